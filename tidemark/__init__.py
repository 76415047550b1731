"""Profile wide, zero-inflated records and split them into segments on Spark."""

__version__ = "0.1.0"
