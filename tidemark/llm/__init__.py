"""Operators for preparing training text: ``queries`` registers them, each module holds one operator."""
