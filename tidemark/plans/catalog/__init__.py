"""Registered queries: each names its Spark plan and, where SQL can express it, its SQL twin."""

from __future__ import annotations

from tidemark.plans.catalog import cleaning, models, scalars, sources, statistics  # noqa: F401
from tidemark.plans.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
