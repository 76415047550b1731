"""Imports every operator module, which registers its query."""

from tidemark.llm import decontamination, exact_dups, fill_in_middle, html_text, language, near_dups, packing, periodic_runs, pii, quality, token_counts, toxicity, warc  # noqa: F401
from tidemark.llm.common import QUERIES, SQL  # noqa: F401
