"""The corpus pipeline: every stage applies one operator to what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontamination import decontamination_stage
from tidemark.llm.near_dups import near_duplicate_stage
from tidemark.llm.packing import packing_stage
from tidemark.llm.pii import pii_stage
from tidemark.llm.quality import quality_stage
from tidemark.session import scratch_path

STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: The stages hash, train and pack, which SQL cannot express; tests/llm compares them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
