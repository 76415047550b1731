"""Small helpers that several operators of this package share."""

from __future__ import annotations

import gc
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: White space of the word rule: space and the controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) plan and, where SQL can express it, its twin."""

    def register(plan):
        QUERIES[name] = plan
        if sql:
            SQL[name] = sql
        return plan

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key's text modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def fold_of(key: int, folds: int) -> int:
    return zlib.crc32(str(key).encode()) % folds


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (case does not count)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sample_order(key: str) -> Column:
    return F.crc32(F.concat(F.lit("sample:"), F.col(key).cast("string")).cast("binary"))


def bounded_sample(labelled: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows in the order of a hash of the key: the same rows for the same table.

    For fitting models only. Spark keeps ``rows`` rows per task, so nothing large moves.
    """
    return labelled.orderBy(sample_order(key), F.col(key)).limit(rows)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts hold about ``most_bytes`` bytes; a longer text is alone."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most_bytes:
            yield start, i
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files and checkpoints of tables that nothing refers to any more.

    It does so when the driver collects garbage, which a driver with little to do may not do before a long job ends.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
