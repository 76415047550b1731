"""Top rows, repeatable samples, sorted previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import MISSING, as_number, display_value
from tidemark.operators.order import join_checked, numbered_rows
from tidemark.operators.profiling import natural_order

# Sample sizes.
SCATTER_ROWS = 12_000
STRATIFIED_ROWS = 2_200
STRATUM_MIN = 60
HASH_DIGITS = 13


def top_outliers(df: DataFrame, column: str, key: str, n: int = 8) -> DataFrame:
    """Rows with the largest finite values; the lower key wins ties."""
    rows = df.withColumn("_value", as_number(df, column)).where(F.col("_value").isNotNull())
    return rows.orderBy(F.desc("_value"), F.asc(key)).limit(n).drop("_value")


def multi_key_sort(df: DataFrame, keys: list[tuple[str, bool]]) -> DataFrame:
    """Sort by (column, ascending) pairs."""
    return df.orderBy(*[F.asc(c) if up else F.desc(c) for c, up in keys])


def natural_sort(df: DataFrame, column: str) -> DataFrame:
    return df.orderBy(*natural_order(column))


def head_preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def _draw(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def random_sample(df: DataFrame, key: str, n: int = SCATTER_ROWS, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones whatever the partitioning.

    Rows are ordered by a hash of their unique key. A hash threshold first leaves about twice
    the sample, so the final top-n never sees more than that per table.
    """
    ordered = df.withColumn("_draw", _draw(key, seed))
    total = df.count()
    if total > 4 * n + 2000:
        share = (2 * n + 1000) / total
        limit = f"{int(share * 16 ** HASH_DIGITS):0{HASH_DIGITS}x}"
        near = ordered.where(F.substring("_draw", 1, HASH_DIGITS) < limit)
        if near.count() >= n:
            ordered = near
    return ordered.orderBy("_draw", key).limit(n).drop("_draw")


def stratified_sample(df: DataFrame, label: str, key: str, max_rows: int = STRATIFIED_ROWS,
                      stratum_min: int = STRATUM_MIN) -> DataFrame:
    """About ``max_rows`` rows, evenly strided inside each label in key order; every label has one at least.

    Each label aims at its share of ``max_rows``, at least ``stratum_min``. If the labels together would take more than
    ``max_rows``, all aims are lowered in proportion. Tables within ``max_rows`` are returned whole; only with more
    labels than ``max_rows`` is the sample larger.
    """
    if len(df.select(key).take(max_rows + 1)) <= max_rows:
        return df
    rows = df.withColumn("_label", display_value(label))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    sizes = rows.where(F.col("_label") != MISSING).groupBy("_label").agg(F.count(F.lit(1)).alias("_rows"))
    target = F.greatest(F.lit(stratum_min), F.floor(F.col("_rows").cast("double") / total * max_rows + 0.5))
    first = sizes.withColumn("_target", target).withColumn(
        "_first", F.greatest(F.lit(1), F.floor(F.col("_rows") / F.col("_target"))).cast("long"))
    sums = first.agg(F.sum(F.ceil(F.col("_rows") / F.col("_first"))).alias("taken"), F.sum("_target").alias("aims")).first()
    step = F.col("_first")
    if (sums["taken"] or 0) > max_rows:
        lower = F.greatest(F.lit(1), F.floor(F.col("_target") * max_rows / F.lit(sums["aims"])))
        step = F.ceil(F.col("_rows") / lower).cast("long")
    plan = first.select("_label", step.alias("_step"))
    slim = numbered_rows(rows.select("_label", key), key, ["_label"], "_place")
    chosen = (
        slim.join(plan, "_label")
        .where((F.col("_place") - 1) % F.col("_step") == 0)
        .select(key)
    )
    # As many keys as rows in the sample: the rows are numbered once and the table is not shuffled to meet them.
    return join_checked(df, chosen, key, "left_semi")
