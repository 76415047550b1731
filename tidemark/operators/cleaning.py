"""Row filters, zero and null profiles, data-driven column drop, step counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tidemark.functions.values import all_zero, as_number
from tidemark.operators.schema import column_set_union, numeric_columns

# Thresholds of the column drop and of the zero verdict.
ZERO_LIMIT = 0.98
NULL_LIMIT = 0.90
VERDICTS = [(99.5, "Discard (pure noise)"), (98.5, "Drop candidate"), (95.0, "Borderline (still relevant)")]
VERDICT_ELSE = "Useful (good volume)"


def is_null(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_zero(df: DataFrame, name: str) -> Column:
    """Exactly 0; null and text are not."""
    if name in numeric_columns(df):
        return F.coalesce(F.col(name) == 0, F.lit(False))
    return F.lit(False)


def has_values(df: DataFrame) -> Column:
    """At least one column has a value: the rows that ``drop_empty_rows`` keeps, as a step of ``row_funnel``."""
    return ~reduce(lambda a, b: a & b, [is_null(df, c) for c in df.columns], F.lit(True))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna("all")


def drop_missing_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna("any", subset=keys)


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_all_zero(df: DataFrame, amounts: list[str]) -> DataFrame:
    return df.where(~all_zero(amounts))


def _per_column(df: DataFrame, columns: list[str], measures: dict[str, object]) -> DataFrame:
    """One pass over the table, then one row per column with the named measures and ``rows``."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggs += [measure(c).alias(f"{name}_{i}") for name, measure in measures.items()]
    wide = df.agg(*aggs)
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 *[F.col(f"{name}_{i}").alias(name) for name in measures])
        for i, c in enumerate(columns)
    ])
    return wide.select("rows", F.inline(cells))


def zero_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Zero percentage over all rows, count of values other than 0 (nulls included) and a verdict."""
    columns = columns or numeric_columns(df)
    table = _per_column(df, columns, {"zeros": lambda c: F.count_if(is_zero(df, c))})
    pct = F.try_divide(F.col("zeros") * 100.0, F.col("rows"))
    verdict = F.lit(VERDICT_ELSE)
    for limit, text in reversed(VERDICTS):
        verdict = F.when(pct > limit, text).otherwise(verdict)
    return table.select("position", "column", pct.alias("zero_pct"),
                        (F.col("rows") - F.col("zeros")).alias("nonzero"), verdict.alias("verdict"))


def sparsity(df: DataFrame, columns: list[str] | None = None, zero_limit: float = ZERO_LIMIT,
             null_limit: float = NULL_LIMIT) -> DataFrame:
    """Zero and null rate of each column over all rows, and whether the limits drop it."""
    table = _per_column(df, columns or df.columns, {
        "zeros": lambda c: F.count_if(is_zero(df, c)),
        "nulls": lambda c: F.count_if(is_null(df, c)),
    })
    zero_rate = F.coalesce(F.try_divide(F.col("zeros").cast("double"), F.col("rows")), F.lit(0.0))
    null_rate = F.coalesce(F.try_divide(F.col("nulls").cast("double"), F.col("rows")), F.lit(0.0))
    return table.select("position", "column", "rows", "zeros", "nulls", zero_rate.alias("zero_rate"),
                        null_rate.alias("null_rate"),
                        ((zero_rate > zero_limit) | (null_rate > null_limit)).alias("dropped"))


def prune_sparse_columns(df: DataFrame, zero_limit: float = ZERO_LIMIT, null_limit: float = NULL_LIMIT) -> DataFrame:
    """Drop the columns that are too sparse: one aggregate job, then a projection."""
    decided = sparsity(df, None, zero_limit, null_limit).collect()
    mostly_zero = [r["column"] for r in decided if r["zero_rate"] > zero_limit]
    mostly_null = [r["column"] for r in decided if r["null_rate"] > null_limit]
    return df.drop(*column_set_union(mostly_zero, mostly_null))


def null_counts(df: DataFrame) -> DataFrame:
    return sparsity(df).select("position", "column", "nulls")


def zero_rates(df: DataFrame) -> DataFrame:
    return sparsity(df).select("position", "column", (F.col("zero_rate") * 100).alias("zero_pct"))


def zero_rate_one(df: DataFrame, condition: Column) -> DataFrame:
    """Rows meeting a condition, all rows, and the percentage."""
    counted = df.agg(F.count_if(condition).alias("zero_rows"), F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("zero_pct", F.try_divide(F.col("zero_rows") * 100.0, F.col("rows")))


def zero_source_summary(df: DataFrame, sources: dict[str, str]) -> DataFrame:
    """Zero rate of each source over its present values, the pooled rate, and the worst source."""
    columns = [c for c in sources if c in df.columns]
    table = _per_column(df, columns, {
        "present": lambda c: F.count(as_number(df, c)),
        "zero_count": lambda c: F.count_if(as_number(df, c) == 0),
    }).where(F.col("present") > 0)
    table = table.withColumn("zero_rate", F.col("zero_count").cast("double") / F.col("present"))
    # One row per source, so this window is a handful of rows.
    everything = Window.partitionBy(F.lit(1))
    labels = F.create_map(*[F.lit(x) for pair in sources.items() for x in pair])
    return table.select(
        "position", "column", F.try_element_at(labels, F.col("column")).alias("label"), "present", "zero_count",
        "zero_rate",
        F.sum("present").over(everything).alias("total_cells"),
        F.sum("zero_count").over(everything).alias("zero_cells"),
        (F.sum("zero_count").over(everything).cast("double") / F.sum("present").over(everything)).alias("pooled_rate"),
        F.max_by("column", F.struct("zero_rate", -F.col("position"))).over(everything).alias("highest"),
    )


def row_funnel(df: DataFrame, steps: list[tuple[str, Column]], distinct_after: int | None = None) -> DataFrame:
    """Rows removed and remaining after each cumulative filter step, counted in one pass.

    ``distinct_after`` puts a full-row distinct after that many filter steps. Copies of a row pass
    or fail every filter together, so counting the copies once per row keeps this to one shuffle.
    """
    names = [name for name, _ in steps]
    passed, cumulative = None, []
    for _, keep in steps:
        keep = F.coalesce(keep, F.lit(False))
        passed = keep if passed is None else passed & keep
        cumulative.append(passed)
    if distinct_after is None:
        flagged = df.select(F.lit(1).alias("copies"), *[c.alias(f"s{i}") for i, c in enumerate(cumulative)])
    else:
        flagged = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")).select(
            "copies", *[c.alias(f"s{i}") for i, c in enumerate(cumulative)])
        names.insert(distinct_after, "drop_duplicates")
    counts = [F.coalesce(F.sum("copies"), F.lit(0)).alias("n")]
    for i in range(len(steps)):
        before_distinct = distinct_after is None or i < distinct_after
        rows = F.col("copies") if before_distinct else F.lit(1)
        counts.append(F.coalesce(F.sum(F.when(F.col(f"s{i}"), rows)), F.lit(0)).alias(f"c{i}"))
        if distinct_after is not None and i == distinct_after - 1:
            counts.append(F.count_if(F.col(f"s{i}")).alias("d"))
    remaining = [F.col(f"c{i}") for i in range(len(steps))]
    if distinct_after is not None:
        remaining.insert(distinct_after, F.col("d") if distinct_after else F.lit(None))
    remaining = [F.col("n"), *remaining]
    cells = F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("rule"),
                 (remaining[i] - remaining[i + 1]).alias("removed"), remaining[i + 1].alias("remaining"))
        for i, name in enumerate(names)
    ])
    return flagged.agg(*counts).select(F.inline(cells))


def select_segment(df: DataFrame, label: str, value: object) -> DataFrame:
    return df.where(F.col(label) == F.lit(value))


def search_rows(df: DataFrame, term: str, columns: list[str], label: str | None = None,
                value: str | None = None) -> DataFrame:
    """Rows of one label (if given) holding the term, in any case, in one of the columns."""
    condition = F.lit(True)
    if label and value is not None:
        condition = condition & (F.col(label).cast("string") == value)
    needle = term.strip().lower()
    if needle:
        hits = [F.coalesce(F.lower(F.col(c).cast("string")).contains(needle), F.lit(False))
                for c in columns if c in df.columns]
        condition = condition & reduce(lambda a, b: a | b, hits, F.lit(False))
    return df.where(condition)


def search_table(df: DataFrame, term: str, columns: list[str], order: str, label: str | None = None,
                 value: str | None = None, limit: int = 180) -> DataFrame:
    """The first matching rows in key order, beside the number of all matches."""
    found = search_rows(df, term, columns, label, value)
    total = found.agg(F.count(F.lit(1)).alias("matches")).scalar()
    return found.orderBy(order).limit(limit).withColumn("matches", total)
