"""Column profiles from small mergeable parts: one part a day (or file), written once, merged when read.

A part holds exact counts and a distinct sketch of every column. A new day is profiled alone and added to the
written parts; the profile of the whole table is then a merge of parts and reads no row again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import coerce_number_symbols, is_missing, parse_date_text
from tidemark.operators.profiling import HEAVY_MISSING, IDENTIFIER_SHARE, _finish, column_profile

# 2 ** PRECISION registers of a byte: 16 KB for a column with many values.
PRECISION = 14
# Five standard errors of a merged sketch: about one estimate in two million lies further off.
ERROR = 5 * 1.04 / 2 ** (PRECISION / 2)


def profile_parts(df: DataFrame, order: str, by: list[str] | None = None) -> DataFrame:
    """(by..., position, column, rows, missing, numbers, dates, example, example_at, sketch), from one scan.

    No value is shuffled: a task sends one row for each combination of ``by`` it holds. An empty table gives
    columns of 0 rows without ``by``, no row with it.
    """
    by = by or []
    columns = [c for c in df.columns if c != order and c not in by]
    text = [F.when(~is_missing(F.col(f"`{c}`")), F.col(f"`{c}`").cast("string")).alias(f"_v{i}") for i, c in enumerate(columns)]
    shown = df.select(*by, F.col(order).alias("_order"), *text)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i in range(len(columns)):
        v = F.col(f"_v{i}")
        at = F.when(v.isNotNull(), F.col("_order"))
        aggs += [
            F.count_if(v.isNull()).alias(f"_missing{i}"), F.hll_sketch_agg(v, PRECISION).alias(f"_sketch{i}"),
            F.min_by(v, at).alias(f"_example{i}"), F.min(at).alias(f"_example_at{i}"),
            F.count_if(coerce_number_symbols(v).isNotNull()).alias(f"_numbers{i}"),
            F.count_if(parse_date_text(v).isNotNull()).alias(f"_dates{i}"),
        ]
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col("_rows").alias("rows"),
                 *[F.col(f"_{m}{i}").alias(m) for m in ("missing", "numbers", "dates", "example", "example_at", "sketch")])
        for i, c in enumerate(columns)
    ])
    wide = shown.groupBy(*by).agg(*aggs)
    return wide.select(*by, F.inline(cells))


def write_parts(parts: DataFrame, path: str, by: list[str]) -> str:
    """Add parts to those at ``path``; a part of the same day is replaced, all others stay."""
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return path


def merge_parts(parts: DataFrame) -> DataFrame:
    """``column_profile`` of all parts together, with an estimated ``distinct`` and its bounds ``low`` and ``high``.

    Columns that only some parts have are counted over the rows of those.
    """
    merged = parts.groupBy("column").agg(
        F.min("position").alias("position"), F.sum("rows").alias("rows"), F.sum("missing").alias("missing"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"), F.min_by("example", "example_at").alias("example"),
        F.sum("numbers").alias("numbers"), F.sum("dates").alias("dates"))
    return _finish(merged).drop("numbers", "dates").withColumns({
        "low": F.floor(F.col("distinct") / (1 + ERROR)), "high": F.ceil(F.col("distinct") / (1 - ERROR))})


def identifier_column(profile: list, count_exactly) -> str | None:
    """The first category column with distinct values for more than ``IDENTIFIER_SHARE`` of its rows.

    ``profile`` has the rows of ``merge_parts``. Columns whose bounds lie on both sides of the limit, up to the first
    one that is surely beyond it, are passed to ``count_exactly``, which returns their distinct counts by name.
    """
    candidates, open_ones, sure = sorted((r for r in profile if r["type"] == "category" and r["rows"]), key=lambda r: r["position"]), [], None
    for r in candidates:
        limit = IDENTIFIER_SHARE * r["rows"]
        if r["low"] > limit:
            sure = r["column"]
            break
        if r["high"] > limit:
            open_ones.append(r)
    counted = count_exactly([r["column"] for r in open_ones]) if open_ones else {}
    return next((r["column"] for r in open_ones if counted[r["column"]] / r["rows"] > IDENTIFIER_SHARE), sure)


def profile_warnings(df: DataFrame, order: str, parts: DataFrame | None = None) -> DataFrame:
    """(kind, text): empty table, many missing values, a category that looks like an identifier.

    The profile is one row a column; with written ``parts`` of the table no row is read. Values are shuffled
    only for columns that the bounds of their sketch leave open.
    """
    profile = merge_parts(profile_parts(df, order) if parts is None else parts).collect()

    def count_exactly(columns: list[str]) -> dict[str, int]:
        found = column_profile(df.select(order, *columns), order).select("column", "distinct").collect()
        return {r["column"]: r["distinct"] for r in found}

    heavy = sorted((r for r in profile if r["missing_rate"] >= HEAVY_MISSING), key=lambda r: r["position"])
    alike = identifier_column(profile, count_exactly)
    told = []
    if not any(r["rows"] for r in profile):
        told.append(("empty", "The dataset is empty."))
    if heavy:
        told.append(("missing", f"{len(heavy)} columns have at least 20% missing values, led by {heavy[0]['column']}."))
    if alike:
        told.append(("identifier", f"{alike} behaves like an identifier rather than a grouping feature."))
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(text).alias("text")) for kind, text in told]
    none = F.array().cast("array<struct<kind:string,text:string>>")
    return df.sparkSession.range(1).select(F.inline(F.array(*rows) if rows else none))
