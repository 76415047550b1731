"""Filters, missing values and sparsity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scores import SOURCES
from tidemark.functions.values import all_zero, finite
from tidemark.operators import cleaning as ops
from tidemark.operators.profiling import missing_top
from tidemark.plans.catalog.registry import PREP, RAW, query, rounded, union_sql
from tidemark.plans.records import AMOUNTS, labelled_records, raw_records, table

NUMERIC = ["record_id", "funding_total_usd", "funding_rounds", "seed", "venture", "debt_financing", "angel", "grant",
           "private_equity", "sparse_a", *[f"round_{x}" for x in "ABCDEFGH"]]
TEXT = ["name", "category_list", "market", "status", "country_code", "region", "city", "date"]
ALL_ZERO = " AND ".join(f'"{c}" = 0' for c in AMOUNTS)


@query("drop_empty_rows", """SELECT quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
WHERE quality IS NOT NULL OR toxic IS NOT NULL""")
def _drop_empty_rows(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return ops.drop_empty_rows(joined.select("quality", "toxic"))


@query("drop_missing_key", f"""WITH {RAW} SELECT record_id, market, category_list FROM raw
WHERE market IS NOT NULL AND category_list IS NOT NULL""")
def _drop_missing_key(spark, sf_dir):
    df = raw_records(spark, sf_dir).select("record_id", "market", "category_list")
    return ops.drop_missing_key(df, ["market", "category_list"])


@query("drop_duplicates", f"WITH {RAW} SELECT DISTINCT market, status, category_list, country_code FROM raw")
def _drop_duplicates(spark, sf_dir):
    return ops.drop_duplicates(raw_records(spark, sf_dir).select("market", "status", "category_list", "country_code"))


@query("drop_all_zero", f"WITH {RAW} SELECT record_id, venture FROM raw WHERE NOT ({ALL_ZERO})")
def _drop_all_zero(spark, sf_dir):
    return ops.drop_all_zero(raw_records(spark, sf_dir), AMOUNTS).select("record_id", "venture")


_ZERO_SQL = union_sql(NUMERIC, lambda i, c: (
    f"SELECT '{c}' AS \"column\", 100.0 * count(*) FILTER (\"{c}\" = 0) / count(*) AS pct, "
    f"count(*) FILTER (\"{c}\" IS NULL OR \"{c}\" <> 0) AS nonzero FROM raw"))


@query("zero_profile", f"""WITH {RAW} SELECT "column", round(pct, 6) AS zero_pct, nonzero,
CASE WHEN pct > 99.5 THEN 'Discard (pure noise)' WHEN pct > 98.5 THEN 'Drop candidate'
WHEN pct > 95.0 THEN 'Borderline (still relevant)' ELSE 'Useful (good volume)' END AS verdict FROM ({_ZERO_SQL})""")
def _zero_profile(spark, sf_dir):
    return rounded(ops.zero_profile(raw_records(spark, sf_dir)).select("column", "zero_pct", "nonzero", "verdict"))


_SPARSE_SQL = union_sql(NUMERIC, lambda i, c: (
    f"SELECT '{c}' AS \"column\", count(*) FILTER (\"{c}\" = 0) / count(*) AS z, "
    f"count(*) FILTER (\"{c}\" IS NULL) / count(*) AS u, count(*) FILTER (\"{c}\" IS NULL) AS nulls FROM raw"
)) + " UNION ALL " + union_sql(TEXT, lambda i, c: (
    f"SELECT '{c}', 0, count(*) FILTER (\"{c}\" IS NULL) / count(*), count(*) FILTER (\"{c}\" IS NULL) FROM raw"))


@query("prune_sparse_columns", f"""WITH {RAW} SELECT "column", round(z, 6) AS zero_rate, round(u, 6) AS null_rate,
z > 0.98 OR u > 0.90 AS dropped FROM ({_SPARSE_SQL})""")
def _prune_sparse_columns(spark, sf_dir):
    return rounded(ops.sparsity(raw_records(spark, sf_dir)).select("column", "zero_rate", "null_rate", "dropped"))


@query("column_set_union", f"""WITH {RAW}, d AS (SELECT "column", z, u FROM ({_SPARSE_SQL}))
SELECT "column" AS kept FROM d WHERE NOT (z > 0.5 OR u > 0.05)""")
def _column_set_union(spark, sf_dir):
    kept = ops.prune_sparse_columns(raw_records(spark, sf_dir), 0.5, 0.05)
    return ops.sparsity(kept).select(F.col("column").alias("kept"))


@query("zero_rate_columns", f"""WITH {RAW} SELECT "column", round(100 * z, 6) AS zero_pct FROM ({_SPARSE_SQL})""")
def _zero_rate_columns(spark, sf_dir):
    return rounded(ops.zero_rates(raw_records(spark, sf_dir)).select("column", "zero_pct"))


@query("zero_rate_one", f"""WITH {RAW} SELECT 'all sources' AS rule, count(*) FILTER ({ALL_ZERO}) AS zero_rows,
count(*) AS "rows", round(100.0 * count(*) FILTER ({ALL_ZERO}) / count(*), 6) AS zero_pct FROM raw UNION ALL
SELECT 'venture', count(*) FILTER (venture = 0), count(*), round(100.0 * count(*) FILTER (venture = 0) / count(*), 6)
FROM raw""")
def _zero_rate_one(spark, sf_dir):
    df = raw_records(spark, sf_dir)
    rules = {"all sources": all_zero(AMOUNTS), "venture": F.col("venture") == 0}
    parts = [ops.zero_rate_one(df, c).select(F.lit(n).alias("rule"), "*") for n, c in rules.items()]
    return rounded(parts[0].unionByName(parts[1]))


@query("null_counts", f"""WITH {RAW} SELECT "column", nulls FROM ({_SPARSE_SQL})""")
def _null_counts(spark, sf_dir):
    return ops.null_counts(raw_records(spark, sf_dir)).select("column", "nulls")


@query("missing_top", f"""WITH {RAW} SELECT "column", nulls AS missing, round(u, 6) AS missing_rate FROM ({_SPARSE_SQL})
WHERE nulls > 0""")
def _missing_top(spark, sf_dir):
    return rounded(missing_top(raw_records(spark, sf_dir)))


_SOURCE_SQL = union_sql(list(SOURCES), lambda i, c: (
    f"SELECT {i} AS position, '{c}' AS \"column\", '{SOURCES[c]}' AS label, count({c}) AS present, "
    f"count(*) FILTER ({c} = 0) AS zero_count FROM prep"))


@query("zero_source_summary", f"""WITH {PREP}, s AS (SELECT *, zero_count / present AS r FROM ({_SOURCE_SQL}))
SELECT "column", label, present, zero_count, round(r, 6) AS zero_rate,
CAST((SELECT sum(present) FROM s) AS BIGINT) AS total_cells, CAST((SELECT sum(zero_count) FROM s) AS BIGINT) AS zero_cells,
round((SELECT sum(zero_count) / sum(present) FROM s), 6) AS pooled_rate,
(SELECT "column" FROM s ORDER BY r DESC, position LIMIT 1) AS highest FROM s""")
def _zero_source_summary(spark, sf_dir):
    return rounded(ops.zero_source_summary(labelled_records(spark, sf_dir), SOURCES).drop("position"))


_FUNNEL = ["name", "market", "status", "country_code", "funding_total_usd", *[f'"{c}"' for c in AMOUNTS]]


def _funnel_sql() -> str:
    steps = [" OR ".join(f"{c} IS NOT NULL" for c in _FUNNEL), "name IS NOT NULL", "true", "funding_total_usd IS NOT NULL AND market IS NOT NULL", f"NOT ({ALL_ZERO})"]
    names = ["empty", "missing_name", "drop_duplicates", "missing_total_or_market", "all_zero"]
    sources = ["r", "r", "u", "u", "u"]
    remaining = []
    for i in range(len(steps)):
        condition = " AND ".join(f"({s})" for s in steps[: i + 1])
        remaining.append(f"(SELECT count(*) FROM {sources[i]} WHERE {condition})")
    parts = []
    for i, name in enumerate(names):
        before = remaining[i - 1] if i else "(SELECT count(*) FROM r)"
        parts.append(f"SELECT {i} AS step, '{name}' AS rule, {before} - {remaining[i]} AS removed, {remaining[i]} AS remaining")
    return (f"WITH {RAW}, r AS (SELECT " + ", ".join(f"CASE WHEN record_id % 50 > 0 THEN {c} END AS {c}" for c in _FUNNEL)
            + " FROM raw), u AS (SELECT DISTINCT * FROM r) "
            + " UNION ALL ".join(parts))


@query("row_funnel", _funnel_sql())
def _row_funnel(spark, sf_dir):
    """Every fiftieth record is blank."""
    names = ["name", "market", "status", "country_code", "funding_total_usd", *AMOUNTS]
    df = raw_records(spark, sf_dir).select(*[F.when(F.col("record_id") % 50 > 0, F.col(c)).alias(c) for c in names])
    steps = [("empty", ops.has_values(df)), ("missing_name", F.col("name").isNotNull()),
             ("missing_total_or_market", F.col("funding_total_usd").isNotNull() & F.col("market").isNotNull()),
             ("all_zero", ~all_zero(AMOUNTS))]
    return ops.row_funnel(df, steps, distinct_after=2)


@query("select_segment", f"""WITH {PREP} SELECT record_id, market, venture FROM prep WHERE "Cluster" = '1'""")
def _select_segment(spark, sf_dir):
    return ops.select_segment(labelled_records(spark, sf_dir), "Cluster", "1").select("record_id", "market", "venture")


@query("search_table", f"""WITH {PREP}, hits AS (SELECT * FROM prep WHERE "Cluster" = '3' AND
(contains(lower(name), 'auto') OR contains(lower(market), 'auto') OR contains(lower(status), 'auto') OR
contains(lower(country_code), 'auto') OR contains(lower(city), 'auto') OR contains("Cluster", 'auto')))
SELECT record_id, name, market, funding_total_usd, (SELECT count(*) FROM hits) AS matches FROM hits
ORDER BY record_id LIMIT 180""")
def _search_table(spark, sf_dir):
    found = ops.search_table(labelled_records(spark, sf_dir), " Auto ",
                             ["name", "market", "status", "country_code", "city", "Cluster"], "record_id", "Cluster", "3")
    return found.select("record_id", "name", "market", "funding_total_usd", "matches")


@query("finite_filter", """SELECT event_id, value FROM events WHERE event_type NOT IN ('error', 'click')""")
def _finite_filter(spark, sf_dir):
    odd = F.when(F.col("event_type") == "error", F.lit(float("nan"))).when(
        F.col("event_type") == "click", F.lit(float("inf"))).otherwise(F.col("value"))
    df = table(spark, sf_dir, "events").select("event_id", finite(odd).alias("value"))
    return df.where(F.col("value").isNotNull())
