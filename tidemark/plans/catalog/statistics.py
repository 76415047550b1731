"""Joins, aggregates, windows, sorts, samples, reshaping and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scores import STATUS_CLASSES
from tidemark.functions.templates import FINDINGS, STATUS_READINGS, TAKEAWAY, fill_sql
from tidemark.functions.text import METRIC_LABELS, REPORT_NAMES, group_text, subgroup_text
from tidemark.functions.values import display_value
from tidemark.operators import groups as G
from tidemark.operators import profiling as P
from tidemark.operators import sampling
from tidemark.operators.order import (
    date_percentile,
    exact_quantiles,
    frequency_percentile,
    join_checked,
    midrank_percentile,
)
from tidemark.operators.scaling import robust_scale
from tidemark.operators.schema import MODEL_FEATURES, PROFILE_FEATURES, transpose, unpivot
from tidemark.operators.sketches import merge_parts, profile_parts, profile_warnings, write_parts
from tidemark.operators.segments import segment_names, segment_summary, subgroup_model
from tidemark.plans import reports as R
from tidemark.plans.catalog.registry import PREP, RAW, SEG, label_values, query, rounded, union_sql
from tidemark.plans.catalog.scalars import compact_sql, money_sql, number_sql, percent_sql, spread_sql
from tidemark.plans.catalog.sources import FIT_SQL, SCALED_SQL
from tidemark.plans.records import labelled_records, raw_records, segment_records, table
from tidemark.session import scratch_path

REAL = PROFILE_FEATURES[:7]
RATIOS = PROFILE_FEATURES[7:]
STATUSES = ["operating", "acquired", "closed"]
LABELS = ["0", "1", "2", "3"]
ALL_FEATURES = MODEL_FEATURES + [c for c in PROFILE_FEATURES if c not in MODEL_FEATURES]
SUB_FEATURES = ["funding_total_usd", "funding_rounds", "venture", "venture_ratio"]


def labelled(spark, sf_dir):
    return labelled_records(spark, sf_dir)


def median_sql(c: str, q: float = 0.5) -> str:
    return f"quantile_cont(CAST({c} AS DOUBLE), {q})"


def long_sql(features: list[str], expr: str, source: str = "prep", by: str = '"Cluster"') -> str:
    """(by, feature, value) rows: one grouped SELECT per feature; ``{c}`` is the column."""
    by = f"{by}, " if by else ""
    group = f" GROUP BY {by[:-2]}" if by else ""
    return union_sql(features, lambda i, c: f"SELECT {by}{i} AS pos, '{c}' AS feature, {expr.format(c=c)} FROM {source}{group}")


# --- joins -----------------------------------------------------------------------------------

_SIZES = ('sizes AS (SELECT "Cluster", count(*) AS "rows", round_even(100.0::DOUBLE * count(*) / (SELECT count(*) FROM prep '
          'WHERE "Cluster" IS NOT NULL), 2) AS pct, ' + ", ".join(f"round_even({median_sql(c)}, 0) AS {c}" for c in REAL)
          + ' FROM prep WHERE "Cluster" IS NOT NULL GROUP BY "Cluster")')
_STATUS_PCT = ('st AS (SELECT "Cluster", ' + ", ".join(
    f"round_even(100.0::DOUBLE * count(*) FILTER (status = '{s}') / count(status), 2) AS {s}" for s in STATUSES)
    + ' FROM prep GROUP BY "Cluster")')


@query("join_sizes_profile", f"WITH {PREP}, {_SIZES} SELECT * FROM sizes")
def _join_sizes_profile(spark, sf_dir):
    return R.join_sizes_profile(labelled(spark, sf_dir), "Cluster", REAL)


@query("join_status", f'WITH {PREP}, {_SIZES}, {_STATUS_PCT} SELECT sizes."Cluster", "rows", pct, operating, acquired, closed '
       'FROM sizes LEFT JOIN st ON sizes."Cluster" = st."Cluster"')
def _join_status(spark, sf_dir):
    df = labelled(spark, sf_dir)
    sizes = G.group_sizes(df, "Cluster").withColumn("pct", F.bround("pct", 2))
    status = G.crosstab_row_pct(df, "Cluster", "status", STATUSES)
    return sizes.join(status.select("Cluster", *[F.bround(s, 2).alias(s) for s in STATUSES]), "Cluster", "left")


_LIFT = ('inside AS (SELECT "Cluster", market, count(*) AS n FROM prep WHERE market IS NOT NULL GROUP BY ALL), '
         'lift AS (SELECT "Cluster", i.market, n AS "rows", n / sum(n) OVER (PARTITION BY "Cluster") AS share, base_share, '
         '(n / sum(n) OVER (PARTITION BY "Cluster")) / base_share AS lift FROM inside i JOIN (SELECT market, '
         'count(*) / (SELECT count(*) FROM prep WHERE market IS NOT NULL) AS base_share FROM prep WHERE market IS NOT NULL '
         'GROUP BY market) b ON i.market = b.market)')


@query("share_ratio_join", f'WITH {PREP}, {_LIFT} SELECT "Cluster", market, "rows", round(share, 6) AS share, '
       'round(base_share, 6) AS base_share, round(lift, 6) AS lift FROM lift')
def _share_ratio_join(spark, sf_dir):
    return rounded(G.share_ratio(labelled(spark, sf_dir), "Cluster", "market"))


@query("assemble_series", f'WITH {PREP}, {_LIFT} SELECT "Cluster", market, round_even(share * 100, 2) AS share_pct, '
       '"rows", round_even(lift, 2) AS lift FROM lift WHERE "rows" >= 20')
def _assemble_series(spark, sf_dir):
    df = labelled(spark, sf_dir)
    lifts = G.share_ratio(df, "Cluster", "market").where(F.col("rows") >= 20).select(
        "Cluster", "market", F.bround("lift", 2).alias("lift"))
    shares = G.share_of_total(df, "Cluster", "market").select(
        "Cluster", "market", F.bround(F.col("share") * 100, 2).alias("share_pct"), "rows")
    return G.assemble_series(shares, lifts, ["Cluster", "market"])


@query("reindex", f"""WITH {PREP}, n AS (SELECT market AS label, count(*) AS n FROM prep WHERE "Cluster" = '2' GROUP BY market)
SELECT m.label, coalesce(n.n, 0) AS n FROM (SELECT DISTINCT c_mktsegment AS label FROM customer) m LEFT JOIN n ON n.label = m.label""")
def _reindex(spark, sf_dir):
    labels = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("label")).distinct()
    small = labelled(spark, sf_dir).where(F.col("Cluster") == "2").groupBy(F.col("market").alias("label")).agg(
        F.count(F.lit(1)).alias("n"))
    return G.reindex(labels, small, "label", {"n": 0})


@query("label_by_position", f"""WITH {PREP}, s AS (SELECT record_id, CASE WHEN venture > funding_total_usd THEN 'above' ELSE 'within' END AS label FROM prep)
SELECT raw.record_id, label FROM raw LEFT JOIN s ON raw.record_id = s.record_id""")
def _label_by_position(spark, sf_dir):
    prepared = labelled(spark, sf_dir)
    labels = prepared.select("record_id", F.when(F.col("venture") > F.col("funding_total_usd"), "above")
                             .otherwise("within").alias("label"))
    return raw_records(spark, sf_dir).select("record_id").join(labels, "record_id", "left")


@query("lookup_profile", f"""WITH {PREP}, m AS (SELECT "Cluster", {median_sql('funding_total_usd')} AS typical FROM prep GROUP BY "Cluster")
SELECT record_id, prep."Cluster", round(typical, 4) AS typical, funding_total_usd > typical AS above FROM prep JOIN m ON prep."Cluster" = m."Cluster" """)
def _lookup_profile(spark, sf_dir):
    df = labelled(spark, sf_dir)
    typical = G.group_median(df, "Cluster", ["funding_total_usd"]).select("Cluster", F.col("median").alias("typical"))
    return rounded(join_checked(df.select("record_id", "Cluster", "funding_total_usd"), typical, "Cluster").select(
        "record_id", "Cluster", "typical", (F.col("funding_total_usd") > F.col("typical")).alias("above")), 4)


# --- aggregates ------------------------------------------------------------------------------

_DESCRIBE = ("count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min, "
             f"round({median_sql('{c}', 0.25)}, 4) AS q1, round({median_sql('{c}')}, 4) AS median, "
             f"round({median_sql('{c}', 0.75)}, 4) AS q3, round(CAST(max({{c}}) AS DOUBLE), 4) AS max")


@query("describe_numeric", f"WITH {PREP} SELECT * EXCLUDE (pos) FROM ({long_sql(PROFILE_FEATURES, _DESCRIBE, by='')})")
def _describe_numeric(spark, sf_dir):
    return rounded(P.describe_numeric(labelled(spark, sf_dir), PROFILE_FEATURES), 4)


@query("variance_numeric", f"WITH {PREP} SELECT feature, round(v, 6) AS variance FROM ({long_sql(MODEL_FEATURES, 'var_samp({c}) AS v', by='')})")
def _variance_numeric(spark, sf_dir):
    return rounded(P.variance_numeric(labelled(spark, sf_dir), MODEL_FEATURES))


_BASIC = _DESCRIBE.replace("stddev_samp", "stddev_pop")


@query("basic_stats", f"WITH {PREP}, ev AS (SELECT CASE WHEN event_type <> 'error' THEN value END AS value FROM events) "
       f"SELECT * EXCLUDE (pos) FROM ({long_sql(['value'], _BASIC, 'ev', '')})")
def _basic_stats(spark, sf_dir):
    odd = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return rounded(P.basic_stats(table(spark, sf_dir, "events").select(odd.alias("value")), ["value"]), 4)


@query("quantile_linear", "SELECT 'o_totalprice' AS feature, " + ", ".join(
    f"round({median_sql('o_totalprice', q)}, 4) AS {n}" for n, q in (("p1", .01), ("p10", .1), ("p33", .333), ("p90", .9), ("p99", .99)))
    + " FROM orders")
def _quantile_linear(spark, sf_dir):
    probs = {"p1": 0.01, "p10": 0.1, "p33": 0.333, "p90": 0.9, "p99": 0.99}
    return rounded(exact_quantiles(table(spark, sf_dir, "orders"), ["o_totalprice"], probs), 4)


# Ranked way of the same operator, forced by a small limit: what runs on columns with many distinct values.
@query("quantile_linear_ranked", 'SELECT o_orderstatus, feature, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3 FROM ('
       "SELECT o_orderstatus, 'o_totalprice' AS feature, " + ", ".join(
           f"{median_sql('o_totalprice', q)} AS {n}" for n, q in (("q1", .25), ("median", .5), ("q3", .75)))
       + " FROM orders GROUP BY o_orderstatus)")
def _quantile_linear_ranked(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return rounded(exact_quantiles(orders, ["o_totalprice"], by=["o_orderstatus"], small_rows=0, small=100, per_bucket=500, groups=0), 4)


_PROFILE_COLUMNS = ["name", "category_list", "market", "status", "funding_rounds", "date", "total_text"]
_MIXED = ("mixed AS (SELECT record_id, name, category_list, market, status, CAST(funding_rounds AS VARCHAR) AS funding_rounds, "
          "date, CASE WHEN status = 'closed' AND market IS NULL THEN 'undisclosed' ELSE '$' || format('{:,.2f}', funding_total_usd) END AS total_text FROM raw)")
_MIXED_KIND = {"name": "category", "category_list": "category", "market": "category", "status": "category",
               "funding_rounds": "number", "date": "date", "total_text": "number"}


def _mixed(spark, sf_dir):
    return raw_records(spark, sf_dir).select(
        "record_id", "name", "category_list", "market", "status", F.col("funding_rounds").cast("string").alias("funding_rounds"),
        "date", F.when((F.col("status") == "closed") & F.col("market").isNull(), "undisclosed").otherwise(
            F.concat(F.lit("$"), F.format_number("funding_total_usd", 2))).alias("total_text"))


_PROFILE_SQL = union_sql(_PROFILE_COLUMNS, lambda i, c: (
    f"SELECT '{c}' AS \"column\", '{_MIXED_KIND[c]}' AS type, count(*) AS \"rows\", count(*) - count({c}) AS missing, "
    f"round((count(*) - count({c})) / count(*), 6) AS missing_rate, count(DISTINCT {c}) AS \"distinct\", "
    f"min_by({c}, record_id) FILTER ({c} IS NOT NULL) AS example FROM mixed"))


@query("column_profile", f"WITH {RAW}, {_MIXED} {_PROFILE_SQL}")
def _column_profile(spark, sf_dir):
    return rounded(P.column_profile(_mixed(spark, sf_dir), "record_id").drop("position"))


_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_TYPES_SQL = union_sql(_PROFILE_COLUMNS, lambda i, c: (
    f"SELECT '{c}' AS \"column\", count({c}) AS filled, "
    f"count(*) FILTER (regexp_matches(regexp_replace({c}, '[$%,]', '', 'g'), '{_NUMBER}')) AS numbers, "
    f"count(*) FILTER (regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}(-[0-9]{{2}})?$')) AS dates FROM mixed"))


@query("infer_types", f"""WITH {RAW}, {_MIXED} SELECT "column", CASE WHEN numbers / filled >= 0.86 THEN 'number'
WHEN dates / filled >= 0.86 THEN 'date' ELSE 'category' END AS type, numbers, dates FROM ({_TYPES_SQL})""")
def _infer_types(spark, sf_dir):
    return P.infer_types(_mixed(spark, sf_dir), "record_id").select("column", "type", "numbers", "dates")


_TOP_COLUMNS = ["name", "category_list", "market", "status"]
_TOP_SQL = union_sql(_TOP_COLUMNS, lambda i, c: (
    f"SELECT '{c}' AS \"column\", coalesce({c}, '(missing)') AS value, count(*) AS \"rows\", count(*) / (SELECT count(*) FROM mixed) AS s "
    f"FROM mixed GROUP BY {c}"))


@query("column_top_values", f"""WITH {RAW}, {_MIXED}, t AS ({_TOP_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY "column"
ORDER BY "rows" DESC, value) AS rank FROM t) SELECT "column", value, "rows", round(s, 6) AS share, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 8""")
def _column_top_values(spark, sf_dir):
    return rounded(P.column_top_values(_mixed(spark, sf_dir), "record_id").drop("position"))


@query("profile_warnings", """WITH w AS (SELECT doc_id, quality, toxic, lang FROM documents LEFT JOIN labels USING (doc_id)),
m AS (SELECT count(*) FILTER (s >= 0.2) AS n FROM (SELECT 1 - count(quality) / count(*) AS s FROM w UNION ALL
SELECT 1 - count(toxic) / count(*) FROM w UNION ALL SELECT 1 - count(lang) / count(*) FROM w))
SELECT 'missing' AS kind, n || ' columns have at least 20% missing values, led by quality.' AS text FROM m WHERE n > 0
UNION ALL SELECT 'identifier', 'code behaves like an identifier rather than a grouping feature.'""")
def _profile_warnings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    df = docs.select("doc_id", "lang", "quality", "toxic", F.concat(F.lit("doc "), F.col("doc_id")).alias("code"))
    return profile_warnings(df, "doc_id")


_PART_TYPES = {"o_custkey": "number", "o_orderstatus": "category", "o_totalprice": "number", "o_orderdate": "date", "clerk": "category"}


@query("profile_parts", "WITH o AS (SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate), CASE WHEN o_orderkey % 3 > 0 THEN 'clerk ' || o_orderkey END AS clerk FROM orders) " + union_sql(
    list(_PART_TYPES), lambda i, c: f"SELECT '{c}' AS \"column\", '{_PART_TYPES[c]}' AS type, count(*) AS \"rows\", count(*) - count({c}) AS missing, "
    f"arg_min({c}, o_orderkey)::VARCHAR AS example, true AS within FROM o"))
def _profile_parts(spark, sf_dir):
    """Parts by year; the last years are added to those written before, and one year is written again."""
    clerk = F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("clerk "), "o_orderkey"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"),
        clerk.alias("clerk"), F.year("o_orderdate").alias("year"))
    path = scratch_path(spark, "profile-parts")
    for years in ("year < 1997", "year = 1996", "year >= 1997"):
        write_parts(profile_parts(orders.where(years), "o_orderkey", ["year"]), path, ["year"])
    merged = merge_parts(spark.read.parquet(path))
    exact = P.column_profile(orders.drop("year"), "o_orderkey").select("column", F.col("distinct").alias("exact"))
    return merged.join(exact, "column").select("column", "type", "rows", "missing", "example", F.col("exact").between(F.col("low"), F.col("high")).alias("within"))


@query("value_counts", f"""WITH {RAW} SELECT coalesce(market, '(missing)') AS value, count(*) AS "rows",
round(count(*) / (SELECT count(*) FROM raw), 6) AS share FROM raw GROUP BY market ORDER BY 2 DESC, 1 LIMIT 4""")
def _value_counts(spark, sf_dir):
    return rounded(P.value_counts(raw_records(spark, sf_dir), "market", 4))


# --- histograms: the SQL repeats the edge rules from summary numbers ---------------------------


def bins_sql(values: str, bins: int, offset: int = 0) -> str:
    """CTEs from a ``v(x)`` source: st (summary), e (edges), bars."""
    return f"""s0 AS (SELECT min(x) AS lo, max(x) AS top, {median_sql('x', 0.25)} AS q1, {median_sql('x')} AS md,
{median_sql('x', 0.75)} AS q3 FROM {values}), s1 AS (SELECT *, (SELECT max(x) FROM {values}, s0 z WHERE x <= z.q3 + 3 * (z.q3 - z.q1)) AS trimmed FROM s0),
s2 AS (SELECT lo, md, CASE WHEN q3 > q1 AND trimmed > lo AND trimmed < top THEN trimmed ELSE top END AS hi FROM s1),
s3 AS (SELECT *, lo >= 0 AND hi > 0 AND md > 0 AND hi / md > 20 AS lg, CASE WHEN lo = 0 THEN 1 ELSE 0 END AS sh FROM s2),
e AS (SELECT i, CASE WHEN i = 0 THEN lo WHEN i = {bins} THEN hi WHEN lg THEN pow(10, log10(lo + sh) + (log10(hi + sh) - log10(lo + sh)) / {bins} * i) - sh
ELSE lo + (hi - lo) / {bins} * i END AS edge FROM s3, range({bins + 1}) t(i)),
h AS (SELECT least({bins - 1}, (SELECT count(*) FROM e WHERE i BETWEEN 1 AND {bins - 1} AND x >= edge)) AS bar, count(*) AS n FROM {values} GROUP BY 1),
bars AS (SELECT CAST(a.i + {offset} AS INTEGER) AS bar, round(a.edge, 4) AS x0, round(b.edge, 4) AS x1,
{compact_sql('a.edge')} || ' – ' || {compact_sql('b.edge')} AS label, coalesce(n, 0) AS "rows" FROM e a JOIN e b ON b.i = a.i + 1 LEFT JOIN h ON h.bar = a.i)"""


@query("histogram", f"""WITH {RAW}, v AS (SELECT venture AS x FROM raw WHERE venture > 0), {bins_sql('v', 11, 1)},
z AS (SELECT count(*) FILTER (angel = 0) AS n, count(*) AS t FROM raw)
SELECT 'sparse' AS kind, 0 AS bar, 0.0::DOUBLE AS x0, 0.0::DOUBLE AS x1, '0 (none)' AS label, n AS "rows" FROM z
UNION ALL SELECT * FROM (WITH v2 AS (SELECT angel AS x FROM raw WHERE angel > 0), {bins_sql('v2', 11, 1)} SELECT 'sparse', * FROM bars)
UNION ALL SELECT 'integer', CAST(i AS INTEGER), CAST(i AS DOUBLE), CAST(i AS DOUBLE), CAST(i AS VARCHAR), (SELECT count(*) FROM raw WHERE funding_rounds = i)
FROM (SELECT unnest(range(min(funding_rounds), max(funding_rounds) + 1)) AS i FROM raw)
UNION ALL SELECT * FROM (WITH v3 AS (SELECT funding_total_usd AS x FROM raw), {bins_sql('v3', 12)} SELECT 'continuous', * FROM bars)""")
def _histogram(spark, sf_dir):
    df = raw_records(spark, sf_dir)
    kinds = {"sparse": "angel", "integer": "funding_rounds", "continuous": "funding_total_usd"}
    parts = [P.histogram(df, c).select(F.lit(k).alias("kind"), "*") for k, c in kinds.items()]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 4)


@query("histogram_bins", f"""WITH v AS (SELECT CASE WHEN event_type = 'error' THEN value * value * value ELSE value END AS x FROM events WHERE value IS NOT NULL),
{bins_sql('v', 12)} SELECT * FROM bars""")
def _histogram_bins(spark, sf_dir):
    v = F.col("value")
    x = F.when(F.col("event_type") == "error", v * v * v).otherwise(v)
    return rounded(P.histogram_bins(table(spark, sf_dir, "events").select(x.alias("x")), "x"), 4)


# --- group tables ------------------------------------------------------------------------------


@query("group_sizes", f'WITH {PREP} SELECT "Cluster", count(*) AS "rows", round(100.0 * count(*) / (SELECT count(*) FROM prep), 6) AS pct FROM prep GROUP BY 1')
def _group_sizes(spark, sf_dir):
    return rounded(G.group_sizes(labelled(spark, sf_dir), "Cluster"))


@query("group_median", f'WITH {PREP} SELECT "Cluster", feature, round(v, 4) AS median FROM ({long_sql(REAL, median_sql("{c}") + " AS v")})')
def _group_median(spark, sf_dir):
    return rounded(G.group_median(labelled(spark, sf_dir), "Cluster", REAL), 4)


@query("group_mean", f'WITH {PREP} SELECT "Cluster", feature, round(v, 4) AS mean FROM ({long_sql(REAL, "avg({c}) AS v")})')
def _group_mean(spark, sf_dir):
    return rounded(G.group_mean(labelled(spark, sf_dir), "Cluster", REAL), 4)


@query("group_nonzero_rate", f'WITH {PREP} SELECT "Cluster", feature, round(v, 6) AS nonzero_rate FROM ({long_sql(PROFILE_FEATURES, "count(*) FILTER ({c} > 0) / count(*) AS v")})')
def _group_nonzero_rate(spark, sf_dir):
    return rounded(G.group_nonzero_rate(labelled(spark, sf_dir), "Cluster", PROFILE_FEATURES))


_PARTS = ["early_stage_funding", "venture", "debt_financing", "private_equity"]
_SHARE = "CASE WHEN funding_total_usd > 0 THEN {c} / funding_total_usd ELSE 0 END"


@query("group_median_share", f'WITH {PREP} SELECT "Cluster", feature, round_even(v, 3) AS median FROM ({long_sql(_PARTS, median_sql(_SHARE) + " AS v")})')
def _group_median_share(spark, sf_dir):
    shares = G.group_median_share(labelled(spark, sf_dir), "Cluster", _PARTS, "funding_total_usd")
    return shares.withColumn("median", F.bround("median", 3))


_BOX = long_sql(REAL, f"{median_sql('{c}', .25)} AS q1, {median_sql('{c}')} AS md, {median_sql('{c}', .75)} AS q3, list(CAST({{c}} AS DOUBLE)) AS xs")


@query("group_boxplot", f"""WITH {PREP}, b AS ({_BOX}) SELECT "Cluster", feature,
round(list_min(list_filter(xs, lambda x: x >= q1 - 1.5 * (q3 - q1))), 4) AS whisker_low, round(q1, 4) AS q1, round(md, 4) AS median, round(q3, 4) AS q3,
round(list_max(list_filter(xs, lambda x: x <= q3 + 1.5 * (q3 - q1))), 4) AS whisker_high FROM b""")
def _group_boxplot(spark, sf_dir):
    return rounded(G.group_boxplot(labelled(spark, sf_dir), "Cluster", REAL), 4)


@query("crosstab_row_pct", f'WITH {PREP}, {_STATUS_PCT} SELECT * FROM st')
def _crosstab_row_pct(spark, sf_dir):
    pct = G.crosstab_row_pct(labelled(spark, sf_dir), "Cluster", "status", STATUSES)
    return pct.select("Cluster", *[F.bround(s, 2).alias(s) for s in STATUSES])


@query("top_values_by_group", f"""WITH {PREP}, c AS (SELECT "Cluster", country_code, count(*) AS n FROM prep GROUP BY ALL), r AS (SELECT *,
n / sum(n) OVER (PARTITION BY "Cluster") AS s, row_number() OVER (PARTITION BY "Cluster" ORDER BY n DESC, country_code) AS rank FROM c)
SELECT "Cluster", country_code, n AS "rows", round(100 * s, 6) AS pct, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def _top_values_by_group(spark, sf_dir):
    top = G.top_values_by_group(labelled(spark, sf_dir), "Cluster", "country_code")
    return rounded(top.select("Cluster", "country_code", "rows", (F.col("share") * 100).alias("pct"), "rank"))


_STATS = long_sql(PROFILE_FEATURES, _BASIC)


@query("group_profile", f"""WITH {PREP}, o AS (SELECT "Cluster" AS c, count(*) AS n, count(*) / (SELECT count(*) FROM prep) AS share FROM prep GROUP BY 1)
SELECT s."Cluster", 'Cluster ' || 'x' AS dummy, n AS "rows", round(share, 4) AS share, s.* EXCLUDE ("Cluster", pos) FROM ({_STATS}) s JOIN o ON o.c = s."Cluster" """
       .replace("'Cluster ' || 'x' AS dummy", "CASE s.\"Cluster\" WHEN '0' THEN 'Broad early-stage group' WHEN '1' THEN 'Debt-financed startups' "
                "WHEN '2' THEN 'Private equity profile' WHEN '3' THEN 'Venture-backed growth group' END AS name"))
def _group_profile(spark, sf_dir):
    return rounded(G.group_profile(labelled(spark, sf_dir), "Cluster", PROFILE_FEATURES), 4)


_CATS = ["status", "market", "country_code"]
_CATS_SQL = union_sql(_CATS, lambda i, c: f"SELECT \"Cluster\", '{c}' AS \"column\", coalesce({c}, '(missing)') AS value, count(*) AS n FROM prep GROUP BY ALL")


@query("group_top_categories", f"""WITH {PREP}, c AS ({_CATS_SQL}), r AS (SELECT *, n / sum(n) OVER (PARTITION BY "Cluster", "column") AS s,
row_number() OVER (PARTITION BY "Cluster", "column" ORDER BY n DESC, value) AS rank FROM c)
SELECT "Cluster", "column", value, n AS "rows", round(s, 6) AS share, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 4""")
def _group_top_categories(spark, sf_dir):
    return rounded(G.group_top_categories(labelled(spark, sf_dir), "Cluster"))


def _diff_sql(features: list[str], source: str = "prep", by: str = '"Cluster"') -> str:
    return (f"diff AS MATERIALIZED (SELECT {by}, l.pos, l.feature, m AS local_mean, g AS global_mean, sd, "
            f"CASE WHEN sd > 0 THEN (m - g) / sd ELSE 0 END AS score FROM ({long_sql(features, 'avg({c}) AS m', source, by)}) l "
            f"JOIN ({long_sql(features, 'avg({c}) AS g, stddev_pop({c}) AS sd', source, '')}) o ON l.feature = o.feature)")


_DISTINCT4 = """ranked AS (SELECT *, row_number() OVER (PARTITION BY "Cluster" ORDER BY round(abs(score), 9) DESC, pos) AS rank FROM diff)"""


@query("distinguishing_features", f"""WITH {PREP}, {_diff_sql(ALL_FEATURES)}, {_DISTINCT4} SELECT "Cluster", CAST(rank AS INTEGER) AS rank, feature,
round(score, 4) + 0.0 AS score, CASE WHEN score >= 0 THEN 'higher' ELSE 'lower' END AS direction, round(local_mean, 4) AS local_mean,
round(global_mean, 4) AS global_mean FROM ranked WHERE rank <= 4""")
def _distinguishing_features(spark, sf_dir):
    return rounded(G.distinguishing_features(labelled(spark, sf_dir), "Cluster", ALL_FEATURES), 4)


_SEPARATION = """sep AS (SELECT feature, any_value(pos) AS pos, arg_min("Cluster", (round(local_mean, 9), "Cluster")) AS low_label, min(local_mean) AS low,
arg_max("Cluster", (round(local_mean, 9), "Cluster")) AS high_label, max(local_mean) AS high,
CASE WHEN any_value(sd) > 0 THEN (max(local_mean) - min(local_mean)) / any_value(sd) ELSE max(local_mean) - min(local_mean) END AS score FROM diff GROUP BY feature)"""


@query("feature_separation", f"""WITH {PREP}, {_diff_sql(ALL_FEATURES)}, {_SEPARATION} SELECT feature, low_label, round(low, 4) AS low,
high_label, round(high, 4) AS high, round(score, 4) AS score FROM sep""")
def _feature_separation(spark, sf_dir):
    return rounded(G.feature_separation(labelled(spark, sf_dir), "Cluster", ALL_FEATURES).drop("position"), 4)


@query("group_heatmap", f"""WITH {PREP}, {_diff_sql(MODEL_FEATURES)} SELECT "Cluster", feature, round(score, 4) + 0.0 AS score FROM diff""")
def _group_heatmap(spark, sf_dir):
    return rounded(G.group_heatmap(labelled(spark, sf_dir), "Cluster", MODEL_FEATURES), 4)


@query("largest_smallest_group", f"""WITH {PREP}, n AS (SELECT "Cluster" AS c, count(*) AS n FROM prep GROUP BY 1) SELECT
arg_min(c, (-n, c)) AS largest, max(n) AS largest_rows, arg_min(c, (n, c)) AS smallest, min(n) AS smallest_rows FROM n""")
def _largest_smallest_group(spark, sf_dir):
    return G.largest_smallest_group(labelled(spark, sf_dir), "Cluster")


_SCALED_LIFT = (f"SELECT l.\"Cluster\", l.feature, round(m - g, 4) + 0.0 AS lift FROM ({long_sql(MODEL_FEATURES, 'avg({c}) AS m', 'scaled')}) l "
                f"JOIN ({long_sql(MODEL_FEATURES, 'avg({c}) AS g', 'scaled', '')}) o ON l.feature = o.feature")


@query("feature_lift", f"WITH {PREP}, {FIT_SQL}, {SCALED_SQL} {_SCALED_LIFT}")
def _feature_lift(spark, sf_dir):
    scaled = robust_scale(labelled(spark, sf_dir), MODEL_FEATURES, ["record_id", "Cluster"])
    return rounded(G.feature_lift(scaled, "Cluster", MODEL_FEATURES), 4)


@query("market_lift", f"""WITH {PREP}, {_LIFT}, r AS (SELECT *, row_number() OVER (PARTITION BY "Cluster" ORDER BY round(lift, 9) DESC, market) AS rank
FROM lift WHERE "rows" >= 20) SELECT "Cluster", market, "rows", round(share, 6) AS share, round(base_share, 6) AS base_share, round(lift, 6) AS lift,
CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def _market_lift(spark, sf_dir):
    return rounded(G.market_lift(labelled(spark, sf_dir), "Cluster", "market"))


@query("funding_composition", f'WITH {PREP} SELECT "Cluster", feature, round(100 * v, 6) AS pct FROM ({long_sql(RATIOS, "avg({c}) AS v")})')
def _funding_composition(spark, sf_dir):
    return rounded(G.funding_composition(labelled(spark, sf_dir), "Cluster", RATIOS))


@query("segment_summary", f"""WITH {SEG} SELECT "SubCluster", count(*) AS "rows", round(100.0 * count(*) FILTER (venture > 0) / count(*), 6) AS pct_with_venture,
round(100.0 * count(*) FILTER (early_stage_funding > 0) / count(*), 6) AS pct_with_early_stage, round({median_sql('funding_total_usd')}, 6) AS median_total_funding_usd,
round({median_sql('funding_rounds')}, 6) AS median_funding_rounds, round({median_sql('stage_level')}, 6) AS median_stage_level,
round({median_sql('early_stage_funding_ratio')}, 6) AS median_early_stage_ratio, round({median_sql('venture_ratio')}, 6) AS median_venture_ratio,
round(100.0 * count(*) / (SELECT count(*) FROM seg), 6) AS pct_of_segment FROM seg GROUP BY "SubCluster" """)
def _segment_summary(spark, sf_dir):
    return rounded(segment_summary(segment_records(spark, sf_dir), "SubCluster"))


_NAMES_SQL = label_values(REPORT_NAMES)


@query("cluster_report", f"""WITH {PREP}, {_SIZES}, {_STATUS_PCT} SELECT n.name, sizes.*, operating, acquired, closed FROM sizes
LEFT JOIN st ON sizes."Cluster" = st."Cluster" LEFT JOIN {_NAMES_SQL} n(label, name) ON n.label = sizes."Cluster" """)
def _cluster_report(spark, sf_dir):
    return R.cluster_report(labelled(spark, sf_dir), "Cluster", REAL, STATUSES)


@query("comparison_table", f"""WITH {PREP} SELECT "Cluster", count(*) AS "rows", round(count(*) / (SELECT count(*) FROM prep), 6) AS share, """
       + ", ".join(f"round({median_sql(c)}, 6) AS {c}" for c in R.COMPARISON_FEATURES) + ' FROM prep GROUP BY "Cluster"')
def _comparison_table(spark, sf_dir):
    return rounded(R.comparison_table(labelled(spark, sf_dir), "Cluster"))


_SUB_NAME = "CASE \"SubCluster\" WHEN 1 THEN 'venture side' WHEN 0 THEN 'multi-round' ELSE 'seed' END"


@query("subgroup_model", f"""WITH {SEG}, g AS (SELECT *, {_SUB_NAME} AS subgroup FROM seg), o AS (SELECT subgroup AS k, count(*) AS n FROM g GROUP BY 1)
SELECT s.* EXCLUDE (pos), n AS "rows", round(n / (SELECT count(*) FROM g), 4) AS share, round((SELECT count(*) FROM g) / (SELECT count(*) FROM prep), 4) AS share_of_whole
FROM ({long_sql(SUB_FEATURES, _BASIC, 'g', 'subgroup')}) s JOIN o ON o.k = s.subgroup""")
def _subgroup_model(spark, sf_dir):
    name = F.when(F.col("SubCluster") == 1, "venture side").when(F.col("SubCluster") == 0, "multi-round").otherwise("seed")
    whole = labelled(spark, sf_dir).agg(F.count(F.lit(1)).alias("n")).scalar()
    df = segment_records(spark, sf_dir).withColumn("SubCluster_Name", name)
    return rounded(subgroup_model(df, whole, SUB_FEATURES), 4)


# Status in five classes: records without a category are unknown, one priority counts as other.
_FIVE_STATUS = "CASE WHEN category_list IS NULL THEN 'unknown' WHEN category_list = '5-LOW' THEN 'other' ELSE status END"


def _with_status(spark, sf_dir):
    kind = F.col("category_list")
    return labelled(spark, sf_dir).withColumn(
        "status", F.when(kind.isNull(), " ").when(kind == "5-LOW", "ipo").otherwise(F.col("status")))


_ST = ("t AS (SELECT \"Cluster\", count(*) AS \"rows\", " + ", ".join(f"count(*) FILTER (s = '{s}') AS {s}" for s in STATUS_CLASSES) + ", "
       + ", ".join(f"count(*) FILTER (s = '{s}') / count(*) AS {s}_rate" for s in STATUS_CLASSES)
       + f" FROM (SELECT *, {_FIVE_STATUS} AS s FROM prep) GROUP BY \"Cluster\")")


@query("status_by_group", f"WITH {PREP}, {_ST} SELECT \"Cluster\", \"rows\", " + ", ".join(STATUS_CLASSES) + ", "
       + ", ".join(f"round({s}_rate, 6) AS {s}_rate" for s in STATUS_CLASSES) + " FROM t")
def _status_by_group(spark, sf_dir):
    return rounded(G.status_by_group(_with_status(spark, sf_dir), "Cluster"))


@query("status_totals", f"WITH {PREP}, {_ST} " + union_sql(STATUS_CLASSES, lambda i, s: f"SELECT '{s}' AS class, CAST(sum({s}) AS BIGINT) AS \"rows\" FROM t"))
def _status_totals(spark, sf_dir):
    return G.status_totals(G.status_by_group(_with_status(spark, sf_dir), "Cluster"))


_EXTREMES = """ex AS (SELECT arg_min("Cluster", (-acquired_rate, "Cluster")) AS ha, max(acquired_rate) AS har, arg_min("Cluster", (-closed_rate, "Cluster")) AS hc,
max(closed_rate) AS hcr, arg_min("Cluster", (closed_rate, "Cluster")) AS lc, min(closed_rate) AS lcr FROM t)"""


@query("status_extremes", f"""WITH {PREP}, {_ST}, {_EXTREMES} SELECT ha AS highest_acquired, round(har, 6) AS highest_acquired_rate, hc AS highest_closed,
round(hcr, 6) AS highest_closed_rate, lc AS lowest_closed, round(lcr, 6) AS lowest_closed_rate FROM ex""")
def _status_extremes(spark, sf_dir):
    return rounded(G.status_extremes(G.status_by_group(_with_status(spark, sf_dir), "Cluster"), "Cluster"))


def _said(rule: str) -> str:
    return fill_sql(STATUS_READINGS[rule], **{c: percent_sql(f"{c}_rate") for c in ("acquired", "closed", "operating", "unknown")})


@query("status_reading", f"""WITH {PREP}, {_ST}, {_EXTREMES} SELECT "Cluster", CASE
WHEN "Cluster" = ha AND acquired_rate > 0 THEN {_said('exits')} WHEN "Cluster" = hc AND closed_rate > 0 THEN {_said('closures')}
WHEN "Cluster" = lc AND closed_rate < 0.03 THEN {_said('stable')} WHEN operating_rate >= 0.85 THEN {_said('active')}
WHEN unknown_rate >= 0.08 THEN {_said('unknown')} ELSE {_said('mixed')} END AS reading FROM t, ex
UNION ALL SELECT NULL, {fill_sql(STATUS_READINGS['overall'], acquired_label='ha', acquired=percent_sql('har'), closed_label='hc', closed=percent_sql('hcr'))} FROM ex""")
def _status_reading(spark, sf_dir):
    return G.status_reading(_with_status(spark, sf_dir), "Cluster")


# Pairwise gaps: one column with missing values, one constant.
_CORR_COLUMNS = ["funding_total_usd", "funding_rounds", "venture", "private_equity", "stage_level", "gappy", "constant"]


def _corr_source(spark, sf_dir):
    return labelled(spark, sf_dir).withColumns({
        "gappy": F.when(F.col("category_list").isNotNull(), F.col("debt_financing")), "constant": F.lit(1.0)})


_CORR_SQL = "corrs AS (" + " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, '{a}' AS x, '{b}' AS y, "
    + ("CAST(NULL AS DOUBLE)" if "constant" in (a, b) else "CAST(1 AS DOUBLE)" if a == b else f"corr({a}, {b})") + " AS v FROM src"
    + (" GROUP BY ()" if a == b or "constant" in (a, b) else "")
    for i, a in enumerate(_CORR_COLUMNS) for j, b in enumerate(_CORR_COLUMNS)) + ")"
_CORR_SRC = "src AS (SELECT *, CASE WHEN category_list IS NOT NULL THEN debt_financing END AS gappy, CAST(1 AS DOUBLE) AS constant FROM prep)"


@query("correlation_matrix", f"WITH {PREP}, {_CORR_SRC}, {_CORR_SQL} SELECT x, y, round(v, 6) + 0.0 AS value FROM corrs")
def _correlation_matrix(spark, sf_dir):
    return rounded(P.correlation_matrix(_corr_source(spark, sf_dir), _CORR_COLUMNS).select("x", "y", "value"))


@query("strongest_correlation", f"WITH {PREP}, {_CORR_SRC}, {_CORR_SQL} SELECT x, y, round(v, 6) AS value FROM corrs WHERE i < j AND v IS NOT NULL "
       "ORDER BY abs(v) DESC, i, j LIMIT 1")
def _strongest_correlation(spark, sf_dir):
    return rounded(P.strongest_pair(P.correlation_matrix(_corr_source(spark, sf_dir), _CORR_COLUMNS)))


@query("unique_labels", f"""WITH {RAW} SELECT DISTINCT coalesce(market, CAST(funding_rounds AS VARCHAR)) AS label FROM raw""")
def _unique_labels(spark, sf_dir):
    df = raw_records(spark, sf_dir).select(F.coalesce("market", F.col("funding_rounds").cast("string")).alias("v"))
    return P.unique_labels(df, "v")


# --- findings and texts --------------------------------------------------------------------------


def _label_case(x: str) -> str:
    names = {"funding_total_usd": "Total funding", "funding_rounds": "Funding rounds", "early_stage_funding": "Early-stage funding",
             "venture": "Venture funding", "debt_financing": "Debt financing", "private_equity": "Private equity", "stage_level": "Stage level",
             "early_stage_funding_ratio": "Early-stage share", "venture_ratio": "Venture share", "debt_financing_ratio": "Debt share",
             "private_equity_ratio": "Private equity share", "log_funding_total_usd": "Log total funding", "log_funding_rounds": "Log funding rounds",
             "log_early_stage_funding": "Log early-stage funding", "log_venture": "Log venture funding", "log_debt_financing": "Log debt financing",
             "log_private_equity": "Log private equity", "category_list": "Category List"}
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + f" ELSE {x} END"


_CORR8 = "corrs AS (" + " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS v FROM prep"
    for i, a in enumerate(PROFILE_FEATURES[:8]) for j, b in enumerate(PROFILE_FEATURES[:8]) if i < j) + ")"



def _finding_sql(rule: str, source: str, label: str, feature: str, /, **slots: str) -> str:
    told = FINDINGS[rule]
    return (f"SELECT {told.rank} AS rank, '{told.kicker}' AS kicker, {fill_sql(told.title, **slots)} AS title, '{told.tone}' AS tone, "
            f"{fill_sql(told.body, **slots)} AS body, CAST({label} AS VARCHAR) AS label, CAST({feature} AS VARCHAR) AS feature FROM {source}")


_INSIGHTS = f"""WITH {PREP}, {_diff_sql(ALL_FEATURES)}, {_DISTINCT4}, {_SEPARATION}, {_CORR8},
n AS (SELECT "Cluster", count(*) AS n, count(*) / (SELECT count(*) FROM prep) AS share FROM prep GROUP BY 1),
d AS (SELECT n.*, feature, CASE WHEN score >= 0 THEN 'higher' ELSE 'lower' END AS direction FROM n JOIN ranked r ON r."Cluster" = n."Cluster" AND rank = 1),
big AS (SELECT * FROM d ORDER BY n DESC, "Cluster" LIMIT 1), small AS (SELECT * FROM d ORDER BY n, "Cluster" LIMIT 1),
wide AS (SELECT * FROM sep ORDER BY round(abs(score), 9) DESC, pos LIMIT 1),
miss AS (SELECT count(*) - count(category_list) AS m, (count(*) - count(category_list)) / count(*) AS u FROM prep),
pair AS (SELECT * FROM corrs ORDER BY abs(v) DESC, i, j LIMIT 1),
med AS ({long_sql(R.MIX_FEATURES, median_sql('{c}') + ' AS v')}),
mr AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY v DESC, "Cluster") AS r FROM med),
mix AS (SELECT a."Cluster", a.feature FROM mr a LEFT JOIN mr b ON b.feature = a.feature AND b.r = 2 WHERE a.r = 1 AND a.v > 0
ORDER BY round(a.v - coalesce(b.v, 0), 9) DESC, a.pos LIMIT 1),
top AS (SELECT name, funding_total_usd AS x FROM prep ORDER BY funding_total_usd DESC, record_id LIMIT 1)
""" + " UNION ALL ".join([
    _finding_sql("largest", "big", '"Cluster"', "feature", label='"Cluster"', rows=number_sql("n"), share=percent_sql("share"), feature=_label_case("feature"), direction="direction"),
    _finding_sql("smallest", "small", '"Cluster"', "feature", label='"Cluster"', rows=number_sql("n"), feature=_label_case("feature")),
    _finding_sql("widest", "wide", "NULL", "feature", feature=_label_case("feature"), low="low_label", high="high_label"),
    _finding_sql("missing", "miss WHERE m > 0", "NULL", "'category_list'", column="'Category List'", share=percent_sql("u")),
    _finding_sql("pair", "pair", "NULL", "x", x=_label_case("x"), y=_label_case("y"), value=number_sql("v", 2)),
    _finding_sql("mix", "mix", '"Cluster"', "feature", label='"Cluster"', feature=_label_case("feature")),
    _finding_sql("largest_value", "top", "NULL", "'funding_total_usd'", name="name", total=money_sql("x"))])


@query("insights", _INSIGHTS)
def _insights(spark, sf_dir):
    return R.insights(labelled(spark, sf_dir), "Cluster", ALL_FEATURES, PROFILE_FEATURES, "record_id")


@query("group_text", f"""WITH {SEG}, g AS (SELECT DISTINCT {_SUB_NAME} AS label FROM seg), m AS (SELECT {_SUB_NAME} AS label, {median_sql('funding_total_usd')} AS md FROM seg GROUP BY 1)
SELECT label, CASE WHEN label LIKE '%venture%' THEN 'VC-backed companies that are still smaller or earlier than the main venture-growth cluster.'
WHEN label LIKE '%multi%' THEN 'Early-stage companies with more rounds, suggesting more traction than the simplest seed-stage profile.'
ELSE 'Small, usually one-round companies dominated by seed, angel, or grant-style funding.' END AS text FROM g
UNION ALL SELECT 'funding', {fill_sql(TAKEAWAY, top='h.label', top_value=money_sql('h.md'), bottom='l.label', bottom_value=money_sql('l.md'))}
FROM (SELECT * FROM m ORDER BY md DESC, label LIMIT 1) h, (SELECT * FROM m ORDER BY md, label DESC LIMIT 1) l
UNION ALL SELECT DISTINCT "Cluster", CASE "Cluster" WHEN '0' THEN 'The largest and most early-stage-heavy group: low median funding, usually one round, and mostly early-stage funding.'
WHEN '1' THEN 'A mixed financing group where debt financing is much more relevant, usually alongside venture funding.'
WHEN '2' THEN 'A small, capital-intensive group dominated by private equity and much higher median funding.'
WHEN '3' THEN 'The clearer venture-backed growth group, with higher stage level and venture funding dominating the funding mix.' END FROM prep""")
def _group_text(spark, sf_dir):
    name = F.when(F.col("SubCluster") == 1, "venture side").when(F.col("SubCluster") == 0, "multi-round").otherwise("seed")
    seg = segment_records(spark, sf_dir).select("funding_total_usd", name.alias("label"))
    none = F.lit(None).cast("string")
    subs = seg.select("label").distinct().select("label", subgroup_text("label", none).alias("text"))
    takeaway = G.funding_takeaway(seg, "label").select(F.lit("funding").alias("label"), F.col("takeaway").alias("text"))
    mains = labelled(spark, sf_dir).select(F.col("Cluster").alias("label")).distinct().select("label", group_text("label", none).alias("text"))
    return subs.unionByName(takeaway).unionByName(mains)


# --- windows -----------------------------------------------------------------------------------


@query("share_of_total", f"""WITH {PREP} SELECT "Cluster", market, n AS "rows", round(n / sum(n) OVER (PARTITION BY "Cluster"), 6) AS share
FROM (SELECT "Cluster", market, count(*) AS n FROM prep GROUP BY ALL)""")
def _share_of_total(spark, sf_dir):
    return rounded(G.share_of_total(labelled(spark, sf_dir), "Cluster", "market").drop("label_rows"))


@query("top_n_per_group", f"""WITH {PREP}, r AS (SELECT "Cluster", record_id, funding_total_usd, row_number() OVER (PARTITION BY "Cluster" ORDER BY funding_total_usd DESC, record_id) AS rank FROM prep)
SELECT "Cluster", record_id, funding_total_usd, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def _top_n_per_group(spark, sf_dir):
    df = labelled(spark, sf_dir).select("Cluster", "record_id", "funding_total_usd")
    return G.top_n_per_group(df, ["Cluster"], [F.desc("funding_total_usd"), F.asc("record_id")], 3)


def midrank_sql(x: str, source: str) -> str:
    return (f"SELECT {x} AS value, CASE WHEN sum(count(*)) OVER () < 2 THEN 50 ELSE (sum(count(*)) OVER (ORDER BY {x}) - count(*) + count(*) * 0.5::DOUBLE) "
            f"/ sum(count(*)) OVER () * 100 END AS pct FROM {source} WHERE {x} IS NOT NULL GROUP BY {x}")


@query("midrank_percentile", f"""WITH {RAW}, v AS (SELECT record_id, CASE WHEN status <> 'closed' THEN venture END AS x FROM raw), t AS ({midrank_sql('x', 'v')})
SELECT record_id, round(pct, 6) AS pct FROM v LEFT JOIN t ON v.x = t.value""")
def _midrank_percentile(spark, sf_dir):
    df = raw_records(spark, sf_dir).select("record_id", F.when(F.col("status") != "closed", F.col("venture")).alias("x"))
    return rounded(midrank_percentile(df, "x", "pct").select("record_id", "pct"))


# The way taken on columns with many distinct values, forced by a small limit.
@query("midrank_percentile_ranked", f"""WITH {RAW}, v AS (SELECT record_id, CASE WHEN status <> 'closed' THEN venture END AS x FROM raw), t AS ({midrank_sql('x', 'v')})
SELECT record_id, round(pct, 6) AS pct FROM v LEFT JOIN t ON v.x = t.value""")
def _midrank_percentile_ranked(spark, sf_dir):
    df = raw_records(spark, sf_dir).select("record_id", F.when(F.col("status") != "closed", F.col("venture")).alias("x"))
    return rounded(midrank_percentile(df, "x", "pct", small=50).select("record_id", "pct"))


@query("date_percentile", f"""WITH t AS ({midrank_sql('o_orderdate', 'orders')}) SELECT o_orderkey, round(pct, 6) AS pct FROM orders LEFT JOIN t ON o_orderdate = t.value""")
def _date_percentile(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return rounded(date_percentile(df, "o_orderdate", "pct").select("o_orderkey", "pct"))


def frequency_sql(x: str, source: str) -> str:
    return f"k AS (SELECT {x} AS c, count(*) AS n FROM {source} WHERE {x} IS NOT NULL GROUP BY 1), f AS (SELECT c, pct FROM k JOIN ({midrank_sql('n', 'k')}) z ON z.value = k.n)"


@query("frequency_percentile", f"""WITH {frequency_sql('p_brand', 'part')} SELECT p_partkey, round(pct, 6) AS pct FROM part LEFT JOIN f ON f.c = p_brand""")
def _frequency_percentile(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return rounded(frequency_percentile(df, "p_brand", "pct").select("p_partkey", "pct"))


def _weighted(parts: list[tuple[str, float]]) -> str:
    return (f"floor(least(100, greatest(0, ({' + '.join(f'({x}) * {w}' for x, w in parts)}) / CAST({' + '.join(str(w) for _, w in parts)} AS DOUBLE))) + 0.5)")


_HOT = "CASE WHEN t > 85 AND r > 70 THEN 1 ELSE 0 END"
_STRESS = (f"floor((50 * 1.4 + pst * 1.5 + r * 1.3 + (100 - t) * 1.2 + d * 0.6 + ss * 1.2 + least(95, (t + r) / 2) * 0.7 * ({_HOT})) / "
           f"CAST(1.4 + 1.5 + 1.3 + 1.2 + 0.6 + 1.2 + 0.7 * ({_HOT}) AS DOUBLE) + 0.5)")
# The level column also fills the stage role by its name; its numbers give the neutral stage scores of 50.
_CARD = f"""WITH {PREP}, {frequency_sql('market', 'prep')}, mt AS ({midrank_sql('funding_total_usd', 'prep')}), mr AS ({midrank_sql('funding_rounds', 'prep')}),
ml AS ({midrank_sql('stage_level', 'prep')}), md AS ({midrank_sql('date', 'prep')}),
g AS (SELECT record_id, {spread_sql('mt.pct', 15, 95)} AS t, {spread_sql('mr.pct', 15, 95)} AS r, {spread_sql('ml.pct', 15, 95)} AS l, {spread_sql('md.pct', 25, 85)} AS d,
{spread_sql('f.pct', 35, 80)} AS m, CASE "Cluster" WHEN '1' THEN 'debt' WHEN '2' THEN 'equity' WHEN '3' THEN 'venture' ELSE 'early' END AS profile,
CASE status WHEN 'closed' THEN 5 WHEN 'acquired' THEN 94 ELSE 78 END AS sh, CASE status WHEN 'closed' THEN 20 WHEN 'acquired' THEN 82 ELSE 70 END AS sf,
CASE status WHEN 'closed' THEN 96 WHEN 'acquired' THEN 28 ELSE 42 END AS ss,
CASE "Cluster" WHEN '1' THEN 68 WHEN '2' THEN 88 WHEN '3' THEN 64 ELSE 24 END AS pc, CASE "Cluster" WHEN '1' THEN 42 WHEN '2' THEN 56 WHEN '3' THEN 82 ELSE 44 END AS pp,
CASE "Cluster" WHEN '1' THEN 82 WHEN '2' THEN 86 WHEN '3' THEN 50 ELSE 30 END AS pf, CASE "Cluster" WHEN '1' THEN 30 WHEN '2' THEN 28 WHEN '3' THEN 82 ELSE 86 END AS pst
FROM prep LEFT JOIN mt ON mt.value = funding_total_usd LEFT JOIN mr ON mr.value = funding_rounds LEFT JOIN ml ON ml.value = stage_level
LEFT JOIN md ON md.value = date LEFT JOIN f ON f.c = market),
v AS (SELECT record_id, profile, {_weighted([('sh', 3.0), ('l', 1.8), ('50', 1.3), ('t', 1.1), ('r', 0.5)])} AS health, {_weighted([('t', 5.0), ('l', 1.2), ('50', 1.0), ('pc', 1.3)])} AS cash,
{_weighted([('r', 2.4), ('t', 1.5), ('m', 1.0), ('d', 0.7), ('50', 0.8), ('pp', 0.7)])} AS popularity, {_weighted([('50', 2.0), ('sf', 1.0), ('pf', 1.8), ('l', 1.5)])} AS focus, {_STRESS} AS stress FROM g)
SELECT *, CASE WHEN stress >= 85 THEN 'Overwhelmed' WHEN health <= 25 THEN 'Fragile' WHEN cash <= 25 THEN 'Worried' WHEN popularity >= 75 AND stress >= 70
THEN 'Excited but tired' WHEN cash >= 75 AND stress <= 40 THEN 'Comfortable' WHEN focus >= 75 AND stress <= 35 THEN 'Calm'
WHEN health >= 75 AND popularity >= 70 THEN 'Confident' ELSE 'Doing okay' END AS mood FROM v"""


@query("row_scorecard", _CARD)
def _row_scorecard(spark, sf_dir):
    return R.row_scorecard(labelled(spark, sf_dir), "record_id")


# --- sorts, samples, reshaping --------------------------------------------------------------------


@query("top_outliers", f"WITH {PREP} SELECT record_id, name, funding_total_usd FROM prep ORDER BY funding_total_usd DESC, record_id LIMIT 8")
def _top_outliers(spark, sf_dir):
    return sampling.top_outliers(labelled(spark, sf_dir), "funding_total_usd", "record_id").select("record_id", "name", "funding_total_usd")


@query("multi_key_sort", f'WITH {PREP} SELECT "Cluster", market, count(*) AS "rows" FROM prep GROUP BY ALL ORDER BY 1, 3 DESC, 2')
def _multi_key_sort(spark, sf_dir):
    counted = labelled(spark, sf_dir).groupBy("Cluster", "market").agg(F.count(F.lit(1)).alias("rows"))
    return sampling.multi_key_sort(counted, [("Cluster", True), ("rows", False), ("market", True)])


@query("natural_key", "SELECT p_type, string_agg(label, ', ' ORDER BY p_size) AS labels FROM (SELECT DISTINCT p_type, p_size, 'size ' || p_size || ' of ' || p_type AS label FROM part) GROUP BY 1")
def _natural_key(spark, sf_dir):
    """The labels of each type in natural order: at most one for each size."""
    labels = table(spark, sf_dir, "part").select("p_type", F.concat(F.lit("size "), "p_size", F.lit(" of "), "p_type").alias("label")).distinct()
    ordered = F.sort_array(F.collect_list(F.struct(P.natural_key("label").alias("key"), "label")))
    return labels.groupBy("p_type").agg(F.array_join(F.transform(ordered, lambda x: x["label"]), ", ").alias("labels"))


@query("natural_sort", f"""WITH {RAW} SELECT CAST(funding_rounds AS VARCHAR) AS label, count(*) AS "rows" FROM raw GROUP BY 1""")
def _natural_sort(spark, sf_dir):
    counted = raw_records(spark, sf_dir).groupBy(F.col("funding_rounds").cast("string").alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    return sampling.natural_sort(counted, "label")


@query("random_sample", f"""WITH {PREP} SELECT record_id, "Cluster" FROM prep ORDER BY md5(record_id || ':42'), record_id LIMIT 12000""")
def _random_sample(spark, sf_dir):
    return sampling.random_sample(labelled(spark, sf_dir).select("record_id", "Cluster"), "record_id")


_STRATA = """sz AS (SELECT "Cluster" AS c, count(*) AS n, (SELECT count(*) FROM prep) AS total FROM prep GROUP BY 1),
pl AS (SELECT c, n, greatest(60, floor(n / total * 2200 + 0.5)) AS target FROM sz),
p2 AS (SELECT *, greatest(1, CAST(floor(n / target) AS BIGINT)) AS first FROM pl),
p3 AS (SELECT c, CASE WHEN sum(ceil(n / first)) OVER () <= 2200 THEN first
  ELSE CAST(ceil(n / greatest(1, floor(target * 2200 / sum(target) OVER ()))) AS BIGINT) END AS step FROM p2),
rn AS (SELECT *, row_number() OVER (PARTITION BY "Cluster" ORDER BY record_id) - 1 AS k FROM prep),
strata AS (SELECT rn.* FROM rn JOIN p3 ON p3.c = "Cluster" WHERE (SELECT count(*) FROM prep) <= 2200 OR k % step = 0)"""


@query("stratified_sample", f'WITH {PREP}, {_STRATA} SELECT record_id, "Cluster" FROM strata')
def _stratified_sample(spark, sf_dir):
    df = labelled(spark, sf_dir).select("record_id", "Cluster")
    return sampling.stratified_sample(df, "Cluster", "record_id")


@query("head_preview", f"WITH {PREP} SELECT record_id, venture, round(log_venture, 6) AS log_venture FROM prep ORDER BY record_id LIMIT 5")
def _head_preview(spark, sf_dir):
    return rounded(sampling.head_preview(labelled(spark, sf_dir), "record_id").select("record_id", "venture", "log_venture"))


@query("unpivot_profile", f'WITH {PREP} SELECT "Cluster", CASE feature ' + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in METRIC_LABELS.items())
       + f' END AS metric, round(v, 4) AS value FROM ({long_sql(list(METRIC_LABELS), median_sql("{c}") + " AS v")})')
def _unpivot_profile(spark, sf_dir):
    medians = G.group_median(labelled(spark, sf_dir), "Cluster", list(METRIC_LABELS))
    return rounded(G.unpivot_profile(G.widen(medians, "Cluster", list(METRIC_LABELS), "median"), "Cluster", METRIC_LABELS), 4)


@query("transpose_profile", f"WITH {PREP} SELECT feature, " + ", ".join(f"max(round(v, 4)) FILTER (\"Cluster\" = '{k}') AS \"{k}\"" for k in LABELS)
       + f" FROM ({long_sql(PROFILE_FEATURES, median_sql('{c}') + ' AS v')}) GROUP BY feature")
def _transpose_profile(spark, sf_dir):
    medians = G.group_median(labelled(spark, sf_dir), "Cluster", PROFILE_FEATURES)
    wide = G.widen(medians, "Cluster", PROFILE_FEATURES, "median")
    return rounded(transpose(unpivot(wide, ["Cluster"], PROFILE_FEATURES), "feature", "Cluster", "value", LABELS), 4)


@query("name_segments", f"""WITH {SEG}, m AS (SELECT "SubCluster", {median_sql('venture_ratio')} AS vr, {median_sql('funding_rounds')} AS fr, {median_sql('funding_total_usd')} AS ft FROM seg GROUP BY 1),
a AS (SELECT *, row_number() OVER (ORDER BY vr DESC, "SubCluster") = 1 AS iv FROM m), b AS (SELECT *, row_number() OVER (ORDER BY iv, fr DESC, ft DESC, "SubCluster") AS p FROM a)
SELECT "SubCluster", CASE WHEN iv THEN 'Small / early venture-backed' WHEN p = 1 THEN 'Early-stage multi-round' ELSE 'Small seed-stage' END AS name FROM b""")
def _name_segments(spark, sf_dir):
    return segment_names(segment_records(spark, sf_dir), "SubCluster")
