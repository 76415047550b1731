"""Sources, sinks and column-list operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import column_label, column_unit, column_unit_label, map_values, REPORT_NAMES
from tidemark.functions.values import (
    coerce_number,
    coerce_number_suffix,
    coerce_number_symbols,
    display_or,
    display_value,
    is_missing,
)
from tidemark.operators.cleaning import null_counts
from tidemark.operators.order import numbered_rows
from tidemark.operators.profiling import describe_numeric, value_counts
from tidemark.operators.scaling import robust_scale
from tidemark.operators.schema import (
    MODEL_FEATURES,
    PROFILE_FEATURES,
    choose_features,
    drop_columns,
    normalize_headers,
    numeric_columns,
    present_columns,
    preferred_columns,
    resolve_roles,
    select_numeric,
)
from tidemark.plans.catalog.registry import PREP, RAW, label_values, query, rounded, union_sql
from tidemark.plans.records import INFO, labelled_records, raw_records, table
from tidemark.session import scratch_path
from tidemark.sources.csv import scan_csv, scan_csv_lenient
from tidemark.sources.tables import Source, load_sources, rewrite_with_columns, write_csv, write_report_set, write_table


@query("scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _scan_csv(spark, sf_dir):
    path = write_csv(table(spark, sf_dir, "customer"), scratch_path(spark, "customer-csv"))
    text = scan_csv(spark, f"{path}-absent", path)
    return text.select(F.col("c_custkey").try_cast("long").alias("c_custkey"), "c_name",
                       F.col("c_nationkey").try_cast("int").alias("c_nationkey"),
                       coerce_number("c_acctbal").alias("c_acctbal"), "c_mktsegment")


@query("scan_csv_lenient", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
       CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS market,
       'first, ' || chr(10) || '"' || c_mktsegment || '"' AS note FROM customer""")
def _scan_csv_lenient(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    messy = customer.select(
        F.concat(F.lit("  "), F.col("c_custkey").cast("string")).alias("id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")).alias(" name "),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).otherwise("   ").alias("market"),
        F.concat(F.lit('first, \n"'), F.col("c_mktsegment"), F.lit('"')).alias("note"))
    path = scratch_path(spark, "messy-csv")
    messy.write.options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False,
                        ignoreTrailingWhiteSpace=False).csv(path)
    return scan_csv_lenient(spark, path)


@query("scan_csv_mixed_headers", """
SELECT c_custkey, c_name, CASE WHEN c_nationkey < 10 THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_nationkey >= 10 THEN c_mktsegment END AS c_mktsegment FROM customer""")
def _scan_csv_mixed_headers(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = write_csv(customer.where("c_nationkey < 10").select("c_custkey", "c_name", "c_acctbal"), scratch_path(spark, "mixed-csv"))
    customer.where("c_nationkey >= 10").select("c_mktsegment", "c_name", "c_custkey").write.mode("append").csv(path, header=True)
    text = scan_csv(spark, path)
    return text.select(F.col("c_custkey").try_cast("long").alias("c_custkey"), "c_name",
                       coerce_number("c_acctbal").alias("c_acctbal"), "c_mktsegment")


@query("scan_csv_line_ends", """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'one, ' || c_name || chr(10) || 'two "' || c_mktsegment || '"' AS note FROM customer""")
def _scan_csv_line_ends(spark, sf_dir):
    note = F.concat(F.lit("one, "), F.col("c_name"), F.lit("\n"), F.lit('two "'), F.col("c_mktsegment"), F.lit('"'))
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), note.alias("note"))
    path = scratch_path(spark, "line-ends-csv")
    customer.where("id % 2 = 0").write.csv(path, header=True, escape='"')
    customer.where("id % 2 = 1").select("note", "id").write.mode("append").csv(path, header=True, escape='"')
    return scan_csv(spark, path).select("id", "note")


@query("scan_csv_bad_records", """
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 5 <> 1 THEN c_name END AS name,
       CASE WHEN c_custkey % 5 = 0 THEN concat_ws(',', c_custkey, c_name, c_mktsegment) WHEN c_custkey % 5 = 1
       THEN CAST(c_custkey AS VARCHAR) END AS record FROM customer""")
def _scan_csv_bad_records(spark, sf_dir):
    key = F.col("c_custkey")
    line = F.when(key % 5 == 0, F.concat_ws(",", key, "c_name", "c_mktsegment")).when(key % 5 == 1, key.cast("string")).otherwise(
        F.concat_ws(",", key, "c_name"))
    path = scratch_path(spark, "bad-records-csv")
    table(spark, sf_dir, "customer").select(line.alias("id,name")).write.csv(path, header=True, sep="|")
    return scan_csv(spark, path, record="record")


@query("normalize_headers", """
SELECT c_custkey, c_name AS "Column 2", c_nationkey AS "value", c_acctbal AS "value_2", c_mktsegment AS "value_3"
FROM customer""")
def _normalize_headers(spark, sf_dir):
    return normalize_headers(table(spark, sf_dir, "customer").toDF(" c_custkey ", "", "value", " value", "value "))


@query("load_sources", """
SELECT 'customer' AS id, true AS required, true AS loaded, (SELECT count(*) FROM customer) AS n_rows
UNION ALL SELECT 'labels', false, true, (SELECT count(*) FROM labels)
UNION ALL SELECT 'absent', false, false, NULL""")
def _load_sources(spark, sf_dir):
    tables, outcome = load_sources(spark, [
        Source("customer", f"{sf_dir}/customer.parquet", True, "parquet"),
        Source("labels", f"{sf_dir}/labels.parquet", False, "parquet"),
        Source("absent", f"{sf_dir}/absent.csv")])
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("id"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return outcome.join(counts, "id", "left").select("id", "required", F.col("error").isNull().alias("loaded"), "n_rows")


@query("write_csv", f"""WITH {PREP} SELECT record_id, name, market, funding_total_usd, "Cluster" FROM prep""")
def _write_csv(spark, sf_dir):
    df = labelled_records(spark, sf_dir).select("record_id", "name", "market", "funding_total_usd", "Cluster")
    path = write_csv(df, scratch_path(spark, "labelled-csv"))
    return spark.read.schema(df.schema).csv(path, header=True)


@query("rewrite_with_columns", """
SELECT o_orderkey, o_totalprice, o_totalprice > 250000 AS is_large FROM orders""")
def _rewrite_with_columns(spark, sf_dir):
    path = write_table(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
                       scratch_path(spark, "orders"))
    wider = spark.read.parquet(path).withColumn("is_large", F.col("o_totalprice") > 250000)
    rewrite_with_columns(wider, path, scratch_path(spark, "orders-staging"))
    return spark.read.parquet(path)


@query("write_report_set", f"""WITH {PREP}
SELECT 'market_by/size' AS report, market AS value, count(*) AS n FROM prep GROUP BY market
UNION ALL SELECT 'status counts of every prepared record', status, count(*) FROM prep GROUP BY status""")
def _write_report_set(spark, sf_dir):
    df = labelled_records(spark, sf_dir)
    reports = {"market_by/size": value_counts(df, "market", None),
               "status counts of every prepared record": value_counts(df, "status", None)}
    paths = write_report_set(reports, scratch_path(spark, "reports"))
    result = None
    for name, path in paths.items():
        one = spark.read.schema("value string, n long, share double").csv(path, header=True).select(
            F.lit(name).alias("report"), "value", "n")
        result = one if result is None else result.unionByName(one)
    return result


@query("row_number_key", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_number FROM orders""")
def _row_number_key(spark, sf_dir):
    return numbered_rows(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


# --- projections and column lists ------------------------------------------------------------


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def _drop_columns(spark, sf_dir):
    return drop_columns(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderdate", "permalink"])


@query("select_numeric", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def _select_numeric(spark, sf_dir):
    return select_numeric(table(spark, sf_dir, "customer"))


@query("present_columns", "SELECT c_mktsegment, c_custkey FROM customer")
def _present_columns(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    return df.select(*present_columns(df.columns, ["c_mktsegment", "city", "c_custkey"]))


def _stats_sql(columns: list[str], source: str) -> str:
    return union_sql(columns, lambda i, c: (
        f"SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, "
        f"round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median FROM {source}"))


@query("choose_features", f"WITH {PREP}, fallback AS (SELECT funding_total_usd AS a, venture AS b, debt_financing AS c "
       f"FROM prep) SELECT 'model' AS choice, * FROM ({_stats_sql(MODEL_FEATURES, 'prep')}) UNION ALL "
       f"SELECT 'readable', * FROM ({_stats_sql(PROFILE_FEATURES, 'prep')}) UNION ALL "
       f"SELECT 'fallback', * FROM ({_stats_sql(['a', 'b', 'c'], 'fallback')})")
def _choose_features(spark, sf_dir):
    df = labelled_records(spark, sf_dir)
    other = df.select(F.col("funding_total_usd").alias("a"), F.col("venture").alias("b"),
                      F.col("debt_financing").alias("c"), F.lit(1).alias("cluster"))
    numeric = numeric_columns(df)
    choices = [("model", df, choose_features(numeric)), ("readable", df, choose_features(numeric, PROFILE_FEATURES, 8)),
               ("fallback", other, choose_features(numeric_columns(other)))]
    result = None
    for name, source, features in choices:
        one = describe_numeric(source, features).select(F.lit(name).alias("choice"), "feature", "count", "mean", "median")
        result = one if result is None else result.unionByName(one)
    return rounded(result)


@query("preferred_columns", f"WITH {PREP} SELECT country_code, market FROM prep")
def _preferred_columns(spark, sf_dir):
    df = labelled_records(spark, sf_dir)
    return df.select(*preferred_columns(df.columns, ["country_code", "market", "state_code"]))


@query("resolve_roles", f"""WITH {PREP} SELECT record_id, name, market, country_code AS country, date, status,
stage_level AS "level", stage_level AS stage, funding_rounds AS rounds, funding_total_usd AS total, "Cluster" AS profile FROM prep""")
def _resolve_roles(spark, sf_dir):
    df = labelled_records(spark, sf_dir)
    roles = {role: c for role, c in resolve_roles(df.columns, "Cluster").items() if c}
    return df.select("record_id", *[F.col(c).alias(role) for role, c in roles.items()])


@query("coerce_number", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total FROM orders""")
def _coerce_number(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", " -   ").otherwise(
        F.concat(F.lit(" "), F.format_number("o_totalprice", 2), F.lit(" ")))
    return table(spark, sf_dir, "orders").select("o_orderkey", coerce_number(text).alias("total"))


@query("coerce_number_symbols", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN o_totalprice WHEN 'F' THEN -o_totalprice END AS total FROM orders""")
def _coerce_number_symbols(spark, sf_dir):
    amount = F.format_number("o_totalprice", 2)
    text = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("$"), amount)).when(
        F.col("o_orderstatus") == "F", F.concat(F.lit("-$"), amount, F.lit("%"))).otherwise("NaN")
    return table(spark, sf_dir, "orders").select("o_orderkey", coerce_number_symbols(text).alias("total"))


@query("coerce_number_suffix", """
SELECT o_orderkey, round(CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice * 1000 WHEN '2-HIGH' THEN o_totalprice * 1e6
WHEN '3-MEDIUM' THEN o_totalprice * 1e9 WHEN '5-LOW' THEN o_totalprice END, 2) AS total FROM orders""")
def _coerce_number_suffix(spark, sf_dir):
    amount = F.format_number("o_totalprice", 2)
    kind = F.col("o_orderpriority")
    text = (
        F.when(kind == "1-URGENT", F.concat(F.lit("$"), amount, F.lit("K")))
        .when(kind == "2-HIGH", F.concat(F.lit("€ "), amount, F.lit(" million")))
        .when(kind == "3-MEDIUM", F.concat(amount, F.lit(" Billion USD")))
        .when(kind == "5-LOW", F.concat(amount, F.lit(" percent")))
        .otherwise("n/a"))
    return rounded(table(spark, sf_dir, "orders").select("o_orderkey", coerce_number_suffix(text).alias("total")), 2)


@query("is_missing", f"""WITH {RAW} SELECT record_id, market IS NULL AS market_missing,
category_list IS NULL OR category_list = '5-LOW' AS category_missing FROM raw""")
def _is_missing(spark, sf_dir):
    blanked = F.when(F.col("category_list") == "5-LOW", " \t").otherwise(F.col("category_list"))
    return raw_records(spark, sf_dir).select(
        "record_id", is_missing("market").alias("market_missing"), is_missing(blanked).alias("category_missing"))


@query("display_value", f"""WITH {RAW} SELECT record_id, coalesce(market, '(missing)') AS market,
coalesce(category_list, 'none given') AS category_list FROM raw""")
def _display_value(spark, sf_dir):
    return raw_records(spark, sf_dir).select("record_id", display_value("market").alias("market"),
                                             display_or("category_list", "none given").alias("category_list"))


@query("cast_category", f"WITH {RAW} SELECT record_id, status FROM raw")
def _cast_category(spark, sf_dir):
    return raw_records(spark, sf_dir).select("record_id", F.col("status").cast("string").alias("status"))


_QUARTILES = union_sql(MODEL_FEATURES, lambda i, c: (
    f"SELECT '{c}' AS feature, quantile_cont({c}::DOUBLE, 0.5) AS center, "
    f"quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25) AS iqr FROM prep"))
FIT_SQL = (f"fit AS MATERIALIZED (SELECT feature, center, CASE WHEN iqr = 0 THEN 1.0::DOUBLE ELSE iqr END AS scale "
           f"FROM ({_QUARTILES}))")
SCALED_SQL = "scaled AS MATERIALIZED (SELECT record_id, name, category_list, market, status, country_code, city, " \
    '"Cluster", ' + ", ".join(
        f"({c} - (SELECT center FROM fit WHERE feature = '{c}')) / (SELECT scale FROM fit WHERE feature = '{c}') AS {c}"
        for c in MODEL_FEATURES) + " FROM prep)"


@query("attach_info_columns", f"WITH {PREP}, {FIT_SQL}, {SCALED_SQL} SELECT record_id, " + ", ".join(INFO) + ", "
       + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in MODEL_FEATURES) + " FROM scaled")
def _attach_info_columns(spark, sf_dir):
    return rounded(robust_scale(labelled_records(spark, sf_dir), MODEL_FEATURES, ["record_id", *INFO]))


@query("map_labels", f"""WITH {PREP} SELECT record_id, "Cluster", n.name AS cluster_name FROM prep
LEFT JOIN {label_values(REPORT_NAMES)} n(label, name) ON label = "Cluster" """)
def _map_labels(spark, sf_dir):
    return labelled_records(spark, sf_dir).select("record_id", "Cluster",
                                                  map_values("Cluster", REPORT_NAMES).alias("cluster_name"))


_LABELS = [
    ("record_id", "Record Id", ""), ("name", "Name", ""), ("category_list", "Category List", ""),
    ("market", "Market", ""), ("status", "Status", ""), ("country_code", "Country", ""), ("region", "Region", ""),
    ("city", "City", ""), ("date", "Date", ""), ("funding_total_usd", "Total funding", "USD"),
    ("funding_rounds", "Funding rounds", "count"), ("seed", "Seed", ""), ("venture", "Venture funding", "USD"),
    ("debt_financing", "Debt financing", "USD"), ("angel", "Angel", ""), ("grant", "Grant", ""),
    ("private_equity", "Private equity", "USD"), ("sparse_a", "Sparse A", ""),
    *[(f"round_{x}", f"Round {x}", "") for x in "ABCDEFGH"],
]
_LABEL_SQL = union_sql(_LABELS, lambda i, c: (
    f"SELECT '{c[0]}' AS \"column\", '{c[1]}' AS label, '{c[2]}' AS unit, "
    f"CASE '{c[2]}' WHEN '' THEN '' ELSE '({c[2]})' END AS unit_label, count(*) - count(\"{c[0]}\") AS nulls FROM raw"))


@query("column_labels", f"WITH {RAW} {_LABEL_SQL}")
def _column_labels(spark, sf_dir):
    return null_counts(raw_records(spark, sf_dir)).select(
        "column", column_label("column").alias("label"), column_unit("column").alias("unit"),
        column_unit_label("column").alias("unit_label"), "nulls")
