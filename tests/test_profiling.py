"""Profiles, histograms, correlation, cleaning on small tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning as C
from tidemark.operators import profiling as P
from tidemark.operators import sketches as S
from tidemark.operators.schema import choose_features, find_column, resolve_roles, unique_headers


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(1, "a", "1,000", "2020-01", None, 0.0), (2, "b", "x", "2020-02-01", None, 0.0), (3, "c", "3%", "", None, 0.0),
            (4, "d", "$4", "2021-05", None, 0.0), (5, "e", "5", "2021-06", None, 0.0), (6, "f", "6", None, None, 0.0),
            (7, "g", "7", "2021-06", None, 0.0), (8, " ", "8", "2021-06", None, 0.0)]
    return spark.createDataFrame(rows, "id long, name string, amount string, day string, empty string, zero double")


def test_column_profile(mixed):
    rows = {r["column"]: r for r in P.column_profile(mixed, "id").collect()}
    assert {c: r["type"] for c, r in rows.items()} == {
        "name": "category", "amount": "number", "day": "date", "empty": "category", "zero": "number"}
    assert (rows["name"]["missing"], rows["name"]["distinct"], rows["name"]["example"]) == (1, 7, "a")
    assert (rows["empty"]["missing"], rows["empty"]["distinct"], rows["empty"]["example"]) == (8, 0, None)
    assert rows["day"]["missing_rate"] == 0.25
    approximate = {r["column"]: r for r in P.column_profile(mixed, "id", exact=False).collect()}
    assert approximate == rows


def test_warnings(spark, mixed):
    texts = {r["kind"]: r["text"] for r in S.profile_warnings(mixed, "id").collect()}
    assert texts == {"missing": "2 columns have at least 20% missing values, led by day.",
                     "identifier": "name behaves like an identifier rather than a grouping feature."}
    # A table without rows has no (column, value) pairs to look at.
    assert [r["kind"] for r in S.profile_warnings(mixed.limit(0), "id").collect()] == ["empty"]


def test_missing_top(mixed):
    assert [(r["column"], r["missing"]) for r in P.missing_top(mixed).collect()] == [("empty", 8), ("day", 2), ("name", 1)]


def bars(df):
    return [(r["label"], r["rows"]) for r in df.orderBy("bar").collect()]


def numbers(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def test_histogram_small_integers_keep_gaps(spark):
    assert bars(P.histogram(numbers(spark, [1, 1, 4, 2]), "x")) == [("1", 2), ("2", 1), ("3", 0), ("4", 1)]


def test_histogram_constant_and_empty(spark):
    assert bars(P.histogram(numbers(spark, [5.5, 5.5]), "x")) == [("5.5", 2)]
    assert bars(P.histogram(numbers(spark, [float("nan")]), "x")) == []


def test_histogram_zero_bar_stands_beside_all_other_values(spark):
    values = [0] * 40 + [i * 100.5 for i in range(1, 51)] + [-5.5]
    got = bars(P.histogram(numbers(spark, values), "x"))
    assert got[0] == ("0 (none)", 40) and len(got) == 12 and sum(n for _, n in got) == 91


def test_histogram_fence_and_log_edges(spark):
    values = [float(i) for i in range(1, 101)] + [10_000.0]
    rows = P.histogram_bins(numbers(spark, values), "x").orderBy("bar").collect()
    assert rows[-1]["x1"] == 100.0 and sum(r["rows"] for r in rows) == 101
    assert rows[-1]["rows"] == 10
    skewed = [1.0] * 60 + [2.0 + i * 0.01 for i in range(40)] + [float(10 ** k) for k in range(1, 7)] * 8
    rows = P.histogram_bins(numbers(spark, skewed), "x").orderBy("bar").collect()
    assert sum(r["rows"] for r in rows) == len(skewed)
    steps = [r["x1"] / r["x0"] for r in rows]
    assert max(steps) == pytest.approx(min(steps), rel=1e-6)


def test_correlation_edges(spark):
    rows = [(1.0, 2.0, 7.0, None), (2.0, 4.0, 7.0, 1.0), (3.0, 6.0, 7.0, None), (4.0, 9.0, 7.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, k double, few double")
    cells = {(r["x"], r["y"]): r["value"] for r in P.correlation_matrix(df, df.columns).collect()}
    assert cells["a", "a"] == pytest.approx(1.0) and cells["a", "b"] == cells["b", "a"] == pytest.approx(11.5 / (5 * 26.75) ** 0.5)
    assert cells["a", "k"] is None and cells["k", "k"] is None and cells["a", "few"] is None
    assert P.strongest_pair(P.correlation_matrix(df, df.columns)).first()["x"] == "a"


def test_correlation_keeps_digits_on_large_values(spark):
    df = spark.createDataFrame([(1e9 + i, 1e9 - 2 * i + (i % 2)) for i in range(50)], "a double, b double")
    import numpy as np

    want = np.corrcoef([i for i in range(50)], [-2 * i + (i % 2) for i in range(50)])[0, 1]
    got = P.correlation_matrix(df, ["a", "b"]).where("i = 0 and j = 1").first()["value"]
    assert got == pytest.approx(want, abs=1e-9)


def test_zero_conventions(spark):
    df = spark.createDataFrame([(0.0,), (None,), (float("nan"),), (5.0,)], "x double")
    row = C.zero_profile(df).first()
    assert (row["zero_pct"], row["nonzero"]) == (25.0, 3)
    row = C.zero_source_summary(df, {"x": "X"}).first()
    assert (row["present"], row["zero_count"], row["zero_rate"]) == (2, 1, 0.5)
    assert C.sparsity(df).first()["nulls"] == 2


def test_prune(spark, mixed):
    assert C.prune_sparse_columns(mixed).columns == ["id", "name", "amount", "day"]


def test_funnel_counts_copies(spark):
    rows = [("a", 1.0), ("a", 1.0), (None, 1.0), ("b", 0.0), ("b", 0.0), ("c", None)]
    df = spark.createDataFrame(rows, "n string, x double")
    steps = [("named", F.col("n").isNotNull()), ("nonzero", F.coalesce(F.col("x") != 0, F.lit(True)))]
    got = [(r["rule"], r["removed"], r["remaining"]) for r in C.row_funnel(df, steps, 1).orderBy("step").collect()]
    assert got == [("named", 1, 5), ("drop_duplicates", 2, 3), ("nonzero", 1, 2)]
    got = [(r["rule"], r["removed"], r["remaining"]) for r in C.row_funnel(df, steps).orderBy("step").collect()]
    assert got == [("named", 1, 5), ("nonzero", 2, 3)]
    gaps = spark.createDataFrame([("a", 1.0), (None, float("nan")), (None, None), (None, 2.0)], "n string, x double")
    got = C.row_funnel(gaps, [("empty", C.has_values(gaps))]).first()
    assert (got["removed"], got["remaining"]) == (2, 2) == (4 - C.drop_empty_rows(gaps).count(), C.drop_empty_rows(gaps).count())


def test_search(spark):
    df = spark.createDataFrame([(1, "Alpha", "0"), (2, None, "0"), (3, "alphabet", "1")], "id long, name string, c string")
    assert [(r["id"], r["matches"]) for r in C.search_table(df, " ALPH", ["name", "absent"], "id").collect()] == [(1, 2), (3, 2)]
    assert [r["id"] for r in C.search_table(df, "", ["name"], "id", "c", "0").collect()] == [1, 2]


def test_headers_and_roles():
    assert unique_headers([" a ", "", "a", None, "a"]) == ["a", "Column 2", "a_2", "Column 4", "a_3"]
    assert find_column(["Company Name", "x"], ["name", "company_name"]) == "Company Name"
    assert find_column(["my_status_text"], ["status"]) == "my_status_text"
    assert resolve_roles(["Cluster", "market"], "Cluster")["profile"] == "Cluster"
    assert choose_features(["cluster", "a", "b"]) == ["a", "b"]


def test_no_column_and_no_row_is_lost(spark):
    wide = spark.range(30).select(*[(F.col("id") * (i + 1) % 7).cast("double").alias(f"c{i}") for i in range(12)])
    assert P.correlation_matrix(wide, wide.columns).count() == 144
    mixed = spark.createDataFrame([(0.0,)] * 60 + [(-i - 0.5,) for i in range(30)] + [(i + 0.5,) for i in range(10)], "x double")
    assert P.histogram(mixed, "x").agg(F.sum("rows")).first()[0] == 100
    assert unique_headers(["a", "a", "a_2"]) == ["a", "a_3", "a_2"]


def test_natural_order_of_text_with_numbers(spark):
    from tidemark.operators.sampling import natural_sort

    labels = ["a10", "a2", "10", "9", "b1", "a02x", "a2x", "$8", "a", "", "a99999999999999999999999999999999999999999", "a100000000000000000000000000000000000000000"]
    got = [r["t"] for r in natural_sort(spark.createDataFrame([(v,) for v in labels], "t string"), "t").collect()]
    assert got == ["$8", "9", "10", "", "a", "a2", "a02x", "a2x", "a10", "a99999999999999999999999999999999999999999",
                   "a100000000000000000000000000000000000000000", "b1"]


def test_counts_and_their_total_come_from_one_scan(spark, tmp_path):
    from tidemark.operators.groups import group_sizes
    from tidemark.operators.profiling import value_counts

    spark.range(1000).selectExpr("cast(id % 7 as string) as v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for found in (value_counts(df, "v", 3), value_counts(df, "v", None), group_sizes(df, "v")):
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert "ReusedExchange" in plan and final.count("FileScan") <= 2


def test_parts_merge_to_the_profile_of_the_table(spark, mixed, tmp_path):
    dated = mixed.withColumn("part", F.col("id") % 3)
    path = str(tmp_path / "parts")
    S.write_parts(S.profile_parts(dated.where("part < 2"), "id", ["part"]), path, ["part"])
    S.write_parts(S.profile_parts(dated.where("part >= 1"), "id", ["part"]), path, ["part"])  # one part again, one new
    exact = {r["column"]: r.asDict() for r in P.column_profile(mixed, "id").collect()}
    merged = {r["column"]: r.asDict() for r in S.merge_parts(spark.read.parquet(path)).drop("low", "high").collect()}
    assert merged == exact  # sketches of a few values count them


def test_sketch_bounds_hold_and_decide(spark):
    df = spark.range(30000).select(F.col("id"), F.concat(F.lit("a"), F.col("id") % 20000).alias("two_thirds"),
                                   F.concat(F.lit("b"), F.col("id") % 24001).alias("near"), F.concat(F.lit("c"), "id").alias("all"))
    rows = {r["column"]: r for r in S.merge_parts(S.profile_parts(df, "id")).collect()}
    assert all(rows[c]["low"] <= n <= rows[c]["high"] for c, n in (("two_thirds", 20000), ("near", 24001), ("all", 30000)))
    asked = []

    def count_exactly(columns):
        asked.extend(columns)
        return {"near": 24001}

    assert S.identifier_column(list(rows.values()), count_exactly) == "near" and asked == ["near"]
    assert S.identifier_column([rows["two_thirds"], rows["all"]], None) == "all"
    assert S.profile_warnings(df, "id").first()["text"].startswith("near behaves")
    plain = spark.range(100).select("id", (F.col("id") % 5).alias("v"))
    assert S.profile_warnings(plain, "id").collect() == []
