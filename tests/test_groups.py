"""Group tables, samples and report texts on small tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import groups as G
from tidemark.operators.sampling import random_sample, stratified_sample, top_outliers
from tidemark.operators.profiling import unique_labels
from tidemark.operators.segments import segment_names


@pytest.fixture(scope="module")
def people(spark):
    rows = [("10", "x", 1.0, "acquired"), ("10", "x", 3.0, "closed"), ("9", "y", 0.0, "operating"), ("9", "x", None, None),
            ("9", "y", 100.0, "operating"), (None, "x", 5.0, "closed"), (" ", None, 7.0, "ipo")]
    return spark.createDataFrame(rows, "c string, m string, v double, status string")


def test_labels_in_natural_order(people):
    assert [r["label"] for r in unique_labels(people, "c").collect()] == ["9", "10"]


def test_sizes_and_shares(people):
    sizes = {r["c"]: (r["rows"], r["pct"]) for r in G.group_sizes(people.where("c <> ' '"), "c").collect()}
    assert sizes == {"10": (2, 40.0), "9": (3, 60.0)}
    overview = {r["c"]: r["share"] for r in G.group_overview(people, "c").collect()}
    assert overview == {"10": pytest.approx(2 / 7), "9": pytest.approx(3 / 7)}


def test_nonzero_counts_missing_as_no(people):
    rates = {r["c"]: r["nonzero_rate"] for r in G.group_nonzero_rate(people, "c", ["v"]).collect()}
    assert rates["9"] == pytest.approx(1 / 3)


def test_crosstab_divides_by_rows_with_a_status(people):
    rows = {r["c"]: r for r in G.crosstab_row_pct(people, "c", "status", ["operating", "closed"]).collect()}
    assert rows["9"]["operating"] == 100.0 and rows["10"]["closed"] == 50.0


def test_boxplot_whiskers_stop_at_the_fence(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 5, 100]], "c string, v double")
    row = G.group_boxplot(df, "c", ["v"]).first()
    assert (row["whisker_low"], row["median"], row["whisker_high"]) == (1.0, 3.5, 5.0)


def test_constant_feature_scores_zero(spark):
    df = spark.createDataFrame([("a", 2.0, 1.0), ("b", 2.0, 3.0)], "c string, k double, v double")
    scores = {(r["c"], r["feature"]): r["score"] for r in G.standard_differences(df, "c", ["k", "v"]).collect()}
    assert scores == {("a", "k"): 0.0, ("b", "k"): 0.0, ("a", "v"): -1.0, ("b", "v"): 1.0}
    gap = {r["feature"]: (r["low_label"], r["high_label"], r["score"]) for r in G.feature_separation(df, "c", ["k", "v"]).collect()}
    assert gap["v"] == ("a", "b", 2.0) and gap["k"][2] == 0.0


def test_market_lift_ties_by_name(spark):
    rows = [("a", m) for m in ["z", "y", "x"] for _ in range(3)] + [("b", "w")] * 9
    lifts = G.market_lift(spark.createDataFrame(rows, "c string, m string"), "c", "m", min_rows=3, n=2)
    assert [(r["c"], r["m"]) for r in lifts.orderBy("c", "rank").collect()] == [("a", "x"), ("a", "y"), ("b", "w")]


def test_status_reading_rules(spark):
    rows = [("0", "operating")] * 9 + [("0", "acquired")] + [("1", "closed")] * 2 + [("1", "operating")] * 8 + [
        ("2", "operating")] * 100 + [("2", "closed")]
    df = spark.createDataFrame(rows, "c string, status string")
    texts = {r["c"]: r["reading"] for r in G.status_reading(df, "c").collect()}
    assert texts["0"] == "Most acquisitions of all labels: 10.0% acquired, 0.0% closed."
    assert texts["1"] == "Most closures of all labels: 20.0% closed."
    assert texts["2"].startswith("99.0% operating")
    assert texts[None].startswith("Acquired most often: label 0 (10.0%). Closed most often: label 1")


def test_random_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = {r["k"] for r in random_sample(df.repartition(7), "k", 100).collect()}
    assert len(a) == 100 and a == {r["k"] for r in random_sample(df.coalesce(1), "k", 100).collect()}
    assert a != {r["k"] for r in random_sample(df, "k", 100, seed=1).collect()}
    assert random_sample(df, "k", 9999).count() == 5000


def test_random_sample_hash_cut_gives_the_same_rows(spark):
    from tidemark.operators import sampling

    df = spark.range(20000).withColumnRenamed("id", "k")
    whole = [r["k"] for r in df.withColumn("_d", sampling._draw("k", 42)).orderBy("_d", "k").limit(50).collect()]
    assert {r["k"] for r in random_sample(df, "k", 50).collect()} == set(whole)


def test_stratified_sample(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") < 900, "a").otherwise("b").alias("c"))
    got = [r["k"] for r in stratified_sample(df, "c", "k", 100, 10).orderBy("k").collect()]
    assert got == list(range(0, 900, 10)) + list(range(900, 1000, 10))
    assert stratified_sample(df, "c", "k", 2000).count() == 1000
    # The minimum per label overshoots: all aims are lowered, no label is lost.
    tight = {r["c"]: r["count"] for r in stratified_sample(df, "c", "k", 95, 50).groupBy("c").count().collect()}
    assert sum(tight.values()) <= 95 and tight["a"] > 40 and tight["b"] > 20
    even = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 50).cast("string").alias("c"))
    assert stratified_sample(even, "c", "k").select("c").distinct().count() == 50


def test_outliers_break_ties_by_key(spark):
    df = spark.createDataFrame([(2, 9.0), (1, 9.0), (3, float("nan")), (4, 1.0)], "k long, v double")
    assert [r["k"] for r in top_outliers(df, "v", "k", 2).collect()] == [1, 2]


def test_segment_names(spark):
    rows = [(0, 0.0, 1.0, 10.0), (1, 0.9, 1.0, 50.0), (2, 0.0, 3.0, 20.0)]
    df = spark.createDataFrame(rows, "s int, venture_ratio double, funding_rounds double, funding_total_usd double")
    assert {r["s"]: r["name"] for r in segment_names(df, "s").collect()} == {
        0: "Small seed-stage", 1: "Small / early venture-backed", 2: "Early-stage multi-round"}


def test_templates_fill_columns_and_sql_alike(spark):
    from tidemark.functions.templates import fill, fill_sql

    told = "{a}'s share is {b}."
    made = spark.range(1).select(fill(told, a=F.lit("x"), b=F.lit("1%")).alias("t")).first()["t"]
    assert made == "x's share is 1%." and fill_sql(told, a="p", b="q") == "p || '''s share is ' || q || '.'"


def test_label_moments_merge_to_those_of_the_table(spark, people):
    rows = people.withColumn("k", F.xxhash64("c", "v"))
    found = G.label_moments(rows, "c", ["v"], "v")
    whole = people.agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"), F.count("v").alias("n")).first()
    assert (found.rows, found.counts["v"]) == (7, whole["n"])
    assert found.means["v"] == pytest.approx(whole["m"]) and found.deviations["v"] == pytest.approx(whole["s"])
    assert found.missing == {"c": 2, "m": 1, "v": 1, "status": 1, "k": 0} and found.largest == 100.0
    expected = {(r["c"], r["feature"]): (r["local_mean"], r["score"]) for r in G.standard_differences(people, "c", ["v"]).collect()}
    got = {(r["c"], r["feature"]): (r["local_mean"], r["score"]) for r in G.moments_differences(found, "c", ["v"]).collect()}
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k]) for k in got)
    empty = G.label_moments(rows.limit(0), "c", ["v"], "v")
    assert (empty.rows, empty.means, empty.largest) == (0, {"v": None}, None)


def test_insights_read_the_table_three_times(spark, rows_read, tmp_path):
    from tidemark.plans.reports import MIX_FEATURES, insights

    path, rows = str(tmp_path / "t"), 3000
    made = spark.range(rows).select(
        F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 3).cast("string").alias("c"),
        F.col("id").cast("double").alias("funding_total_usd"), *[((F.col("id") * (i + 2)) % 7 / 7).alias(f) for i, f in enumerate(MIX_FEATURES)])
    made.write.parquet(path)
    table = spark.read.parquet(path)
    before = rows_read()
    found = insights(table, "c", ["funding_total_usd", *MIX_FEATURES], ["funding_total_usd", *MIX_FEATURES], "k").collect()
    assert [r["rank"] for r in found] == [1, 2, 3, 5, 6, 7] and found[-1]["title"] == "n2999"
    assert rows_read() - before < 3 * rows + rows / 2  # the rest: rows of labels and features, and the file of the largest value
    assert insights(table.limit(0), "c", ["funding_total_usd"], ["funding_total_usd", "venture_ratio"], "k").collect() == []


def test_sizes_and_totals_take_one_scan(spark, people, rows_read, tmp_path):
    path = str(tmp_path / "p")
    people.write.parquet(path)
    table = spark.read.parquet(path)
    for report in (lambda: G.group_overview(table, "c"), lambda: G.group_sizes(table, "c")):
        before = rows_read()
        assert report().collect()
        assert rows_read() - before == 7
