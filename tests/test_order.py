"""Order statistics against brute force, in both ways, under skew."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.order import (
    exact_quantiles,
    frequency_percentile,
    measure_spread,
    midrank_percentile,
    midrank_percentiles,
    numbered_rows,
    rows_at,
)

RANKED = dict(small_rows=0, small=20, per_bucket=60)


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows are 0, one group holds most rows, some values are missing or not numbers."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        value = 0.0 if i % 3 == 0 else float(np.round(np.exp(rng.normal(8, 3)), 2))
        if i % 50 == 1:
            value = None
        if i % 50 == 2:
            value = float("nan")
        rows.append((i, "big" if i % 10 else f"g{i % 4}", value, float(i % 5)))
    return rows


@pytest.fixture(scope="module")
def frame(spark, skewed):
    return spark.createDataFrame(skewed, "id long, g string, x double, y double").repartition(6, "id").cache()


def finite(values):
    return np.array([v for v in values if v is not None and not np.isnan(v)])


@pytest.mark.parametrize("options", [{}, RANKED], ids=["aggregate", "ranked"])
def test_quantiles_match_numpy(frame, skewed, options):
    probs = {"p0": 0.0, "q1": 0.25, "median": 0.5, "p99": 0.99, "p1": 1.0}
    got = exact_quantiles(frame, ["x", "y"], probs, ["g"], **options).collect()
    assert len(got) == len({r[1] for r in skewed}) * 2
    for row in got:
        column = 2 if row["feature"] == "x" else 3
        values = finite(r[column] for r in skewed if r[1] == row["g"])
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("options", [{}, RANKED], ids=["aggregate", "ranked"])
def test_quantiles_of_nothing(spark, options):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 3.0)], "id long, x double, y double")
    got = {r["feature"]: r["median"] for r in exact_quantiles(df, ["x", "y"], {"median": 0.5}, **options).collect()}
    assert got == {"x": None, "y": 2.5}


def test_null_group_is_kept(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, x double")
    for options in ({}, RANKED):
        got = {r["g"]: r["median"] for r in exact_quantiles(df, ["x"], {"median": 0.5}, ["g"], **options).collect()}
        assert got == {None: 2.0, "a": 5.0}


def brute_midrank(value, values):
    if value is None or np.isnan(value):
        return None
    return ((values < value).sum() + (values == value).sum() * 0.5) / len(values) * 100


@pytest.mark.parametrize("small", [200_000, 20], ids=["broadcast", "hot and cold"])
def test_midrank(frame, skewed, small):
    values = finite(r[2] for r in skewed)
    got = {r["id"]: r["pct"] for r in midrank_percentile(frame, "x", "pct", small).select("id", "pct").collect()}
    assert len(got) == len(skewed)
    for i, _, value, _ in skewed:
        expected = brute_midrank(value, values)
        assert got[i] == (None if expected is None else pytest.approx(expected, abs=1e-9))


def test_midranks_together(frame, skewed):
    out = midrank_percentiles(frame, frame, {"a": F.col("x"), "b": F.col("y")}, small=20)
    rows = {r["id"]: r for r in out.collect()}
    xs, ys = finite(r[2] for r in skewed), finite(r[3] for r in skewed)
    assert len(rows) == len(skewed)
    for i, _, x, y in skewed[:200]:
        want = brute_midrank(x, xs)
        assert rows[i]["_a_pct"] == (None if want is None else pytest.approx(want, abs=1e-9))
        assert rows[i]["_b_pct"] == pytest.approx(brute_midrank(y, ys), abs=1e-9)


def test_midrank_of_one_row_is_50(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None)], "id long, x double")
    assert {r["id"]: r["pct"] for r in midrank_percentile(df, "x", "pct").collect()} == {1: 50.0, 2: None}


@pytest.mark.parametrize("small", [200_000, 1], ids=["broadcast", "hot and cold"])
def test_frequency_percentile(spark, small):
    names = ["A "] * 5 + ["a"] * 1 + ["b"] * 2 + ["c"] * 2 + [None, " ", "(missing)"]
    df = spark.createDataFrame(list(enumerate(names)), "id long, m string")
    got = {r["id"]: r["pct"] for r in frequency_percentile(df, "m", "pct", small=small).collect()}
    # Counts: a 6, b 2, c 2, (missing) 1.
    assert got[0] == got[5] == pytest.approx((3 + 0.5) / 4 * 100)
    assert got[6] == pytest.approx((1 + 1) / 4 * 100)
    assert got[10] is None and got[11] is None and got[12] is None


def test_numbered_rows(frame, skewed):
    got = {r["id"]: r["n"] for r in numbered_rows(frame, "id", out="n", small=20, per_bucket=100).collect()}
    assert got == {r[0]: r[0] + 1 for r in skewed}
    by = {r["id"]: r["n"] for r in numbered_rows(frame, "id", ["g"], "n", small=20, per_bucket=100).collect()}
    seen = {}
    for i, g, _, _ in skewed:
        seen[g] = seen.get(g, 0) + 1
        assert by[i] == seen[g]


def test_rows_at(frame):
    for options in ({}, dict(small=20, per_bucket=100)):
        got = {r["p"]: r["id"] for r in rows_at(frame, "id", [1, 1500, 3000], "p", **options).collect()}
        assert got == {1: 0, 1500: 1499, 3000: 2999}


def test_spread_is_measured(frame):
    spread = measure_spread(frame, ["x", "y"], small=20, per_bucket=100)
    assert spread["x"].rows == 3000 and len(spread["x"].splits) > 5 and spread["y"].splits == ()


def test_partition_count_does_not_matter(spark, frame):
    wide = exact_quantiles(frame.repartition(37), ["x"], by=["g"], **RANKED).orderBy("g").collect()
    assert wide == exact_quantiles(frame.coalesce(1), ["x"], by=["g"], **RANKED).orderBy("g").collect()


def test_zero_heavy_values_fill_several_buckets(spark):
    from tidemark.operators.order import _with_buckets

    df = spark.range(100_000).select(F.when(F.col("id") % 50 == 0, F.col("id").cast("double")).otherwise(0.0).alias("x"))
    spread = measure_spread(df, ["x"], small=10, per_bucket=100)
    sizes = _with_buckets(df, spread).distinct().groupBy("x__bucket").count().collect()
    assert len(sizes) >= 15 and max(r["count"] for r in sizes) <= 200


@pytest.mark.parametrize("options", [{}, {"small": 2, "per_bucket": 2}], ids=["one", "buckets"])
def test_keys_keep_their_type(spark, options):
    large = [2**60 + k for k in (5, 0, 3, 1, 4, 2)]
    got = numbered_rows(spark.createDataFrame([(k,) for k in large], "k long"), "k", **options).collect()
    assert {r["k"] - 2**60: r["row_number"] for r in got} == {k: k + 1 for k in range(6)}
    names = ["b", "a", "Customer#000000010", "Customer#000000009", "é", "aa", ""]
    got = numbered_rows(spark.createDataFrame([(k,) for k in names], "k string"), "k", **options).collect()
    assert [r["k"] for r in sorted(got, key=lambda r: r["row_number"])] == sorted(names, key=lambda x: x.encode())


@pytest.mark.parametrize("options", [dict(groups=0), dict(accuracy=10), dict(accuracy=100)], ids=["ranks", "brackets", "whole groups"])
def test_large_table_quantiles_match_numpy(frame, skewed, options):
    probs = {"p0": 0.0, "q1": 0.25, "median": 0.5, "p99": 0.99, "p1": 1.0}
    for by in ([], ["g"]):
        got = exact_quantiles(frame, ["x", "y"], probs, by, **RANKED, **options).collect()
        assert len(got) == len({r[1] for r in skewed} if by else [()]) * 2
        for row in got:
            column = 2 if row["feature"] == "x" else 3
            values = finite(r[column] for r in skewed if not by or r[1] == row["g"])
            for name, p in probs.items():
                assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_bracketed_quantiles_count_few_values(spark):
    """Of many distinct values only those near the quartiles are counted one by one."""
    from tidemark.operators.order import _bracketed_quantiles

    df = spark.range(200_000).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("string").alias("g"))
    for by in ([], ["g"]):
        found = _bracketed_quantiles(df, ["x"], {"q1": 0.25, "median": 0.5}, by, 1000)
        assert found.select("q1", "median").first() == (49_999.75, 99_999.5)
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm

    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        none = spark.sparkContext._gateway.new_array(jvm.double, 0)
        stages = store.stageList(None, False, False, none, jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = shuffled()
    exact_quantiles(df, ["x"], {"median": 0.5}, small_rows=0, small=20, accuracy=1000).collect()
    assert shuffled() - before < 10_000
