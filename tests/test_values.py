"""Hand-written edge values of the row-level functions."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scores, text
from tidemark.functions.values import (
    all_zero,
    coerce_number,
    coerce_number_suffix,
    coerce_number_symbols,
    display_value,
    dominant,
    finite,
    has_value,
    is_missing,
    ladder_level,
    infer_date_format,
    parse_date_as,
    parse_date_text,
    raw_share,
    round_half_even,
    round_half_up,
    safe_ratio,
    sum_parts,
    zero_count,
)

NAN, INF = float("nan"), float("inf")


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", make(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_coerce_number(spark):
    values = ["1,750,000", " 12 ", " -   ", "12d", "1e3", "nan", "Infinity", "", None, "-.5", "$5"]
    assert column(spark, values, "string", coerce_number) == [
        1750000.0, 12.0, None, None, 1000.0, None, None, None, None, -0.5, None]


def test_coerce_number_symbols(spark):
    assert column(spark, ["$2,500", "12%", "NaN", "abc", None, "  "], "string", coerce_number_symbols) == [
        2500.0, 12.0, None, None, None, None]


def test_coerce_number_suffix(spark):
    values = ["$2.5M", "3 billion", "5k", "12 percent", "€1,000", "n/a", "", None, "unknown", "-"]
    assert column(spark, values, "string", coerce_number_suffix) == [
        2.5e6, 3e9, 5000.0, 12.0, 1000.0, None, None, None, 0.0, None]


def test_missing_and_display(spark):
    values = [None, "", " \t", "x", "(missing)"]
    assert column(spark, values, "string", is_missing) == [True, True, True, False, False]
    assert column(spark, values, "string", display_value) == ["(missing)"] * 3 + ["x", "(missing)"]
    assert column(spark, values, "string", has_value) == [False, False, False, True, False]


def test_finite(spark):
    assert column(spark, [1.0, NAN, INF, -INF, None, 0.0], "double", finite) == [1.0, None, None, None, None, 0.0]


def test_dates(spark):
    got = column(spark, ["2020-02", "2020-02-30", "2020-02-29", "2020-2-1", "x", None], "string", parse_date_text)
    assert [str(v) if v else None for v in got] == ["2020-02-01", None, "2020-02-29", None, None, None]


def test_rounding(spark):
    assert column(spark, [0.5, 1.5, 2.5, -0.5, -1.5], "double", round_half_even) == [0.0, 2.0, 2.0, 0.0, -2.0]
    assert column(spark, [0.5, 1.5, 2.5, -0.5, -1.5], "double", round_half_up) == [1.0, 2.0, 3.0, 0.0, -1.0]


@pytest.fixture(scope="module")
def amounts(spark):
    rows = [(1, 50.0, 100.0, 0.0), (2, 150.0, 100.0, 0.0), (3, 5.0, 0.0, 5.0), (4, 5.0, None, 7.0), (5, -5.0, 10.0, 0.0),
            (6, None, 10.0, None), (7, 0.0, 10.0, 0.0), (8, 3.0, 10.0, 3.0)]
    return spark.createDataFrame(rows, "i int, part double, total double, other double")


def test_ratio_and_share(amounts):
    rows = amounts.select("i", safe_ratio("part", "total").alias("r"), raw_share("part", "total").alias("s")).orderBy("i").collect()
    assert [r["r"] for r in rows] == [0.5, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.3]
    assert [r["s"] for r in rows] == [0.5, 1.5, 0.0, 0.0, -0.5, None, 0.0, 0.3]


def test_row_sums_and_zeros(amounts):
    rows = amounts.select("i", sum_parts("part", "other").alias("s"), all_zero(["part", "other"]).alias("z"),
                          zero_count(["part", "other"]).alias("n")).orderBy("i").collect()
    assert [r["s"] for r in rows] == [50.0, 150.0, 10.0, 12.0, -5.0, None, 0.0, 6.0]
    assert [r["z"] for r in rows] == [False] * 6 + [True, False]
    assert [r["n"] for r in rows] == [1, 1, 0, 0, 1, 0, 2, 0]


def test_dominant_first_listed_wins(amounts):
    name, value = dominant(["part", "other"])
    rows = amounts.select("i", name.alias("n"), value.alias("v")).orderBy("i").collect()
    assert [(r["n"], r["v"]) for r in rows] == [
        ("part", 50.0), ("part", 150.0), ("part", 5.0), ("other", 7.0), (None, None), (None, None), (None, None),
        ("part", 3.0)]


def test_ladder_with_gaps_and_absent_columns(spark):
    df = spark.createDataFrame([(1.0, 0.0, 5.0), (0.0, 0.0, 0.0), (1.0, None, None)], "a double, b double, d double")
    assert [r[0] for r in df.select(ladder_level(["a", "b", "c", "d"], df.columns)).collect()] == [4, 0, 1]


def test_status_order(spark):
    values = ["Inactive", "ACQUIRED", "Live", "  ", None, "ipo", "(missing)", "was operating, closed"]
    assert column(spark, values, "string", scores.normalize_status) == [
        "closed", "acquired", "operating", "unknown", "unknown", "other", "unknown", "closed"]


def test_profile_class(spark):
    values = ["Private  Equity", "pe", "Debt Financing", "Series A", "pre-seed", "2", "9", None]
    assert column(spark, values, "string", lambda c: scores.profile_class(c, True)) == [
        "equity", "equity", "debt", "venture", "early", "equity", "early", "early"]


def test_spread_and_weights(spark):
    assert column(spark, [0.0, 50.0, 100.0, None], "double", scores.spread_percentile) == [15.0, 55.0, 95.0, None]
    mean = lambda c: scores.weighted_mean([(c, 2.0), (F.lit(None).cast("double"), 5.0)])
    assert column(spark, [80.0, 300.0, None], "double", mean) == [80.0, 100.0, 50.0]


def test_formats(spark):
    values = [1.25e9, 3.4e6, 7450.0, 12.5, -2e6, None, NAN]
    assert column(spark, values, "double", text.format_money) == [
        "$1.25B", "$3.40M", "$7.5K", "$13", "$-2.00M", "n/a", "n/a"]
    assert column(spark, [0.125, None], "double", text.format_percent) == ["12.5%", "n/a"]
    assert column(spark, [999.94, 999.96, 1234.0, 1e6, 12.0, 2.5e12, None], "double", text.format_compact) == [
        "999.9", "1K", "1.2K", "1M", "12", "2.5T", "n/a"]


def test_column_labels(spark):
    values = ["funding_total_usd", "log_extra_usd", "round_A", "country_code"]
    assert column(spark, values, "string", text.column_label) == ["Total funding", "Log Extra USD", "Round A", "Country"]
    assert column(spark, ["venture", "venture_ratio", "stage_level", "log_x", "y"], "string", text.column_unit_label) == [
        "(USD)", "(%)", "(count)", "(log-scale)", ""]


def test_date_formats_are_inferred(spark):
    frame = lambda *values: spark.createDataFrame([(v,) for v in values], "t string")
    assert infer_date_format(frame("1/2/2014", "3/25/2014", None, " ", "x"), "t") == ("month_first", False)
    assert infer_date_format(frame("1/2/2014", "25/3/2014", "31/12/2013"), "t") == ("day_first", False)
    assert infer_date_format(frame("1/2/2014", "3/4/2014"), "t") == ("month_first", True)
    assert infer_date_format(frame("2014-02-03", "1/2/2014", "2015-02-03"), "t") == ("iso", False)
    assert infer_date_format(frame("Feb 3, 2014"), "t") == ("named", False)
    assert infer_date_format(frame("3.2.2014", "13.2.2014"), "t") == ("dotted", False)
    assert infer_date_format(frame("x", None), "t") == infer_date_format(frame(), "t") == (None, False)
    got = [str(r[0]) for r in frame("2/30/2014", "2/3/2014 ", "02/03/2014", "2/3/14", None).select(parse_date_as("t", "month_first")).collect()]
    assert got == ["None", "2014-02-03", "2014-02-03", "None", "None"]
