"""The batch preparation on a raw text file, and plan shapes."""

import contextlib
import io

from pyspark.sql import functions as F

from tidemark.plans.preparation import prepare
from tidemark.plans.records import record_profile, table
from tidemark.plans.reports import row_scorecard
from tidemark.operators.groups import group_mean
from tidemark.operators.kmeans import assign

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_prepare_raw_text(spark):
    rows = [("a", "m", " 1,000 ", 400.0, 300.0, 0.0, 0.0, 0.0, 0.0, 1.0, 5.0, 0.0), ("a", "m", " 1,000 ", 400.0, 300.0, 0.0, 0.0, 0.0, 0.0, 1.0, 5.0, 0.0),
            (None, "m", "5", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0), ("b", None, "5", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0),
            ("c", "m", " - ", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0), ("d", "m", "9", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0),
            ("e", "m", "0", 5.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0, 0.0, 7.0)]
    raw = spark.createDataFrame(rows, "name string, market string, ` funding_total_usd ` string, seed double, venture double, debt_financing double, "
                                "angel double, grant double, private_equity double, funding_rounds double, round_A double, round_C double")
    got = {r["name"]: r for r in prepare(raw).collect()}
    assert set(got) == {"a", "e"}
    assert (got["a"]["funding_total_usd"], got["a"]["venture_ratio"], got["a"]["early_stage_funding_ratio"], got["a"]["stage_level"]) == (1000.0, 0.3, 0.4, 1)
    assert (got["e"]["early_stage_funding_ratio"], got["e"]["stage_level"]) == (0.0, 3)


def test_filters_and_columns_reach_the_scan(spark):
    df = table(spark, SF, "orders").where(F.col("o_totalprice") > 1000).select("o_orderkey")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_records_have_no_nested_loop_and_prune_columns(spark):
    text = plan(record_profile(spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "l_shipdate" not in text and "p_name" not in text


def test_group_mean_is_one_shuffle_and_assign_none(spark):
    lines = table(spark, SF, "lineitem")
    assert plan(group_mean(lines, "l_returnflag", ["l_quantity", "l_tax"])).count(") Exchange") == 1
    assert "Exchange" not in plan(assign(lines, ["l_quantity"], [[1.0], [2.0]]))


def test_scorecard_explains_itself(spark):
    df = spark.createDataFrame(
        [(1, "a", "m", "operating", 100.0, 1.0), (2, "b", "m", "closed", 50.0, 3.0), (3, "c", None, None, None, None)],
        "id long, name string, market string, status string, funding_total_usd double, funding_rounds double")
    rows = {r["id"]: r for r in row_scorecard(df, "id", explain=True).collect()}
    assert rows[1]["health_fields"] == ["Status", "Total funding", "Funding rounds"]
    assert rows[3]["health_fields"] == [] and rows[3]["health"] == 50.0
    assert rows[3]["health_why"].startswith("No useful dataset signal") and rows[1]["profile"] == "early"


def test_record_table_sums_lines_after_their_shuffle_and_is_not_shuffled_again(spark):
    from tidemark.plans import records

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prepared = prepare(records.record_profile(spark, "/root/testdata/sf0.001"))
        plan = prepared._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange" not in plan[:plan.index("SortMergeJoin")]  # the row distinct uses the order key's shuffle
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "regionkey" not in line]
    assert len(moved) == 6  # lines twice, orders twice, customers, parts


def test_tasks_of_the_record_table_follow_the_orders(spark, monkeypatch):
    from tidemark.plans import records

    expected = sorted(record_profile(spark, SF).collect())
    monkeypatch.setattr(records, "ORDERS_PER_TASK", 100, raising=False)
    assert sorted(record_profile(spark, SF).collect()) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large for a broadcast
    try:
        dealt = record_profile(spark, SF)
        assert sorted(dealt.collect()) == expected
        assert dealt.rdd.getNumPartitions() == 15
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_batch_preparation_reads_its_text_once_types_are_known(spark):
    from tidemark.plans.catalog import QUERIES

    prepared = QUERIES["batch_preparation"](spark, SF)
    assert "Scan parquet" in plan(prepared) and "Scan csv" not in plan(prepared)
    raw = prepare(record_profile(spark, SF))
    assert {r[0] for r in prepared.select("record_id").collect()} == {r[0] for r in raw.select("record_id").collect()}
