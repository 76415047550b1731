"""The wide record table: one row per order, amounts by kind of part, descriptive columns."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import map_values
from tidemark.functions.values import dominant
from tidemark.plans.preparation import prepare
from tidemark.session import scratch_path

AMOUNTS = ["seed", "venture", "debt_financing", "angel", "grant", "private_equity"]
ROUNDS = [f"round_{x}" for x in "ABCDEFGH"]
INFO = ["name", "category_list", "market", "status", "country_code", "city"]
SOURCE_LABEL = {"early_stage_funding": "0", "debt_financing": "1", "private_equity": "2", "venture": "3"}
# Fixed value: orders of one task of the record table, at some 0.9 kB of its memory each.
ORDERS_PER_TASK = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_by(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` dealt by ``key`` to as many tasks as ``rows`` orders need, if these are more than the session's.

    A join on ``key`` deals its other side likewise, unless ``df`` is small enough to be broadcast.
    """
    tasks = math.ceil(rows / ORDERS_PER_TASK)
    return df.repartition(tasks, key) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def record_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records. Only narrow rows are shuffled: lines as key, price and the kind of amount they count for, orders
    with their customer's columns. The amounts are summed after the shuffle on the order key, which also serves the join
    with the orders and, as the key is a column of the result, the row distinct of the preparation. The number of tasks
    follows the number of orders, so that the memory of one task does not grow with the tables."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    size = orders.count()  # from the footers of the files
    part, customer = spread_by(part, "p_partkey", size), spread_by(customer, "c_custkey", size)
    # Two of the amounts depend on the order status, so they are summed per order and switched off below.
    kind, flag, number = F.col("p_type"), F.col("l_returnflag"), F.col("l_linenumber")
    kinds = {
        "seed": kind == "ECONOMY",
        "venture": kind.isin("STANDARD", "LARGE"),
        "debt_financing": (kind == "PROMO") & (flag == "A"),
        "angel": (kind == "SMALL") & (flag == "R"),
        "grant": (kind == "MEDIUM") & (flag == "R"),
        "private_equity": (kind == "SMALL") & (flag == "A"),
        "sparse_a": (kind == "PROMO") & (number == 7) & (flag == "R") & (F.col("l_discount") == 0),
        **{f"round_{x}": number == i for i, x in enumerate("ABCDEFG", start=1)},
    }
    # One bit for each amount that a line counts for: a line may count for several.
    bits = reduce(lambda a, b: a.bitwiseOR(b), [
        F.when(condition, F.lit(1 << i)).otherwise(F.lit(0)) for i, condition in enumerate(kinds.values())])
    marked = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", F.col("l_extendedprice").alias("price"), bits.alias("bits"))

    def amount(i):
        counted = F.col("bits").bitwiseAND(F.lit(1 << i)) != 0
        return F.round(F.coalesce(F.sum(F.when(counted, F.col("price"))), F.lit(0.0)), 2)

    # Shuffled before it is summed: four lines an order are narrower than one row of all sums.
    sums = spread_by(marked.repartition("l_orderkey"), "l_orderkey", size).groupBy("l_orderkey").agg(
        *[amount(i).alias(c) for i, c in enumerate(kinds)], F.count(F.lit(1)).alias("funding_rounds"))
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    # The sums come last, so that they are never moved.
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").drop("o_custkey", "c_custkey")
        .join(F.broadcast(place), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    status = F.when(F.col("o_orderstatus") == "O", "operating").when(F.col("o_orderstatus") == "F", "acquired") \
        .when(F.col("o_orderstatus") == "P", "closed")
    return joined.select(
        F.col("o_orderkey").alias("record_id"),
        F.col("c_name").alias("name"),
        # An order without a stated priority has no category, an indebted customer no market.
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("category_list"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("market"),
        status.alias("status"),
        F.col("n_name").alias("country_code"),
        F.col("r_name").alias("region"),
        F.concat_ws(" ", "r_name", F.col("c_nationkey").cast("string")).alias("city"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("funding_total_usd"),
        F.coalesce("funding_rounds", F.lit(0)).alias("funding_rounds"),
        *[zero(c).alias(c) for c in ("seed", "venture", "debt_financing", "angel", "grant")],
        F.when(F.col("o_orderstatus") == "O", zero("private_equity")).otherwise(0.0).alias("private_equity"),
        zero("sparse_a").alias("sparse_a"),
        *[zero(f"round_{x}").alias(f"round_{x}") for x in "ABCDEFG"],
        F.lit(0.0).alias("round_H"),
    )


_STAGED: dict[tuple, str] = {}


def _fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of what lies in an input folder, so that rewritten input is not taken for the old one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in entries))


def _spot(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, name, _fingerprint(spark, sf_dir))


def staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table written once per application to the shared folder and read from there.

    Every report reads the same prepared records. Written columnar, each report scans only its
    own columns, plans stay short, and a lost executor re-reads files instead of redoing joins.
    """
    spot = _spot(spark, sf_dir, name)
    if spot not in _STAGED:
        path = scratch_path(spark, name)
        build().write.parquet(path)
        _STAGED[spot] = path
    return spark.read.parquet(_STAGED[spot])


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "raw_records", lambda: record_profile(spark, sf_dir))


def label_by_source(prepared: DataFrame, out: str = "Cluster") -> DataFrame:
    """Rule-based label: the source with the largest amount."""
    source, _ = dominant(list(SOURCE_LABEL))
    return prepared.withColumn(out, map_values(source, SOURCE_LABEL))


def labelled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared records with a rule-based label.

    They are made from the raw records if these are written already; else straight from the tables, so that the raw ones
    are neither written nor shuffled again for the row distinct.
    """
    def build() -> DataFrame:
        written = _spot(spark, sf_dir, "raw_records") in _STAGED
        return label_by_source(prepare(raw_records(spark, sf_dir) if written else record_profile(spark, sf_dir)))

    return staged(spark, sf_dir, "labelled_records", build)


def segment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label 0 only, split by a rule into three subgroups."""
    inside = labelled_records(spark, sf_dir).where(F.col("Cluster") == "0")
    sub = F.when(F.col("venture_ratio") > 0.15, 1).when(F.col("funding_rounds") >= 5, 0).otherwise(2)
    return inside.withColumn("SubCluster", sub)
