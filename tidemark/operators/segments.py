"""Drill-down into one segment: re-clustering, naming, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import as_number
from tidemark.operators.groups import group_overview, group_stats, keyed
from tidemark.operators.kmeans import assign, kmeans_fit
from tidemark.operators.order import exact_quantiles, join_checked
from tidemark.session import cut_lineage

# Names of the three subgroups.
VENTURE_NAME = "Small / early venture-backed"
MULTI_ROUND_NAME = "Early-stage multi-round"
SEED_NAME = "Small seed-stage"
# Medians of the segment summary.
SUMMARY_MEDIANS = {"funding_total_usd": "median_total_funding_usd", "funding_rounds": "median_funding_rounds",
                   "stage_level": "median_stage_level", "early_stage_funding_ratio": "median_early_stage_ratio",
                   "venture_ratio": "median_venture_ratio"}


def segment_recluster(scaled: DataFrame, label: str, value: object, features: list[str], k: int = 3,
                      out: str = "SubCluster", starts: int = 10) -> DataFrame:
    """Cluster again inside one label, on features scaled over the full table (no refit)."""
    inside = scaled.where(F.col(label) == F.lit(value))
    return assign(inside, features, kmeans_fit(inside, features, k, starts=starts), out)


def segment_names(df: DataFrame, label: str) -> DataFrame:
    """(label, name): highest median venture ratio, then most rounds and funding, then the rest.

    Works on medians per label; the two leading labels are found by aggregates, whatever the number of labels.
    """
    features = ["venture_ratio", "funding_rounds", "funding_total_usd"]
    medians = exact_quantiles(keyed(df, label), features, {"median": 0.5}, [label])
    wide = cut_lineage(medians.groupBy(label).pivot("feature", features).agg(F.first("median")))
    highest = lambda c: F.struct(F.col(c).isNull(), -F.col(c))  # noqa: E731  nulls come last
    first = lambda rows, *order: rows.agg(F.min_by(label, F.struct(*order, F.col(label)))).first()[0]
    venture = first(wide, highest("venture_ratio"))
    rest = wide.where(F.col(label) != F.lit(venture))
    rounds = first(rest, highest("funding_rounds"), highest("funding_total_usd"))
    return wide.select(label, F.when(F.col(label) == F.lit(venture), VENTURE_NAME)
                       .when(F.col(label) == F.lit(rounds), MULTI_ROUND_NAME).otherwise(SEED_NAME).alias("name"))


def name_segments(df: DataFrame, label: str, out: str = "SubCluster_Name") -> DataFrame:
    """Rows with their segment name."""
    return join_checked(df, segment_names(df, label).withColumnRenamed("name", out), label, "left")


def segment_summary(df: DataFrame, label: str) -> DataFrame:
    """Size, share, medians and non-zero rates per label, highest median total first."""
    rows = keyed(df, label)
    medians = SUMMARY_MEDIANS
    found = exact_quantiles(rows, list(medians), {"median": 0.5}, [label])
    wide = found.groupBy(label).pivot("feature", list(medians)).agg(F.first("median")).withColumnsRenamed(medians)
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    positive = lambda c: F.avg(F.coalesce(as_number(rows, c) > 0, F.lit(False)).cast("int")) * 100
    sizes = rows.groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"), positive("venture").alias("pct_with_venture"),
        positive("early_stage_funding").alias("pct_with_early_stage"))
    return sizes.join(wide, label).withColumn("pct_of_segment", F.col("rows") * 100.0 / total).orderBy(
        F.desc("median_total_funding_usd"), F.asc(label))


def segment_drilldown(df: DataFrame, scaled: DataFrame, key: str, label: str, value: object, features: list[str],
                      k: int = 3, starts: int = 10) -> dict[str, DataFrame]:
    """One segment taken apart: ``rows`` with sub-label and name, ``summary`` by named sub-label, ``profile`` by name.

    ``scaled`` has the key, the label and the features scaled over the full table. The sub-labels are fitted, the names
    come from their medians. Keys are unique; rows without a key are left out. A segment without rows gives empty tables.
    """
    inside = df.where((F.col(label) == F.lit(value)) & F.col(key).isNotNull())
    if inside.isEmpty():
        bare = inside.withColumns({"SubCluster": F.lit(None).cast("int"), "SubCluster_Name": F.lit(None).cast("string")})
    else:
        found = segment_recluster(scaled, label, value, features, k, starts=starts).select(key, "SubCluster")
        # Read by all three tables, so fitted, labelled and joined once.
        bare = name_segments(cut_lineage(inside.join(found, key)), "SubCluster")
    names = bare.groupBy("SubCluster").agg(F.first("SubCluster_Name").alias("SubCluster_Name"))
    summary = segment_summary(bare, "SubCluster").join(names, "SubCluster")
    return {"rows": bare, "summary": summary, "profile": group_stats(bare, "SubCluster_Name", list(SUMMARY_MEDIANS))}


def subgroup_model(df: DataFrame, whole_rows, features: list[str], label: str = "SubCluster",
                   name: str = "SubCluster_Name") -> DataFrame:
    """``group_profile`` inside a segment, by name if there is one, with the segment's share of the whole."""
    by = name if name in df.columns else label
    segment_rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return group_overview(df, by).drop("name").join(group_stats(df, by, features), by).withColumn(
        "share_of_whole", segment_rows.cast("double") / whole_rows).withColumnRenamed(by, "subgroup")
