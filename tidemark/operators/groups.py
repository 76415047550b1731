"""Statistics by label: sizes, medians, shares, cross-tabs, lifts, profiles, status readings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scores import STATUS_CLASSES, normalize_status
from tidemark.functions.templates import NO_TAKEAWAY, STATUS_READINGS, TAKEAWAY, fill
from tidemark.functions.text import HINT_NAMES, format_money, format_percent, map_values
from tidemark.functions.values import MISSING, as_number, display_value, is_missing, raw_share
from tidemark.operators.order import exact_quantiles, join_checked
from tidemark.operators.profiling import _moments, basic_stats, coerce_number_symbols, join_null_safe
from tidemark.operators.schema import unpivot
from tidemark.session import cut_lineage

# Category columns shown in a group profile, and the market-lift size limit.
PROFILE_CATEGORIES = ["status", "market", "country_code"]
MIN_LIFT_ROWS = 20
# Limits in the status reading.
LOW_CLOSED, HIGH_OPERATING, HIGH_UNKNOWN = 0.03, 0.85, 0.08


def keyed(df: DataFrame, label: str) -> DataFrame:
    """Rows that have a label: null keys form no group."""
    return df.where(F.col(label).isNotNull())


def shown_label(df: DataFrame, label: str) -> DataFrame:
    """Rows with a visible label, the label as text."""
    return df.withColumn(label, display_value(label)).where(F.col(label) != MISSING)


def group_sizes(df: DataFrame, label: str) -> DataFrame:
    """Rows per label and percentage of the labelled rows."""
    rows = keyed(df, label)
    counted = rows.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = counted.agg(F.sum("rows").alias("n")).scalar()  # the same exchange, so the table is read once
    return counted.withColumn("pct", F.col("rows") * 100.0 / total)


def group_median(df: DataFrame, label: str, features: list[str], rows: int | None = None) -> DataFrame:
    return exact_quantiles(keyed(df, label), features, {"median": 0.5}, [label], rows=rows)


def group_mean(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    return _moments(keyed(df, label), features, {"mean": F.avg}, [label])


def group_nonzero_rate(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """Share of a label's rows whose value is positive; a missing value is not."""
    positive = lambda x: F.avg(F.coalesce(x > 0, F.lit(False)).cast("int"))
    return _moments(keyed(df, label), features, {"nonzero_rate": positive}, [label])


def widen(long: DataFrame, label: str, features: list[str], value: str) -> DataFrame:
    """One row per label, one column per feature."""
    return long.groupBy(label).pivot("feature", features).agg(F.first(value))


def group_median_share(df: DataFrame, label: str, parts: list[str], total: str) -> DataFrame:
    shares = df.select(label, *[raw_share(p, total).alias(p) for p in parts])
    return group_median(shares, label, parts)


def group_boxplot(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """Quartiles and the extreme values inside 1.5 IQR of the box, per label and feature."""
    rows = keyed(df, label)
    box = exact_quantiles(rows, features, by=[label])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fences = box.groupBy(label).pivot("feature", features).agg(
        F.first(F.col("q1") - reach).alias("low"), F.first(F.col("q3") + reach).alias("high"))
    joined = join_checked(rows.select(label, *[as_number(rows, f).alias(f) for f in features]), fences, label)
    aggs = []
    for i, f in enumerate(features):
        aggs += [F.min(F.when(F.col(f) >= F.col(f"{f}_low"), F.col(f))).alias(f"lo{i}"),
                 F.max(F.when(F.col(f) <= F.col(f"{f}_high"), F.col(f))).alias(f"hi{i}")]
    wide = joined.groupBy(label).agg(*aggs)
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"lo{i}").alias("whisker_low"),
                               F.col(f"hi{i}").alias("whisker_high")) for i, f in enumerate(features)])
    return box.join(wide.select(label, F.inline(cells)), [label, "feature"]).select(
        label, "feature", "whisker_low", "q1", "median", "q3", "whisker_high")


def crosstab_row_pct(df: DataFrame, label: str, column: str, values: list[str]) -> DataFrame:
    """Row percentages of a label x value table; the divisor is the label's rows with a value."""
    rows = keyed(df, label).where(F.col(column).isNotNull())
    aggs = [F.count_if(F.col(column) == v).alias(f"c{i}") for i, v in enumerate(values)]
    counted = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *aggs)
    return counted.select(label, *[(F.col(f"c{i}") * 100.0 / F.col("n")).alias(v) for i, v in enumerate(values)])


def share_of_total(df: DataFrame, label: str, column: str) -> DataFrame:
    """Count of each value inside each label, and its share of the label's rows with a value."""
    rows = keyed(df, label).where(F.col(column).isNotNull())
    counted = rows.groupBy(label, column).agg(F.count(F.lit(1)).alias("rows"))
    totals = counted.groupBy(label).agg(F.sum("rows").alias("label_rows"))
    return counted.join(totals, label).withColumn("share", F.col("rows").cast("double") / F.col("label_rows"))


def top_n_per_group(df: DataFrame, by: list[str], order: list[Column], n: int, out: str = "rank") -> DataFrame:
    """First n rows of each group; Spark cuts to n per task before the shuffle."""
    place = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.row_number().over(place)).where(F.col(out) <= n)


def top_values_by_group(df: DataFrame, label: str, column: str, n: int = 10) -> DataFrame:
    shares = share_of_total(df, label, column)
    return top_n_per_group(shares, [label], [F.desc("rows"), F.asc(column)], n)


def group_stats(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """Long table (label, feature, count, min, max, mean, median, q1, q3, std) over visible labels."""
    return basic_stats(shown_label(df, label), features, [label])


def group_overview(df: DataFrame, label: str) -> DataFrame:
    """Rows per visible label, share of all rows, readable name."""
    every = df.groupBy(display_value(label).alias(label)).agg(F.count(F.lit(1)).alias("rows"))
    total = every.agg(F.sum("rows").alias("n")).scalar()  # the same exchange, so the table is read once
    # Asking for rows as well keeps this filter above the counts, where the total still has the missing label.
    counted = every.where(F.when(F.col("rows") > 0, F.col(label) != MISSING))
    name = F.coalesce(map_values(label, HINT_NAMES), F.concat(F.lit("Cluster "), F.col(label)))
    return counted.select(label, name.alias("name"), "rows", (F.col("rows").cast("double") / total).alias("share"))


def group_top_categories(df: DataFrame, label: str, columns: list[str] = PROFILE_CATEGORIES, n: int = 4) -> DataFrame:
    """The most frequent values of the category columns in each label, missing counted."""
    rows = shown_label(df, label)
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), display_value(c).alias("value")) for c in columns if c in df.columns])
    counted = rows.select(label, F.inline(cells)).groupBy(label, "column", "value").agg(
        F.count(F.lit(1)).alias("rows"))
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("label_rows"))
    ranked = top_n_per_group(counted, [label, "column"], [F.desc("rows"), F.asc("value")], n)
    return ranked.join(sizes, label).withColumn("share", F.col("rows").cast("double") / F.col("label_rows")).drop(
        "label_rows")


def group_profile(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """``group_stats`` beside the size, share and name of each label."""
    return group_overview(df, label).join(group_stats(df, label, features), label)


def standard_differences(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """(label, feature, local_mean, global_mean, score): mean difference in global deviations, 0 without spread."""
    local = _moments(shown_label(df, label), features, {"local_mean": F.avg}, [label])
    overall = _moments(df, features, {"global_mean": F.avg, "global_std": F.stddev_pop})
    gap = F.coalesce("local_mean", F.lit(0.0)) - F.coalesce("global_mean", F.lit(0.0))
    score = F.when(F.col("global_std") > 0, gap / F.col("global_std")).otherwise(F.lit(0.0))
    return local.join(overall, "feature").select(label, "feature", "local_mean", "global_mean", "global_std",
                                                 score.alias("score"))


@dataclass(frozen=True)
class LabelMoments:
    """What one scan of a table tells about its labels, features, gaps and largest value."""

    table: DataFrame  # one row per shown label, missing labels included as a label: rows, n<i>, m<i>, v<i>
    rows: int
    counts: dict[str, int]
    means: dict[str, float | None]
    deviations: dict[str, float | None]
    missing: dict[str, int]
    largest: float | None


def label_moments(df: DataFrame, label: str, features: list[str], total: str) -> LabelMoments:
    """One grouped aggregate over the table; all figures over all rows are merged from its rows, one per label.

    Counts, means and squared deviations of the labels add up to those of the table without a second look at it. All
    buffers are numbers, so the labels are hashed and no row is sorted.
    """
    gaps = df.columns
    aggs = [F.count(F.lit(1)).alias("rows"), F.max(as_number(df, total)).alias("largest"),
            *[F.count_if(is_missing(F.col(f"`{c}`"))).alias(f"gap{i}") for i, c in enumerate(gaps)]]
    for i, f in enumerate(features):
        x = as_number(df, f)
        aggs += [F.count(x).alias(f"n{i}"), F.coalesce(F.avg(x), F.lit(0.0)).alias(f"m{i}"),
                 F.coalesce(F.var_pop(x), F.lit(0.0)).alias(f"v{i}")]
    table = cut_lineage(df.groupBy(display_value(label).alias(label)).agg(*aggs))
    each = range(len(features))
    sums = table.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max("largest").alias("largest"),
                     *[F.coalesce(F.sum(f"gap{i}"), F.lit(0)).alias(f"gap{i}") for i in range(len(gaps))],
                     *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in each],
                     *[F.try_divide(F.sum(F.col(f"n{i}") * F.col(f"m{i}")), F.sum(f"n{i}")).alias(f"m{i}") for i in each]).first()
    around = lambda i: F.col(f"v{i}") + F.pow(F.col(f"m{i}") - F.lit(float(sums[f"m{i}"] or 0.0)), 2)
    spread = table.agg(F.lit(0), *[F.sqrt(F.try_divide(F.sum(F.col(f"n{i}") * around(i)), F.sum(f"n{i}"))) for i in each]).first()
    return LabelMoments(
        table, sums["rows"], {f: sums[f"n{i}"] for i, f in enumerate(features)}, {f: sums[f"m{i}"] for i, f in enumerate(features)},
        dict(zip(features, spread[1:])), {c: sums[f"gap{i}"] for i, c in enumerate(gaps)}, sums["largest"])


def moments_overview(found: LabelMoments, label: str) -> DataFrame:
    """``group_overview`` from what is known, without its name."""
    share = F.col("rows").cast("double") / F.lit(max(1, found.rows))
    return found.table.where(F.col(label) != MISSING).select(label, "rows", share.alias("share"))


def moments_differences(found: LabelMoments, label: str, features: list[str]) -> DataFrame:
    """``standard_differences`` from what is known."""
    place = {f: i for i, f in enumerate(found.counts)}
    number = lambda x: F.lit(None if x is None else float(x)).cast("double")
    cells = F.array(*[F.struct(
        F.lit(f).alias("feature"), F.when(F.col(f"n{place[f]}") > 0, F.col(f"m{place[f]}")).alias("local_mean"),
        number(found.means[f]).alias("global_mean"), number(found.deviations[f]).alias("global_std")) for f in features])
    long = found.table.where(F.col(label) != MISSING).select(label, F.inline(cells))
    gap = F.coalesce("local_mean", F.lit(0.0)) - F.coalesce("global_mean", F.lit(0.0))
    score = F.when(F.col("global_std") > 0, gap / F.col("global_std")).otherwise(F.lit(0.0))
    return long.select("*", score.alias("score"))


def _feature_position(features: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))


def distinguishing_features(df: DataFrame, label: str, features: list[str], n: int = 4) -> DataFrame:
    return rank_differences(standard_differences(df, label, features), label, features, n)


def rank_differences(scored: DataFrame, label: str, features: list[str], n: int = 4) -> DataFrame:
    """The n features of each label that differ most from all rows."""
    # Scores that differ only in rounding noise count as ties and fall back to the feature order.
    order = [F.desc(F.round(F.abs("score"), 9)), F.asc("position")]
    top = top_n_per_group(scored.withColumn("position", _feature_position(features)), [label], order, n)
    return top.select(label, "rank", "feature", "score",
                      F.when(F.col("score") >= 0, "higher").otherwise("lower").alias("direction"),
                      "local_mean", "global_mean")


def feature_separation(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    return separate_features(standard_differences(df, label, features), label, features)


def separate_features(scored: DataFrame, label: str, features: list[str]) -> DataFrame:
    """Gap between the highest and lowest label mean, in global deviations."""
    place = F.struct(F.round("local_mean", 9), _label_rank(label))
    gaps = scored.where(F.col("local_mean").isNotNull()).groupBy("feature").agg(
        F.count(F.lit(1)).alias("labels"),
        F.min_by(label, place).alias("low_label"), F.min("local_mean").alias("low"),
        F.max_by(label, place).alias("high_label"), F.max("local_mean").alias("high"),
        F.max("global_std").alias("global_std"),
    ).where(F.col("labels") >= 2)
    gap = F.col("high") - F.col("low")
    score = F.when(F.col("global_std") > 0, gap / F.col("global_std")).otherwise(gap)
    return gaps.select("feature", _feature_position(features).alias("position"), "low_label", "low", "high_label",
                       "high", score.alias("score"))


def _label_rank(label: str) -> Column:
    """Comparable natural-order key of a text label."""
    number = coerce_number_symbols(F.col(label))
    return F.struct(number.isNull().alias("is_text"), F.coalesce(number, F.lit(0.0)).alias("number"),
                    F.col(label).alias("text"))


def group_heatmap(df: DataFrame, label: str, features: list[str], limit: int | None = None) -> DataFrame:
    return standard_differences(df, label, features[:limit]).select(label, "feature", "score")


def largest_smallest_group(df: DataFrame, label: str) -> DataFrame:
    """Labels with the most and the fewest rows; the first in natural order wins ties."""
    return size_extremes(group_overview(df, label), label)


def size_extremes(overview: DataFrame, label: str) -> DataFrame:
    return overview.withColumn("_order", _label_rank(label)).agg(
        F.min_by(label, F.struct(-F.col("rows"), "_order")).alias("largest"), F.max("rows").alias("largest_rows"),
        F.min_by(label, F.struct("rows", "_order")).alias("smallest"), F.min("rows").alias("smallest_rows"))


def feature_lift(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """Label mean minus overall mean."""
    local = group_mean(df, label, features)
    overall = _moments(df, features, {"overall": F.avg})
    return local.join(overall, "feature").select(label, "feature", (F.col("mean") - F.col("overall")).alias("lift"))


def share_ratio(df: DataFrame, label: str, column: str) -> DataFrame:
    """(label, value, rows, share, base_share, lift): share inside the label over share in all rows."""
    inside = share_of_total(df, label, column)
    named = df.where(F.col(column).isNotNull())
    base = named.groupBy(column).agg(F.count(F.lit(1)).alias("base_rows"))
    total = base.agg(F.sum("base_rows").alias("n")).scalar()  # the same exchange
    base = base.select(column, (F.col("base_rows").cast("double") / total).alias("base_share"))
    return inside.join(base, column).select(label, column, "rows", "share", "base_share",
                                            (F.col("share") / F.col("base_share")).alias("lift"))


def market_lift(df: DataFrame, label: str, column: str, min_rows: int = MIN_LIFT_ROWS, n: int = 10) -> DataFrame:
    """The most over-represented values of each label among those with enough rows."""
    lifts = share_ratio(df, label, column).where(F.col("rows") >= min_rows)
    return top_n_per_group(lifts, [label], [F.desc(F.round("lift", 9)), F.asc(column)], n)


def assemble_series(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Outer alignment followed by dropping incomplete rows is an inner join without nulls."""
    return left.join(right, keys).dropna("any")


def reindex(labels: DataFrame, values: DataFrame, key: str, fill: dict[str, object] | None = None) -> DataFrame:
    """Values on a fixed label list; absent labels are null or the given fill."""
    joined = labels.join(values, key, "left")
    return joined.na.fill(fill) if fill else joined


def funding_composition(df: DataFrame, label: str, ratios: list[str]) -> DataFrame:
    return group_mean(df, label, ratios).withColumn("pct", F.col("mean") * 100).drop("mean")


def status_by_group(df: DataFrame, label: str, status: str = "status") -> DataFrame:
    """Counts and shares of the status classes per visible label."""
    rows = shown_label(df, label).withColumn("_class", normalize_status(status))
    counted = rows.groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("_class") == s).alias(s) for s in STATUS_CLASSES])
    return counted.select("*", *[(F.col(s).cast("double") / F.col("rows")).alias(f"{s}_rate") for s in STATUS_CLASSES])


def status_totals(table: DataFrame) -> DataFrame:
    """(class, rows) over all labels; ``other`` only if it occurs."""
    sums = table.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in STATUS_CLASSES])
    long = sums.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("class"), F.col(s).alias("rows")) for s in STATUS_CLASSES])))
    return long.where((F.col("class") != "other") | (F.col("rows") > 0))


def status_extremes(table: DataFrame, label: str) -> DataFrame:
    """Labels with the highest acquired, highest closed and lowest closed share."""
    ranked = table.withColumn("_order", _label_rank(label))

    def first_by(rate: Column) -> Column:
        return F.min_by(F.struct(F.col(label).alias("label"), "acquired_rate", "closed_rate"), F.struct(rate, "_order"))

    picked = ranked.agg(first_by(-F.col("acquired_rate")).alias("a"), first_by(-F.col("closed_rate")).alias("c"),
                        first_by(F.col("closed_rate")).alias("l"))
    return picked.select(
        F.col("a.label").alias("highest_acquired"), F.col("a.acquired_rate").alias("highest_acquired_rate"),
        F.col("c.label").alias("highest_closed"), F.col("c.closed_rate").alias("highest_closed_rate"),
        F.col("l.label").alias("lowest_closed"), F.col("l.closed_rate").alias("lowest_closed_rate"))


def status_reading(df: DataFrame, label: str, status: str = "status") -> DataFrame:
    """One sentence per label from its status shares, and one over all labels (label null)."""
    table = status_by_group(df, label, status)
    ends = status_extremes(table, label)
    pct = lambda c: format_percent(F.col(c))
    said = lambda rule: fill(STATUS_READINGS[rule], **{s: pct(f"{s}_rate") for s in ("acquired", "closed", "operating", "unknown")})
    # The extremes are one row, read as a scalar subquery beside every label.
    joined = table.withColumn("_ends", ends.select(F.struct("*").alias("e")).scalar()).select("*", "_ends.*")
    sentence = (
        F.when((F.col(label) == F.col("highest_acquired")) & (F.col("acquired_rate") > 0), said("exits"))
        .when((F.col(label) == F.col("highest_closed")) & (F.col("closed_rate") > 0), said("closures"))
        .when((F.col(label) == F.col("lowest_closed")) & (F.col("closed_rate") < LOW_CLOSED), said("stable"))
        .when(F.col("operating_rate") >= HIGH_OPERATING, said("active"))
        .when(F.col("unknown_rate") >= HIGH_UNKNOWN, said("unknown"))
        .otherwise(said("mixed"))
    )
    overall = F.when(F.col("highest_acquired").isNull(), STATUS_READINGS["none"]).otherwise(fill(
        STATUS_READINGS["overall"], acquired_label=F.col("highest_acquired"), acquired=pct("highest_acquired_rate"),
        closed_label=F.col("highest_closed"), closed=pct("highest_closed_rate")))
    return joined.select(F.col(label), sentence.alias("reading")).unionByName(
        ends.select(F.lit(None).cast("string").alias(label), overall.alias("reading")))


def funding_takeaway(df: DataFrame, label: str, total: str = "funding_total_usd") -> DataFrame:
    """One sentence naming the labels with the highest and lowest median total."""
    medians = exact_quantiles(shown_label(df, label), [total], {"median": 0.5}, [label])
    medians = medians.withColumn("_order", _label_rank(label)).withColumn(
        "_rank", F.coalesce(F.col("median"), F.lit(0.0)))
    ends = medians.agg(
        F.min_by(F.struct(F.col(label).alias("label"), "median"), F.struct(-F.col("_rank"), "_order")).alias("top"),
        F.max_by(F.struct(F.col(label).alias("label"), "median"), F.struct(-F.col("_rank"), "_order")).alias("bottom"))
    text = fill(TAKEAWAY, top=F.col("top.label"), top_value=format_money("top.median"), bottom=F.col("bottom.label"),
                bottom_value=format_money("bottom.median"))
    return ends.select(F.coalesce(text, F.lit(NO_TAKEAWAY)).alias("takeaway"))


def unpivot_profile(wide: DataFrame, label: str, names: dict[str, str]) -> DataFrame:
    """(label, metric, value) with readable metric names."""
    long = unpivot(wide, [label], list(names))
    return long.select(label, map_values("feature", names).alias("metric"), "value")
