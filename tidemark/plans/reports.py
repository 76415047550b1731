"""Report tables assembled from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scores import (
    SCORES,
    explain_score,
    mood_class,
    profile_class,
    profile_scores,
    score_columns,
    signals_used,
    spread_percentile,
    stage_scores,
    status_scores,
)
from tidemark.functions.templates import FINDINGS, NO_DIRECTION, NO_FEATURE, NO_NAME, fill
from tidemark.functions.text import (
    REPORT_NAMES,
    column_label,
    format_money,
    format_number,
    format_percent,
    map_values,
)
from tidemark.functions.values import as_number, coerce_number_suffix
from tidemark.operators.groups import (
    crosstab_row_pct,
    group_median,
    group_overview,
    group_sizes,
    label_moments,
    moments_differences,
    moments_overview,
    rank_differences,
    separate_features,
    shown_label,
    size_extremes,
    top_n_per_group,
    widen,
)
from tidemark.operators.kmeans import detect_label
from tidemark.operators.order import date_number, frequency_percentile, midrank_percentiles
from tidemark.operators.profiling import correlation_matrix, strongest_pair
from tidemark.operators.schema import resolve_roles

# Columns of the comparison table, ratios of the mix story, finding limit.
COMPARISON_FEATURES = ["funding_total_usd", "funding_rounds", "early_stage_funding_ratio", "venture_ratio",
                       "debt_financing_ratio", "private_equity_ratio"]
MIX_FEATURES = ["venture_ratio", "debt_financing_ratio", "private_equity_ratio", "early_stage_funding_ratio"]
MAX_FINDINGS = 8


def join_sizes_profile(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """Size, percentage and rounded medians per label."""
    medians = widen(group_median(df, label, features), label, features, "median")
    rounded = medians.select(label, *[F.bround(f, 0).alias(f) for f in features])
    sizes = group_sizes(df, label).withColumn("pct", F.bround("pct", 2))
    return sizes.join(rounded, label, "left")


def cluster_report(df: DataFrame, label: str, features: list[str], statuses: list[str],
                   names: dict[str, str] = REPORT_NAMES) -> DataFrame:
    """Name, size, medians and status percentages per label."""
    status = crosstab_row_pct(df, label, "status", statuses)
    status = status.select(label, *[F.bround(s, 2).alias(s) for s in statuses])
    report = join_sizes_profile(df, label, features).join(status, label, "left")
    return report.select(map_values(label, names).alias("name"), "*")


def comparison_table(df: DataFrame, label: str, features: list[str] = COMPARISON_FEATURES) -> DataFrame:
    """Size, share and chosen medians per visible label."""
    chosen = [f for f in features if f in df.columns]
    rows = shown_label(df, label)
    medians = widen(group_median(rows, label, chosen), label, chosen, "median")
    return group_overview(df, label).drop("name").join(medians, label)


def _finding_of(rule: str, label: Column | None, feature: Column | None, slots: dict[str, Column]) -> Column:
    """The finding of one rule, with the label and the feature it speaks of."""
    told = FINDINGS[rule]
    none = F.lit(None).cast("string")
    return F.struct(F.lit(told.rank).alias("rank"), F.lit(told.kicker).alias("kicker"), fill(told.title, **slots).alias("title"),
                    F.lit(told.tone).alias("tone"), fill(told.body, **slots).alias("body"),
                    (none if label is None else label).alias("label"), (none if feature is None else feature).alias("feature")).alias("f")


def mix_story(df: DataFrame, label: str, features: list[str], rows: int | None = None) -> DataFrame:
    """The ratio whose leading label is furthest ahead of the runner-up, by median; ``rows`` if the size is known."""
    chosen = [f for f in features if f in df.columns]
    medians = group_median(shown_label(df, label), label, chosen, rows).where(F.col("median").isNotNull())
    top = top_n_per_group(medians, ["feature"], [F.desc("median"), F.asc(label)], 2)
    first, second = F.col("rank") == 1, F.col("rank") == 2
    leader = top.groupBy("feature").agg(
        F.max(F.when(first, F.col(label))).alias("label"), F.max(F.when(first, F.col("median"))).alias("value"),
        (F.max(F.when(first, F.col("median"))) - F.coalesce(F.max(F.when(second, F.col("median"))), F.lit(0.0)))
        .alias("gap"))
    position = F.array_position(F.array(*[F.lit(f) for f in chosen]), F.col("feature"))
    best = leader.where(F.col("value") > 0).agg(F.min_by(
        F.struct("feature", "label", "gap"), F.struct((-F.round("gap", 9)).alias("g"), position.alias("p"))).alias("m"))
    return best.select("m.*").where(F.col("feature").isNotNull())


# Fixed value: columns of the matrix that the fifth finding speaks of.
DISPLAYED_COLUMNS = 8


def insights(df: DataFrame, label: str, features: list[str], correlated: list[str], key: str, name: str = "name",
             total: str = "funding_total_usd") -> DataFrame:
    """Up to eight ranked findings (rank, kicker, title, tone, body, label, feature) from one-row summaries.

    The table is read three times: once by label for sizes, means, gaps and the largest value, once for the
    correlations, and once for the medians of the mix (more often above the size up to which medians are taken at once).
    The row of the largest value is then looked up by that value, which the scan can skip most of a table with.
    """
    spark = df.sparkSession
    shown = correlated[:DISPLAYED_COLUMNS]
    known = label_moments(df, label, list(dict.fromkeys([*features, *shown])), total)
    overview = moments_overview(known, label)
    scored = moments_differences(known, label, features)
    ends = size_extremes(overview, label)
    clearest = rank_differences(scored, label, features, 1)
    one = spark.range(1)
    named = lambda c: F.coalesce(column_label(c), F.lit(NO_FEATURE))

    sized = overview.join(clearest, label, "left")
    about = dict(label=F.col(label), rows=format_number("rows"), share=format_percent("share"), feature=named("feature"),
                 direction=F.coalesce("direction", F.lit(NO_DIRECTION)))
    parts = [
        sized.join(ends, F.col(label) == F.col(end)).select(_finding_of(rule, F.col(label), F.col("feature"), about))
        for rule, end in (("largest", "largest"), ("smallest", "smallest"))]
    widest = separate_features(scored, label, features).orderBy(F.desc(F.round(F.abs("score"), 9)), "position").limit(1)
    parts.append(widest.select(_finding_of("widest", None, F.col("feature"), dict(
        feature=column_label("feature"), low=F.col("low_label"), high=F.col("high_label")))))
    worst = max(df.columns, key=lambda c: known.missing[c], default=None)  # the earlier column wins ties
    if worst is not None and known.missing[worst]:
        parts.append(one.select(_finding_of("missing", None, F.lit(worst), dict(
            column=column_label(F.lit(worst)), share=format_percent(F.lit(known.missing[worst] / known.rows))))))
    pair = strongest_pair(correlation_matrix(df, shown, known=(known.rows, known.counts, known.means)))
    parts.append(pair.select(_finding_of("pair", None, F.col("x"), dict(
        x=column_label("x"), y=column_label("y"), value=format_number("value", 2)))))
    parts.append(mix_story(df, label, MIX_FEATURES, known.rows).select(_finding_of(
        "mix", F.col("label"), F.col("feature"), dict(label=F.col("label"), feature=column_label("feature")))))
    if known.largest is not None:
        amount = F.col(total) if dict(df.dtypes)[total] == "double" else as_number(df, total)  # a plain column reaches the scan
        named_row = df.where(amount == F.lit(known.largest)).agg(F.min_by(F.struct(F.col(name).alias("name")), key).alias("top"))
        parts.append(named_row.select(_finding_of("largest_value", None, F.lit(total), dict(
            name=F.coalesce(F.col("top.name").cast("string"), F.lit(NO_NAME)), total=format_money(F.lit(known.largest))))))

    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select("f.*").orderBy("rank").limit(MAX_FINDINGS)


def scorecard_signals(df: DataFrame, roles: dict[str, str | None]) -> tuple[DataFrame, dict[str, Column]]:
    """The table with helper columns, and every signal as a column on it."""
    signals: dict[str, Column] = {}
    ranges = {"total": (15.0, 95.0), "rounds": (15.0, 95.0), "level": (15.0, 95.0), "date": (25.0, 85.0),
              "market": (35.0, 80.0)}
    present = {role: roles[role] for role in ranges if roles.get(role)}
    base = df
    if "market" in present:
        df = frequency_percentile(df, present["market"], "_market_pct", base)
    numbers = {role: c for role, c in present.items() if role != "market"}
    texts = {c for c, kind in base.dtypes if kind == "string"}  # amounts such as "$1.2M"
    ranked = {role: date_number(c) if role == "date" else coerce_number_suffix(c) if c in texts else as_number(base, c)
              for role, c in numbers.items()}
    df = midrank_percentiles(df, base, ranked)
    for role in present:
        signals[role] = spread_percentile(f"_{role}_pct", *ranges[role])
    df = df.withColumns({f"_s_{name}": signal for name, signal in signals.items()})
    signals = {name: F.col(f"_s_{name}") for name in signals}
    if "total" in signals:
        signals["low_total"] = F.lit(100.0) - signals["total"]
        if "rounds" in signals:
            total, rounds = signals["total"], signals["rounds"]
            signals["overheated"] = F.when((total > 85) & (rounds > 70), F.least(F.lit(95.0), (total + rounds) / 2))
    profile_column = roles.get("profile")
    kind = profile_class(F.col(profile_column) if profile_column else F.lit(""),
                         bool(profile_column) and "cluster" in profile_column.lower(), df.columns)
    df = df.withColumn("profile", kind)
    groups = {"profile": profile_scores("profile")}
    if roles.get("status"):
        groups["status"] = status_scores(roles["status"])
    if roles.get("stage"):
        groups["stage"] = stage_scores(roles["stage"])
    for prefix, scores in groups.items():
        signals |= {f"{prefix}_{name}": score for name, score in scores.items()}
    # Named once, so the five scores refer to columns instead of repeating the expressions.
    fresh = {name: s for name, s in signals.items() if f"_s_{name}" not in df.columns}
    df = df.withColumns({f"_s_{name}": signal for name, signal in fresh.items()})
    return df, {name: F.col(f"_s_{name}") for name in signals}


def row_scorecard(df: DataFrame, key: str, label: str | None = None, explain: bool = False) -> DataFrame:
    """Five rounded 0-100 scores, the profile and the mood of every row.

    Percentile tables are computed once per column and looked up, instead of sorting the column
    again for each scored row.
    """
    roles = resolve_roles(df.columns, label or detect_label(df))
    used = {c for c in roles.values() if c} | {key} | {
        c for c in ("early_stage_funding", "venture", "debt_financing", "private_equity") if c in df.columns}
    rows, signals = scorecard_signals(df.select(*[c for c in df.columns if c in used]), roles)
    scored = rows.withColumns(score_columns(signals, roles))
    scored = scored.withColumn("mood", mood_class(*SCORES))
    columns = [key, "profile", *SCORES, "mood"]
    if explain:
        scored = scored.withColumns({f"{s}_fields": signals_used(s, signals, roles) for s in SCORES})
        scored = scored.withColumns({f"{s}_why": explain_score(s, F.col(f"{s}_fields")) for s in SCORES})
        columns += [f"{s}_{x}" for s in SCORES for x in ("fields", "why")]
    return scored.select(*columns)
