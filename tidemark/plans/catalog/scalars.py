"""Row-level operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scores as S
from tidemark.functions.text import (
    format_compact,
    format_feature,
    format_money,
    format_number,
    format_percent,
)
from tidemark.functions.values import (
    clip,
    dominant,
    ladder_level,
    log1p,
    DATE_FORMATS,
    date_formats,
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
from tidemark.plans.catalog.registry import PREP, RAW, STAGE_SQL, query, rounded, union_sql
from tidemark.plans.preparation import LADDER, LOGGED, SOURCES
from tidemark.plans.records import labelled_records, raw_records, table

SOURCE_ORDER = list(S.SOURCES)


@query("stage_level", f"""WITH {RAW} SELECT record_id, CAST({STAGE_SQL} AS INTEGER) AS stage_level,
CAST(CASE WHEN round_F > 0 THEN 6 WHEN round_C > 0 THEN 3 WHEN round_A > 0 THEN 1 ELSE 0 END AS INTEGER) AS gapped_level
FROM raw""")
def _stage_level(spark, sf_dir):
    return raw_records(spark, sf_dir).select(
        "record_id", ladder_level(LADDER).alias("stage_level"),
        ladder_level(LADDER, ["round_A", "round_C", "round_F"]).alias("gapped_level"))


@query("sum_parts", f"""WITH {RAW} SELECT record_id, round(seed + angel + "grant", 4) AS early_stage_funding,
CASE WHEN status <> 'closed' THEN round(seed + angel + "grant", 4) END AS with_gap FROM raw""")
def _sum_parts(spark, sf_dir):
    gap = F.when(F.col("status") != "closed", F.col("angel"))
    return rounded(raw_records(spark, sf_dir).select(
        "record_id", sum_parts("seed", "angel", "grant").alias("early_stage_funding"),
        sum_parts(F.col("seed"), gap, F.col("grant")).alias("with_gap")), 4)


_TOTAL = "CASE status WHEN 'closed' THEN 0 WHEN 'acquired' THEN NULL ELSE funding_total_usd END"



def _holed_total():
    return F.when(F.col("status") == "closed", 0.0).when(F.col("status") == "operating", F.col("funding_total_usd"))


@query("safe_ratio", f"""WITH {RAW}, t AS (SELECT *, {_TOTAL} AS total FROM raw) SELECT record_id,
round(CASE WHEN total IS NULL OR total = 0 THEN 0 ELSE least(1, greatest(0, venture / total)) END, 9) AS venture_ratio FROM t""")
def _safe_ratio(spark, sf_dir):
    df = raw_records(spark, sf_dir).withColumn("total", _holed_total())
    return rounded(df.select("record_id", safe_ratio("venture", "total").alias("venture_ratio")), 9)


@query("raw_share", f"""WITH {RAW}, t AS (SELECT *, {_TOTAL} AS total FROM raw) SELECT record_id,
round(CASE WHEN total > 0 THEN venture / total ELSE 0 END, 9) AS venture_share FROM t""")
def _raw_share(spark, sf_dir):
    df = raw_records(spark, sf_dir).withColumn("total", _holed_total())
    return rounded(df.select("record_id", raw_share("venture", "total").alias("venture_share")), 9)


@query("clip", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal > 5000 THEN 5000 ELSE c_acctbal END AS bounded
FROM customer""")
def _clip(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", clip("c_acctbal", 0.0, 5000.0).alias("bounded"))


@query("log1p_features", f"WITH {PREP} SELECT record_id, " + ", ".join(
    f"round(ln(1 + {c}), 9) AS log_{c}" for c in LOGGED) + " FROM prep")
def _log1p_features(spark, sf_dir):
    return rounded(labelled_records(spark, sf_dir).select("record_id", *[log1p(c).alias(f"log_{c}") for c in LOGGED]), 9)


@query("round_half_even", "SELECT event_id, round_even(value / 4, 1) AS tenths, round_even(CAST(floor(value) AS DOUBLE) / 2, 0) AS halves FROM events")
def _round_half_even(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", round_half_even(F.col("value") / 4, 1).alias("tenths"),
        round_half_even(F.floor("value").cast("double") / 2, 0).alias("halves"))


@query("round_half_up_js", "SELECT c_custkey, floor(floor(c_acctbal) / 2 + 0.5) AS halves FROM customer")
def _round_half_up(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", round_half_up(F.floor("c_acctbal") / 2).alias("halves"))


def money_sql(x: str, absent: str = "n/a") -> str:
    return (f"CASE WHEN {x} IS NULL THEN '{absent}' WHEN abs({x}) >= 1e9 THEN '$' || format('{{:,.2f}}', round({x} / 1e9, 2)) || 'B' "
            f"WHEN abs({x}) >= 1e6 THEN '$' || format('{{:,.2f}}', round({x} / 1e6, 2)) || 'M' "
            f"WHEN abs({x}) >= 1e3 THEN '$' || format('{{:,.1f}}', round({x} / 1e3, 1)) || 'K' "
            f"ELSE '$' || format('{{:,.0f}}', round({x}, 0)) END")


def number_sql(x: str, digits: int = 0) -> str:
    return f"coalesce(format('{{:,.{digits}f}}', round(CAST({x} AS DOUBLE), {digits})), 'n/a')"


def percent_sql(x: str, digits: int = 1) -> str:
    return f"coalesce(format('{{:,.{digits}f}}', round(({x}) * 100, {digits})) || '%', 'n/a')"


@query("format_money", f"""WITH {PREP}, v AS (SELECT record_id, CASE status WHEN 'closed' THEN venture * 37
WHEN 'acquired' THEN venture * 40111 ELSE nullif(venture, 0) END AS x FROM prep)
SELECT record_id, {money_sql('x')} AS page, {money_sql('x', '')} AS report, {money_sql('(x / 1e5)')} AS small FROM v""")
def _format_money(spark, sf_dir):
    x = F.when(F.col("status") == "closed", F.col("venture") * 37).when(
        F.col("status") == "acquired", F.col("venture") * 40111).otherwise(F.nullif("venture", F.lit(0.0)))
    df = labelled_records(spark, sf_dir).select("record_id", x.alias("x"))
    return df.select("record_id", format_money("x").alias("page"), format_money("x", "").alias("report"),
                     format_money(F.col("x") / 1e5).alias("small"))


@query("format_number_percent", f"""WITH {PREP} SELECT record_id, {number_sql('nullif(venture, 0)', 1)} AS number,
{percent_sql('venture_ratio')} AS pct, {number_sql('funding_rounds')} AS rounds,
{money_sql('venture')} || ' | ' || {percent_sql('venture_ratio')} || ' | ' || {number_sql('stage_level', 1)} AS by_feature FROM prep""")
def _format_number_percent(spark, sf_dir):
    by_feature = F.concat_ws(" | ", *[format_feature(F.lit(f), f) for f in ("venture", "venture_ratio", "stage_level")])
    return labelled_records(spark, sf_dir).select(
        "record_id", format_number(F.nullif("venture", F.lit(0.0)), 1).alias("number"),
        format_percent("venture_ratio").alias("pct"), format_number("funding_rounds").alias("rounds"),
        by_feature.alias("by_feature"))


def compact_sql(x: str) -> str:
    def scaled(unit: str, suffix: str) -> str:
        v = f"round(({x}) / {unit}, 1)"
        return f"CASE WHEN {v} = floor({v}) THEN format('{{:.0f}}', {v}) ELSE format('{{:.1f}}', {v}) END || '{suffix}'"

    return (f"CASE WHEN {x} IS NULL THEN 'n/a' WHEN abs({x}) >= 999.95e9 THEN {scaled('1e12', 'T')} "
            f"WHEN abs({x}) >= 999.95e6 THEN {scaled('1e9', 'B')} WHEN abs({x}) >= 999.95e3 THEN {scaled('1e6', 'M')} "
            f"WHEN abs({x}) >= 999.95 THEN {scaled('1e3', 'K')} ELSE {scaled('1', '')} END")


@query("format_compact", f"""WITH v AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice * 1e4
WHEN '2-HIGH' THEN o_totalprice * 1e8 WHEN '3-MEDIUM' THEN o_totalprice / 1e3 WHEN '5-LOW' THEN o_totalprice END AS x FROM orders)
SELECT o_orderkey, {compact_sql('x')} AS text FROM v""")
def _format_compact(spark, sf_dir):
    kind, total = F.col("o_orderpriority"), F.col("o_totalprice")
    x = F.when(kind == "1-URGENT", total * 1e4).when(kind == "2-HIGH", total * 1e8).when(
        kind == "3-MEDIUM", total / 1e3).when(kind == "5-LOW", total)
    df = table(spark, sf_dir, "orders").select("o_orderkey", x.alias("x"))
    return df.select("o_orderkey", format_compact("x").alias("text"))


# Status texts in several spellings, chosen by priority and status.
_STATUS_SQL = ("CASE o_orderpriority WHEN '1-URGENT' THEN ' Inactive' WHEN '2-HIGH' THEN 'LIVE' WHEN '3-MEDIUM' THEN "
               "CASE o_orderstatus WHEN 'O' THEN 'Acquired' WHEN 'F' THEN 'ipo' ELSE ' ' END "
               "WHEN '5-LOW' THEN 'shutdown' END")


def _status_text():
    kind = F.col("o_orderpriority")
    inner = F.when(F.col("o_orderstatus") == "O", "Acquired").when(F.col("o_orderstatus") == "F", "ipo").otherwise(" ")
    return F.when(kind == "1-URGENT", " Inactive").when(kind == "2-HIGH", "LIVE").when(kind == "3-MEDIUM", inner).when(
        kind == "5-LOW", "shutdown")


@query("normalize_status", f"""SELECT o_orderkey, CASE trim(coalesce({_STATUS_SQL}, '')) WHEN 'Inactive' THEN 'closed'
WHEN 'LIVE' THEN 'operating' WHEN 'Acquired' THEN 'acquired' WHEN 'ipo' THEN 'other' WHEN 'shutdown' THEN 'closed'
ELSE 'unknown' END AS status FROM orders""")
def _normalize_status(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", S.normalize_status(_status_text()).alias("status"))


_TOP_SQL = ("CASE WHEN greatest(venture, debt_financing, private_equity, early_stage_funding) <= 0 THEN NULL "
            + " ".join(f"WHEN {c} = greatest(venture, debt_financing, private_equity, early_stage_funding) THEN '{c}'"
                       for c in SOURCE_ORDER) + " END")


@query("dominant_source", f"""WITH {PREP} SELECT record_id, {_TOP_SQL} AS source,
greatest(venture, debt_financing, private_equity, early_stage_funding) AS amount FROM prep""")
def _dominant_source(spark, sf_dir):
    name, amount = dominant(SOURCE_ORDER)
    return labelled_records(spark, sf_dir).select("record_id", name.alias("source"), amount.alias("amount"))


@query("zero_source_count", f"WITH {PREP} SELECT record_id, CAST(" + " + ".join(
    f"CASE WHEN {c} = 0 THEN 1 ELSE 0 END" for c in SOURCE_ORDER) + " AS INTEGER) AS zero_sources FROM prep")
def _zero_source_count(spark, sf_dir):
    return labelled_records(spark, sf_dir).select("record_id", zero_count(SOURCE_ORDER).alias("zero_sources"))


@query("band_notes", f"""WITH {RAW}, v AS (SELECT record_id, CASE WHEN market IS NOT NULL THEN funding_rounds END AS r,
CAST({STAGE_SQL} AS INTEGER) AS s, CASE WHEN category_list IS NOT NULL THEN venture END AS a FROM raw) SELECT record_id,
CASE WHEN r IS NULL THEN 'Not recorded' WHEN r <= 1 THEN 'Single formal raise' WHEN r >= 4 THEN 'Many recorded raises'
ELSE 'Several recorded raises' END AS rounds_note,
CASE WHEN r IS NULL THEN 'an unrecorded number of funding rounds' WHEN r = 1 THEN '1 funding round'
ELSE r || ' funding rounds' END AS rounds_phrase,
CASE WHEN s <= 1 THEN 'Earlier maturity' WHEN s >= 3 THEN 'Later maturity' ELSE 'Middle maturity' END AS stage_note,
CASE WHEN a IS NULL THEN 'Not recorded' WHEN a = 0 THEN 'No recorded amount' ELSE 'Recorded amount' END AS source_note FROM v""")
def _band_notes(spark, sf_dir):
    df = raw_records(spark, sf_dir).select(
        "record_id", F.when(F.col("market").isNotNull(), F.col("funding_rounds")).alias("r"),
        ladder_level(LADDER).alias("s"), F.when(F.col("category_list").isNotNull(), F.col("venture")).alias("a"))
    return df.select("record_id", S.rounds_note("r").alias("rounds_note"), S.rounds_phrase("r").alias("rounds_phrase"),
                     S.stage_note("s").alias("stage_note"), S.source_note("a").alias("source_note"))


_BY_SOURCE = "CASE \"Cluster\" WHEN '1' THEN 'debt' WHEN '2' THEN 'equity' WHEN '3' THEN 'venture' ELSE 'early' END"


@query("profile_class", f"""WITH {PREP} SELECT record_id, {_BY_SOURCE} AS by_label, {_BY_SOURCE} AS by_source,
CASE WHEN category_list = '1-URGENT' THEN 'equity' WHEN category_list = '2-HIGH' THEN 'debt' WHEN category_list = '3-MEDIUM'
THEN 'venture' WHEN category_list = '5-LOW' THEN 'early' ELSE {_BY_SOURCE} END AS by_words FROM prep""")
def _profile_class(spark, sf_dir):
    kind = F.col("category_list")
    words = F.when(kind == "1-URGENT", "Private   Equity").when(kind == "2-HIGH", "Loan financing").when(
        kind == "3-MEDIUM", "Series B").when(kind == "5-LOW", "angel").otherwise("x")
    return labelled_records(spark, sf_dir).select(
        "record_id", S.profile_class("Cluster", True).alias("by_label"),
        S.profile_class(F.lit("none"), False, SOURCES).alias("by_source"),
        S.profile_class(words, True, SOURCES).alias("by_words"))


@query("status_scores", f"""WITH v AS (SELECT o_orderkey, trim(coalesce({_STATUS_SQL}, '')) AS s FROM orders) SELECT o_orderkey,
CAST(CASE s WHEN '' THEN NULL WHEN 'Inactive' THEN 5 WHEN 'shutdown' THEN 5 WHEN 'Acquired' THEN 94 WHEN 'ipo' THEN 94 ELSE 78 END AS DOUBLE) AS health,
CAST(CASE s WHEN '' THEN NULL WHEN 'Inactive' THEN 20 WHEN 'shutdown' THEN 20 WHEN 'Acquired' THEN 82 WHEN 'ipo' THEN 82 ELSE 70 END AS DOUBLE) AS focus,
CAST(CASE s WHEN '' THEN NULL WHEN 'Inactive' THEN 96 WHEN 'shutdown' THEN 96 WHEN 'Acquired' THEN 28 WHEN 'ipo' THEN 28 ELSE 42 END AS DOUBLE) AS stress FROM v""")
def _status_scores(spark, sf_dir):
    scores = S.status_scores(_status_text())
    return table(spark, sf_dir, "orders").select("o_orderkey", *[c.alias(n) for n, c in scores.items()])


_STAGE_CASES = {"1-URGENT": "Pre-Seed", "2-HIGH": "Series A", "3-MEDIUM": "series c", "4-NOT SPECIFIED": "Late growth", "5-LOW": "loan"}
_STAGE_VALUES = {"1-URGENT": (24, 24, 42, 28, 84), "2-HIGH": (48, 54, 62, 48, 72), "3-MEDIUM": (68, 72, 74, 66, 62),
                 "4-NOT SPECIFIED": (88, 84, 76, 84, 38), "5-LOW": (68, 68, 46, 78, 34)}


@query("stage_scores", "SELECT o_orderkey, " + ", ".join(
    "CAST(CASE WHEN o_orderstatus = 'P' THEN 50 ELSE CASE o_orderpriority "
    + " ".join(f"WHEN '{k}' THEN {v[i]}" for k, v in _STAGE_VALUES.items()) + f" END END AS DOUBLE) AS {name}"
    for i, name in enumerate(["maturity", "cash", "popularity", "focus", "stress"])) + " FROM orders")
def _stage_scores(spark, sf_dir):
    text = F.lit("bridge")
    for priority, stage in _STAGE_CASES.items():
        text = F.when((F.col("o_orderpriority") == priority) & (F.col("o_orderstatus") != "P"), stage).otherwise(text)
    df = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("stage"))
    return df.select("o_orderkey", *[c.alias(n) for n, c in S.stage_scores("stage").items()])


@query("profile_scores", f"WITH {PREP} SELECT record_id, " + ", ".join(
    "CAST(CASE \"Cluster\" WHEN '1' THEN {debt} WHEN '2' THEN {equity} WHEN '3' THEN {venture} ELSE {early} END AS DOUBLE) AS {name}"
    .format(name=n, **{k: v[n] for k, v in S.PROFILE_SCORES.items()}) for n in ("cash", "popularity", "focus", "stress"))
    + " FROM prep")
def _profile_scores(spark, sf_dir):
    df = labelled_records(spark, sf_dir).select("record_id", S.profile_class("Cluster", True).alias("profile"))
    return df.select("record_id", *[c.alias(n) for n, c in S.profile_scores("profile").items()])


def spread_sql(p: str, low: int, high: int) -> str:
    mid, half = (low + high) / 2, (high - low) / 2
    return f"least(100.0::DOUBLE, greatest(0.0::DOUBLE, {mid} + sign({p} - 50) * pow(abs({p} - 50) / 50, 0.72::DOUBLE) * {half}))"


@query("spread_percentile", f"""WITH v AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN least(100, greatest(0, value)) END AS p FROM events) SELECT event_id, CASE WHEN p IS NOT NULL THEN round({spread_sql('p', 15, 95)}, 6) END AS wide,
CASE WHEN p IS NOT NULL THEN round({spread_sql('p', 35, 80)}, 6) END AS narrow FROM v""")
def _spread_percentile(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", clip("value", 0.0, 100.0)).alias("p"))
    return rounded(df.select("event_id", S.spread_percentile("p").alias("wide"),
                             S.spread_percentile("p", 35.0, 80.0).alias("narrow")))


# Three signals with gaps, and rounded scores standing in for the five.
_SIGNAL_SQL = ("v AS (SELECT record_id, CASE WHEN status <> 'closed' THEN least(100, funding_total_usd / 5000) END AS a, "
               "CASE WHEN market IS NOT NULL THEN 10.0 * funding_rounds END AS b, "
               "CASE WHEN category_list IS NOT NULL AND status <> 'closed' THEN least(100, venture / 2000) END AS c FROM raw)")


def _signals(spark, sf_dir):
    live = F.col("status") != "closed"
    return raw_records(spark, sf_dir).select(
        "record_id", F.when(live, F.least(F.lit(100.0), F.col("funding_total_usd") / 5000)).alias("a"),
        F.when(F.col("market").isNotNull(), F.col("funding_rounds") * 10.0).alias("b"),
        F.when(F.col("category_list").isNotNull() & live, F.least(F.lit(100.0), F.col("venture") / 2000)).alias("c"))


@query("weighted_signals", f"""WITH {RAW}, {_SIGNAL_SQL} SELECT record_id, round(CASE WHEN coalesce(a, b, c) IS NULL THEN 50 ELSE
(coalesce(a, 0) * 3 + CASE WHEN b IS NULL THEN 0 ELSE least(b, 100) END * 1.8 + coalesce(c, 0) * 0.5) /
(CASE WHEN a IS NULL THEN 0 ELSE 3 END + CASE WHEN b IS NULL THEN 0 ELSE 1.8 END + CASE WHEN c IS NULL THEN 0 ELSE 0.5 END)
END::DOUBLE, 9) AS score FROM v""")
def _weighted_signals(spark, sf_dir):
    mean = S.weighted_mean([(F.col("a"), 3.0), (F.col("b"), 1.8), (F.col("c"), 0.5)])
    return rounded(_signals(spark, sf_dir).select("record_id", mean.alias("score")), 9)


@query("signals_used", f"""WITH {RAW}, {_SIGNAL_SQL} SELECT record_id, concat_ws(', ', CASE WHEN a IS NOT NULL THEN 'Total funding' END,
CASE WHEN b IS NOT NULL THEN 'Stage level' END, CASE WHEN c IS NOT NULL AND a IS NULL THEN 'Total funding' END) AS used,
CASE WHEN coalesce(a, b, c) IS NULL THEN '{S.NO_SIGNAL}' ELSE '{S.EXPLANATIONS["cash"]}' END AS why FROM v""")
def _signals_used(spark, sf_dir):
    df = _signals(spark, sf_dir)
    # Two signals of the same field, listed once.
    used = S.signals_used("cash", {"total": F.coalesce("a", "c"), "level": F.col("b"), "profile_cash": F.col("c")},
                          {"total": "funding_total_usd", "level": "stage_level", "profile": "funding_total_usd"})
    return df.select("record_id", F.array_join(used, ", ").alias("used"), S.explain_score("cash", used).alias("why"))


_FIVE_SQL = ("v AS (SELECT record_id, CAST(floor(funding_total_usd / 5000) AS BIGINT) % 101 AS health, "
             "CAST(floor(venture / 977) AS BIGINT) % 101 AS cash, CAST(funding_rounds * 13 AS BIGINT) % 101 AS popularity, "
             "CAST(floor(early_stage_funding / 1013) AS BIGINT) % 101 AS focus, "
             "CAST(floor(funding_total_usd / 997) AS BIGINT) % 101 AS stress FROM prep)")


def _five(spark, sf_dir):
    return labelled_records(spark, sf_dir).select(
        "record_id", (F.floor(F.col("funding_total_usd") / 5000) % 101).alias("health"),
        (F.floor(F.col("venture") / 977) % 101).alias("cash"), (F.col("funding_rounds") * 13 % 101).alias("popularity"),
        (F.floor(F.col("early_stage_funding") / 1013) % 101).alias("focus"),
        (F.floor(F.col("funding_total_usd") / 997) % 101).alias("stress"))


@query("mood_class", f"""WITH {PREP}, {_FIVE_SQL} SELECT record_id, CASE WHEN stress >= 85 THEN 'Overwhelmed' WHEN health <= 25 THEN 'Fragile'
WHEN cash <= 25 THEN 'Worried' WHEN popularity >= 75 AND stress >= 70 THEN 'Excited but tired' WHEN cash >= 75 AND stress <= 40
THEN 'Comfortable' WHEN focus >= 75 AND stress <= 35 THEN 'Calm' WHEN health >= 75 AND popularity >= 70 THEN 'Confident'
ELSE 'Doing okay' END AS mood FROM v""")
def _mood_class(spark, sf_dir):
    return _five(spark, sf_dir).select("record_id", S.mood_class(*S.SCORES).alias("mood"))


_PULSE = {"Runway vibe": "cash * 0.7 + focus * 0.15 + (100 - stress) * 0.15", "Market buzz": "popularity * 0.8 + health * 0.2",
          "Balance": "(health + cash + focus + (100 - stress)) / 4.0", "Pressure": "stress"}


def _pulse_sql() -> str:
    parts = []
    for name, x in _PULSE.items():
        v = f"CAST({x} AS DOUBLE)"
        if name == "Pressure":
            rating = f"CASE WHEN {v} <= 25 THEN 'Chill' WHEN {v} <= 50 THEN 'Manageable' WHEN {v} <= 75 THEN 'Spicy' ELSE 'Too loud' END"
            tone = f"CASE WHEN {v} <= 40 THEN 'good' WHEN {v} <= 70 THEN 'neutral' ELSE 'spicy' END"
        else:
            rating = (f"CASE WHEN round({v}, 6) >= 78 THEN 'Strong' WHEN round({v}, 6) >= 58 THEN 'Promising' "
                      f"WHEN round({v}, 6) >= 38 THEN 'Wobbly' ELSE 'Risky' END")
            tone = f"CASE WHEN round({v}, 6) >= 70 THEN 'good' WHEN round({v}, 6) >= 45 THEN 'neutral' ELSE 'spicy' END"
        parts.append(f"SELECT record_id, '{name}' AS label, round({v}, 6) AS score, {rating} AS rating, {tone} AS tone FROM v")
    return f"WITH {PREP}, {_FIVE_SQL} " + " UNION ALL ".join(parts)


@query("pulse_index", _pulse_sql())
def _pulse_index(spark, sf_dir):
    indexes = S.pulse_indexes(*[F.col(c).cast("double") for c in S.SCORES])
    cells = F.array(*[F.struct(F.lit(n).alias("label"), F.round(v, 6).alias("score")) for n, v in indexes.items()])
    up = F.col("label") != "Pressure"
    return _five(spark, sf_dir).select("record_id", F.inline(cells)).select(
        "record_id", "label", "score", S.rating(F.col("score"), up).alias("rating"), S.tone(F.col("score"), up).alias("tone"))


@query("score_band", f"""WITH {PREP}, {_FIVE_SQL}, t AS (SELECT record_id, CAST(health + cash + popularity + focus - stress AS DOUBLE) AS total FROM v)
SELECT record_id, total, CASE WHEN total >= 300 THEN 'Thriving' WHEN total >= 230 THEN 'Stable' WHEN total >= 160 THEN 'Struggling'
ELSE 'Burned out' END AS band FROM t""")
def _score_band(spark, sf_dir):
    df = _five(spark, sf_dir).select("record_id", S.survival_score(*S.SCORES).alias("total"))
    return df.withColumn("band", S.score_band(F.col("total")))


@query("parse_date_text", """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN CAST(date_trunc('month', o_orderdate) AS DATE)
WHEN 'F' THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")
def _parse_date_text(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM")).when(
        F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "yyyy-13-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_date_text(text).alias("day"))


# Order dates as a file may have them, month first; the first twelve days of a month can be read in two ways.
_DATED = "(SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate, '%-m/%-d/%Y') END AS t FROM orders)"


def _dated(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.date_format("o_orderdate", "M/d/yyyy")).alias("t"))


@query("date_formats", f"""SELECT n AS format, CASE n WHEN 'month_first' THEN count(t) WHEN 'day_first' THEN count(t) FILTER (WHERE day(o_orderdate) <= 12) ELSE 0 END AS "rows",
count(t) AS "of" FROM {_DATED}, (SELECT unnest([{', '.join(repr(n) for n in DATE_FORMATS)}]) AS n) GROUP BY n""")
def _date_formats(spark, sf_dir):
    return date_formats(_dated(spark, sf_dir), "t")


@query("parse_dates", f"SELECT o_orderkey, CASE WHEN t IS NOT NULL THEN CAST(o_orderdate AS DATE) END AS day FROM {_DATED}")
def _parse_dates(spark, sf_dir):
    df = _dated(spark, sf_dir)
    return df.select("o_orderkey", parse_date_as("t", infer_date_format(df, "t")[0]).alias("day"))
