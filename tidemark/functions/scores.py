"""Row-level classes and scores: status, source profile, five 0-100 scores and their readings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import column_label, format_number
from tidemark.functions.values import clip, col, dominant, round_half_up

# The status classes, in display order.
STATUS_CLASSES = ["operating", "acquired", "closed", "unknown", "other"]

# The four funding sources, in display order.
SOURCES = {
    "venture": "Venture funding",
    "debt_financing": "Debt financing",
    "private_equity": "Private equity",
    "early_stage_funding": "Early-stage funding",
}
# Order in which the profile rule breaks ties between sources.
PROFILE_SOURCES = ["early_stage_funding", "venture", "debt_financing", "private_equity"]

SCORES = ["health", "cash", "popularity", "focus", "stress"]

# Keyword rules, first match wins; the last row is the value for any other text.
STATUS_SCORES = [
    (["closed", "inactive", "failed", "dead", "shutdown", "shut down"], {"health": 5, "focus": 20, "stress": 96}),
    (["acquired", "ipo", "public"], {"health": 94, "focus": 82, "stress": 28}),
    (["active", "operating", "live"], {"health": 78, "focus": 70, "stress": 42}),
    ([], {"health": 50, "focus": 50, "stress": 50}),
]
STAGE_SCORES = [
    (["pre-seed", "pre seed", "seed", "angel", "early"],
     {"maturity": 24, "cash": 24, "popularity": 42, "focus": 28, "stress": 84}),
    (["series a"], {"maturity": 48, "cash": 54, "popularity": 62, "focus": 48, "stress": 72}),
    (["series b", "series c"], {"maturity": 68, "cash": 72, "popularity": 74, "focus": 66, "stress": 62}),
    (["series d", "series e", "late", "growth", "private equity", "buyout"],
     {"maturity": 88, "cash": 84, "popularity": 76, "focus": 84, "stress": 38}),
    (["debt", "loan", "credit"], {"maturity": 68, "cash": 68, "popularity": 46, "focus": 78, "stress": 34}),
    ([], {"maturity": 50, "cash": 50, "popularity": 50, "focus": 50, "stress": 50}),
]
PROFILE_SCORES = {
    "venture": {"cash": 64, "popularity": 82, "focus": 50, "stress": 82},
    "debt": {"cash": 68, "popularity": 42, "focus": 82, "stress": 30},
    "equity": {"cash": 88, "popularity": 56, "focus": 86, "stress": 28},
    "early": {"cash": 24, "popularity": 44, "focus": 30, "stress": 86},
}
# Words that decide the profile, first match wins.
PROFILE_WORDS = [
    ("equity", ["private equity", "buyout"]),
    ("debt", ["debt", "loan", "credit", "financing"]),
    ("venture", ["venture", "vc", "series a", "series b", "series c", "series d", "series e"]),
    ("early", ["early", "seed", "pre-seed", "angel"]),
]
PROFILE_BY_LABEL = {0: "early", 1: "debt", 2: "equity", 3: "venture"}
PROFILE_BY_SOURCE = {"private_equity": "equity", "debt_financing": "debt", "venture": "venture"}

# Signal weights (signal, weight, role) behind each score.
SIGNALS = {
    "health": [("status_health", 3.0, "status"), ("level", 1.8, "level"), ("stage_maturity", 1.3, "stage"),
               ("total", 1.1, "total"), ("rounds", 0.5, "rounds")],
    "cash": [("total", 5.0, "total"), ("level", 1.2, "level"), ("stage_cash", 1.0, "stage"),
             ("profile_cash", 1.3, "profile")],
    "popularity": [("rounds", 2.4, "rounds"), ("total", 1.5, "total"), ("market", 1.0, "market"),
                   ("date", 0.7, "date"), ("stage_popularity", 0.8, "stage"), ("profile_popularity", 0.7, "profile")],
    "focus": [("stage_focus", 2.0, "stage"), ("status_focus", 1.0, "status"), ("profile_focus", 1.8, "profile"),
              ("level", 1.5, "level")],
    "stress": [("stage_stress", 1.4, "stage"), ("profile_stress", 1.5, "profile"), ("rounds", 1.3, "rounds"),
               ("low_total", 1.2, "total"), ("date", 0.6, "date"), ("status_stress", 1.2, "status"),
               ("overheated", 0.7, "total")],
}
EXPLANATIONS = {
    "health": "Status, maturity, funding level, and funding activity were combined as simple durability signals.",
    "cash": "Funding total is the strongest signal, with level, stage, and funding profile used as smaller context clues.",
    "popularity": "Funding rounds, funding total, market frequency, recent activity, and stage are used as visibility signals.",
    "focus": "Stage, status, funding profile, and level are used as rough signals for structure and execution.",
    "stress": "Early or venture-style profiles, many rounds, low cash, recent activity, and difficult statuses increase pressure.",
}
NO_SIGNAL = "No useful dataset signal was available, so this stat started from a neutral value."


def contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def normalize_status(c: Column | str) -> Column:
    """Status class; closing words are tested before operating ones, so "inactive" is closed."""
    s = F.lower(F.trim(F.coalesce(col(c).cast("string"), F.lit(""))))
    return (
        F.when((s == "") | (s == "(missing)"), "unknown")
        .when(s.contains("acquired"), "acquired")
        .when(contains_any(s, ["closed", "inactive", "failed", "shutdown"]), "closed")
        .when(contains_any(s, ["operating", "active", "live"]), "operating")
        .otherwise("other")
    )


def _rule_scores(c: Column | str, rules: list[tuple[list[str], dict[str, int]]]) -> dict[str, Column]:
    text = F.lower(F.coalesce(col(c).cast("string"), F.lit("")))
    present = F.trim(text) != ""
    scores = {}
    for name in rules[-1][1]:
        value = F.lit(float(rules[-1][1][name]))
        for words, values in reversed(rules[:-1]):
            value = F.when(contains_any(text, words), F.lit(float(values[name]))).otherwise(value)
        scores[name] = F.when(present, value)
    return scores


def status_scores(c: Column | str) -> dict[str, Column]:
    return _rule_scores(c, STATUS_SCORES)


def stage_scores(c: Column | str) -> dict[str, Column]:
    return _rule_scores(c, STAGE_SCORES)


def profile_scores(profile: Column | str) -> dict[str, Column]:
    p = col(profile)
    scores = {}
    for name in PROFILE_SCORES["early"]:
        value = F.lit(float(PROFILE_SCORES["early"][name]))
        for kind in ("venture", "debt", "equity"):
            value = F.when(p == kind, F.lit(float(PROFILE_SCORES[kind][name]))).otherwise(value)
        scores[name] = value
    return scores


def profile_class(c: Column | str, by_label: bool, sources: list[str] | None = None) -> Column:
    """early / debt / equity / venture from words, else the label number, else the largest source."""
    text = F.trim(F.regexp_replace(F.lower(F.coalesce(col(c).cast("string"), F.lit(""))), r"\s+", " "))
    by_source = F.lit("early")
    if sources:
        name, _ = dominant([s for s in PROFILE_SOURCES if s in sources])
        for source, kind in PROFILE_BY_SOURCE.items():
            by_source = F.when(name == source, kind).otherwise(by_source)
    result = by_source
    if by_label:
        number = F.regexp_extract(text, r"^([+-]?[0-9]{1,9})", 1).try_cast("int")
        for label, kind in PROFILE_BY_LABEL.items():
            result = F.when(number == label, kind).otherwise(result)
    for kind, words in reversed(PROFILE_WORDS):
        hit = contains_any(text, words)
        if kind == "equity":
            hit = hit | (text == "pe")
        result = F.when(hit, kind).otherwise(result)
    return result


def spread_percentile(pct: Column | str, low: float = 15.0, high: float = 95.0) -> Column:
    """Stretch a percentile away from 50 into [low, high]."""
    p = col(pct)
    bend = F.signum(p - 50) * F.pow(F.abs(p - 50) / 50, F.lit(0.72))
    stretched = F.lit((low + high) / 2) + bend * F.lit((high - low) / 2)
    return F.when(p.isNotNull(), F.least(F.lit(100.0), F.greatest(F.lit(0.0), stretched)))


def weighted_mean(signals: list[tuple[Column, float]]) -> Column:
    """Weighted mean of the signals that are present, 50 when none is."""
    total = reduce(lambda a, b: a + b, [F.coalesce(clip(v, 0.0, 100.0) * F.lit(w), F.lit(0.0)) for v, w in signals])
    weight = reduce(lambda a, b: a + b, [F.when(v.isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for v, w in signals])
    return F.coalesce(F.try_divide(total, weight), F.lit(50.0))


def score_columns(signals: dict[str, Column], roles: dict[str, str | None]) -> dict[str, Column]:
    """The five rounded scores; a signal whose role has no column does not take part."""
    scores = {}
    for score, parts in SIGNALS.items():
        used = [(signals[s], w) for s, w, role in parts if roles.get(role) and s in signals]
        scores[score] = round_half_up(weighted_mean(used)) if used else F.lit(50.0)
    return scores


def signals_used(score: str, signals: dict[str, Column], roles: dict[str, str | None]) -> Column:
    """Readable names of the fields that contributed to one score, in order, without repeats."""
    names = [
        F.when(signals[s].isNotNull(), column_label(F.lit(roles[role])))
        for s, _, role in SIGNALS[score]
        if roles.get(role) and s in signals
    ]
    if not names:
        return F.array().cast("array<string>")
    return F.array_distinct(F.array_compact(F.array(*names)))


def explain_score(score: str, used: Column) -> Column:
    return F.when(F.size(used) > 0, EXPLANATIONS[score]).otherwise(NO_SIGNAL)


def mood_class(health: str, cash: str, popularity: str, focus: str, stress: str) -> Column:
    h, c, p, f, s = (F.col(x) for x in (health, cash, popularity, focus, stress))
    return (
        F.when(s >= 85, "Overwhelmed")
        .when(h <= 25, "Fragile")
        .when(c <= 25, "Worried")
        .when((p >= 75) & (s >= 70), "Excited but tired")
        .when((c >= 75) & (s <= 40), "Comfortable")
        .when((f >= 75) & (s <= 35), "Calm")
        .when((h >= 75) & (p >= 70), "Confident")
        .otherwise("Doing okay")
    )


def pulse_indexes(health: Column, cash: Column, popularity: Column, focus: Column, stress: Column) -> dict[str, Column]:
    """Four 0-100 composites; a missing score counts as 50."""
    h, c, p, f, s = (F.coalesce(x, F.lit(50.0)) for x in (health, cash, popularity, focus, stress))
    return {
        "Runway vibe": clip(c * 0.7 + f * 0.15 + (F.lit(100.0) - s) * 0.15, 0.0, 100.0),
        "Market buzz": clip(p * 0.8 + h * 0.2, 0.0, 100.0),
        "Balance": clip((h + c + f + (F.lit(100.0) - s)) / 4, 0.0, 100.0),
        "Pressure": clip(s, 0.0, 100.0),
    }


def rating(value: Column, higher_is_better: Column) -> Column:
    up = F.when(value >= 78, "Strong").when(value >= 58, "Promising").when(value >= 38, "Wobbly").otherwise("Risky")
    down = (
        F.when(value <= 25, "Chill").when(value <= 50, "Manageable").when(value <= 75, "Spicy").otherwise("Too loud")
    )
    return F.when(higher_is_better, up).otherwise(down)


def tone(value: Column, higher_is_better: Column) -> Column:
    up = F.when(value >= 70, "good").when(value >= 45, "neutral").otherwise("spicy")
    down = F.when(value <= 40, "good").when(value <= 70, "neutral").otherwise("spicy")
    return F.when(higher_is_better, up).otherwise(down)


def survival_score(health: str, cash: str, popularity: str, focus: str, stress: str) -> Column:
    return round_half_up(F.col(health) + F.col(cash) + F.col(popularity) + F.col(focus) - F.col(stress))


def score_band(total: Column) -> Column:
    return (
        F.when(total >= 300, "Thriving")
        .when(total >= 230, "Stable")
        .when(total >= 160, "Struggling")
        .otherwise("Burned out")
    )


def rounds_note(c: Column | str) -> Column:
    x = col(c)
    return (
        F.when(x.isNull(), "Not recorded")
        .when(x <= 1, "Single formal raise")
        .when(x >= 4, "Many recorded raises")
        .otherwise("Several recorded raises")
    )


def rounds_phrase(c: Column | str) -> Column:
    x = col(c)
    word = F.when(round_half_up(x) == 1, " funding round").otherwise(" funding rounds")
    return F.when(x.isNull(), "an unrecorded number of funding rounds").otherwise(
        F.concat(format_number(x, 0), word)
    )


def stage_note(c: Column | str) -> Column:
    x = col(c)
    return (
        F.when(x.isNull(), "Not recorded")
        .when(x <= 1, "Earlier maturity")
        .when(x >= 3, "Later maturity")
        .otherwise("Middle maturity")
    )


def source_note(c: Column | str) -> Column:
    x = col(c)
    return F.when(x.isNull(), "Not recorded").when(x == 0, "No recorded amount").otherwise("Recorded amount")
