"""Readable names, number formats, fixed descriptions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.templates import DESCRIBED_BY, NO_FEATURE, fill
from tidemark.functions.values import col

# Readable column names.
COLUMN_LABELS = {
    "funding_total_usd": "Total funding",
    "funding_rounds": "Funding rounds",
    "early_stage_funding": "Early-stage funding",
    "venture": "Venture funding",
    "debt_financing": "Debt financing",
    "private_equity": "Private equity",
    "stage_level": "Stage level",
    "early_stage_funding_ratio": "Early-stage share",
    "venture_ratio": "Venture share",
    "debt_financing_ratio": "Debt share",
    "private_equity_ratio": "Private equity share",
    "log_funding_total_usd": "Log total funding",
    "log_funding_rounds": "Log funding rounds",
    "log_early_stage_funding": "Log early-stage funding",
    "log_venture": "Log venture funding",
    "log_debt_financing": "Log debt financing",
    "log_private_equity": "Log private equity",
    "country_code": "Country",
    "SubCluster_Name": "Subcluster",
}

# Units by column.
USD_COLUMNS = ["funding_total_usd", "early_stage_funding", "venture", "debt_financing", "private_equity"]
PERCENT_COLUMNS = ["early_stage_funding_ratio", "venture_ratio", "debt_financing_ratio", "private_equity_ratio"]
COUNT_COLUMNS = ["funding_rounds", "stage_level"]

# Short metric names of the funding comparison.
METRIC_LABELS = {
    "funding_total_usd": "Total funding",
    "early_stage_funding": "Early-stage",
    "venture": "Venture",
    "debt_financing": "Debt",
    "private_equity": "Private equity",
}

# Readable names of the scaled features.
FEATURE_LABELS = {
    "log_funding_total_usd": "Total funding",
    "log_funding_rounds": "Funding rounds",
    "log_early_stage_funding": "Early-stage funding",
    "log_venture": "Venture funding",
    "log_debt_financing": "Debt financing",
    "log_private_equity": "Private equity",
    "stage_level": "Stage level",
    "early_stage_funding_ratio": "Early-stage ratio",
    "venture_ratio": "Venture ratio",
    "debt_financing_ratio": "Debt ratio",
    "private_equity_ratio": "Private equity ratio",
}

# Group names by label, as used in the report and as hints.
REPORT_NAMES = {
    "0": "Early-stage / low funding",
    "1": "Debt-financed startups",
    "2": "Private equity / capital intensive",
    "3": "Venture-backed growth",
}
HINT_NAMES = {
    "0": "Broad early-stage group",
    "1": "Debt-financed startups",
    "2": "Private equity profile",
    "3": "Venture-backed growth group",
}

# Group descriptions.
GROUP_TEXT = {
    "0": "The largest and most early-stage-heavy group: low median funding, usually one round, and mostly early-stage funding.",
    "1": "A mixed financing group where debt financing is much more relevant, usually alongside venture funding.",
    "2": "A small, capital-intensive group dominated by private equity and much higher median funding.",
    "3": "The clearer venture-backed growth group, with higher stage level and venture funding dominating the funding mix.",
}
SUBGROUP_TEXT = {
    "venture": "VC-backed companies that are still smaller or earlier than the main venture-growth cluster.",
    "multi": "Early-stage companies with more rounds, suggesting more traction than the simplest seed-stage profile.",
    "seed": "Small, usually one-round companies dominated by seed, angel, or grant-style funding.",
}


def map_values(c: Column | str, mapping: dict[str, str]) -> Column:
    """Dictionary lookup on the text of a column; absent keys give null."""
    c = col(c).cast("string")
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def column_label(c: Column | str) -> Column:
    """Readable name of the column named by ``c``."""
    name = col(c)
    plain = F.regexp_replace(F.regexp_replace(name, "^log_", "log "), "_", " ")
    # Only the first letter of each word changes; the rest keeps its case.
    words = F.transform(
        F.split(plain, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 20))
    )
    fallback = F.regexp_replace(F.array_join(words, " "), r"\bUsd\b", "USD")
    return F.coalesce(map_values(name, COLUMN_LABELS), fallback)


def label_of(name: str) -> str:
    """Driver-side twin of ``column_label`` for a known column name."""
    if name in COLUMN_LABELS:
        return COLUMN_LABELS[name]
    words = re.sub("^log_", "log ", name).replace("_", " ").split(" ")
    return re.sub(r"\bUsd\b", "USD", " ".join(w[:1].upper() + w[1:] for w in words))


def column_unit(c: Column | str) -> Column:
    name = col(c)
    return (
        F.when(name.isin(*USD_COLUMNS), "USD")
        .when(name.isin(*PERCENT_COLUMNS), "%")
        .when(name.isin(*COUNT_COLUMNS), "count")
        .when(name.startswith("log_"), "log")
        .otherwise("")
    )


def column_unit_label(c: Column | str) -> Column:
    unit = column_unit(c)
    return (
        F.when(unit == "", "").when(unit == "log", "(log-scale)").otherwise(F.concat(F.lit("("), unit, F.lit(")")))
    )


def _is_finite(x: Column) -> Column:
    return F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))


def _grouped(x: Column, digits: int) -> Column:
    # Round half away from zero first: format_number alone rounds ties to even.
    return F.format_number(F.round(x, digits), digits)


def format_number(c: Column | str, digits: int = 0) -> Column:
    x = col(c).cast("double")
    return F.when(_is_finite(x), _grouped(x, digits)).otherwise("n/a")


def format_percent(c: Column | str, digits: int = 1) -> Column:
    x = col(c).cast("double")
    return F.when(_is_finite(x), F.concat(_grouped(x * 100, digits), F.lit("%"))).otherwise("n/a")


def _money_ladder(x: Column) -> Column:
    size = F.abs(x)
    return (
        F.when(size >= 1e9, F.concat(F.lit("$"), _grouped(x / 1e9, 2), F.lit("B")))
        .when(size >= 1e6, F.concat(F.lit("$"), _grouped(x / 1e6, 2), F.lit("M")))
        .when(size >= 1e3, F.concat(F.lit("$"), _grouped(x / 1e3, 1), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), _grouped(x, 0)))
    )


def format_money(c: Column | str, absent: str = "n/a") -> Column:
    """``$1.25B``, ``$3.40M``, ``$7.5K``, ``$12``; ``absent`` where there is no finite value."""
    x = col(c).cast("double")
    return F.when(_is_finite(x), _money_ladder(x)).otherwise(absent)


def format_compact(c: Column | str) -> Column:
    """At most one decimal and a K/M/B/T suffix."""
    x = col(c).cast("double")
    size = F.abs(x)

    def scaled(unit: float, suffix: str) -> Column:
        v = F.round(x / unit, 1)
        text = F.when(v == F.floor(v), F.format_string("%.0f", v)).otherwise(F.format_string("%.1f", v))
        return F.concat(text, F.lit(suffix))

    # 999.95 rounds to 1000.0 and so already belongs to the next unit.
    return (
        F.when(~_is_finite(x), "n/a")
        .when(size >= 999.95e9, scaled(1e12, "T"))
        .when(size >= 999.95e6, scaled(1e9, "B"))
        .when(size >= 999.95e3, scaled(1e6, "M"))
        .when(size >= 999.95, scaled(1e3, "K"))
        .otherwise(scaled(1.0, ""))
    )


def format_feature(feature: Column | str, value: Column | str) -> Column:
    """Format chosen by the feature's unit."""
    feature = col(feature)
    return (
        F.when(feature.isin(*USD_COLUMNS), format_money(value))
        .when(feature.endswith("_ratio"), format_percent(value))
        .otherwise(format_number(value, 1))
    )


def group_text(label: Column | str, top_feature: Column | str) -> Column:
    fallback = fill(DESCRIBED_BY, feature=F.coalesce(column_label(top_feature), F.lit(NO_FEATURE)))
    return F.coalesce(map_values(label, GROUP_TEXT), fallback)


def subgroup_text(label: Column | str, top_feature: Column | str) -> Column:
    name = F.lower(col(label).cast("string"))
    text = fill(DESCRIBED_BY, feature=F.coalesce(column_label(top_feature), F.lit(NO_FEATURE)))
    # The first matching word wins, in the order of the table.
    for word, sentence in reversed(SUBGROUP_TEXT.items()):
        text = F.when(name.contains(word), sentence).otherwise(text)
    return text
