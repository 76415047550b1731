"""The batch preparation: raw records to model features, and the fitted main segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.values import coerce_number, ladder_level, log1p, safe_ratio, sum_parts
from tidemark.operators.cleaning import (
    drop_all_zero,
    drop_duplicates,
    drop_empty_rows,
    drop_missing_key,
    prune_sparse_columns,
)
from tidemark.operators.components import fit_components, project
from tidemark.operators.kmeans import kmeans_fit, label_rows
from tidemark.operators.scaling import apply_scale, fit_scale
from tidemark.operators.schema import MODEL_FEATURES, drop_columns, normalize_headers
from tidemark.session import cut_lineage

# Columns left out, ladder, amounts, parts, sources and logged columns.
IRRELEVANT = ["permalink", "homepage_url", "state_code", "region", "founded_month", "founded_quarter", "founded_year"]
LADDER = ["round_A", "round_B", "round_C", "round_D", "round_E", "round_F", "round_G", "round_H"]
AMOUNTS = ["seed", "venture", "debt_financing", "angel", "grant", "private_equity"]
EARLY_PARTS = ["seed", "angel", "grant"]
SOURCES = ["early_stage_funding", "venture", "debt_financing", "private_equity"]
LOGGED = ["funding_total_usd", "funding_rounds", "early_stage_funding", "venture", "debt_financing", "private_equity"]
TOTAL = "funding_total_usd"


def derive(df: DataFrame) -> DataFrame:
    """Early-stage sum, clipped ratios and logs; the summed parts are dropped."""
    df = df.withColumn("early_stage_funding", sum_parts(*EARLY_PARTS)).drop(*EARLY_PARTS)
    return df.withColumns({
        **{f"{c}_ratio": safe_ratio(c, TOTAL) for c in SOURCES},
        **{f"log_{c}": log1p(c) for c in LOGGED},
    })


def prepare(raw: DataFrame, prune: bool = False) -> DataFrame:
    """Cleaning and features in one lazy plan. The only shuffle of its own is the row distinct.

    ``prune`` adds the data-driven column drop, which takes one aggregate job to decide.
    """
    df = drop_empty_rows(drop_columns(normalize_headers(raw), IRRELEVANT))
    df = df.withColumn("stage_level", ladder_level(LADDER, df.columns))
    df = drop_columns(df, LADDER)
    if prune:
        df = prune_sparse_columns(df)
    if dict(df.dtypes).get(TOTAL) == "string":
        df = df.withColumn(TOTAL, coerce_number(TOTAL))
    df = drop_missing_key(df, ["name"])
    df = drop_duplicates(df)
    df = drop_missing_key(df, [TOTAL, "market"])
    return derive(drop_all_zero(df, AMOUNTS))


def main_segments(prepared: DataFrame, key: str, k: int = 4, components: int = 3, starts: int = 10,
                  label: str = "Cluster") -> DataFrame:
    """Robust scale, principal components, K-Means on the scores.

    The fits read a narrow written table; the labels are then a projection of the full one.
    """
    complete = prepared.dropna("any", subset=MODEL_FEATURES)
    scale = fit_scale(complete, MODEL_FEATURES)
    scaled = cut_lineage(apply_scale(complete, scale, [key]))
    model = fit_components(scaled, MODEL_FEATURES, components)
    names = [f"PC{i + 1}" for i in range(components)]
    centers = kmeans_fit(project(scaled, model, [key]), names, k, starts=starts)
    return label_rows(complete, scale, centers, label, model)
