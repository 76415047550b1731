"""Outlier-robust scaling: fit to a small model table, apply as plain column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import as_number, clip
from tidemark.operators.order import QUARTILES, SMALL_ROWS, exact_quantiles

# Fixed value: bound of scaled values in the fallback rule.
SCALED_BOUND = 8.0


@dataclass(frozen=True)
class Scale:
    """Centre and scale per feature; ``bound`` clips, ``fill_centre`` puts a missing value at the centre."""

    features: tuple[str, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    bound: float | None = None
    fill_centre: bool = False

    def table(self, spark) -> DataFrame:
        rows = [F.struct(F.lit(f).alias("feature"), F.lit(float(c)).alias("center"), F.lit(float(s)).alias("scale"))
                for f, c, s in zip(self.features, self.centre, self.scale)]
        return spark.range(1).select(F.inline(F.array(*rows)))


def scale_table(df: DataFrame, features: list[str], fallback: bool = False, small_rows: int = SMALL_ROWS) -> DataFrame:
    """(feature, center, scale): median and IQR; an IQR of 0 becomes 1.

    With ``fallback`` an IQR of 0 becomes the population deviation, and only then 1.
    """
    quartiles = exact_quantiles(df, features, QUARTILES, small_rows=small_rows)
    iqr = F.col("q3") - F.col("q1")
    if fallback:
        stds = df.agg(*[F.stddev_pop(as_number(df, f)).alias(f"s{i}") for i, f in enumerate(features)])
        stds = stds.select(F.inline(F.array(*[
            F.struct(F.lit(f).alias("feature"), F.col(f"s{i}").alias("std")) for i, f in enumerate(features)])))
        quartiles = quartiles.join(stds, "feature")
        scale = F.when(iqr != 0, iqr).when(F.col("std") > 0, F.col("std")).otherwise(F.lit(1.0))
    else:
        scale = F.when(iqr != 0, iqr).otherwise(F.lit(1.0))
    return quartiles.select("feature", F.coalesce("median", F.lit(0.0)).alias("center"), scale.alias("scale"))


def fit_scale(df: DataFrame, features: list[str], fallback: bool = False, small_rows: int = SMALL_ROWS) -> Scale:
    """``scale_table`` as literals: one row per feature reaches the driver."""
    rows = {r["feature"]: r for r in scale_table(df, features, fallback, small_rows).collect()}
    return Scale(tuple(features), tuple(rows[f]["center"] for f in features), tuple(rows[f]["scale"] for f in features))


def scaled_columns(df: DataFrame, model: Scale, names: list[str] | None = None) -> list[Column]:
    """The scaled features under their own names, or under the given ones."""
    columns = []
    names = names or list(model.features)
    for feature, centre, scale, name in zip(model.features, model.centre, model.scale, names):
        x = as_number(df, feature)
        if model.fill_centre:
            x = F.coalesce(x, F.lit(float(centre)))
        z = (x - F.lit(float(centre))) / F.lit(float(scale))
        if model.bound is not None:
            z = clip(z, -model.bound, model.bound)
        columns.append(z.alias(name))
    return columns


def apply_scale(df: DataFrame, model: Scale, keep: list[str]) -> DataFrame:
    """The kept columns beside the scaled features."""
    return df.select(*keep, *scaled_columns(df, model))


def robust_scale(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Rows complete in all features, scaled by median and IQR (IQR 0 divides by 1)."""
    complete = df.dropna("any", subset=features)
    return apply_scale(complete, fit_scale(complete, features), keep)


def robust_scale_fallback(df: DataFrame, features: list[str], keep: list[str],
                          bound: float | None = SCALED_BOUND) -> DataFrame:
    """Every row: missing at the median, IQR 0 replaced by the deviation, values bounded."""
    fitted = fit_scale(df, features, fallback=bound is not None)
    model = Scale(fitted.features, fitted.centre, fitted.scale, bound, True)
    return apply_scale(df, model, keep)
