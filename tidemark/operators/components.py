"""Covariance and principal components.

The covariance is one distributed aggregate; only the p x p matrix reaches the driver, where
numpy solves it. Scores are dot products with literals, so they stay in generated code.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import as_number
from tidemark.operators.groups import group_median, shown_label
from tidemark.operators.sampling import stratified_sample
from tidemark.operators.scaling import fit_scale, robust_scale_fallback, scaled_columns

# Up to this width one aggregate holds all pair products; wider tables use Spark ML's PCA, or its Gram matrix.
PAIRWISE_WIDTH = 32


@dataclass(frozen=True)
class Components:
    """Fitted directions: ``loadings[k][i]`` of feature i in component k, ``variance[k]`` along it."""

    features: tuple[str, ...]
    centre: tuple[float, ...]
    loadings: tuple[tuple[float, ...], ...]
    variance: tuple[float, ...]
    total_variance: float

    @property
    def ratio(self) -> list[float]:
        return [v / (self.total_variance or 1.0) for v in self.variance]

    def table(self, spark) -> DataFrame:
        """(component, feature, loading)."""
        rows = [F.struct(F.lit(f"PC{k + 1}").alias("component"), F.lit(f).alias("feature"), F.lit(float(w)).alias("loading"))
                for k, weights in enumerate(self.loadings) for f, w in zip(self.features, weights)]
        return spark.range(1).select(F.inline(F.array(*rows)))


def covariance(df: DataFrame, features: list[str], centred: bool = True, means: list[float] | None = None) -> DataFrame:
    """(i, j, x, y, value) for all pairs of complete features, from one aggregate of plain sums.

    The means are taken first and subtracted before multiplying, so large values do not cancel.
    ``centred=False`` is the second moment about zero with the same n-1 divisor.
    """
    if not centred:
        means = [0.0] * len(features)
    elif means is None:
        means = feature_means(df, features)
    at = [F.col(f) - F.lit(m) if m else F.col(f) for f, m in zip(features, means)]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(len(features)):
        aggs += [F.sum(at[i] * at[j]).alias(f"c{i}_{j}") for j in range(i, len(features))]
    below = (F.col("n") - 1) if centred else F.greatest(F.lit(1), F.col("n") - 1)
    cells = [
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(features[i]).alias("x"), F.lit(features[j]).alias("y"),
                 F.col(f"c{min(i, j)}_{max(i, j)}").alias("sum"))
        for i in range(len(features)) for j in range(len(features))
    ]
    pairs = df.agg(*aggs).select("n", F.inline(F.array(*cells)))
    return pairs.select("i", "j", "x", "y", F.try_divide("sum", below).alias("value"))


def feature_means(df: DataFrame, features: list[str]) -> list[float]:
    return [float(m or 0.0) for m in df.agg(*[F.avg(f) for f in features]).first()]


def _solve(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest k eigenpairs; each direction's largest loading is positive."""
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:k]
    directions = vectors[:, order].T
    for row in directions:
        # Near-equal loadings keep their order, so rounding noise cannot flip the sign.
        if row[np.argmax(np.round(np.abs(row), 9))] < 0:
            row *= -1
    return np.maximum(values[order], 0.0), directions


def fit_components(df: DataFrame, features: list[str], k: int, centred: bool = True) -> Components:
    if len(features) > PAIRWISE_WIDTH:
        return _fit_wide(df, features, k) if centred else _fit_gram(df, features, k)
    centre = feature_means(df, features) if centred else [0.0] * len(features)
    matrix = np.zeros((len(features), len(features)))
    for c in covariance(df, features, centred, centre).collect():
        matrix[c["i"], c["j"]] = c["value"] if c["value"] is not None else 0.0
    variance, directions = _solve(matrix, k)
    return Components(tuple(features), tuple(centre), tuple(tuple(map(float, d)) for d in directions),
                      tuple(map(float, variance)), float(np.trace(matrix)))


def _fit_wide(df: DataFrame, features: list[str], k: int) -> Components:
    """Same result through Spark ML for many features; its ratios give variances back via the trace."""
    centre = feature_means(df, features)
    trace = float(sum(df.agg(*[F.var_samp(f) for f in features]).first()))
    vectors = VectorAssembler(inputCols=features, outputCol="vector").transform(df)
    model = PCA(k=k, inputCol="vector", outputCol="scores").fit(vectors)
    directions = np.array(model.pc.toArray().T)
    for row in directions:
        if row[np.argmax(np.round(np.abs(row), 9))] < 0:
            row *= -1
    variance = model.explainedVariance.toArray() * trace
    return Components(tuple(features), tuple(centre), tuple(tuple(map(float, d)) for d in directions),
                      tuple(map(float, variance)), trace)


def second_moments(df: DataFrame, features: list[str]) -> np.ndarray:
    """Second moments about zero of many complete features, with the n-1 divisor, from the distributed Gram matrix.

    Rows stay on the executors, which add up p x p products; only the p x p matrix reaches the driver.
    """
    n = df.count()
    if not n:
        return np.zeros((len(features), len(features)))
    rows = VectorAssembler(inputCols=features, outputCol="vector").transform(df).select("vector")
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "vector")).computeGramianMatrix()
    return gram.toArray() / max(1, n - 1)


def _fit_gram(df: DataFrame, features: list[str], k: int) -> Components:
    """Directions of the second moment of many features."""
    moments = second_moments(df, features)
    variance, directions = _solve(moments, k)
    return Components(tuple(features), (0.0,) * len(features), tuple(tuple(map(float, d)) for d in directions),
                      tuple(map(float, variance)), float(np.trace(moments)))


def score_columns(model: Components) -> list[Column]:
    scores = []
    for k, weights in enumerate(model.loadings):
        score = F.lit(0.0)
        for feature, centre, weight in zip(model.features, model.centre, weights):
            score = score + (F.col(feature) - F.lit(centre)) * F.lit(weight)
        scores.append(score.alias(f"PC{k + 1}"))
    return scores


def project(df: DataFrame, model: Components, keep: list[str]) -> DataFrame:
    """The kept columns beside PC1, PC2, ..."""
    return df.select(*keep, *score_columns(model))


def explained_variance(df: DataFrame, features: list[str]) -> DataFrame:
    """(component, variance, ratio, cumulative) over all components."""
    model = fit_components(df, features, len(features))
    cumulative = np.cumsum(model.ratio)
    rows = [F.struct(F.lit(k + 1).alias("component"), F.lit(v).alias("variance"), F.lit(r).alias("ratio"),
                     F.lit(float(c)).alias("cumulative"))
            for k, (v, r, c) in enumerate(zip(model.variance, model.ratio, cumulative))]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def pca_scores(df: DataFrame, features: list[str], k: int, keep: list[str]) -> DataFrame:
    return project(df, fit_components(df, features, k), keep)


def pca_scores_uncentred(df: DataFrame, features: list[str], keep: list[str], k: int = 3) -> DataFrame:
    """Directions of the second moment of fallback-scaled values, without removing the mean."""
    scaled = robust_scale_fallback(df, features, keep)
    model = fit_components(scaled, features, min(k, len(features)), centred=False)
    scores = project(scaled, model, keep)
    return scores if len(features) >= 3 else scores.withColumn("PC3", F.lit(0.0))


def existing_scores(df: DataFrame, label: str, key: str, max_points: int = 2200) -> DataFrame | None:
    """Sampled (key, label, PC1, PC2, PC3) if the table already carries scores, else None."""
    if not {"PC1", "PC2"} <= set(df.columns):
        return None
    third = F.coalesce(as_number(df, "PC3"), F.lit(0.0)) if "PC3" in df.columns else F.lit(0.0)
    picked = stratified_sample(df, label, key, max_points)
    points = picked.select(key, label, as_number(df, "PC1").alias("PC1"), as_number(df, "PC2").alias("PC2"),
                           third.alias("PC3")).where(F.col("PC1").isNotNull() & F.col("PC2").isNotNull())
    return points if len(points.limit(3).collect()) == 3 else None


def group_centres(scores: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Median score per label."""
    return group_median(shown_label(scores, label), label, columns)


def append_scores(df: DataFrame, features: list[str], k: int = 2) -> DataFrame:
    """The table with PC1..PCk added: missing features count as 0, robust scale, centred scores."""
    filled = df.withColumns({f"_f{i}": F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for i, f in enumerate(features)})
    names = [f"_f{i}" for i in range(len(features))]
    model = fit_scale(filled, names)
    scaled = filled.withColumns(dict(zip(names, scaled_columns(filled, model))))
    return project(scaled, fit_components(scaled, names, k), list(df.columns))
