"""K-Means: fit, assign, quality, sweeps, labels that do not depend on the run."""

from __future__ import annotations

import math
import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.clustering import KMeans as SeededKMeans
from pyspark.mllib.clustering import KMeansModel
from pyspark.mllib.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import MISSING, display_value
from tidemark.operators.components import Components, score_columns
from tidemark.operators.order import rows_at
from tidemark.operators.scaling import Scale, apply_scale, fit_scale, scaled_columns
from tidemark.session import cut_lineage

Centers = list[list[float]]

# Fitting defaults.
SEED, STARTS, MAX_ROUNDS = 42, 10, 300
#: Movement below which a center counts as settled.
SETTLED = 1e-9
#: Fits of one best-of that run at the same time: on small tables a fit mostly waits for the driver.
FITS_AT_ONCE = 5
#: Numbers that the fits of one best-of hold at the same time, if that leaves any two: on large tables one fills the cluster.
VALUES_AT_ONCE = 500_000_000
#: Rows of each cluster that a silhouette compares with, and folds of them for its standard error.
REFERENCES, FOLDS = 512, 16
#: Rows that a whole silhouette packs into one block, those that one of its tasks scores at most, and the side of a tile of distances.
BLOCK, SCORED, TILE = 2048, 16384, 256
#: Mean distance, as a part of a row's distance from the mean of the table, below which it is only rounding.
ROUNDING = 1e-7
#: Labels of one partition that may be matched with another's.
MATCHED_LABELS = 1000
# Label columns looked for, in order.
LABEL_COLUMNS = ["Cluster", "cluster", "cluster_label", "Cluster_scaled"]


def squared_distance(features: list[str], center: list[float]) -> Column:
    parts = [(F.col(f) - F.lit(float(c))) * (F.col(f) - F.lit(float(c))) for f, c in zip(features, center)]
    return reduce(lambda a, b: a + b, parts)


def _distances(features: list[str], centers: Centers) -> Column:
    return F.array(*[squared_distance(features, c) for c in centers])


def nearest(features: list[str], centers: Centers) -> Column:
    """0-based index of the nearest center; the lower index wins ties."""
    distances = _distances(features, centers)
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def assign(df: DataFrame, features: list[str], centers: Centers, out: str = "Cluster") -> DataFrame:
    """A plain projection: no shuffle, no model object on the executors."""
    return df.withColumn(out, nearest(features, centers))


def inertia(df: DataFrame, features: list[str], centers: Centers) -> DataFrame:
    """Sum of squared distances to the nearest center."""
    return df.agg(F.sum(F.array_min(_distances(features, centers))).alias("inertia"),
                  F.count(F.lit(1)).alias("rows"))


def lloyd_step(df: DataFrame, features: list[str], centers: Centers) -> DataFrame:
    """(cluster, rows, mean of each feature) after assigning to the given centers."""
    return assign(df, features, centers, "cluster").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(f).alias(f) for f in features])


def fit_facts(df: DataFrame, features: list[str], centers: Centers, key: str) -> DataFrame:
    """What holds for a good fit: (rows, clusters, settled, nearest, not_worse), to be read as a check of ``centers``.

    ``settled``: every center is the mean of its rows, to a hundredth. ``nearest``: the inertia is what the sums of squares
    about the means give, which holds only if rows belong to these means. ``not_worse``: the inertia is at most that of
    the fit from evenly spaced rows.
    """
    other, _ = kmeans_seeded(df, features, key, len(centers))
    best = F.array_min(_distances(features, centers))
    groups = df.select(*features, nearest(features, centers).alias("cluster"), best.alias("d"), F.array_min(_distances(features, other)).alias("e"))
    given = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    gap = F.greatest(F.lit(0.0), *[F.abs(F.avg(f) - F.element_at(F.element_at(given, F.col("cluster") + 1), i + 1)) for i, f in enumerate(features)])
    within = reduce(lambda a, b: a + b, [F.var_pop(f) for f in features]) * F.count(F.lit(1))
    facts = groups.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), gap.alias("gap"), within.alias("within"), F.sum("d").alias("d"), F.sum("e").alias("e"))
    return facts.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("clusters"), (F.max("gap") < 0.01).alias("settled"),
        (F.abs(F.sum("within") - F.sum("d")) <= 1e-3 * F.sum("d")).alias("nearest"),
        (F.sum("d") <= 1.0001 * F.sum("e")).alias("not_worse"))


def canonical_order(centers: Centers, sizes: list[int]) -> Centers:
    """Centers by size, largest first, then by their coordinates."""
    order = sorted(range(len(centers)), key=lambda i: (-sizes[i], [round(float(x), 9) for x in centers[i]]))
    return [list(map(float, centers[i])) for i in order]


def kmeans_fit(df: DataFrame, features: list[str], k: int, seed: int = SEED, starts: int = STARTS,
               max_rounds: int = MAX_ROUNDS) -> Centers:
    """Best of several seeded runs by inertia, centers in canonical order, see ``kmeans_fits``."""
    return kmeans_fits(df, features, [k], seed, starts, max_rounds)[0]


def kmeans_fits(df: DataFrame, features: list[str], ks: list[int], seed: int = SEED, starts: int = STARTS,
                max_rounds: int = MAX_ROUNDS) -> list[Centers]:
    """For each K the best of several seeded runs by inertia, centers in canonical order.

    ``df`` should already be small in columns and cut from its lineage, since it is read once into a cache of vectors. Each
    run reads that cache once and keeps its rows decoded for its rounds, which Spark ML does for a table that is not
    itself the cached one; decoding them again in every round takes longer than the round. The runs of all K share one
    queue, the largest K first, so that no K waits for the slowest run of another.
    """
    vectors = VectorAssembler(inputCols=features, outputCol="vector").transform(df).select("vector").persist()
    try:
        values = vectors.count() * len(features)
        at_once = max(1, min(FITS_AT_ONCE, VALUES_AT_ONCE // max(1, values)))
        points = vectors.where(F.col("vector").isNotNull())  # every row: a query on the cached table, not that table
        found = []
        with ThreadPoolExecutor(at_once) as pool:
            runs = {(i, start): pool.submit(KMeans(
                k=ks[i], seed=seed + start, maxIter=max_rounds, tol=1e-6, featuresCol="vector").fit, points)
                for i in sorted(range(len(ks)), key=lambda i: -ks[i]) for start in range(starts)}
        for i in range(len(ks)):
            best = None
            for model in (runs[i, start].result() for start in range(starts)):
                cost = model.summary.trainingCost
                if best is None or cost < best.summary.trainingCost - 1e-9 * abs(best.summary.trainingCost):
                    best = model
            found.append(canonical_order([list(c) for c in best.clusterCenters()], list(best.summary.clusterSizes)))
    finally:
        vectors.unpersist()
    return found


def evenly_spaced_rows(df: DataFrame, features: list[str], key: str, k: int) -> Centers:
    """The rows at k evenly spaced places in key order."""
    total = df.count()
    places = [int(math.floor(i / max(1, k - 1) * (total - 1))) + 1 for i in range(k)]
    found = {r["_place"]: [float(r[f]) for f in features]
             for r in rows_at(df.select(key, *features), key, places, "_place").collect()}
    return [list(found[p]) for p in places]


def kmeans_seeded(df: DataFrame, features: list[str], key: str, k: int, max_rounds: int = MAX_ROUNDS) -> tuple[Centers, bool]:
    """Centers of the fit that starts at evenly spaced rows, and whether it has settled.

    The fit is MLlib's, from a given first model: an empty cluster keeps its center, and it ends when no center moves. It
    has settled if every center is the mean of its rows, which takes one more aggregate over ``df``.
    """
    first = KMeansModel([Vectors.dense(c) for c in evenly_spaced_rows(df, features, key, k)])
    rows = df.select(*[F.col(f).cast("double") for f in features]).rdd.map(lambda r: Vectors.dense(list(r)))
    model = SeededKMeans.train(rows, k, maxIterations=max_rounds, epsilon=SETTLED, initialModel=first)
    centers = [[float(x) for x in c] for c in model.clusterCenters]
    moved = max((abs(r[f] - x) for r in lloyd_step(df, features, centers).collect()  # k rows
                 for f, x in zip(features, centers[r["cluster"]], strict=True)), default=0.0)
    return centers, moved <= 1e-6


def label_rows(df: DataFrame, scale: Scale, centers: Centers, out: str, components: Components | None = None) -> DataFrame:
    """Label every row of a wide table with fitted models: a projection, no join back and no shuffle."""
    scaled = [f"_z{i}" for i in range(len(scale.features))]
    wide = df.withColumns(dict(zip(scaled, scaled_columns(df, scale, scaled))))
    names = scaled
    if components:
        names = [f"_p{i}" for i in range(len(components.loadings))]
        moved = replace(components, features=tuple(scaled))
        wide = wide.withColumns(dict(zip(names, score_columns(moved))))
    return assign(wide, names, centers, out).drop(*scaled, *names)


def kmeans_seeded_labels(df: DataFrame, features: list[str], key: str, k: int, out: str = "__cluster") -> DataFrame:
    """Every row with its label (as text) by the seeded fit on all features: missing at the median, IQR 0 divides by 1.

    Warns if the fit has not settled.
    """
    scale = replace(fit_scale(df, features), fill_centre=True)
    # The rounds read a narrow written table.
    centers, settled = kmeans_seeded(cut_lineage(apply_scale(df, scale, [key])), features, key, k)
    if not settled:
        warnings.warn(f"the seeded fit has not settled after {MAX_ROUNDS} rounds", stacklevel=2)
    return label_rows(df, scale, centers, out).withColumn(out, F.col(out).cast("string"))


def fallback_k(rows: int) -> int:
    return min(4, max(2, int(math.floor(math.sqrt(rows / 2) + 0.5))))


def detect_label(df: DataFrame) -> str | None:
    """First known label column holding a visible value."""
    present = [c for c in LABEL_COLUMNS if c in df.columns]
    if not present:
        return None
    filled = df.agg(*[F.count_if(display_value(c) != MISSING).alias(c) for c in present]).first()
    return next((c for c in present if filled[c]), None)


def ensure_labels(df: DataFrame, features: list[str], key: str) -> tuple[DataFrame, str, int]:
    """(table, label column, number of labels): existing labels, else the seeded clustering."""
    existing = detect_label(df)
    if existing:
        shown = df.select(display_value(existing).alias("v")).where(F.col("v") != MISSING)
        return df, existing, shown.distinct().count()
    rows = df.count()
    if not rows or not features:
        return df.withColumn("__cluster", F.lit("0")), "__cluster", 1 if rows else 0
    k = fallback_k(rows)
    return kmeans_seeded_labels(df, features, key, k), "__cluster", k


def silhouette(df: DataFrame, features: list[str], label: str, key: str, references: int | None = REFERENCES,
               seed: int = SEED) -> DataFrame:
    """Mean Euclidean silhouette of all rows: (silhouette, standard_error, rows).

    With ``references`` None every row is compared with every other one, see ``silhouettes``. Else every row is compared with ``references`` rows of each cluster, those with the least hash of their (unique) key, or
    with the whole cluster if it has no more; so the error does not depend on the number of rows and vanishes where all
    clusters are whole. The references are dealt into ``FOLDS`` folds and the standard error is that of the jackknife over
    them. What reaches the driver and each task is at most ``references`` rows of each cluster. A row that is alone in
    its cluster scores 0, as does every row of a single cluster; rows without a label take no part.
    """
    if references is None:
        return df.sparkSession.createDataFrame(
            silhouettes(df, features, [label]), "silhouette double, standard_error double, rows long")
    rows = df.where(F.col(label).isNotNull()).select(
        F.col(key).cast("string").alias("_key"), F.col(label).cast("string").alias("_label"),
        *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)])
    names = [f"_f{i}" for i in range(len(features))]
    order = Window.partitionBy("_label").orderBy(F.md5(F.concat(F.col("_key"), F.lit(f":{seed}"))), "_key")
    drawn = rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= references).collect()
    drawn.sort(key=lambda r: (r["_label"], r["_place"]))
    labels = sorted({r["_label"] for r in drawn})
    code = {v: i for i, v in enumerate(labels)}
    cluster = np.array([code[r["_label"]] for r in drawn], np.int64)
    fold = np.array([r["_place"] % FOLDS for r in drawn], np.int64)
    points = np.array([[r[n] for n in names] for r in drawn], float).reshape(len(drawn), len(names))
    shared = df.sparkSession.sparkContext.broadcast(
        (points, cluster, fold, code, {(r["_key"], r["_label"]): r["_place"] % FOLDS for r in drawn}))
    sums = rows.mapInArrow(lambda batches: _silhouettes(batches, *shared.value), "sums array<double>, n long")
    means = F.array(*[F.sum(F.element_at("sums", i + 1)) / F.sum("n") for i in range(FOLDS + 1)])
    whole = np.bincount(cluster, minlength=1).max() < references if len(drawn) else True
    spread = F.aggregate(F.slice("means", 2, FOLDS), F.lit(0.0), lambda a, m: a + F.pow(m - F.col("centre"), 2))
    centre = F.aggregate(F.slice("means", 2, FOLDS), F.lit(0.0), lambda a, m: a + m) / FOLDS
    error = F.lit(0.0) if whole else F.sqrt(spread * ((FOLDS - 1) / FOLDS))
    return sums.agg(means.alias("means"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).withColumn("centre", centre).select(
        F.element_at("means", 1).alias("silhouette"), error.alias("standard_error"), "rows")


def _silhouettes(batches, points: np.ndarray, cluster: np.ndarray, fold: np.ndarray, code: dict, held: dict):
    """Sums of the silhouettes of a batch, with all references and without each fold of them."""
    k = len(code)
    member = np.zeros((len(points), k * FOLDS))
    member[np.arange(len(points)), cluster * FOLDS + fold] = 1
    sizes = member.sum(axis=0).reshape(k, FOLDS)
    for batch in batches:
        key, label = batch.column("_key").to_pylist(), batch.column("_label").to_pylist()
        values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]).astype(float)
        totals = np.zeros(FOLDS + 1)
        for at in range(0, len(values), 1024):
            part = values[at:at + 1024]
            own = np.array([code[v] for v in label[at:at + 1024]], np.int64)
            gaps = np.zeros((len(part), len(points)))
            for f in range(points.shape[1]):
                gaps += (part[:, f, None] - points[None, :, f]) ** 2
            sums = (np.sqrt(gaps) @ member).reshape(len(part), k, FOLDS)
            counts = np.broadcast_to(sizes, sums.shape).copy()
            for i, pair in enumerate(zip(key[at:at + 1024], label[at:at + 1024], strict=True)):
                if pair in held:  # a reference is not compared with itself
                    counts[i, own[i], held[pair]] -= 1
            all_sums, all_counts = sums.sum(axis=2), counts.sum(axis=2)
            for g in range(FOLDS + 1):
                s = all_sums if not g else all_sums - sums[:, :, g - 1]
                n = all_counts if not g else all_counts - counts[:, :, g - 1]
                mean = np.where(n > 0, s / np.maximum(n, 1), np.inf)
                rows = np.arange(len(part))
                inside = mean[rows, own].copy()
                mean[rows, own] = np.inf
                outside = mean.min(axis=1)
                top = np.maximum(inside, outside)
                good = np.isfinite(top) & (top > 0)
                totals[g] += ((outside[good] - inside[good]) / top[good]).sum()
        yield pa.RecordBatch.from_arrays([pa.array([totals.tolist()], pa.list_(pa.float64())), pa.array([len(values)], pa.int64())], ["sums", "n"])


def silhouettes(df: DataFrame, features: list[str], labels: list[str]) -> list[tuple[float | None, float, int]]:
    """(silhouette, standard error 0, rows) of each of several labelings, every row compared with every other one.

    A distance does not depend on the labels, so it is worked out once for all of them. The time grows with the square of
    the number of rows. Nothing is drawn and nothing is shuffled but the rows themselves: each task holds the sums of its
    own ``SCORED`` rows while the blocks of all rows pass by, so its memory depends on neither side. Rows should be finite;
    a row that is alone in its cluster scores 0, as does every row of a single cluster and one that equals all rows it is
    compared with; rows without a label take no part in that labeling.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(labels)]))
    found = df.select(pairs.alias("p")).select("p.*").dropna().groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).orderBy("i", "v").collect()  # one row a label
    values = [[r["v"] for r in found if r["i"] == i] for i in range(len(labels))]
    sizes = [np.array([r["n"] for r in found if r["i"] == i], np.int64) for i in range(len(labels))]
    labelled = df.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in labels]))
    means = labelled.agg(F.count(F.lit(1)), *[F.avg(F.col(f).cast("double")) for f in features]).first()
    # Distances are those of centred rows, whose products lose the fewest digits.
    points = [(F.col(f).cast("double") - F.lit(m)).alias(f"_f{i}") for i, (f, m) in enumerate(zip(features, means[1:], strict=True))]
    codes = [F.coalesce(F.array_position(F.array(*map(F.lit, v)), F.col(c).cast("string")) - 1, F.lit(-1)).cast("int").alias(f"_c{i}") if v
             else F.lit(-1).alias(f"_c{i}") for i, (c, v) in enumerate(zip(labels, values, strict=True))]
    slots = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(-(-means[0] // BLOCK), -(-means[0] // (SCORED * slots)) * slots)  # as many rounds of tasks for every slot
    # Rows of equal labels lie side by side, so that most of a tile is summed as one.
    rows = labelled.select(*points, *codes).repartition(max(1, tasks)).sortWithinPartitions(*[f"_c{i}" for i in range(len(labels))])
    width = len(features)
    blocks = cut_lineage(rows.mapInArrow(lambda batches: _blocks(batches, width), "points binary, codes binary, starts binary").withColumn(
        "id", F.monotonically_increasing_id()))
    # The blocks of a task are one element, so that all blocks pass by it once, not once for each.
    scored = blocks.rdd.glom().cartesian(blocks.coalesce(1).rdd).mapPartitions(lambda near: _whole_silhouettes(near, width, sizes)).collect()  # one row a task
    return [(math.fsum(s[i] for s in scored) / n if n else None, 0.0, n) for i, n in enumerate(int(s.sum()) for s in sizes)]


def _blocks(batches, width: int):
    """Sorted rows as blocks: points, the label codes of each stretch of equal ones, and where the stretches begin."""
    def block(part: np.ndarray) -> pa.RecordBatch:
        codes = part[:, width:].astype(np.int32)
        starts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]).any(axis=1)])
        parts = [np.ascontiguousarray(part[:, :width]), np.ascontiguousarray(codes[starts]), starts.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], ["points", "codes", "starts"])

    held = None
    for batch in batches:
        more = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
        held = more if held is None else np.concatenate([held, more])
        while len(held) >= BLOCK:
            yield block(held[:BLOCK])
            held = held[BLOCK:]
    if held is not None and len(held):
        yield block(held)


def _unpacked(block, width: int, labelings: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points, codes of the stretches and the stretch of each row."""
    points = np.frombuffer(block["points"], float).reshape(-1, width)
    starts = np.frombuffer(block["starts"], np.int32)
    codes = np.frombuffer(block["codes"], np.int32).reshape(len(starts), labelings)
    return points, codes, np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(points)]))


def _whole_silhouettes(near, width: int, sizes: list[np.ndarray]):
    """Sums of the silhouettes of a task's rows, one for each labeling, from all pairs of its blocks with any block."""
    first = np.cumsum([0, *map(len, sizes)])  # where the labels of a labeling begin in the columns of sums
    buffer, sides = np.empty(TILE * TILE), {}
    for own_blocks, other in near:
        for mine in own_blocks:
            if mine["id"] not in sides:
                points, codes, stretch = _unpacked(mine, width, len(sizes))
                square = (points ** 2).sum(axis=1)[:, None]
                sides[mine["id"]] = np.hstack([points, square, np.ones_like(square)]), codes[stretch], np.zeros((len(points), first[-1]))
        points, codes, stretch = _unpacked(other, width, len(sizes))
        square = (points ** 2).sum(axis=1)[:, None]
        right = np.ascontiguousarray(np.hstack([-2 * points, np.ones_like(square), square]).T)
        counts = np.zeros((len(codes), first[-1]))  # which labels a stretch counts for
        at, labeling = np.nonzero(codes >= 0)
        counts[at, first[labeling] + codes[at, labeling]] = 1
        whole = len(codes) > first[-1]  # more stretches than labels: each row is summed under its labels at once
        member = counts[stretch] if whole else np.zeros((len(points), len(codes)))
        if not whole:
            member[np.arange(len(points)), stretch] = 1
        for mine in own_blocks:
            left, _, sums = sides[mine["id"]]
            total = np.zeros((len(left), member.shape[1]))
            for i in range(0, len(left), TILE):
                a = left[i:i + TILE]
                for j in range(0, len(points), TILE):
                    b = right[:, j:j + TILE]
                    gaps = buffer[:len(a) * b.shape[1]].reshape(len(a), b.shape[1])
                    np.dot(a, b, out=gaps)
                    np.sqrt(np.abs(gaps, out=gaps), out=gaps)
                    if mine["id"] == other["id"] and i == j:
                        np.fill_diagonal(gaps, 0)
                    # A tile meets only the stretches that its rows are in.
                    of = slice(None) if whole else slice(stretch[j], stretch[j + len(gaps[0]) - 1] + 1)
                    total[i:i + TILE, of] += gaps @ member[j:j + TILE, of]
            sums += total if whole else total @ counts
    totals = np.zeros(len(sizes))
    for left, codes, sums in sides.values():
        noise = ROUNDING * np.sqrt(left[:, -2])
        for i, size in enumerate(sizes):
            rows = np.flatnonzero(codes[:, i] >= 0)
            own = codes[rows, i]
            counts = np.broadcast_to(size, (len(rows), len(size))).copy()
            at = np.arange(len(rows))
            counts[at, own] -= 1
            mean = np.where(counts > 0, sums[rows, first[i]:first[i + 1]] / np.maximum(counts, 1), np.inf)
            inside = mean[at, own].copy()
            mean[at, own] = np.inf
            outside = mean.min(axis=1, initial=np.inf)
            top = np.maximum(inside, outside)
            good = np.isfinite(top) & (top > noise[rows])
            totals[i] += ((outside[good] - inside[good]) / top[good]).sum()
    yield totals


def k_sweep(df: DataFrame, features: list[str], key: str, ks=range(2, 10), references: int | None = None,
            starts: int = STARTS) -> DataFrame:
    """(k, inertia, silhouette, standard_error, sizes) for several K on the same table.

    The labels of all K are written once; inertia and sizes come from one pass over them. The silhouettes compare every
    row with every other one, all K in the same pass, unless the caller gives a number of ``references``.
    """
    ks = list(ks)
    fits = kmeans_fits(df, features, ks, starts=starts)
    labels = [f"_l{i}" for i in range(len(ks))]
    # Written, as the labels are long expressions that several plans would each optimise and compute anew.
    labelled = cut_lineage(df.select(
        key, *features, *[nearest(features, centers).alias(c) for c, centers in zip(labels, fits)],
        *[F.array_min(_distances(features, centers)).alias(f"_d{i}") for i, centers in enumerate(fits)]))
    quality = silhouettes(labelled, features, labels) if references is None else [
        silhouette(labelled, features, c, key, references).first() for c in labels]
    each = F.explode(F.array(*[F.struct(
        F.lit(i).alias("i"), F.col(c).alias("cluster"), F.col(f"_d{i}").alias("d")) for i, c in enumerate(labels)]))
    groups = labelled.select(each.alias("x")).select("x.*").groupBy("i", "cluster").agg(F.count(F.lit(1)).alias("rows"), F.sum("d").alias("d"))
    # At most k entries.
    sizes = F.array_sort(F.collect_list(F.struct("cluster", "rows")))
    text = F.array_join(F.transform(sizes, lambda r: F.concat_ws(": ", r["cluster"].cast("string"),
                                                                 r["rows"].cast("string"))), ", ")

    def of_fit(values) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("i") + 1)

    return groups.groupBy("i").agg(F.sum("d").alias("inertia"), text.alias("sizes")).select(
        of_fit(ks).alias("k"), "inertia", of_fit([q[0] for q in quality]).alias("silhouette"),
        of_fit([q[1] for q in quality]).alias("standard_error"), "sizes")


def best_matching(weight: np.ndarray) -> list[int]:
    """For each row of a square table its column, so that the sum of the chosen cells is greatest.

    Shortest augmenting paths over reduced costs, one row after another.
    """
    n = len(weight)
    cost = weight.max(initial=0) - weight.astype(float)
    row_price, column_price = np.zeros(n), np.zeros(n + 1)
    holder = np.full(n + 1, -1)  # row of each column; the last column is where a search starts
    for row in range(n):
        holder[n], here = row, n
        reach, via, done = np.full(n, np.inf), np.full(n, n), np.zeros(n + 1, bool)
        while holder[here] >= 0:
            done[here] = True
            i = holder[here]
            slack = cost[i] - row_price[i] - column_price[:n]
            shorter = ~done[:n] & (slack < reach)
            reach[shorter], via[shorter] = slack[shorter], here
            step = np.where(done[:n], np.inf, reach)
            following = int(step.argmin())
            row_price[holder[done]] += step[following]
            column_price[done] -= step[following]
            reach[~done[:n]] -= step[following]
            here = following
        while here != n:
            holder[here], here = holder[via[here]], via[here]
    columns = [0] * n
    for column in range(n):
        columns[holder[column]] = column
    return columns


def match_labels(df: DataFrame, a: str, b: str) -> list[tuple]:
    """Pairs (label of ``a``, label of ``b``), each label in one pair at most, that agree on the most rows.

    Only the counts of label pairs reach the driver. Of the surplus labels of the longer side, and of null labels, none
    is in a pair.
    """
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("rows")).dropna().collect()
    left, right = sorted({r[0] for r in cells}), sorted({r[1] for r in cells})
    if max(len(left), len(right)) > MATCHED_LABELS:
        raise ValueError(f"more than {MATCHED_LABELS} labels: match_labels compares partitions, not keys")
    size = max(len(left), len(right), 1)
    weight = np.zeros((size, size))
    at_left, at_right = {v: i for i, v in enumerate(left)}, {v: i for i, v in enumerate(right)}
    for x, y, n in cells:
        weight[at_left[x], at_right[y]] = n
    return [(x, right[j]) for x, j in zip(left, best_matching(weight), strict=False) if j < len(right)]


def _is_match(df: DataFrame, a: str, b: str) -> Column:
    return reduce(lambda x, y: x | y, [(F.col(a) == F.lit(x)) & (F.col(b) == F.lit(y)) for x, y in match_labels(df, a, b)], F.lit(False))


def compare_partitions(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency of two labelings, with the cells of the best one-to-one matching of their labels marked."""
    found = F.coalesce(_is_match(df, a, b), F.lit(False)).alias("matched")
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("rows")).select(a, b, "rows", found)


def partition_changes(df: DataFrame, a: str, b: str) -> DataFrame:
    """(rows, changed, share): how many rows are in another group in ``b`` than in ``a``, labels matched one to one."""
    return compare_partitions(df, a, b).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~F.col("matched"), F.col("rows")).otherwise(0)), F.lit(0)).alias("changed")).withColumn(
        "share", F.try_divide(F.col("changed"), F.col("rows")))
