"""Scaling, components and clustering against numpy."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import components as C
from tidemark.operators import kmeans as K
from tidemark.operators.scaling import fit_scale, robust_scale, robust_scale_fallback


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    groups = [(0, 0, 0), (6, 0, 1), (0, 7, -1)]
    return np.vstack([rng.normal(size=(n, 3)) * 0.5 + g for n, g in zip((80, 50, 30), groups)]).round(4)


@pytest.fixture(scope="module")
def cloud(spark, points):
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(5).cache()


def test_zero_iqr_divides_by_one(spark):
    df = spark.createDataFrame([(i, float(i), 0.0 if i else 8.0) for i in range(9)], "id long, x double, z double")
    model = fit_scale(df, ["x", "z"])
    assert model.centre == (4.0, 0.0) and model.scale == (4.0, 1.0)
    top = robust_scale(df, ["x", "z"], ["id"]).orderBy("id").first()
    assert (top["x"], top["z"]) == (-1.0, 8.0)


def test_fallback_fills_and_bounds(spark):
    rows = [(i, 1000.0 if i == 9 else float(i), 5.0 if i == 9 else 0.0, 7.0) for i in range(10)] + [(10, None, None, None)]
    df = spark.createDataFrame(rows, "id long, x double, z double, k double")
    got = {r["id"]: r for r in robust_scale_fallback(df, ["x", "z", "k"], ["id"]).collect()}
    assert got[9]["x"] == 8.0 and got[10]["x"] == got[10]["z"] == 0.0
    assert got[9]["z"] == pytest.approx(5.0 / np.std([0.0] * 9 + [5.0])) and got[9]["k"] == 0.0


def test_components_match_numpy(cloud, points):
    model = C.fit_components(cloud, ["a", "b", "c"], 3)
    values = np.sort(np.linalg.eigvalsh(np.cov(points.T)))[::-1]
    assert model.variance == pytest.approx(values) and sum(model.ratio) == pytest.approx(1.0)
    for row in model.loadings:
        assert row[int(np.argmax(np.abs(row)))] > 0
    scores = np.array([[r["PC1"], r["PC2"], r["PC3"]] for r in C.project(cloud, model, []).collect()])
    assert scores.mean(axis=0) == pytest.approx([0, 0, 0], abs=1e-9)
    assert scores.var(axis=0, ddof=1) == pytest.approx(values)


def test_wide_components_agree(cloud):
    narrow = C.fit_components(cloud, ["a", "b", "c"], 2)
    wide = C._fit_wide(cloud, ["a", "b", "c"], 2)
    assert np.abs(np.array(wide.loadings)) == pytest.approx(np.abs(np.array(narrow.loadings)), abs=1e-8)
    assert wide.variance == pytest.approx(narrow.variance)


def test_covariance_keeps_digits(spark):
    df = spark.createDataFrame([(1e9 + i, 1e9 + 2 * i) for i in range(10)], "a double, b double")
    cells = {(r["x"], r["y"]): r["value"] for r in C.covariance(df, ["a", "b"]).collect()}
    assert cells["a", "b"] == pytest.approx(2 * np.var(range(10), ddof=1), rel=1e-9)


def test_assignment_ties_go_to_the_lower_label(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double")
    assert [r["Cluster"] for r in K.assign(df, ["x"], [[0.0], [2.0]]).orderBy("x").collect()] == [0, 0, 1]


def test_fit_is_stable_and_canonical(cloud, points):
    centers = K.kmeans_fit(cloud, ["a", "b", "c"], 3, starts=3)
    labelled = K.assign(cloud, ["a", "b", "c"], centers)
    sizes = {r["Cluster"]: r["count"] for r in labelled.groupBy("Cluster").count().collect()}
    assert sizes == {0: 80, 1: 50, 2: 30}
    again = K.kmeans_fit(cloud.repartition(3), ["a", "b", "c"], 3, starts=3)
    assert np.array(again) == pytest.approx(np.array(centers), abs=1e-6)
    before = K.inertia(cloud, ["a", "b", "c"], centers).first()["inertia"]
    step = K.lloyd_step(cloud, ["a", "b", "c"], centers).orderBy("cluster").collect()
    moved = [[r["a"], r["b"], r["c"]] for r in step]
    assert K.inertia(cloud, ["a", "b", "c"], moved).first()["inertia"] <= before + 1e-9


def brute_seeded(x, k, rounds=45):
    centers = [x[int(i / max(1, k - 1) * (len(x) - 1))].copy() for i in range(k)]
    labels = np.zeros(len(x), dtype=int)
    for _ in range(rounds):
        new = np.array([int(np.argmin([((p - c) ** 2).sum() for c in centers])) for p in x])
        moved = (new != labels).any()
        labels = new
        for j in range(k):
            if (labels == j).any():
                centers[j] = x[labels == j].mean(axis=0)
        if not moved:
            break
    return labels


def test_seeded_labels_match_brute_force(cloud, points):
    spread = np.quantile(points, 0.75, axis=0) - np.quantile(points, 0.25, axis=0)
    scaled = (points - np.median(points, axis=0)) / spread
    want = brute_seeded(scaled, 4)
    got = {r["id"]: r["__cluster"] for r in K.kmeans_seeded_labels(cloud, ["a", "b", "c"], "id", 4).collect()}
    assert [got[i] for i in range(len(points))] == [str(v) for v in want]


def test_ensure_labels(spark, cloud):
    labelled = cloud.withColumn("cluster", F.lit("x")).withColumn("Cluster_scaled", F.lit("y"))
    assert K.ensure_labels(labelled, ["a"], "id")[1:] == ("cluster", 1)
    blank = cloud.withColumn("Cluster", F.lit(" "))
    df, column, k = K.ensure_labels(blank, ["a", "b", "c"], "id")
    assert (column, k) == ("__cluster", 4) and df.count() == 160
    assert K.ensure_labels(cloud.limit(0), ["a"], "id")[1:] == ("__cluster", 0)
    assert K.fallback_k(2) == 2 and K.fallback_k(18) == 3 and K.fallback_k(10 ** 9) == 4


def test_silhouette_matches_brute_force(cloud, points):
    labels = np.repeat([0, 1, 2], [80, 50, 30])
    df = cloud.withColumn("l", F.when(F.col("id") < 80, 0).when(F.col("id") < 130, 1).otherwise(2))
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    want = []
    for i in range(len(points)):
        same = (labels == labels[i])
        a = d[i][same].sum() / (same.sum() - 1)
        b = min(d[i][labels == j].mean() for j in set(labels) - {labels[i]})
        want.append((b - a) / max(a, b))
    row = K.silhouette(df, ["a", "b", "c"], "l", "id").first()
    assert row["silhouette"] == pytest.approx(np.mean(want), abs=1e-9) and row["rows"] == 160
    one = K.silhouette(cloud.withColumn("l", F.lit(1)), ["a"], "l", "id").first()
    assert one["silhouette"] == 0.0


def test_silhouette_of_all_rows_is_within_its_error(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(c, s, (n, 2)) for c, s, n in (((0, 0), 1.0, 900), ((3, 0), 1.5, 1500), ((0, 4), 0.7, 300))])
    labels = np.repeat([0, 1, 2], [900, 1500, 300])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    means = np.stack([d[:, labels == j].sum(axis=1) / np.where(labels == j, (labels == j).sum() - 1, (labels == j).sum()) for j in range(3)], axis=1)
    own = means[np.arange(len(x)), labels]
    means[np.arange(len(x)), labels] = np.inf
    other = means.min(axis=1)
    want = ((other - own) / np.maximum(own, other)).mean()
    df = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, (a, b), c in zip(range(len(x)), x, labels, strict=True)], "id long, a double, b double, l int")
    found = [K.silhouette(df, ["a", "b"], "l", "id", references=64, seed=seed).first() for seed in range(6)]
    assert all(0 < r["standard_error"] < 0.05 and r["rows"] == len(x) for r in found)
    assert sum(abs(r["silhouette"] - want) <= 2 * r["standard_error"] for r in found) >= 5
    whole = K.silhouette(df.repartition(7), ["a", "b"], "l", "id", references=2000).first()
    assert whole["silhouette"] == pytest.approx(want, abs=1e-9) and whole["standard_error"] == 0
    assert tuple(K.silhouette(df.limit(0), ["a", "b"], "l", "id").first()) == (None, 0.0, 0)


def whole_silhouette(x, labels):
    """Every row with every other one; rows labelled None take no part."""
    kept = np.array([v is not None for v in labels])
    x, labels = x[kept], np.array([v for v in labels if v is not None])
    sides = [labels == j for j in sorted(set(labels.tolist()))]
    scores = np.zeros(len(x))
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        own = next(side for side in sides if side[i])
        others = [d[side].mean() for side in sides if side is not own]
        if own.sum() > 1 and others:
            a, b = d[own].sum() / (own.sum() - 1), min(others)
            scores[i] = (b - a) / max(a, b) if max(a, b) > 0 else 0
    return scores.mean(), len(x)


def test_silhouettes_compare_every_row_with_every_other(spark):
    rng = np.random.default_rng(23)
    x = rng.normal(40, 1.0, (2600, 3))
    x[100:150] = x[100]
    many = rng.integers(0, 40, len(x))
    labels = [(x[:, 0] > 40).astype(int).tolist(), many.tolist(), [None if i % 5 == 0 else int(v) for i, v in enumerate(many % 3)],
              [int(i == 7) for i in range(len(x))], [None] * len(x)]
    rows = [(*map(float, p), *codes) for p, codes in zip(x, zip(*labels, strict=True), strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, l0 int, l1 int, l2 int, l3 int, l4 int")
    found = K.silhouettes(df.repartition(5), ["a", "b", "c"], [f"l{i}" for i in range(5)])
    for (score, error, n), given in zip(found[:4], labels, strict=False):
        want, rows = whole_silhouette(x, given)
        assert score == pytest.approx(want, abs=1e-9) and (error, n) == (0.0, rows)
    assert found[4] == (None, 0.0, 0) and K.silhouettes(df.limit(0), ["a"], ["l0"]) == [(None, 0.0, 0)]
    one = K.silhouette(df, ["a", "b", "c"], "l0", "a", references=None).first()
    assert one["silhouette"] == pytest.approx(found[0][0], abs=1e-12) and one["rows"] == len(x)
    # Rows of one place, far from zero: two labels of equal rows score 0, not what rounding leaves.
    equal = df.limit(300).select(F.lit(0.1).alias("a"), F.lit(1e5).alias("b"), "l0")
    assert K.silhouettes(equal, ["a", "b"], ["l0"]) == [(0.0, 0.0, 300)]


def test_k_sweep_scores_with_all_rows(spark):
    rng = np.random.default_rng(29)
    x = np.concatenate([rng.normal(c, s, (n, 2)) for c, s, n in (((0, 0), 1.0, 900), ((4, 0), 1.5, 1500), ((0, 5), 0.7, 400))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    rows = K.k_sweep(df, ["a", "b"], "id", [2, 3], starts=2).orderBy("k").collect()
    assert [r["k"] for r in rows] == [2, 3]
    for row in rows:
        centers = np.array(K.kmeans_fit(df, ["a", "b"], row["k"], starts=2))
        gaps = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
        labels = gaps.argmin(axis=1)
        assert row["inertia"] == pytest.approx(gaps.min(axis=1).sum())
        assert row["sizes"] == ", ".join(f"{j}: {(labels == j).sum()}" for j in range(row["k"]))
        assert row["silhouette"] == pytest.approx(whole_silhouette(x, labels.tolist())[0], abs=1e-9) and row["standard_error"] == 0
    part = K.k_sweep(df, ["a", "b"], "id", [3], references=64, starts=2).first()
    assert part["standard_error"] > 0 and part["sizes"] == rows[1]["sizes"]


def test_best_matching_is_the_best_permutation():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 6))
        w = rng.integers(0, 12, (n, n)).astype(float)
        chosen = K.best_matching(w)
        assert sorted(chosen) == list(range(n))
        assert w[range(n), chosen].sum() == max(w[range(n), list(p)].sum() for p in permutations(range(n)))


def test_compare_partitions(spark):
    # The best match of both labels of x alone would be 1 of y.
    rows = [("a", 1)] * 5 + [("a", 2)] * 4 + [("b", 1)] * 6 + [("b", 3)] * 1 + [(None, 1)] * 2
    df = spark.createDataFrame(rows, "x string, y int")
    got = {(r["x"], r["y"]): (r["rows"], r["matched"]) for r in K.compare_partitions(df, "x", "y").collect()}
    assert got == {("a", 1): (5, False), ("a", 2): (4, True), ("b", 1): (6, True), ("b", 3): (1, False), (None, 1): (2, False)}
    assert tuple(K.partition_changes(df, "x", "y").first()) == (18, 8, 8 / 18)
    assert tuple(K.partition_changes(df.limit(0), "x", "y").first()) == (0, 0, None)


def test_a_wrong_fit_is_seen(cloud):
    names = ["a", "b", "c"]
    centers = K.kmeans_fit(cloud, names, 3, starts=3)
    assert tuple(K.fit_facts(cloud, names, centers, "id").first())[2:] == (True, True, True)
    wrong = [[x + 1 for x in centers[0]], *centers[1:]]
    assert not all(tuple(K.fit_facts(cloud, names, wrong, "id").first())[2:])
    merged = [centers[0], [x + 0.01 for x in centers[0]], centers[2]]
    assert not all(tuple(K.fit_facts(cloud, names, merged, "id").first())[2:])


def test_seeded_fit_says_whether_it_settled(cloud):
    names = ["a", "b", "c"]
    assert K.kmeans_seeded(cloud, names, "id", 4)[1]
    assert not K.kmeans_seeded(cloud, names, "id", 4, max_rounds=1)[1]


def test_append_scores_fills_gaps(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 1.0), (3, 4.0, 5.0), (4, 9.0, 0.0)], "id long, x double, y double")
    out = C.append_scores(df, ["x", "y"])
    assert out.columns == ["id", "x", "y", "PC1", "PC2"] and out.where("PC1 is null").count() == 0


def test_wide_uncentred_components(spark):
    """Forty features go by the Gram matrix; directions, variances and scores agree with numpy."""
    import numpy as np

    from tidemark.operators import components as C

    values = np.random.default_rng(3).normal(size=(200, 40)) * np.linspace(3, 1, 40) + 1
    names = [f"f{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in values], ", ".join(f"{n} double" for n in names)).repartition(3)
    moments = values.T @ values / 199
    assert np.allclose(C.second_moments(df, names), moments)
    model = C.fit_components(df, names, 3, centred=False)
    assert np.allclose(model.variance, np.sort(np.linalg.eigvalsh(moments))[::-1][:3]) and np.isclose(model.total_variance, np.trace(moments))
    w = np.array(model.loadings)
    assert np.allclose(w @ w.T, np.eye(3)) and np.allclose(w @ moments @ w.T, np.diag(model.variance))
    assert np.allclose(C.second_moments(df.limit(0), names), 0)


def test_drilldown_finds_and_names_separate_groups(spark):
    from tidemark.operators.segments import segment_drilldown

    kinds = [("seed", 0.0, 0.9, 1.0, 10.0), ("multi", 0.1, 0.8, 4.0, 40.0), ("venture", 0.9, 0.0, 2.0, 90.0)]
    rows = [(i, "0" if i < 60 else "1", kind, v + i / 1e4, e, r, t + i / 100, 1.0, v, e) for i in range(75) for kind, v, e, r, t in [kinds[i % 3]]]
    df = spark.createDataFrame(rows, "k int, c string, kind string, venture_ratio double, early_stage_funding_ratio double, funding_rounds double, "
                                     "funding_total_usd double, stage_level double, venture double, early_stage_funding double")
    features = ["venture_ratio", "funding_rounds"]
    tables = segment_drilldown(df, df.select("k", "c", *features), "k", "c", "0", features, starts=3)
    names = {(r["kind"], r["SubCluster_Name"]) for r in tables["rows"].collect()}
    assert names == {("seed", "Small seed-stage"), ("multi", "Early-stage multi-round"), ("venture", "Small / early venture-backed")}
    summary = {r["SubCluster_Name"]: r for r in tables["summary"].collect()}
    assert all(r["rows"] == 20 and abs(r["pct_of_segment"] - 100 / 3) < 1e-9 for r in summary.values())
    assert summary["Early-stage multi-round"]["median_funding_rounds"] == 4.0
    assert tables["profile"].where("feature = 'funding_rounds'").count() == 3
    none = segment_drilldown(df, df.select("k", "c", *features), "k", "c", "absent", features)
    assert [t.count() for t in none.values()] == [0, 0, 0]


def test_starts_of_one_fit_run_at_the_same_time_and_give_the_same_centers(spark, monkeypatch):
    import threading

    from tidemark.operators import kmeans as K

    rows = spark.createDataFrame([(float(i % 7), float(i * i % 11)) for i in range(200)], "a double, b double")
    monkeypatch.setattr(K, "FITS_AT_ONCE", 1)
    alone = K.kmeans_fit(rows, ["a", "b"], 3, starts=2)
    monkeypatch.undo()
    both, fit = threading.Barrier(2, timeout=30), K.KMeans.fit

    def meet(self, *args):
        both.wait()  # broken unless two fits are under way
        return fit(self, *args)

    monkeypatch.setattr(K.KMeans, "fit", meet)
    together = K.kmeans_fit(rows, ["a", "b"], 3, starts=2)
    assert [[round(x, 9) for x in c] for c in together] == [[round(x, 9) for x in c] for c in alone]


def test_existing_scores_number_the_rows_once(spark):
    """Only the numbering shuffles rows, and once; the table is not shuffled to meet the sampled keys."""
    from tidemark.operators.components import existing_scores

    rows = 20_000
    df = spark.range(rows).select("id", (F.col("id") % 3).cast("string").alias("g"), F.rand(1).alias("PC1"), F.rand(2).alias("PC2"))
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm

    def shuffled() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        none = spark.sparkContext._gateway.new_array(jvm.double, 0)
        stages = store.stageList(None, False, False, none, jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = shuffled()
    points = existing_scores(df, "g", "id", 2000).collect()
    assert 1800 <= len(points) <= 2000
    assert shuffled() - before < 1.5 * rows


def test_starts_keep_their_rows_decoded(spark, monkeypatch):
    """No start fits the cached table itself, which it would decode in every round; of large tables fewer fit at once."""
    import threading

    seen, running, most, lock = [], set(), [], threading.Lock()

    class Watched(K.KMeans):
        def fit(self, dataset):
            with lock:
                seen.append((dataset.storageLevel.useMemory, "InMemoryTableScan" in dataset._jdf.queryExecution().toString()))
                running.add(self.uid)
                most.append(len(running))
            try:
                return super().fit(dataset)
            finally:
                with lock:
                    running.remove(self.uid)

    monkeypatch.setattr(K, "KMeans", Watched)
    df = spark.createDataFrame([(i, float(i % 2 * 100 + i % 7), float(i % 3)) for i in range(60)], "id int, x double, y double")
    expected = K.kmeans_fit(df, ["x", "y"], 2, starts=4)
    assert seen == [(False, True)] * 4
    monkeypatch.setattr(K, "VALUES_AT_ONCE", 120, raising=False)
    most.clear()
    assert K.kmeans_fit(df, ["x", "y"], 2, starts=4) == expected
    assert max(most) == 1
