"""Scaling, components, clustering and segment models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import components as C
from tidemark.operators import kmeans as K
from tidemark.operators.scaling import robust_scale, robust_scale_fallback, scale_table
from tidemark.operators.schema import MODEL_FEATURES
from tidemark.operators.segments import MULTI_ROUND_NAME, SUMMARY_MEDIANS, VENTURE_NAME, segment_drilldown, segment_recluster
from tidemark.plans.catalog.registry import PREP, query, rounded, union_sql
from tidemark.plans.catalog.sources import FIT_SQL, SCALED_SQL
from tidemark.plans.catalog.statistics import _STRATA, labelled, long_sql, median_sql
from tidemark.plans.preparation import main_segments, prepare
from tidemark.plans.records import raw_records, staged, table
from tidemark.session import cut_lineage, scratch_path
from tidemark.sources.csv import scan_csv, with_numbers
from tidemark.sources.tables import write_report_set, write_table

KEY = "record_id"
TEN = MODEL_FEATURES[:10]
THREE = ["log_funding_total_usd", "venture_ratio", "early_stage_funding_ratio"]
# Centers given to the assignment queries: scaled total, venture share, early-stage share.
CENTERS = [[0.0, -0.5, 0.5], [0.1, 0.5, -0.5], [-2.0, 1.0, 1.0], [0.5, 0.0, 0.0]]


def scaled_table(spark, sf_dir):
    """Robust-scaled features, written once and shared by the model queries."""
    return staged(spark, sf_dir, "scaled_records", lambda: robust_scale(
        labelled(spark, sf_dir), MODEL_FEATURES, [KEY, "Cluster", "funding_total_usd"]))


SCALED = f"{PREP}, {FIT_SQL}, {SCALED_SQL}"


def distance_sql(center: list[float], features: list[str] = THREE) -> str:
    return "(" + " + ".join(f"pow({f} - ({c}), 2)" for f, c in zip(features, center)) + ")"


NEAREST = "CASE least(" + ", ".join(distance_sql(c) for c in CENTERS) + ") " + " ".join(
    f"WHEN {distance_sql(c)} THEN {i}" for i, c in enumerate(CENTERS)) + " END"


@query("robust_scale", f"WITH {SCALED} SELECT record_id, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in MODEL_FEATURES) + " FROM scaled")
def _robust_scale(spark, sf_dir):
    return rounded(robust_scale(labelled(spark, sf_dir), MODEL_FEATURES, [KEY]))


@query("robust_scale_model", f"WITH {PREP}, {FIT_SQL} SELECT feature, round(center, 6) AS center, round(scale, 6) AS scale FROM fit")
def _robust_scale_model(spark, sf_dir):
    return rounded(scale_table(labelled(spark, sf_dir), MODEL_FEATURES))


# The fallback rule on the two amounts whose IQR is 0, one with gaps, and the total.
_FB = ["private_equity", "gappy", "funding_total_usd"]
_FB_SRC = "src AS (SELECT *, CASE WHEN category_list IS NOT NULL THEN debt_financing END AS gappy FROM prep)"
_FB_FIT = ("ft AS MATERIALIZED (SELECT feature, md, CASE WHEN iqr <> 0 THEN iqr WHEN sd > 0 THEN sd ELSE 1 END AS sc FROM ("
           + long_sql(_FB, f"{median_sql('{c}')} AS md, {median_sql('{c}', .75)} - {median_sql('{c}', .25)} AS iqr, stddev_pop({{c}}) AS sd", "src", "") + "))")
_FB_Z = {c: f"greatest(-8.0::DOUBLE, least(8.0::DOUBLE, (coalesce({c}, (SELECT md FROM ft WHERE feature = '{c}')) - (SELECT md FROM ft WHERE feature = '{c}')) / (SELECT sc FROM ft WHERE feature = '{c}')))" for c in _FB}


def _fallback_source(spark, sf_dir):
    return labelled(spark, sf_dir).withColumn("gappy", F.when(F.col("category_list").isNotNull(), F.col("debt_financing")))


@query("robust_scale_fallback", f"WITH {PREP}, {_FB_SRC}, {_FB_FIT} SELECT record_id, " + ", ".join(f"round({z}, 6) + 0.0 AS {c}" for c, z in _FB_Z.items()) + " FROM src")
def _robust_scale_fallback(spark, sf_dir):
    return rounded(robust_scale_fallback(_fallback_source(spark, sf_dir), _FB, [KEY]))


_PAIRS = [(a, b) for a in MODEL_FEATURES for b in MODEL_FEATURES]


@query("covariance", f"WITH {SCALED} " + union_sql(_PAIRS, lambda i, p: f"SELECT '{p[0]}' AS x, '{p[1]}' AS y, round(covar_samp({p[0]}, {p[1]}), 4) + 0.0 AS value FROM scaled"))
def _covariance(spark, sf_dir):
    return rounded(C.covariance(scaled_table(spark, sf_dir), MODEL_FEATURES).select("x", "y", "value"), 4)


_FB_PAIRS = [(a, b) for a in _FB for b in _FB]


@query("second_moments", f"WITH {PREP}, {_FB_SRC}, {_FB_FIT}, z AS (SELECT " + ", ".join(f"{z} AS {c}" for c, z in _FB_Z.items()) + " FROM src) "
       + union_sql(_FB_PAIRS, lambda i, p: f"SELECT '{p[0]}' AS x, '{p[1]}' AS y, round(sum({p[0]} * {p[1]}) / greatest(1, count(*) - 1), 4) + 0.0 AS value FROM z"))
def _second_moments(spark, sf_dir):
    scaled = robust_scale_fallback(_fallback_source(spark, sf_dir), _FB, [KEY])
    return rounded(C.covariance(scaled, _FB, centred=False).select("x", "y", "value"), 4)


# --- principal components: the SQL finds the directions by repeated multiplication --------------

ROUNDS = 400


def power_sql(cov: str, features: list[str], k: int) -> str:
    """CTEs d1..dk(w, lam): directions of a symmetric matrix given as ``cov(i, row)`` lists."""
    ctes = [f"m0 AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM {cov})"]
    start = "[" + ", ".join(f"CAST({(i + 1) / len(features)} AS DOUBLE)" for i in range(len(features))) + "]"
    for j in range(1, k + 1):
        ctes.append(f"""p{j} AS (SELECT 0 AS s, {start} AS w UNION ALL SELECT s + 1, list_transform(u, lambda x: x / sqrt(list_dot_product(u, u)))
FROM (SELECT s, list_transform((SELECT m FROM m{j - 1}), lambda r: list_dot_product(r, w)) AS u FROM p{j} WHERE s < {ROUNDS}))""")
        ctes.append(f"""d{j} AS MATERIALIZED (SELECT CASE WHEN list_extract(w, list_position(list_transform(w, lambda x: round(abs(x), 9)), list_max(list_transform(w, lambda x: round(abs(x), 9))))) < 0
THEN list_transform(w, lambda x: -x) ELSE w END AS w, list_dot_product(w, list_transform((SELECT m FROM m0), lambda r: list_dot_product(r, w))) AS lam FROM p{j} WHERE s = {ROUNDS})""")
        ctes.append(f"""m{j} AS MATERIALIZED (SELECT list_transform(m, lambda r, i: list_transform(r, lambda c, q: c - lam * list_extract(w, i) * list_extract(w, q))) AS m FROM m{j - 1}, d{j})""")
    return ", ".join(ctes)


_COV_ROWS = "cov AS (" + union_sql(MODEL_FEATURES, lambda i, a: (
    f"SELECT {i} AS i, [" + ", ".join(f"covar_samp({a}, {b})" for b in MODEL_FEATURES) + "] AS r FROM scaled")) + ")"
_RECURSIVE = "WITH RECURSIVE " + SCALED + ", " + _COV_ROWS
_TRACE = "(SELECT " + " + ".join(f"var_samp({c})" for c in MODEL_FEATURES) + " FROM scaled)"
_VECTOR = "[" + ", ".join(f"{c} - (SELECT avg({c}) FROM scaled)" for c in MODEL_FEATURES) + "]"


@query("pca_variance", f"""WITH {SCALED} SELECT CAST({len(MODEL_FEATURES)} AS BIGINT) AS components, round({_TRACE}, 4) AS total_variance, 1.0::DOUBLE AS cumulative""")
def _pca_variance(spark, sf_dir):
    table_ = C.explained_variance(scaled_table(spark, sf_dir), MODEL_FEATURES)
    return table_.agg(F.count(F.lit(1)).alias("components"), F.round(F.sum("variance"), 4).alias("total_variance"),
                      F.round(F.max("cumulative"), 6).alias("cumulative"))


@query("pca_components", f"{_RECURSIVE}, {power_sql('cov', MODEL_FEATURES, 3)} "
       + union_sql([1, 2, 3], lambda i, j: f"SELECT 'PC{j}' AS component, CAST({j} AS BIGINT) AS k, round(lam / {_TRACE}, 4) AS ratio, round(list_max(w), 4) AS top_loading FROM d{j}"))
def _pca_components(spark, sf_dir):
    model = C.fit_components(scaled_table(spark, sf_dir), MODEL_FEATURES, 3)
    loadings = model.table(spark)
    ratio = F.create_map(*[F.lit(x) for k, r in enumerate(model.ratio) for x in (f"PC{k + 1}", float(r))])
    return loadings.groupBy("component").agg(F.max("loading").alias("top_loading")).select(
        "component", F.substring("component", 3, 9).cast("long").alias("k"),
        F.round(F.element_at(ratio, F.col("component")), 4).alias("ratio"), F.round("top_loading", 4).alias("top_loading"))


@query("pca_scores", f"{_RECURSIVE}, {power_sql('cov', MODEL_FEATURES, 3)}, x AS (SELECT record_id, {_VECTOR} AS v FROM scaled) SELECT record_id, "
       + ", ".join(f"round(list_dot_product(v, (SELECT w FROM d{j})), 4) + 0.0 AS \"PC{j}\"" for j in (1, 2, 3)) + " FROM x")
def _pca_scores(spark, sf_dir):
    return rounded(C.pca_scores(scaled_table(spark, sf_dir), MODEL_FEATURES, 3, [KEY]), 4)


_FB_COV = "cov AS (" + union_sql(_FB, lambda i, a: (
    f"SELECT {i} AS i, [" + ", ".join(f"sum({a} * {b}) / greatest(1, count(*) - 1)" for b in _FB) + "] AS r FROM z")) + ")"


@query("pca_scores_uncentered", f"WITH RECURSIVE {PREP}, {_FB_SRC}, {_FB_FIT}, z AS MATERIALIZED (SELECT record_id, " + ", ".join(f"{z} AS {c}" for c, z in _FB_Z.items())
       + f" FROM src), {_FB_COV}, {power_sql('cov', _FB, 3)} SELECT record_id, "
       + ", ".join(f"round(list_dot_product([{', '.join(_FB)}], (SELECT w FROM d{j})), 4) + 0.0 AS \"PC{j}\"" for j in (1, 2, 3)) + " FROM z")
def _pca_scores_uncentered(spark, sf_dir):
    return rounded(C.pca_scores_uncentred(_fallback_source(spark, sf_dir), _FB, [KEY]), 4)


@query("group_center_2d", f"{_RECURSIVE}, {power_sql('cov', MODEL_FEATURES, 2)}, x AS (SELECT \"Cluster\", {_VECTOR} AS v FROM scaled), "
       "y AS (SELECT \"Cluster\", " + ", ".join(f"list_dot_product(v, (SELECT w FROM d{j})) AS \"PC{j}\"" for j in (1, 2)) + " FROM x) SELECT \"Cluster\", feature, round(v, 3) + 0.0 AS median FROM ("
       + long_sql(['"PC1"', '"PC2"'], f"{median_sql('{c}')} AS v", "y").replace("'\"PC1\"'", "'PC1'").replace("'\"PC2\"'", "'PC2'") + ")")
def _group_center_2d(spark, sf_dir):
    scores = C.pca_scores(scaled_table(spark, sf_dir), MODEL_FEATURES, 2, [KEY, "Cluster"])
    return rounded(C.group_centres(scores, "Cluster", ["PC1", "PC2"]), 3)


@query("use_existing_scores", f"WITH {PREP}, {_STRATA} SELECT record_id, \"Cluster\", round(log_venture, 6) AS \"PC1\", round(venture_ratio, 6) AS \"PC2\", 0.0::DOUBLE AS \"PC3\" "
       "FROM strata WHERE category_list IS NOT NULL")
def _use_existing_scores(spark, sf_dir):
    df = labelled(spark, sf_dir).select(KEY, "Cluster", F.when(F.col("category_list").isNotNull(), F.col("log_venture")).alias("PC1"),
                                        F.col("venture_ratio").alias("PC2"))
    return rounded(C.existing_scores(df, "Cluster", KEY))


@query("append_scores", f"{_RECURSIVE}, {power_sql('cov', MODEL_FEATURES, 2)}, x AS (SELECT record_id, {_VECTOR} AS v FROM scaled) SELECT prep.record_id, market, funding_total_usd, "
       + ", ".join(f"round(list_dot_product(v, (SELECT w FROM d{j})), 4) + 0.0 AS \"PC{j}\"" for j in (1, 2)) + " FROM prep JOIN x ON x.record_id = prep.record_id")
def _append_scores(spark, sf_dir):
    return rounded(C.append_scores(labelled(spark, sf_dir), MODEL_FEATURES).select(KEY, "market", "funding_total_usd", "PC1", "PC2"), 4)


@query("batch_preparation", f"""WITH {PREP} SELECT record_id, market, funding_total_usd, stage_level, round(early_stage_funding, 4) AS early_stage_funding,
round(venture_ratio, 6) AS venture_ratio, round(log_funding_rounds, 6) AS log_funding_rounds FROM prep""")
def _batch_preparation(spark, sf_dir):
    """The whole way from a raw text file: padded header, total with commas, types and columns decided by the data."""
    raw = raw_records(spark, sf_dir)
    text = raw.withColumn("funding_total_usd", F.concat(F.lit(" "), F.format_number("funding_total_usd", 2), F.lit(" ")))
    path = scratch_path(spark, "raw-csv")
    text.withColumnRenamed("funding_total_usd", " funding_total_usd ").write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    # Written with its types, as the column drop and the preparation would each read the text again.
    typed = spark.read.parquet(write_table(with_numbers(scan_csv(spark, path)), scratch_path(spark, "typed")))
    prepared = prepare(typed, prune=True)
    return rounded(prepared.select(
        F.col("record_id").cast("long").alias("record_id"), "market", "funding_total_usd", "stage_level",
        F.round("early_stage_funding", 4).alias("early_stage_funding"), "venture_ratio", "log_funding_rounds"))


# --- clustering -----------------------------------------------------------------------------------


@query("kmeans_assign", f"WITH {SCALED} SELECT record_id, CAST({NEAREST} AS INTEGER) AS \"Cluster\" FROM scaled")
def _kmeans_assign(spark, sf_dir):
    return K.assign(scaled_table(spark, sf_dir).select(KEY, *THREE), THREE, CENTERS).select(KEY, "Cluster")


@query("kmeans_step", f"WITH {SCALED} SELECT CAST({NEAREST} AS INTEGER) AS cluster, count(*) AS \"rows\", " + ", ".join(
    f"round(avg({f}), 6) + 0.0 AS {f}" for f in THREE) + " FROM scaled GROUP BY 1")
def _kmeans_step(spark, sf_dir):
    return rounded(K.lloyd_step(scaled_table(spark, sf_dir), THREE, CENTERS))


@query("inertia", f"WITH {SCALED} SELECT round(sum(least({', '.join(distance_sql(c) for c in CENTERS)})), 4) AS inertia, count(*) AS \"rows\" FROM scaled")
def _inertia(spark, sf_dir):
    return rounded(K.inertia(scaled_table(spark, sf_dir), THREE, CENTERS), 4)


@query("kmeans_fit", f"WITH {SCALED} SELECT count(*) AS \"rows\", 4::BIGINT AS clusters, true AS settled, true AS nearest, true AS not_worse FROM scaled")
def _kmeans_fit(spark, sf_dir):
    """Fit on three components, then check the fit."""
    scores = cut_lineage(C.pca_scores(scaled_table(spark, sf_dir), MODEL_FEATURES, 3, [KEY]))
    names = ["PC1", "PC2", "PC3"]
    return K.fit_facts(scores, names, K.kmeans_fit(scores, names, 4), KEY)


@query("main_segments", f"WITH {PREP} SELECT count(*) AS \"rows\", 4::BIGINT AS labels, count(DISTINCT record_id) AS keys FROM prep")
def _main_segments(spark, sf_dir):
    prepared = labelled(spark, sf_dir).drop("Cluster")
    out = main_segments(prepared, KEY)
    return out.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("Cluster").alias("labels"), F.countDistinct(KEY).alias("keys"))


_SEED_FEATURES = ["log_funding_total_usd", "venture_ratio", "stage_level"]
SEED_ROUNDS = 45


def seeded_ctes(k: int, features: list[str], tag: str = "") -> list[str]:
    """The seeded clustering unrolled: one CTE of centers per round, which stay once labels stop moving. Labels are in l<tag>."""
    columns = [f"x{i}" for i in range(len(features))]
    fit = f"sf{tag} AS MATERIALIZED (SELECT " + ", ".join(
        f"{median_sql(c)} AS m{i}, CASE WHEN {median_sql(c, .75)} = {median_sql(c, .25)} THEN 1 ELSE {median_sql(c, .75)} - {median_sql(c, .25)} END AS s{i}"
        for i, c in enumerate(features)) + " FROM prep)"
    pts = (f"pts{tag} AS MATERIALIZED (SELECT record_id, row_number() OVER (ORDER BY record_id) - 1 AS p, "
           + ", ".join(f"({c} - m{i}) / s{i} AS x{i}" for i, c in enumerate(features)) + f" FROM prep, sf{tag})")
    ctes = [fit, pts, f"c{tag}0 AS MATERIALIZED (SELECT j, {', '.join(columns)} FROM pts{tag} JOIN (SELECT j, CAST(floor(j / "
            f"{k - 1}.0::DOUBLE * ((SELECT count(*) FROM pts{tag}) - 1)) AS BIGINT) AS at FROM range({k}) t(j)) q ON q.at = pts{tag}.p)"]
    label = "arg_min(c.j, (" + " + ".join(f"pow(p.{x} - c.{x}, 2)" for x in columns) + ", c.j))"
    means = ", ".join(f"coalesce(avg(p.{x}), any_value(c.{x})) AS {x}" for x in columns)
    for r in range(1, SEED_ROUNDS + 1):
        name = f"l{tag}{r}" if r < SEED_ROUNDS else f"l{tag}"
        ctes.append(f"{name} AS MATERIALIZED (SELECT p.record_id, {label} AS j FROM pts{tag} p, c{tag}{r - 1} c GROUP BY 1)")
        ctes.append(f"c{tag}{r} AS MATERIALIZED (SELECT c.j, {means} FROM c{tag}{r - 1} c LEFT JOIN {name} l ON l.j = c.j "
                    f"LEFT JOIN pts{tag} p ON p.record_id = l.record_id GROUP BY c.j)")
    return ctes


def seeded_sql(k: int) -> str:
    return f"WITH {PREP}, " + ", ".join(seeded_ctes(k, _SEED_FEATURES)) + " SELECT record_id, CAST(j AS VARCHAR) AS __cluster FROM l"


@query("kmeans_seeded", seeded_sql(4))
def _kmeans_seeded(spark, sf_dir):
    df = labelled(spark, sf_dir).select(KEY, *_SEED_FEATURES)
    return K.kmeans_seeded_labels(df, _SEED_FEATURES, KEY, 4).select(KEY, "__cluster")


@query("ensure_labels", f"WITH {PREP} SELECT record_id, \"Cluster\" AS label, 4::BIGINT AS labels FROM prep")
def _ensure_labels(spark, sf_dir):
    df, column, k = K.ensure_labels(labelled(spark, sf_dir), MODEL_FEATURES, KEY)
    return df.select(KEY, F.col(column).alias("label"), F.lit(k).cast("long").alias("labels"))


@query("ensure_labels_fallback", seeded_sql(4))
def _ensure_labels_fallback(spark, sf_dir):
    unlabelled = labelled(spark, sf_dir).select(KEY, *_SEED_FEATURES, F.lit(" ").alias("Cluster"))
    df, column, _ = K.ensure_labels(unlabelled, _SEED_FEATURES, KEY)
    return df.select(KEY, F.col(column).alias("__cluster"))


_GAP = " + ".join(f"pow(a.{f} - r.{f}, 2)" for f in THREE)
SILHOUETTE_SQL = f"""WITH {SCALED}, v AS MATERIALIZED (SELECT record_id, "Cluster" AS l, {', '.join(THREE)} FROM scaled),
refs AS MATERIALIZED (SELECT *, place % {K.FOLDS} AS g FROM (SELECT *, row_number() OVER (PARTITION BY l ORDER BY md5(record_id || ':42'), CAST(record_id AS VARCHAR)) AS place FROM v)
  WHERE place <= {K.REFERENCES}),
cells AS MATERIALIZED (SELECT a.record_id, a.l AS own, r.l AS other, r.g, sum(sqrt({_GAP})) AS d, count(*) FILTER (WHERE r.record_id <> a.record_id) AS n
  FROM v a, refs r GROUP BY ALL),
total AS MATERIALIZED (SELECT record_id, own, other, sum(d) AS d, sum(n) AS n FROM cells GROUP BY ALL),
means AS (SELECT record_id, own, other, -1 AS g, d / nullif(n, 0) AS m FROM total UNION ALL
  SELECT t.record_id, t.own, t.other, f.g, (t.d - coalesce(c.d, 0)) / nullif(t.n - coalesce(c.n, 0), 0) FROM total t CROSS JOIN (SELECT unnest(range({K.FOLDS})) AS g) f
  LEFT JOIN cells c ON c.record_id = t.record_id AND c.other = t.other AND c.g = f.g),
sides AS (SELECT record_id, g, max(CASE WHEN own = other THEN m END) AS a, min(CASE WHEN own <> other THEN m END) AS b FROM means GROUP BY ALL),
s AS MATERIALIZED (SELECT g, avg(CASE WHEN a IS NOT NULL AND b IS NOT NULL AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) AS s, count(*) AS n FROM sides GROUP BY g),
most AS (SELECT max(c) AS c FROM (SELECT count(*) AS c FROM refs GROUP BY l))
SELECT round(max(CASE WHEN g < 0 THEN s END), 6) AS silhouette, max(n) AS "rows",
  round(CASE WHEN max(most.c) < {K.REFERENCES} THEN 0 ELSE sqrt({K.FOLDS - 1} * var_pop(s) FILTER (WHERE g >= 0)) END, 6) AS standard_error FROM s, most"""


@query("silhouette", SILHOUETTE_SQL)
def _silhouette(spark, sf_dir):
    return rounded(K.silhouette(scaled_table(spark, sf_dir), THREE, "Cluster", KEY))


@query("k_sweep")
def _k_sweep(spark, sf_dir):
    inside = staged(spark, sf_dir, "segment_scaled", lambda: scaled_table(spark, sf_dir).where(F.col("Cluster") == "0"))
    return rounded(K.k_sweep(inside, MODEL_FEATURES, KEY, range(2, 10)), 3)


SWEEP = [2, 3, 5]


@query("k_sweep_facts", f"WITH {PREP} " + union_sql(SWEEP, lambda i, k: (
    f"SELECT {k} AS k, count(*) AS \"rows\", {k}::BIGINT AS clusters, true AS settled, true AS nearest, true AS not_worse, true AS falls "
    "FROM prep WHERE \"Cluster\" = '0'")))
def _k_sweep_facts(spark, sf_dir):
    """What must hold of the fits that a sweep compares: each is checked by its centers, and more clusters leave less inertia."""
    inside = staged(spark, sf_dir, "segment_scaled", lambda: scaled_table(spark, sf_dir).where(F.col("Cluster") == "0"))
    fits = {k: K.kmeans_fit(inside, MODEL_FEATURES, k) for k in SWEEP}
    left = [K.inertia(inside, MODEL_FEATURES, centers).first()["inertia"] for centers in fits.values()]
    facts = None
    for i, (k, centers) in enumerate(fits.items()):
        one = K.fit_facts(inside, MODEL_FEATURES, centers, KEY).select(
            F.lit(k).alias("k"), "*", F.lit(i == 0 or left[i] < left[i - 1]).alias("falls"))
        facts = one if facts is None else facts.unionByName(one)
    return facts


@query("segment_recluster", f"""WITH {PREP} SELECT count(*) AS "rows", 3::BIGINT AS clusters, true AS settled, true AS nearest, true AS not_worse, true AS sizes_fall
FROM prep WHERE "Cluster" = '0'""")
def _segment_recluster(spark, sf_dir):
    out = segment_recluster(scaled_table(spark, sf_dir), "Cluster", "0", MODEL_FEATURES, 3)
    groups = out.groupBy("SubCluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f) for f in MODEL_FEATURES]).orderBy("SubCluster").collect()
    centers = [[r[f] for f in MODEL_FEATURES] for r in groups]
    # Canonical order: label 0 is the largest.
    falls = all(a["n"] >= b["n"] for a, b in zip(groups, groups[1:]))
    return K.fit_facts(out, MODEL_FEATURES, centers, KEY).withColumn("sizes_fall", F.lit(falls))


@query("segment_drilldown", f"""WITH {PREP} SELECT count(*) AS "rows", 3::BIGINT AS segments, 3::BIGINT AS names, 100.0::DOUBLE AS pct,
CAST(sum(funding_rounds) AS BIGINT) AS funding_rounds, true AS ranked, true AS summarised FROM prep WHERE "Cluster" = '0'""")
def _segment_drilldown(spark, sf_dir):
    """The whole drill-down, its tables written and read again, then what must hold of any fit checked on them."""
    tables = segment_drilldown(labelled(spark, sf_dir), scaled_table(spark, sf_dir), KEY, "Cluster", "0", MODEL_FEATURES)
    folder = scratch_path(spark, "drilldown")
    rows, summary = (spark.read.parquet(write_table(tables[t], f"{folder}/{t}")) for t in ("rows", "summary"))
    write_report_set({t: tables[t] for t in ("summary", "profile")}, f"{folder}/reports")
    made = rows.groupBy("SubCluster", "SubCluster_Name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("funding_rounds").alias("r"), *[F.percentile(c, F.lit(0.5)).alias(f"m_{c}") for c in SUMMARY_MEDIANS])
    both = made.join(summary, ["SubCluster", "SubCluster_Name"], "full")
    same = (F.col("n") == F.col("rows")) & F.lit(True)
    for c, name in SUMMARY_MEDIANS.items():
        same = same & (F.abs(F.col(f"m_{c}") - F.col(name)) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(name)))
    venture, rest = F.col("SubCluster_Name") == VENTURE_NAME, F.col("SubCluster_Name") != VENTURE_NAME
    multi = F.col("SubCluster_Name") == MULTI_ROUND_NAME
    place = F.struct("m_funding_rounds", "m_funding_total_usd")
    ranked = (F.max(F.when(venture, F.col("m_venture_ratio"))) == F.max("m_venture_ratio")) & (F.max(F.when(multi, place)) == F.max(F.when(rest, place)))
    return rounded(both.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("segments"), F.countDistinct("SubCluster_Name").alias("names"),
        F.sum("pct_of_segment").alias("pct"), F.sum("r").cast("long").alias("funding_rounds"), ranked.alias("ranked"),
        F.coalesce(F.bool_and(same), F.lit(False)).alias("summarised")))


_OTHER_FEATURES = ["log_funding_rounds", "log_venture", "early_stage_funding_ratio"]
MATCH_SQL = f"""WITH {PREP}, {', '.join(seeded_ctes(4, _SEED_FEATURES, 'a'))}, {', '.join(seeded_ctes(4, _OTHER_FEATURES, 'b'))},
t AS MATERIALIZED (SELECT la.j AS a, lb.j AS b, count(*) AS n FROM la JOIN lb USING (record_id) GROUP BY ALL),
perms AS (SELECT p, q, r, s FROM range(4) w(p), range(4) x(q), range(4) y(r), range(4) z(s) WHERE p <> q AND p <> r AND p <> s AND q <> r AND q <> s AND r <> s),
best AS MATERIALIZED (SELECT p, q, r, s, sum(CASE WHEN b = [p, q, r, s][a + 1] THEN n ELSE 0 END) AS score FROM perms, t GROUP BY ALL ORDER BY score DESC LIMIT 1),
m AS (SELECT CAST(a AS VARCHAR) AS first, CAST(b AS VARCHAR) AS second, n AS "rows", b = [p, q, r, s][a + 1] AS matched FROM t, best)"""


def two_segmentations(spark, sf_dir):
    """The same records labelled by two fits, on other features each."""
    df = labelled(spark, sf_dir).select(KEY, *_SEED_FEATURES, *_OTHER_FEATURES)
    return K.kmeans_seeded_labels(K.kmeans_seeded_labels(df, _SEED_FEATURES, KEY, 4, "first"), _OTHER_FEATURES, KEY, 4, "second")


@query("compare_partitions", f"{MATCH_SQL} SELECT * FROM m")
def _compare_partitions(spark, sf_dir):
    return K.compare_partitions(two_segmentations(spark, sf_dir), "first", "second")


@query("partition_changes", f"""{MATCH_SQL} SELECT CAST(sum("rows") AS BIGINT) AS "rows", CAST(sum(CASE WHEN matched THEN 0 ELSE "rows" END) AS BIGINT) AS changed,
round(sum(CASE WHEN matched THEN 0 ELSE "rows" END) / sum("rows"), 6) AS share FROM m""")
def _partition_changes(spark, sf_dir):
    return rounded(K.partition_changes(two_segmentations(spark, sf_dir), "first", "second"))


@query("embedding_components", "SELECT count(*) AS \"rows\", 3::BIGINT AS components, true AS centred FROM embeddings")
def _embedding_components(spark, sf_dir):
    """Components of a wide table (64 values) through Spark ML; the scores have mean 0."""
    names = [f"e{i}" for i in range(64)]
    df = table(spark, sf_dir, "embeddings").select("vec_id", *[F.element_at("embedding", i + 1).cast("double").alias(n) for i, n in enumerate(names)])
    scores = C.pca_scores(df, names, 3, ["vec_id"])
    means = F.greatest(*[F.abs(F.avg(f"PC{k}")) for k in (1, 2, 3)])
    return scores.agg(F.count(F.lit(1)).alias("rows"), F.lit(3).cast("long").alias("components"), (means < 1e-9).alias("centred"))


@query("embedding_second_moments", """SELECT i, j, round(sum(embedding[i + 1]::DOUBLE * embedding[j + 1]::DOUBLE) / greatest(1, count(*) - 1), 6) + 0.0 AS value
FROM embeddings, range(64) a(i), range(64) b(j) GROUP BY ALL""")
def _embedding_second_moments(spark, sf_dir):
    """The uncentred form of a wide table: all 64 x 64 moments that its components come from."""
    names = [f"e{i}" for i in range(64)]
    df = table(spark, sf_dir, "embeddings").select(*[F.element_at("embedding", i + 1).cast("double").alias(n) for i, n in enumerate(names)])
    cells = [(i, j, float(v)) for i, row in enumerate(C.second_moments(df, names)) for j, v in enumerate(row)]
    return rounded(spark.createDataFrame(cells, "i long, j long, value double"))
