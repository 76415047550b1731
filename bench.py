"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) chooses the data, BENCH_CPUS (default 8) the threads,
BENCH_QUERIES (comma separated) the queries.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cluster_report", "zero_profile", "prune_sparse_columns", "row_funnel", "column_profile", "describe_numeric",
    "histogram", "group_profile", "crosstab_row_pct", "distinguishing_features", "market_lift", "correlation_matrix",
    "status_by_group", "midrank_percentile", "row_scorecard", "insights", "robust_scale", "covariance", "pca_scores", "quantile_linear_ranked", "midrank_percentile_ranked",
    "kmeans_assign", "kmeans_step", "kmeans_seeded", "silhouette", "segment_summary", "stratified_sample",
]


def main() -> None:
    from tidemark.plans.catalog import QUERIES
    from tidemark.plans.catalog.models import scaled_table
    from tidemark.plans.records import labelled_records
    from tidemark.session import get_spark

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = get_spark("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-bench-")})
    spark.sparkContext.setLogLevel("ERROR")

    def run(plan) -> float:
        start = time.perf_counter()
        plan().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    # The record tables are written once per application; that cost is a line of its own.
    times = {"prepare_records": run(lambda: labelled_records(spark, sf_dir)),
             "scale_records": run(lambda: scaled_table(spark, sf_dir))}
    for name in names:
        times[name] = run(lambda: QUERIES[name](spark, sf_dir))
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
