"""List what to look at in the physical plan of each registered query.

usage: python tools/check_plans.py SF_DIR [name ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SIGNS = {
    "nested loop": r"NestedLoopJoin", "cartesian": r"CartesianProduct", "python": r"(MapInPandas|ArrowEvalPython|BatchEvalPython)",
    "single": r"Exchange SinglePartition", "hash": r"Exchange hashpartitioning", "range": r"Exchange rangepartitioning",
    "broadcast": r"BroadcastHashJoin", "sort-merge": r"SortMergeJoin", "window": r"\bWindow \[", "scans": r"FileScan",
}


def main() -> None:
    from tidemark.plans.catalog import QUERIES
    from tidemark.session import get_spark

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = get_spark("plans", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                              "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            QUERIES[name](spark, sf_dir).explain()
        plan = out.getvalue()
        if os.environ.get("FULL"):
            print(plan)
        found = {k: len(re.findall(p, plan)) for k, p in SIGNS.items()}
        open_windows = [w for w in re.findall(r"\bWindow \[.*", plan) if "windowspecdefinition(" in w
                        and not re.search(r"\], \[[^\]]+\]", w)]
        print(f"{name:28}", " ".join(f"{k}={v}" for k, v in found.items() if v),
              f"OPEN WINDOW {open_windows[0][:160]}" if open_windows else "", flush=True)


if __name__ == "__main__":
    main()
