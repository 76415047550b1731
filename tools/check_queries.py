"""Run registered queries beside their SQL and report differences.

usage: python tools/check_queries.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value + 0.0:.9g}"
    if isinstance(value, list):
        return tuple(_cell(v) for v in value)
    if value is None:
        return "∅"
    return str(value)


KINDS = {"bigint": "int64", "int": "int32", "double": "float64", "string": "str", "boolean": "bool", "date": "date",
         "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "float64", "VARCHAR": "str", "BOOLEAN": "bool",
         "DATE": "date", "array<string>": "str[]", "VARCHAR[]": "str[]"}


def compare(df, con, sql: str) -> str | None:
    """None if equal, else a description of the first difference."""
    got_columns, got_types = list(df.columns), dict(df.dtypes)
    rows = df.collect()
    result = con.execute(sql)
    want_columns = [c[0] for c in result.description]
    want_types = {c[0]: str(c[1]) for c in result.description}
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    order = sorted(got_columns)
    kinds = [(c, KINDS.get(got_types[c], got_types[c]), KINDS.get(want_types[c], want_types[c])) for c in order]
    a = sorted(tuple(_cell(r[c]) for c in order) for r in rows)
    b = sorted(tuple(_cell(r[want_columns.index(c)]) for c in order) for r in want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; extra {sorted(set(a) - set(b))[:2]} missing {sorted(set(b) - set(a))[:2]}"
    for x, y in zip(a, b):
        if x != y:
            return f"{order}\n   spark {x}\n   sql   {y} ({sum(p != q for p, q in zip(a, b))} of {len(a)} rows differ)"
    bad = [k for k in kinds if k[1] != k[2]]
    return f"types {bad}" if bad else None


def main() -> int:
    from tidemark.plans.catalog import QUERIES, SQL
    from tidemark.session import get_spark

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = get_spark("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                              "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = compare(df, con, SQL[name]) if name in SQL else None
            note = "" if name in SQL else f" rows={df.count()} (no SQL)"
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{time.time() - start:6.1f}s{note} {problem or ''}", flush=True)
    print(f"{len(names) - failures} of {len(names)} passed")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
