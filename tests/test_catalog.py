"""Every registered query beside its SQL twin, on the smallest data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_queries import compare, connect  # noqa: E402

from tidemark.plans.catalog import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_k_sweep(spark):
    rows = QUERIES["k_sweep"](spark, SF).orderBy("k").collect()
    assert [r["k"] for r in rows] == list(range(2, 10))
    assert rows[0]["inertia"] > rows[-1]["inertia"] and all(-1 <= r["silhouette"] <= 1 for r in rows)


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
