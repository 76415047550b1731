"""The query registry and the SQL of the shared record tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tidemark.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) plan, and the SQL that gives the same rows."""

    def register(plan):
        QUERIES[name] = lambda spark, sf_dir: plan(tune(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return plan

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns, so that the order of summation does not show; -0 becomes 0."""
    columns = [
        (F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*columns)


def union_sql(items: list, template: Callable[[int, str], str]) -> str:
    return " UNION ALL ".join(template(i, c) for i, c in enumerate(items))


def label_values(mapping: dict) -> str:
    """A VALUES list of key/text pairs."""
    quote = lambda v: "'" + str(v).replace("'", "''") + "'"
    return "(VALUES " + ", ".join(f"({quote(k)}, {quote(v)})" for k, v in mapping.items()) + ")"


_AMOUNTS = {
    "seed": "p_type = 'ECONOMY'",
    "venture": "p_type IN ('STANDARD', 'LARGE')",
    "debt_financing": "p_type = 'PROMO' AND l_returnflag = 'A'",
    "angel": "p_type = 'SMALL' AND l_returnflag = 'R'",
    "grant": "p_type = 'MEDIUM' AND l_returnflag = 'R'",
    "private_equity": "p_type = 'SMALL' AND l_returnflag = 'A'",
    "sparse_a": "p_type = 'PROMO' AND l_linenumber = 7 AND l_returnflag = 'R' AND l_discount = 0",
    **{f"round_{x}": f"l_linenumber = {i}" for i, x in enumerate("ABCDEFG", start=1)},
}
_Q = {c: f'"{c}"' for c in _AMOUNTS}

RAW = (
    "sums AS MATERIALIZED (SELECT l_orderkey, "
    + ", ".join(f"round(coalesce(sum(CASE WHEN {cond} THEN l_extendedprice END), 0), 2) AS {_Q[c]}"
                for c, cond in _AMOUNTS.items())
    + ", count(*) AS funding_rounds FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey), "
    "raw AS MATERIALIZED (SELECT o_orderkey AS record_id, c_name AS name, "
    "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS category_list, "
    "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS market, "
    "CASE o_orderstatus WHEN 'O' THEN 'operating' WHEN 'F' THEN 'acquired' WHEN 'P' THEN 'closed' END AS status, "
    "n_name AS country_code, r_name AS region, concat_ws(' ', r_name, CAST(c_nationkey AS VARCHAR)) AS city, "
    "strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS funding_total_usd, "
    "coalesce(funding_rounds, 0) AS funding_rounds, "
    + ", ".join(f"coalesce({_Q[c]}, 0) AS {_Q[c]}" for c in ("seed", "venture", "debt_financing", "angel", "grant"))
    + ", CASE WHEN o_orderstatus = 'O' THEN coalesce(private_equity, 0) ELSE 0 END AS private_equity, "
    "coalesce(sparse_a, 0) AS sparse_a, "
    + ", ".join(f"coalesce(round_{x}, 0) AS round_{x}" for x in "ABCDEFG")
    + ", CAST(0 AS DOUBLE) AS round_H "
    "FROM orders LEFT JOIN sums ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey "
    "LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"
)

_SOURCES = ["early_stage_funding", "venture", "debt_financing", "private_equity"]
_LOGGED = ["funding_total_usd", "funding_rounds", "early_stage_funding", "venture", "debt_financing", "private_equity"]

STAGE_SQL = "CASE " + " ".join(
    f"WHEN round_{x} > 0 THEN {i}" for i, x in reversed(list(enumerate("ABCDEFGH", start=1)))) + " ELSE 0 END"

PREP = (
    RAW + ", base AS (SELECT DISTINCT record_id, name, category_list, market, status, country_code, city, date, "
    "funding_total_usd, funding_rounds, venture, debt_financing, private_equity, sparse_a, "
    f"CAST({STAGE_SQL} AS INTEGER) AS stage_level, seed + angel + \"grant\" AS early_stage_funding FROM raw "
    "WHERE name IS NOT NULL AND funding_total_usd IS NOT NULL AND market IS NOT NULL AND NOT (seed = 0 AND venture = 0 "
    "AND debt_financing = 0 AND angel = 0 AND \"grant\" = 0 AND private_equity = 0)), "
    "prep AS MATERIALIZED (SELECT *, "
    + ", ".join(f"CASE WHEN coalesce(funding_total_usd, 0) = 0 OR {c} IS NULL THEN 0.0::DOUBLE ELSE "
                f"least(1.0::DOUBLE, greatest(0.0::DOUBLE, {c} / funding_total_usd)) END AS {c}_ratio" for c in _SOURCES)
    + ", " + ", ".join(f"ln(1 + {c}) AS log_{c}" for c in _LOGGED)
    + ", CASE greatest(early_stage_funding, debt_financing, private_equity, venture) "
    "WHEN early_stage_funding THEN '0' WHEN debt_financing THEN '1' WHEN private_equity THEN '2' "
    "WHEN venture THEN '3' END AS \"Cluster\" FROM base)"
)

SEG = (
    PREP + ", seg AS MATERIALIZED (SELECT *, CASE WHEN venture_ratio > 0.15 THEN 1 WHEN funding_rounds >= 5 THEN 0 "
    "ELSE 2 END AS \"SubCluster\" FROM prep WHERE \"Cluster\" = '0')"
)
