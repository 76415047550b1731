"""Exact order statistics and mid-ranks that hold at any number of rows and distinct values.

Two ways, chosen by measured size:

* Small tables (``SMALL_ROWS``): Spark's ``percentile`` aggregate. It merges the value -> count
  maps of all tasks of a group in one task, which is fast only while the table is small.
* Larger ones: the values are counted first (a hot value becomes one row per map task), cut into
  buckets at approximate quantiles, and a running count is taken inside each bucket on top of
  the bucket totals. The approximate cut points decide only which task a value goes to, so the
  result is exact, and no task ever holds a whole column or a whole group.

A few quantiles of a larger table need no ranks of all values: approximate ones bracket them, counts prove that they
lie within, and only the values inside the brackets are counted one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import as_number
from tidemark.session import cut_lineage

SMALL_ROWS = 5_000_000
# Up to this many distinct values one bucket, and a lookup table of this size, are small.
SMALL_DISTINCT = 200_000
VALUES_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4096
# Approximate quantiles that bracket exact ones: their rank is rarely off by a share of 10 / ACCURACY, which is three to
# four times the sketch's usual error. Sketches are kept for at most BRACKETED_GROUPS groups; groups of up to
# 4 * ACCURACY values are counted whole.
ACCURACY = 4096
BRACKETED_GROUPS = 1000
# A value held by more than one row in HOT_SHARE is looked up apart; there are at most HOT_SHARE of them.
HOT_SHARE = 1000

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


@dataclass(frozen=True)
class Spread:
    """Measured size of one column: rows, approximate distinct count and bucket cut points."""

    rows: int
    distinct: int
    splits: tuple[float, ...] = ()


def measure_spread(df: DataFrame, columns: list[str], small: int = SMALL_DISTINCT,
                   per_bucket: int = VALUES_PER_BUCKET, unique: bool = False) -> dict[str, Spread]:
    """One bounded aggregate per call, and a second one only for columns above ``small``.

    Cut points are quantiles of the distinct values, so a value that most rows hold takes no more than its place. Values
    that are ``unique`` are distinct as they are and not shuffled for it.
    """
    if not columns:
        return {}
    rows, *counts = df.agg(F.count(F.lit(1)), *[F.approx_count_distinct(as_number(df, c)) for c in columns]).first()
    distinct = dict(zip(columns, counts))
    large = [c for c in columns if distinct[c] > small]
    splits: dict[str, tuple[float, ...]] = {}
    if large:
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), as_number(df, c).alias("value")) for c in large])
        values = df.select(F.inline(cells)).where("value is not null")
        values = values if unique else values.distinct()
        aggs = []
        for i, c in enumerate(large):
            buckets = min(MAX_BUCKETS, max(2, distinct[c] // per_bucket + 1))
            probs = [i / buckets for i in range(1, buckets)]
            aggs.append(F.percentile_approx(F.when(F.col("feature") == c, F.col("value")), probs, 4 * MAX_BUCKETS).alias(f"c{i}"))
        for c, cuts in zip(large, values.agg(*aggs).first()):
            splits[c] = tuple(sorted(set(cuts or [])))
    return {c: Spread(rows, distinct[c], splits.get(c, ())) for c in columns}


def _with_buckets(df: DataFrame, spreads: dict[str, Spread]) -> DataFrame:
    """Add ``<column>__bucket`` beside each measured column (double columns only)."""
    cut = [c for c, s in spreads.items() if s.splits]
    if cut:
        edges = [[float("-inf"), *spreads[c].splits, float("inf")] for c in cut]
        df = Bucketizer(inputCols=cut, outputCols=[f"{c}__bucket" for c in cut], splitsArray=edges,
                        handleInvalid="keep").transform(df)
    return df.withColumns({f"{c}__bucket": F.lit(0.0) for c in spreads if c not in cut})


def count_values(df: DataFrame, columns: list[str], by: list[str], spreads: dict[str, Spread]) -> DataFrame:
    """(by..., feature, bucket, value, ties): one row per distinct finite value."""
    numbers = df.select(*by, *[as_number(df, c).alias(c) for c in columns])
    numbers = _with_buckets(numbers, {c: spreads[c] for c in columns})
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__bucket").alias("bucket"), F.col(c).alias("value"))
        for c in columns
    ])
    return (
        numbers.select(*by, F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy(*by, "feature", "bucket", "value")
        .agg(F.count(F.lit(1)).alias("ties"))
    )


def running_counts(counts: DataFrame, keys: list[str], bucketed: bool) -> DataFrame:
    """Add ``below`` (rows strictly lower within ``keys``) and ``n`` (all rows within ``keys``).

    Windows are over the bucket totals (a few thousand rows per key) and over one bucket at a time.
    Without buckets, that is with few distinct values, one window per key does.
    """
    if not bucketed:
        key = Window.partitionBy(*keys)
        lower = key.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumns({"below": F.coalesce(F.sum("ties").over(lower), F.lit(0)), "n": F.sum("ties").over(key)})
    # Read twice below; written once, so that the table behind it is scanned and shuffled once.
    counts = cut_lineage(counts)
    totals = counts.groupBy(*keys, "bucket").agg(F.sum("ties").alias("in_bucket"))
    by_bucket = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.col("bucket").alias("_o_bucket"),
        F.coalesce(F.sum("in_bucket").over(by_bucket), F.lit(0)).alias("before"),
        F.sum("in_bucket").over(Window.partitionBy(*keys)).alias("n"),
    )
    # Null group keys match each other.
    same = F.col("bucket") == F.col("_o_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    by_value = Window.partitionBy(*keys, "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.join(offsets, same)
        .withColumn("below", F.col("before") + F.coalesce(F.sum("ties").over(by_value), F.lit(0)))
        .drop("before", "_o_bucket", *[f"_o_{k}" for k in keys])
    )


def exact_quantiles(df: DataFrame, columns: list[str], probs: dict[str, float] | None = None,
                    by: list[str] | None = None, small_rows: int = SMALL_ROWS, small: int = SMALL_DISTINCT,
                    per_bucket: int = VALUES_PER_BUCKET, rows: int | None = None, groups: int = BRACKETED_GROUPS,
                    accuracy: int = ACCURACY) -> DataFrame:
    """Long table (by..., feature, <one column per quantile>), linear interpolation at (n-1)*p.

    Only finite values count; a feature without any gives nulls. Null group keys form a group.
    ``rows`` saves the counting job where the caller knows the size of the table. Above ``small_rows`` the quantiles are
    bracketed if there are at most ``groups`` groups, else all values are ranked.
    """
    probs = probs or QUARTILES
    by = by or []
    if (df.count() if rows is None else rows) <= small_rows:
        aggs = [F.percentile(as_number(df, c), list(probs.values())).alias(f"q{i}") for i, c in enumerate(columns)]
        cells = F.array(*[
            F.struct(F.lit(c).alias("feature"), *[F.col(f"q{i}")[j].alias(name) for j, name in enumerate(probs)])
            for i, c in enumerate(columns)
        ])
        return df.groupBy(*by).agg(*aggs).select(*by, F.inline(cells))
    if groups and (not by or df.select(*by).distinct().count() <= groups):
        found = _bracketed_quantiles(df, columns, probs, by, accuracy)
        if found is not None:
            return found
    return _ranked_quantiles(df, columns, probs, by, measure_spread(df, columns, small, per_bucket))


def _bracketed_quantiles(df: DataFrame, columns: list[str], probs: dict[str, float], by: list[str],
                         accuracy: int) -> DataFrame | None:
    """The quantiles from three scans that shuffle only values near them; None if a bracket misses its quantile.

    A bracket is a pair of approximate quantiles below and above the wanted one. The rows below and within it are counted,
    which proves that the wanted places lie within; then the distinct values within are counted and ranked. One row a
    group reaches every task.
    """
    places = [(j, i) for j in range(len(columns)) for i in range(len(probs))]
    numbers = df.select(*by, *[as_number(df, c).alias(f"_v{j}") for j, c in enumerate(columns)])
    cuts = [min(1.0, max(0.0, p + side * 10 / accuracy)) for p in probs.values() for side in (-1, 1)]
    sketches = [F.kll_sketch_agg_double(f"_v{j}", accuracy).alias(f"_c{j}") for j in range(len(columns))]
    sketches += [(F.count(f"_v{j}") <= 4 * accuracy).alias(f"_all{j}") for j in range(len(columns))]
    cut = lambda j, i: F.kll_sketch_get_quantile_double(f"_c{j}", F.lit(cuts[i]))
    ends = {}
    for j, i in places:
        ends[f"_lo{j}_{i}"] = F.when(F.col(f"_all{j}"), float("-inf")).otherwise(cut(j, 2 * i))
        ends[f"_hi{j}_{i}"] = F.when(F.col(f"_all{j}"), float("inf")).otherwise(cut(j, 2 * i + 1))
    edges = numbers.groupBy(*by).agg(*sketches).select(*by, *[x.alias(name) for name, x in ends.items()])
    if by:
        # Written: both scans below read it. Null group keys match each other.
        edges = cut_lineage(edges.withColumnsRenamed({b: f"_g{k}" for k, b in enumerate(by)}))
        same = [F.col(b).eqNullSafe(F.col(f"_g{k}")) for k, b in enumerate(by)]
        near = numbers.join(F.broadcast(edges), same)
        edge = {name: F.col(name) for name in ends}
    else:
        found = edges.first()
        near = numbers
        edge = {name: F.lit(found[name]).cast("double") for name in ends}
    lo, hi = (lambda j, i: edge[f"_lo{j}_{i}"]), (lambda j, i: edge[f"_hi{j}_{i}"])
    inside = {(j, i): (F.col(f"_v{j}") >= lo(j, i)) & (F.col(f"_v{j}") <= hi(j, i)) for j, i in places}

    counted = [F.count(f"_v{j}").alias(f"_n{j}") for j in range(len(columns))]
    counted += [F.count_if(F.col(f"_v{j}") < lo(j, i)).alias(f"_below{j}_{i}") for j, i in places]
    counted += [F.count_if(inside[j, i]).alias(f"_within{j}_{i}") for j, i in places]
    # The edges are the same in all rows of a group.
    counted += [F.first(x).alias(name) for name, x in edge.items()] if by else []
    totals = near.groupBy(*by).agg(*counted)
    share = F.create_map(*[F.lit(x) for i, p in enumerate(probs.values()) for x in (i, float(p))])
    cells = F.array(*[F.struct(
        F.lit(j).alias("_j"), F.lit(i).alias("_i"), F.col(f"_n{j}").alias("n"), F.col(f"_below{j}_{i}").alias("before"),
        F.col(f"_within{j}_{i}").alias("within"), lo(j, i).alias("lo"), hi(j, i).alias("hi")) for j, i in places])
    position = (F.col("n") - 1) * share[F.col("_i")]
    totals = cut_lineage(totals.select(*by, F.inline(cells)).withColumn("position", position))
    held = (F.col("before") <= F.floor("position")) & (F.ceil("position") < F.col("before") + F.col("within"))
    if not totals.where((F.col("n") > 0) & ~held).isEmpty():
        return None

    open_ = {at: x & (lo(*at) < hi(*at)) for at, x in inside.items()}
    values = near.where(reduce(lambda a, b: a | b, open_.values())).select(*by, F.inline(F.array_compact(F.array(*[
        F.when(x, F.struct(F.lit(j).alias("_j"), F.lit(i).alias("_i"), F.col(f"_v{j}").alias("value")))
        for (j, i), x in open_.items()]))))
    keys = [*by, "_j", "_i"]
    values = values.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("ties"))
    single = totals.where(F.col("lo") == F.col("hi")).select(*keys, F.col("lo").alias("value"), F.col("within").alias("ties"))
    lower = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = values.unionByName(single).withColumn("_lower", F.coalesce(F.sum("ties").over(lower), F.lit(0)))
    ranked = ranked.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    rows = totals.join(ranked, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], "left")

    def at(index: Column) -> Column:
        here = (F.col("before") + F.col("_lower") <= index) & (index < F.col("before") + F.col("_lower") + F.col("ties"))
        return F.max(F.when(here, F.col("value")))

    weight = F.col("position") - F.floor("position")
    picked = rows.groupBy(*keys, "position").agg(at(F.floor("position")).alias("a"), at(F.ceil("position")).alias("b"))
    picked = picked.withColumn("value", F.col("a") * (1 - weight) + F.col("b") * weight)
    feature = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_j") + 1).alias("feature")
    return picked.groupBy(*by, feature).agg(*[F.max(F.when(F.col("_i") == i, F.col("value"))).alias(name)
                                             for i, name in enumerate(probs)])


def _ranked_quantiles(df: DataFrame, columns: list[str], probs: dict[str, float], by: list[str],
                      spreads: dict[str, Spread]) -> DataFrame:
    keys = [*by, "feature"]
    ranked = running_counts(count_values(df, columns, by, spreads), keys, any(spreads[c].splits for c in columns))

    def at(index: Column) -> Column:
        here = (F.col("below") <= index) & (index < F.col("below") + F.col("ties"))
        return F.max(F.when(here, F.col("value")))

    aggs = [F.max("n").alias("n")]
    for i, p in enumerate(probs.values()):
        position = (F.col("n") - 1) * F.lit(p)
        aggs += [at(F.floor(position)).alias(f"lo{i}"), at(F.ceil(position)).alias(f"hi{i}")]
    picked = ranked.groupBy(*keys).agg(*aggs)
    values = []
    for i, (name, p) in enumerate(probs.items()):
        position = (F.col("n") - 1) * F.lit(p)
        weight = position - F.floor(position)
        values.append((F.col(f"lo{i}") * (1 - weight) + F.col(f"hi{i}") * weight).alias(name))
    found = picked.select(*[F.col(k).alias(f"_f_{k}") for k in keys], *values)
    # Groups and features without any finite value still get a row of nulls.
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    every = groups.select(*by, F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    same = F.col("feature") == F.col("_f_feature")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_f_{b}"))
    return every.join(found, same, "left").select(*keys, *probs)


def midrank_table(df: DataFrame, columns: list[str], spreads: dict[str, Spread]) -> DataFrame:
    """(feature, value, ties, n, pct): pct = (lower + equal/2) / n * 100, 50 when n < 2."""
    bucketed = any(spreads[c].splits for c in columns)
    ranked = running_counts(count_values(df, columns, [], spreads), ["feature"], bucketed)
    pct = (F.col("below") + F.col("ties") * 0.5) / F.col("n") * 100
    return ranked.select("feature", "value", "ties", "n", F.when(F.col("n") < 2, 50.0).otherwise(pct).alias("pct"))


def attach_by_value(df: DataFrame, key: Column, table: DataFrame, distinct: int, out: str,
                    small: int = SMALL_DISTINCT) -> DataFrame:
    """Left-join ``table(value, ties, n, pct)`` on a row value and name its pct ``out``.

    Beyond ``small`` values the table is read twice, so it should be a written one.

    A table of at most ``small`` values is broadcast (its size was measured). Beyond
    that the values held by more than one row in a thousand, at most a thousand of them, are
    looked up by broadcast, and only the other rows are matched by shuffle. Resolved rows and
    rows without a value are spread over all tasks by a row hash, so no key is hot.
    """
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    rows = df.withColumn("_key", key)
    if distinct <= small:
        lookup = F.broadcast(table.select(F.col("value").alias("_key"), F.col("pct").alias(out)))
        return rows.join(lookup, "_key", "left").drop("_key")
    is_hot = F.col("ties") * HOT_SHARE > F.col("n")
    hot = table.where(is_hot).select(F.col("value").alias("_key"), F.col("pct").alias("_hot"))
    cold = table.where(~is_hot).select(
        F.col("value").alias("_cold_key"), (F.col("ties") % 1).alias("_salt"), F.col("pct").alias("_cold")
    )
    rows = rows.withColumn("_row", row_hash).join(F.broadcast(hot), "_key", "left")
    open_row = F.col("_hot").isNull() & F.col("_key").isNotNull()
    rows = rows.withColumn("_cold_key", F.when(open_row, F.col("_key"))).withColumn(
        "_salt", F.when(open_row, F.lit(0)).otherwise(F.col("_row"))
    )
    return (
        rows.join(cold, ["_cold_key", "_salt"], "left")
        .withColumn(out, F.coalesce("_hot", "_cold"))
        .drop("_key", "_cold_key", "_salt", "_row", "_hot", "_cold")
    )


def midrank_percentile(df: DataFrame, column: str, out: str, small: int = SMALL_DISTINCT,
                       base: DataFrame | None = None) -> DataFrame:
    """Mid-rank percentile of a number among all rows; rows without a number get null.

    ``base`` is the table the ranks are taken from. Pass the original one when adding several
    percentiles in a row, so that each does not recompute the ones before it.
    """
    base = df if base is None else base
    spread = measure_spread(base, [column], small)[column]
    table = midrank_table(base, [column], {column: spread})
    if spread.distinct > small:
        table = cut_lineage(table)
    return attach_by_value(df, as_number(df, column), table, spread.distinct, out, small)


def midrank_percentiles(df: DataFrame, base: DataFrame, numbers: dict[str, Column],
                        small: int = SMALL_DISTINCT) -> DataFrame:
    """Add ``_<name>_pct`` for several numbers at once.

    All columns are measured in one job and ranked in one table, written once and read per column.
    """
    if not numbers:
        return df
    values = base.select(*[x.alias(name) for name, x in numbers.items()])
    spreads = measure_spread(values, list(numbers), small)
    table = cut_lineage(midrank_table(values, list(numbers), spreads))
    for name, x in numbers.items():
        own = table.where(F.col("feature") == name)
        df = attach_by_value(df, x, own, spreads[name].distinct, f"_{name}_pct", small)
    return df


def date_number(column: str) -> Column:
    return F.unix_micros(F.col(column).try_cast("timestamp")).cast("double")


def date_percentile(df: DataFrame, column: str, out: str, small: int = SMALL_DISTINCT,
                    base: DataFrame | None = None) -> DataFrame:
    """Mid-rank percentile of a date or timestamp column."""
    base = (df if base is None else base).select(date_number(column).alias("_when"))
    return midrank_percentile(df.withColumn("_when", date_number(column)), "_when", out, small, base).drop("_when")


def frequency_percentile(df: DataFrame, column: str, out: str, base: DataFrame | None = None,
                         small: int = SMALL_DISTINCT) -> DataFrame:
    """How common the row's category is: mid-rank of its count among all category counts.

    Categories are compared trimmed and in lower case; fewer than two categories give 50,
    a missing category gives null.
    """
    base = df if base is None else base
    name = F.lower(F.trim(F.col(column).cast("string")))
    sizes = base.where(name != "").groupBy(name.alias("category")).agg(F.count(F.lit(1)).alias("rows"))
    # Counts of counts: never more rows than the square root of twice the table.
    steps = sizes.groupBy("rows").agg(F.count(F.lit(1)).alias("ties"))
    ranked = running_counts(steps.withColumnRenamed("rows", "value"), [], False).select(
        F.col("value").alias("rows"),
        F.when(F.col("n") < 2, 50.0).otherwise((F.col("below") + F.col("ties") * 0.5) / F.col("n") * 100).alias("pct"),
    )
    measured = base.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(name).alias("d")).first()
    table = sizes.join(ranked, "rows").select(
        F.col("category").alias("value"), F.col("rows").alias("ties"), F.lit(measured["n"]).alias("n"), "pct"
    )
    if measured["d"] > small:
        table = cut_lineage(table)
    return attach_by_value(df, F.when((name != "") & (name != "(missing)"), name), table, measured["d"], out, small)


def _key_number(df: DataFrame, key: str) -> Column:
    """A number that never falls where the key rises: the key itself, or the first six bytes of a text."""
    if dict(df.dtypes)[key] != "string":
        return as_number(df, key)
    head = F.hex(F.substring(F.encode(F.col(key), "UTF-8"), 1, 6))
    return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")


def _bucketed_rows(df: DataFrame, key: str, small: int, per_bucket: int) -> tuple[DataFrame, bool]:
    """The rows with ``_order`` and ``_bucket``, and whether there is more than one bucket.

    ``_order`` is the key in its own type; the bucket comes from a number, which may be equal for different keys.
    """
    numbered = df.withColumns({"_order": F.col(key), "_place": _key_number(df, key)})
    spread = measure_spread(numbered.select("_place"), ["_place"], small, per_bucket, unique=True)["_place"]
    rows = _with_buckets(numbered, {"_place": spread}).drop("_place")
    return rows.withColumnRenamed("_place__bucket", "_bucket"), bool(spread.splits)


def numbered_rows(df: DataFrame, key: str, by: list[str] | None = None, out: str = "row_number",
                  small: int = SMALL_DISTINCT, per_bucket: int = VALUES_PER_BUCKET) -> DataFrame:
    """1-based position of each row in the order of a unique key (number, date or text), overall or within ``by``.

    Positions are counted bucket by bucket, so neither the table nor a large group is sorted in
    one task. Small tables get one bucket, where this is a plain ``row_number``.
    """
    by = by or []
    rows, bucketed = _bucketed_rows(df, key, small, per_bucket)
    if not bucketed:
        place = F.row_number().over(Window.partitionBy(*by).orderBy("_order"))
        return rows.withColumn(out, place.cast("long")).drop("_order", "_bucket")
    sizes = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col("_bucket").alias("_start_bucket"),
                          F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    here = Window.partitionBy(*by, "_bucket").orderBy("_order")
    same = F.col("_bucket") == F.col("_start_bucket")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    numbered = rows.withColumn("_in_bucket", F.row_number().over(here)).join(starts, same, "left")
    return numbered.withColumn(out, (F.col("_before") + F.col("_in_bucket")).cast("long")).drop(
        "_order", "_bucket", "_start_bucket", "_before", "_in_bucket", *[f"_by_{b}" for b in by]
    )


def rows_at(df: DataFrame, key: str, places: list[int], out: str = "row_number", small: int = SMALL_DISTINCT,
            per_bucket: int = VALUES_PER_BUCKET) -> DataFrame:
    """The rows at a few 1-based places in key order; only the buckets holding one are sorted."""
    rows, _ = _bucketed_rows(df, key, small, per_bucket)
    # At most MAX_BUCKETS counts reach the driver.
    sizes = sorted((r["_bucket"], r["n"]) for r in rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, {}
    for bucket, n in sizes:
        if any(before < p <= before + n for p in places):
            starts[bucket] = before
        before += n
    if not starts:
        return rows.limit(0).withColumn(out, F.lit(0).cast("long")).drop("_order", "_bucket")
    start = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])[F.col("_bucket")]
    here = Window.partitionBy("_bucket").orderBy("_order")
    near = rows.where(F.col("_bucket").isin(*starts)).withColumn(
        out, (start + F.row_number().over(here)).cast("long"))
    return near.where(F.col(out).isin(*places)).drop("_order", "_bucket")


def join_checked(rows: DataFrame, table: DataFrame, key: str, how: str = "inner",
                 limit: int = SMALL_DISTINCT) -> DataFrame:
    """Join a table that has one row per group: broadcast if its counted size allows, else by shuffle.

    The table is written once, so counting it does not compute it twice, and the rows are not
    sent to one task per group only to meet a few values.
    """
    table = cut_lineage(table)
    if table.count() <= limit:
        table = F.broadcast(table)
    return rows.join(table, key, how)
