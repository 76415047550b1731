"""Column profiles, descriptive statistics, value counts, histograms, correlation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import format_compact
from tidemark.functions.values import (
    MISSING,
    as_number,
    coerce_number_symbols,
    display_value,
    finite,
    is_missing,
    parse_date_text,
)
from tidemark.operators.order import QUARTILES, exact_quantiles

# Share of present values that must parse, and the warning limits.
TYPE_SHARE = 0.86
HEAVY_MISSING = 0.2
IDENTIFIER_SHARE = 0.8
LABEL_COLUMN = "cluster"


def _moments(df: DataFrame, columns: list[str], measures: dict[str, object], by: list[str] | None = None) -> DataFrame:
    """One fused aggregate over all columns, laid out as one row per (by..., feature)."""
    by = by or []
    aggs = [f(as_number(df, c)).alias(f"{m}_{i}") for i, c in enumerate(columns) for m, f in measures.items()]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{m}_{i}").alias(m) for m in measures])
        for i, c in enumerate(columns)
    ])
    return wide.select(*by, F.inline(cells))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; the keys appear once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample standard deviation, min, quartiles, max per column."""
    base = _moments(df, columns, {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    return base.join(exact_quantiles(df, columns), "feature").select(
        "feature", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def variance_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    return _moments(df, columns, {"variance": F.var_samp})


def basic_stats(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """count, min, max, mean, median, q1, q3 and population deviation over finite values."""
    by = by or []
    base = _moments(df, columns, {"count": F.count, "min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_pop}, by)
    quantiles = exact_quantiles(df, columns, QUARTILES, by)
    return join_null_safe(base, quantiles, [*by, "feature"]).select(
        *by, "feature", "count", "min", "max", "mean", "median", "q1", "q3", "std")


def _value_cells(df: DataFrame, order: str) -> DataFrame:
    """(position, column, value, rows, first_at) over the present values of every column, as text."""
    columns = [c for c in df.columns if c != order]
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 F.when(~is_missing(c), F.col(c).cast("string")).alias("value"))
        for i, c in enumerate(columns)
    ])
    return (
        df.select(F.col(order).alias("_order"), F.inline(cells))
        .groupBy("position", "column", "value")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("_order").alias("first_at"))
    )


def _kind() -> Column:
    """number, date or category from the counts ``rows``, ``missing``, ``numbers`` and ``dates``."""
    filled = F.col("rows") - F.col("missing")
    share = lambda c: F.coalesce(F.try_divide(F.col(c), filled), F.lit(0.0))
    return (
        F.when(F.lower("column") == LABEL_COLUMN, "category")
        .when(share("numbers") >= TYPE_SHARE, "number")
        .when(share("dates") >= TYPE_SHARE, "date")
        .otherwise("category")
    )


def _finish(summary: DataFrame) -> DataFrame:
    rate = F.coalesce(F.try_divide(F.col("missing").cast("double"), F.col("rows")), F.lit(0.0))
    return summary.select("position", "column", _kind().alias("type"), "rows", "missing", rate.alias("missing_rate"),
                          "distinct", "example", "numbers", "dates")


def _column_summary(cells: DataFrame) -> DataFrame:
    present = F.col("value").isNotNull()
    parsed = coerce_number_symbols("value").isNotNull()
    dated = parse_date_text("value").isNotNull()
    return _finish(cells.groupBy("position", "column").agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(~present, F.col("rows"))), F.lit(0)).alias("missing"),
        F.count("value").alias("distinct"),
        F.coalesce(F.sum(F.when(parsed, F.col("rows"))), F.lit(0)).alias("numbers"),
        F.coalesce(F.sum(F.when(dated, F.col("rows"))), F.lit(0)).alias("dates"),
        F.min_by("value", F.when(present, F.col("first_at"))).alias("example"),
    ))


def _fused_summary(df: DataFrame, order: str) -> DataFrame:
    """The same summary in one pass without a shuffle of values; ``distinct`` is approximate."""
    columns = [c for c in df.columns if c != order]
    text = {c: F.when(~is_missing(c), F.col(c).cast("string")) for c in columns}
    shown = df.select(F.col(order).alias("_order"), *[t.alias(f"v{i}") for i, t in enumerate(text.values())])
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(columns)):
        v = F.col(f"v{i}")
        aggs += [
            F.count(v).alias(f"filled{i}"), F.approx_count_distinct(v).alias(f"distinct{i}"),
            F.min_by(v, F.when(v.isNotNull(), F.col("_order"))).alias(f"example{i}"),
            F.count_if(coerce_number_symbols(v).isNotNull()).alias(f"numbers{i}"),
            F.count_if(parse_date_text(v).isNotNull()).alias(f"dates{i}"),
        ]
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), (F.col("rows") - F.col(f"filled{i}")).alias("missing"),
                 *[F.col(f"{m}{i}").alias(m) for m in ("distinct", "example", "numbers", "dates")])
        for i, c in enumerate(columns)
    ])
    return _finish(shown.agg(*aggs).select("rows", F.inline(cells)))


def infer_types(df: DataFrame, order: str) -> DataFrame:
    """Number, date or category by the share of present values that parse; one pass."""
    return _fused_summary(df, order).select("position", "column", "type", "rows", "numbers", "dates")


def column_profile(df: DataFrame, order: str, exact: bool = True) -> DataFrame:
    """Per column: type, missing, rate, distinct count, first present value by ``order``.

    Exact distinct counts come from one count of (column, value): copies of a value collapse
    before the shuffle and the keys spread evenly, but columns of unique values are shuffled
    whole. ``exact=False`` takes approximate distinct counts in a single pass instead.
    """
    summary = _column_summary(_value_cells(df, order)) if exact else _fused_summary(df, order)
    return summary.drop("numbers", "dates")


def column_top_values(df: DataFrame, order: str, limit: int = 8) -> DataFrame:
    """The most frequent values of each category column, missing counted as a value."""
    cells = _value_cells(df, order)
    kinds = _column_summary(cells).select("position", "type", F.col("rows").alias("all_rows"))
    ranked = cells.join(kinds, "position").where(F.col("type") == "category").select(
        "position", "column", F.coalesce("value", F.lit(MISSING)).alias("value"), "rows",
        (F.col("rows").cast("double") / F.col("all_rows")).alias("share"))
    place = Window.partitionBy("position", "column").orderBy(F.desc("rows"), "value")
    return ranked.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= limit)


def missing_top(df: DataFrame, limit: int = 12) -> DataFrame:
    """The columns with the largest share of missing values; one pass, no shuffle of values."""
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(is_missing(c)).alias(f"m{i}") for i, c in enumerate(df.columns)])
    cells = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"))
                      for i, c in enumerate(df.columns)])
    counted = wide.select("rows", F.inline(cells)).where(F.col("missing") > 0)
    rate = F.col("missing").cast("double") / F.col("rows")
    return counted.orderBy(F.desc("missing"), "position").limit(limit).select("column", "missing", rate.alias("missing_rate"))


def value_counts(df: DataFrame, column: str, limit: int | None = 12) -> DataFrame:
    """Most frequent values with their share of all rows; missing is a value."""
    counted = df.groupBy(display_value(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    total = counted.agg(F.sum("rows").alias("n")).scalar()  # the same exchange, so the table is read once
    if limit:
        counted = counted.orderBy(F.desc("rows"), "value").limit(limit)
    return counted.withColumn("share", F.col("rows").cast("double") / total)


def unique_labels(df: DataFrame, label: str) -> DataFrame:
    """Distinct non-missing labels, numbers first in numeric order, then text."""
    shown = df.select(display_value(label).alias("label")).where(F.col("label") != MISSING).distinct()
    return shown.orderBy(*natural_order("label"))


def natural_key(label: str) -> Column:
    """Sort key of text with numbers in it: its runs of digits, by value, and of other characters; a2 is before a10."""
    runs = F.regexp_extract_all(F.col(label).cast("string"), F.lit("[0-9]+|[^0-9]+"), F.lit(0))

    def part(run: Column) -> Column:
        digits = F.regexp_replace(run, "^0+(?=.)", "")
        number = run.rlike("^[0-9]")
        return F.struct(F.when(number, 0).otherwise(1).alias("text"), F.when(number, F.length(digits)).otherwise(0).alias("length"),
                        F.when(number, digits).otherwise(run).alias("value"))

    return F.transform(runs, part)


def natural_order(label: str) -> list[Column]:
    """Sort keys: by number where the label is one, then by the runs of digits and of text of the others."""
    return [F.asc_nulls_last(coerce_number_symbols(F.col(label).cast("string"))), natural_key(label).asc(), F.asc(label)]


# --- histogram -----------------------------------------------------------------------------

# Limits of the three histogram cases.
MAX_INTEGER_BARS = 30
ZERO_HEAVY = 0.3
FENCE = 3.0
LOG_SKEW = 20.0


def bin_edges(stats: dict[str, float], trimmed_max: float | None, bins: int) -> list[float]:
    """Edges from summary numbers only: fenced maximum, log spacing when the range is skewed."""
    low, high = stats["min"], stats["max"]
    if trimmed_max is not None and low < trimmed_max < high:
        high = trimmed_max
    if low >= 0 and high > 0 and stats["median"] > 0 and high / stats["median"] > LOG_SKEW:
        shift = 1.0 if low == 0 else 0.0
        start, stop = math.log10(low + shift), math.log10(high + shift)
        inner = [10 ** (start + (stop - start) / bins * i) - shift for i in range(1, bins)]
    else:
        inner = [low + (high - low) / bins * i for i in range(1, bins)]
    return [low, *inner, high]


def _edges_for(df: DataFrame, number: Column, bins: int) -> list[float]:
    """Edges of the finite values of one expression: one aggregate, plus one if a fence is needed."""
    values = df.select(number.alias("x")).where(F.col("x").isNotNull())
    stats = values.agg(F.min("x").alias("min"), F.max("x").alias("max"), F.count("x").alias("n")).first().asDict()
    if stats["min"] == stats["max"]:
        return [stats["min"], stats["max"]]
    stats |= exact_quantiles(values, ["x"], rows=stats["n"]).first().asDict()
    trimmed, spread = None, stats["q3"] - stats["q1"]
    if spread > 0:
        fence = stats["q3"] + FENCE * spread
        trimmed = values.where(F.col("x") <= fence).agg(F.max("x")).first()[0]
    return bin_edges(stats, trimmed, bins)


def _bars(df: DataFrame, spans: list[tuple[float, float, Column]], position: Column) -> DataFrame:
    """Count rows per bar; bars without a row stay with count 0."""
    counted = df.where(position.isNotNull()).groupBy(position.cast("int").alias("bar")).agg(
        F.count(F.lit(1)).alias("rows"))
    frame = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("bar"), F.lit(float(a)).alias("x0"), F.lit(float(b)).alias("x1"),
                 label.cast("string").alias("label"))
        for i, (a, b, label) in enumerate(spans)
    ])))
    return frame.join(counted, "bar", "left").select(
        "bar", "x0", "x1", "label", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))


def _bin_spans(edges: list[float]) -> list[tuple[float, float, Column]]:
    if len(edges) == 2 and edges[0] == edges[1]:
        return [(edges[0], edges[1], format_compact(F.lit(edges[0])))]
    return [
        (a, b, F.concat(format_compact(F.lit(float(a))), F.lit(" – "), format_compact(F.lit(float(b)))))
        for a, b in zip(edges, edges[1:])
    ]


def _bin_position(x: Column, edges: list[float]) -> Column:
    """Half-open bins; a value past the last edge counts in the last bin."""
    position = F.when(x.isNotNull(), F.lit(0))
    for edge in edges[1:-1]:
        position = position + (x >= F.lit(float(edge))).cast("int")
    return position


def histogram_bins(df: DataFrame, column: str, bins: int = 12) -> DataFrame:
    """Continuous histogram of the finite values of a column."""
    x = as_number(df, column)
    edges = _edges_for(df, x, bins)
    return _bars(df, _bin_spans(edges), _bin_position(x, edges))


def histogram(df: DataFrame, column: str, bins: int = 12) -> DataFrame:
    """One bar per small integer, or a zero bar beside bins of all other values, or continuous bins."""
    x = as_number(df, column)
    stats = df.agg(
        F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"),
        F.count_if(x == 0).alias("zeros"), F.count_if(x != F.floor(x)).alias("fractions"),
        F.count_if(x != 0).alias("others"),
    ).first()
    if not stats["n"]:
        return _bars(df, [(0.0, 0.0, F.lit(""))], x).where(F.lit(False))
    if stats["low"] == stats["high"]:
        return histogram_bins(df, column, bins)
    if stats["fractions"] == 0 and stats["high"] - stats["low"] <= MAX_INTEGER_BARS:
        low, high = int(stats["low"]), int(stats["high"])
        return _bars(df, [(v, v, F.lit(str(v))) for v in range(low, high + 1)], x - F.lit(low))
    if stats["zeros"] / stats["n"] > ZERO_HEAVY:
        if not stats["others"]:
            return _bars(df, [(0.0, 0.0, F.lit("0 (all rows)"))], F.when(x == 0, F.lit(0)))
        others = F.when(x != 0, x)
        edges = _edges_for(df, others, max(2, bins - 1))
        spans = [(0.0, 0.0, F.lit("0 (none)")), *_bin_spans(edges)]
        return _bars(df, spans, F.when(x == 0, F.lit(0)).otherwise(_bin_position(others, edges) + 1))
    return histogram_bins(df, column, bins)


# --- correlation ---------------------------------------------------------------------------


def correlation_matrix(df: DataFrame, columns: list[str], limit: int | None = None,
                       known: tuple[int, dict, dict] | None = None) -> DataFrame:
    """(x, y, value) for every ordered pair: Pearson over pairwise-complete rows.

    All pairs come from one aggregate. Null with fewer than three pairs or no variance. A first
    look finds the columns without gaps, whose variance need not be taken again for every pair;
    ``known`` (rows, counts and means by column) saves that look.
    """
    chosen = columns[:limit]
    numbers = df.select(*[as_number(df, c).alias(c) for c in chosen])
    if known:
        rows, counts, means = known[0], [known[1][c] for c in chosen], [known[2][c] for c in chosen]
    else:
        looked = numbers.agg(F.count(F.lit(1)), *[F.count(c) for c in chosen], *[F.avg(c) for c in chosen]).first()
        rows, counts, means = looked[0], looked[1:len(chosen) + 1], looked[len(chosen) + 1:]
    # Around the overall means, plain sums do not lose digits.
    at = [F.col(c) - F.lit(float(m or 0.0)) for c, m in zip(chosen, means)]
    whole = [n == rows for n in counts]
    aggs = []
    for i in range(len(chosen)):
        aggs += [F.sum(at[i]).alias(f"s_{i}"), F.sum(at[i] * at[i]).alias(f"q_{i}")]
        for j in range(i + 1, len(chosen)):
            aggs.append(F.sum(at[i] * at[j]).alias(f"p_{i}_{j}"))
            if not (whole[i] and whole[j]):
                both = F.col(chosen[i]).isNotNull() & F.col(chosen[j]).isNotNull()
                x, y = F.when(both, at[i]), F.when(both, at[j])
                aggs += [F.count_if(both).alias(f"n_{i}_{j}"), F.sum(x).alias(f"x_{i}_{j}"), F.sum(y).alias(f"y_{i}_{j}"),
                         F.sum(x * x).alias(f"xx_{i}_{j}"), F.sum(y * y).alias(f"yy_{i}_{j}")]
    wide = numbers.agg(*aggs)
    cells = []
    for i, a in enumerate(chosen):
        for j, b in enumerate(chosen):
            low, high = min(i, j), max(i, j)
            k = f"{low}_{high}"
            if i == j:
                n, x, y, xx, yy, xy = F.lit(counts[i]), *(F.col(f"{c}_{i}") for c in "ssqqq")
            elif whole[i] and whole[j]:
                n, x, y = F.lit(rows), F.col(f"s_{low}"), F.col(f"s_{high}")
                xx, yy, xy = F.col(f"q_{low}"), F.col(f"q_{high}"), F.col(f"p_{k}")
            else:
                n, x, y, xx, yy, xy = (F.col(f"{c}_{k}") for c in ("n", "x", "y", "xx", "yy", "p"))
            cells.append(F.struct(
                F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(a).alias("x"), F.lit(b).alias("y"), n.alias("n"),
                x.alias("sx"), y.alias("sy"), xx.alias("sxx"), yy.alias("syy"), xy.alias("sxy")))
    # The sums are laid out as rows first, so the formula is compiled once and not once per pair.
    pairs = wide.select(F.inline(F.array(*cells)))
    n, sx, sy, sxx, syy, sxy = (F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy"))
    pairs = pairs.withColumns({"va": n * sxx - sx * sx, "vb": n * syy - sy * sy})
    # A variance at rounding-noise level is no variance.
    real = (n >= 3) & (F.col("va") > n * sxx * 1e-12) & (F.col("vb") > n * syy * 1e-12)
    value = F.when(real, (n * sxy - sx * sy) / (F.sqrt("va") * F.sqrt("vb")))
    return pairs.select("i", "j", "x", "y", value.alias("value"))


def strongest_pair(matrix: DataFrame) -> DataFrame:
    """The pair with the largest absolute correlation; the earlier pair wins ties."""
    pairs = matrix.where((F.col("i") < F.col("j")) & F.col("value").isNotNull())
    best = F.max_by(F.struct("x", "y", "value"), F.struct(F.abs("value"), -F.col("i"), -F.col("j")))
    return pairs.agg(best.alias("p")).select("p.x", "p.y", "p.value").where(F.col("x").isNotNull())
