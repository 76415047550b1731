"""Missing values, number and date coercion, bounds and rounding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Fixed value: the text shown in place of a missing value.
MISSING = "(missing)"

# Plain decimal text. Spark's own cast also takes suffixes such as "12d", which are not numbers here.
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: Column | str) -> Column:
    """Null or text without a visible character."""
    c = col(c)
    return c.isNull() | ~c.cast("string").rlike(r"\S")


def display_value(c: Column | str) -> Column:
    return F.when(is_missing(c), F.lit(MISSING)).otherwise(col(c).cast("string"))


def has_value(c: Column | str) -> Column:
    """Stricter presence test: the placeholder text counts as missing too."""
    return ~is_missing(c) & (F.trim(col(c).cast("string")) != MISSING)


def display_or(c: Column | str, fallback: str) -> Column:
    return F.when(has_value(c), display_value(c)).otherwise(F.lit(fallback))


def finite(c: Column | str) -> Column:
    """The value as double; NaN and infinities become null."""
    x = col(c).cast("double")
    # NaN sorts above infinity, so this comparison rejects it too.
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def _number_from_text(text: Column) -> Column:
    text = F.trim(text)
    return F.when(text.rlike(NUMBER_TEXT), finite(text.try_cast("double")))


def coerce_number(c: Column | str) -> Column:
    """Text with thousands commas to double; anything else becomes null."""
    return _number_from_text(F.regexp_replace(col(c), ",", ""))


def coerce_number_symbols(c: Column | str) -> Column:
    """As ``coerce_number``, also ignoring ``$`` and ``%``."""
    return _number_from_text(F.regexp_replace(col(c), "[$%,]", ""))


def coerce_number_suffix(c: Column | str) -> Column:
    """Money text such as ``$1.2M``, ``3 billion``, ``5k`` or ``12 percent`` to double."""
    raw = F.lower(F.trim(col(c)))
    word_factor = (
        F.when(raw.rlike(r"\bbillion\b"), 1e9)
        .when(raw.rlike(r"\bmillion\b"), 1e6)
        .when(raw.rlike(r"\bthousand\b"), 1e3)
        .otherwise(1.0)
    )
    text = F.regexp_replace(raw, r"[,$€£¥₹\s]", "")
    text = F.regexp_replace(text, "percent|percentage|usd|eur|gbp|billion|million|thousand", "")
    factor = (
        F.when(text.endswith("k"), 1e3)
        .when(text.endswith("m"), 1e6)
        .when(text.endswith("b"), 1e9)
        .otherwise(word_factor)
    )
    digits = F.regexp_replace(text, r"[^0-9.\-]", "")
    # Text without any digit left reads as zero, e.g. "unknown"; a stray "-" or "." does not parse.
    number = F.when(digits == "", F.lit(0.0)).otherwise(_number_from_text(digits))
    return F.when((raw != "") & ~raw.isin("nan", "n/a"), number * factor)


def as_number(df: DataFrame, name: str) -> Column:
    """Finite double of a column, whatever its stored type."""
    field = df.schema[name]
    if isinstance(field.dataType, NumericType):
        return finite(F.col(name))
    return coerce_number_symbols(F.col(name).cast("string"))


def parse_date_text(c: Column | str) -> Column:
    """``YYYY-MM`` or ``YYYY-MM-DD`` to date, else null."""
    text = col(c).cast("string")
    full = F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}$"), F.concat(text, F.lit("-01"))).when(
        text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text
    )
    return full.try_cast("date")


#: Date formats that a text column may have, in order of preference: shape of the text and pattern to read it by.
DATE_FORMATS = {
    "iso": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"),
    "month": (r"^[0-9]{4}-[0-9]{2}$", "yyyy-MM"),
    "slashed": (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    "month_first": (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    "day_first": (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "d/M/yyyy"),
    "dotted": (r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$", "d.M.yyyy"),
    "named": (r"^[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4}$", "MMM d, yyyy"),
}


def parse_date_as(c: Column | str, name: str) -> Column:
    """Text of one of ``DATE_FORMATS`` to date; text of another shape, and a day that does not exist, become null."""
    shape, pattern = DATE_FORMATS[name]
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(shape), F.try_to_date(text, pattern))


def date_formats(df: DataFrame, c: str) -> DataFrame:
    """(format, rows, of): how many of the visible values each format reads, from one aggregate."""
    counts = df.agg(F.count_if(~is_missing(c)).alias("of"), *[F.count(parse_date_as(c, n)).alias(n) for n in DATE_FORMATS])
    return counts.select("of", F.inline(F.array(*[F.struct(F.lit(n).alias("format"), F.col(n).alias("rows")) for n in DATE_FORMATS])))


def infer_date_format(df: DataFrame, c: str) -> tuple[str | None, bool]:
    """The format that reads the most values of a text column (the earlier of equals), and whether another reads as many.

    ``(None, False)`` if none reads a value.
    """
    counts = {r["format"]: r["rows"] for r in date_formats(df, c).collect()}
    best = max(counts, key=counts.get)
    return (best, sum(n == counts[best] for n in counts.values()) > 1) if counts[best] else (None, False)


def clip(c: Column | str, low: float, high: float) -> Column:
    """Bound to [low, high]; null stays null."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), c)))


def safe_ratio(part: Column | str, total: Column | str) -> Column:
    """part / total in [0, 1]; a zero or missing total or part gives 0."""
    ratio = F.coalesce(F.try_divide(col(part), col(total)), F.lit(0.0))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio))


def raw_share(part: Column | str, total: Column | str) -> Column:
    """part / total where the total is positive, else 0; not bounded, null part stays null."""
    total = col(total)
    return F.when(total > 0, F.try_divide(col(part), total)).otherwise(F.lit(0.0))


def log1p(c: Column | str) -> Column:
    return F.log1p(col(c).cast("double"))


def round_half_even(c: Column | str, digits: int = 0) -> Column:
    return F.bround(col(c), digits)


def round_half_up(c: Column | str) -> Column:
    """Nearest integer, ties toward plus infinity."""
    return F.floor(col(c) + F.lit(0.5)).cast("double")


def sum_parts(*parts: Column | str) -> Column:
    """Sum that is null as soon as one part is null."""
    return reduce(lambda a, b: a + b, [col(p) for p in parts])


def ladder_level(columns: list[str], available: list[str] | None = None) -> Column:
    """Highest rung (1-based) whose amount is positive, 0 if none; absent columns keep their number."""
    rungs = [
        F.when(F.col(c) > 0, F.lit(i)).otherwise(F.lit(0))
        for i, c in enumerate(columns, start=1)
        if available is None or c in available
    ]
    return F.greatest(F.lit(0), F.lit(0), *rungs)


def all_zero(columns: list[str]) -> Column:
    """True when every listed amount is exactly 0; a null is not 0."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(c) == 0, F.lit(False)) for c in columns])


def zero_count(columns: list[str]) -> Column:
    """How many of the listed amounts are exactly 0 in this row."""
    return reduce(lambda a, b: a + b, [F.when(F.col(c) == 0, 1).otherwise(0) for c in columns])


def dominant(columns: list[str]) -> tuple[Column, Column]:
    """(name, amount) of the largest positive amount; the first listed wins ties, none gives nulls."""
    if not columns:
        return F.lit(None).cast("string"), F.lit(None).cast("double")
    # One struct per source, so each amount appears once however often the result is used.
    best = F.array_max(F.array(*[
        F.struct(F.coalesce(finite(c), F.lit(0.0)).alias("amount"), F.lit(-i).alias("place"), F.lit(c).alias("name"))
        for i, c in enumerate(columns)
    ]))
    return F.when(best["amount"] > 0, best["name"]), F.when(best["amount"] > 0, best["amount"])
