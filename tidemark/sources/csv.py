"""CSV through Spark's own reader, everything as text.

One native pass over the lines tells of each file its header, whether a quoted cell goes over a line end, and how many
records have more or fewer cells than the header. Files are then read by their own header and joined by column name;
only files with line ends inside cells go through the reader that cannot split a file.
"""

from __future__ import annotations

import csv
import io
import warnings
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.values import NUMBER_TEXT, is_missing
from tidemark.operators.schema import unique_headers

_QUOTES = {"quote": '"', "escape": '"'}


def _without(text: Column, part: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(part)))


def cells(record: Column) -> Column:
    """Number of cells of one record: commas outside quotes, and one."""
    return _without(F.when(F.contains(record, F.lit('"')), F.regexp_replace(record, '"[^"]*"', "")).otherwise(record), ",") + 1


def file_shapes(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with a visible line: file, header (bytes of the first such line), open_lines, long, short.

    ``open_lines`` counts lines with an odd number of quotes: without any, every line is a record. ``long`` and ``short``
    count the lines with more and with fewer cells than the header line.
    """
    line = F.col("value")
    lines = spark.read.text(path).where(line.rlike(r"[^\x00-\x20]")).select(
        F.col("_metadata.file_path").alias("file"), cells(line).alias("cells"), (_without(line, '"') % 2).alias("open"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
                 line.cast("binary").alias("text"), cells(line).alias("cells")).alias("line"))
    counts = lines.groupBy("file", "cells").agg(
        F.count(F.lit(1)).alias("n"), F.sum("open").alias("open"), F.min("line").alias("first"))
    other = lambda test: F.aggregate(
        "counts", F.lit(0).cast("bigint"), lambda a, c: a + F.when(test(c["cells"], F.col("first.cells")), c["n"]).otherwise(0))
    return counts.groupBy("file").agg(
        F.sum("open").alias("open_lines"), F.min("first").alias("first"),
        F.collect_list(F.struct("cells", "n")).alias("counts")).select(
        "file", F.col("first.text").alias("header"), "open_lines",
        other(lambda x, y: x > y).alias("long"), other(lambda x, y: x < y).alias("short"))


def _header(spark: SparkSession, shape: Row, encoding: str) -> list[str]:
    text = bytes(shape["header"]).decode(encoding, "replace").removeprefix("\ufeff")
    if text.count('"') % 2:  # a header cell goes over a line end
        first = spark.read.csv(unquote(shape["file"]), header=False, multiLine=True, encoding=encoding, **_QUOTES).first()
        return [(v or "").removeprefix("\ufeff") for v in first]
    return next(csv.reader(io.StringIO(text)))


def _read(spark: SparkSession, path: str, encoding: str, counts: Observation | None, record: str | None, **options: object) -> DataFrame:
    """Read every file by its own header; the pass over the lines runs first, the data stays lazy."""
    shapes = sorted(file_shapes(spark, path).collect(), key=lambda r: r["file"])  # one row a file
    groups: dict[tuple, list[str]] = {}
    for shape in shapes:
        names = tuple(unique_headers(_header(spark, shape, encoding)))
        groups.setdefault((names, shape["open_lines"] > 0), []).append(unquote(shape["file"]))
    if not groups:
        return spark.createDataFrame([], StructType([]))
    long = sum(s["long"] for s in shapes if not s["open_lines"])
    if long and not record and counts is None:
        warnings.warn(f"{long} records of {path} have more cells than their header; `record` keeps their text", stacklevel=3)
    watched = record is not None or counts is not None
    taken = {n.lower() for names, _ in groups for n in names}
    text = record or "_record"
    while text.lower() in taken:
        text += "_"
    parts = []
    for (names, open_lines), files in groups.items():
        fields = [StructField(n, StringType()) for n in (*names, *([text] if watched else []))]
        part = spark.read.schema(StructType(fields)).csv(
            path if len(groups) == 1 else files, header=True, enforceSchema=True, multiLine=open_lines, mode="PERMISSIVE",
            columnNameOfCorruptRecord=text, encoding=encoding, **_QUOTES, **options)
        parts.append(part.withColumn(f"{text}_over", cells(F.col(f"`{text}`")) - len(names)) if watched else part)
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if counts is not None:
        over = F.col(f"`{text}_over`")
        out = out.observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if(over > 0).alias("long"), F.count_if(over < 0).alias("short"))
    if not watched:
        return out
    kept = [c for c in out.columns if c not in (text, f"{text}_over")]
    return out.select(*[F.col(f"`{c}`") for c in kept], *([F.col(f"`{text}`")] if record else []))


def scan_csv(spark: SparkSession, *paths: str, encoding: str = "ISO-8859-1", counts: Observation | None = None,
             record: str | None = None) -> DataFrame:
    """First of the given paths that exists, as text columns; files split across tasks.

    Files of a folder may have other columns, or the same ones in another order: columns are matched by name, and one
    that a file does not have is null there. A file with a line end inside a quoted cell is read whole by one task.
    Records that are too short are padded. Of one that is too long the surplus cells are in no column: ``record`` names
    a column that holds the text of every record with another number of cells than the header (null elsewhere), and
    ``counts`` counts rows, long and short records while the result is used. Without either a warning gives the number.
    The encoding has to extend ASCII.
    """
    missing: Exception | None = None
    for path in paths:
        try:
            return _read(spark, path, encoding, counts, record)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = error
    raise missing or ValueError("no path given")


def scan_csv_lenient(spark: SparkSession, path: str, encoding: str = "UTF-8", counts: Observation | None = None,
                     record: str | None = None) -> DataFrame:
    """As ``scan_csv``; also trimmed cells, empty text as null, blank records skipped."""
    raw = _read(spark, path, encoding, counts, record, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    if not raw.columns:
        return raw
    values = [c for c in raw.columns if c != record]
    trimmed = {c: F.regexp_replace(F.col(f"`{c}`"), r"^[\ufeff\s]+|\s+$", "") for c in values}
    out = raw.select(*[F.when(t != "", t).alias(c) for c, t in trimmed.items()], *([F.col(f"`{record}`")] if record else []))
    return out.dropna("all", subset=[f"`{c}`" for c in values])


def with_numbers(df: DataFrame) -> DataFrame:
    """Cast the text columns in which every present value is a plain number; one aggregate decides.

    A column without any value counts as a number. Text such as "1,750" keeps its column as text.
    """
    def quoted(name: str):
        return F.col("`" + name.replace("`", "``") + "`")

    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not texts:
        return df
    # The usual spellings of "no number" do not make a column text.
    plain = {c: F.when(~is_missing(quoted(c)) & ~F.lower(F.trim(quoted(c))).isin("nan", "na", "n/a", "null"), F.trim(quoted(c)))
             for c in texts}
    odd = df.agg(*[F.count_if(plain[c].isNotNull() & ~plain[c].rlike(NUMBER_TEXT)).alias(f"o{i}")
                   for i, c in enumerate(texts)]).first()
    numbers = {c for c, n in zip(texts, odd) if n == 0}
    return df.select(*[plain[c].try_cast("double").alias(c) if c in numbers else quoted(c) for c in df.columns])
