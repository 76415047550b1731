"""Loading several configured tables, and writing results."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.csv import scan_csv_lenient

# Fixed value: longest name of a report table.
REPORT_NAME_LENGTH = 31


@dataclass(frozen=True)
class Source:
    id: str
    path: str
    required: bool = False
    format: str = "csv"


def load_sources(spark: SparkSession, sources: list[Source]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables by id, and (id, required, error) with a null error for the loaded ones.

    A required table that cannot be read raises; an optional one is only recorded.
    """
    tables: dict[str, DataFrame] = {}
    outcome: list[tuple[str, bool, str | None]] = []
    for source in sources:
        try:
            if source.format == "csv":
                tables[source.id] = scan_csv_lenient(spark, source.path)
            else:
                tables[source.id] = spark.read.format(source.format).load(source.path)
            outcome.append((source.id, source.required, None))
        except PySparkException as error:
            outcome.append((source.id, source.required, error.getCondition() or type(error).__name__))
    failed = [f"{i}: {e}" for i, required, e in outcome if required and e]
    if failed:
        raise ValueError("; ".join(failed))
    rows = [F.struct(F.lit(i).alias("id"), F.lit(r).alias("required"), F.lit(e).cast("string").alias("error"))
            for i, r, e in outcome]
    return tables, spark.range(1).select(F.inline(F.array(*rows)))


def write_csv(df: DataFrame, path: str) -> str:
    """One header per file, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def _folder(spark: SparkSession, path: str):
    """(file system, Hadoop path) of a path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def recover_rewrite(spark: SparkSession, path: str, staging: str) -> str:
    """Bring a rewrite that was cut off to an end: ``new``, ``old`` or ``none``, by the table that is at ``path`` then.

    If the old table was already set aside, the new one takes its place when it is complete, and the old one comes back
    when it is not. An unfinished new table at ``staging`` is left for the next rewrite to replace.
    """
    files, place = _folder(spark, path)
    _, fresh = _folder(spark, staging)
    _, done = _folder(spark, f"{staging}/_SUCCESS")
    _, aside = _folder(spark, f"{staging}-replaced")
    if not files.exists(aside):
        return "none"
    outcome = "new"
    if not files.exists(place):
        outcome = "new" if files.exists(done) else "old"
        _rename(files, fresh if outcome == "new" else aside, place)
    if outcome == "new":
        files.delete(aside, True)
    return outcome


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"could not rename {source} to {target}")


def rewrite_with_columns(df: DataFrame, path: str, staging: str, fmt: str = "parquet") -> str:
    """Replace the table at ``path`` by ``df``, which may itself read ``path``.

    The new table is complete in ``staging`` (on the same file system) before the old one is touched. Then the old one is
    renamed aside, the new one to ``path``, and the old one deleted; no row is written twice. A failure in between
    is mended by ``recover_rewrite``, which also runs before every rewrite.
    """
    spark = df.sparkSession
    recover_rewrite(spark, path, staging)
    options = {"header": "true"} if fmt == "csv" else {}
    df.write.mode("overwrite").format(fmt).options(**options).save(staging)
    files, place = _folder(spark, path)
    if files.exists(place):
        _rename(files, place, _folder(spark, f"{staging}-replaced")[1])
    _rename(files, _folder(spark, staging)[1], place)
    recover_rewrite(spark, path, staging)
    spark.catalog.refreshByPath(path)
    return path


def report_name(name: str) -> str:
    """Table name without slashes and spaces, at most 31 characters."""
    return re.sub(" ", "_", name.replace("/", "-"))[:REPORT_NAME_LENGTH]


def write_report_set(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One output directory per named table; returns where each went."""
    return {name: write_csv(df, f"{folder}/{report_name(name)}") for name, df in tables.items()}
