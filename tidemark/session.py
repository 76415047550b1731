"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Call-site capture costs several milliseconds per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the settings this package is tuned for.

    On a cluster leave ``master`` empty and let spark-submit decide; the shuffle partition
    count then also comes from the cluster (AQE coalesces what is too fine).
    """
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | conf).items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply those settings that a running session still takes."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key) and spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster session without
    it is an error, because a machine-local folder would not survive the loss of that machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for a table that is written and read back."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
