"""Session settings the library is written for, and the shared folder of a cluster."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # rows of 1,280 floats weigh 5 kB: keep an Arrow batch near 5 MB
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # and a batch of very long texts from weighing a gigabyte on either side of the socket
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
# can only be given when a session is built: keeps PySpark from looking up the call site of every
# column expression, some milliseconds each
BUILD_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else one set on the context, else in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/linscore-work"
        on_this_machine = re.match(r"file:|/|[^:]*$", folder)
        if on_this_machine and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"{folder} is on each machine by itself: set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder not used before, inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The table written to reliable storage once, its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
