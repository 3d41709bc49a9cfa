"""Intermediate tables in the shared folder: written once, read by whoever needs them, dropped when done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from linscore.session import new_folder


# a batch of very long texts would otherwise weigh a gigabyte on either side of the socket
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


class Store:
    """Parquet tables of one run of an operator, below ``spark.checkpoint.dir``.

    A written table survives lost executors and cuts the lineage. ``drop`` takes back what later steps
    and the result no longer read; what the result still reads goes when the session's JVM ends. Arrow batches are kept small while a table is
    written, as tasks hold some at a time; the session's own settings are put back behind it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, new_folder(spark, name)
        system, path = self._place(self.folder)
        system.mkdirs(path)
        system.deleteOnExit(path)

    def _place(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        schema: StructType = df.schema
        before = {key: self.spark.conf.get(key, None) for key in BATCHES}
        try:
            for key, value in BATCHES.items():
                self.spark.conf.set(key, value)
            df.write.mode("overwrite").parquet(self.path(name))
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            system, path = self._place(self.path(name))
            system.delete(path, True)
