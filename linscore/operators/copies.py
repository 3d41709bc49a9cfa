"""Exact copies of rows, counted and spread again without one task getting all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES_PER_TASK = 100_000


def repeat_rows(df: DataFrame, times: str, number: str | None = None) -> DataFrame:
    """Each row ``times`` over, in chunks spread over the shuffle partitions; numbered if wanted."""
    columns = [c for c in df.columns if c != times]
    size = F.lit(COPIES_PER_TASK)
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / size)))
    spread = df.select("*", chunk.alias("_chunk")).repartition(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*columns), F.col("_chunk")
    )
    first = F.col("_chunk") * size
    here = F.sequence(first + 1, F.least(first + size, F.col(times)))
    repeated = spread.select(*columns, F.explode(here).alias(number or "_number"))
    return repeated if number else repeated.drop("_number")


def number_copies(df: DataFrame, number: str) -> DataFrame:
    """The table with a number in each row that tells exact copies apart; they are counted first."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_times"))
    return repeat_rows(counted, "_times", number)
