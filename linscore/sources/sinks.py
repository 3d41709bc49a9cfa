"""Writing results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linscore.sources.dialect import CSV_WRITE


def write_table(
    df: DataFrame, path: str, output_format: str = "csv", partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write CSV (with header, in the library's dialect) or Parquet, straight from the tasks that made the rows."""
    if output_format not in ("csv", "parquet"):
        raise ValueError(f"unknown output format {output_format!r}")
    writer = df.write.mode(mode).partitionBy(*partition_by) if partition_by else df.write.mode(mode)
    if output_format == "csv":
        writer.options(**CSV_WRITE).csv(path)
    else:
        writer.parquet(path)


FILE_BYTES, SPARE_FILES = 128 << 20, 1_000
PARTS_PER_JOB = 100


def part_sizes(spark: SparkSession, path: str, part: str) -> DataFrame:
    """Files and bytes of each value of the partition column ``part`` below a path, from the listing; no content is read."""
    listing = f"path string, modificationTime timestamp, length bigint, content binary, {part} string"
    files = spark.read.format("binaryFile").schema(listing).load(path)
    return files.groupBy(part).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def merge_files(
    written: DataFrame,
    sizes: DataFrame,
    path: str,
    output_format: str,
    part: str,
    file_bytes: int = FILE_BYTES,
    spare_files: int = SPARE_FILES,
) -> bool:
    """Write a partitioned table anew in files of about ``file_bytes``, if it has ``spare_files`` more than those would be.

    Each value of ``part`` is scanned by as many tasks as it is to have files, so that no row is shuffled and a large value
    has as many tasks as it needs. Tells whether it was written; ``written`` itself is left as it is.
    """
    needed = {r[part]: (r["files"], max(1, -(-r["bytes"] // file_bytes))) for r in sizes.collect()}  # a row per value
    if sum(files - n for files, n in needed.values()) <= spare_files:
        return False
    values = sorted(needed)
    for k in range(0, len(values), PARTS_PER_JOB):
        scans = [written.where(F.col(part) == v).coalesce(needed[v][1]) for v in values[k : k + PARTS_PER_JOB]]
        write_table(reduce(DataFrame.union, scans), path, output_format, [part], "append" if k else "overwrite")
    return True


def empty_table(spark: SparkSession, path: str) -> None:
    """Removes the files of a table that nothing refers to any more."""
    spark.createDataFrame([], "nothing int").write.mode("overwrite").parquet(path)


def write_split(df: DataFrame, path: str, split_by: str | None = "site_id", output_format: str = "csv") -> None:
    """Write one folder per value of ``split_by``, or in one piece without one; the caller decides, not the row count."""
    # the key also stays in the rows, as it does in an unsplit table
    out = df.withColumn(f"by_{split_by}", F.col(split_by)) if split_by else df
    write_table(out, path, output_format, [f"by_{split_by}"] if split_by else ())


def write_json_lines(df: DataFrame, path: str) -> None:
    """Write one JSON object per line, nulls included."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


SOURCES_PER_LINE = 1_000


def write_manifest(rows: DataFrame, path: str, per_line: int = SOURCES_PER_LINE) -> None:
    """Write (source, output) rows as a manifest in line form: documents of about ``per_line`` sources, one per line."""
    lines = max(1, -(-rows.count() // per_line))
    dealt = rows.groupBy(F.pmod(F.xxhash64("source", "output"), F.lit(lines)).alias("line"))
    parts = dealt.agg(F.sort_array(F.collect_list(F.struct("source", "output"))).alias("m"))
    write_json_lines(parts.select(F.col("m.source").alias("source"), F.col("m.output").alias("output")), path)
