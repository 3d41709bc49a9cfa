"""Scoring of files as they arrive.

Scoring keeps no state. ``score_arriving`` is the stream for files nobody has vouched for: its rows are names of new files, and each
batch of them is a run like any other, with footers checked first, detections, and a report. ``score_new_files`` is for
tables known to be sound: the batch operator between a file source and a file sink.

The checkpoint remembers which files were seen; a run with nothing new does nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linscore.operators.scoring import score
from linscore.plans.classify import score_inputs
from linscore.registry import load_classifiers
from linscore.sources.storage import FileSystems, as_uri, bases, by_scheme, check_storage

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def score_arriving(
    spark: SparkSession,
    folder: str,
    output_path: str,
    config: Any,
    checkpoint: str,
    *,
    glob: str = "*.parquet",
    files_per_batch: int | None = None,
    output_format: str = "parquet",
    file_systems: FileSystems | None = None,
) -> StreamingQuery:
    """Score the files that have come into a folder since the last call, then stop.

    A file that is broken, too narrow or breaks while it is read stops nothing: it is reported as failed and listed in
    ``quarantine``. A batch repeated after a loss has its number again and so replaces what it had written. ``read_results`` and ``report_of``
    read the output; ``classify`` over the same folder and output takes up what had failed and is sound by then.
    """
    classifiers = load_classifiers(config, spark)
    classifiers.check_path_parts()
    find = file_systems or by_scheme()
    check_storage([as_uri(folder, bases(spark))], find)
    # by number, so that runs of ``classify``, named by the time, count as later ones
    stream = hashlib.sha1(checkpoint.encode()).hexdigest()[:8]

    def score_batch(files: DataFrame, number: int) -> None:
        session, run = files.sparkSession, f"{number:020d}-{stream}"
        stem = F.regexp_replace(F.url_decode(F.replace(F.regexp_extract("input", "([^/]*)$", 1), F.lit("+"), F.lit("%2B"))), r"\.parquet$", "")
        inputs = files.select("input", F.concat(stem, F.lit(".csv")).alias("output"))
        report = score_inputs(session, inputs, output_path, classifiers, run, output_format, find)
        if report is not None:
            failed = report.where("status = 'failed'").groupBy("input").agg(F.min("error").alias("error"))
            failed.write.mode("overwrite").parquet(f"{output_path}/quarantine/run={run}")

    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # only names are asked for, so no content is read here
    names = reader.load(folder).select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("input"))
    return names.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_embeddings(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Embedding files of a folder, or a single file, as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def score_new_files(
    stream: DataFrame,
    config: Any,
    output_path: str,
    checkpoint: str,
    *,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    output_format: str = "parquet",
    **options: Any,
) -> StreamingQuery:
    """Score what has arrived since the last run, append it, and stop.

    ``prepare`` shapes the stream for scoring (``pack_features``, renames); ``checkpoint`` and
    ``output_path`` belong on storage that all executors share.
    """
    rows = prepare(stream) if prepare else stream
    detections = score(rows, load_classifiers(config), **options)
    return (
        detections.writeStream.format(output_format)
        .option("path", output_path)
        .option("header", True)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
