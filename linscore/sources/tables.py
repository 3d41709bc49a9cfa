"""Detections, catalogs, predictions and manifests read from files."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linscore.functions.names import path_stem
from linscore.functions.urls import merge_query, url_has_host, url_to_output_path
from linscore.operators.enrich import CATALOG_NAMES
from linscore.session import checkpointed
from linscore.sources.dialect import CSV_READ, CSV_READ_MULTILINE
from linscore.sources.storage import FileSystems, first_lines, list_files, plain_path

CATALOG_SCHEMA = (
    "id bigint, site_id bigint, `sites.name` string, `regions.id` bigint, `regions.name` string, recorded_date string"
)


def recording_of(path: Column) -> Column:
    """Recording id of a file: its stem, null if that is no whole number."""
    return F.when(path_stem(path).rlike(r"^\s*[+-]?\d+\s*$"), F.trim(path_stem(path))).try_cast("bigint")


DETECTION_COLUMNS = ("source", "channel", "offset", "label", "score")


def read_detections(
    spark: SparkSession, folder: str, multiline: bool = False, file_systems: FileSystems | None = None
) -> DataFrame:
    """Detections from one CSV per recording, the file's stem being the recording id.

    Each file is read by its own header: tasks look at the first line of each, and a header, of which there are few, is a scan
    that meets its files by a join on the path. Files whose stem is no number are left out, values stay text until they are enriched; a
    column that a file lacks is null. ``multiline`` is for texts with line breaks; such files are not split.
    """

    def named(reader):
        return reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")

    empty = "audio_recording_id bigint, source string, channel string, offset string, label string, score string"
    listed = list_files(spark, folder, "*.csv", file_systems)
    firsts = checkpointed(first_lines(listed, file_systems).where("line is not null"))
    headers = [r["line"] for r in firsts.select("line").distinct().collect()]
    if not headers:
        return spark.createDataFrame([], empty)
    parts = []
    for header in headers:
        columns = next(csv.reader([header]))
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = named(spark.read.options(**(CSV_READ_MULTILINE if multiline else CSV_READ))).schema(schema)
        table = reader.csv(folder)
        ident = recording_of(F.col("_metadata.file_name")).alias("audio_recording_id")
        wanted = [F.col(f"`{c}`") for c in DETECTION_COLUMNS if c in columns]
        if len(headers) > 1:
            # where headers differ, no row is read by another file's header: values hang on the joined side, so that no
            # expression on them is moved below the join, to rows of other files
            mine = firsts.where(F.col("line") == header).select(plain_path(F.col("input")).alias("_file"))
            mine = mine.withColumn("_mine", F.length("_file") > 0)
            origin = plain_path(F.col("_metadata.file_path")).alias("_file")
            joined = table.select(ident, *wanted, origin).join(mine, "_file")
            kept = [c for c in DETECTION_COLUMNS if c in columns]
            parts.append(joined.select("audio_recording_id", *[F.when(F.col("_mine"), F.col(c)).alias(c) for c in kept]))
        else:
            parts.append(table.select(ident, *wanted))
    table = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return table.where("audio_recording_id is not null")


def completed_recordings(files: DataFrame) -> DataFrame:
    """Recording ids that have a results file, even an empty one; ``files`` comes from ``list_files``."""
    ident = recording_of(F.url_decode(F.col("input")))
    return files.select(ident.alias("audio_recording_id")).where("audio_recording_id is not null").distinct()


def catalog_columns(df: DataFrame) -> DataFrame:
    """Catalog with plain column names and all columns present."""
    for dotted, plain in CATALOG_NAMES.items():
        if dotted in df.columns:
            df = df.withColumnRenamed(dotted, plain)
    absent = [c for c in ("region_id", "region_name") if c not in df.columns]
    kinds = {"region_id": "bigint", "region_name": "string"}
    return df.select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in absent])


def read_catalog(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Recordings catalog: a JSON list of objects, or one object per line with ``multiline=False``.

    One JSON list is read by a single task; for a large catalog use lines.
    """
    table = spark.read.schema(CATALOG_SCHEMA).option("multiLine", multiline).json(path)
    return catalog_columns(table)


def read_predictions(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False
) -> DataFrame:
    """Predictions CSV with a header; without a schema all columns are text and are written back so.

    ``multiline`` is for texts with line breaks; a file is then read by one task.
    """
    reader = spark.read.options(**(CSV_READ_MULTILINE if multiline else CSV_READ))
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def explode_manifest(documents: DataFrame) -> DataFrame:
    """(source, output) rows from documents with parallel ``source`` and ``output`` arrays.

    ``output`` may be absent or null. Empty sources and lists of different length are errors.
    """
    if "output" not in documents.columns:
        documents = documents.withColumn("output", F.lit(None).cast("array<string>"))
    given = F.size("source")
    checked = (
        F.when(F.coalesce(given, F.lit(0)) < 1, F.raise_error(F.lit("a manifest needs a source list")))
        .when(
            F.col("output").isNotNull() & (F.size("output") != given),
            F.raise_error(F.lit("source and output lists of a manifest differ in length")),
        )
        .otherwise(F.col("source"))
    )
    paired = F.arrays_zip(checked.alias("source"), F.coalesce("output", F.array()).alias("output"))
    return documents.select(F.inline(paired))


def manifest_inputs(manifest: DataFrame, params: str | Mapping[str, Sequence[str] | str] | None = None) -> DataFrame:
    """Manifest with query parameters merged in and outputs filled from the URLs; no host is an error."""
    source = F.when(
        ~url_has_host(F.col("source")),
        F.raise_error(F.concat(F.lit("no host in manifest source "), F.col("source"))),
    ).otherwise(merge_query(F.col("source"), params))
    return manifest.select(
        source.alias("source"), F.coalesce("output", url_to_output_path(F.col("source"))).alias("output")
    )


MANIFEST_SCHEMA = "source array<string>, output array<string>"


def is_line_form(spark: SparkSession, path: str) -> bool:
    """Whether a manifest has a whole document per line, so that it can be split over tasks; only its first line is looked at."""
    first = spark.read.text(path).limit(1)
    return not first.where(F.from_json("value", MANIFEST_SCHEMA)["source"].isNotNull()).isEmpty()


def read_manifest(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Manifest file: one document, or one per line with ``multiline=False`` for large ones."""
    schema = MANIFEST_SCHEMA
    return explode_manifest(spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(path))
