"""Input files as a table: Parquet footers and the embeddings in them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linscore.operators.scoring import METADATA, pack_features
from linscore.sources.storage import FILES_PER_TASK, FileSystems, as_uri, by_scheme, list_files, spread

__all__ = ["as_uri", "check_footers", "list_files", "parquet_footers", "read_embeddings", "reader_path"]

FOOTER_COLUMNS = ["input", "rows", "groups", "layout", "features", "error"]
FOOTER_SCHEMA = "input string, rows bigint, groups int, layout string, features int, error string"


def reader_path(uri: str) -> str:
    """URI of a file as the reader takes it: unescaped, and safe from being read as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(uri))


def _footer_probe(find: FileSystems) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batch function that opens footers; self-contained, so that workers need not import this package."""
    metadata, columns = list(METADATA), FOOTER_COLUMNS

    def look(path: str) -> tuple:
        import pyarrow.parquet as pq

        try:
            system, name = find(path)
            with pq.ParquetFile(name, filesystem=system) as opened:
                schema, rows, groups = opened.schema_arrow, opened.metadata.num_rows, opened.num_row_groups
        except (OSError, pa.ArrowException, ValueError) as problem:
            return path, None, None, None, None, str(problem)
        absent = [c for c in metadata if c not in schema.names]
        error = f"lacks {', '.join(absent)}" if absent else None
        layout = hashlib.sha1("\n".join(f"{f.name} {f.type}" for f in schema).encode()).hexdigest()
        packed = "features" in schema.names
        return path, rows, groups, layout, None if packed else len(schema) - len(metadata), error

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string()]
        for batch in batches:
            found = [look(path) for path in batch.column("input").to_pylist()]
            arrays = zip(*found) if found else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, types)], names=columns)

    return probe


def parquet_footers(files: DataFrame, file_systems: FileSystems | None = None) -> DataFrame:
    """Rows, row groups, layout and number of feature columns of each file, or why it cannot be read.

    Files of one layout have the same columns and types. The number of features is null where they
    come as one array. A scan would die on one broken file and quietly fill up a file with too few
    columns, so footers are looked at beforehand. Only footers are read, in parallel over the files.
    """
    rows = spread(files.select("input"), files.count(), FILES_PER_TASK, "input")
    return rows.mapInArrow(_footer_probe(file_systems or by_scheme()), FOOTER_SCHEMA)


def check_footers(footers: DataFrame, dim: int) -> DataFrame:
    """Footers with a wrong number of features turned into errors."""
    wrong = F.concat(F.col("features"), F.lit(f" feature columns found, the classifiers expect {dim}"))
    return footers.withColumn(
        "error", F.coalesce(F.col("error"), F.when(F.col("features") != dim, wrong))
    )


def read_embeddings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Embeddings of files or folders of one layout, packed, with the file of each row as ``input``.

    Paths are taken as the reader takes them (``reader_path`` makes them of URIs).

    A wide table is packed by position after its metadata columns; a table that already has a
    ``features`` array is taken as it is.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    table = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    origin = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("input")
    if "features" in table.columns:
        return table.select(*METADATA, "features", origin)
    return pack_features(table, extra=[origin])
