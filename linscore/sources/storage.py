"""Storage as tasks see it: file systems by path, folders walked level by level, first lines of files.

Tasks open files through a function that maps a URI to a file system of pyarrow and the path in it. The one given here knows
the schemes in ``SCHEMES``; for any other storage the caller passes a function of its own as ``file_systems``. Which schemes a run meets is
looked at before it starts, so that an unknown one is an error at once and not one per file.

Functions sent to tasks are made inside others, so that workers need not import this package.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from fnmatch import fnmatchcase
from functools import reduce
from typing import Any
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linscore.session import new_folder

FileSystems = Callable[[str], tuple[Any, str]]
SCHEMES = ("file", "s3", "s3a", "s3n", "gs", "hdfs", "abfs", "abfss")
FOLDERS_PER_TASK, FILES_PER_TASK, MOST_TASKS = 4, 8, 10_000
HEADER_BYTES = 1 << 16
SAFE = "/:@&=+$,;-_.!~*'()"  # what a path in a URI need not escape
_HAS_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]+:/"


def by_scheme() -> FileSystems:
    """File systems of pyarrow for the schemes it knows."""
    known = SCHEMES

    def find(uri: str):
        from pyarrow import fs

        parts = urlsplit(uri)
        if parts.scheme not in known:
            raise ValueError(f"no file system is known for {parts.scheme}:, pass file_systems")
        if parts.scheme == "file":
            return fs.LocalFileSystem(), unquote(parts.path)
        scheme = {"s3a": "s3", "s3n": "s3"}.get(parts.scheme, parts.scheme)
        return fs.FileSystem.from_uri(parts._replace(scheme=scheme).geturl())

    return find


def check_storage(uris: Iterable[str], file_systems: FileSystems) -> None:
    """Raise where a URI's storage is unknown or cannot be reached."""
    for uri in uris:
        try:
            system, path = file_systems(uri)
            system.get_file_info(path)
        except (OSError, pa.ArrowException, ValueError, KeyError) as problem:
            raise ValueError(f"storage of {uri} cannot be used: {problem}") from problem


def bases(spark: SparkSession) -> tuple[str, str]:
    """What stands before an absolute and before a relative path without a scheme: the session's default file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.FileSystem.get(spark._jsparkSession.sessionState().newHadoopConf())
    root = system.getUri().toString().rstrip("/")
    if root.startswith("file:"):
        return "file:", "file:" + quote(os.getcwd(), SAFE)
    return root, system.getWorkingDirectory().toUri().toString().rstrip("/")


def as_uri(path: str, base: tuple[str, str] | None = None) -> str:
    """Path in the one form used here; without a scheme it belongs to ``base``, by default to the local files."""
    if re.match(_HAS_SCHEME, path):
        return re.sub("^file:/+", "file:/", path)
    root, working = base or ("file:", "file:" + quote(os.getcwd(), SAFE))
    path = re.sub(r"/(\./)+", "/", re.sub("/+", "/", path))
    return root + quote(path, SAFE) if path.startswith("/") else f"{working}/{quote(path.removeprefix('./'), SAFE)}"


def uri_column(path: Column, base: tuple[str, str]) -> Column:
    """``as_uri`` of a column."""
    root, working = base
    plain = F.regexp_replace(F.regexp_replace(path, "/+", "/"), r"/(\./)+", "/")

    def quoted(text: Column) -> Column:
        part = F.url_encode(text)
        for form, meant in (("+", "%20"), *((quote(c, ""), c) for c in SAFE if quote(c, "") != c), ("%7E", "~")):
            part = F.replace(part, F.lit(form), F.lit(meant))
        return part

    return (
        F.when(path.rlike(_HAS_SCHEME), F.regexp_replace(path, "^file:/+", "file:/"))
        .when(F.startswith(plain, F.lit("/")), F.concat(F.lit(root), quoted(plain)))
        .otherwise(F.concat(F.lit(working + "/"), quoted(F.regexp_replace(plain, r"^\./", ""))))
    )


def _lister(file_systems: FileSystems, glob: str):
    """Batch function: a folder's files that match and its folders; Spark's hidden names are left out as readers leave them out."""
    safe = SAFE

    def hidden(name: str) -> bool:
        return name.startswith(".") or (name.startswith("_") and "=" not in name)

    def look(folder: str) -> Iterator[tuple[str, bool]]:
        from pyarrow import fs

        system, path = file_systems(folder)
        for info in system.get_file_info(fs.FileSelector(path)):
            name = info.base_name
            is_folder = info.type == fs.FileType.Directory
            if not hidden(name) and (is_folder or fnmatchcase(name, glob)):
                yield f"{folder.rstrip('/')}/{quote(name, safe)}", is_folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = list(look(folder))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f for f, _ in found], pa.string()), pa.array([d for _, d in found], pa.bool_())], ["input", "is_folder"]
                )

    return run


def plain_path(uri: Column) -> Column:
    """URI without escapes and with one slash behind ``file:``: the same whoever wrote it."""
    return F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def spread(rows: DataFrame, count: int, per_task: int, *keys: str) -> DataFrame:
    """Rows dealt by number over tasks: names are few bytes, but what they name is slow to open."""
    return rows.repartition(max(1, min(-(-count // per_task), MOST_TASKS)), *keys)


def list_files(
    spark: SparkSession, folder: str | Sequence[str], glob: str, file_systems: FileSystems | None = None
) -> DataFrame:
    """Files below folders (or files named themselves) whose names match, as ``input``; nothing is read.

    Folders are rows: each level of the tree is listed in tasks and written as a table, whose folders are the next level. The driver
    sees only how many folders a level has.
    """
    find = file_systems or by_scheme()
    base, table, kind = bases(spark), new_folder(spark, "listing"), "input string, is_folder boolean"
    roots = []
    for path in [folder] if isinstance(folder, str) else folder:
        uri = as_uri(path, base)
        check_storage([uri], find)
        system, place = find(uri)
        info = system.get_file_info(place)
        if info.type.name == "NotFound":
            raise FileNotFoundError(f"input path {path} does not exist")
        roots.append((uri.rstrip("/"), info.type.name == "Directory"))
    found = spark.createDataFrame(roots, kind)
    levels, open_ = [found.where("not is_folder")], sum(is_folder for _, is_folder in roots)
    while open_:
        listed = spread(found.where("is_folder").select("input"), open_, FOLDERS_PER_TASK).mapInArrow(_lister(find, glob), kind)
        path = f"{table}/level={len(levels)}"
        listed.write.parquet(path)
        found = spark.read.schema(kind).parquet(path)
        levels.append(found.where("not is_folder"))
        open_ = found.where("is_folder").count()
    return reduce(DataFrame.union, levels).select("input")


def first_lines(files: DataFrame, file_systems: FileSystems | None = None) -> DataFrame:
    """``input, line``: the first line of each file. Reading stops behind it; an empty file has a null line."""
    find, size = file_systems or by_scheme(), HEADER_BYTES

    def first(uri: str) -> str | None:
        system, path = find(uri)
        line = b""
        with system.open_input_stream(path) as stream:
            while b"\n" not in line and (part := stream.read(size)):
                line += part
        line = re.split(rb"\r?\n", line, maxsplit=1)[0].removeprefix(b"\xef\xbb\xbf").rstrip(b"\r")
        return line.decode("utf-8", "replace") or None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [first(uri) for uri in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.string())], ["input", "line"])

    rows = spread(files.select("input"), files.count(), FILES_PER_TASK, "input")
    return rows.mapInArrow(run, "input string, line string")
