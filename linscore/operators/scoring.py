"""Scoring: every embedding against every class of every classifier, kept in long form.

The work is one matrix product per batch of rows, needs no shuffle, and reads the embeddings once
for all classifiers. Rows whose features are null or of another length are left out before the
product (they are counted by ``rejected_rows``); a missing or NaN feature makes the row's scores
NaN, which pass no threshold.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linscore.registry import ClassifierSet, load_classifiers

METADATA = ("source", "channel", "offset")
BROADCAST_BYTES = 64 << 20
SCORES_PER_CHUNK = 1 << 20
SQL_WEIGHTS = 1 << 16


def pack_features(
    df: DataFrame, metadata: Sequence[str] = METADATA, extra: Sequence[Column] = ()
) -> DataFrame:
    """Wide embedding columns as one ``features`` array of floats.

    Metadata is found by name, features are all columns after as many as there are metadata
    columns, in their order. ``extra`` columns are added at the end.
    """
    columns = df.columns
    absent = [c for c in metadata if c not in columns]
    if absent:
        raise ValueError(f"embedding table lacks {', '.join(absent)}")
    # one expression of text: a thousand columns built one by one take seconds on the driver
    quoted = (c.replace("`", "``") for c in columns[len(metadata) :])
    packed = F.expr("array(" + ", ".join(f"cast(`{c}` as float)" for c in quoted) + ")")
    return df.select(*metadata, packed.alias("features"), *extra)


def check_dims(found: int, classifiers: ClassifierSet) -> None:
    """Raise unless ``found`` feature columns are what the classifiers expect."""
    if len(classifiers) and found != classifiers.embedding_dim:
        raise ValueError(f"{found} feature columns found, the classifiers expect {classifiers.embedding_dim}")


def rejected_rows(df: DataFrame, classifiers: ClassifierSet, features: str = "features") -> DataFrame:
    """Rows that cannot be scored: null features or another number of them."""
    return df.where(~usable(features, classifiers.embedding_dim))


def usable(features: str, dim: int):
    return F.col(features).isNotNull() & (F.size(features) == F.lit(dim))


def score(
    df: DataFrame,
    classifiers: ClassifierSet,
    *,
    features: str = "features",
    keep: Sequence[str] | None = None,
    engine: str = "arrow",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Detections: ``keep`` columns, classifier, label and score where score >= threshold.

    ``engine="arrow"`` multiplies Arrow batches with numpy; the weights travel as broadcasts of at
    most ``broadcast_bytes``; a larger registry has several, which each batch meets in turn, in one scan.
    ``engine="sql"`` keeps all in SQL expressions, for registries of up to 65,536 weights where no Python
    is wanted; a larger one is an error there.
    Both sum in double and compare as float.
    """
    classifiers = load_classifiers(classifiers)
    keep = [c for c in df.columns if c != features] if keep is None else list(keep)
    rows = df.select(*keep, features)
    schema = T.StructType(
        [rows.schema[c] for c in keep]
        + [
            T.StructField("classifier", T.StringType()),
            T.StructField("label", T.StringType()),
            T.StructField("score", T.FloatType()),
        ]
    )
    if not classifiers.columns:
        return df.sparkSession.createDataFrame([], schema)
    # weights and scores are floats: features of any number type meet them as floats
    rows = rows.withColumn(features, F.col(features).cast("array<float>"))
    rows = rows.where(usable(features, classifiers.embedding_dim))
    if engine == "sql":
        return _score_sql(rows, classifiers, keep, features)
    if engine != "arrow":
        raise ValueError(f"unknown engine {engine!r}")
    return _score_blocks(rows, classifiers, weight_blocks(classifiers, broadcast_bytes), keep, features, schema)


def weight_blocks(classifiers: ClassifierSet, broadcast_bytes: int = BROADCAST_BYTES) -> list[slice]:
    """The classes in runs whose weights stay below ``broadcast_bytes``."""
    width = max(1, broadcast_bytes // (4 * classifiers.embedding_dim))
    return [slice(b, b + width) for b in range(0, len(classifiers.columns), width)]


def _block(classifiers: ClassifierSet, block: slice) -> tuple:
    return (
        np.ascontiguousarray(classifiers.weights[:, block]),
        classifiers.bias[block],
        classifiers.thresholds[block],
        [name for name, _ in classifiers.columns[block]],
        [label for _, label in classifiers.columns[block]],
    )


def _passing():
    """Function for tasks: row, column and score of all scores at or above their thresholds, in chunks."""
    size = SCORES_PER_CHUNK

    def passing(matrix, weights, bias, thresholds) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        weights, bias = weights.astype(np.float64), bias.astype(np.float64)
        step = max(1, size // max(len(bias), 1))
        for start in range(0, len(matrix), step):
            with np.errstate(all="ignore"):
                scores = matrix[start : start + step].astype(np.float64) @ weights + bias
                scores = scores.astype(np.float32)
                row, column = np.nonzero(scores >= thresholds)
            if row.size:
                yield row + start, column, scores[row, column]

    return passing


def _score_blocks(
    rows: DataFrame, classifiers: ClassifierSet, blocks: Sequence[slice], keep: list[str], features: str, schema: T.StructType
) -> DataFrame:
    """One scan: each batch meets the blocks of weights in turn."""
    context = rows.sparkSession.sparkContext
    shared = [context.broadcast(_block(classifiers, block)) for block in blocks]
    passing = _passing()

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(features).flatten().to_numpy(zero_copy_only=False)
            matrix = flat.reshape(batch.num_rows, -1)
            carried = batch.select(keep)
            for part in shared:
                *numbers, names, labels = part.value
                names, labels = pa.array(names, pa.string()), pa.array(labels, pa.string())
                for row, column, scores in passing(matrix, *numbers):
                    found = carried.take(pa.array(row))
                    column = pa.array(column)
                    yield pa.RecordBatch.from_arrays(
                        [*found.columns, names.take(column), labels.take(column), pa.array(scores)], names=schema.names
                    )

    return rows.mapInArrow(detect, schema)


RESULT_SCHEMA = (
    "source string, channel bigint, offset double, input string, classifier string, label string, score float, "
    "classifier_path string"
)
# stands where a classifier's path part does, for rows that tell what came of an input; no path part holds a dot
INPUT_ROWS = "inputs."
ROWS_PER_BATCH, BYTES_PER_TASK = 2_000, 64 << 20


class FileScoring:
    """Scoring of Parquet files by row groups, each against the classifiers that are open for its file.

    ``detections`` takes rows of ``input, group, open`` (numbers of classifiers). Tasks read the row group and give, beside its
    detections, one row that counts it, told apart by ``classifier_path``: ``channel`` has the rows read, ``offset`` those of them without usable
    features, ``label`` why it could not be read to its end. Counting thus costs no second scan and a repeated task counts once.
    ``close`` takes the weights back from the executors.
    """

    def __init__(self, spark, classifiers: ClassifierSet, path_part, broadcast_bytes: int = BROADCAST_BYTES):
        self.dim = classifiers.embedding_dim
        number = {c.name: k for k, c in enumerate(classifiers)}
        self.shared = []
        for block in weight_blocks(classifiers, broadcast_bytes):
            weights, bias, thresholds, names, labels = _block(classifiers, block)
            owners = np.array([number[n] for n in names])
            self.shared.append(spark.sparkContext.broadcast((weights, bias, thresholds, names, labels, [path_part(n) for n in names], owners)))

    def detections(self, work: DataFrame, find) -> DataFrame:
        shared, dim, metadata, passing = self.shared, self.dim, list(METADATA), _passing()
        columns = [c.split()[0] for c in RESULT_SCHEMA.split(", ")]
        types = [pa.string(), pa.int64(), pa.float64(), pa.string(), pa.string(), pa.string(), pa.float32(), pa.string()]
        rows_per_batch, input_rows = ROWS_PER_BATCH, INPUT_ROWS

        def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, list[pa.Array], int]:
            """Matrix of the usable rows, their metadata, and the number of unusable ones."""
            names = batch.schema.names
            carried = [batch.column(names.index(m)).cast(t, safe=False) for m, t in zip(metadata, types)]
            if "features" in names:
                lists = batch.column(names.index("features")).cast(pa.large_list(pa.float32()), safe=False)
                sizes = np.diff(np.asarray(lists.offsets))
                good = np.asarray(lists.is_valid()) & (sizes == dim)
                kept = lists.filter(pa.array(good))
                matrix = kept.flatten().to_numpy(zero_copy_only=False).reshape(len(kept), dim)
                return matrix, [c.filter(pa.array(good)) for c in carried], int((~good).sum())
            matrix = np.empty((batch.num_rows, dim), np.float32)
            for k, column in enumerate(batch.columns[len(metadata) :]):
                matrix[:, k] = column.cast(pa.float32(), safe=False).to_numpy(zero_copy_only=False)
            return matrix, carried, 0

        def chosen(open_: tuple[int, ...]) -> list[tuple]:
            """The open classifiers' part of each block of weights."""
            parts = []
            for block in shared:
                weights, bias, thresholds, names, labels, paths, owners = block.value
                at = np.flatnonzero(np.isin(owners, open_))
                if len(at):
                    texts = [pa.array([t[k] for k in at], pa.string()) for t in (names, labels, paths)]
                    parts.append((weights[:, at], bias[at], thresholds[at], *texts))
            return parts

        def made(arrays: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, t) for a, t in zip(arrays, types)], columns)

        def scored(uri: str, group: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            import pyarrow.parquet as pq

            rows, unusable, error = 0, 0, None
            try:
                system, path = find(uri)
                with pq.ParquetFile(path, filesystem=system) as file:
                    for batch in file.iter_batches(rows_per_batch, row_groups=[group]):
                        matrix, carried, missed = unpacked(batch)
                        rows, unusable = rows + batch.num_rows, unusable + missed
                        for *numbers, names, labels, paths in parts:
                            for row, column, scores in passing(matrix, *numbers):
                                row, column = pa.array(row), pa.array(column)
                                texts = [t.take(column) for t in (names, labels, paths)]
                                yield made([*(c.take(row) for c in carried), [uri] * len(row), *texts[:2], scores, texts[2]])
            except (OSError, pa.ArrowException, ValueError) as problem:
                error = str(problem)
            yield made([[None], [rows], [float(unusable)], [uri], [None], [error], [None], [input_rows]])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, parts = None, []
            for batch in batches:
                for uri, group, open_ in zip(*(c.to_pylist() for c in batch.columns)):
                    if tuple(open_) != last:
                        last, parts = tuple(open_), chosen(tuple(open_))
                    yield from scored(uri, group, parts)

        return work.select("input", "group", "open").mapInArrow(run, RESULT_SCHEMA)

    def close(self) -> None:
        for block in self.shared:
            block.destroy()


def _score_sql(rows: DataFrame, classifiers: ClassifierSet, keep: list[str], features: str) -> DataFrame:
    if classifiers.weights.size > SQL_WEIGHTS:
        raise ValueError(f"engine='sql' takes up to {SQL_WEIGHTS} weights; use engine='arrow'")
    # one literal, folded at planning: no join and no second table
    entries = [
        {
            "classifier": name,
            "label": label,
            "beta": classifiers.weights[:, k].astype(float).tolist(),
            "bias": float(classifiers.bias[k]),
            "threshold": float(classifiers.thresholds[k]),
        }
        for k, (name, label) in enumerate(classifiers.columns)
    ]
    entry = "struct<classifier:string,label:string,beta:array<double>,bias:double,threshold:float>"
    classes = F.from_json(F.lit(json.dumps(entries)), f"array<{entry}>")

    def scored(c):
        products = F.zip_with(F.col(features), c["beta"], lambda x, w: x.cast("double") * w)
        total = F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p) + c["bias"]
        return F.struct(
            c["classifier"].alias("classifier"),
            c["label"].alias("label"),
            total.cast("float").alias("score"),
            c["threshold"].alias("threshold"),
        )

    passing = F.filter(
        F.transform(classes, scored), lambda s: ~F.isnan(s["score"]) & (s["score"] >= s["threshold"])
    )
    found = rows.select(*keep, F.inline(passing))
    return found.select(*keep, "classifier", "label", "score")


def with_times(detections: DataFrame, recording_id, window_seconds: float = 5.0) -> DataFrame:
    """Scored output with its recording id, start and end in seconds."""
    ident = recording_id if not isinstance(recording_id, int) else F.lit(recording_id)
    return (
        detections.withColumn("audio_recording_id", ident)
        .withColumn("end_time_seconds", F.col("offset") + F.lit(window_seconds))
        .withColumnRenamed("offset", "start_time_seconds")
    )
