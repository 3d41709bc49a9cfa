"""Importance resampling of documents towards a target text, by hashed n-grams.

Each text is lower-cased (A-Z) and its separators collapse to single blanks; ``regex.finditer`` with ``overlapped=True`` then
gives every run of k words as one span, look-arounds holding both of its ends to a word's boundary, and the span's bytes go
straight into a CRC that names its bucket. Buckets are counted over all documents and all target texts; a
bucket's gain is the log ratio of its smoothed shares. A document's weight is the mean of its features' gains, its score the
weight and Gumbel noise of its id, and the highest scores are drawn: sampling without replacement in proportion to weights.

Texts are scanned once: the buckets of a document's features are written, two or four bytes each. Only counts per bucket and
per score value pass through the driver (scores are whole numbers in a range that gains and noise bound). The drawn rows are ranked by a range
partitioning, never in one task, and rows not drawn are not sorted.

Defined cases: null text has no words; a document without features has weight 0; a null id takes the noise of an empty one and comes last
among equal scores; rows that repeat id and text are rows of their own, in any order among themselves; an empty corpus gives no
rows, and an empty target leaves all its counts 0. Extra columns are ignored. A very long text is one row of the scan.
"""

from __future__ import annotations

import binascii

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import Store

BUCKETS, SEED = 10_000, 2024
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = bytes(flat.LOWER)


def span_pattern(words: int) -> regex.Pattern:
    """Runs of ``words`` words in a text whose separators are single blanks."""
    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (words - 1))


def feature_buckets(text: bytes, patterns: list[regex.Pattern], buckets: int) -> tuple[int, list[int]]:
    """Number of words of a text, and the bucket of each of its features."""
    # separators only: upper case is lower by now, so that every separator of the lower-cased text is one here
    blanked = SEPARATORS.sub(b" ", text.translate(LOWER)).strip(b" ")
    if not blanked:
        return 0, []
    crc = binascii.crc32
    found = [crc(m[0]) % buckets for p in patterns for m in p.finditer(blanked, overlapped=True)]
    return blanked.count(b" ") + 1, found


def _scan(ngrams: int, buckets: int):
    """A row per text: its id, numbers of words and features, and the features' buckets as packed integers."""

    def run(batches):
        patterns = [span_pattern(k) for k in range(1, ngrams + 1)]
        kind = _kind(buckets)
        for batch in batches:
            for at in range(batch.num_rows):
                text = batch.column(1)[at].as_py()
                words, found = feature_buckets((text or "").encode(), patterns, buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 1), pa.array([words], pa.int64()), pa.array([len(found)], pa.int64()),
                        pa.array([np.array(found, kind).tobytes()], pa.binary()),
                    ],
                    ["doc_id", "n_words", "n_features", "found"],
                )

    return run


def _kind(buckets: int):
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def _counted(buckets: int):
    """Counts per bucket of a task, as rows of those that occur."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_py(), _kind(buckets)), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int64()), "n": pa.array(total[held], pa.int64())})

    return run


def bucket_counts(scanned: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows of a scan; summed in tasks before and after the shuffle."""
    counts = scanned.select("found").mapInArrow(_counted(buckets), "bucket bigint, n bigint")
    total = np.zeros(buckets, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket at most
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray, buckets: int) -> np.ndarray:
    """Log ratio of target and corpus shares of each bucket in thousandths, rounded down."""
    s, t = corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _weighed(gain: np.ndarray, buckets: int):
    def run(batches):
        for batch in batches:
            weights = []
            for value in batch.column(3):
                found = np.frombuffer(value.as_py(), _kind(buckets))
                weights.append(int(gain[found].sum()) // len(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(weights, pa.int64())], ["doc_id", "n_words", "n_features", "weight"]
            )

    return run


def noise(seed: int, ident) -> F.Column:
    """Gumbel noise of an id in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, store: Store, name: str) -> DataFrame:
    """``rows`` with their ``rank`` by falling score and rising id, from 1: sorted by ranges, then counted per range."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("place")]
    spread = rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
    # the sort is written, so that a range's number and a row's place in it are what they are
    at = F.monotonically_increasing_id()
    parts = store.write(
        name,
        spread.sortWithinPartitions(*order).withColumns(
            {"part": F.shiftright(at, 33), "at": at.bitwiseAND((1 << 33) - 1)}
        ),
    )
    before, offsets = 0, {}
    for row in parts.groupBy("part").count().orderBy("part").collect():  # a row per partition
        offsets[row["part"]], before = before, before + row["count"]
    if not offsets:
        return parts.withColumn("rank", F.lit(0).cast("bigint")).drop("part", "at")
    # by the range's number, as a map would be searched entry by entry
    table = F.array(*[F.lit(offsets.get(k, 0)).cast("bigint") for k in range(max(offsets) + 1)])
    return parts.withColumn("rank", F.get(table, F.col("part").cast("int")) + F.col("at") + 1).drop("part", "at")


def resampled(
    documents: DataFrame,
    target: DataFrame,
    percent: int = 10,
    ngrams: int = 1,
    buckets: int = BUCKETS,
    least_words: int = 20,
    seed: int = SEED,
) -> DataFrame:
    """A row per document: ``doc_id, n_features, weight, score, rank``; ``rank`` is null where it is not drawn.

    Of the documents with ``least_words`` words or more, ``percent`` in a hundred are drawn (rounded down).
    """
    store = Store(documents.sparkSession, "resampling")
    kind = "doc_id bigint, n_words bigint, n_features bigint, found binary"
    scan = _scan(ngrams, buckets)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = store.write("scanned", texts.mapInArrow(scan, kind))
    wanted = target.select(F.lit(None).cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(scanned, buckets), bucket_counts(wanted.mapInArrow(scan, kind), buckets), buckets)
    weighed = scanned.mapInArrow(_weighed(gain, buckets), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    scored = store.write(
        "scored",
        weighed.withColumns(
            {"score": F.col("weight") + noise(seed, F.col("doc_id")), "able": F.col("n_words") >= least_words, "place": F.monotonically_increasing_id()}
        ),
    )
    store.drop("scanned")
    # scores are whole numbers between bounds that gains and noise set, whatever the number of rows
    per_score = scored.where("able").groupBy("score").count().collect()
    left = draws = percent * sum(r["count"] for r in per_score) // 100
    cut = None
    for row in sorted(per_score, key=lambda r: -r["score"]):
        if left <= 0:
            break
        cut, left = row["score"], left - row["count"]
    columns = ["doc_id", "n_features", "weight", "score"]
    near = F.col("able") & (F.col("score") >= F.lit(cut).cast("bigint"))
    first = F.coalesce(near, F.lit(False))
    top = ranked(scored.where(first).select(*columns, "place"), store, "drawn")
    return (
        top.select(*columns, F.when(F.col("rank") <= draws, F.col("rank")).alias("rank"))
        .unionByName(scored.where(~first).select(*columns, F.lit(None).cast("bigint").alias("rank")))
    )
