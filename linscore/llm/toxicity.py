"""Toxic texts told apart by non-negative positive-unlabelled learning.

Only confirmed toxic documents teach what toxic is; all other text, labelled or not, is unlabelled. With the class prior
p, the risk of a classifier is ``p * R+(positive) + max(0, R-(unlabelled) - p * R-(positive))``: unlabelled text holds a share p of
toxic text, whose part in the negative risk is taken off, and where that would fall below zero (the classifier has begun to learn the
unlabelled toxic texts as clean) steps go back up instead of on.

1. Each text gives marks: hashes (``BITS`` bits) of its distinct lower-cased words, of their stems (the first bytes of longer words, at
   each length of ``STEMS``), and of whatever of these it holds more than once and ``DENSE`` times a word or more. Marks of at least one confirmed document in a hundred are candidates; near copies among
   these documents (one smallest word hash) count once. The documents that hold a candidate are counted over the whole
   corpus. The up to ``FEATURES`` candidates with the highest likelihood ratio of both counts, ``LEAST_RATIO`` or more, become features.
2. Every text is reduced to the features it holds, some bytes a document.
3. Each task trains a numpy logistic classifier on all its documents as the unlabelled ones and on the confirmed ones, batch
   by batch; the classifiers' weights are averaged in proportion to their documents.

Confirmed documents are bounded by ``max_positive`` (a hash of the id decides beyond it), everything else covers all documents. The class
prior is a parameter, or else the share of toxic ones among the labelled rows that may be learned from.

Defined cases: null text counts as empty and gets a score like any text; labels without a toxic mark, or for ids without a document,
are left out; with no confirmed document, or none that differs from the rest, every score is 0; with no label at all the prior is ``PRIOR``; repeated ids or rows give
rows of their own, and a null id is held in no label; an empty table gives no rows. Very long texts are read whole; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import Store

BITS, FEATURES = 40, 256
STEMS, DENSE = (5, 6, 7), 0.01
SALTS = np.random.default_rng(1).integers(1 << 63, size=len(STEMS) + 1, dtype=np.uint64)  # of each length of stems, and of what is repeated
LEAST_RATIO = 12.0  # a share that differs by chance reaches it once in two thousand buckets
PRIOR = 0.1
LEAST, MOST_PRIOR = 1e-3, 0.9
FIRST_STEPS, STEPS, RATE, DECAY = 300, 60, 0.1, 5e-5
POSITIVE_ROWS = 2_000
WORD = flat.byte_table(lambda b: b >= 0x80 or chr(b).isalnum())


def held_buckets(piece: flat.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct marks of a piece's rows: row, mark; and the smallest word hash of each row (0 without words)."""
    words = flat.find_words(piece, WORD, lower=True)
    hashes = flat.span_hashes(words.data, words.starts, words.ends)
    row = np.repeat(np.arange(piece.rows), words.counts())
    smallest = np.full(piece.rows, np.iinfo(np.uint64).max)
    np.minimum.at(smallest, row, hashes)
    parts = [(row, hashes)]
    for length, salt in zip(STEMS, SALTS):
        long = words.ends - words.starts >= length
        parts.append((row[long], flat.span_hashes(words.data, words.starts[long], words.starts[long] + length) * (salt | np.uint64(1))))
    keys = [(r.astype(np.int64) << BITS) + (h >> np.uint64(64 - BITS)).astype(np.int64) for r, h in parts]
    distinct, times = np.unique(np.concatenate(keys), return_counts=True)
    held = distinct & ((1 << BITS) - 1)
    again = (times > 1) & (times >= DENSE * words.counts()[distinct >> BITS])
    row = np.concatenate([distinct, distinct[again]]) >> BITS
    mark = np.concatenate([held, held[again] ^ np.int64(SALTS[-1] >> np.uint64(64 - BITS))])
    order = np.argsort(row, kind="stable")
    return row[order], mark[order], np.where(words.counts() > 0, smallest, 0)


def _holders(candidates: np.ndarray):
    """Documents of a task that hold each candidate; ``-1`` counts all documents."""

    def run(batches):
        total, rows = np.zeros(len(candidates), np.int64), 0
        for batch in batches:
            for piece in flat.text_pieces(batch.column(0)):
                place, _ = found_in(candidates, held_buckets(piece)[1])
                total += np.bincount(place, minlength=len(candidates))
                rows += piece.rows
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(np.append(candidates, -1), pa.int64()), "n": pa.array(np.append(total, rows), pa.int64())}
        )

    return run


def found_in(known: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``known``, which rises, of the marks that it has, and which marks those are."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(len(marks), bool)
    place = np.minimum(np.searchsorted(known, marks), len(known) - 1)
    held = known[place] == marks
    return place[held], held


def _confirmed_buckets(batches):
    for batch in batches:
        for piece in flat.text_pieces(batch.column(0)):
            row, bucket, smallest = held_buckets(piece)
            yield pa.RecordBatch.from_pydict(
                {"print": pa.array(smallest[row].view(np.int64), pa.int64()), "bucket": pa.array(bucket, pa.int64())}
            )


def likelihood_ratio(a: np.ndarray, n: int, b: np.ndarray, m: int) -> np.ndarray:
    """Twice the log likelihood ratio of shares a/n and b/m being two against being one."""

    def part(k, total):
        with np.errstate(all="ignore"):
            p = k / total
            return np.where(k > 0, k * np.log(p), 0.0) + np.where(k < total, (total - k) * np.log1p(-p), 0.0)

    return 2 * (part(a, n) + part(b, m) - part(a + b, n + m))


@dataclass
class Classifier:
    """Feature marks, rising, and their weights, the constant's last; ``weights`` is None where nothing was learned."""

    buckets: np.ndarray
    weights: np.ndarray | None = None

    def features(self, piece: flat.Piece) -> tuple[np.ndarray, np.ndarray]:
        """Features that each row of a piece holds: flat numbers, and row offsets."""
        row, bucket, _ = held_buckets(piece)
        place, held = found_in(self.buckets, bucket)
        return place, np.searchsorted(row[held], np.arange(piece.rows + 1))

    def matrix(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row per document: 1 where it holds a feature, and a constant."""
        x = np.zeros((len(offsets) - 1, len(self.buckets) + 1), np.float32)
        x[np.repeat(np.arange(len(x)), np.diff(offsets)), values] = 1
        x[:, -1] = 1
        return x

    def scores(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(offsets) - 1)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[values])])
        return logistic(sums[offsets[1:]] - sums[offsets[:-1]] + self.weights[-1])


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def risk(weights: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """Risk on positives, and the corrected risk on negatives, which a classifier that fits too well drives below zero."""
    on_positive, on_unlabelled = positive @ weights, unlabelled @ weights
    corrected = np.logaddexp(0, on_unlabelled).mean() - prior * np.logaddexp(0, on_positive).mean()
    return prior * float(np.logaddexp(0, -on_positive).mean()), float(corrected)


def gradient(weights: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Direction of the next step: that of the risk, or back up the corrected negative risk where it is below zero."""
    p, u = logistic(positive @ weights), logistic(unlabelled @ weights)
    corrected = (u @ unlabelled) / len(unlabelled) - prior * (p @ positive) / len(positive)
    if risk(weights, positive, unlabelled, prior)[1] < 0:
        return -corrected
    return prior * ((p - 1) @ positive) / len(positive) + corrected


class Steps:
    """Adam with a small pull towards zero."""

    def __init__(self, size: int):
        self.weights, self.first, self.second, self.n = np.zeros(size), np.zeros(size), np.zeros(size), 0

    def take(self, direction: np.ndarray, rate: float) -> None:
        self.n += 1
        direction = direction + DECAY * self.weights
        self.first = 0.9 * self.first + 0.1 * direction
        self.second = 0.999 * self.second + 0.001 * direction**2
        first, second = self.first / (1 - 0.9**self.n), self.second / (1 - 0.999**self.n)
        self.weights = self.weights - rate * first / (np.sqrt(second) + 1e-8)


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.asarray(column.offsets).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]


def _trained(model: Classifier, positive: tuple[np.ndarray, np.ndarray], prior: float):
    """A task's classifier: its documents as unlabelled rows, batch by batch, each against the confirmed ones."""

    def run(batches):
        known = model.matrix(*positive)
        steps, mean, seen = Steps(known.shape[1]), np.zeros(known.shape[1]), 0
        rng = np.random.default_rng(len(known))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = model.matrix(*_lists(batch.column(0)))
            count = STEPS if seen else FIRST_STEPS
            for k in range(count):
                some = known if len(known) <= POSITIVE_ROWS else known[rng.integers(len(known), size=POSITIVE_ROWS)]
                steps.take(gradient(steps.weights, some, x, prior), RATE * (1 - 0.9 * k / count))
            mean += steps.weights * batch.num_rows
            seen += batch.num_rows
        yield pa.RecordBatch.from_pydict({"weights": pa.array([mean.tobytes()], pa.binary()), "n": pa.array([seen], pa.int64())})

    return run


def _averaged(batches):
    total, seen = None, 0
    for batch in batches:
        for value, n in zip(batch.column(0), batch.column(1).to_pylist()):
            sums = np.frombuffer(value.as_py())
            total, seen = sums.copy() if total is None else total + sums, seen + n
    if total is not None:
        yield pa.RecordBatch.from_pydict({"weights": pa.array([total.tobytes()], pa.binary()), "n": pa.array([seen], pa.int64())})


def _reduced(model: Classifier):
    """Texts as the features they hold; what stands before the text is carried."""

    def run(batches):
        for batch in batches:
            for piece in flat.text_pieces(batch.column(1)):
                values, offsets = model.features(piece)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, piece.rows), flat.listed(values.astype(np.int16), offsets)], ["doc_id", "held"]
                )

    return run


def remainder(ident) -> F.Column:
    return F.crc32(F.col(ident).cast("string").cast("binary")) % 3


def scored(
    documents: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    prior: float | None = None,
    max_positive: int = 50_000,
) -> DataFrame:
    """One row per document: ``doc_id, held_out`` (its label is never learned from), ``score`` (0 to 1), ``predicted``."""
    store = Store(documents.sparkSession, "toxicity")
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.where("doc_id is not null and toxic is not null").where(remainder("doc_id") != 1)
    known = marks.agg(F.count(F.lit(1)).alias("n"), F.count_if("toxic").alias("toxic")).first()
    if prior is None:
        prior = known["toxic"] / known["n"] if 0 < known["toxic"] < known["n"] else PRIOR
    prior = min(max(prior, LEAST), MOST_PRIOR)
    confirmed = marks.where("toxic")
    if known["toxic"] > max_positive:
        confirmed = confirmed.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(max_positive / known["toxic"] * (1 << 30)))
    # at most about max_positive ids and their texts; the corpus itself is not shuffled
    confirmed = store.write("confirmed", texts.join(F.broadcast(confirmed.select("doc_id").distinct()), "doc_id", "left_semi"))
    model = _features(texts, confirmed, store)
    reduced = store.write("reduced", texts.mapInArrow(_reduced(model), "doc_id bigint, held array<smallint>"))
    if len(model.buckets):
        rows = confirmed.mapInArrow(_reduced(model), "doc_id bigint, held array<smallint>").select("held")
        lists = [r["held"] for r in rows.collect()]  # about max_positive at most
        positive = np.array([v for held in lists for v in held], np.int64), np.cumsum([0, *map(len, lists)])
        kind = "weights binary, n bigint"
        parts = reduced.select("held").mapInArrow(_trained(model, positive, prior), kind)
        parts = parts.repartition(8).mapInArrow(_averaged, kind).collect()
        seen = sum(r["n"] for r in parts)
        if seen:
            model.weights = sum(np.frombuffer(r["weights"]) for r in parts) / seen

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(*_lists(batch.column(1))))], ["doc_id", "score"])

    return reduced.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _features(texts: DataFrame, confirmed: DataFrame, store: Store) -> Classifier:
    """The marks in which confirmed documents differ most from all documents."""
    kind = "bucket bigint, n bigint"
    per_group = store.write("groups", confirmed.select("text").mapInArrow(_confirmed_buckets, "print bigint, bucket bigint").distinct())
    groups = per_group.select("print").distinct().count()
    if not groups:
        return Classifier(np.zeros(0, np.int64))
    least = max(2, 0.01 * groups)
    # a hundred times the marks of a mean confirmed document at most
    inside = {r["bucket"]: r["n"] for r in per_group.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).collect()}
    buckets = np.array(sorted(inside), np.int64)
    holders = texts.select("text").mapInArrow(_holders(buckets), kind).groupBy("bucket").agg(F.sum("n").alias("n"))
    held = {r["bucket"]: r["n"] for r in holders.collect()}  # a row per candidate
    documents = held.pop(-1)
    a = np.array([inside[b] for b in buckets.tolist()], float)
    b = np.array([held[b] for b in buckets.tolist()], float)
    ratio = np.where(a / groups > b / documents, likelihood_ratio(a, groups, b, documents), -1.0)
    best = np.argsort(-ratio, kind="stable")[:FEATURES]
    return Classifier(np.sort(buckets[best[ratio[best] >= LEAST_RATIO]]))
