"""Document quality by kernel ridge regression on text statistics, calibrated by isotonic regression.

Each text gives some twenty statistics (kinds of characters, shapes of words, repetition). Random Fourier features
approximate a Gaussian kernel over the standardised statistics; ridge weights come from normal equations,
summed per task and again in a handful of tasks, so that the driver sees a few matrices of fixed size. The sums are kept per
fold: they give every fold's error under the others' weights, by which the ridge is chosen, and
scores of rows that the weights have not seen, on which the calibration (pool adjacent violators over 2,000 bins) is fitted.

Learned from labelled rows alone, at most ``max_rows`` of them (a hash of the id decides beyond that bound).
Labels, language, source and id are no inputs of a score.

Defined cases: null text counts as empty and gets a score like any text; labels without a quality are left out, other
values than 1 count as 0; with no label at all every score is 0.5; repeated ids give a row each; texts of any length are read whole; an empty table
gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import Store

FEATURES, FOLDS, SEED = 320, 5, 7
BINS = 2_000
RIDGES = (1e-4, 1e-3, 1e-2, 1e-1, 1.0, 10.0)
UPPER = flat.byte_table(lambda b: 65 <= b <= 90)
LOWER = flat.byte_table(lambda b: 97 <= b <= 122)
WIDE = flat.byte_table(lambda b: b >= 0x80)
NOT_LINE_END = flat.byte_table(lambda b: b != 10)
KINDS = (
    UPPER,
    LOWER,
    WIDE,
    flat.byte_table(lambda b: 48 <= b <= 57),
    flat.byte_table(lambda b: chr(b) in ".,;:?'\"-()"),
    flat.byte_table(lambda b: chr(b) in "!"),
    flat.byte_table(lambda b: chr(b) in "#$%&*@^~+="),
    flat.byte_table(lambda b: chr(b) in "|<>{}[]\\/_`"),
    flat.byte_table(lambda b: b in flat.SPACES),
    flat.byte_table(lambda b: b == 10),
)
STATS = len(KINDS) + 12


def statistics(piece: flat.Piece) -> np.ndarray:
    """(rows, STATS) statistics of whole texts; shares of nothing are 0."""
    data, bounds = piece.data, piece.offsets
    size = np.diff(bounds).astype(float)
    found = flat.find_words(piece)
    words = found.counts().astype(float)
    rows, places = piece.rows, found.rows

    def share(total: np.ndarray, of: np.ndarray) -> np.ndarray:
        return total / np.maximum(of, 1.0)

    def summed(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        totals = np.concatenate([[0], np.cumsum(values)])
        return (totals[at[1:]] - totals[at[:-1]]).astype(float)

    owner = np.repeat(np.arange(rows), found.counts())
    lengths = (found.ends - found.starts).astype(float)
    hashes = flat.span_hashes(data, found.starts, found.ends)
    own = flat.mixed(owner.astype(np.uint64))
    unique, first = np.unique(hashes ^ own, return_index=True)
    distinct = np.bincount(owner[first], minlength=rows).astype(float)
    after = np.zeros(len(hashes), bool)
    after[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    pairs = np.zeros(len(hashes), np.uint64)
    pairs[1:] = flat.mixed(hashes[1:] + flat.mixed(hashes[:-1])) ^ own[1:]
    paired = np.ones(len(hashes), bool)
    paired[:1] = False
    paired[1:] &= owner[1:] == owner[:-1]
    _, first = np.unique(pairs[paired], return_index=True)
    distinct_pairs = np.bincount(owner[paired][first], minlength=rows).astype(float)
    lines = flat.find_words(piece, NOT_LINE_END)
    line_owner = np.repeat(np.arange(rows), lines.counts())
    line_hashes = flat.span_hashes(data, lines.starts, lines.ends) ^ flat.mixed(line_owner.astype(np.uint64))
    _, first = np.unique(line_hashes, return_index=True)
    distinct_lines = np.bincount(line_owner[first], minlength=rows).astype(float)
    letters = np.concatenate([[0], np.cumsum(UPPER[data] | LOWER[data] | WIDE[data])])
    uppers = np.concatenate([[0], np.cumsum(UPPER[data])])
    has = letters[found.ends] - letters[found.starts]
    loud = (uppers[found.ends] - uppers[found.starts] == has) & (has > 1)
    plain_end = UPPER[data[found.ends - 1]] | LOWER[data[found.ends - 1]] | WIDE[data[found.ends - 1]]
    mean = share(summed(lengths, places), words)
    columns = [share(summed(kind[data], bounds), size) for kind in KINDS]
    columns += [
        np.log1p(words),
        mean,
        np.sqrt(np.maximum(share(summed(lengths**2, places), words) - mean**2, 0.0)),
        share(distinct, words),
        share(summed(after, places), words),
        share(distinct_pairs, words - 1),
        share(distinct_lines, lines.counts().astype(float)),
        share(words, lines.counts().astype(float)),
        share(summed(has == 0, places), words),
        share(summed(loud, places), words),
        share(summed(UPPER[data[found.starts]], places), words),
        share(summed(plain_end, places), words),
    ]
    return np.stack(columns, axis=1)


@dataclass
class Model:
    """What scores a text: standardisation, frequencies and phases, weights, and the calibration's knots."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features, with a constant in front."""
        rng = np.random.default_rng(SEED)
        frequencies = rng.standard_normal((len(self.mean), FEATURES)) / np.sqrt(len(self.mean))
        phases = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        return np.concatenate([np.ones((len(z), 1)), np.sqrt(2 / FEATURES) * np.cos(z @ frequencies + phases)], axis=1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of quality 1."""
        return np.clip(np.interp(self.features(stats) @ self.weights, self.raw, self.calibrated), 0.0, 1.0)


def pooled(position: np.ndarray, positive: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (mean position, rate) of a rising step function."""
    blocks: list[list[float]] = []
    for x, p, n in zip(position.tolist(), positive.tolist(), count.tolist()):
        blocks.append([x * n, p, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _stats(batches):
    for batch in batches:
        for piece in flat.text_pieces(batch.column(1)):
            stats = statistics(piece)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(piece.first, piece.rows),
                    flat.listed(stats.ravel(), np.arange(piece.rows + 1) * STATS),
                ],
                ["doc_id", "stats"],
            )


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), STATS)


def _normal_equations(model: Model):
    """Sums of products of a task's rows: one matrix per fold, targets as the last row and column."""

    def run(batches):
        width = FEATURES + 2
        sums = np.zeros((FOLDS, width, width))
        for batch in batches:
            fold = batch.column(2).to_numpy()
            x = np.concatenate(
                [model.features(_matrix(batch.column(0))), batch.column(1).to_numpy().astype(float)[:, None]], axis=1
            )
            for f in range(FOLDS):
                part = x[fold == f]
                sums[f] += part.T @ part
        yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tobytes()], pa.binary())})

    return run


def _added(batches):
    total = None
    for batch in batches:
        for value in batch.column(0):
            sums = np.frombuffer(value.as_py())
            total = sums.copy() if total is None else total + sums
    if total is not None:
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})


def _ridge(sums: np.ndarray, ridge: float) -> np.ndarray:
    gram, target = sums[:-1, :-1], sums[:-1, -1]
    penalty = np.eye(len(gram)) * ridge
    penalty[0, 0] = 1e-9
    return np.linalg.solve(gram + penalty, target)


def _unseen(model: Model, weights: np.ndarray):
    """Raw scores of rows under the other folds' weights, counted per bin."""

    def run(batches):
        n, positive, total = np.zeros(BINS), np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            fold = batch.column(2).to_numpy()
            raw = (model.features(_matrix(batch.column(0))) * weights[fold]).sum(axis=1)
            at = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            n += np.bincount(at, minlength=BINS)
            positive += np.bincount(at, batch.column(1).to_numpy().astype(float), BINS)
            total += np.bincount(at, raw, BINS)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bin": held, "n": n[held], "positive": positive[held], "total": total[held]})

    return run


def fold_of(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def learned_from(labels: DataFrame, max_rows: int) -> DataFrame:
    """``doc_id, label, fold`` of the labelled rows outside fold 0, about ``max_rows`` of them at most."""
    chosen = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("quality") == 1).cast("int").alias("label")
    ).where("doc_id is not null and label is not null")
    chosen = chosen.withColumn("fold", fold_of("doc_id").cast("int")).where("fold <> 0")
    known = chosen.count()
    if known > max_rows:
        chosen = chosen.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(max_rows / known * (1 << 30)))
    return chosen


def fit(stats: DataFrame, chosen: DataFrame, store: Store) -> Model:
    """The model learned from the rows of ``learned_from``; ``stats`` has ``doc_id, stats``."""
    rows = store.write("labelled", stats.join(chosen, "doc_id").select("stats", "label", "fold"))
    moments = rows.select(
        F.count(F.lit(1)),
        *[f(F.col("stats")[k]) for k in range(STATS) for f in (F.avg, F.stddev_pop)],
        F.avg("label"),
    ).first()
    blank = Model(np.zeros(STATS), np.ones(STATS), np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    if not moments[0]:
        return blank
    values = np.array(moments[1:-1]).reshape(STATS, 2)
    model = Model(values[:, 0], np.maximum(values[:, 1], 1e-6), blank.weights, blank.raw, np.array([moments[-1]]))
    parts = rows.mapInArrow(_normal_equations(model), "sums binary").repartition(8).mapInArrow(_added, "sums binary")
    width = FEATURES + 2
    sums = sum(np.frombuffer(r["sums"]).reshape(FOLDS, width, width) for r in parts.collect())  # at most 8 rows
    all_rows = sums.sum(axis=0)

    def error(ridge: float) -> float:
        total = 0.0
        for f in range(1, FOLDS):
            w = np.append(_ridge(all_rows - sums[f], ridge), -1.0)
            total += w @ sums[f] @ w
        return total

    ridge = min(RIDGES, key=error)
    model.weights = _ridge(all_rows, ridge)
    apart = np.array([_ridge(all_rows - sums[f], ridge) for f in range(FOLDS)])
    counted = rows.mapInArrow(_unseen(model, apart), "bin bigint, n double, positive double, total double")
    bins = counted.groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("n", "positive", "total")]).orderBy("bin").collect()
    n, positive, total = (np.array([b[c] for b in bins]) for c in ("n", "positive", "total"))
    model.raw, model.calibrated = pooled(total / n, positive, n)
    return model


def _statistics_of(texts: DataFrame) -> DataFrame:
    texts = texts.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_stats, "doc_id bigint, stats array<double>")


def trained(documents: DataFrame, labels: DataFrame, max_rows: int = 1_000_000) -> tuple[Model, DataFrame]:
    """The model, and the statistics of all documents (``doc_id, stats``)."""
    store = Store(documents.sparkSession, "quality")
    stats = store.write("stats", _statistics_of(documents))
    return fit(stats, learned_from(labels, max_rows), store), stats


def trained_on_labelled(documents: DataFrame, labels: DataFrame, max_rows: int = 1_000_000) -> Model:
    """The model alone: only labelled texts are read for it, and no text is shuffled."""
    store = Store(documents.sparkSession, "quality")
    chosen = store.write("chosen", learned_from(labels, max_rows))
    # some eight bytes for each of about max_rows ids at most
    known = documents.withColumn("doc_id", F.col("doc_id").cast("bigint")).join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    return fit(store.write("stats", _statistics_of(known)), chosen, store)


def scored(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 1_000_000) -> DataFrame:
    """One row per document: ``doc_id, held_out`` (outside training), ``score`` (0 to 1), ``predicted``."""
    model, stats = trained(documents, labels, max_rows)

    def run(batches):
        for batch in batches:
            score = model.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", F.coalesce(fold_of("doc_id") == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 1_000_000) -> DataFrame:
    """The documents, all columns, whose score reaches ``threshold``; texts are never shuffled, and read twice only where they are labelled."""
    model = trained_on_labelled(documents, labels, max_rows)
    at = documents.columns.index("text")

    def run(batches):
        for batch in batches:
            for piece in flat.text_pieces(batch.column(at)):
                good = model.score(statistics(piece)) >= threshold
                yield batch.slice(piece.first, piece.rows).filter(pa.array(good))

    return documents.mapInArrow(run, documents.schema)
