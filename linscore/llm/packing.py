"""Packing of tokenised documents into sequences: non-negative least squares over the lengths' histogram.

A document's ids are cut into full windows, which are sequences of their own, and one tail. For the tails,
shallow combinations of two or three lengths that fill a window exactly are enumerated, and least squares with
non-negative unknowns finds how often to use each so that together they use up the histogram. The counts are rounded down to
what is there, and what is left is packed greedily: long tails first, one behind the other, cut where a window
is full. The very end is cut into powers of two, which need no padding. Without a vocabulary nothing else is driver-side:
the histogram and the plan are bounded by the window, whatever the corpus.

A tail's rank among those of its length says which place of the plan it takes. Ranks are counted in groups of a few
thousand rows (``bucket``), so that a length that a third of all documents share spreads over many tasks.

Defined cases: null or empty text gives the separator alone; rows that repeat an id (null as well) are packed one by
one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .bytebpe import byte_bpe
from .store import Store

GROUP_ROWS = 5_000
STEPS = (0, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233)


def combinations(window: int) -> list[tuple[int, ...]]:
    """Pairs of lengths that fill a window, and triples whose two smaller lengths are alike or nearly so."""
    pairs = [(a, window - a) for a in range(1, window // 2 + 1)]
    triples = {
        tuple(sorted((a, a + d, window - 2 * a - d))) for d in STEPS for a in range(1, window) if window - 2 * a - d > 0
    }
    return pairs + sorted(triples)


def solved(histogram: np.ndarray, combos: list[tuple[int, ...]], rounds: int = 400) -> np.ndarray:
    """How often to use each combination: least squares against ``histogram[length]``, no count below zero.

    Accelerated projected gradient steps; a product with the matrix is a sum over the lengths of a combination.
    """
    depth = max(map(len, combos))
    index = np.array([[*c, *[0] * (depth - len(c))] for c in combos])
    held = index > 0
    n = len(histogram)

    def used(x):
        return np.bincount(index[held], np.repeat(x, held.sum(axis=1)), n)

    def back(y):
        return (y[index] * held).sum(axis=1)

    norm = np.ones(len(combos))
    for _ in range(20):
        norm = back(used(norm))
        bound = np.linalg.norm(norm)
        norm /= bound
    x = ahead = np.zeros(len(combos))
    t = 1.0
    target = histogram.astype(float)
    for _ in range(rounds):
        new = np.maximum(0.0, ahead - back(used(ahead) - target) / (1.01 * bound))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def planned(histogram: np.ndarray, window: int) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray, int]:
    """Places ``(length, first rank, last rank + 1, first sequence, offset)``, tails placed per length, sequences used."""
    combos = combinations(window)
    counts = solved(histogram, combos)
    free, done = histogram.astype(np.int64).copy(), np.zeros(len(histogram), np.int64)
    places, sequences = [], 0

    def use(combo: tuple[int, ...], most: int) -> None:
        nonlocal sequences
        kinds = {length: combo.count(length) for length in combo}
        times = min([most, *(int(free[length]) // k for length, k in kinds.items())])
        if times <= 0:
            return
        offset = 0
        for length in combo:
            places.append((length, int(done[length]), int(done[length]) + times, sequences, offset))
            done[length] += times
            free[length] -= times
            offset += length
        sequences += times

    order = np.argsort(-counts, kind="stable")
    for k in order:
        use(combos[k], int(np.floor(counts[k])))
    for k in order:  # what rounding left, by the same combinations
        use(combos[k], int(free.max(initial=0)))
    return places, done, sequences


def _tokenised(path: str, separator: int, window: int):
    def run(batches):
        encoder = byte_bpe(path)
        context = TaskContext.get()
        key = (context.partitionId() if context else 0) << 36
        for batch in batches:
            for piece in flat.text_pieces(batch.column(1)):
                ids, rows = encoder.encode(piece)
                doc_ids = batch.column(0).slice(piece.first, piece.rows).to_pylist()
                last = np.array([separator], "<u4")
                out = {n: [] for n in ("piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
                for doc, a, b in zip(doc_ids, rows[:-1].tolist(), rows[1:].tolist()):
                    whole = memoryview(np.concatenate([ids[a:b].astype("<u4"), last])).cast("B")
                    total = b - a + 1
                    for start in range(0, total, window):
                        length = min(window, total - start)
                        part = whole[4 * start : 4 * (start + length)]
                        out["piece"].append(key)
                        out["doc_id"].append(doc)
                        out["start"].append(start)
                        out["length"].append(length)
                        out["ids_crc32"].append(zlib.crc32(part))
                        out["doc_tokens"].append(total)
                        out["ids"].append(bytes(part) if length < window else None)
                        key += 1
                yield pa.RecordBatch.from_pydict(
                    out, pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in out])
                )

    return run


def _cut(window: int, bounds: list[int]):
    """Parts of tails that cross the end of a window, or lie in the last one, cut at ``bounds``."""
    tops = np.array(bounds, np.int64)

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = {n: [] for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
            for row in rows:
                a, b = row["place"], row["place"] + row["length"]
                inner = tops[(tops > a) & (tops < b)].tolist()
                full = range((a // window + 1) * window, min(b, int(tops[0])), window)
                edges = sorted({a, *full, *inner, b})
                for x, y in zip(edges[:-1], edges[1:]):
                    if x < tops[0]:
                        sequence, offset = x // window, x % window
                    else:
                        k = int(np.searchsorted(tops, x, side="right")) - 1
                        sequence, offset = int(tops[0]) // window + k, x - int(tops[k])
                    part = row["ids"][4 * (x - a) : 4 * (y - a)]
                    for name, value in (
                        ("doc_id", row["doc_id"]), ("start", row["start"] + x - a), ("length", y - x),
                        ("ids_crc32", zlib.crc32(part)), ("doc_tokens", row["doc_tokens"]),
                        ("sequence_id", sequence), ("offset", offset),
                    ):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, pa.schema([(n, pa.int64()) for n in out]))

    return run


RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def packed(documents: DataFrame, tokenizer: str, window: int = 1024, separator: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``tokenizer`` is the file of a byte-level BPE tokenizer, ``window`` the longest sequence.
    """
    spark = documents.sparkSession
    store = Store(spark, "packing")
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = store.write(
        "pieces",
        texts.mapInArrow(
            _tokenised(tokenizer, separator, window),
            "piece bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary",
        ),
    )
    histogram = np.zeros(window + 1, np.int64)
    for row in pieces.where(F.col("length") < window).groupBy("length").count().collect():  # at most window - 1 rows
        histogram[row["length"]] = row["count"]
    places, done, used = planned(histogram, window)

    # what the plan leaves: one stream, long tails first; the last window ends at powers of two
    left = histogram - done
    lengths = np.arange(window + 1)
    tokens = left * lengths
    base = np.zeros(window + 1, np.int64)
    base[::-1] = np.cumsum(tokens[::-1]) - tokens[::-1]
    stream = int(tokens.sum())
    bounds = [stream // window * window]
    for bit in reversed(range(window.bit_length())):
        if (stream - bounds[0]) >> bit & 1:
            bounds.append(bounds[-1] + (1 << bit))
    full = pieces.where(F.col("length") == window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("piece") + used + stream // window + len(bounds)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    )
    if not histogram.any():
        return full.select(RESULT)

    # ranks among the tails of a length; tables of at most window rows say where a length stands
    def per_length(**columns) -> DataFrame:
        rows = [(int(k), *(int(c[k]) for c in columns.values())) for k in np.flatnonzero(histogram)]
        return F.broadcast(spark.createDataFrame(rows, ", ".join(f"{n} bigint" for n in ("length", *columns))))

    tails = pieces.where(F.col("length") < window).drop("ids")
    dealt = tails.join(per_length(groups=-(-histogram // GROUP_ROWS)), "length").withColumn(
        "bucket", F.pmod(F.xxhash64("piece"), F.col("groups"))
    )
    sizes = dealt.groupBy("length", "bucket").count()
    before = sizes.selectExpr(
        "length", "bucket", "sum(count) over (partition by length order by bucket rows unbounded preceding) - count as before"
    )
    ranked = store.write(
        "ranked",
        dealt.selectExpr("*", "row_number() over (partition by length, bucket order by piece) - 1 as within")
        .join(before, ["length", "bucket"])
        .select("piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("within") + F.col("before")).alias("rank")),
    )
    # at most three places for each of some thousand combinations
    plan = F.broadcast(
        spark.createDataFrame(places, "length bigint, rank_from bigint, rank_to bigint, sequence bigint, offset bigint")
    )
    placed = ranked.join(
        plan, (ranked["length"] == plan["length"]) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    ).select(
        "doc_id", "start", ranked["length"], "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset",
    )
    rest = (
        ranked.join(per_length(done=done, base=base), "length")
        .where("rank >= done")
        .withColumn("place", F.expr("base + (rank - done) * length"))
        .withColumn("crosses", F.expr(f"place div {window} <> (place + length - 1) div {window} or place + length > {bounds[0]}"))
    )
    whole = rest.where("not crosses").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.expr(f"place div {window} + {used}").alias("sequence_id"), F.expr(f"place % {window}").alias("offset"),
    )
    crossing = rest.where("crosses").select("piece", "doc_id", "start", "length", "doc_tokens", "place")
    cut = (
        pieces.where(F.col("length") < window).select("piece", "ids").join(crossing, "piece")
        .mapInArrow(_cut(window, bounds), ", ".join(f"{n} bigint" for n in RESULT))
        .withColumn("sequence_id", F.col("sequence_id") + used)
    )
    found = full
    for part in (placed, whole, cut):
        found = found.unionByName(part)
    return found.select(RESULT)
