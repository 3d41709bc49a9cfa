"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find.

Words are runs of bytes other than ASCII white space, A-Z lower-cased; a document's set holds its distinct
5-word shingles, or its whole sequence if it has fewer words. Links join documents whose sets have a Jaccard
similarity of at least ``percent`` / 100, confirmed on the full sets (as 64-bit hashes).

Signatures: each shingle walks a random permutation of the slots and offers slot p[i] the value i + u
(SuperMinHash). Offers of a later round never beat those of an earlier one, so rounds run over all shingles of
a piece at once and stop for a document as soon as all its slots are taken: one round for long documents.
A pair at the threshold shares none of the bands with a probability of (1 - 0.75**5)**36 = 6e-5.

Groups of any size: equal sets are one vertex; within a bucket vertices are compared with one pivot first. Where a
bucket then still holds several components, these are compared with each other, and with nothing of their own: small
buckets as pairs that the distances to the pivot do not rule out (1 - Jaccard is a metric), large ones in pairs of
blocks of bounded size, each of which gives a forest of its links. No bucket is collected or paired in full.

Defined cases: null or blank text gives the empty set, linked with nothing; a null id takes no part in links
(``component_id`` null, ``kept`` true); rows that repeat an id share its component and each get a row; extra
columns, whatever their names, are ignored; texts longer than a piece are read whole, as a piece of their own; an empty table
gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .components import components, forest
from .store import Store

WORDS, SLOTS, BANDS = 5, 180, 36
FACTORS = flat.mixed(np.arange(1, WORDS + 2, dtype=np.uint64) * np.uint64(flat.BASE)) | np.uint64(1)
FEW_PAIRS, BLOCK_ROWS, BLOCK_SHINGLES = 256, 1024, 2_000_000


def shingle_sets(piece: flat.Piece, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one row behind the other, and the row offsets."""
    found = flat.find_words(piece, lower=True)
    hashes = flat.span_hashes(found.data, found.starts, found.ends)
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    whole = sum(padded[j : j + len(hashes)] * FACTORS[j] for j in range(words)) if len(hashes) else hashes
    whole = flat.mixed(whole)
    sets, sizes = [], np.zeros(piece.rows, np.int64)
    for row, (a, b) in enumerate(zip(found.rows[:-1].tolist(), found.rows[1:].tolist())):
        if b - a >= words:
            part = np.sort(whole[a : b - words + 1])
            part = part[np.concatenate([[True], part[1:] != part[:-1]])]
        elif b > a:
            short = (hashes[a:b] * FACTORS[: b - a]).sum(dtype=np.uint64, keepdims=True)
            part = flat.mixed(short + FACTORS[words : words + 1] * np.uint64(b - a))
        else:
            continue
        sizes[row] = len(part)
        sets.append(part)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), offsets


def signatures(elements: np.ndarray, rows: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each row's elements: (rows, slots) of round * 2**40 + draw; no elements: all ones."""
    n = len(rows) - 1
    taken = np.full(n * slots, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(rows))
    order = None
    for step in range(slots):
        draw = flat.mixed(elements + np.uint64((step + 1) * 0xD1B54A32D192ED03 & flat.MASK))
        pick = step + ((draw >> np.uint64(40)) % np.uint64(slots - step)).astype(np.int64)
        if order is not None:
            line = np.arange(len(elements))
            slot = order[line, pick].astype(np.int64)
            order[line, pick] = order[line, step]
            order[line, step] = slot
        else:
            slot = pick
        place = owner * slots + slot
        value = (draw & np.uint64((1 << 40) - 1)) | np.uint64(step << 40)
        better = value < taken[place]
        np.minimum.at(taken, place[better], value[better])
        full = (taken.reshape(n, slots) >> np.uint64(40) <= step).all(axis=1) if n else np.zeros(0, bool)
        stay = ~full[owner]
        if not stay.any():
            break
        first, order_before = pick[stay], order
        elements, owner = elements[stay], owner[stay]
        if order_before is None:
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(elements), 1))
            line = np.arange(len(elements))
            order[line, first] = 0
            order[line, 0] = first
        else:
            order = order_before[stay]
    return taken.reshape(n, slots)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key per row and band, different between bands."""
    parts = signature.reshape(len(signature), bands, -1)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64)[None, :], parts.shape[:2]).copy()
    for j in range(parts.shape[2]):
        key = flat.mixed(key * np.uint64(flat.BASE) + parts[:, :, j])
    return key


def _sketches(batches):
    for batch in batches:
        for piece in flat.text_pieces(batch.column(1)):
            sets, rows = shingle_sets(piece)
            sizes = np.diff(rows)
            held = np.flatnonzero(sizes)
            prints = np.zeros((2, piece.rows), np.uint64)
            if len(held):
                prints[0, held] = np.add.reduceat(flat.mixed(sets ^ np.uint64(flat.BASE)), rows[:-1][held])
                prints[1, held] = np.add.reduceat(flat.mixed(sets + np.uint64(flat.BASE)), rows[:-1][held])
            keys = band_keys(signatures(sets, rows)).view(np.int64)
            keys = keys[held]
            lengths = np.where(sizes > 0, BANDS, 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(piece.first, piece.rows),
                    pa.array(sizes),
                    pa.array(prints[0].view(np.int64)),
                    pa.array(prints[1].view(np.int64)),
                    flat.listed(keys.ravel(), np.concatenate([[0], np.cumsum(lengths)])),
                ],
                ["doc_id", "n_shingles", "print_a", "print_b", "bands"],
            )


def _sets(batches):
    for batch in batches:
        for piece in flat.text_pieces(batch.column(1)):
            sets, rows = shingle_sets(piece)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(piece.first, piece.rows), flat.listed(sets.view(np.int64), rows)], ["id", "shingles"]
            )


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``low``, ``high`` with the size of their sets' intersection and union."""
    lows = sets.select(F.col("id").alias("low"), F.col("shingles").alias("a"))
    highs = sets.select(F.col("id").alias("high"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b")).cast("bigint")
    return (
        pairs.select("low", "high")
        .join(lows, "low")
        .join(highs, "high")
        .select("low", "high", both.alias("both"), (F.size("a") + F.size("b") - both).alias("either"), F.size("b").alias("size"))
    )


def _block_links(percent: int):
    """Links between different components in a pair of blocks, as a forest; set sizes and intersections are counted exactly."""

    def run(table: pa.Table) -> pa.Table:
        ids, component = table["id"].to_numpy(), table["component"].to_numpy()
        outer = table["outer"].to_numpy(zero_copy_only=False)
        lists = table["shingles"].combine_chunks()
        sizes = np.diff(np.asarray(lists.offsets)).astype(np.int64)
        _, column = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), sizes)
        shared = np.bincount(column) > 1
        place = np.cumsum(shared) - 1
        held = shared[column]
        owner, column = owner[held], place[column[held]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        left = np.flatnonzero(outer)
        # a part's counts are whole in float32, their sum and its hundredfold in float64
        both = np.zeros((len(left), len(ids)), np.float64)
        wide = int(shared.sum())
        for first in range(0, wide, 4096):
            a, b = np.searchsorted(column, [first, first + 4096])
            part = np.zeros((len(ids), 4096), np.float32)
            part[owner[a:b], column[a:b] - first] = 1
            both += part[left] @ part.T
        either = sizes[left][:, None] + sizes[None, :] - both
        link = (both * 100 >= either * percent) & (component[left][:, None] != component[None, :])
        x, y = np.nonzero(link)
        x = ids[left[x]]
        y = ids[y]
        low, high = forest(np.minimum(x, y), np.maximum(x, y))
        return pa.table({"low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())})

    return run


def _dealt(placed: DataFrame, store: Store | None = None) -> DataFrame:
    """Rows of each cluster (``cluster, id, component, n_shingles``) dealt over pairs of an outer block ``i`` and a block ``j``.

    A cluster's largest component is its core. Only rows outside it ask (``outer``), and they ask all rows: each row answers in its own block
    once per outer block, of which there is one unless very many rows ask, and each row that asks goes to every block.
    """
    counted = placed.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("width"))
    clusters = counted.groupBy("cluster").agg(F.max_by("component", "n").alias("core"), F.sum("n").alias("n"), F.sum("width").alias("width"), F.max("n").alias("core_n"))
    core_width = counted.join(clusters.select("cluster", F.col("core").alias("component")), ["cluster", "component"]).select("cluster", F.col("width").alias("core_width"))

    def blocks(rows, width):
        return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(width / BLOCK_SHINGLES))

    sizes = clusters.join(core_width, "cluster").select(
        "cluster", "core", blocks(F.col("n"), F.col("width")).alias("blocks"),
        blocks(F.col("n") - F.col("core_n"), F.col("width") - F.col("core_width")).alias("outers"),
    ).where("outers > 0")
    if store is not None:  # written first, so that the rows of a hot cluster may be split where they meet its sizes
        sizes = store.write("block-sizes", sizes)
    rows = placed.join(sizes, "cluster").withColumn("hash", F.xxhash64("id"))

    def every(count):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))

    columns = ["cluster", "i", "j", "id", "component", "outer"]
    answering = rows.select(
        "cluster", every("outers").alias("i"), F.pmod("hash", "blocks").alias("j"), "id", "component", F.lit(False).alias("outer")
    )
    asking = rows.where("component <> core").select(
        "cluster", F.pmod("hash", "outers").alias("i"), every("blocks").alias("j"), "id", "component", F.lit(True).alias("outer")
    )
    return answering.unionByName(asking).select(columns)


def _linked_in_blocks(store: Store, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that members of large buckets have outside their component.

    Buckets that share members make one cluster, so that members which meet in many bands are compared once. A cluster is
    dealt over blocks (``_dealt``), and each pair of them is a task's worth: rows out are a forest, never pairs.
    """
    ties = members.groupBy("bucket").agg(F.min("id").alias("low")).join(members.select("bucket", F.col("id").alias("high")), "bucket")
    clusters = components(store, "clusters", ties.where("low < high").select("low", "high"))
    known = members.select("id", "component", "n_shingles").distinct()
    placed = store.write(
        "clustered",
        known.join(clusters.withColumnRenamed("component", "cluster"), "id", "left")
        .withColumn("cluster", F.coalesce("cluster", "id")),
    )
    dealt = _dealt(placed, store).join(sets, "id")
    return dealt.groupBy("cluster", "i", "j").applyInArrow(_block_links(percent), "low bigint, high bigint")


def near_duplicates(documents: DataFrame, percent: int = 75) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept, representative``.

    ``component_id`` is the smallest id reachable over links; ``representative`` the smallest id with an equal set.
    """
    spark = documents.sparkSession
    store = Store(spark, "near-duplicates")
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = store.write(
        "sketches",
        texts.mapInArrow(_sketches, "doc_id bigint, n_shingles bigint, print_a bigint, print_b bigint, bands array<bigint>"),
    )
    same = ["print_a", "print_b", "n_shingles"]
    sketches = store.write("prints", sketched.select("doc_id", *same))
    full = sketches.where("n_shingles > 0 and doc_id is not null")
    # copies meet before the shuffle; the smallest id stands for all
    first = store.write("first", full.groupBy(*same).agg(F.min("doc_id").alias("representative")))
    vertices = store.write(
        "vertices",
        sketched.join(first.withColumnRenamed("representative", "doc_id"), ["doc_id", *same])
        .dropDuplicates(["doc_id", *same])
        .select(F.col("doc_id").alias("id"), "bands"),
    )
    store.drop("sketches")
    rows = vertices.select("id", F.explode("bands").alias("bucket"))
    pivots = rows.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last")
    # written first, so that the rows of a hot bucket may be split where they meet its pivot
    pivots = store.write("pivots", pivots.select("bucket", "pivot"))
    members = store.write("members", rows.join(pivots, "bucket").select("bucket", "id", "pivot"))
    store.drop("vertices", "pivots")
    involved = store.write("involved", members.select("id").distinct())
    sets = store.write(
        "sets",
        texts.join(involved, texts["doc_id"] == involved["id"], "left_semi")
        .mapInArrow(_sets, "id bigint, shingles array<bigint>"),
    )
    # rows that give one id different texts tie those texts' sets together
    several = full.groupBy("doc_id").agg(
        (F.min("print_a") != F.max("print_a")).alias("a"), (F.min("print_b") != F.max("print_b")).alias("b")
    ).where("a or b").select("doc_id")
    links_by_round = [
        full.select("doc_id", *same).join(several, "doc_id", "left_semi").join(first, same).where("representative < doc_id")
        .select(F.col("representative").alias("low"), F.col("doc_id").alias("high"))
    ]

    def round_of(name: str, pairs: DataFrame) -> DataFrame:
        found = store.write(f"{name}-compared", _compared(pairs.distinct(), sets))
        links_by_round.append(found.where(F.col("both") * 100 >= F.col("either") * percent).select("low", "high"))
        return found

    def labelled(name: str) -> DataFrame:
        links = links_by_round[0]
        for more in links_by_round[1:]:
            links = links.unionByName(more)
        return components(store, name, links)

    # round 1: everyone against the bucket's smallest id
    found = round_of("star", members.where("id <> pivot").select(F.col("pivot").alias("low"), F.col("id").alias("high")))
    distances = found.select(
        F.col("low").alias("pivot"), F.col("high").alias("id"), F.col("size").alias("n_shingles"),
        (1 - F.col("both") / F.col("either")).alias("distance"),
    )
    comp = labelled("first-round")
    members = store.write(
        "placed",
        members.where("id <> pivot").join(distances, ["pivot", "id"]).select("bucket", "id", "n_shingles", "distance"),
    )
    store.drop("members")

    def open_members(comp: DataFrame, members: DataFrame) -> DataFrame:
        """Members, without pivots, of buckets that still hold several components; ``core``: that nearest to the pivot."""
        placed = members.join(comp, "id", "left").select(
            "bucket", "id", "n_shingles", "distance", F.coalesce("component", "id").alias("component")
        )
        spread = placed.groupBy("bucket").agg(
            F.min("component").alias("least"), F.max("component").alias("most"),
            F.min(F.struct("distance", "component")).alias("nearest"),
        ).where("least < most")
        return placed.join(spread.select("bucket", F.col("nearest.component").alias("core")), "bucket")

    members = store.write("open", open_members(comp, members))
    if not members.isEmpty():
        # what is still apart is compared in full: few rows as pairs, many in blocks
        sizes = members.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.sum((F.col("component") != F.col("core")).cast("bigint")).alias("outer")
        )
        few = members.join(sizes.where(f"n * outer <= {FEW_PAIRS}").select("bucket"), "bucket")
        near = F.expr(
            "a.bucket = b.bucket and a.component <> b.component and (b.component = b.core or a.id < b.id)"
            f" and abs(a.distance - b.distance) <= {1 - percent / 100} + 1e-9"
            f" and least(a.n_shingles, b.n_shingles) * 100 >= greatest(a.n_shingles, b.n_shingles) * {percent}"
        )
        round_of(
            "rest",
            few.where("component <> core").alias("a").join(few.alias("b"), near)
            .select(F.expr("least(a.id, b.id)").alias("low"), F.expr("greatest(a.id, b.id)").alias("high")),
        )
        many = members.join(sizes.where(f"n * outer > {FEW_PAIRS}").select("bucket"), "bucket")
        # written before the next Python step: no task has two workers
        links_by_round.append(store.write("block-links", _linked_in_blocks(store, many, sets, percent)))
        comp = labelled("last-round")
    store.drop("sets")
    by_set = first.withColumnRenamed("representative", "id").join(comp, "id", "left").select(
        *same, F.col("id").alias("representative"), F.coalesce("component", "id").alias("component_id")
    )
    joined = sketches.join(by_set, same, "left")
    known = F.col("doc_id").isNotNull()
    own = F.when(known, F.coalesce("component_id", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"),
        F.when(known, F.coalesce("representative", "doc_id")).alias("representative"),
    )

