"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with a cosine of at least ``least`` lie within eps = sqrt(2 - 2 least). They are turned to their leading
principal axes (fitted on a bounded sample), laid on a grid of width eps and sorted by cell. Runs of the sorted
sequence become blocks with bounding boxes; runs of blocks become intervals, and so on up. The join starts at each label's
whole sequence and goes down: a pair of intervals is split into pairs of their parts, and pairs whose boxes lie
further apart than eps are dropped, with all vectors in them. Only pairs of blocks that remain meet as vectors, in
one matrix product each. A turn keeps distances, and a box over some axes only underestimates them: no link is lost.

Equal vectors are one vertex with a count, so a vector of a third of all rows costs one. A pair of blocks gives each
vertex's number of links and a forest, never pairs of vectors.

Defined cases: vectors that are null, zero or hold null or non-finite components, rows without label or id, link with
nothing (``n_links`` 0, own component); vectors of different lengths do not link; rows that repeat an id share its
component; rows that repeat both count as each other's links; extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors
from .components import components, forest
from .store import Store

AXES, BLOCK, FAN, SAMPLE = 8, 512, 8, 8192


def principal_axes(sample: np.ndarray, count: int) -> np.ndarray:
    """Columns: the directions in which unit vectors vary most; zeros where there are fewer than ``count``."""
    centred = sample - sample.mean(axis=0)
    _, directions = np.linalg.eigh(centred.T @ centred)
    leading = directions[:, ::-1][:, :count]
    return np.pad(leading, ((0, 0), (0, count - leading.shape[1])))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _cells(axes: dict[int, np.ndarray], eps: float):
    """Grid cell of each vector, as one column that sorts like its coordinates."""

    def run(batches):
        for batch in batches:
            cells: list = [None] * batch.num_rows
            for rows, values in vectors.matrices(batch.column(3)):
                turned = np.floor(_unit(values) @ axes[values.shape[1]] / eps).astype(int)
                for row, cell in zip(rows.tolist(), turned.tolist()):
                    cells[row] = cell
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int32()))], [*batch.schema.names, "cell"]
            )

    return run


def _blocks(axes: dict[int, np.ndarray]):
    """Runs of the sorted rows, up to BLOCK each and one label and length in each, with their boxes."""

    def run(batches):
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        held: dict[str, list] = {}
        number = 0

        def flush():
            nonlocal number
            raw = np.stack(held["embedding"])
            turned = _unit(raw) @ axes[raw.shape[1]]
            number += 1
            return pa.RecordBatch.from_pydict(
                {
                    "block": [task << 32 | number], "label": [held["label"][0]], "size": [raw.shape[1]],
                    "low": [turned.min(axis=0).tolist()], "high": [turned.max(axis=0).tolist()],
                    "ids": [np.array(held["id"], np.int64).tobytes()], "keys": [np.array(held["key"], np.int64).tobytes()],
                    "counts": [np.array(held["n"], np.int64).tobytes()], "rows": [raw.astype(np.float64).tobytes()],
                },
                BLOCK_SCHEMA,
            )

        for batch in batches:
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            for label, key, id_, n, vector in zip(*(columns[c] for c in ("label", "key", "id", "n", "embedding"))):
                if held and (len(held["id"]) == BLOCK or held["label"][0] != label or len(held["embedding"][0]) != len(vector)):
                    yield flush()
                    held = {}
                for name, value in (("label", label), ("key", key), ("id", id_), ("n", n), ("embedding", np.array(vector))):
                    held.setdefault(name, []).append(value)
        if held:
            yield flush()

    return run


BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64()), ("label", pa.int64()), ("size", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]
    + [(n, pa.binary()) for n in ("ids", "keys", "counts", "rows")]
)
BLOCK_SQL = (
    "block bigint, label bigint, size int, low array<double>, high array<double>, ids binary, keys binary, counts binary, rows binary"
)


def _joined(least: float):
    """Links in pairs of blocks: ``key, links`` sums, and forest rows ``low, high``."""

    def run(batches):
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for k in range(batch.num_rows):
                size = columns["size"][k].as_py()
                side = {}
                for s in "ab":
                    side[s] = {n: np.frombuffer(columns[f"{n}_{s}"][k].as_py(), np.int64) for n in ("ids", "keys", "counts")}
                    side[s]["rows"] = _unit(np.frombuffer(columns[f"rows_{s}"][k].as_py()).reshape(-1, size))
                a, b = side["a"], side["b"]
                same = columns["a"][k].as_py() == columns["b"][k].as_py()
                link = a["rows"] @ b["rows"].T >= least
                if same:
                    np.fill_diagonal(link, False)
                keys, links = [a["keys"]], [link @ b["counts"]]
                if not same:
                    keys.append(b["keys"])
                    links.append(link.T @ a["counts"])
                keys, links = np.concatenate(keys), np.concatenate(links)
                held = links > 0
                x, y = np.nonzero(link)
                low, high = np.minimum(a["ids"][x], b["ids"][y]), np.maximum(a["ids"][x], b["ids"][y])
                apart = low != high
                low, high = forest(low[apart], high[apart])
                none = [None] * len(low)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array([*keys[held].tolist(), *none], pa.int64()),
                        "links": pa.array([*links[held].tolist(), *none], pa.int64()),
                        "low": pa.array([None] * int(held.sum()) + low.tolist(), pa.int64()),
                        "high": pa.array([None] * int(held.sum()) + high.tolist(), pa.int64()),
                    }
                )

    return run


def near_vectors(embeddings: DataFrame, least: float = 0.98) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``; links join equal labels at a cosine of ``least`` or more."""
    spark = embeddings.sparkSession
    store = Store(spark, "near-vectors")
    eps = float(np.sqrt(2 - 2 * least)) * (1 + 1e-9) + 1e-9
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vectors.usable(F.col("embedding"))
    rows = rows.withColumn("key", F.when(part, F.xxhash64("label", "embedding")))
    good = rows.where("key is not null")
    vertices = store.write(
        "vertices",
        good.groupBy("label", "key", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")),
    )
    axes: dict[int, np.ndarray] = {}
    for (size,) in vertices.select(F.size("embedding")).distinct().collect():  # lengths of vectors: a handful
        sample = vertices.where(F.size("embedding") == size).orderBy(F.xxhash64("key", F.lit(1))).limit(SAMPLE)
        axes[size] = principal_axes(_unit(np.array([r["embedding"] for r in sample.select("embedding").collect()])), AXES)
    cells = vertices.select("label", "key", "id", "embedding", "n").mapInArrow(
        _cells(axes, eps), "label bigint, key bigint, id bigint, embedding array<double>, n bigint, cell array<int>"
    )
    order = [F.col("label"), F.size("embedding"), *[F.col("cell")[i] for i in range(AXES)], F.col("key")]
    blocks = store.write(
        "blocks",
        cells.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("label", "key", "id", "n", "embedding").mapInArrow(_blocks(axes), BLOCK_SQL),
    )
    # intervals of intervals: each level has the boxes of FAN runs of the one below
    boxes = blocks.select("block", "label", "size", "low", "high").selectExpr(
        "label", "size", "block", "cast(row_number() over (partition by label, size order by block) - 1 as bigint) as node",
        *[f"low[{i}] as low_{i}" for i in range(AXES)], *[f"high[{i}] as high_{i}" for i in range(AXES)],
    )
    levels = [store.write("level-0", boxes)]
    bounds = [f(f"{s}_{i}").alias(f"{s}_{i}") for i in range(AXES) for s, f in (("low", F.min), ("high", F.max))]
    while levels[-1].agg(F.max("node")).first()[0] or 0:
        above = levels[-1].withColumn("node", F.floor(F.col("node") / FAN)).groupBy("label", "size", "node").agg(*bounds)
        levels.append(store.write(f"level-{len(levels)}", above))
    apart = " + ".join(
        f"pow(greatest(0D, a.low_{i} - b.high_{i}, b.low_{i} - a.high_{i}), 2)" for i in range(AXES)
    )
    pairs = levels[-1].selectExpr("label", "size", "node as a", "node as b")
    for level in reversed(levels):
        if level is not levels[-1]:
            child = level.withColumn("up", F.floor(F.col("node") / FAN))
            a = pairs.alias("p").join(child.alias("a"), F.expr("p.label = a.label and p.size = a.size and p.a = a.up"))
            both = a.join(
                child.alias("b"),
                F.expr(f"p.label = b.label and p.size = b.size and p.b = b.up and a.node <= b.node and {apart} <= {eps * eps}"),
            )
            pairs = both.selectExpr("p.label as label", "p.size as size", "a.node as a", "b.node as b")
            pairs = store.write(f"pairs-{levels.index(level)}", pairs)
    named = levels[0].select("label", "size", "node", "block")
    pairs = pairs.join(named.withColumnsRenamed({"node": "a", "block": "block_a"}), ["label", "size", "a"]).join(
        named.withColumnsRenamed({"node": "b", "block": "block_b"}), ["label", "size", "b"]
    ).select(F.col("block_a").alias("a"), F.col("block_b").alias("b"), "size")

    def side(s: str) -> DataFrame:
        return blocks.select(F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "keys", "counts", "rows")])

    found = store.write(
        "found",
        pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_joined(least), "key bigint, links bigint, low bigint, high bigint"),
    )
    several = good.groupBy("vec_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("vec_id")
    ties = good.select("vec_id", "key").join(several, "vec_id", "left_semi").join(vertices.select("key", "id"), "key").where(
        "id < vec_id"
    ).selectExpr("id as low", "vec_id as high")
    comp = components(store, "groups", found.where("low is not null").select("low", "high").unionByName(ties))
    links = found.where("key is not null").groupBy("key").agg(F.sum("links").alias("links"))
    known = vertices.select("key", "id", "n").join(links, "key", "left").join(comp, "id", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")
    )
    own = F.coalesce("component", "vec_id")
    return rows.select("vec_id", "key").join(known, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), own.alias("component_id"),
        F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
