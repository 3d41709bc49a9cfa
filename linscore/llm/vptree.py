"""Nearest neighbours by inner product: vantage-point trees per shard.

Within a shard a further coordinate lifts all vectors to one length, so that the largest inner product is the smallest
distance. A tree splits vectors at the median distance to a vantage point and keeps, for each part, the range of these
distances. Queries go down a tree in blocks: each first into the part that holds it, and then into the other unless
the triangle inequality rules it out: unless the gap, times ``factor``, exceeds the distance to the k-th
best so far. ``factor`` 1 is exact search; a larger one prunes more.

Trees are built once, kept in a table, and meet every block of queries; each such pair gives the k best of a shard, and the k
best of all shards are ranked per query. Vectors are dealt over shards by a hash of a row's own key, so that no id or
vector makes a shard large.

Defined cases: rows without id, and vectors that are null, zero, hold null or non-finite components, take no part; vectors
of another length than the query's are no candidates; all rows with the query's id are its own; rows that repeat an id
are candidates each, repeated queries are answered each; extra columns are ignored. No queries, or an empty table, give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors
from .store import Store

SHARD_ROWS, BLOCK_ROWS, LEAF = 8192, 512, 128
MOST_TASKS = 100_000


class Tree:
    """Nodes in flat arrays: vantage point, children (-1: leaf), ranges of distances, and the rows of leaves."""

    FIELDS = (
        ("ids", np.int64), ("rows", np.float64), ("points", np.float64), ("left", np.int64), ("right", np.int64),
        ("ranges", np.float64), ("first", np.int64), ("last", np.int64),
    )

    @classmethod
    def built(cls, ids: np.ndarray, rows: np.ndarray) -> Tree:
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], rows[order]
        squares = (rows * rows).sum(axis=1)
        lifted = np.concatenate([rows, np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0.0))[:, None]], axis=1)
        rng = np.random.default_rng(len(rows))
        nodes: dict[str, list] = {n: [] for n in ("points", "left", "right", "ranges", "first", "last")}
        sequence: list[np.ndarray] = []
        placed = 0

        def add(members: np.ndarray) -> int:
            nonlocal placed
            node = len(nodes["left"])
            for n, value in (("points", None), ("left", -1), ("right", -1), ("ranges", (0.0, 0.0, 0.0, 0.0)), ("first", placed), ("last", placed)):
                nodes[n].append(value)
            nodes["points"][node] = np.zeros(lifted.shape[1])
            if len(members) > LEAF:
                point = lifted[members[rng.integers(len(members))]]
                distance = np.sqrt(((lifted[members] - point) ** 2).sum(axis=1))
                near = distance <= np.median(distance)
                if not near.all():
                    nodes["points"][node] = point
                    inner, outer = distance[near], distance[~near]
                    nodes["ranges"][node] = (inner.min(), inner.max(), outer.min(), outer.max())
                    nodes["left"][node] = add(members[near])
                    nodes["right"][node] = add(members[~near])
                    return node
            # equal distances cannot be split: a leaf, searched in parts
            sequence.append(members)
            placed += len(members)
            nodes["last"][node] = placed
            return node

        add(np.arange(len(rows)))
        tree = cls()
        kept = np.concatenate(sequence) if sequence else np.arange(0)
        tree.ids, tree.rows = ids[kept], rows[kept]
        tree.points, tree.ranges = np.array(nodes["points"]), np.array(nodes["ranges"])
        tree.left, tree.right, tree.first, tree.last = (np.array(nodes[n]) for n in ("left", "right", "first", "last"))
        tree.square = float(squares.max(initial=0.0))
        return tree

    def packed(self) -> dict[str, bytes | float]:
        return {n: getattr(self, n).tobytes() for n, _ in self.FIELDS} | {"square": self.square}

    @classmethod
    def unpacked(cls, values: dict, size: int) -> Tree:
        tree = cls()
        for name, kind in cls.FIELDS:
            setattr(tree, name, np.frombuffer(values[name], kind))
        tree.rows = tree.rows.reshape(-1, size)
        tree.points = tree.points.reshape(-1, size + 1)
        tree.ranges = tree.ranges.reshape(-1, 4)
        tree.square = values["square"]
        return tree

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k best per query, best first, ties to smaller ids; -inf where there are fewer."""
        n = len(queries)
        scores, ids = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        squares = (queries * queries).sum(axis=1)
        lifted = np.concatenate([queries, np.zeros((n, 1))], axis=1)
        slack = 1e-9 * np.sqrt(squares * self.square) + 1e-300

        def reach(q: np.ndarray) -> np.ndarray:
            with np.errstate(invalid="ignore"):
                return np.sqrt(np.maximum(squares[q] + self.square - 2 * (scores[q, -1] - slack[q]), 0.0))

        def leaf(first: int, last: int, q: np.ndarray) -> None:
            about = queries[q] @ self.rows[first:last].T
            about[self.ids[first:last][None, :] == own[q][:, None]] = -np.inf
            better = (about >= (scores[q, -1] - slack[q])[:, None]) & (about > -np.inf)
            some = np.flatnonzero(better.any(axis=1))
            if not len(some):
                return
            x, y = np.nonzero(better[some])
            exact = np.full((len(some), last - first), -np.inf)
            exact[x, y] = (queries[q[some]][x] * self.rows[first:last][y]).sum(axis=1)
            q = q[some]
            all_scores = np.concatenate([scores[q], exact], axis=1)
            all_ids = np.concatenate([ids[q], np.broadcast_to(self.ids[first:last], exact.shape)], axis=1)
            best = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            scores[q], ids[q] = np.take_along_axis(all_scores, best, 1), np.take_along_axis(all_ids, best, 1)

        def visit(node: int, q: np.ndarray) -> None:
            if not len(q):
                return
            if self.left[node] < 0:
                for first in range(self.first[node], self.last[node], 4 * LEAF):
                    leaf(first, min(first + 4 * LEAF, int(self.last[node])), q)
                return
            distance = np.sqrt(((lifted[q] - self.points[node]) ** 2).sum(axis=1))
            a, b, c, d = self.ranges[node]
            inner = distance <= (b + c) / 2
            visit(int(self.left[node]), q[inner])
            visit(int(self.right[node]), q[~inner])
            gap = np.maximum(np.maximum(c - distance, distance - d), 0.0)[inner]
            visit(int(self.right[node]), q[inner][gap * factor <= reach(q[inner])])
            gap = np.maximum(np.maximum(a - distance, distance - b), 0.0)[~inner]
            visit(int(self.left[node]), q[~inner][gap * factor <= reach(q[~inner])])

        visit(0, np.arange(n))
        return scores, ids


def _keyed(batches):
    """Rows with a key of their own: task and place in it."""
    key = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(key, key + batch.num_rows)), *batch.columns], ["key", *batch.schema.names]
        )
        key += batch.num_rows


def _rows(table: pa.Table) -> np.ndarray:
    return table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _tree(table: pa.Table) -> pa.Table:
    tree = Tree.built(table["vec_id"].to_numpy(), _rows(table))
    return pa.table(
        {"size": pa.array([table["size"][0].as_py()], pa.int32()), "shard": pa.array([table["shard"][0].as_py()], pa.int64())}
        | {n: pa.array([v], pa.float64() if n == "square" else pa.binary()) for n, v in tree.packed().items()}
    )


def _block(table: pa.Table) -> pa.Table:
    return pa.table(
        {
            "size": pa.array([table["size"][0].as_py()], pa.int32()),
            "block": pa.array([table["block"][0].as_py()], pa.int64()),
            "query_keys": pa.array([table["key"].to_numpy().tobytes()], pa.binary()),
            "query_ids": pa.array([table["vec_id"].to_numpy().tobytes()], pa.binary()),
            "query_rows": pa.array([_rows(table).tobytes()], pa.binary()),
        }
    )


def _searched(k: int, factor: float):
    def run(batches):
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for row in range(batch.num_rows):
                value = {n: c[row].as_py() for n, c in columns.items()}
                tree = Tree.unpacked(value, value["size"])
                keys, own = np.frombuffer(value["query_keys"], np.int64), np.frombuffer(value["query_ids"], np.int64)
                scores, ids = tree.search(own, np.frombuffer(value["query_rows"]).reshape(len(own), -1), k, factor)
                found = scores > -np.inf
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(keys, found.sum(axis=1))), pa.array(np.repeat(own, found.sum(axis=1))),
                        pa.array(ids[found]), pa.array(scores[found]),
                    ],
                    ["key", "query_id", "vec_id", "score"],
                )

    return run


def nearest(embeddings: DataFrame, is_query, k: int = 20, factor: float = 1.5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of every row for which ``is_query`` (a condition on vec_id) holds."""
    spark = embeddings.sparkSession
    store = Store(spark, "vantage-points")
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(F.col("vec_id").isNotNull() & vectors.usable(F.col("embedding")))
    rows = store.write("rows", rows.mapInArrow(_keyed, "key bigint, vec_id bigint, embedding array<double>"))
    rows = rows.withColumn("size", F.size("embedding"))
    queries = rows.where(is_query)
    shards, blocks = -(-rows.count() // SHARD_ROWS), -(-queries.count() // BLOCK_ROWS)
    if not blocks:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    fields = ", ".join(f"{n} binary" for n, _ in Tree.FIELDS)
    trees = store.write(
        "trees",
        rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("bigint"))
        .groupBy("size", "shard").applyInArrow(_tree, f"size int, shard bigint, {fields}, square double"),
    )
    packed = store.write(
        "queries",
        queries.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("bigint"))
        .groupBy("size", "block").applyInArrow(_block, "size int, block bigint, query_keys binary, query_ids binary, query_rows binary"),
    )
    # every block of queries to every shard: the stated query set against all rows. Where shards are fewer than cores, a shard's tree
    # goes to several tasks, each with a part of the blocks; both sides are dealt once, by the join's own key
    parts = min(blocks, max(1, -(-2 * spark.sparkContext.defaultParallelism // shards)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    asked = packed.withColumn("shard", every(shards)).withColumn("part", F.pmod("block", F.lit(parts)).cast("bigint"))
    found = store.write(
        "found",
        asked.repartition(min(2 * shards * parts, MOST_TASKS), "size", "shard", "part")
        .join(trees.withColumn("part", every(parts)), ["size", "shard", "part"])
        .mapInArrow(_searched(k, factor), "key bigint, query_id bigint, vec_id bigint, score double"),
    )
    return found.selectExpr(
        "query_id", "cast(row_number() over (partition by key order by score desc, vec_id) as int) as rank", "vec_id", "score"
    ).where(F.col("rank") <= k)
