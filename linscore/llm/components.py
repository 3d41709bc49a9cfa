"""Connected components of links between ids, without ever holding them in one place."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store


def forest(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over links: for each id but the smallest of its group, a link to that smallest id."""
    ids, places = np.unique(np.concatenate([low, high]), return_inverse=True)
    parent = list(range(len(ids)))
    half = len(low)
    for a, b in zip(places[:half].tolist(), places[half:].tolist()):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a != b:
            parent[max(a, b)] = min(a, b)
    roots = np.array(parent, np.int64)
    while not np.array_equal(up := roots[roots], roots):
        roots = up
    inner = roots != np.arange(len(ids))
    return ids[roots[inner]], ids[inner]


def _forests(batches):
    """Forests of some hundred thousand links at a time."""
    held: list[pa.RecordBatch] = []

    def flush():
        table = pa.Table.from_batches(held)
        low, high = forest(table["low"].to_numpy(), table["high"].to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["low", "high"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= 400_000:
            yield flush()
            held = []
    if held:
        yield flush()


def components(store: Store, name: str, links: DataFrame) -> DataFrame:
    """``id``, ``component`` (smallest id reachable) for every id in ``links`` (``low`` < ``high``, bigint).

    A pass makes a forest of each task's links by union-find, hangs every group's top under its smallest
    neighbour, follows those pointers to their ends and lays the links between what has been merged; only links between
    different groups go on. A star, however large, takes one pass: its links are summed per task before the shuffle.
    """
    spark = store.spark
    schema = "low bigint, high bigint"
    links = store.write(f"{name}-links-0", links.select("low", "high").mapInArrow(_forests, schema))
    labels: DataFrame | None = None
    step = 0
    while not links.isEmpty():
        # every id hangs under its smallest smaller neighbour: pointers only go down, so they cannot turn in circles
        hung = links.groupBy(F.col("high").alias("id")).agg(F.min("low").alias("top"))
        hung = store.write(f"{name}-hung-{step}", hung)
        jump = 0
        while True:
            above = hung.select(F.col("id").alias("top"), F.col("top").alias("higher"))
            hung_next = store.write(
                f"{name}-hung-{step}-{jump}",
                hung.join(above, "top", "left").select(
                    "id", F.coalesce("higher", "top").alias("top"), F.col("higher").isNotNull().alias("moved")
                ),
            )
            moved = not hung_next.where("moved").isEmpty()
            hung = hung_next.select("id", "top")
            jump += 1
            if not moved:
                break
        ends = hung.select(F.col("id").alias("high"), F.col("top").alias("high_top"))
        lows = hung.select(F.col("id").alias("low"), F.col("top").alias("low_top"))
        left = (
            links.join(ends, "high", "left")
            .join(lows, "low", "left")
            .select(F.coalesce("low_top", "low").alias("a"), F.coalesce("high_top", "high").alias("b"))
            .where("a <> b")
            .select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
            .distinct()
        )
        step += 1
        links = store.write(f"{name}-links-{step}", left.mapInArrow(_forests, schema))
        if labels is None:
            labels = hung
        else:
            # what was a top before may now hang under another one; new ids cannot appear
            up = hung.select(F.col("id").alias("top"), F.col("top").alias("higher"))
            labels = labels.join(up, "top", "left").select("id", F.coalesce("higher", "top").alias("top"))
            labels = labels.unionByName(hung.join(labels.select("id"), "id", "left_anti"))
        labels = store.write(f"{name}-labels-{step}", labels)
    if labels is None:
        return spark.createDataFrame([], "id bigint, component bigint")
    return labels.select("id", F.col("top").alias("component"))
