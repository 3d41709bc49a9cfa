"""Best detection per site, label and hour, what is left, and detection counts.

One (site, label, hour) may hold a large part of all rows. Nothing here brings a whole group into
one task: best rows come from aggregates that combine before the shuffle, and the rest is found by
an anti join on the row itself, which spreads evenly, instead of a rank within the group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linscore.functions.datetimes import hour_key
from linscore.operators.copies import repeat_rows

TIES = ("audio_recording_id", "start_offset_seconds", "end_offset_seconds")


def _group(df: DataFrame) -> list[Column]:
    return [F.col("site_name"), F.col("label"), hour_key(F.col("start_datetime")).alias("hour")]


def _sorted_group(df: DataFrame) -> list[Column]:
    """The group behind a hash of it: whole rows as aggregates make Spark sort, and numbers sort faster."""
    return [F.xxhash64(*_group(df)).alias("group_hash"), *_group(df)]


def _ranked(df: DataFrame, row_key: Sequence[str] | None, whole: bool) -> Column:
    """Struct whose smallest is the best row: highest score, then a fixed order over all columns."""
    ties = [c for c in TIES if c in df.columns]
    last = [c for c in (row_key or df.columns) if c not in ties]
    rest = [c for c in df.columns if c not in ties + last] if whole else []
    return F.struct((-F.col("score")).alias("neg_score"), *ties, *last, *rest)


def max_per_hour(df: DataFrame, row_key: Sequence[str] | None = None) -> DataFrame:
    """Row with the highest score of each (site_name, label, hour), and the group's ``count``.

    Ties go to the lowest recording id, start, end and then to the other columns in order.
    ``row_key`` names columns that are unique per row, if there are any.
    """
    best = df.groupBy(*_sorted_group(df)).agg(
        F.min(_ranked(df, row_key, whole=True)).alias("best"), F.count("*").alias("count")
    )
    return best.select(*[F.col("best")[c].alias(c) for c in df.columns], "count")


def non_max(df: DataFrame, row_key: Sequence[str] | None = None) -> DataFrame:
    """All rows but the one ``max_per_hour`` picks from each group.

    With a ``row_key`` this is one anti join on it. Without, rows are matched on all columns; exact
    copies of a best row then fall out with it and are put back, all but one.
    """
    key = list(row_key or df.columns)
    best = df.groupBy(*_sorted_group(df)).agg(F.min(_ranked(df, row_key, whole=False)).alias("best"))
    winners = best.select(*[F.col("best")[c].alias(f"best_{c}") for c in key])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"best_{c}")) for c in key])
    if row_key:
        return df.join(winners, same, "left_anti")
    # the hash goes first among the join keys, again for the sort
    same = (F.col("row_hash") == F.col("best_hash")) & same
    rows = df.withColumn("row_hash", F.xxhash64(*key))
    winners = winners.withColumn("best_hash", F.xxhash64(*[f"best_{c}" for c in key]))
    rest = rows.join(winners, same, "left_anti").drop("row_hash")
    copies = rows.join(winners, same, "left_semi").groupBy("row_hash", *df.columns).agg(F.count("*").alias("copies"))
    spare = copies.where("copies > 1").drop("row_hash").withColumn("copies", F.col("copies") - 1)
    return rest.unionByName(repeat_rows(spare, "copies"))


def top_rows(best: DataFrame, n: int = 1000, row_key: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` rows with the highest scores, of the rows ``max_per_hour`` gives; ties go by all other columns."""
    order = [c for c in (*TIES, *(row_key or ())) if c in best.columns]
    order += [c for c in best.columns if c not in order and c != "score"]
    return best.orderBy(F.desc("score"), *order).limit(n)


def top_max_per_hour(df: DataFrame, n: int = 1000, row_key: Sequence[str] | None = None) -> DataFrame:
    """The ``n`` best of the best rows."""
    return top_rows(max_per_hour(df, row_key), n, row_key)


def counts_by_label(df: DataFrame) -> DataFrame:
    """Detections per label."""
    return df.groupBy("label").agg(F.count("*").alias("n"))


def counts_by_site(df: DataFrame) -> DataFrame:
    """Detections per site and label."""
    return df.groupBy("site_name", "label").agg(F.count("*").alias("n"))


def counts_by_catalog_site(detections: DataFrame, catalog: DataFrame) -> DataFrame:
    """Detections per catalog site and label, for rows that know only their recording.

    Counting per recording comes first, so that a recording with very many detections enters the
    join as one row per label.
    """
    per_recording = detections.groupBy("audio_recording_id", "label").agg(F.count("*").alias("n"))
    sites = catalog.select(F.col("id").alias("audio_recording_id"), "site_name")
    return per_recording.join(sites, "audio_recording_id").groupBy("site_name", "label").agg(F.sum("n").alias("n"))


def counts_with_totals(df: DataFrame) -> DataFrame:
    """Both counts in one table: ``level`` is ``total`` (site_name null) or ``site``.

    The sets are formed over the counted groups, not over the rows.
    """
    sets = counts_by_site(df).groupingSets([["label"], ["site_name", "label"]], "site_name", "label")
    level = F.when(F.grouping("site_name") == 1, "total").otherwise("site")
    return sets.agg(F.sum("n").alias("n"), level.alias("level")).select("level", "site_name", "label", "n")


def run_totals(df: DataFrame) -> DataFrame:
    """One row: all rows, best rows, remaining rows, labels and sites."""
    groups = df.groupBy(*_group(df)).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("max_rows"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("*")).alias("non_max_rows"),
        F.countDistinct("label").alias("labels"),
        F.countDistinct("site_name").alias("sites"),
    )
