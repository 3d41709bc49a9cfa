"""Catalog recordings that have no results yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linscore.functions.datetimes import date_key
from linscore.session import checkpointed

SLICE_WIDTH = 10_000


def missing_recordings(catalog: DataFrame, completed: DataFrame) -> DataFrame:
    """Recordings of the catalog whose id is not among ``completed.audio_recording_id``."""
    done = completed.select(F.col("audio_recording_id").alias("id"))
    return catalog.join(done, "id", "left_anti").select(
        "site_name", "site_id", "id", date_key(F.col("recorded_date")).alias("date")
    )


def missing_totals(catalog: DataFrame, completed: DataFrame) -> DataFrame:
    """One row: missing recordings, catalog rows, and distinct completed ids (in the catalog or not)."""
    done = completed.select(F.col("audio_recording_id").alias("id")).where("id is not null").distinct()
    marked = catalog.select("id").join(done.withColumn("done", F.lit(1)), "id", "left")
    return marked.agg(
        (F.count("*") - F.count("done")).alias("missing_results_total"), F.count("*").alias("total_files")
    ).withColumn("completed_files", done.agg(F.count("*")).scalar())


def missing_summary_by_site(
    catalog: DataFrame, completed: DataFrame, slice_width: int = SLICE_WIDTH
) -> DataFrame:
    """Missing recordings: one row per site, date and slice of ids, sites with most missing first.

    A slice is a range of ``slice_width`` ids, which bounds every list at every size of the catalog.
    ``missing_count`` is the site's own. The lists are made once and kept; counts are summed over them.
    """
    missing = missing_recordings(catalog, completed)
    lists = checkpointed(
        missing.groupBy("site_name", "date", F.floor(F.col("id") / slice_width).alias("slice")).agg(
            F.min("site_id").alias("site_id"), F.sort_array(F.collect_list("id")).alias("missing_arids")
        )
    )
    sites = lists.groupBy("site_name").agg(
        F.min("site_id").alias("first_site_id"), F.sum(F.size("missing_arids")).alias("missing_count")
    ).withColumnRenamed("site_name", "of_site")
    return (
        lists.join(sites, F.col("site_name").eqNullSafe(F.col("of_site")))
        .select("site_name", F.col("first_site_id").alias("site_id"), "missing_count", "date", "slice", "missing_arids")
        .orderBy(F.desc("missing_count"), "site_name", "date", "slice")
    )
