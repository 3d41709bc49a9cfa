"""Manifests built from a recordings catalog, and checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linscore.functions.names import safe_name


def build_manifest(
    catalog: DataFrame, base_url: str, job_id: int, analysis_name: str, limit: int | None = None
) -> DataFrame:
    """(source, output) of each catalog recording: where its embeddings are, where detections go.

    Outputs lie in a folder per site, inside a folder per region where there is one. ``limit`` takes
    the lowest ids.
    """
    if limit is not None and limit > 0:
        catalog = catalog.orderBy("id").limit(limit)
    ident = F.col("id").cast("string")
    source = F.concat(
        F.lit(f"{base_url}/analysis_jobs/{job_id}/results/"), ident, F.lit(f"/{analysis_name}/embeddings.parquet")
    )
    site = safe_name(F.col("site_name"), F.col("site_id"))
    region = safe_name(F.col("region_name"), F.col("region_id"))
    has_region = F.coalesce(F.col("region_name") != "", F.lit(False))
    output = F.concat_ws("/", F.when(has_region, region), site, F.concat(ident, F.lit(".csv")))
    return catalog.select(source.alias("source"), output.alias("output"))


def collisions(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, such as output paths several sources would write to."""
    return df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
