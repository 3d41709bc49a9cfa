"""Post-processing of scored recordings: one enriched table and the reports made from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linscore.functions.labels import parse_label_map, parse_labels
from linscore.operators.enrich import compact, enrich, rejected_detections, unique_catalog
from linscore.operators.missing import missing_summary_by_site, missing_totals
from linscore.operators.rollup import counts_with_totals, max_per_hour, non_max, run_totals, top_rows
from linscore.sources.files import list_files
from linscore.plans.classify import recordings_of_runs
from linscore.sources.sinks import write_json_lines, write_split, write_table
from linscore.sources.tables import completed_recordings, read_catalog, read_detections


def postprocess(
    spark: SparkSession,
    catalog_path: str,
    results: str | DataFrame,
    output_path: str,
    *,
    host: str,
    site_hosts: Mapping[str, str] | None = None,
    include: str | Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    label_map: str | Mapping[str, str] | None = None,
    limit_catalog: int | None = None,
    limit_results: int | None = None,
    top: int = 1000,
    split_by: str | None = None,
    output_format: str = "csv",
) -> dict[str, DataFrame]:
    """Consolidate per-recording detections and write all reports below ``output_path``.

    Tables that others come from (enriched detections, best rows, remaining rows) are made once, kept
    as Parquet under ``work`` and read back. ``results`` is a folder of one CSV per recording, the output of
    ``classify`` (a recording's id is the stem of the output its report names), or a table with
    audio_recording_id, offset, label and score. With ``split_by`` (``site_id``) tables are written one folder per
    value. Returns the tables written.
    """
    include = parse_labels(include) if isinstance(include, str) else include
    label_map = parse_label_map(label_map) if isinstance(label_map, str) else label_map

    catalog = unique_catalog(read_catalog(spark, catalog_path))
    if limit_catalog:
        catalog = catalog.orderBy("id").limit(limit_catalog)
    if isinstance(results, DataFrame):
        detections = results
        completed = results.select("audio_recording_id").where("audio_recording_id is not null").distinct()
    elif (found := recordings_of_runs(spark, results)) is not None:
        detections, completed = found
    else:
        completed = completed_recordings(list_files(spark, results, "*.csv"))
        detections = read_detections(spark, results)
    if limit_results:
        completed = completed.orderBy("audio_recording_id").limit(limit_results)
        detections = detections.join(completed, "audio_recording_id", "left_semi")

    enriched = enrich(
        detections,
        catalog,
        host=host,
        site_hosts=site_hosts,
        include=include,
        exclude=exclude,
        label_map=label_map,
    )

    def kept(table: DataFrame, name: str) -> DataFrame:
        write_table(table, f"{output_path}/work/{name}", "parquet")
        return spark.read.parquet(f"{output_path}/work/{name}")

    enriched = kept(enriched, "enriched")
    # where a row lies in the kept files tells it apart from its copies
    key = ["row_file", "row_index"]
    keyed = enriched.select("*", F.col("_metadata.file_path").alias(key[0]), F.col("_metadata.row_index").alias(key[1]))
    best = kept(max_per_hour(keyed, key).drop(*key), "max_per_hour")
    rest = kept(non_max(keyed, key).drop(*key), "non_max")
    totals = run_totals(enriched)
    tables = {}
    for name, table in (("detections", enriched), ("max_per_hour", best), ("non_max", rest)):
        tables[name], tables[f"{name}_compact"] = table, compact(table)
        for each in (name, f"{name}_compact"):
            write_split(tables[each], f"{output_path}/{each}", split_by, output_format)

    tables["max_per_hour_top"] = top_rows(best, top)
    tables["detection_counts"] = counts_with_totals(enriched)
    tables["totals"] = totals
    tables["rejected"] = rejected_detections(detections, catalog)
    for name in ("max_per_hour_top", "detection_counts", "totals", "rejected"):
        write_table(tables[name], f"{output_path}/{name}", output_format)

    tables["missing_totals"] = missing_totals(catalog, completed)
    tables["missing_by_site"] = missing_summary_by_site(catalog, completed)
    tables["summary"] = combined_summary(tables["missing_totals"], tables["missing_by_site"], tables["detection_counts"])
    write_json_lines(tables["summary"], f"{output_path}/summary")
    write_json_lines(tables["missing_totals"], f"{output_path}/missing_totals")
    write_json_lines(tables["missing_by_site"], f"{output_path}/missing_by_site")
    return tables


def counts_as_maps(counts: DataFrame) -> DataFrame:
    """Detection counts in nested form, one row per site (null: the total) with a label -> n map."""
    pairs = F.array_sort(F.collect_list(F.struct("label", "n")))
    return counts.where("label is not null").groupBy("level", "site_name").agg(
        F.map_from_entries(pairs).alias("counts")
    )


def combined_summary(totals: DataFrame, missing_by_site: DataFrame, counts: DataFrame) -> DataFrame:
    """What is missing beside what was found: a row for the whole catalog, then one per site with missing recordings or detections.

    ``counts`` maps labels to detections; ``missing_dates`` has the days of a site's missing recordings.
    """
    nested = counts_as_maps(counts)
    sites = missing_by_site.groupBy("site_name").agg(
        F.min("site_id").alias("site_id"), F.min("missing_count").cast("bigint").alias("missing"),
        F.sort_array(F.collect_set("date")).alias("missing_dates"),
    )
    found = nested.where("level = 'site'").select(F.col("site_name").alias("of_site"), "counts")
    no_file_counts = [F.lit(None).cast("bigint").alias(c) for c in ("total_files", "completed_files")]
    per_site = sites.join(found, F.col("site_name").eqNullSafe(F.col("of_site")), "full").select(
        F.lit("site").alias("level"), F.coalesce("site_name", "of_site").alias("site_name"), "site_id",
        F.coalesce("missing", F.lit(0).cast("bigint")).alias("missing"), *no_file_counts, "missing_dates", "counts",
    )
    # a single row of each kind, brought into one
    files = totals.select(F.lit("total").alias("level"), F.col("missing_results_total").alias("missing"), "total_files", "completed_files")
    both = files.unionByName(nested.where("level = 'total'").select("level", "counts"), allowMissingColumns=True)
    whole = both.groupBy("level").agg(
        F.lit(None).cast("string").alias("site_name"), F.lit(None).cast("bigint").alias("site_id"),
        *[F.max(c).alias(c) for c in ("missing", "total_files", "completed_files")],
        F.lit(None).cast("array<string>").alias("missing_dates"), F.any_value("counts", True).alias("counts"),
    )
    return whole.unionByName(per_site)
