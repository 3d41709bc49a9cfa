"""Detections joined to the recordings catalog, with labels filtered and mapped."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linscore.functions.datetimes import read_date, shifted, wall_clock
from linscore.functions.links import listen_link
from linscore.functions.scores import is_text, to_number

WINDOW_SECONDS = 5

# The columns of enriched and of compact detections
ENRICHED = (
    "audio_recording_id",
    "site_name",
    "site_id",
    "region_name",
    "region_id",
    "end_offset_seconds",
    "start_offset_seconds",
    "label",
    "score",
    "start_datetime",
    "listen_link",
)
# Dotted catalog fields and the columns they become
CATALOG_NAMES = {"sites.name": "site_name", "regions.id": "region_id", "regions.name": "region_name"}
COMPACT = ("audio_recording_id", "site_id", "label", "start_offset_seconds", "end_offset_seconds", "score")


def exclude_labels(df: DataFrame, labels: Iterable[str] | None) -> DataFrame:
    """Rows whose label is not listed; a null label stays."""
    labels = list(labels or ())
    return df.where(F.col("label").isNull() | ~F.col("label").isin(labels)) if labels else df


def include_labels(df: DataFrame, labels: Iterable[str] | None) -> DataFrame:
    """Rows whose label is listed; None means all."""
    return df if labels is None else df.where(F.col("label").isin(list(labels)))


def mapped_label(label: Column, mapping: Mapping[str, str] | None) -> Column:
    """Label under its new name, or as it is."""
    if not mapping:
        return label
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, label), label)


def compact(df: DataFrame, with_site: bool = True) -> DataFrame:
    """The few columns that identify and rank a detection."""
    return df.select(*[c for c in COMPACT if with_site or c != "site_id"])


def filter_catalog(catalog: DataFrame, conditions: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Catalog rows that meet all of ``{"field": {"eq": v}}`` and ``{"field": {"in": [...]}}``.

    Fields may go by their dotted names, as in a filter sent to a catalog service.
    """
    for field, tests in conditions.items():
        name = field if field in catalog.columns else CATALOG_NAMES.get(field, field)
        column = F.col(f"`{name}`")
        for test, value in tests.items():
            if test == "eq":
                catalog = catalog.where(column == F.lit(value))
            elif test == "in":
                catalog = catalog.where(column.isin(list(value)))
            else:
                raise ValueError(f"unknown catalog condition {test!r}")
    return catalog


def unique_catalog(catalog: DataFrame) -> DataFrame:
    """One row per recording id; of several the one latest in (recorded_date, other columns)."""
    others = [c for c in catalog.columns if c not in ("id", "recorded_date")]
    order = F.struct("recorded_date", *sorted(others))
    best = catalog.groupBy("id").agg(F.max(order).alias("best"))
    return best.select("id", *[F.col("best")[c].alias(c) for c in catalog.columns if c != "id"])


def whole_seconds(df: DataFrame) -> Column:
    """Offset as whole seconds; null where it is no whole number."""
    number = to_number(F.col("offset"), is_text(df, "offset"))
    return F.when(number == F.floor(number), number.try_cast("int"))


def _score(df: DataFrame) -> Column:
    return to_number(F.col("score"), is_text(df, "score"))


def rejected_detections(detections: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """Detections that cannot be enriched: offset or score, or the recording's date, cannot be read."""
    unread = whole_seconds(detections).isNull() | _score(detections).isNull()
    if catalog is None:
        return detections.where(unread)
    undated = catalog.where(wall_clock(F.col("recorded_date")).isNull()).select(
        F.col("id").alias("audio_recording_id"), F.lit(True).alias("undated")
    )
    return detections.join(undated, "audio_recording_id", "left").where(unread | F.col("undated")).select(detections.columns)


def enrich(
    detections: DataFrame,
    catalog: DataFrame,
    *,
    host: str,
    site_hosts: Mapping[str, str] | None = None,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    label_map: Mapping[str, str] | None = None,
    window_seconds: int = WINDOW_SECONDS,
) -> DataFrame:
    """Detections with site, region, time and link of their recording.

    ``detections`` has audio_recording_id, label, score and offset; ``catalog`` has one row per id
    with site_id, site_name, region_id, region_name and recorded_date. Label filters look at the
    label as scored, the map is applied after them. A detection of an unknown recording, or of one
    without a readable date, is left out (``rejected_detections`` has the latter). The join carries no hint: Spark broadcasts the catalog only if its size allows, and
    otherwise splits a recording with very many detections over several tasks.
    """
    wanted = exclude_labels(include_labels(detections, include), exclude)
    rows = wanted.select(
        "audio_recording_id",
        whole_seconds(wanted).alias("start_offset_seconds"),
        mapped_label(F.col("label"), label_map).alias("label"),
        _score(wanted).alias("score"),
    ).where("start_offset_seconds is not null and score is not null")
    # a generator gives no row where the date cannot be read: unlike a condition, it is not copied to other places of the plan
    dated = F.filter(F.array(read_date(F.col("recorded_date"))), lambda date: date["wall"].isNotNull())
    known = catalog.select(
        F.col("id").alias("audio_recording_id"),
        "site_name",
        "site_id",
        F.nullif(F.col("region_name"), F.lit("")).alias("region_name"),
        F.nullif(F.col("region_id"), F.lit(0)).alias("region_id"),
        F.inline(dated),
    )
    end = F.col("start_offset_seconds") + F.lit(window_seconds)
    joined = rows.join(known, "audio_recording_id")
    return joined.select(
        "audio_recording_id",
        "site_name",
        "site_id",
        "region_name",
        "region_id",
        end.alias("end_offset_seconds"),
        "start_offset_seconds",
        "label",
        "score",
        shifted(F.col("wall"), F.col("zone"), F.col("start_offset_seconds")).alias("start_datetime"),
        listen_link(host, F.col("audio_recording_id"), F.col("start_offset_seconds"), end, site_hosts).alias(
            "listen_link"
        ),
    )
