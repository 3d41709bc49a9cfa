"""From a recordings catalog to the manifest of a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from linscore.operators.enrich import filter_catalog, unique_catalog
from linscore.operators.manifest import build_manifest, collisions
from linscore.sources.sinks import write_manifest
from linscore.sources.tables import manifest_inputs, read_catalog, read_manifest


def make_manifest(
    spark: SparkSession,
    catalog_path: str,
    output_path: str,
    base_url: str,
    job_id: int,
    analysis_name: str,
    *,
    conditions: Mapping[str, Mapping[str, Any]] | None = None,
    params: str | Mapping[str, Sequence[str] | str] | None = None,
    limit: int | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Writes the manifest of the catalog recordings that meet ``conditions`` and reads it back.

    ``params`` are merged into the query of each source, ``limit`` takes the lowest ids. Recordings listed twice count once; two that would
    write to one output are an error. The file is in line form, a bounded number of sources per line, so that ``classify`` reads it in tasks.
    """
    catalog = unique_catalog(read_catalog(spark, catalog_path, multiline))
    rows = build_manifest(filter_catalog(catalog, conditions or {}), base_url, job_id, analysis_name, limit)
    rows = manifest_inputs(rows, params)
    doubled = collisions(rows, "output").limit(5).collect()
    if doubled:
        raise ValueError(f"outputs named more than once: {', '.join(sorted(r['output'] for r in doubled))}")
    write_manifest(rows, output_path)
    return read_manifest(spark, output_path, multiline=False)
