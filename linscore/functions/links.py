"""Recording links and recording file names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, here and in the links below: the pattern of a recording's file name,
# <stamp>_<site name>_<recording id>.<ext>, and the shapes of the links
RECORDING_NAME = r"^\d{8}T\d{6}(?:Z|[+-]\d{4})_(.+?)_(\d+)\.\w+$"


def listen_link(
    host: str, recording_id: Column, start: Column, end: Column, site_hosts: Mapping[str, str] | None = None
) -> Column:
    """Link that plays one segment; ``site_hosts`` maps a data host to the host people visit."""
    site = (site_hosts or {}).get(host, host)
    return F.concat(
        F.lit(f"{site}/listen/"),
        recording_id.cast("string"),
        F.lit("/?start="),
        start.cast("string"),
        F.lit("&end="),
        end.cast("string"),
    )


def recording_site_name(source: Column) -> Column:
    """Site name inside a recording's file name, null where the name has another form."""
    return F.when(source.rlike(RECORDING_NAME), F.regexp_extract(source, RECORDING_NAME, 1))


def recording_id_of(source: Column) -> Column:
    """Recording id inside a recording's file name, null where the name has another form."""
    return F.when(
        source.rlike(RECORDING_NAME), F.regexp_extract(source, RECORDING_NAME, 2).try_cast("bigint")
    )


def original_link(source: Column, host: str | None) -> Column:
    """Link to the original recording; a name of another form (or no host) passes through."""
    if not host:
        return source
    link = F.concat(
        F.lit(f"{host}/audio_recordings/"), recording_id_of(source).cast("string"), F.lit("/original")
    )
    return F.coalesce(link, source)
