"""Names made safe for use as path parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitise_name(name: Column) -> Column:
    """Classifier name as a path part: blanks become ``_``, all but ``[A-Za-z0-9_-]`` goes."""
    return F.regexp_replace(F.regexp_replace(name, r"\s+", "_"), r"[^A-Za-z0-9_-]", "")


def safe_name(name: Column, ident: Column) -> Column:
    """Lower-cased, underscored name with its id appended, as in ``north_creek_12``."""
    underscored = F.replace(F.lower(name), F.lit(" "), F.lit("_"))
    trimmed = F.regexp_replace(underscored, r"^\s+|\s+$", "")
    return F.concat(trimmed, F.lit("_"), ident.cast("string"))


def path_stem(path: Column) -> Column:
    """File name of a path without its last suffix; a leading dot is part of the name."""
    leaf = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_replace(leaf, r"^(.+)\.[^.]+$", "$1")
