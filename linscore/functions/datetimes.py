"""Segment times, hour keys and sampling days.

Two different clocks are at work and must not be mixed: the hour of a detection is read off the
recording's own wall clock, while the sampling day is the UTC day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# date and time, each in extended form or in basic form (20240131, 0515 or 051530); groups: year, month and day (extended, basic),
# hour, minute, second and fraction (extended), the same (basic), offset
_DATE_TIME = (
    r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))"
    r"(?:[T ](\d{2})(?::(\d{2})(?::(\d{2})([.,]\d{1,9})?)?|(\d{2})(?:(\d{2})([.,]\d{1,9})?)?)(Z|[+-]\d{2}:?\d{2})?)?$"
)
_PARTS = "\x01$1-$2$4-$3$5\x01$6\x01$7$10\x01$8$11\x01$9$12\x01$13"
_BASIC_DATE = (r"^(\d{4})(\d{2})(\d{2})(?=[T ]|$)", "$1-$2-$3")


def _with(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used: an expression named twice is otherwise copied."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def read_date(recorded: Column) -> Column:
    """ISO date-time as a struct of its ``wall`` clock and its ``zone``, both null if it is none: one look at the text.

    ``wall`` is a zone-less timestamp, ``zone`` the offset in the form ``+hh:mm`` or empty.
    """

    def found(parts: Column) -> Column:
        number = lambda k: F.when(parts[k] == "", F.lit("00")).otherwise(parts[k])
        text = F.concat(parts[1], F.lit(" "), number(2), F.lit(":"), number(3), F.lit(":"), number(4), F.replace(parts[5], F.lit(","), F.lit(".")))
        zone = (
            F.when(parts[6] == "Z", F.lit("+00:00"))
            .when(F.length(parts[6]) == 5, F.concat(F.substring(parts[6], 1, 3), F.lit(":"), F.substring(parts[6], 4, 2)))
            .otherwise(parts[6])
        )
        wall = F.when(F.size(parts) == 7, text).try_cast("timestamp_ntz")
        return F.struct(wall.alias("wall"), F.when(F.size(parts) == 7, zone).alias("zone"))

    # the mark in front tells text that fits from text that is left as it is
    return _with(F.split(F.regexp_replace(recorded, _DATE_TIME, _PARTS), "\x01"), found)


def wall_clock(recorded: Column) -> Column:
    """Wall clock of an ISO date-time as a zone-less timestamp, null if it is none."""
    return read_date(recorded)["wall"]


def offset_text(recorded: Column) -> Column:
    """Offset of an ISO date-time in the form ``+hh:mm``, empty if it has none, null if it is no date-time."""
    return read_date(recorded)["zone"]


def shifted(wall: Column, offset: Column, seconds: Column) -> Column:
    """Wall clock moved by ``seconds``, in ISO form with its offset; the fraction only if not zero."""
    moved = wall + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))

    def printed(text: Column) -> Column:
        whole = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))
        fraction = F.when(F.length(text) > 19, F.rpad(F.substring(text, 20, 7), 7, "0")).otherwise(F.lit(""))
        return F.concat(whole, fraction, offset)

    # text of a zone-less timestamp: formatting functions would take it through the session's zone
    return _with(moved.cast("string"), printed)


def segment_datetime(recorded: Column, seconds: Column) -> Column:
    """ISO date-time moved by ``seconds``, printed in the offset it came with.

    ``Z`` is printed as ``+00:00``. Text that is no ISO date-time gives null. The wall clock is held
    as a zone-less timestamp, so the session time zone and daylight saving have no say. Where many
    segments share a recording, ``read_date`` is better used once for it.
    """
    return _with(read_date(recorded), lambda date: shifted(date["wall"], date["zone"], seconds))


def hour_key(start_datetime: Column) -> Column:
    """Wall-clock hour of an ISO date-time, as in ``2024-01-31T05``."""
    return F.substring(start_datetime, 1, 13)


def date_key(recorded: Column) -> Column:
    """Date part of an ISO date-time."""
    return F.substring(F.regexp_replace(recorded, *_BASIC_DATE), 1, 10)


def utc_date(start_datetime: Column) -> Column:
    """UTC day of an ISO date-time, null if it cannot be read; no offset means UTC."""

    def day(date: Column) -> Column:
        offset = date["zone"]
        minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 5, 2).try_cast("int")
        signed = F.when(offset == "", F.lit(0)).when(F.startswith(offset, F.lit("-")), minutes).otherwise(-minutes)
        return (date["wall"] + F.make_dt_interval(F.lit(0), F.lit(0), signed, F.lit(0))).cast("date")

    return _with(read_date(start_datetime), day)
