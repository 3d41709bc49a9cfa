"""Score arithmetic: coercion, weights, bins and seeded draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INF = float("inf")
_DRAWS = float(1 << 48)


def to_number(value: Column, is_text: bool = True) -> Column:
    """Value as double, null where it is no number (text such as ``1.5f`` is no number)."""
    if not is_text:
        return value.cast("double")
    return F.when(~F.coalesce(F.lower(F.trim(value.cast("string"))).rlike(r"\d[df]$"), F.lit(False)), value).try_cast(
        "double"
    )


def finite_number(value: Column, is_text: bool = True) -> Column:
    """Value as a finite double, null for text, NaN and both infinities."""
    number = to_number(value, is_text)
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(_INF)), number)


def is_text(df: DataFrame, column: str) -> bool:
    """Whether a column has to be read as text; numbers need no such look."""
    return not isinstance(df.schema[column].dataType, T.NumericType)


def half_gaussian_weight(score: Column, sigma: Column | float) -> Column:
    """``exp(-s²/2σ²)`` of a number, for finite ``s >= 0``, else 0."""
    sigma = sigma if isinstance(sigma, Column) else F.lit(float(sigma))
    number = finite_number(score, is_text=False)
    weight = F.exp(-(number * number) / (F.lit(2.0) * sigma * sigma))
    return F.when(number >= 0, weight).otherwise(F.lit(0.0))


def _edge(index: Column, lo: float, hi: float, bins: int) -> Column:
    step = (hi - lo) / bins
    return F.when(index >= bins, F.lit(hi)).otherwise(F.lit(lo) + index * F.lit(step))


def _first_guess(value: Column, lo: float, hi: float, bins: int) -> Column:
    place = F.floor((value - F.lit(lo)) / F.lit((hi - lo) / bins))
    return F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1)).cast("int")


def right_closed_bin(value: Column, lo: float, hi: float, bins: int) -> Column:
    """Bin 0..bins-1 of ``(edge, next edge]``; the lowest value is in bin 0. Needs lo < hi."""
    guess = _first_guess(value, lo, hi, bins)
    return (
        F.when((guess > 0) & (value <= _edge(guess, lo, hi, bins)), guess - 1)
        .when((guess < bins - 1) & (value > _edge(guess + 1, lo, hi, bins)), guess + 1)
        .otherwise(guess)
    )


def left_closed_bin(value: Column, lo: float, hi: float, bins: int) -> Column:
    """Bin 0..bins-1 of ``[edge, next edge)``; the last bin is closed. Needs lo < hi."""
    guess = _first_guess(value, lo, hi, bins)
    return (
        F.when((guess > 0) & (value < _edge(guess, lo, hi, bins)), guess - 1)
        .when((guess < bins - 1) & (value >= _edge(guess + 1, lo, hi, bins)), guess + 1)
        .otherwise(guess)
    )


def bin_edge(index: Column, lo: float, hi: float, bins: int) -> Column:
    """Left edge of bin ``index`` (of ``bins``: the upper end)."""
    return _edge(index, lo, hi, bins)


def draw_hash(seed: int, id_columns: Sequence[str]) -> Column:
    """Seeded draw of a row as 32 hex digits, uniform and the same on every run.

    It hangs on the row's identity alone, never on its place in a partition, so a retried task or
    another cluster size draws the same.
    """
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in id_columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *text))


def draw_uniform(draw: Column) -> Column:
    """Draw as a number in (0, 1), from its first 48 bits."""
    bits = F.conv(F.substring(draw, 1, 12), 16, 10).cast("bigint")
    return (bits + F.lit(0.5)) / F.lit(_DRAWS)


def draw_cell(draw: Column) -> Column:
    """Cell of a draw: leading zeros and the next two hex digits, in the order of the draws.

    Cells get finer towards zero: whatever the number of draws, the cell that holds the n-th
    smallest has about n/16 of them or fewer, and there are only some 240 cells for each leading
    zero. Counting per cell thus finds where the n smallest end without sorting the draws.
    """
    rest = F.ltrim(draw, F.lit("0"))
    return F.concat(F.lpad(F.length(rest).cast("string"), 2, "0"), F.substring(rest, 1, 2))
