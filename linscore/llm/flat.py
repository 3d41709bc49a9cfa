"""Whole columns of text as flat numpy arrays: bytes, word spans, hashes.

The bytes of many texts lie in one Arrow buffer, so that words are found and hashed by a few array
operations over a piece of some megabytes instead of one call per text. A text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def byte_table(truth) -> np.ndarray:
    return np.array([bool(truth(b)) for b in range(256)])


NOT_SPACE = byte_table(lambda b: b not in SPACES)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


@dataclass
class Piece:
    """Rows ``first`` to ``last`` of a column: their bytes and where each row's bytes begin and end."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first


def text_pieces(column, size: int = PIECE_BYTES) -> Iterator[Piece]:
    """Runs of rows of about ``size`` bytes; null counts as empty, a longer text is a piece of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    rows = len(column)
    if not rows:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, rows + 1, column.offset * 8)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield Piece(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """Spans of words in ``data``; ``rows[i]:rows[i+1]`` are the words of row i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)


def find_words(piece: Piece, inside: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Longest runs of bytes for which ``inside`` holds, never across rows."""
    data = LOWER[piece.data] if lower else piece.data
    held = inside[data]
    before = np.empty_like(held)
    before[1:] = held[:-1]
    before[:1] = False
    begins = piece.offsets[:-1]
    before[begins[begins < len(data)]] = False
    after = np.empty_like(held)
    after[:-1] = held[1:]
    after[-1:] = False
    finishes = piece.offsets[1:]
    after[finishes[finishes > 0] - 1] = False
    starts, ends = np.flatnonzero(held & ~before), np.flatnonzero(held & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, piece.offsets))


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, 2**bits of each."""

    def table(base: int) -> np.ndarray:
        found = np.ones(1, np.uint64)
        for k in range(bits):
            found = np.concatenate([found, found * np.uint64(pow(base, 1 << k, 1 << 64))])
        return found

    return table(BASE), table(pow(BASE, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit hangs on every other."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, alike for equal bytes wherever they stand."""
    powers, inverse = _powers(max(20, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of the runs, one behind the other."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def listed(values: np.ndarray, offsets: np.ndarray, kind=None) -> pa.Array:
    """A list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def taken(batch: pa.RecordBatch, names: list[str], first: int, last: int) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)).slice(first, last - first) for n in names]


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of ``values`` (hashes of words, say), alike for equal runs wherever they stand."""
    powers, inverse = _powers(max(20, int(len(values)).bit_length()))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
