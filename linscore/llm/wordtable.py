"""A growing table of words already encoded, so that each distinct word of a task is encoded once.

Words are told apart by 64-bit hashes. The table is bounded: beyond ``limit`` words it starts anew.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import flat

Encode = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class WordTable:
    """``encode(data, starts, ends)`` gives the flat ids of words and the number of ids of each."""

    def __init__(self, encode: Encode, limit: int = 1_000_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.firsts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.used, self.ids = 0, np.zeros(1 << 16, np.int32)

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's ids begin in ``ids``, and how many there are."""
        hashes = flat.span_hashes(data, starts, ends)
        unique, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inner = place < len(self.keys)
        known[inner] = self.keys[place[inner]] == unique[inner]
        if not known.all():
            if len(self.keys) + int((~known).sum()) > self.limit and len(self.keys):
                self._clear()
                return self.look_up(data, starts, ends)
            new = ~known
            ids, lengths = self.encode(data, starts[example[new]], ends[example[new]])
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used : self.used + len(ids)] = ids
            firsts = self.used + np.cumsum(lengths) - lengths
            self.used += len(ids)
            at = place[new]
            self.keys = np.insert(self.keys, at, unique[new])
            self.firsts = np.insert(self.firsts, at, firsts)
            self.lengths = np.insert(self.lengths, at, lengths)
            place = np.searchsorted(self.keys, unique)
        return self.firsts[place][inverse], self.lengths[place][inverse]
