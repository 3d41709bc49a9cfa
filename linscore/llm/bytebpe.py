"""Byte-level BPE ids of whole columns, equal to those of the ``tokenizers`` library.

Texts are cut where the tokenizer's own pattern always cuts: before a single blank or line break between two
characters that are surely no white space. Each distinct chunk of a task is encoded once: by ``tiktoken``, with
vocabulary and ranks taken from the tokenizer's file, many chunks in a call, or by ``tokenizers`` itself where a chunk is
irregular (first in its text, white space at its end, an added token in it).
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from . import flat
from .wordtable import WordTable

# the pattern of byte-level pre-tokenizers: a fixed value
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BREAKS = flat.byte_table(lambda b: b in b" \n")
GRAPHIC = flat.byte_table(lambda b: 0x21 <= b <= 0x7E)
# lead bytes of characters none of which is white space; two-byte ones end a chunk safely too
PLAIN_TWO = flat.byte_table(lambda b: 0xC3 <= b <= 0xDF)
PLAIN_LEAD = flat.byte_table(lambda b: 0xC3 <= b <= 0xDF or 0xE4 <= b <= 0xF4)


def _bytes_of_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, others follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBPE:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _bytes_of_letters()
        model, before = spec["model"], spec["pre_tokenizer"]
        added = [t["content"].encode() for t in spec["added_tokens"]]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without normalizer or prefix is taken")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or b" " in c for t, c in zip(spec["added_tokens"], added)):
            raise ValueError("added tokens that take white space are not taken")
        self.added = added
        ranks = {
            bytes(letters[c] for c in token): k for token, k in model["vocab"].items() if token.encode() not in added
        }
        self.fast = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.token_bytes[list(ranks.values())] = [len(t) for t in ranks]
        self.table = WordTable(self._encode)

    def _encode(self, data, starts, ends):
        lengths = ends - starts
        text = data[flat.ranges(starts, lengths)].tobytes()
        at = np.cumsum(lengths) - lengths
        regular = BREAKS[data[starts]] & (lengths > 1) & (GRAPHIC | PLAIN_TWO)[data[np.minimum(starts + 1, len(data) - 1)]]
        last = data[ends - 1]
        regular &= GRAPHIC[last] | ((last >= 0x80) & PLAIN_TWO[data[np.maximum(ends - 2, 0)]] & (lengths > 2))
        for token in self.added:
            place = text.find(token)
            while place >= 0:
                regular[np.searchsorted(at, place, side="right") - 1] = False
                place = text.find(token, place + 1)
        counts = np.zeros(len(starts), np.int64)
        odd = np.flatnonzero(~regular)
        odd_ids = [
            x.ids
            for x in self.tokenizer.encode_batch(
                [text[at[i] : at[i] + lengths[i]].decode() for i in odd], add_special_tokens=False
            )
        ]
        counts[odd] = [len(x) for x in odd_ids]
        plain = np.flatnonzero(regular)
        joined = data[flat.ranges(starts[plain], lengths[plain])].tobytes().decode()
        plain_ids = np.array(self.fast.encode_ordinary(joined), np.int32)
        ends_of = np.cumsum(lengths[plain])
        token_ends = np.cumsum(self.token_bytes[plain_ids])
        upto = np.searchsorted(token_ends, ends_of, side="right")
        if len(plain) and not np.array_equal(token_ends[upto - 1], ends_of):
            raise AssertionError("a token crosses a chunk's end")
        counts[plain] = np.diff(upto, prepend=0)
        ids = np.zeros(int(counts.sum()), np.int32)
        place = np.cumsum(counts) - counts
        ids[flat.ranges(place[plain], counts[plain])] = plain_ids
        if len(odd):
            ids[flat.ranges(place[odd], counts[odd])] = np.concatenate([np.array(x, np.int32) for x in odd_ids])
        return ids, counts

    def chunks(self, piece: flat.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of chunks, and the row offsets into them."""
        data, n = piece.data, len(piece.data)
        cut = np.zeros(n, bool)
        if n > 2:
            sure_before = GRAPHIC[data]
            sure_before[1:] |= (data[1:] >= 0x80) & PLAIN_TWO[data[:-1]]
            sure_after = (GRAPHIC | PLAIN_LEAD)[data]
            cut[1:-1] = BREAKS[data[1:-1]] & sure_before[:-2] & sure_after[2:]
        bounds = piece.offsets
        # a row's last byte is no start of a chunk: what follows it belongs to the next row
        lasts = bounds[1:][np.diff(bounds) > 0] - 1
        cut[lasts] = False
        firsts = bounds[:-1][np.diff(bounds) > 0]
        cut[firsts] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)[: len(starts)]
        return starts, ends, np.searchsorted(starts, bounds)

    def encode(self, piece: flat.Piece) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all rows, and the row offsets into them."""
        starts, ends, rows = self.chunks(piece)
        firsts, lengths = self.table.look_up(piece.data, starts, ends)
        totals = np.concatenate([[0], np.cumsum(lengths)])
        return self.table.ids[flat.ranges(firsts, lengths)], totals[rows]


@cache
def byte_bpe(path: str) -> ByteBPE:
    """One tokenizer per worker process, kept with its table between tasks."""
    return ByteBPE(path)
