"""SentencePiece BPE ids of whole columns by merge rounds over flat arrays, equal to the library's.

A text becomes words: a run of blanks with what follows it, as no piece of the model has a blank behind another
character. The distinct words of a piece of a column lie one behind the other in one array of symbols. In each round
every word merges its leftmost pair of the best score (a segmented minimum), the array is compacted, and words
without a pair left leave it. One merge per word and round keeps the library's order exactly: a piece may be made of
several pairs, so merging all occurrences of a pair at once could overtake a better one. Words of over ``LONG`` characters are
first cut between neighbouring characters that no piece holds, where no merge can reach across; the parts take the rounds like
words. Only a part that is still as long (one letter a thousand times over, say) takes a heap, for which a round per merge would be too many.

Characters outside the vocabulary fall back to bytes. Models with a normaliser, pieces marked unused, or blanks
inside pieces are refused.

Defined cases: null text counts as empty and has no ids; texts of any length are encoded whole; repeated ids and rows give a row each; an
empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .wordtable import WordTable

BLANK = "▁"
UNKNOWN = 1 << 24
NONE = np.int64(1) << 30
LONG = 96
NOT_BLANK = flat.byte_table(lambda b: b != 0x20)


class PieceBPE:
    def __init__(self, path: str):
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(size)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(size)]
        if any(library.is_unused(i) for i in range(size)) or any(BLANK in n.lstrip(BLANK) for n in names):
            raise ValueError("models with unused pieces, or with blanks inside pieces, are not taken")
        probe = "ﬁ \tA  ́e "
        if library.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("only models that leave texts as they are, behind a blank, are taken")
        self.bytes = np.array([library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        symbols = {names[i]: i for i in range(size) if not special[i]}
        self.size = size
        # characters that only occur inside pieces are symbols too
        for name in list(symbols):
            for c in name:
                symbols.setdefault(c, UNKNOWN + ord(c))
        self.characters = np.arange(0x110000, dtype=np.int64) + UNKNOWN
        for name, i in symbols.items():
            if len(name) == 1:
                self.characters[ord(name)] = i
        self.characters[0x20] = self.characters[ord(BLANK)]
        # neighbouring characters that some piece holds: between all others no merge can ever reach across
        beside = {ord(a) << 32 | ord(b) for name in symbols for a, b in zip(name, name[1:])}
        self.beside = np.array(sorted(beside), np.int64)
        scores = sorted({library.get_score(i) for i in range(size) if not special[i]}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        pairs = {}
        for name, i in symbols.items():
            if i < size:
                for k in range(1, len(name)):
                    if name[:k] in symbols and name[k:] in symbols:
                        pairs[symbols[name[:k]] << 32 | symbols[name[k:]]] = (rank[library.get_score(i)], i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int64)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)
        self.known: dict[int, tuple[int, int]] | None = None
        self.table = WordTable(self._encode)
        self.texts = [str(i).encode() for i in range(size)]
        self.text_lengths = np.array([len(t) + 1 for t in self.texts], np.int64)
        self.text_starts = np.cumsum(self.text_lengths) - self.text_lengths
        self.text_bytes = np.frombuffer(b"".join(t + b"," for t in self.texts), np.uint8)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE where no piece comes of it) and piece of neighbouring symbols."""
        key = left << np.int64(32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], NONE), self.made[at]

    def merged(self, symbols: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rounds over all words: parts ``(word numbers, flat symbols, symbols per word)`` as they are finished."""
        words, done = np.arange(len(counts)), []
        rank, piece = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            rank[:-1], piece[:-1] = self.pair(symbols[:-1], symbols[1:])
        rank[np.cumsum(counts) - 1] = NONE
        while len(words):
            starts = np.cumsum(counts) - counts
            best = np.minimum.reduceat(rank << np.int64(32) | np.arange(len(symbols)), starts)
            going = best < NONE << np.int64(32)
            if not going.all():
                over = np.repeat(~going, counts)
                done.append((words[~going], symbols[over], counts[~going]))
                moved = np.cumsum(~over) - 1
                symbols, rank, piece = symbols[~over], rank[~over], piece[~over]
                words, counts = words[going], counts[going]
                if not len(words):
                    break
                at = moved[best[going] & np.int64(0xFFFFFFFF)]
            else:
                at = best & np.int64(0xFFFFFFFF)
            symbols[at] = piece[at]
            rank[at] = rank[at + 1]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            shift = np.arange(len(at))
            symbols, rank, piece = symbols[keep], rank[keep], piece[keep]
            counts = counts - 1
            at = at - shift
            ends = np.cumsum(counts)
            right = at + 1 < ends
            place = at[right]
            rank[at[~right]] = NONE
            rank[place], piece[place] = self.pair(symbols[place], symbols[place + 1])
            place = at[at > ends - counts] - 1
            rank[place], piece[place] = self.pair(symbols[place], symbols[place + 1])
        return done

    def merged_long(self, symbols: list[int]) -> list[int]:
        """One very long word: a heap of pairs, best score and then leftmost first."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        if self.known is None:
            self.known = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist())))
        known = self.known
        heap: list[tuple[int, int, int, int, int]] = []

        def push(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (found := known.get(symbols[a] << 32 | symbols[b])):
                heapq.heappush(heap, (found[0], a, b, symbols[a], symbols[b]))

        for i in range(n - 1):
            push(i, i + 1)
        while heap:
            _, a, b, left, right = heapq.heappop(heap)
            if symbols[a] != left or symbols[b] != right or after[a] != b:
                continue
            symbols[a], symbols[b] = known[left << 32 | right][1], -1
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            push(before[a], a)
            push(a, after[a])
        return [s for s in symbols if s >= 0]

    def _encode(self, data, starts, ends):
        lengths = ends - starts
        raw = data[flat.ranges(starts, lengths)]
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        leads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        upto = np.cumsum(lengths)
        counts = leads[upto] - leads[upto - lengths]
        symbols = self.characters[points]
        whole = counts
        owner, counts = self._cut(points, counts)
        long = counts > LONG
        n = len(counts)
        parts = self.merged(symbols[np.repeat(~long, counts)], counts[~long])
        short_numbers = np.flatnonzero(~long)
        parts = [(short_numbers[w], s, c) for w, s, c in parts]
        bounds = np.cumsum(counts)
        for i in np.flatnonzero(long):
            found = np.array(self.merged_long(symbols[bounds[i] - counts[i] : bounds[i]].tolist()), np.int64)
            parts.append((np.array([i]), found, np.array([len(found)])))
        sizes = np.zeros(n, np.int64)
        for words, _, kept in parts:
            sizes[words] = kept
        flat_symbols = np.zeros(int(sizes.sum()), np.int64)
        first = np.cumsum(sizes) - sizes
        for words, found, kept in parts:
            flat_symbols[flat.ranges(first[words], kept)] = found
        return self._with_bytes(flat_symbols, np.bincount(owner, sizes, len(whole)).astype(np.int64))

    def _cut(self, points: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words over ``LONG`` characters cut where no piece reaches across; whose part each part is, and the parts' lengths."""
        inside = np.repeat(counts > LONG, counts)
        if not inside.any():
            return np.arange(len(counts)), counts
        ends = np.cumsum(counts)
        first = np.zeros(len(points), bool)
        first[ends[counts > 0] - counts[counts > 0]] = True
        characters = np.where(points == 0x20, ord(BLANK), points).astype(np.int64)
        at = np.flatnonzero(inside[1:] & ~first[1:]) + 1
        pairs = characters[at - 1] << 32 | characters[at]
        place = np.minimum(np.searchsorted(self.beside, pairs), max(len(self.beside) - 1, 0))
        held = self.beside[place] == pairs if len(self.beside) else np.zeros(len(pairs), bool)
        first[at[~held]] = True
        starts = np.flatnonzero(first)
        return np.searchsorted(ends, starts, side="right"), np.diff(np.append(starts, len(points)))

    def _with_bytes(self, symbols, sizes):
        """Symbols outside the vocabulary as the byte pieces of their UTF-8."""
        unknown = symbols >= UNKNOWN
        if not unknown.any():
            return symbols.astype(np.int32), sizes
        texts = [chr(s).encode() for s in (symbols[unknown] - UNKNOWN).tolist()]
        width = np.ones(len(symbols), np.int64)
        width[unknown] = [len(t) for t in texts]
        ids = np.repeat(symbols, width)
        ids[np.repeat(unknown, width)] = self.bytes[np.frombuffer(b"".join(texts), np.uint8)]
        totals = np.concatenate([[0], np.cumsum(width)])
        upto = np.cumsum(sizes)
        return ids.astype(np.int32), totals[upto] - totals[upto - sizes]

    def encode(self, piece: flat.Piece) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all rows, and the row offsets into them."""
        data, bounds = piece.data, piece.offsets
        if data.tobytes().find(BLANK.encode()) >= 0:  # a literal blank symbol is a blank to the model
            texts = [data[a:b].tobytes().replace(BLANK.encode(), b" ") for a, b in zip(bounds[:-1], bounds[1:])]
            data = np.frombuffer(b"".join(texts), np.uint8)
            bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        # the blank in front of every text
        held = np.diff(bounds) > 0
        data = np.insert(data, bounds[:-1][held], 0x20)
        bounds = bounds + np.concatenate([[0], np.cumsum(held)])
        blank = ~NOT_BLANK[data]
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[bounds[:-1][held]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        firsts, lengths = self.table.look_up(data, starts, ends)
        totals = np.concatenate([[0], np.cumsum(lengths)])
        return self.table.ids[flat.ranges(firsts, lengths)], totals[np.searchsorted(starts, bounds)]

    def written(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Decimal ids, each with a comma behind it, and the row offsets into these bytes."""
        lengths = self.text_lengths[ids]
        totals = np.concatenate([[0], np.cumsum(lengths)])
        return self.text_bytes[flat.ranges(self.text_starts[ids], lengths)], totals[rows]

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> list[str]:
        numbers = ids.tolist()
        return self.library.decode([numbers[a:b] for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())], num_threads=1)


@cache
def piece_bpe(path: str) -> PieceBPE:
    """One model per worker process, kept with its table between tasks."""
    return PieceBPE(path)


def encoded(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids`` (array<int>) and ``decoded`` of every text; null counts as empty, rows stay apart."""

    def run(batches):
        encoder = piece_bpe(model)
        for batch in batches:
            for piece in flat.text_pieces(batch.column(1)):
                ids, rows = encoder.encode(piece)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, piece.rows), flat.listed(ids, rows, pa.int32()), pa.array(encoder.decode(ids, rows), pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    return _texts(documents).mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def digests(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256`` (decimal ids joined by commas), ``decoded_sha256`` of every text.

    Ids and decoded texts stay in the task. Null counts as empty; each row, repeated or not, gives a row.
    """

    def run(batches):
        encoder = piece_bpe(model)
        for batch in batches:
            for piece in flat.text_pieces(batch.column(1)):
                ids, rows = encoder.encode(piece)
                text, at = encoder.written(ids, rows)
                view = memoryview(text)
                spans = zip(at[:-1].tolist(), at[1:].tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, piece.rows),
                        pa.array(np.diff(rows)),
                        pa.array([hashlib.sha256(view[a : max(a, b - 1)]).hexdigest() for a, b in spans], pa.string()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in encoder.decode(ids, rows)], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return _texts(documents).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
