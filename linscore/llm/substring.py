"""Repeated passages: words covered by a window of ``window`` words that also starts anywhere else are removed.

1. Each window is known by its anchor, the phrase of 8 words in it with the smallest hash; equal windows have equal
   anchors, and neighbouring windows mostly share one. A document gives one row per anchor and stretch of
   windows, with a hash of the stretch's words: about one row for 14 words.
2. Only stretches whose anchor occurs again go on. A stretch whose hash occurs again is claimed to repeat as a whole. Of
   the others, and of one copy of each whole one beside them, every window is hashed; what occurs twice is claimed. A claim names
   another place that is to hold the same words; so far all of it is hashes.
3. The passages that claims name are read off the documents at those other places, a window each: the ends of every run of claimed
   windows, and of the windows between as many as cover its words. Each is one row of a table of texts, however many claim it.
4. Documents are dealt over shards with the passages claimed for them. A shard compiles an Aho-Corasick automaton of its passages and
   streams its documents through it: only places where the automaton finds a passage's very words, other than the place it was
   read from, lose words. Where two hashes are equal by chance the automaton finds nothing, and the words stay.

All counts combine before their shuffle. Tables that hot anchors, windows or passages are looked up in are written first, so that the joins'
other side may be split where one passage is in a third of all documents. A document is known by a hash of its id and text, so rows may repeat ids or lack them: a
repeated row is an occurrence elsewhere. Null or blank text has no words, and texts are read whole however long; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flat
from .store import Store

PHRASE = 8
SHARD_BYTES = 1 << 20
# fewer only in tests, where hashes are to be equal by chance
HASH_BITS = 64


class Stretches:
    """Runs of windows of one anchor in a piece: ``row, low, high`` (window starts, from the row's first word)."""

    def __init__(self, piece: flat.Piece, window: int):
        self.words = words = flat.find_words(piece)
        self.hashes = flat.span_hashes(words.data, words.starts, words.ends)
        n = len(self.hashes)
        phrase = min(PHRASE, window)
        reach = window - phrase + 1
        if n < window:
            self.row = self.low = self.high = self.first = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        begins = np.arange(n - phrase + 1)
        phrases = flat.sequence_hashes(self.hashes, begins, begins + phrase)
        best = np.lib.stride_tricks.sliding_window_view(phrases, reach).argmin(axis=1) + np.arange(n - window + 1)
        row = np.searchsorted(words.rows, np.arange(n - window + 1), side="right") - 1
        valid = np.arange(n - window + 1) + window <= words.rows[row + 1]
        starts = np.flatnonzero(valid)
        best, row = best[starts], row[starts]
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (best[1:] != best[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(fresh)
        last = np.append(at[1:], len(starts)) - 1
        if not len(at):
            last = at
        self.row, self.first = row[at], words.rows[row[at]]
        self.low, self.high = starts[at] - self.first, starts[last] - self.first
        self.anchor = phrases[best[at]]

    def contexts(self, window: int) -> np.ndarray:
        """Hashes of all words of each stretch."""
        return flat.sequence_hashes(self.hashes, self.first + self.low, self.first + self.high + window)


def _stretches(window: int):
    shift = np.uint64(64 - HASH_BITS)

    def run(batches):
        for batch in batches:
            for piece in flat.text_pieces(batch.column(1)):
                found = Stretches(piece, window)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((found.anchor >> shift).view(np.int64)),
                        pa.array((found.contexts(window) >> shift).view(np.int64)),
                        batch.column(0).take(pa.array(found.row + piece.first)),
                        pa.array(found.low.astype(np.int32)),
                        pa.array(found.high.astype(np.int32)),
                    ],
                    ["anchor", "context", "key", "low", "high"],
                )

    return run


def _settled(whole: bool):
    """Documents without a repeated anchor are finished; of the others, or of all if ``whole``, the text stays."""

    def run(batches):
        for batch in batches:
            texts = batch.column(2)
            open_ = np.array(batch.column(3).is_valid())
            words, digests = [], []
            for going, text in zip(open_.tolist(), texts):
                parts = [] if going else (text.as_py() or "").encode().split()
                words.append(None if going else len(parts))
                digests.append(None if going else hashlib.sha256(b" ".join(parts)).hexdigest())
            kept = texts if whole else pc.if_else(pa.array(open_), texts, pa.scalar(None, texts.type))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words, pa.int64()), pa.array(digests, pa.string()), kept, *batch.columns[3:]],
                ["key", "doc_id", "n_words", "kept_sha256", "text", *batch.schema.names[3:]],
            )

    return run


def _marks(column, piece: flat.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Flat marks of a piece's rows: row in the piece, low, whole, speaks."""
    lists = column.slice(piece.first, piece.rows)
    values = lists.flatten()
    sizes = np.diff(np.asarray(lists.offsets))
    return (
        np.repeat(np.arange(piece.rows), sizes),
        *(np.asarray(values.field(n).to_numpy(zero_copy_only=False)) for n in ("low", "whole", "speaks")),
    )


def _matched(found: Stretches, row: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Places of the stretches that begin at ``low`` in ``row``."""
    return np.searchsorted((found.row << 32) + found.low, (row.astype(np.int64) << 32) + low)


def _windows(window: int):
    """Every window of the stretches that speak: its hash, where it lies in which context, and whether that occurs twice."""
    shift = np.uint64(64 - HASH_BITS)

    def run(batches):
        for batch in batches:
            for piece in flat.text_pieces(batch.column(1)):
                found = Stretches(piece, window)
                row, low, whole, speaks = _marks(batch.column(2), piece)
                row, low, whole = row[speaks], low[speaks], whole[speaks]
                at = _matched(found, row, low)
                counts = found.high[at] - found.low[at] + 1
                starts = flat.ranges(found.low[at], counts)
                places = flat.ranges(found.first[at] + found.low[at], counts)
                hashes = flat.sequence_hashes(found.hashes, places, places + window)
                context = np.repeat(found.contexts(window)[at], counts)
                offset = (starts - np.repeat(found.low[at], counts)).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((hashes >> shift).view(np.int64)),
                        pa.array(flat.mixed(context + offset * np.uint64(flat.BASE)).view(np.int64)),
                        pa.array(np.repeat(whole, counts)),
                        batch.column(0).take(pa.array(np.repeat(row + piece.first, counts))),
                        pa.array(starts.astype(np.int32)),
                    ],
                    ["hash", "place", "whole", "key", "start"],
                )

    return run


def _tiles(row, start, rkey, rstart, window: int) -> np.ndarray:
    """Of claimed windows, those to look at: both ends of each run on one other place's words, and between them every ``window``-th."""
    order = np.lexsort((start, rstart - start, rkey, row))
    row, start, rkey, rstart = row[order], start[order], rkey[order], rstart[order]
    same = np.zeros(len(row), bool)
    same[1:] = (row[1:] == row[:-1]) & (rkey[1:] == rkey[:-1]) & (start[1:] - start[:-1] == 1) & (rstart[1:] - rstart[:-1] == 1)
    last = np.ones(len(row), bool)
    last[:-1] = ~same[1:]
    return order[~same | last | (rstart % window == 0)]


def _claims(window: int):
    """A document's claims as passages to look for: ``key, rkey, rpos, twin``; a twin is the same place of a repeated row."""

    def run(batches):
        for batch in batches:
            marks, singles = batch.column(1), batch.column(2)
            sizes = np.diff(np.asarray(marks.offsets))
            values = marks.flatten()
            field = lambda v, n: np.asarray(v.field(n).to_numpy(zero_copy_only=False))
            whole = field(values, "whole").astype(bool)
            owner = np.repeat(np.arange(batch.num_rows), sizes)[whole]
            low, high, rkey, rlow, twin = (field(values, n)[whole] for n in ("low", "high", "rkey", "rlow", "twin"))
            counts = (high - low + 1).astype(np.int64)
            steps = flat.ranges(np.zeros(len(counts), np.int64), counts)
            each = lambda x: np.repeat(x, counts)
            apart = np.where(np.asarray(singles.is_valid()), np.diff(np.asarray(singles.offsets)), 0)
            found = singles.flatten()
            row = np.concatenate([each(owner), np.repeat(np.arange(batch.num_rows), apart)])
            start = np.concatenate([each(low) + steps, field(found, "start")]).astype(np.int64)
            rkey = np.concatenate([each(rkey), field(found, "rkey")]).astype(np.int64)
            rstart = np.concatenate([each(rlow) + steps, field(found, "rstart")]).astype(np.int64)
            twin = np.concatenate([each(twin), np.zeros(len(found), bool)]).astype(bool)
            at = _tiles(row, start, rkey, rstart, window)
            # a line that a document repeats claims its first place again and again
            order = at[np.lexsort((twin[at], rstart[at], rkey[at], row[at]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = np.any([v[order[1:]] != v[order[:-1]] for v in (row, rkey, rstart, twin)], axis=0)
            at = order[fresh]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row[at])), pa.array(rkey[at]), pa.array(rstart[at].astype(np.int32)), pa.array(twin[at]),
                ],
                ["key", "rkey", "rpos", "twin"],
            )

    return run


def _passages(window: int):
    """Texts of the windows that claims name in a document: ``rkey, rpos, passage``."""

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                words = (batch.column(1)[at].as_py() or "").encode().split()
                places = sorted(p for p in batch.column(2)[at].as_py() if p + window <= len(words))
                texts = [b" ".join(words[p : p + window]).decode() for p in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[at].as_py()] * len(places), pa.int64()), pa.array(places, pa.int32()), pa.array(texts, pa.string())],
                    ["rkey", "rpos", "passage"],
                )

    return run


def located(documents: list[tuple[int, list[str]]], passages: dict[str, set[tuple[int, int, bool]]], window: int) -> list[np.ndarray]:
    """Which words of each document (key, words) an automaton of the passages finds to repeat.

    A passage comes with the places it was read from (key, first word, and whether a row like that one is there again); finding it at
    its only such place says nothing.
    """
    automaton = ahocorasick.Automaton()
    for text, sources in passages.items():
        automaton.add_word(f" {text} ", sources)
    automaton.make_automaton()
    found = []
    for key, words in documents:
        edges = np.zeros(len(words) + 1, np.int64)
        if len(automaton) and len(words) >= window:
            after = np.cumsum([len(w) + 1 for w in words])
            for end, sources in automaton.iter(" " + " ".join(words) + " "):
                last = int(np.searchsorted(after, end))
                first = last - window + 1
                if any(twin or (rkey, rpos) != (key, first) for rkey, rpos, twin in sources):
                    edges[first] += 1
                    edges[last + 1] -= 1
        found.append(np.cumsum(edges[:-1]) > 0)
    return found


def _removed(window: int):
    """Compiles a shard's automaton and streams the shard's documents through it."""

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            column = {n: batch.column(i) for i, n in enumerate(names)}
            others = [n for n in names if n == "rest"]
            for piece in flat.text_pieces(column["text"], SHARD_BYTES):
                part = {n: column[n].slice(piece.first, piece.rows) for n in names}
                passages: dict[str, set] = {}
                for mine in part["passages"]:
                    for p in mine.as_py() or ():
                        passages.setdefault(p["passage"], set()).add((p["rkey"], p["rpos"], p["twin"]))
                documents = [
                    (key, [w.decode() for w in (text or "").encode().split()])
                    for key, text in zip(part["key"].to_pylist(), part["text"].to_pylist())
                ]
                kept = [
                    [w for w, gone in zip(words, covered.tolist()) if not gone]
                    for (_, words), covered in zip(documents, located(documents, passages, window))
                ]
                totals = [len(words) for _, words in documents]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"], pa.array(totals, pa.int64()),
                        pa.array([t - len(k) for t, k in zip(totals, kept)], pa.int64()), pa.array([" ".join(k) for k in kept], pa.string()),
                        *(part[n] for n in ["text", *others]),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept", "text", *others],
                )

    return run


MARK = "struct<low:int,high:int,whole:boolean,speaks:boolean,rkey:bigint,rlow:int,twin:boolean>"


def _found(documents: DataFrame, window: int, whole: bool) -> tuple[DataFrame, DataFrame]:
    """Finished documents ``doc_id, n_words, kept_sha256``, and ``doc_id, n_words, n_removed, kept, text`` of the others.

    With ``whole`` both have the text, and in ``rest`` all columns of ``documents`` but that.
    """
    store = Store(documents.sparkSession, "substrings")
    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if whole:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != "text"]).alias("rest"))
    texts = documents.select(*columns)
    texts = texts.withColumn("key", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), "text"))
    rest = ["rest"] if whole else []
    rest_type = f", rest {texts.schema['rest'].dataType.simpleString()}" if whole else ""
    rows = store.write(
        "stretches",
        texts.select("key", "text").mapInArrow(_stretches(window), "anchor bigint, context bigint, key bigint, low int, high int"),
    )
    again = store.write("anchors", rows.groupBy("anchor").count().where("count > 1").select("anchor"))
    rows = store.write("repeated", rows.join(again, "anchor", "left_semi"))
    store.drop("stretches", "anchors")
    place = F.struct("key", "low")
    contexts = store.write(
        "contexts", rows.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("voice"), F.max(place).alias("other"))
    )
    several = contexts.groupBy("anchor").count().where("count > 1").select("anchor", F.lit(True).alias("several"))
    contexts = store.write("voices", contexts.join(store.write("several", several), "anchor", "left"))
    speaker = F.col("voice") == place
    reference = F.when(speaker, F.col("other")).otherwise(F.col("voice"))
    marked = rows.join(contexts, ["anchor", "context"]).select(
        "key",
        F.struct(
            "low", "high", (F.col("n") > 1).alias("whole"), (F.col("several").isNotNull() & speaker).alias("speaks"),
            reference["key"].alias("rkey"), reference["low"].alias("rlow"), (reference == place).alias("twin"),
        ).alias("mark"),
    )
    marks = store.write("marks", marked.groupBy("key").agg(F.collect_set("mark").alias("marks")))
    settled = store.write(
        "settled",
        texts.join(marks, "key", "left").select("key", "doc_id", "text", "marks", *rest).mapInArrow(
            _settled(whole),
            f"key bigint, doc_id bigint, n_words bigint, kept_sha256 string, text string, marks array<{MARK}>" + rest_type,
        ),
    )
    store.drop("repeated", "contexts", "several", "voices")
    open_ = settled.where("marks is not null")
    windows = store.write(
        "windows",
        open_.select("key", "text", "marks").mapInArrow(
            _windows(window), "hash bigint, place bigint, whole boolean, key bigint, start int"
        ),
    )
    # the smallest key of those that hold a window: windows of one passage name one document, and make one run
    at = F.struct(F.col("key").alias("rkey"), F.col("start").alias("rstart"), "place")
    twice = windows.groupBy("hash").agg(F.min(at).alias("a"), F.max(at).alias("b")).where("a.place <> b.place")
    twice = store.write("twice", twice)
    other = F.when((F.col("key") == F.col("a.rkey")) & (F.col("start") == F.col("a.rstart")), F.col("b")).otherwise(F.col("a"))
    single = F.struct("start", other["rkey"].alias("rkey"), other["rstart"].alias("rstart"))
    singles = windows.where("not whole").join(twice, "hash").groupBy("key").agg(F.collect_set(single).alias("singles"))
    claims = store.write(
        "claims",
        marks.join(singles, "key", "left").mapInArrow(_claims(window), "key bigint, rkey bigint, rpos int, twin boolean"),
    )
    store.drop("windows", "twice", "marks")
    # at most one place a word of the document that is read there
    named = claims.groupBy(F.col("rkey").alias("key")).agg(F.collect_set("rpos").alias("places"))
    texts_there = open_.select("key", "text").dropDuplicates(["key"]).join(named, "key")
    passages = store.write("passages", texts_there.mapInArrow(_passages(window), "rkey bigint, rpos int, passage string"))
    mine = store.write(
        "mine",
        claims.join(passages, ["rkey", "rpos"]).groupBy("key").agg(F.collect_list(F.struct("rkey", "rpos", "twin", "passage")).alias("passages")),
    )
    store.drop("claims", "passages")
    removed = open_.select("key", "doc_id", "text", *rest).join(mine, "key", "left").mapInArrow(
        _removed(window), "doc_id bigint, n_words bigint, n_removed bigint, kept string, text string" + rest_type
    )
    return settled.where("marks is null"), removed


def repeated_passages(documents: DataFrame, window: int = 35) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256`` (hash of the kept words joined by a blank)."""
    clean, removed = _found(documents, window, False)
    clean = clean.select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256")
    return clean.unionByName(removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")))


def without_repeats(documents: DataFrame, window: int = 35) -> DataFrame:
    """All documents with their columns; where words went, ``text`` is the kept words joined by a blank."""
    clean, removed = _found(documents, window, True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")).alias("text")
    found = clean.select("text", "rest").unionByName(removed.select(text, "rest"))
    return found.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in documents.columns])
