"""Token ids against the libraries, and packing by a round trip."""

import hashlib
import os
import random
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from linscore.llm import bytebpe, flat, packing, pieces

from . import fixtures

os.environ["TOKENIZERS_PARALLELISM"] = "false"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = [" ", "\n", "a", "B", "é", "1", "'s", " ", "\t", "漢", "!", "▁", "ll", "  ", "\x00", "the", "🙂", "   ", "<s>", "<0x41>", " ", "\u0085", "\x1c", "\r"]
ODD = ["", None, " ", "\n", "a  b", "a \n b", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "x　y z", "it's we'll  don't\n\n\nfoo\t bar  "]
ODD += ["x" * 3000, "the" * 1000, " " * 2000, "abcde" * 500]


def random_texts(count: int = 4000) -> list[str]:
    rng = random.Random(7)
    return ["".join(rng.choices(LETTERS, k=rng.randint(0, 40))) for _ in range(count)]


def encoded(encoder, texts, size):
    found = []
    for piece in flat.text_pieces(pa.array(texts, pa.string()), size):
        ids, rows = encoder.encode(piece)
        found += [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:])]
    return found


@pytest.mark.parametrize("size", [500, 1 << 20])
def test_byte_bpe_equals_tokenizers(size):
    texts = ODD + random_texts()
    library = Tokenizer.from_file(BPE)
    expected = [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encoded(bytebpe.ByteBPE(BPE), texts, size) == expected


@pytest.mark.parametrize("size", [500, 1 << 20])
def test_pieces_equal_sentencepiece(size):
    texts = ODD + random_texts()
    encoder = pieces.PieceBPE(PIECES)
    expected = sentencepiece.SentencePieceProcessor(model_file=PIECES).encode([t or "" for t in texts])
    assert encoded(encoder, texts, size) == expected


def test_long_words_are_cut_where_no_piece_reaches_across():
    rng = random.Random(5)
    letters = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=600_000))
    texts = [letters, "".join(rng.choices("etaoinshr", k=20_000)), "漢字" * 300 + "a" * 300, "é" * 500, "ab▁cd" * 200, "x" * 4_000 + letters[:500]]
    encoder, library = pieces.PieceBPE(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    began = time.time()
    (piece,) = flat.text_pieces(pa.array(texts), 1 << 24)
    ids, offsets = encoder.encode(piece)
    took = time.time() - began
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [library.encode(t) for t in texts]
    assert took < 5
    points = np.frombuffer(letters.encode("utf-32-le"), np.uint32)
    owner, counts = encoder._cut(points, np.array([len(points)]))
    assert counts.sum() == len(points) and set(owner.tolist()) == {0} and (counts > pieces.LONG).mean() < 0.01


def test_a_full_word_table_starts_anew():
    encoder = pieces.PieceBPE(PIECES)
    encoder.table.limit = 50
    texts = random_texts(300)
    assert encoded(encoder, texts, 400) == encoder.library.encode(texts)


def test_digests(spark):
    rows = fixtures.awkward() + [(500 + k, t) for k, t in enumerate(ODD)]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = Counter()
    for i, text in rows:
        ids = library.encode(text or "")
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), library.decode(ids)))
        expected[(i, len(ids), *digests)] += 1
    assert Counter(tuple(r) for r in pieces.digests(fixtures.documents(spark, rows), PIECES).collect()) == expected
    kept = pieces.encoded(fixtures.documents(spark, rows), PIECES).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in kept) == Counter(
        (i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in rows
    )
    assert pieces.digests(fixtures.documents(spark, []), PIECES).count() == 0


def check_packing(rows, found, window):
    library = Tokenizer.from_file(BPE)
    ids = defaultdict(list)
    for i, text in rows:
        ids[i].append(library.encode(text or "", add_special_tokens=False).ids + [0])
    # ids with one row each can be followed piece by piece
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, texts in ids.items():
        assert sum(r.length for r in by_doc[i]) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for r in sorted(by_doc[i], key=lambda r: r.start):
                part = texts[0][r.start : r.start + r.length]
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(texts[0]), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
                at += r.length
    padding = 0
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        padding += window - at if at & (at - 1) else 0
    return padding


@pytest.mark.parametrize("window", [64, 1024])
def test_packing_holds_every_id_once(spark, monkeypatch, window):
    monkeypatch.setattr(packing, "GROUP_ROWS", 7)
    rows = fixtures.awkward() + [(1000 + k, "same text again") for k in range(80)]
    found = packing.packed(fixtures.documents(spark, rows), BPE, window).collect()
    assert check_packing(rows, found, window) == 0


def test_packing_of_nothing(spark):
    assert packing.packed(fixtures.documents(spark, []), BPE).collect() == []
    assert [(r.length, r.offset) for r in packing.packed(fixtures.documents(spark, [(1, None)]), BPE).collect()] == [(1, 0)]


def test_least_squares_uses_up_what_fits():
    rng = np.random.default_rng(0)
    histogram = np.zeros(65, np.int64)
    for a in rng.integers(1, 32, 500):
        histogram[[a, 64 - a]] += 1
    places, done, sequences = packing.planned(histogram, 64)
    assert done.sum() > 0.95 * histogram.sum() and (done <= histogram).all()
    taken = Counter()
    for length, first, last, sequence, offset in places:
        taken.update((sequence + k, offset + j) for k in range(last - first) for j in range(length))
    assert len(taken) == 64 * sequences and set(taken.values()) == {1}
