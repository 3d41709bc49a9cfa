"""Near-duplicates, components and repeated passages against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from linscore.llm import components, flat, minhash, substring
from linscore.llm.store import Store

from . import fixtures


@pytest.mark.parametrize("few", [0, 256])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(minhash, "FEW_PAIRS", few)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 16)
    rows = fixtures.awkward()
    found = minhash.near_duplicates(fixtures.documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == fixtures.near_duplicates(rows)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(fixtures.documents(spark, [])).collect() == []


def test_blocks_find_the_links_between_components():
    rng = np.random.default_rng(0)
    sets = [rng.choice(60, rng.integers(20, 40), replace=False) for _ in range(50)]
    component = rng.integers(0, 9, 50)
    table = pa.table(
        {
            "id": pa.array(range(50), pa.int64()), "component": pa.array(component), "outer": pa.array([True] * 50),
            "shingles": pa.array([s.tolist() for s in sets], pa.list_(pa.int64())),
        }
    )
    found = minhash._block_links(40)(table).to_pydict()
    expected = [
        (i, j) for i in range(50) for j in range(i + 1, 50)
        if component[i] != component[j] and 100 * len({*sets[i]} & {*sets[j]}) >= 40 * len({*sets[i]} | {*sets[j]})
    ]
    assert expected
    assert fixtures.groups(zip(found["low"], found["high"]), range(50)) == fixtures.groups(expected, range(50))


def test_blocks_link_large_sets_at_exactly_the_threshold():
    # the hundredfold of the shared shingles is no float32, and rounds down
    n = next(n for n in range(3 * 223_700, 1 << 22, 3) if int(np.float32(n) * np.float32(100)) < 100 * n)
    table = pa.table(
        {
            "id": pa.array([1, 2], pa.int64()), "component": pa.array([1, 2], pa.int64()), "outer": pa.array([False, True]),
            "shingles": pa.array([np.arange(n), np.arange(n + n // 3)], pa.list_(pa.int64())),
        }
    )
    assert minhash._block_links(75)(table).to_pylist() == [{"low": 1, "high": 2}]


def superminhash(elements, slots):
    """One set's signature, element by element as published, with the draws of ``signatures``."""
    found = [np.iinfo(np.uint64).max] * slots
    for element in elements:
        order = list(range(slots))
        for step in range(slots):
            draw = int(flat.mixed(np.array([element + ((step + 1) * 0xD1B54A32D192ED03 & flat.MASK) & flat.MASK], np.uint64))[0])
            pick = step + (draw >> 40) % (slots - step)
            order[step], order[pick] = order[pick], order[step]
            found[order[step]] = min(found[order[step]], draw & (1 << 40) - 1 | step << 40)
    return found


def test_signatures_follow_the_published_loop():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 2, 30, 400]
    elements = rng.integers(0, 1 << 63, sum(sizes)).astype(np.uint64)
    rows = np.concatenate([[0], np.cumsum(sizes)])
    found = minhash.signatures(elements, rows, 16)
    for k in range(len(sizes)):
        part = [int(x) for x in elements[rows[k] : rows[k + 1]]]
        assert found[k].tolist() == superminhash(part, 16)


def test_signatures_estimate_the_similarity():
    one = flat.mixed(np.arange(300, dtype=np.uint64))
    two = flat.mixed(np.arange(100, 400, dtype=np.uint64))
    found = minhash.signatures(np.concatenate([one, two]), np.array([0, 300, 600]))
    assert abs((found[0] == found[1]).mean() - 0.5) < 0.1


@pytest.mark.parametrize("links", [[(k, k + 1) for k in range(200)], [(0, k) for k in range(1, 300)], [(5, 9), (9, 12), (3, 12), (20, 21)], []])
def test_components(spark, links):
    table = spark.createDataFrame(links, "low bigint, high bigint").repartition(5)
    found = {r.id: r.component for r in components.components(Store(spark, "test"), "c", table).collect()}
    expected = fixtures.groups(links, {i for link in links for i in link})
    assert {i: found.get(i, i) for i in expected} == expected


WINDOW = 35


def passages(rows, window=WINDOW) -> list:
    split = [(i, fixtures.words_of(t)) for i, t in rows]
    count = Counter(tuple(w[k : k + window]) for _, w in split for k in range(len(w) - window + 1))
    found = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if count[tuple(words[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        found.append((i, words, [w for k, w in enumerate(words) if k not in gone]))
    return found


def passage_rows():
    rows = fixtures.awkward()
    base = fixtures.sentences(4, 3, 100)
    rows += [(200, " ".join([base[0], base[1]])), (201, base[1] + " z"), (202, " ".join(base[1].split(" ")[30:70])), (203, "r " * 34), (204, "a b " * 60)]
    rows += [(205, base[2].replace(" ", "\n", 3)), (206, "tail " + " ".join(base[2].split(" ")[:35]))]
    return rows


def test_repeated_passages_equal_brute_force(spark):
    rows = passage_rows()
    found = Counter(tuple(r) for r in substring.repeated_passages(fixtures.documents(spark, rows)).collect())
    assert found == Counter(
        (i, len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for i, w, k in passages(rows)
    )
    assert sum(r[2] for r in found) > 500


def test_without_repeats_keeps_columns_and_untouched_texts(spark):
    rows = passage_rows()
    table = fixtures.documents(spark, rows)
    found = substring.without_repeats(table)
    assert found.columns == table.columns
    expected = Counter((i, " ".join(k) if len(k) < len(w) else t) for (i, t), (_, w, k) in zip(rows, passages(rows)))
    assert Counter((r.doc_id, r.text) for r in found.collect()) == expected


def test_no_passages_in_nothing(spark):
    assert substring.repeated_passages(fixtures.documents(spark, [])).collect() == []


def test_pieces_shards_and_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_BYTES", 1 << 16)
    rows = fixtures.long_documents()
    assert len(rows[0][1].encode()) > flat.PIECE_BYTES
    found = Counter(tuple(r) for r in substring.repeated_passages(fixtures.documents(spark, rows)).collect())
    assert found == Counter(
        (i, len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for i, w, k in passages(rows)
    )
    near = Counter(tuple(r)[:4] for r in minhash.near_duplicates(fixtures.documents(spark, rows)).collect())
    assert near == fixtures.near_duplicates(rows)


@pytest.mark.parametrize("bits", [3, 12])
def test_equal_hashes_take_no_words(spark, monkeypatch, bits):
    """With hashes of a few bits nearly all claims are false: the automata find none of them."""
    monkeypatch.setattr(substring, "HASH_BITS", bits)
    fresh = [(k, t) for k, t in enumerate(fixtures.sentences(31, 60))]
    found = substring.repeated_passages(fixtures.documents(spark, fresh)).collect()
    assert len(found) == 60 and {r.n_removed for r in found} == {0}
    rows = fresh + [(100, " ".join(fresh[3][1].split()[5:50])), (101, fresh[7][1]), (102, fresh[7][1])]
    exact = {i: len(w) - len(k) for i, w, k in passages(rows)}
    assert all(r.n_removed <= exact[r.doc_id] for r in substring.repeated_passages(fixtures.documents(spark, rows)).collect())


def test_automata_mark_what_stands_there_and_elsewhere():
    words = "a b c d a b c e".split()
    documents = [(7, words), (8, "x a b c".split()), (9, "a b".split())]
    at = lambda *sources: {"a b c": set(sources)}
    marked = lambda p: [c.tolist() for c in substring.located(documents, p, 3)]
    no = [[False] * 8, [False] * 4, [False] * 2]
    assert marked({}) == marked({"b a c": {(1, 0, False)}}) == no
    assert marked(at((7, 0, False)))[0] == [False] * 4 + [True] * 3 + [False]
    assert marked(at((7, 0, True)))[0] == marked(at((7, 0, False), (8, 1, False)))[0] == [True] * 3 + [False] + [True] * 3 + [False]
    assert marked(at((8, 1, False)))[1] == [False] * 4 and marked(at((7, 0, False)))[1:] == [[False, True, True, True], [False] * 2]


@pytest.mark.parametrize("outer", [0, 1, 7, 40])
def test_block_rows_grow_with_rows_that_ask(spark, monkeypatch, outer):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 16)
    n = 200
    rows = [(1, i, 1 if i >= outer else 1000 + i, 50) for i in range(n)] + [(2, 900 + i, 5, 50) for i in range(30)]
    dealt = minhash._dealt(spark.createDataFrame(rows, "cluster bigint, id bigint, component bigint, n_shingles bigint")).collect()
    blocks, outers = -(-n // 16), -(-outer // 16)
    assert len(dealt) == n * outers + outer * blocks
    seen = {}
    for r in dealt:
        seen.setdefault((r.i, r.j), ([], []))[r.outer].append(r.id)
    met = {(a, b) for rows_, asking in seen.values() for a in asking for b in rows_}
    assert met == {(a, b) for a in range(outer) for b in range(n)}
    assert all(len(rows_) < 40 and len(asking) < 40 for rows_, asking in seen.values())
