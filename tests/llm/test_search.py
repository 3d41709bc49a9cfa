"""Vector joins and searches against all pairs; archives by a round trip."""

import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from linscore.llm import gridjoin, vptree, warc
from linscore.llm.store import Store

from . import fixtures

SCHEMA = "vec_id bigint, embedding array<float>, label int, key string, n int"


def vectors(seed=0, count=400, size=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, size))
    rows = [(i, (centres[i % 12] + rng.standard_normal(size) * (0.02 + 0.2 * (i % 5))).astype(np.float32).tolist(), i % 3) for i in range(count)]
    same = rows[7][1]
    rows += [(1000 + k, same, 1) for k in range(50)] + [(1100, same, 2), (1101, [float(np.float32(3 * x)) for x in same], 1), (1102, same, None), (None, same, 1)]
    rows += [(1103, None, 1), (1104, [0.0] * size, 1), (1105, [float("nan")] * size, 1), (1106, [None] * size, 1), (1107, [], 1)]
    rows += [(1108, same[:3], 1), (1109, same[:3], 1), (1110, [float("inf")] + same[1:], 1), (1111, same, 1), (1111, same, 1), (1112, rows[8][1], 2), (1112, rows[9][1], 0)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_grid_join_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(gridjoin, "BLOCK", 16)
    monkeypatch.setattr(gridjoin, "FAN", 3)
    rows = vectors()
    part = [usable(v) and i is not None and label is not None for i, v, label in rows]
    counts, links = [0] * len(rows), []
    for a, (i, v, label) in enumerate(rows):
        for b, (j, w, other) in enumerate(rows):
            if a != b and part[a] and part[b] and label == other and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                    counts[a] += 1
                    links.append((i, j))
    component = fixtures.groups(links, {i for i, *_ in rows if i is not None})
    expected = Counter((i, n, component.get(i), i is None or component[i] == i) for (i, *_), n in zip(rows, counts))
    assert Counter(tuple(r) for r in gridjoin.near_vectors(table(spark, rows)).collect()) == expected
    assert gridjoin.near_vectors(table(spark, [])).collect() == []


@pytest.mark.parametrize("factor, least", [(1.0, 1.0), (1.5, 0.9)])
def test_search_against_all_rows(spark, monkeypatch, factor, least):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 150)
    monkeypatch.setattr(vptree, "LEAF", 8)
    monkeypatch.setattr(vptree, "BLOCK_ROWS", 7)
    rows = [r for r in vectors(1) if r[0] not in (1111, 1112)]  # ids that repeat
    found = vptree.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, 20, factor).collect()
    good = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and usable(v)]
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: r.rank):
        got[r.query_id].append((r.vec_id, r.score))
    hit = total = 0
    for i, v in good:
        if i % 20 == 0:
            best = sorted((-(w * v).sum(), j) for j, w in good if j != i and len(w) == len(v))[:20]
            assert [s for _, s in got[i]] == sorted((s for _, s in got[i]), reverse=True)
            assert all(abs(s - (dict(good)[j] * v).sum()) < 1e-12 for j, s in got[i])
            hit += len({j for _, j in best} & {j for j, _ in got[i]})
            total += len(best)
            if least == 1.0:
                assert [j for _, j in best] == [j for j, _ in got[i]]
    assert hit >= least * total and len(got) == sum(i % 20 == 0 for i, _ in good)
    assert vptree.nearest(table(spark, []), F.col("vec_id") % 20 == 0).collect() == []


def pages():
    rows = [(k, f"http://example.org/{k}", f"<p>{k % 7}</p>" * (k % 40)) for k in range(120)]
    rows += [(None, "http://é/ x\r\n", "<p>"), (None, None, None), (5000, "u", ""), (5001, "u", None), (5002, "u", "a\r\n\r\nb"), (5003, "u", "a\r\n\r\nb")]
    return rows + [(5003, "u", "a\r\n\r\nb"), (None, "u", "a\r\n\r\nb"), (6000, "u", "long é " * 200_000)]


@pytest.mark.parametrize("least", [0, 30])
def test_archives_give_back_what_was_written(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "FILE_BYTES", 4000)
    rows = pages()
    table = spark.createDataFrame([(*r, "f", 1) for r in rows], "page_id bigint, url string, html string, file string, offset int")
    same = defaultdict(list)
    for i, _, html in rows:
        same[html or ""].append(i)
    expected = Counter()
    for i, _, html in rows:
        body = (html or "").encode()
        top = max((j for j in same[html or ""] if j is not None), default=None)
        first = len(body) < least or len(same[html or ""]) == 1 or i == top
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        expected[(i, len(body), digest, "response" if first else "revisit", None if first else top)] += 1
    assert Counter(tuple(r) for r in warc.round_trip(table, least).collect()) == expected
    assert warc.round_trip(table.limit(0)).collect() == []


def test_selected_records_are_read_with_their_payload(spark):
    store = Store(spark, "test-archives")
    table = spark.createDataFrame(pages(), "page_id bigint, url string, html string")
    index = warc.write_archives(table, store.path("warc"), store)
    found = warc.read_archives(index.where("page_id in (3, 9, 5003, 6000)"), store.path("warc")).collect()
    html = {i: (h or "").encode() for i, _, h in pages()}
    assert {r.page_id for r in found} == {3, 9, 5003, 6000}
    assert all(bytes(r.payload) == (html[r.page_id] if r.record_type == "response" else b"") for r in found)
