"""Whitening, resampling and positive-unlabelled learning against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linscore.llm import flat, queries, resampling, toxicity, whitening
from tests.compare import connect, differences

from . import fixtures
from .test_search import table, vectors

SF = "/root/testdata/sf0.01"
WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


# ---- whitening --------------------------------------------------------------------------------


def symmetric(size, values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [np.linspace(1, 3, 40), np.r_[np.full(12, 5.0), np.full(28, 1.0)], 0.7 ** np.arange(40), np.r_[[4.0, 2.0], np.zeros(38)], np.zeros(40)])
def test_contours_find_what_inertia_counts(values):
    matrix = symmetric(40, values)
    matrix = (matrix + matrix.T) / 2
    for shift in (0.5, 1.7, 4.5):
        assert whitening.above(matrix, shift) == (values > shift).sum()
    intervals = whitening.eigenvalue_intervals(matrix, 16)
    real = np.sort(values[values > 1e-12 * max(values.max(), 1)])[::-1]
    assert sum(c for *_, c in intervals) >= min(16, len(real))
    if not intervals:
        return
    found, vectors_ = whitening.orthonormal_pairs(
        matrix, np.concatenate([whitening.contour_eigenpairs(matrix, *i)[1] for i in intervals], axis=1)
    )
    k = min(16, len(real))
    assert np.allclose(found[:k], real[:k], rtol=0, atol=1e-13 * real[0])
    assert np.abs(vectors_.T @ vectors_ - np.eye(len(found))).max() < 1e-12


def test_an_interval_with_fewer_eigenvalues_than_counted_is_an_error():
    with pytest.raises(ArithmeticError):
        whitening.contour_eigenpairs(np.diag([1.0, 2.0, 5.0]), 1.5, 3.0, 2)


def integers(v):
    if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v):
        return None
    return tuple(math.floor(64 * float(x)) + 1_000_000 for x in v)


def check_whitening(rows, found):
    """All rows against dense eigenvectors of the plain covariance."""
    by_size = {}
    for i, v, _ in rows:
        x = integers(v)
        if x is not None:
            by_size.setdefault(len(x), []).append((i, x))
    expected, got = Counter(), {}
    for size, members in by_size.items():
        fit = sorted({x for _, x in members})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[(v * n - s) / n for v, s in zip(x, sums)] for x in fit])
        covariance = centred.T @ centred / n
        values = np.linalg.eigvalsh(covariance)[::-1][:16]
        for i, x in members:
            deviation = sum((v * n - s) ** 2 for v, s in zip(x, sums))
            for k in range(min(16, size)):
                share = round(values[k] / np.trace(covariance), 9) + 0.0 if np.trace(covariance) > 0 else None
                expected[(i, k + 1, n, deviation, share)] += 1
        white = {}
        for r in found:
            if r.n == n and r.whitened is not None:
                white.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
        got[size] = white
        if not white:
            continue
        for (i, x) in members:
            y = np.array([(v * n - s) / n for v, s in zip(x, sums)])
            deviation = sum((v * n - s) ** 2 for v, s in zip(x, sums))
            parts = white[(i, deviation)]
            # the whitened length in the leading space is the same for any signs and order within equal values
            inverse = np.linalg.eigh(covariance)
            top = inverse[1][:, ::-1][:, : len(parts)]
            assert sum(v * v for v in parts.values()) == pytest.approx(((y @ top) ** 2 / values[: len(parts)]).sum(), rel=1e-8, abs=1e-8)
    assert Counter((r.vec_id, r.component, r.n, r.deviation, None if r.explained is None else round(r.explained, 9) + 0.0) for r in found) == expected
    assert all(r.identity_error < 1e-9 for r in found)


def test_whitening_equals_dense_eigenvectors(spark):
    rows = [r for r in vectors() if r[1] is None or len(r[1]) != 3] + [(2000, [3.0, 1.0], 1), (2001, [1e30] * 16, 1), (2002, [3.0, 2.0], None), (2003, [3.0, 2.0], 1)]
    found = whitening.whitened(table(spark, rows)).collect()
    check_whitening([r for r in rows if r[0] != 2001], found)
    assert whitening.whitened(table(spark, [])).collect() == []
    assert {(r.whitened, r.explained, r.deviation) for r in whitening.whitened(table(spark, [(1, [1.0, 2.0], 0)] * 3)).collect()} == {(None, None, 0)}


def test_whitening_of_the_given_table(spark):
    found = queries.QUERIES["op11_feast_whitening"](spark, SF).collect()
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(rows, found)
    white = np.array([[r.whitened for r in sorted(found, key=lambda r: (r.component, r.vec_id)) if r.component == k] for k in range(1, 17)])
    assert np.abs(np.cov(white, bias=True) - np.eye(16)).max() < 1e-4


def test_deviations_beyond_a_long_are_null():
    model = whitening.Whitening(3_000_000_000, [3_000_000_000 * 5 + 1] * 2, np.zeros((2, 0)), np.zeros(0))
    found = model.deviations(np.array([[5, 5], [6, 5], [1 << 52, 5]]))
    assert found[:2] == [2, (3_000_000_000 - 1) ** 2 + 1] and found[2] is None


# ---- resampling -------------------------------------------------------------------------------


def resampled(rows, target, percent=10, ngrams=1, buckets=10_000):
    def features(text):
        words = re.findall(WORD, (text or "").translate(fixtures.ASCII_LOWER))
        runs = [" ".join(words[i : i + k]) for k in range(1, ngrams + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    s, t = Counter(), Counter()
    for text in target:
        t.update(features(text)[1])
    known = [(i, *features(text)) for i, text in rows]
    for *_, found in known:
        s.update(found)
    every, wanted = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (every + buckets) / ((s[b] + 1) * (wanted + buckets))))
    out = []
    for i, words, found in known:
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return out, able[: percent * len(able) // 100]


@pytest.mark.parametrize("percent, ngrams, buckets", [(10, 1, 10_000), (50, 3, 257), (100, 2, 70_000), (0, 1, 100)])
def test_resampling_equals_brute_force(spark, percent, ngrams, buckets):
    rows = fixtures.awkward() + [(600, "A-b\x00c_d é　É1" * 9), (601, "\x7f{|}" * 30)] + [(700, fixtures.sentences(5, 1)[0])] * 7
    target = [*fixtures.sentences(3, 2), None, "", "Only four"]
    wanted = spark.createDataFrame([(k, t, 1) for k, t in enumerate(target)], "item_id bigint, text string, bucket int")
    found = resampling.resampled(fixtures.documents(spark, rows), wanted, percent, ngrams, buckets).collect()
    expected, drawn = resampled(rows, target, percent, ngrams, buckets)
    assert Counter(tuple(r)[:4] for r in found) == Counter(r[:4] for r in expected)
    ranks = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranks] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranks] == [(r[0], r[3]) for r in drawn]


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert resampling.resampled(fixtures.documents(spark, []), none).collect() == []
    found = resampling.resampled(fixtures.documents(spark, fixtures.awkward()), none).collect()
    assert Counter(tuple(r)[:4] for r in found) == Counter(r[:4] for r in resampled(fixtures.awkward(), [])[0])


def test_resampling_equals_sql(spark):
    assert differences(spark, connect(SF), SF, "op12_importance_resampling") is None


def test_overlapping_spans_are_all_runs():
    text = b"b aa b aa cc"
    spans = [m[0] for m in resampling.span_pattern(2).finditer(text, overlapped=True)]
    assert spans == [b"b aa", b"aa b", b"b aa", b"aa cc"]
    assert resampling.feature_buckets(b" ..Aa;BB ", [resampling.span_pattern(1)], 1 << 20) == (2, [zlib.crc32(w) % (1 << 20) for w in (b"aa", b"bb")])


# ---- positive-unlabelled learning -------------------------------------------------------------


def test_risk_is_corrected_and_kept_above_zero():
    rng = np.random.default_rng(1)
    positive, unlabelled, weights = rng.random((30, 4)), rng.random((80, 4)), rng.standard_normal(4)
    plain = lambda x, y: np.log1p(np.exp(-y * (x @ weights)))
    on_positive, corrected = toxicity.risk(weights, positive, unlabelled, 0.3)
    assert on_positive == pytest.approx(0.3 * plain(positive, 1).mean())
    assert corrected == pytest.approx(plain(unlabelled, -1).mean() - 0.3 * plain(positive, -1).mean())

    def slope(part):
        steps = np.eye(4) * 1e-6
        return np.array([(part(weights + s) - part(weights - s)) / 2e-6 for s in steps])

    assert np.allclose(toxicity.gradient(weights, positive, unlabelled, 0.3), slope(lambda w: sum(toxicity.risk(w, positive, unlabelled, 0.3))), atol=1e-6)
    # a prior too high for these scores drives the negative risk below zero: the step goes back up
    weights = np.full(4, 3.0)
    unlabelled = unlabelled * 0.1
    assert toxicity.risk(weights, positive, unlabelled, 0.9)[1] < 0
    assert np.allclose(toxicity.gradient(weights, positive, unlabelled, 0.9), -slope(lambda w: toxicity.risk(w, positive, unlabelled, 0.9)[1]), atol=1e-5)


def marks_by_hand(text: str | None) -> set:
    words = [w.encode() for w in re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").translate(fixtures.ASCII_LOWER))]
    times = Counter(words) + Counter((n, w[:n]) for w in words for n in toxicity.STEMS if len(w) >= n)
    return set(times) | {("again", m) for m, k in times.items() if k > 1 and k >= toxicity.DENSE * len(words)}


def test_marks_are_words_stems_and_what_is_dense():
    import pyarrow as pa

    texts = ["One two ONE", None, "", "é-é2 b", "x" * 50_000, "réeuxa, réeuxb!", "stem stems stemsx stemsxyz STEMSXYZ", "rare rare " + "w " * 400]
    texts += [t for _, t in fixtures.awkward()]
    expected = [marks_by_hand(t) for t in texts]
    assert ("again", (5, b"r\xc3\xa9eu")) in expected[5] and ("again", b"rare") not in expected[7]
    for size in (4, 1 << 19):
        found = [set() for _ in texts]
        for piece in flat.text_pieces(pa.array(texts), size):
            row, mark, smallest = toxicity.held_buckets(piece)
            assert (np.diff(row) >= 0).all()
            for r, m in zip(row.tolist(), mark.tolist()):
                assert m not in found[r + piece.first]
                found[r + piece.first].add(m)
            assert [bool(s) for s in smallest] == [any(c > " " for c in t or "") for t in texts[piece.first : piece.last]]
        assert [len(f) for f in found] == [len(e) for e in expected]
        assert len(set().union(*found)) == len(set().union(*expected))
        for k in range(len(texts)):
            assert len(found[k] & found[8]) == len(expected[k] & expected[8])


def test_toxic_documents_of_every_language_are_found(spark):
    """Held-out documents of the larger tables: inflected words are told by their stems."""
    folder = "/root/testdata/sf0.1"
    found = queries.QUERIES["op13_toxicity"](spark, folder).where("held_out")
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id").collect()
    for lang in {r.lang for r in rows}:
        assert np.mean([r.predicted for r in rows if r.lang == lang and r.toxic]) > 0.85
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.005


def test_held_out_toxic_documents_are_found(spark):
    found = queries.QUERIES["op13_toxicity"](spark, SF)
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in found.collect()}
    assert len(held) == 1000 and all(held[r.doc_id] == r.held_out and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in found.collect())
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.92
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.04
    assert np.mean([r.predicted for r in rows if r.toxic]) > 0.6


def test_labels_of_held_out_rows_are_never_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.remainder("doc_id") == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (Counter(map(tuple, toxicity.scored(docs, t).collect())) for t in (labels, turned))
    assert one == two


def test_toxicity_of_awkward_texts(spark):
    clean = fixtures.sentences(7, 120)
    rows = fixtures.awkward() + [(1000 + k, t + (" vile Vermin" if k % 4 == 0 else "")) for k, t in enumerate(clean)]
    marks = [(1000 + k, 1, int(k % 4 == 0)) for k in range(120) if k % 3] + [(0, 1, None), (None, 1, 1), (99999, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    found = toxicity.scored(fixtures.documents(spark, rows), labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    score = {r.doc_id: r.score for r in found}
    assert np.mean([score[1000 + k] >= 0.7 for k in range(0, 120, 4)]) > 0.95
    assert np.mean([score[1000 + k] >= 0.7 for k in range(120) if k % 4]) < 0.1
    assert {r.score for r in toxicity.scored(fixtures.documents(spark, rows), labels.limit(0)).collect()} == {0.0}
    assert toxicity.scored(fixtures.documents(spark, []), labels).collect() == []
    only = toxicity.scored(fixtures.documents(spark, rows), labels.where("toxic = 1"), max_positive=10).collect()
    assert all(0 <= r.score <= 1 for r in only) and len(only) == len(rows)
