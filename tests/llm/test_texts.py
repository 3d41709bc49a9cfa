"""Quality, licences, quotes and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from linscore.llm import licences, quality, queries, quoting, store
from tests.compare import as_bag, connect, differences

from . import fixtures

SF = "/root/testdata/sf0.01"


def test_pooled_rates_rise():
    x, rate = quality.pooled(np.arange(6.0), np.array([0.0, 3, 1, 2, 8, 10]), np.full(6, 10.0))
    assert x.tolist() == [0.0, 2.0, 4.0, 5.0] and rate.tolist() == [0.0, 0.2, 0.8, 1.0]


def test_held_out_documents_are_told_apart(spark):
    found = queries.QUERIES["op8_quality_classifier"](spark, SF)
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(r.predicted for r in rows if r.quality)
    assert found.count() == 1000 and found.where("score between 0 and 1").count() == 1000


def test_quality_of_awkward_texts(spark):
    rows = fixtures.awkward()
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(100, 160)] + [(1, None, 1), (None, 1, 0), (9999, 1, 0)], "doc_id bigint, quality int, toxic int")
    found = quality.scored(fixtures.documents(spark, rows), labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    blank = quality.scored(fixtures.documents(spark, rows), labels.limit(0)).collect()
    assert {r.score for r in blank} == {0.5}
    assert quality.scored(fixtures.documents(spark, []), labels).collect() == []
    kept = quality.accepted(fixtures.documents(spark, rows), labels.limit(0))
    assert kept.count() == len(rows) and kept.columns == fixtures.documents(spark, []).columns


def test_licences_equal_brute_force(spark):
    rows = fixtures.awkward() + [
        (500, "GNU General  Public-License, cc by CC BY mit license MIT\nLicense gnu gnu general public license é"),
        (501, "cc by"), (502, "xcc by"), (503, "cc é by"), (None, "Apache License"), (504, "Apache License " * 3000),
        (505, "foundation Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
        (506, "the Apache License, Version 2.0"), (507, "Licensed under the Apache License, Version 2.0."),
    ]
    found = licences.scanned(fixtures.documents(spark, rows)).collect()
    expected = Counter()
    for i, text in rows:
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(fixtures.ASCII_LOWER))
        places = [
            (k, label) for phrase, label in licences.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()
        ]
        starts = [k for k, _ in places]
        expected[(i, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in places})))] += 1
    assert Counter(tuple(r)[:6] for r in found) == expected
    by_id = {r.doc_id: r for r in found}
    assert by_id[507].labels == "apache,apache-2.0" and by_id[507].score == 1.0
    assert by_id[505].labels == "mit" and by_id[505].base_labels == ""
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in found)
    assert licences.scanned(fixtures.documents(spark, [])).collect() == []


def test_notices_among_many_licence_words(spark):
    texts = [text for *_, text in licences.TEMPLATES]
    words = " ".join(sorted({w for text in texts for w in text.split()}))
    rows = [(k, f"{words} zz {text}") for k, text in enumerate(texts)] + [(99, " zz ".join(texts))]
    # words of some notices are common: they come last in a document's order of rarity
    common = [text for label, _, text in licences.TEMPLATES if label in ("apache-2.0", "gpl", "mit")]
    for others in ([], [(200 + k, text) for k, text in enumerate(common * 20)]):
        found = {r.doc_id: r for r in licences.scanned(fixtures.documents(spark, rows + others)).collect()}
        for k, (label, *_) in enumerate(licences.TEMPLATES):
            assert label in found[k].labels.split(",") and found[k].score == pytest.approx(1)
        assert {label for label, *_ in licences.TEMPLATES} <= set(found[99].labels.split(","))


def aligned_by_hand(rows, templates) -> Counter:
    """Every template at every place of every text."""
    def split(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(fixtures.ASCII_LOWER))

    texts = [(i, split(t)) for i, t in rows]
    counts = Counter(w for _, words in texts for w in set(words))
    result: Counter = Counter()
    for i, words in texts:
        labels, best, base = set(), 0.0, []
        for label, key, text in {t for t in templates if None not in t}:
            notice, phrase = split(text), split(key)
            weight = [math.log((len(rows) + 1) / (counts[w] + 0.5)) for w in notice]
            at = [k for k in range(len(notice)) if notice[k : k + len(phrase)] == phrase and phrase]
            rare = sorted(set(notice), key=lambda w: (-weight[notice.index(w)], w))[: licences.RARE]
            indexed = [k for k, w in enumerate(notice) if w in rare]
            for start in range(-len(notice), len(words)) if at else ():
                same = [k for k, w in enumerate(notice) if 0 <= start + k < len(words) and words[start + k] == w]
                share = sum(weight[k] for k in same) / sum(weight)
                stands = start + at[0] >= 0 and words[start + at[0] :][: len(phrase)] == phrase
                if stands and share >= licences.LEAST and len(set(indexed) & set(same)) >= min(2, len(indexed)):
                    labels, best = labels | {label}, max(best, share)
        for phrase, label in licences.BASE.items():
            base += [(k, label) for k in range(len(words)) if words[k:][: len(phrase.split())] == phrase.split()]
        starts, base_labels = [k for k, _ in base], {b for _, b in base}
        result[
            (i, len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)),
             ",".join(sorted(base_labels | labels)), round(max(best, 0.9 if base else 0.0), 9))
        ] += 1
    return result


def test_a_table_of_500_templates_against_brute_force(spark):
    rng = random.Random(9)
    pool = [f"w{k}" for k in range(120)]
    templates = []
    for k in range(500):
        words = rng.choices(pool, k=rng.randint(2, 25))
        at = rng.randrange(len(words))
        templates.append((f"licence-{k % 170}", " ".join(words[at : at + rng.randint(1, 4)]), " ".join(words)))
    templates += [templates[3], ("single", "alone", "Alone"), ("doubled", "ding", "ding-ding"), ("mit-again", "mit license", "under the mit license here")]
    templates += [(None, "w1", "w1 w2"), ("x", None, "w1 w2"), ("x", "w1", None), ("no-key", "w1 zz", "w1 w2"), ("blank", " ", " "), ("empty", "", "w1")]
    rows = [(None, None), (1, ""), (2, "alone"), (2, "alone"), (3, "ding ding ding"), (4, "Under the MIT License here; cc by"), (None, "mit license")]
    for k in range(60):
        parts = []
        for _ in range(rng.randint(0, 3)):
            words = rng.choice(templates[:500])[2].split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = rng.choice(pool)
            # some notices begin before the text
            parts += [*words[rng.choice((0, 0, 1)) :], *rng.choices([*pool, "mit", "license", "cc", "by"], k=rng.randint(0, 9))]
        rows += [(10 + k, " ".join(parts))] * rng.choice((1, 1, 3))
    table = spark.createDataFrame(templates, "label string, key_phrase string, text string")
    found = licences.scanned(fixtures.documents(spark, rows), table).collect()
    assert Counter((*tuple(r)[:7], round(r.score, 9)) for r in found) == aligned_by_hand(rows, templates)
    assert len({label for r in found for label in r.labels.split(",")}) > 60


def test_no_templates_leave_base_labels_and_texts_are_scanned_twice(spark, tmp_path):
    fixtures.documents(spark, [(1, "cc by"), (2, "released under the mit license"), (2, "released under the mit license")]).write.parquet(str(tmp_path / "texts"))
    documents = spark.read.parquet(str(tmp_path / "texts"))
    none = licences.notices(spark).where("false")
    assert sorted((r.doc_id, r.labels, r.score) for r in licences.scanned(documents, none).collect()) == [(1, "cc-by", 0.9), (2, "mit", 0.9), (2, "mit", 0.9)]
    assert {r.labels for r in licences.scanned(documents, none, licences.base_phrases(spark).where("false")).collect()} == {""}
    written = []
    write = store.Store.write

    def noted(self, name, df):
        written.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(self, name, df)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(store.Store, "write", noted)
        result = licences.scanned(documents)
    plans = [plan for _, plan in written] + [result._jdf.queryExecution().executedPlan().toString()]
    scans = [sum("FileScan" in line and "text#" in line for line in plan.splitlines()) for plan in plans]
    assert sum(scans) == 2 and [name for (name, _), n in zip(written, scans) if n] == ["counts", "judged"]
    assert not any("Python" in plan or "NestedLoop" in plan or "Cartesian" in plan for plan in plans)


def test_quotes_are_followed_and_removed(spark, monkeypatch):
    monkeypatch.setattr(quoting, "SPAN", 2)
    rows = [
        (1, 0, "u", "Hello there.\n\nSecond para\ncontinues."), (1, 1, "a", "> Hello there.\nAnswer one."),
        (1, 2, "u", "On x, y wrote:\n> > hello   there.\n> Answer ONE.\nthanks"), (1, 3, "u", "> second para continues.\nlate"),
        (1, 4, "b", None), (1, 7, "b", ">thanks\n> late\n>late"), (1, 7, "c", "twin"), (None, 1, "x", "> Hello there."),
        (2, 5, "x", "> nothing known\nz"), (2, None, "x", "q"),
    ]
    table = spark.createDataFrame([(*r, "e") for r in rows], "conv_id bigint, turn bigint, role string, text string, root string")
    found = {(r.conv_id, r.turn, r.role): (r.reply_to, r.root, r.depth, r.text) for r in quoting.conversations(table).collect()}
    assert found == {
        (1, 0, "u"): (None, 0, 0, rows[0][3]), (1, 1, "a"): (0, 0, 1, "Answer one."), (1, 2, "u"): (1, 0, 2, "thanks"),
        (1, 3, "u"): (0, 0, 1, "late"), (1, 4, "b"): (None, 4, 0, ""), (1, 7, "b"): (2, 0, 3, ""), (1, 7, "c"): (2, 0, 3, "twin"),
        (None, 1, "x"): (None, 1, 0, ""), (2, 5, "x"): (None, 5, 0, "z"), (2, None, "x"): (None, None, 0, "q"),
    }
    assert quoting.conversations(table.limit(0)).collect() == []


def test_nested_quotes_link_where_no_outer_quote_does(spark):
    rows = [
        (1, 0, "first words\nmore of it\n\nend of first"), (1, 1, "second words"),
        (1, 2, ">> second words\nonly nested"), (1, 3, "> deleted parent\n>> first words\n>> more of it\nouter quote has no original"),
        (1, 4, "> second words\n>> first words\n>> more of it\n>> end of first\nouter quote has one"), (1, 5, "> > > end of first\n> > nowhere\n> \nthree deep"),
        (1, 6, ">> nowhere either\nnone"), (1, 7, "> > second words\n> > > first words more of it\n> edited\nnearest level first"),
        (1, 8, "".join(f"{'>' * k} no {k}\n" for k in range(1, 12)) + ">" * 12 + " none\ntwelve deep"),
    ]
    table = spark.createDataFrame([(c, t, "u", text) for c, t, text in rows], "conv_id bigint, turn bigint, role string, text string")
    found = {r.turn: (r.reply_to, r.root, r.depth, r.text) for r in quoting.conversations(table).collect()}
    assert found == {
        0: (None, 0, 0, rows[0][2]), 1: (None, 1, 0, "second words"), 2: (1, 1, 1, "only nested"), 3: (0, 0, 1, "outer quote has no original"),
        4: (1, 1, 1, "outer quote has one"), 5: (0, 0, 1, "three deep"), 6: (None, 6, 0, "none"), 7: (1, 1, 1, "nearest level first"),
        8: (6, 6, 1, "twelve deep"),
    }


def test_turn_after_a_blank_one_links_to_the_turn_it_still_quotes(spark):
    turns = [(1, 0, "u", "hello\nthere"), (1, 1, "a", " "), (1, 2, "u", "bye"), (2, 0, "u", "a"), (2, 1, "a", None), (2, 2, "u", "b")]
    table = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    found = {(r.conv_id, r.turn): r.reply_to for r in quoting.conversations(queries.quoting_messages(table)).collect()}
    assert found == {(1, 0): None, (1, 1): 0, (1, 2): 0, (2, 0): None, (2, 1): 0, (2, 2): None}


def test_quoted_conversations_equal_sql(spark):
    assert differences(spark, connect(SF), SF, "op10_quotation_linking") is None


def test_blank_turns_equal_sql(spark, tmp_path):
    turns = [(c, t, "ua"[t % 2], f"line {c} {t}\nmore of {t}") for c in range(3) for t in range(6)]
    blank = {(0, 1): " ", (0, 2): "\n ", (1, 2): None, (1, 3): "", (2, 0): " \nsecond line", (2, 3): " \t", (2, 5): ""}
    turns = [(c, t, r, blank.get((c, t), text)) for c, t, r, text in turns] + [(3, 0, "u", ""), (3, 1, "a", "x"), (3, 3, "u", "y")]
    path = str(tmp_path)
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").coalesce(1).write.parquet(f"{path}/all")
    next((tmp_path / "all").glob("part-*")).rename(tmp_path / "conversations.parquet")
    connection = duckdb.connect()
    connection.execute(f"create view conversations as select * from read_parquet('{path}/conversations.parquet')")
    result = connection.execute(queries.SQL["op10_quotation_linking"])
    columns = [d[0] for d in result.description]
    found = queries.QUERIES["op10_quotation_linking"](spark, path)
    assert as_bag(found.columns, found.collect()) == as_bag(columns, result.fetchall())


def test_weights_and_calibration_equal_a_direct_fit(spark):
    """Ridge by least squares on all stacked rows, the ridge by each fold's error, and calibration by a naive isotonic fit."""
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    model, stats = quality.trained(docs, labels)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(r.doc_id, r.stats) for r in stats.collect()]
    learned = [(zlib.crc32(str(i).encode()) % 5, marks[i], s) for i, s in rows if i in marks and zlib.crc32(str(i).encode()) % 5]
    fold, y, raw = (np.array(c, float) for c in zip(*learned))
    assert np.allclose(model.mean, raw.mean(axis=0)) and np.allclose(model.scale, np.maximum(raw.std(axis=0), 1e-6))
    x = model.features(raw)

    def solved(part, ridge):
        penalty = np.sqrt(np.r_[1e-9, np.full(x.shape[1] - 1, ridge)])
        return np.linalg.lstsq(np.vstack([x[part], np.diag(penalty)]), np.r_[y[part], np.zeros(len(penalty))], rcond=None)[0]

    errors = {r: sum(((x[fold == f] @ solved(fold != f, r) - y[fold == f]) ** 2).sum() for f in range(1, 5)) for r in quality.RIDGES}
    ridge = min(errors, key=errors.get)
    assert np.allclose(x @ model.weights, x @ solved(fold > 0, ridge), atol=1e-5)
    unseen = np.empty(len(y))
    for f in range(1, 5):
        unseen[fold == f] = x[fold == f] @ solved(fold != f, ridge)
    at = np.clip(((unseen + 0.5) / 2 * quality.BINS).astype(int), 0, quality.BINS - 1)
    bins = sorted(set(at))
    n, positive = (np.array([v[at == b].sum() for b in bins]) for v in (np.ones(len(y)), y))
    # isotonic: the largest mean from any start at or before, of the smallest mean to any end at or after
    mean = lambda a, b: positive[a : b + 1].sum() / n[a : b + 1].sum()
    naive = [max(min(mean(a, b) for b in range(k, len(bins))) for a in range(k + 1)) for k in range(len(bins))]
    knots, rates = quality.pooled(np.array([unseen[at == b].mean() for b in bins]), positive, n)
    step = np.repeat(rates, [sum(1 for v in naive if np.isclose(v, r)) for r in rates])
    assert np.allclose(step, naive)
    assert np.allclose(model.raw, knots, atol=1e-5) and np.allclose(model.calibrated, rates)


def test_native_operators_run_no_python(spark):
    for name in ("op9_licence_scan", "op10_quotation_linking"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


@pytest.fixture(scope="module")
def stages(spark):
    """Inputs and outputs of the pipeline's stages on the smallest tables, a repeated row and a null among them."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.unionByName(docs.limit(1)).unionByName(docs.selectExpr("null as doc_id", "null as text", "lang", "source", "n_chars").limit(1))
    found = []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        found.append((docs, out))
        docs = out
    return found


def test_stages_keep_the_columns(stages):
    for docs, out in stages[:-1]:
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


def test_quality_stage_takes_out_the_rejected(spark, stages):
    docs, out = stages[0]
    bad = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 0")
    kept = out.join(bad, "doc_id").count()
    assert kept <= 0.3 * bad.count() and out.count() > 0.8 * docs.count()


def test_near_dedup_stage_keeps_one_of_each_group(stages):
    docs, out = stages[1]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = {(i, t) for i, t in rows if any(i == k[0] and k[3] for k in fixtures.near_duplicates(rows))}
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(expected)


def test_near_dedup_stage_without_ids_that_tell_rows_apart(spark):
    a, b, c, d, e = fixtures.sentences(11, 5)
    near = fixtures.edited(c, 1, 0)
    rows = [(None, a), (None, a), (7, a), (None, a), (None, b), (None, b), (8, c), (8, near), (9, d), (9, e), (5, d)]
    rows += [(None, None), (None, None), (10, " "), (10, " "), (11, " "), (10, None)]
    found = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, fixtures.documents(spark, rows), "").collect())
    assert found[(8, c)] + found[(8, near)] == 1
    rest = [(7, a), (None, b), (5, d), (9, e), (None, None), (10, " "), (11, " "), (10, None)]
    assert found - Counter([(8, c), (8, near)]) == Counter(rest)


def test_substring_stage_takes_out_passages(stages):
    from .test_dedup import passages

    docs, out = stages[2]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = Counter((i, " ".join(k) if len(k) < len(w) else t) for (i, t), (_, w, k) in zip(rows, passages(rows)))
    found = out.collect()
    assert Counter((r.doc_id, r.text) for r in found) == expected
    assert all(r.n_chars == len(r.text) for r in found if r.text)


def test_packing_stage_holds_every_document(stages):
    from .test_tokens import check_packing

    docs, out = stages[3]
    assert check_packing([(r.doc_id, r.text) for r in docs.collect()], out.collect(), 1024) == 0


def test_session_settings_stay_as_they_were(spark):
    from linscore.llm.store import BATCHES, Store

    before = {key: spark.conf.get(key) for key in BATCHES}
    store = Store(spark, "settings")
    assert store.write("t", spark.range(3)).count() == 3
    assert {key: spark.conf.get(key) for key in BATCHES} == before
    store.drop("t")
