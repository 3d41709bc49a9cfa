import json
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linscore import classify, load_classifiers, postprocess, read_results, review_by_score, review_by_site_and_day
from linscore.operators.runs import run_counts, run_inputs
from linscore.plans.classify import by_classifier, classify_table, report_of
from linscore.registry import Classifier, ClassifierSet
from linscore.streaming.incremental import score_arriving, score_new_files, stream_embeddings
from linscore.operators.scoring import FileScoring, pack_features
from linscore.sources.sinks import merge_files, part_sizes, write_table
from linscore.sources.storage import by_scheme
from tests.test_sources import write_wide


def classifier(name="one", threshold=0.0, **settings):
    # features of row r of a file are r, r+1, r+2, r+3: scores are 4r + 6 - 10 and their negatives
    return Classifier(name, ["up", "down"], [[1, -1]] * 4, [-10, 10], [threshold] * 2, **settings)


@pytest.fixture
def tree(tmp_path):
    write_wide(tmp_path / "in" / "a.parquet", source="a")
    write_wide(tmp_path / "in" / "sub" / "b c.parquet", source="b", offset_type="int32")
    write_wide(tmp_path / "in" / "sub" / "odd[1]{x}.parquet", source="c", prefix="v", order=("source", "offset", "channel"))
    return tmp_path


def statuses(report):
    return {(r.input.rsplit("/", 1)[1], r.classifier): (r.status, r.rows) for r in report.collect()}


@pytest.mark.parametrize("output_format", ["parquet", "csv"])
def test_folder(spark, tree, output_format):
    both = ClassifierSet((classifier(), classifier("two", 5.0)))
    out = str(tree / "out")
    report = classify(spark, str(tree / "in"), out, both, output_format=output_format)
    outputs = {(r.input.rsplit("/", 1)[1], r.output) for r in report.collect()}
    assert outputs == {
        ("a.parquet", "a.csv"), ("b%20c.parquet", "sub/b c.csv"), ("odd%5B1%5D%7Bx%7D.parquet", "sub/odd[1]{x}.csv"),
    }
    found = read_results(spark, out).toPandas()
    wanted = [(s, r * 5.0, n, label) for s in "abc" for n, t in (("one", 0), ("two", 5)) for r in range(5)
              for label, score in (("up", 4 * r - 4), ("down", 4 - 4 * r)) if score >= t]
    assert sorted(zip(found.source, found.offset, found.classifier, found.label)) == sorted(wanted)
    assert report.agg({"rows": "sum"}).first()[0] == len(wanted)
    up = found[(found.source == "a") & (found.label == "up") & (found.classifier == "one")].set_index("offset").score
    assert up.to_dict() == {5.0: 0.0, 10.0: 4.0, 15.0: 8.0, 20.0: 12.0}


@pytest.mark.parametrize("output_format", ["parquet", "csv"])
def test_small_files_are_merged(spark, tree, output_format):
    def files_of(folder, name):
        return list((tree / "out" / folder).glob(f"run=*/classifier_path={name}/part-*"))

    both, out = ClassifierSet((classifier("007"), classifier("two", 5.0))), str(tree / "out")
    plain = str(tree / "plain")
    classify(spark, str(tree / "in"), plain, both, output_format=output_format)
    report = classify(spark, str(tree / "in"), out, both, output_format=output_format, spare_files=0)
    assert {r.folder for r in report.collect()} == {"merged"} and len(report_of(spark, plain).where("folder = 'detections'").head(1)) == 1
    assert [len(files_of("merged", n)) for n in ("007", "two")] == [1, 1] and not list((tree / "out" / "detections").rglob("classifier_path=*"))
    assert len(list((tree / "plain" / "detections").rglob("classifier_path=007/part-*"))) == 3
    found, wanted = (sorted(map(tuple, read_results(spark, o).collect())) for o in (out, plain))
    assert found == wanted and found
    # later runs skip what was merged, and a table in hand is merged alike
    again = classify(spark, str(tree / "in"), out, both, output_format=output_format, spare_files=0)
    assert {r.status for r in again.collect()} == {"skipped"}
    rows = spark.range(40).select(F.array_repeat(F.col("id").cast("float"), 4).alias("features")).repartition(8)
    classify_table(rows, both, out, spark, output_format, "in hand", spare_files=0)
    assert len(files_of("merged", "007")) == 2
    assert read_results(spark, out).where("input = 'in hand' and classifier = '007'").count() == 40


def test_large_classifiers_get_several_files(spark, tmp_path):
    rows = spark.range(400_000).select(F.rand(1).alias("x"), F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("part"))
    write_table(rows.repartition(40), str(tmp_path / "in"), "parquet", ["part"])
    written, sizes = spark.read.parquet(str(tmp_path / "in")), part_sizes(spark, str(tmp_path / "in"), "part")
    bytes_ = {r.part: (r.files, r.bytes) for r in sizes.collect()}
    assert {p: f for p, (f, _) in bytes_.items()} == {"a": 40, "b": 40}
    assert not merge_files(written, sizes, str(tmp_path / "out"), "parquet", "part", spare_files=80)
    assert merge_files(written, sizes, str(tmp_path / "out"), "parquet", "part", bytes_["a"][1] // 4 + 1, 10)
    assert [len(list((tmp_path / "out" / f"part={p}").glob("part-*"))) for p in "ab"] == [4, 1]
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(written).isEmpty()


def test_bad_inputs_do_not_stop_the_others(spark, tree):
    (tree / "in" / "broken.parquet").write_bytes(b"nothing of use")
    write_wide(tree / "in" / "short.parquet", dim=3)
    out = str(tree / "out")
    with pytest.raises(RuntimeError, match="2 inputs failed"):
        classify(spark, str(tree / "in"), out, classifier())
    assert sorted(r.source for r in read_results(spark, out).select("source").distinct().collect()) == ["a", "b", "c"]
    report = spark.read.parquet(f"{out}/report")
    assert {k[0]: v[0] for k, v in statuses(report).items()} == {
        "a.parquet": "ok", "b%20c.parquet": "ok", "odd%5B1%5D%7Bx%7D.parquet": "ok", "broken.parquet": "failed", "short.parquet": "failed",
    }
    assert tuple(run_inputs(report).first()) == (5, 3, 2)
    assert {r.status: r.n for r in run_counts(report).collect()} == {"ok": 3, "failed": 2}
    # a second run leaves the good ones alone and reports the bad ones again
    again = classify(spark, str(tree / "in"), out, classifier(), fail=False)
    assert {k[0]: v[0] for k, v in statuses(again).items()} == {
        "a.parquet": "skipped", "b%20c.parquet": "skipped", "odd%5B1%5D%7Bx%7D.parquet": "skipped", "broken.parquet": "failed", "short.parquet": "failed",
    }


def test_reruns_skip_replace_and_add(spark, tree):
    out = str(tree / "out")
    keep, redo = classifier("keep"), classifier("redo", skip_existing=False)
    classify(spark, str(tree / "in"), out, ClassifierSet((keep, redo)))
    before = read_results(spark, out).count()
    write_wide(tree / "in" / "new.parquet", source="d")
    time.sleep(0.01)
    report = statuses(classify(spark, str(tree / "in"), out, ClassifierSet((keep, redo)), output_format="csv"))
    assert report["a.parquet", "keep"] == ("skipped", 0) and report["a.parquet", "redo"] == ("ok", 6)
    assert report["new.parquet", "keep"] == ("ok", 6)
    assert read_results(spark, out).count() == before + 12


def test_empty_results(spark, tree):
    out, high = str(tree / "out"), 1e6
    pair = ClassifierSet((classifier("saved", high), classifier("unsaved", high, save_empty=False)))
    first = statuses(classify(spark, str(tree / "in"), out, pair))
    assert set(first.values()) == {("empty", 0)}
    assert read_results(spark, out).count() == 0
    second = statuses(classify(spark, str(tree / "in"), out, pair))
    assert second["a.parquet", "saved"][0] == "skipped" and second["a.parquet", "unsaved"][0] == "empty"


def test_single_file_manifest_and_config_file(spark, tree):
    config = tree / "config.json"
    config.write_text(json.dumps({"classes": ["up"], "beta": [[1]] * 4, "beta_bias": [-10], "name": "file"}))
    single = classify(spark, str(tree / "in" / "a.parquet"), str(tree / "one"), str(config))
    assert statuses(single) == {("a.parquet", "file"): ("ok", 4)}
    (tree / "list.json").write_text(json.dumps({"source": [str(tree / "in" / "a.parquet"), (tree / "in" / "sub" / "b c.parquet").as_uri(), str(tree / "gone.parquet")]}))
    listed = classify(spark, str(tree / "list.json"), str(tree / "two"), str(config), fail=False)
    assert {k[0]: v[0] for k, v in statuses(listed).items()} == {"a.parquet": "ok", "b%20c.parquet": "ok", "gone.parquet": "failed"}
    assert sorted(r.output for r in listed.collect()) == ["a.csv", "b c.csv", "gone.csv"]


def test_wrong_inputs(spark, tree):
    (tree / "empty").mkdir()
    with pytest.raises(RuntimeError, match="no parquet files"):
        classify(spark, str(tree / "empty"), str(tree / "out"), classifier())
    with pytest.raises(FileNotFoundError):
        classify(spark, str(tree / "none"), str(tree / "out"), classifier())
    with pytest.raises(FileNotFoundError):
        classify(spark, str(tree / "in"), str(tree / "out"), str(tree / "none.json"))
    with pytest.raises(ValueError, match="same output"):
        classify(spark, str(tree / "in"), str(tree / "out"), ClassifierSet((classifier("a b"), classifier("a_b"))))
    with pytest.raises(FileNotFoundError):
        read_results(spark, str(tree / "out"))


def test_by_classifier(spark):
    frame = pd.DataFrame({"source": ["s"], "channel": [1], "offset": [0.0], **{f"f{i}": [np.float32(5)] for i in range(4)}})
    both = load_classifiers([classifier(), classifier("two", 5.0)])
    parts = by_classifier(classify_table(frame, both, spark=spark), both)
    assert {name: part.collect()[0].score for name, part in parts.items()} == {"one": 10.0, "two": 10.0}


def test_stream_scores_each_file_once(spark, tree):
    schema = spark.read.parquet(str(tree / "in" / "a.parquet")).schema
    folder = tree / "in" / "arriving"
    write_wide(folder / "1.parquet", source="x")
    stream = stream_embeddings(spark, str(folder), schema, files_per_batch=1)

    def run():
        score_new_files(stream, classifier(), str(tree / "s_out"), str(tree / "s_state"), prepare=pack_features).awaitTermination()
        return spark.read.parquet(str(tree / "s_out")).count()

    assert [run(), run()] == [6, 6]
    write_wide(folder / "2.parquet", source="y", rows=3)
    assert run() == 6 + 4


CATALOG = [
    {"id": 1, "site_id": 10, "sites.name": "north", "regions.id": 5, "regions.name": "r", "recorded_date": "2024-01-01T00:59:50Z"},
    {"id": 2, "site_id": 20, "sites.name": "south", "recorded_date": "2024-01-02T00:00:00+10:00"},
    {"id": 3, "site_id": 20, "sites.name": "south", "recorded_date": "2024-01-03T00:00:00+10:00"},
]


@pytest.fixture
def results(tmp_path):
    (tmp_path / "results").mkdir()
    (tmp_path / "catalog.json").write_text(json.dumps(CATALOG))
    head = "source,channel,offset,label,score\n"
    (tmp_path / "results" / "1.csv").write_text(head + "x,1,0,frog,1.5\nx,1,5,frog,2.5\nx,1,15,frog,0.5\nx,1,5,owl,1\n")
    (tmp_path / "results" / "2.csv").write_text(head + "x,1,0,owl,3\nx,1,bad,owl,3\n")
    (tmp_path / "results" / "9.csv").write_text(head + "x,1,0,owl,3\n")
    return tmp_path


@pytest.mark.parametrize("split_by", [None, "site_id"])
def test_postprocess(spark, results, split_by):
    out = results / "out"
    tables = postprocess(
        spark, str(results / "catalog.json"), str(results / "results"), str(out), host="https://h", label_map="owl=bird", split_by=split_by
    )
    rows = {name: table.count() for name, table in tables.items()}
    assert rows == {
        "detections": 5, "detections_compact": 5, "max_per_hour": 4, "non_max": 1, "max_per_hour_compact": 4, "non_max_compact": 1,
        "max_per_hour_top": 4, "detection_counts": 5, "totals": 1, "rejected": 1, "missing_totals": 1, "missing_by_site": 1, "summary": 3,
    }
    summary = {r.site_name: r for r in tables["summary"].collect()}
    assert (summary[None].missing, summary[None].total_files, summary[None].counts) == (1, 3, {"bird": 2, "frog": 3})
    assert (summary["south"].missing, summary["south"].missing_dates, summary["south"].counts) == (1, ["2024-01-03"], {"bird": 1})
    assert (summary["north"].missing, summary["north"].missing_dates) == (0, None)
    assert spark.read.json(str(out / "summary")).count() == 3
    best = {(r.site_name, r.label, r.start_datetime): (r.score, r["count"]) for r in tables["max_per_hour"].collect()}
    assert best["north", "frog", "2024-01-01T00:59:55+00:00"] == (2.5, 2)
    assert best["north", "frog", "2024-01-01T01:00:05+00:00"] == (0.5, 1)
    assert tuple(tables["missing_totals"].first()) == (1, 3, 3)
    missing = tables["missing_by_site"].first()
    assert (missing.site_name, missing.missing_arids, missing.date) == ("south", [3], "2024-01-03")
    back = spark.read.option("header", True).csv(str(out / "detections"))
    assert back.count() == 5 and ("by_site_id" in back.columns) == (split_by == "site_id")
    counts = spark.read.option("header", True).csv(str(out / "detection_counts")).toPandas()
    assert counts[counts.level == "total"].set_index("label").n.to_dict() == {"bird": "2", "frog": "3"}


def test_scored_output_is_post_processed(spark, tree):
    (tree / "catalog.json").write_text(json.dumps(CATALOG))
    for k in (1, 2):
        write_wide(tree / "recordings" / f"{k}.parquet", rows=3)
    classify(spark, str(tree / "recordings"), str(tree / "scored"), classifier(), output_format="csv")
    scored = read_results(spark, str(tree / "scored"))
    tables = postprocess(spark, str(tree / "catalog.json"), str(tree / "scored"), str(tree / "reports"), host="https://h")
    assert tables["detections"].count() == scored.count() > 0
    assert {r.audio_recording_id for r in tables["detections"].collect()} == {1, 2}
    assert tuple(tables["missing_totals"].first()) == (1, 3, 2)
    in_hand = tables["detections"].select("audio_recording_id", F.col("start_offset_seconds").alias("offset"), "label", "score")
    again = postprocess(spark, str(tree / "catalog.json"), in_hand, str(tree / "again"), host="https://h")
    assert again["detections"].count() == scored.count()


def test_a_table_scored_again_loses_nothing(spark, tree):
    frame = pd.DataFrame({"source": ["s"], "channel": [1], "offset": [0.0], **{f"f{i}": [np.float32(5)] for i in range(4)}})
    out = str(tree / "table_out")
    classify_table(frame, classifier(), out, spark, "parquet")
    classify_table(frame, [classifier(), classifier("two", 5.0)], out, spark, "parquet")
    assert read_results(spark, out).count() == 2
    status = {(r.classifier, r.status) for r in report_of(spark, out).collect()}
    assert status == {("one", "ok"), ("one", "skipped"), ("two", "ok")}


def test_a_manifest_source_with_two_outputs(spark, tree):
    write_wide(tree / "recordings" / "7.parquet", rows=3)
    name = str(tree / "recordings" / "7.parquet")
    (tree / "two.json").write_text(json.dumps({"source": [name, name], "output": ["a.csv", "b.csv"]}))
    report = classify(spark, str(tree / "two.json"), str(tree / "two_out"), classifier())
    rows = {r.output: r.rows for r in report.collect()}
    assert rows.keys() == {"a.csv", "b.csv"} and len(set(rows.values())) == 1
    (tree / "same.json").write_text(json.dumps({"source": [name, str(tree / "in" / "a.parquet")], "output": ["a.csv", "a.csv"]}))
    with pytest.raises(ValueError, match="more than once"):
        classify(spark, str(tree / "same.json"), str(tree / "same_out"), classifier())


def test_postprocess_limits_and_filters(spark, results):
    run = lambda **o: postprocess(spark, str(results / "catalog.json"), str(results / "results"), str(results / "out"), host="https://h", **o)
    assert run(limit_catalog=1, include="frog,none")["detections"].count() == 3
    tables = run(limit_results=1, exclude=["frog"])
    assert tables["missing_totals"].first().missing_results_total == 2 and tables["detections"].count() == 1


def test_review_files(spark, tmp_path):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"id": range(400), "site_id": rng.integers(1, 5, 400), "score": rng.normal(1, 1, 400)})
    frame["start_datetime"] = [f"2024-01-{d:02d}T00:00:00+00:00" for d in rng.integers(1, 10, 400)]
    path = str(tmp_path / "predictions.csv")
    frame.to_csv(path, index=False)
    made = review_by_score(spark, path, 30, id_columns="id")
    assert made["sample"].count() == 30 and made["histogram"].count() == 10
    back = spark.read.option("header", True).csv(str(tmp_path / "predictions_score_uniform_binned_n30.csv"))
    assert back.columns == list(frame.columns) and back.count() == 30
    made = review_by_site_and_day(spark, path, max_items=12)
    assert made["sample"].count() == 12 and made["summary"].first()["min"] >= 0
    assert spark.read.option("header", True).csv(str(tmp_path / "predictions_stratified_n1.csv")).count() == 12


def test_names_of_inputs_stay_out_of_the_driver(spark, tmp_path, monkeypatch):
    """A tree of some hundred files is listed, checked, scored and reported while the driver sees a handful of rows at a time."""
    for k in range(300):
        write_wide(tmp_path / "many" / f"d{k % 7}" / f"e{k % 3}" / f"{k}.parquet", source=str(k), rows=2)
    named = [str(tmp_path / "many" / f"d{k % 7}" / f"e{k % 3}" / f"{k}.parquet") for k in range(0, 300, 2)]
    lines = [json.dumps({"source": named[i : i + 10], "output": [f"{i + j}.csv" for j in range(len(named[i : i + 10]))]}) for i in range(0, len(named), 10)]
    (tmp_path / "lines.json").write_text("\n".join(lines))
    kind = type(spark.range(0))
    collect, seen = kind.collect, []
    monkeypatch.setattr(kind, "collect", lambda self: (rows := collect(self), seen.append(len(rows)))[0])
    monkeypatch.setattr(kind, "inputFiles", lambda self: pytest.fail("names go through the driver"))
    report = classify(spark, str(tmp_path / "many"), str(tmp_path / "out"), classifier())
    assert tuple(run_inputs(report).first()) == (300, 300, 0)
    report = classify(spark, str(tmp_path / "lines.json"), str(tmp_path / "out2"), classifier())
    assert report.count() == 150 and max(seen) <= 8


def test_unusable_rows_are_counted(spark, tmp_path):
    rows = [("s", 1, 0.0, [4.0] * 4), ("s", 1, 5.0, None), ("s", 1, 10.0, [1.0] * 3), ("s", 1, 15.0, [None, 4.0, 4.0, 4.0]), ("s", 1, 20.0, [0.0] * 4)]
    packed = spark.createDataFrame(rows, "source string, channel bigint, offset double, features array<double>").coalesce(1)
    packed.write.parquet(str(tmp_path / "in" / "a"))
    packed.where("offset in (5, 10)").write.parquet(str(tmp_path / "in" / "none"))
    packed.limit(0).write.parquet(str(tmp_path / "in" / "empty"))
    for output_format in ("parquet", "csv"):
        out = str(tmp_path / output_format)
        report = classify(spark, str(tmp_path / "in"), out, classifier(), fail=False, output_format=output_format)
        found = {r.output.split("/")[0]: (r.status, r.rows, r.unusable, r.error) for r in report.collect()}
        assert found == {"a": ("ok", 2, 2, None), "none": ("failed", 0, None, "no row has usable features"), "empty": ("empty", 0, 0, None)}
        assert sorted((r.offset, r.label) for r in read_results(spark, out).collect()) == [(0.0, "up"), (20.0, "down")]
    classify_table(packed, classifier(), str(tmp_path / "table"), spark, "parquet")
    assert [(r.rows, r.unusable) for r in report_of(spark, str(tmp_path / "table")).collect()] == [(2, 2)]


def test_a_file_that_breaks_while_it_is_read_fails_alone(spark, tree):
    path = tree / "in" / "sub" / "b c.parquet"
    footer = path.read_bytes()
    path.write_bytes(footer[:4] + b"\0" * 300 + footer[304:])
    report = classify(spark, str(tree / "in"), str(tree / "out"), classifier(), fail=False)
    assert statuses(report)["b%20c.parquet", "one"] == ("failed", 0)
    assert {r.source for r in read_results(spark, str(tree / "out")).collect()} == {"a", "c"}


def test_only_open_pairs_are_scored(spark, tree):
    pair = ClassifierSet((classifier("one"), classifier("two")))
    scoring = FileScoring(spark, pair, lambda name: name)
    file = (tree / "in" / "a.parquet").as_uri()
    work = spark.createDataFrame([(file, 0, [1])], "input string, group int, open array<int>")
    found = scoring.detections(work, by_scheme())
    assert {(r.classifier, r.classifier_path) for r in found.collect()} == {("two", "two"), (None, "inputs.")}
    assert [(r.channel, r.offset, r.label) for r in found.where("classifier is null").collect()] == [(5, 0.0, None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    scoring.close()


def test_unknown_storage_is_an_error_at_once(spark, tree):
    (tree / "far.json").write_text(json.dumps({"source": [str(tree / "in" / "a.parquet"), "odd://bucket/x.parquet"]}))
    for path in ("odd://bucket/in", str(tree / "far.json")):
        with pytest.raises(ValueError, match="odd"):
            classify(spark, path, str(tree / "out"), classifier())
    assert not (tree / "out").exists()

    def find(uri):
        from pyarrow import fs

        return fs.LocalFileSystem(), uri.replace("odd://bucket", folder).removeprefix("file:").replace("%20", " ").replace("%5B", "[").replace("%5D", "]").replace("%7B", "{").replace("%7D", "}")

    folder = str(tree)
    report = classify(spark, "odd://bucket/in", str(tree / "out"), classifier(), file_systems=find)
    assert report.count() == 3 and set(run_counts(report).first()) == {"ok", 3}


def test_arriving_files_are_checked_and_a_repeated_batch_replaces_itself(spark, tree):
    folder, out, state = tree / "in", str(tree / "s_out"), tree / "s_state"
    (folder / "broken.parquet").write_bytes(b"nothing of use")
    write_wide(folder / "short.parquet", dim=3)

    def run():
        score_arriving(spark, str(folder), out, classifier(), str(state), files_per_batch=2).awaitTermination()
        return {k[0]: v for k, v in statuses(report_of(spark, out)).items()}

    first = run()
    assert first == {
        "a.parquet": ("ok", 6), "b%20c.parquet": ("ok", 6), "odd%5B1%5D%7Bx%7D.parquet": ("ok", 6), "broken.parquet": ("failed", 0), "short.parquet": ("failed", 0),
    }
    assert run() == first and read_results(spark, out).count() == 18
    bad = spark.read.parquet(f"{out}/quarantine")
    assert {r.input.rsplit("/", 1)[1] for r in bad.collect()} == {"broken.parquet", "short.parquet"}
    # the last batch was written, but its commit was lost
    last = max((p for p in (state / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (state / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == first and read_results(spark, out).count() == 18 and report_of(spark, out).count() == 5
    # mended by then: a run over the folder takes it up, the sound ones are left alone
    write_wide(folder / "short.parquet", source="s")
    report = statuses(classify(spark, str(folder), out, classifier(), fail=False))
    assert report["short.parquet", "one"] == ("ok", 6) and report["a.parquet", "one"] == ("skipped", 0)
    assert read_results(spark, out).count() == 24
