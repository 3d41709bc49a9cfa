import json

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from linscore.operators.manifest import build_manifest, collisions
from linscore.sources import files, sinks, tables


def write_wide(path, rows=5, dim=4, source="s", offset_type="float64", order=("source", "channel", "offset"), prefix="feature_"):
    path.parent.mkdir(parents=True, exist_ok=True)
    columns = {"source": [source] * rows, "channel": [1] * rows, "offset": pd.Series(range(0, rows * 5, 5)).astype(offset_type)}
    columns = {name: columns[name] for name in order if name in columns}
    columns |= {f"{prefix}{i}": pd.Series([float(i + r) for r in range(rows)]).astype("float32") for i in range(dim)}
    pq.write_table(pa.table(columns), path)


def test_listing_is_recursive_and_by_name(spark, tmp_path):
    for name in ("a.parquet", "sub/b.parquet", "sub/deep/c.parquet", "sub/d.csv"):
        write_wide(tmp_path / name)
    found = sorted(r.input for r in files.list_files(spark, str(tmp_path), "*.parquet").collect())
    assert found == [files.as_uri(str(tmp_path / n)) for n in ("a.parquet", "sub/b.parquet", "sub/deep/c.parquet")]


def test_footers_tell_good_from_bad(spark, tmp_path):
    write_wide(tmp_path / "good one.parquet", rows=7)
    write_wide(tmp_path / "short.parquet", dim=3)
    write_wide(tmp_path / "lacking.parquet", order=("source", "offset"))
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 this is no parquet")
    pq.write_table(pa.table({"source": ["s"], "channel": [1], "offset": [0], "features": pa.array([[1.0]], pa.list_(pa.float32()))}), tmp_path / "packed.parquet")
    gone = spark.createDataFrame([(files.as_uri(str(tmp_path / "gone.parquet")),)], "input string")
    footers = files.parquet_footers(files.list_files(spark, str(tmp_path), "*.parquet").select("input").union(gone))
    found = {r.input.rsplit("/", 1)[1]: r for r in files.check_footers(footers, 4).collect()}
    assert found["good%20one.parquet"].error is None and found["good%20one.parquet"].rows == 7
    assert found["short.parquet"].error == "3 feature columns found, the classifiers expect 4"
    assert found["lacking.parquet"].error == "lacks channel"
    assert found["packed.parquet"].error is None and found["packed.parquet"].features is None
    assert found["broken.parquet"].error and found["gone.parquet"].error
    assert len({r.layout for r in found.values() if r.layout}) == 4


def test_embeddings_are_packed_by_position(spark, tmp_path):
    write_wide(tmp_path / "x" / "odd.parquet", rows=2, order=("source", "offset", "channel"), prefix="v.")
    rows = files.read_embeddings(spark, str(tmp_path / "x")).orderBy("offset").collect()
    assert [r.features for r in rows] == [[0.0, 1.0, 2.0, 3.0], [1.0, 2.0, 3.0, 4.0]]
    assert rows[0].input == files.as_uri(str(tmp_path / "x" / "odd.parquet"))


def test_detections_take_their_recording_from_the_file(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "12.csv").write_text('"source","channel","offset","label","score"\n"a.wav",1,0,"frog",1.5\n"a.wav",1,5,"owl, barn",2\n')
    (tmp_path / "deep" / "013.csv").write_text("source,channel,offset,label,score\nb.wav,1,10,frog,0.25\n")
    (tmp_path / "14.csv").write_text("source,channel,offset,label,score\n")
    (tmp_path / "notes.csv").write_text("source,channel,offset,label,score\nc.wav,1,0,frog,9\n")
    rows = tables.read_detections(spark, str(tmp_path)).collect()
    assert sorted((r.audio_recording_id, r.offset, r.label, r.score) for r in rows) == [
        (12, "0", "frog", "1.5"), (12, "5", "owl, barn", "2"), (13, "10", "frog", "0.25"),
    ]
    done = tables.completed_recordings(files.list_files(spark, str(tmp_path), "*.csv"))
    assert sorted(r.audio_recording_id for r in done.collect()) == [12, 13, 14]


def test_detections_are_read_by_each_files_own_header(spark, tmp_path):
    (tmp_path / "1.csv").write_text("source,channel,offset,label,score\na.wav,7,0,frog,1.5\n")
    (tmp_path / "2.csv").write_text("source,offset,channel,label,score\nb.wav,5,8,frog,2\n")
    (tmp_path / "3.csv").write_text("score,label,offset\n3,owl,10\n")
    frame = pd.DataFrame({"source": ["c"], "channel": [1], "offset": [15], "label": ['say "hi", you'], "score": [4.0]})
    frame.to_csv(tmp_path / "4.csv", index=False)
    rows = {r.audio_recording_id: r for r in tables.read_detections(spark, str(tmp_path)).collect()}
    assert {k: (r.channel, r.offset, r.label, r.score) for k, r in rows.items()} == {
        1: ("7", "0", "frog", "1.5"), 2: ("8", "5", "frog", "2"), 3: (None, "10", "owl", "3"), 4: ("1", "15", 'say "hi", you', "4.0"),
    }


def test_one_dialect_both_ways(spark, tmp_path):
    texts = ['say "hi", you', "two\nlines", " blanks ", "", None, "back\\slash", "\\", 'ends with "', "cr\r\nlf", "plain"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    sinks.write_table(rows, str(tmp_path / "out"), "csv")
    back = tables.read_predictions(spark, str(tmp_path / "out"), "id int, text string", multiline=True)
    assert sorted(tuple(r) for r in back.collect()) == list(enumerate(texts))
    frames = [pd.read_csv(p, keep_default_na=False) for p in (tmp_path / "out").glob("part-*")]
    seen = dict(pd.concat(frames).itertuples(index=False))
    assert {i: t or "" for i, t in enumerate(texts)} == {i: t.replace("\r\n", "\n") if i != 8 else t for i, t in seen.items()}
    pd.DataFrame({"id": range(9), "text": texts[:4] + texts[5:]}).to_csv(tmp_path / "pandas.csv", index=False)
    found = tables.read_predictions(spark, str(tmp_path / "pandas.csv"), "id int, text string", multiline=True)
    assert [r.text or "" for r in found.orderBy("id").collect()] == texts[:4] + texts[5:]


def test_catalog(spark, tmp_path):
    rows = [
        {"id": 1, "site_id": 2, "sites.name": "a", "regions.id": 3, "regions.name": "r", "recorded_date": "2024-01-01T00:00:00Z"},
        {"id": 4, "site_id": 5, "sites.name": "b", "recorded_date": "2024-01-01T00:00:00Z"},
    ]
    (tmp_path / "list.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    for name, multiline in (("list.json", True), ("lines.json", False)):
        found = tables.read_catalog(spark, str(tmp_path / name), multiline).orderBy("id").collect()
        assert [r.asDict() for r in found] == [
            {"id": 1, "site_id": 2, "site_name": "a", "region_id": 3, "region_name": "r", "recorded_date": rows[0]["recorded_date"]},
            {"id": 4, "site_id": 5, "site_name": "b", "region_id": None, "region_name": None, "recorded_date": rows[1]["recorded_date"]},
        ]


def test_manifests(spark, tmp_path):
    def read(document, **options):
        path = tmp_path / f"{len(list(tmp_path.iterdir()))}.json"
        path.write_text(document if isinstance(document, str) else json.dumps(document))
        return [tuple(r) for r in tables.read_manifest(spark, str(path), **options).collect()]

    assert read({"source": ["x", "y"], "output": ["1", "2"]}) == [("x", "1"), ("y", "2")]
    assert read({"source": ["x"]}) == [("x", None)]
    assert read('{"source": ["x"]}\n{"source": ["y"], "output": ["2"]}', multiline=False) == [("x", None), ("y", "2")]
    for wrong in ({"source": []}, {"output": ["1"]}, {"source": ["x"], "output": []}, {"source": ["x"], "output": ["1", "2"]}, "{ no json"):
        with pytest.raises(Exception):
            read(wrong)


def test_manifest_inputs(spark):
    rows = spark.createDataFrame([("https://h:1/a/b.parquet?x=1", None), ("https://h/c", "given.csv")], "source string, output string")
    assert [tuple(r) for r in tables.manifest_inputs(rows, {"token": "t"}).collect()] == [
        ("https://h:1/a/b.parquet?x=1&token=t", "h_1/a/b.csv"), ("https://h/c?token=t", "given.csv"),
    ]
    with pytest.raises(Exception, match="no host"):
        tables.manifest_inputs(spark.createDataFrame([("b.parquet", None)], rows.schema)).collect()


def test_build_manifest(spark):
    catalog = spark.createDataFrame(
        [(7, 1, "North Creek", 2, "Big Hills"), (3, 1, "North Creek", None, None)], "id bigint, site_id bigint, site_name string, region_id bigint, region_name string"
    )
    made = build_manifest(catalog, "https://h", 3, "emb").collect()
    assert [tuple(r) for r in made] == [
        ("https://h/analysis_jobs/3/results/7/emb/embeddings.parquet", "big_hills_2/north_creek_1/7.csv"),
        ("https://h/analysis_jobs/3/results/3/emb/embeddings.parquet", "north_creek_1/3.csv"),
    ]
    assert [r.output for r in build_manifest(catalog, "https://h", 3, "emb", limit=1).collect()] == ["north_creek_1/3.csv"]
    doubled = build_manifest(catalog.union(catalog), "https://h", 3, "emb")
    assert collisions(doubled, "output").count() == 2


def test_split_sink(spark, tmp_path):
    df = spark.range(300).select("id", (F.col("id") % 3).alias("site_id"), F.lit(None).cast("string").alias("note"))
    sinks.write_split(df, str(tmp_path / "many"))
    sinks.write_split(df, str(tmp_path / "few"), None)
    assert sorted(p.name for p in (tmp_path / "many").glob("by_site_id=*")) == [f"by_site_id={i}" for i in range(3)]
    for name in ("many", "few"):
        back = spark.read.option("header", True).csv(str(tmp_path / name)).select(*df.columns)
        assert sorted(int(r.id) for r in back.collect()) == list(range(300))
    with pytest.raises(ValueError):
        sinks.write_table(df, str(tmp_path / "x"), "xml")


def test_json_lines_keep_nulls(spark, tmp_path):
    sinks.write_json_lines(spark.createDataFrame([(1, None)], "a int, b string").coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    assert json.loads(part.read_text()) == {"a": 1, "b": None}


def test_work_folder_of_one_machine_is_refused_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from linscore.session import shared_folder

    def session(master, conf, checkpoint=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *d: conf.get(key, *d)), sparkContext=context)

    local, far = {"spark.sql.warehouse.dir": "file:/w"}, {"spark.sql.warehouse.dir": "hdfs://n/w"}
    assert shared_folder(session("local[8]", local)) == "file:/w/linscore-work"
    assert shared_folder(session("yarn", far)) == "hdfs://n/w/linscore-work"
    assert shared_folder(session("yarn", local, "file:/mnt/shared/")) == "file:/mnt/shared"
    assert shared_folder(session("yarn", local | {"spark.checkpoint.dir": "s3a://b/c"})) == "s3a://b/c"
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,100]"):
        with pytest.raises(RuntimeError, match="checkpoint.dir"):
            shared_folder(session(master, local))
