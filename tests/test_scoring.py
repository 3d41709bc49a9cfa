import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linscore import classify_dataframe, classify_table, read_results
from linscore.operators.scoring import pack_features, rejected_rows, score, with_times
from linscore.registry import NO_THRESHOLD, Classifier, ClassifierSet

DIM, ROWS = 20, 300


def classifier(name="one", classes=3, threshold=0.0, seed=1, dim=DIM):
    rng = np.random.default_rng(seed)
    return Classifier(
        name, [f"k{i}" for i in range(classes)], rng.standard_normal((dim, classes)), rng.standard_normal(classes), [threshold] * classes
    )


@pytest.fixture(scope="module")
def wide():
    rng = np.random.default_rng(42)
    frame = pd.DataFrame({"source": [f"f{i % 7}.wav" for i in range(ROWS)], "offset": np.arange(ROWS, dtype="int32") * 5})
    frame["channel"] = np.arange(ROWS, dtype="int64") % 2 + 1
    features = pd.DataFrame(rng.standard_normal((ROWS, DIM)).astype("f4"), columns=[f"feature_{i}" for i in range(DIM)])
    return pd.concat([frame, features], axis=1)


def expected(wide, classifiers):
    """Numpy twin: all passing (source, channel, offset, classifier, label, score)."""
    matrix = wide.iloc[:, 3:].to_numpy("f8")
    rows = []
    for c in classifiers:
        scores = (matrix @ c.weights.astype("f8") + c.bias).astype("f4")
        for i, k in zip(*np.nonzero(scores >= c.thresholds)):
            r = wide.iloc[i]
            rows.append((r.source, int(r.channel), int(r.offset), c.name, c.labels[k], float(scores[i, k])))
    return sorted(rows)


def got(df):
    return sorted((r.source, r.channel, int(r.offset), r.classifier, r.label, r.score) for r in df.collect())


@pytest.mark.parametrize("engine", ["arrow", "sql"])
@pytest.mark.parametrize("threshold", [0.0, 2.5, NO_THRESHOLD])
def test_equals_numpy(spark, wide, engine, threshold):
    both = ClassifierSet((classifier(threshold=threshold), classifier("two", 2, threshold, 5)))
    found = score(pack_features(spark.createDataFrame(wide)), both, engine=engine)
    assert [f.dataType.simpleString() for f in found.schema][-3:] == ["string", "string", "float"]
    found, wanted = got(found), expected(wide, both)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    np.testing.assert_allclose([r[5] for r in found], [r[5] for r in wanted], atol=1e-6)


def test_blocks_of_classes_and_chunks_of_rows_change_nothing(spark, wide, monkeypatch):
    both = ClassifierSet((classifier(classes=5), classifier("two", 4, seed=5)))
    monkeypatch.setattr("linscore.operators.scoring.SCORES_PER_CHUNK", 50)
    packed = pack_features(spark.createDataFrame(wide))
    assert got(score(packed, both, broadcast_bytes=4 * DIM * 2)) == got(score(packed, both)) == expected(wide, both)


def test_threshold_is_inclusive(spark):
    weights = Classifier("w", ["a", "b"], [[1.0, 1.0]], [0.0, 0.0], [0.1, np.nextafter(np.float32(0.1), np.float32(1))])
    rows = spark.createDataFrame([(1, [0.1])], "id int, features array<float>")
    for engine in ("arrow", "sql"):
        assert [r.label for r in score(rows, weights, engine=engine).collect()] == ["a"]


def test_missing_and_special_features(spark):
    inf, nan = float("inf"), float("nan")
    rows = spark.createDataFrame(
        [(1, [1.0, None]), (2, [1.0, nan]), (3, None), (4, [1.0]), (5, [1.0, 2.0, 3.0]), (6, [inf, 0.0]), (7, [-inf, 0.0]), (8, [1.0, 1.0])],
        "id int, features array<float>",
    )
    plain = Classifier("w", ["a"], [[1.0], [1.0]], [0.0], [NO_THRESHOLD])
    for engine in ("arrow", "sql"):
        assert sorted(r.id for r in score(rows, plain, engine=engine).collect()) == [6, 8]
    assert sorted(r.id for r in rejected_rows(rows, ClassifierSet((plain,))).collect()) == [3, 4, 5]


def test_nan_threshold_passes_nothing(spark):
    rows = spark.createDataFrame([(1, [1.0])], "id int, features array<float>")
    never = Classifier("w", ["a"], [[1.0]], [0.0], [np.nan])
    for engine in ("arrow", "sql"):
        assert score(rows, never, engine=engine).count() == 0


def test_empty_results_keep_their_columns(spark, wide):
    packed = pack_features(spark.createDataFrame(wide))
    none = score(packed, classifier(threshold=1e9))
    assert none.count() == 0 and none.columns == ["source", "channel", "offset", "classifier", "label", "score"]
    assert score(packed, ClassifierSet(())).columns == none.columns


def test_tables_in_hand(spark, wide):
    one = classifier()
    wanted = expected(wide, [one])
    assert got(classify_dataframe(wide, one, spark=spark)) == wanted
    assert got(classify_table(pa.Table.from_pandas(wide, preserve_index=False), one, spark=spark)) == wanted
    assert got(classify_table(spark.createDataFrame(wide), one)) == wanted
    with pytest.raises(TypeError):
        classify_dataframe(pa.Table.from_pandas(wide), one)
    with pytest.raises(TypeError):
        classify_table([1, 2], one)


def test_dims_and_metadata_are_checked(spark, wide):
    frame = spark.createDataFrame(wide)
    with pytest.raises(ValueError, match=f"{DIM} feature columns"):
        classify_table(frame, classifier(dim=DIM + 1))
    with pytest.raises(ValueError, match="channel"):
        classify_table(frame.drop("channel"), classifier())


def test_features_of_other_types_and_names(spark):
    frame = spark.createDataFrame([("s", 1, 0.0, 1, 2.5)], "source string, channel int, offset double, `a b` int, `x.y``z` double")
    assert pack_features(frame).first().features == [1.0, 2.5]


def test_output_by_classifier(spark, wide, tmp_path):
    both = ClassifierSet((classifier("first one"), classifier("two", 2, seed=5)))
    found = classify_table(spark.createDataFrame(wide), both, str(tmp_path / "out"))
    written = (tmp_path / "out" / "detections").glob("run=*/classifier_path=*")
    assert {p.name for p in written} == {"classifier_path=first_one", "classifier_path=two"}
    assert read_results(spark, str(tmp_path / "out")).count() == found.count()


def test_engine_limits(spark, wide):
    packed = pack_features(spark.createDataFrame(wide))
    with pytest.raises(ValueError):
        score(packed, classifier(), engine="other")
    with pytest.raises(ValueError):
        score(packed, classifier(classes=4000), engine="sql")


def test_times(spark):
    found = spark.createDataFrame([("s", 10.0, "a", 1.0)], "source string, offset double, label string, score float")
    row = with_times(found, 77).first().asDict()
    assert row == {
        "source": "s", "start_time_seconds": 10.0, "label": "a", "score": 1.0, "audio_recording_id": 77, "end_time_seconds": 15.0,
    }
    assert with_times(found, F.lit(5)).first().audio_recording_id == 5


def test_no_shuffle_and_no_join(spark, wide, tmp_path):
    spark.createDataFrame(wide).write.parquet(str(tmp_path / "w"))
    stored = spark.read.parquet(str(tmp_path / "w")).where("channel = 1")
    for engine in ("arrow", "sql"):
        plan = score(pack_features(stored), classifier(), engine=engine)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
        assert "PushedFilters: [IsNotNull(channel), EqualTo(channel,1)]" in plan
