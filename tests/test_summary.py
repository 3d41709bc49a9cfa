import numpy as np
import pytest

from linscore.operators import summary as M

CASES = {
    "normal": np.random.default_rng(1).normal(0, 3, 2001),
    "hot value": np.concatenate([np.zeros(700), np.random.default_rng(2).normal(0, 1, 1300)]),
    "wide": np.concatenate([np.random.default_rng(3).lognormal(0, 20, 500), [-1e300, 1e300]]),
    "tiny": np.array([1e-12, 2e-12, -3e-12, 5e-12]),
    "few": np.array([3.0, 1.0]),
    "one": np.array([0.1]),
    "same": np.full(30, 0.1),
    "float32": np.random.default_rng(4).normal(0, 1, 999).astype("f4").astype("f8"),
}


@pytest.mark.parametrize("name", ["normal", "hot value", "float32", "same"])
def test_quantiles_in_finer_parts(spark, monkeypatch, name):
    monkeypatch.setattr(M, "RANKED", 3)
    monkeypatch.setattr(M, "PARTS", 4)
    df = spark.createDataFrame([(float(v),) for v in CASES[name]], "score double").repartition(3)
    found = [r.value for r in M.score_quantiles(df).collect()]
    np.testing.assert_allclose(found, np.quantile(CASES[name], M.QUANTILES), rtol=1e-12, atol=1e-15)


@pytest.mark.parametrize("name", CASES)
def test_against_numpy(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(float(v),) for v in [*values, np.nan, np.inf]] + [(None,)], "score double").repartition(3)
    found = {r.quantile: r.value for r in M.score_quantiles(df).collect()}
    wanted = np.quantile(values, M.QUANTILES)
    assert list(found) == list(M.QUANTILES)
    np.testing.assert_allclose(list(found.values()), wanted, rtol=1e-12, atol=1e-15)
    row = M.score_summary(df).first()
    assert (row["count"], row["min"], row["max"]) == (len(values), values.min(), values.max())
    if name != "wide":
        counts, edges = np.histogram(values, bins=10)
        bins = M.score_histogram(df).collect()
        assert [r["count"] for r in bins] == counts.tolist()
        np.testing.assert_allclose([r.low for r in bins] + [bins[-1].high], edges)


def test_text_scores_and_no_scores(spark):
    df = spark.createDataFrame([("1",), ("x",), ("3",)], "score string")
    assert M.score_summary(df).first()["mean"] == 2.0
    assert [r.value for r in M.score_quantiles(df, [0.5]).collect()] == [2.0]
    none = df.where("score = 'x'")
    assert M.score_quantiles(none).count() == 0 and M.score_histogram(none).count() == 0
    assert M.score_quantiles(none, exact=False).count() == 0
    assert M.score_summary(none).first()["count"] == 0
    with pytest.raises(ValueError):
        M.score_histogram(df, 0)


def test_approximate(spark):
    df = spark.range(1001).selectExpr("cast(id as double) as score")
    assert {r.quantile: r.value for r in M.score_quantiles(df, [0.5, 0.9], exact=False).collect()} == {0.5: 500, 0.9: 900}


def test_report(spark):
    df = spark.createDataFrame([(0.5,), (1.5,)], "score double")
    report = M.score_distribution(df, bins=2)
    assert [r["count"] for r in report["histogram"].collect()] == [1, 1]
    assert report["summary"].first()["count"] == 2 and report["quantiles"].count() == 5
