import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linscore.operators import sampling as S


def naive_quotas(sizes, n):
    got, left = dict.fromkeys(sizes, 0), n
    while left and any(got[b] < sizes[b] for b in sizes):
        for b in sorted(sizes):
            if left and got[b] < sizes[b]:
                got[b] += 1
                left -= 1
    return got


def test_quotas_are_those_of_taking_turns():
    rng = random.Random(5)
    for _ in range(300):
        sizes = {b: rng.randrange(1, 30) for b in rng.sample(range(10), rng.randrange(1, 10))}
        n = rng.randrange(0, 120)
        assert S.round_robin_quotas(sizes, n) == naive_quotas(sizes, n)
    assert S.round_robin_quotas({0: 10**12, 1: 5}, 10**9) == {0: 10**9 - 5, 1: 5}


@pytest.fixture(scope="module")
def scored(spark):
    """Scores crowded in one place, with every kind of value that is no score."""
    rng = random.Random(11)
    rows = [(i, str(round(rng.gauss(0, 1), 4))) for i in range(3000)]
    rows += [(3000 + i, text) for i, text in enumerate(["x", "", "NaN", "inf", "-inf", None, "9.5", "-7.25"])]
    return spark.createDataFrame(rows, "id bigint, score string").repartition(4)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_cap(spark):
    df = spark.range(5000)
    one = ids(S.sample_max_items(df, 700))
    assert len(one) == 700 == len(set(one)) and set(one) <= set(range(5000))
    assert one == ids(S.sample_max_items(df.repartition(13), 700))
    assert one != ids(S.sample_max_items(df, 700, seed=43))
    assert S.sample_max_items(df, 5000) is df and S.sample_max_items(df, 9000) is df
    with pytest.raises(ValueError):
        S.sample_max_items(df, 0)


def test_cap_is_even(spark):
    df = spark.range(200)
    hits = Counter(i for seed in range(40) for i in ids(S.sample_max_items(df, 50, seed)))
    assert len(hits) == 200 and sum(hits.values()) == 2000
    assert 1 <= min(hits.values()) and max(hits.values()) <= 22


def test_cap_takes_the_smallest_draws(spark):
    df = spark.range(3000)
    drawn = df.select("id", S.draw_hash(42, ["id"]).alias("d")).collect()
    for n in (1, 2, 17, 400, 2999):
        wanted = sorted(r.id for r in sorted(drawn, key=lambda r: r.d)[:n])
        assert ids(S.sample_max_items(df, n, id_columns=["id"])) == wanted


def test_copies_are_drawn_one_by_one(spark):
    # two thirds of all rows are copies of one row: they get their share of the sample, no more
    rows = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("id"), F.lit(1.0).alias("score"))
    for sample in (S.sample_max_items(rows, 600), S.sample_by_score_bins(rows, 600)):
        drawn = Counter(ids(sample))
        assert sum(drawn.values()) == 600 and 340 < drawn.pop(-1) < 460
        assert set(drawn.values()) == {1}


def test_ids_that_do_not_tell_rows_apart_are_an_error(spark):
    rows = spark.range(30_000).select(F.lit(1.0).alias("score"), "id")
    with pytest.raises(ValueError, match="apart"):
        S.sample_max_items(rows, 600, id_columns=["score"])


@pytest.mark.parametrize("copies", [2, 900, 2000])
def test_one_id_that_repeats_is_an_error_at_every_size(spark, copies):
    # the copies' draw is among the smallest, so that the sample meets it whatever their number
    seed = 42
    first = spark.range(3000).select("id", S.draw_hash(seed, ["id"]).alias("d")).orderBy("d").first().id
    rows = spark.range(3000).union(spark.range(copies - 1).select(F.lit(first).alias("id"))).withColumn("score", F.lit(0.5))
    for drawn in (lambda: S.sample_max_items(rows, 30, seed, ["id"]), lambda: S.sample_by_score_bins(rows, 30, seed=seed, id_columns=["id"])):
        with pytest.raises(ValueError, match="apart"):
            drawn()


@pytest.mark.parametrize("n", [1, 9, 100, 1500])
def test_bins(scored, n):
    sample = S.sample_by_score_bins(scored, n, id_columns=["id"])
    assert sample.columns == scored.columns
    rows = sample.collect()
    assert len(rows) == n == len({r.id for r in rows})
    values = pd.Series({r.id: float(r.score) for r in scored.where("id < 3000 or id > 3005").collect()})
    edges = np.linspace(values.min(), values.max(), 11)
    bins = pd.cut(values, edges, include_lowest=True, labels=False)
    sizes = bins.value_counts().to_dict()
    taken = Counter(bins[r.id] for r in rows)
    assert dict(taken) == {b: k for b, k in naive_quotas(sizes, n).items() if k}


def test_bins_edges_of_use(spark, scored):
    assert ids(S.sample_by_score_bins(scored, 3002, id_columns=["id"])) == [*range(3000), 3006, 3007]
    assert S.sample_by_score_bins(scored, 10**6).count() == 3002
    flat = spark.range(50).withColumn("score", F.lit(0.5))
    assert len(set(ids(S.sample_by_score_bins(flat, 7)))) == 7
    same = ids(S.sample_by_score_bins(scored, 40, seed=1, id_columns=["id"]))
    assert same == ids(S.sample_by_score_bins(scored.repartition(9), 40, seed=1, id_columns=["id"]))
    assert same != ids(S.sample_by_score_bins(scored, 40, seed=2, id_columns=["id"]))
    for bad in ({"n": 0}, {"n": 1, "bins": 0}, {"n": 1, "score_column": "none"}):
        with pytest.raises(ValueError):
            S.sample_by_score_bins(scored, **bad)
    with pytest.raises(ValueError, match="no valid numbers"):
        S.sample_by_score_bins(scored.where("score = 'x'"), 1)


@pytest.fixture(scope="module")
def timed(spark):
    rng = random.Random(2)
    rows = []
    for i in range(4000):
        site = 1 if i % 3 == 0 else rng.choice([2, 3, None])
        stamp = f"2024-01-{1 if site == 1 else rng.randrange(1, 4):02d}T{rng.randrange(24):02d}:00:00+10:00"
        rows.append((i, site, "no time" if i % 50 == 7 else stamp, rng.gauss(0.5, 1)))
    rows += [(4000, 9, "2024-01-01T00:00:00Z", -1.0), (4001, 9, "2024-01-01T00:00:00Z", float("nan"))]
    return spark.createDataFrame(rows, "id bigint, site_id bigint, start_datetime string, score double").repartition(4)


@pytest.mark.parametrize("n", [1, 3, 2000])
def test_site_and_day(timed, n):
    sample = S.sample_by_site_and_day(timed, n, id_columns=["id"])
    frame = timed.toPandas()
    frame["day"] = pd.to_datetime(frame.start_datetime, errors="coerce", utc=True).dt.date
    eligible = frame[frame.score >= 0].groupby(["site_id", "day"], dropna=False).size()
    taken = sample.toPandas().merge(frame[["id", "day"]], on="id")
    assert (taken.score >= 0).all() and taken.id.is_unique
    sizes = taken.groupby(["site_id", "day"], dropna=False).size()
    assert sizes.sort_index().tolist() == eligible.clip(upper=n).sort_index().tolist()
    order = sample.toPandas()
    assert order.site_id.dropna().is_monotonic_increasing and order.site_id.iloc[-1:].isna().all()


def test_site_and_day_prefers_scores_near_zero(spark):
    rows = spark.range(4).select(
        "id", F.lit(1).alias("site_id"), F.lit("2024-01-01T00:00:00Z").alias("start_datetime"), F.col("id").cast("double").alias("score")
    )
    sigma = np.std([0, 1, 2, 3])
    weights = np.exp(-np.arange(4) ** 2 / (2 * sigma**2))
    race = rows.withColumn("seed", F.explode(F.sequence(F.lit(1), F.lit(4000))))
    drawn = race.withColumn("u", S.draw_uniform(S.draw_hash(0, ["seed", "id"])))
    key = F.log(-F.log("u")) + F.col("score") ** 2 / (2 * sigma**2)
    wins = drawn.withColumn("k", key).groupBy("seed").agg(F.min_by("id", "k").alias("id")).groupBy("id").count().collect()
    share = {r.id: r["count"] / 4000 for r in wins}
    for i, w in enumerate(weights / weights.sum()):
        assert abs(share.get(i, 0) - w) < 0.03


def test_site_and_day_limits(spark, timed):
    negative = timed.where("score < 0")
    assert S.sample_by_site_and_day(negative, 1) is negative
    with pytest.raises(ValueError, match="start_datetime"):
        S.sample_by_site_and_day(timed.withColumn("start_datetime", F.lit("never")), 1)
    for column in ("site_id", "start_datetime", "score"):
        with pytest.raises(ValueError, match=column):
            S.sample_by_site_and_day(timed.drop(column), 1)
    with pytest.raises(ValueError):
        S.sample_by_site_and_day(timed, 0)
    flat = timed.limit(20).withColumn("score", F.lit(0.0)).withColumn("site_id", F.col("id"))
    assert S.sample_by_site_and_day(flat, 1, id_columns=["id"]).count() == 20


def test_groups_are_cut_before_the_shuffle(timed):
    plan = S.first_per_group(timed, ["site_id"], ["score", "id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")
    both = [ids(S.first_per_group(timed, ["site_id"], ["score", "id"], n)) for n in (900,)]
    S_limit = S.GROUP_LIMIT
    try:
        S.GROUP_LIMIT = 1
        assert ids(S.first_per_group(timed, ["site_id"], ["score", "id"], 900)) == both[0]
    finally:
        S.GROUP_LIMIT = S_limit


def test_stratified(timed):
    sample = S.stratified_sample(timed, 2, 10, id_columns=["id"])
    assert sample.count() == 10
    whole = ids(S.sample_by_site_and_day(timed, 2, id_columns=["id"]))
    assert set(ids(sample)) <= set(whole)
    assert ids(S.stratified_sample(timed, 2, id_columns=["id"])) == whole
