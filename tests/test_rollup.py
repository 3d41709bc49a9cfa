import random
from collections import Counter, defaultdict

import pytest

from linscore.operators import rollup as R

SCHEMA = (
    "audio_recording_id bigint, site_name string, label string, start_offset_seconds int, end_offset_seconds int, "
    "score double, start_datetime string"
)


def random_rows(n, seed=7):
    """Few groups and values: a third of all rows in one group, ties and exact copies in plenty."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        site = "hot" if hot else rng.choice(["a", "b", None])
        hour = 5 if hot else rng.randrange(3)
        start = rng.randrange(3) * 5
        rows.append(
            (rng.randrange(3), site, "frog" if hot else rng.choice(["frog", "owl", None]), start, start + 5, rng.randrange(-2, 3) / 2.0,
             f"2024-01-01T{hour:02d}:00:{start:02d}+10:00")
        )
    return rows


def brute_force(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1], row[2], row[6][:13]].append(row)
    best, rest = [], []
    for members in groups.values():
        top = min(members, key=lambda r: (-r[5], r[0], r[3], r[4], r[6]))
        best.append((*top, len(members)))
        rest += members
        rest.remove(top)
    return Counter(best), Counter(rest)


@pytest.mark.parametrize("n", [1, 40, 3000])
def test_best_and_rest_against_brute_force(spark, n):
    rows = random_rows(n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    best, rest = brute_force(rows)
    assert Counter(map(tuple, R.max_per_hour(df).collect())) == best
    assert Counter(map(tuple, R.non_max(df).select(*df.columns).collect())) == rest


def test_copies_beyond_one_chunk(spark, monkeypatch):
    monkeypatch.setattr("linscore.operators.copies.COPIES_PER_TASK", 10)
    rows = [(1, "s", "l", 0, 5, 1.0, "2024-01-01T00:00:00")] * 57 + [(2, "s", "l", 0, 5, 0.5, "2024-01-01T00:00:00")] * 3
    found = Counter(map(tuple, R.non_max(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert found == Counter({rows[0]: 56, rows[-1]: 3})


def test_row_key(spark):
    rows = [(i, *r) for i, r in enumerate(random_rows(500))]
    df = spark.createDataFrame(rows, "row bigint, " + SCHEMA)
    best, rest = R.max_per_hour(df, ["row"]), R.non_max(df, ["row"])
    assert best.columns == [*df.columns, "count"]
    taken, left = {r.row for r in best.collect()}, {r.row for r in rest.collect()}
    assert not taken & left and taken | left == set(range(500))
    wanted, _ = brute_force([r[1:] for r in rows])
    assert Counter((*r[1:-1], r["count"]) for r in map(tuple_row, best.collect())) == wanted


def tuple_row(row):
    class Plain(tuple):
        def __getitem__(self, key):
            return row[key] if isinstance(key, str) else tuple.__getitem__(self, key)

    return Plain(row)


def test_ties_go_to_the_lowest_recording_and_start(spark):
    rows = [(2, "s", "l", 0, 5, 1.0, "2024-01-01T00:00:00"), (1, "s", "l", 10, 15, 1.0, "2024-01-01T00:00:10"), (1, "s", "l", 5, 10, 1.0, "2024-01-01T00:00:05")]
    first = R.max_per_hour(spark.createDataFrame(rows, SCHEMA)).first()
    assert (first.audio_recording_id, first.start_offset_seconds, first["count"]) == (1, 5, 3)


def test_hours_are_those_of_the_recording(spark):
    rows = [(1, "s", "l", 0, 5, 1.0, "2024-01-01T09:30:00+10:00"), (1, "s", "l", 0, 5, 2.0, "2024-01-01T09:30:00+00:00"), (1, "s", "l", 0, 5, 2.0, "2024-01-01T08:59:59+00:00")]
    assert R.max_per_hour(spark.createDataFrame(rows, SCHEMA)).count() == 2


def test_top(spark):
    rows = random_rows(900)
    found = R.top_max_per_hour(spark.createDataFrame(rows, SCHEMA), 4)
    best = sorted(brute_force(rows)[0], key=lambda r: (-r[5], r[0], r[3], r[4]))
    assert [r.score for r in found.collect()] == [r[5] for r in best[:4]]


def test_counts_and_totals(spark):
    rows = random_rows(600)
    df = spark.createDataFrame(rows, SCHEMA)
    labels, sites = Counter(r[2] for r in rows), Counter((r[1], r[2]) for r in rows)
    assert {r.label: r.n for r in R.counts_by_label(df).collect()} == labels
    assert {(r.site_name, r.label): r.n for r in R.counts_by_site(df).collect()} == sites
    both = R.counts_with_totals(df).collect()
    assert {r.label: r.n for r in both if r.level == "total"} == labels
    assert {(r.site_name, r.label): r.n for r in both if r.level == "site"} == sites
    totals, (best, rest) = R.run_totals(df).first(), brute_force(rows)
    assert totals.total_rows == 600 and totals.max_rows == best.total() and totals.non_max_rows == rest.total()
    assert totals.labels == 2 and totals.sites == 3
    assert R.run_totals(df.limit(0)).first().total_rows == 0


def test_nothing_gathers_a_group_before_combining(spark):
    df = spark.createDataFrame(random_rows(50), SCHEMA)
    for query in (R.max_per_hour(df), R.non_max(df), R.non_max(df, ["audio_recording_id"])):
        plan = query._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "partial_min" in plan
        assert "NestedLoop" not in plan and "Cartesian" not in plan
