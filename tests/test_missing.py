from collections import defaultdict

import pytest

from linscore.operators.missing import missing_recordings, missing_summary_by_site, missing_totals

CATALOG = "id bigint, site_id bigint, site_name string, recorded_date string"


def rows(n=200):
    """One site has a third of everything, most of it on one day."""
    out = []
    for i in range(n):
        site = 1 if i % 3 == 0 else 2 + i % 5
        day = 1 if i % 3 == 0 and i % 4 else i % 28 + 1
        out.append((i, site, f"site {site}" if site != 4 else None, f"2024-01-{day:02d}T00:00:00Z"))
    return out


@pytest.mark.parametrize("width", [10_000, 7, 1])
def test_summary(spark, width):
    catalog = spark.createDataFrame(rows(), CATALOG)
    done = spark.createDataFrame([(i,) for i in [*range(0, 200, 7), 999, None]], "audio_recording_id bigint")
    wanted = defaultdict(list)
    for ident, site, name, date in rows():
        if ident % 7:
            wanted[name].append((date[:10], ident))
    found = missing_summary_by_site(catalog, done, width).collect()
    by_site = defaultdict(list)
    for row in found:
        by_site[row.site_name].append(row)
    assert by_site.keys() == wanted.keys()
    assert [r.missing_count for r in found] == sorted((r.missing_count for r in found), reverse=True)
    for name, parts in by_site.items():
        assert {p.missing_count for p in parts} == {len(wanted[name])}
        ids = [i for p in parts for i in p.missing_arids]
        assert sorted(ids) == sorted(i for _, i in wanted[name])
        assert {(p.date, i) for p in parts for i in p.missing_arids} == set(wanted[name])
        assert all({i // width for i in p.missing_arids} == {p.slice} and p.missing_arids == sorted(p.missing_arids) for p in parts)
        assert len({(p.date, p.slice) for p in parts}) == len(parts)


def test_totals(spark):
    catalog = spark.createDataFrame(rows(), CATALOG)
    done = spark.createDataFrame([(1,), (1,), (2,), (999,), (None,)], "audio_recording_id bigint")
    assert tuple(missing_totals(catalog, done).first()) == (198, 200, 3)
    assert missing_recordings(catalog, done).count() == 198
    nothing = missing_totals(catalog.limit(0), done.limit(0)).first()
    assert tuple(nothing) == (0, 0, 0)
    everything = spark.createDataFrame([(i,) for i in range(200)], "audio_recording_id bigint")
    assert missing_summary_by_site(catalog, everything).count() == 0
