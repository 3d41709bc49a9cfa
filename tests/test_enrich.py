import pytest
from pyspark.sql import functions as F

from linscore.operators import enrich as E

CATALOG = "id bigint, site_id bigint, site_name string, region_id bigint, region_name string, recorded_date string"


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(
        [
            (1, 10, "north", 100, "hills", "2024-04-23T07:59:58Z"),
            (2, 20, "south", None, None, "2024-04-23T23:59:00.5+10:00"),
            (3, 20, "south", 0, "", "2024-04-23T00:00:00-03:30"),
        ],
        CATALOG,
    )


@pytest.fixture(scope="module")
def detections(spark):
    return spark.createDataFrame(
        [(1, "0", "frog", "1.5"), (1, "5.0", None, "2"), (2, "60", "owl", "-0.25"), (3, "10", "frog", "3"), (9, "0", "frog", "4"),
         (1, "x", "frog", "1"), (1, "2.5", "frog", "1"), (1, "5", "frog", "bad")],
        "audio_recording_id bigint, offset string, label string, score string",
    )


def enriched(detections, catalog, **options):
    return E.enrich(detections, catalog, host="https://api.x", site_hosts={"https://api.x": "https://www.x"}, **options)


def test_columns_values_and_unknown_recordings(detections, catalog):
    found = enriched(detections, catalog)
    assert tuple(found.columns) == E.ENRICHED
    rows = {(r.audio_recording_id, r.start_offset_seconds): r for r in found.collect()}
    assert sorted(rows) == [(1, 0), (1, 5), (2, 60), (3, 10)]
    first = rows[1, 5]
    assert (first.end_offset_seconds, first.start_datetime, first.region_name, first.region_id) == (10, "2024-04-23T08:00:03+00:00", "hills", 100)
    assert first.listen_link == "https://www.x/listen/1/?start=5&end=10"
    assert rows[2, 60].start_datetime == "2024-04-24T00:00:00.500000+10:00" and rows[2, 60].region_id is None
    assert (rows[3, 10].region_name, rows[3, 10].region_id) == (None, None)


def test_rejected_rows_are_told(detections):
    assert E.rejected_detections(detections).count() == 3


def test_filters_see_the_label_as_scored(detections, catalog):
    def labels(**options):
        return sorted(str(r.label) for r in enriched(detections, catalog, **options).collect())

    assert labels(include=["frog"], label_map={"frog": "toad", "owl": "frog"}) == ["toad", "toad"]
    assert labels(label_map={"owl": "bird"}) == ["None", "bird", "frog", "frog"]
    assert labels(exclude=["frog"]) == ["None", "owl"]
    assert labels(exclude=["toad"], label_map={"frog": "toad"}) == ["None", "owl", "toad", "toad"]
    assert labels(include=[]) == []


def test_window_length(detections, catalog):
    assert {r.end_offset_seconds - r.start_offset_seconds for r in enriched(detections, catalog, window_seconds=3).collect()} == {3}


def test_catalog_conditions(catalog):
    ids = lambda c: sorted(r.id for r in E.filter_catalog(catalog, c).collect())
    assert ids({}) == [1, 2, 3]
    assert ids({"site_id": {"eq": 20}, "id": {"in": [1, 3]}}) == [3]
    with pytest.raises(ValueError):
        ids({"id": {"gt": 1}})
    dotted = catalog.withColumnRenamed("region_id", "regions.id")
    assert E.filter_catalog(dotted, {"regions.id": {"eq": 100}}).count() == 1


def test_duplicate_recordings(spark, catalog):
    again = spark.createDataFrame([(1, 11, "moved", None, None, "2025-01-01T00:00:00Z")], CATALOG)
    found = E.unique_catalog(catalog.union(again))
    assert found.columns == catalog.columns and found.count() == 3
    assert found.where("id = 1").first().site_name == "moved"


def test_compact(detections, catalog):
    found = enriched(detections, catalog)
    assert E.compact(found).columns == list(E.COMPACT)
    assert "site_id" not in E.compact(found, with_site=False).columns


def test_a_large_catalog_is_not_broadcast(spark, detections, catalog):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = enriched(detections, catalog)
        assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
        assert found.where(F.col("audio_recording_id") == 1).count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_date_is_read_once_and_for_recordings_only(spark):
    import __spark_entry__ as entry

    for name in ("enrich_detections", "label_exclude", "label_include_map", "compact_detections"):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.01")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace") <= 5 and "rlike" not in plan
        branch = next(part for part in plan.split("\n") if "regexp_replace" in part)
        assert "Generate" in branch  # below the catalog's side of the join, not a condition on detections
    segments = entry.queries()["segment_datetime_basic"](spark, "/root/testdata/sf0.01")
    assert segments._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= 5
