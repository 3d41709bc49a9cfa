from datetime import datetime, timedelta
from pathlib import PurePosixPath
from urllib.parse import parse_qs, urlencode, urlparse, urlunparse

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linscore.functions import datetimes, labels, links, names, scores, urls


def column(spark, values, kind, make):
    """Value of an expression for each input."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", make(F.col("v")).alias("out")).orderBy("i").collect()]


RECORDED = [
    "2024-04-23T07:27:02.000Z",
    "2024-04-23T23:59:58Z",
    "2024-03-10T02:30:00+10:00",
    "2024-12-31T23:59:59.250-03:30",
    "2024-02-29 12:00:00+0545",
    "2024-04-23T07:27:02.5",
    "2024-04-23T07:27",
    "2024-04-23",
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("seconds", [0, 5, -7200, 100_000])
def test_segment_datetime_equals_isoformat(spark, zone, seconds):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = column(spark, RECORDED, "string", lambda v: datetimes.segment_datetime(v, F.lit(seconds)))
        days = column(spark, RECORDED, "string", datetimes.utc_date)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    parsed = [datetime.fromisoformat(r.replace("Z", "+00:00")) for r in RECORDED]
    assert found == [(p + timedelta(seconds=seconds)).isoformat() for p in parsed]
    assert days == [pd.to_datetime(r, utc=True).date() for r in RECORDED]


def test_unreadable_dates_are_null(spark):
    bad = ["", "yesterday", "2024-13-01T00:00:00Z", "12:30", "2024", "Europe/Berlin", None]
    assert column(spark, bad, "string", lambda v: datetimes.segment_datetime(v, F.lit(1))) == [None] * len(bad)
    assert column(spark, bad, "string", datetimes.utc_date) == [None] * len(bad)


def test_hour_and_date_keys(spark):
    assert column(spark, RECORDED[2:3], "string", datetimes.hour_key) == ["2024-03-10T02"]
    assert column(spark, RECORDED[2:3], "string", datetimes.date_key) == ["2024-03-10"]


def test_names(spark):
    assert column(spark, [" My Site ", "A\tB", "x"], "string", lambda v: names.safe_name(v, F.lit(12))) == [
        "_my_site__12", "a\tb_12", "x_12",
    ]
    assert column(spark, ["Big  Bird (2)!", "a-b_c"], "string", names.sanitise_name) == ["Big_Bird_2", "a-b_c"]
    paths = ["/a/b/c.tar.gz", "plain", ".hidden", "/x/12.csv", "a/"]
    assert column(spark, paths, "string", names.path_stem) == ["c.tar", "plain", ".hidden", "12", ""]


def test_labels():
    assert labels.parse_labels(None) is labels.parse_labels("") is labels.parse_labels(" , ") is None
    assert labels.parse_labels("pos, neg,") == ["pos", "neg"]
    assert labels.parse_label_map(None) is None
    assert labels.parse_label_map("a = b, c=d=e,") == {"a": "b", "c": "d=e"}
    for wrong in ("a", "a=", "=b", "a=b,c"):
        with pytest.raises(ValueError):
            labels.parse_label_map(wrong)


def test_links(spark):
    made = lambda host: column(
        spark, [7], "bigint", lambda v: links.listen_link(host, v, F.lit(10), F.lit(15), {"https://api.x": "https://www.x"})
    )
    assert made("https://api.x") == ["https://www.x/listen/7/?start=10&end=15"]
    assert made("https://other") == ["https://other/listen/7/?start=10&end=15"]


def test_recording_names(spark):
    given = ["20240101T000000Z_North Creek_12_345.flac", "20240101T000000-0330_a_9.wav", "other_9.wav", "20240101T000000Z_9.wav"]
    assert column(spark, given, "string", links.recording_site_name) == ["North Creek_12", "a", None, None]
    assert column(spark, given, "string", links.recording_id_of) == [345, 9, None, None]
    assert column(spark, given, "string", lambda v: links.original_link(v, "h"))[::2] == ["h/audio_recordings/345/original", given[2]]
    assert column(spark, given, "string", lambda v: links.original_link(v, None)) == given


URLS = [
    "https://example.com/path/to/resource",
    "http://example.com:8080/a//b/c.tar.gz?x=1&y=&x=2#frag",
    "https://example.com",
    "https://example.com/",
    "https://example.com/.hidden?q=a%20b+c&t=~*",
    "https://example.com/a/b.parquet;v=1?x=9",
    "https://user@host.org/one.parquet?&&token=old&x",
]


def test_url_paths(spark):
    def twin(url):
        parts = urlparse(url)
        segments = [s for s in parts.path.split("/") if s] or ["index"]
        folder = [parts.netloc.replace(":", "_"), *segments[:-1]]
        return "/".join([*folder, PurePosixPath(segments[-1]).stem + ".csv"])

    assert column(spark, URLS, "string", urls.url_to_output_path) == [twin(u) for u in URLS]
    assert column(spark, ["/local/file", "x.csv", None], "string", urls.url_to_output_path) == [None] * 3


@pytest.mark.parametrize("params", ["token=new", "x=7&x=8&z=a%2Fb", "blank=&k=~%2A+", "", None])
def test_query_merge(spark, params):
    def twin(url):
        if not params:
            return url
        parts = urlparse(url)
        merged = parse_qs(parts.query)
        merged.update(parse_qs(params))
        return urlunparse(parts._replace(query=urlencode(merged, doseq=True)))

    assert column(spark, URLS, "string", lambda v: urls.merge_query(v, params)) == [twin(u) for u in URLS]


def test_numbers(spark):
    given = ["1.5", " 2 ", "1e3", "x", "", "1.5f", "2d", "NaN", "inf", "-Infinity", None]
    assert column(spark, given, "string", scores.finite_number) == [1.5, 2.0, 1000.0] + [None] * 8


def test_bins_equal_numpy_and_pandas(spark):
    rng = np.random.default_rng(3)
    for lo, hi, bins in [(-1.0, 2.0, 10), (0.1, 0.7, 3), (-5.5, 1e6, 7)]:
        edges = np.linspace(lo, hi, bins + 1)
        values = np.concatenate([rng.uniform(lo, hi, 400), edges, np.nextafter(edges, lo), np.nextafter(edges[:-1], hi)])
        values = values[(values >= lo) & (values <= hi)].tolist()
        right = column(spark, values, "double", lambda v: scores.right_closed_bin(v, lo, hi, bins))
        left = column(spark, values, "double", lambda v: scores.left_closed_bin(v, lo, hi, bins))
        assert right == pd.cut(values, edges, include_lowest=True, labels=False).tolist()
        assert np.bincount(left, minlength=bins).tolist() == np.histogram(values, bins, (lo, hi))[0].tolist()


def test_weights(spark):
    given = [0.0, 1.0, -0.5, float("nan"), float("inf"), 1e9]
    found = column(spark, given, "double", lambda v: scores.half_gaussian_weight(v, 2.0))
    assert found == [1.0, pytest.approx(np.exp(-1 / 8)), 0.0, 0.0, 0.0, 0.0]


def test_draw_cells_keep_the_order_of_draws(spark):
    rows = spark.range(5000).withColumn("draw", scores.draw_hash(1, ["id"]))
    rows = rows.select("draw", scores.draw_cell(F.col("draw")).alias("cell"), scores.draw_uniform(F.col("draw")).alias("u")).collect()
    by_draw = sorted(rows, key=lambda r: r.draw)
    assert [r.cell for r in by_draw] == sorted(r.cell for r in rows)
    assert [r.u for r in by_draw] == sorted(r.u for r in rows)
    assert 0.45 < np.mean([r.u for r in rows]) < 0.55
