"""The hand-computed feed: ties, bad numbers, an empty agency, agency case."""

import os

import pytest
from pyspark.sql import functions as F

from fixture_feed import LINES, write_feed
from skyledger.operators import (
    agency_counts,
    agency_winners,
    agency_winners_latest,
    batch_counts,
    parse_records,
    render_records,
    speed_stats,
    speed_stats_latest,
    with_batches,
)
from skyledger.sources import read_lines


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    path = write_feed(os.path.join(str(tmp_path_factory.mktemp("feed")), "feed.csv"))
    lines = with_batches(read_lines(spark, path))
    return parse_records(lines)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_line_numbers_and_batches(spark, feed):
    got = rows(feed.parsed, "line_no", "batch_no")
    assert got == [(i, i // 6) for i in range(len(LINES))]


def test_rejects(feed):
    assert rows(feed.rejects, "line_no", "reason") == [(4, "number"), (9, "arity"), (11, "number")]


def test_batch_counts(feed):
    assert rows(batch_counts(feed.records), "batch_no", "n") == [(0, 5), (1, 4)]


def test_agency_counts(feed):
    assert rows(agency_counts(feed.records), "batch_no", "agency", "n") == [
        (0, "dhs", 2),
        (0, "doj", 1),
        (0, "fbi", 2),
        (1, "DHS", 1),
        (1, "dhs", 1),
        (1, "fbi", 2),
    ]


def test_agency_winners_keep_ties_sorted(feed):
    got = rows(agency_winners(feed.records), "batch_no", "agency_most_flight_segs", "num_of_flight_segs")
    assert got == [(0, "[dhs, fbi]", 2), (1, "[fbi]", 2)]


def test_agency_winners_latest(feed):
    latest = agency_winners_latest(agency_winners(feed.records))
    assert rows(latest, "agency_most_flight_segs", "num_of_flight_segs") == [("[dhs, fbi]", 2), ("[fbi]", 2)]


def test_speed_stats_agency(feed):
    stats = speed_stats(feed.records, "dhs", label="F1")
    cols = ("batch_no", "flight_segment", "max_speed", "min_speed", "avg_speed", "num_of_flight_segments")
    assert rows(stats, *cols) == [(0, "F1", 120, 100, 110.0, 2), (1, "F1", 80, 80, 80.0, 1)]
    latest = speed_stats_latest(stats)
    assert rows(latest, *cols[1:]) == [("F1", 80, 80, 80.0, 1)]


def test_speed_stats_agency_and_flight(feed):
    stats = speed_stats(feed.records, "dhs", flight="F1")
    assert rows(stats, "batch_no", "flight_segment", "max_speed", "min_speed", "avg_speed", "num_of_flight_segments") == [
        (0, "F1", 120, 100, 110.0, 2)
    ]


def test_speed_stats_empty_batch_has_no_row(feed):
    assert speed_stats(feed.records, "nobody", label="F1").count() == 0


def test_squawk_leading_zero(feed):
    assert rows(feed.records.filter(F.col("line_no") == 0), "squawk") == [(453,)]


def test_render_line_zero(feed):
    text = render_records(feed.records).filter(F.col("line_no") == 0).collect()[0]["text"]
    assert text == (
        "A1,F1,3.350000e+01,-1.172500e+02,5000,100,90,453,C182,2015-08-18T07:58:54Z,"
        "NAME,,,N1,S1,2072738,CESSNA,182T,2006,4,dhs"
    )


def test_fail_mode_raises(spark, tmp_path):
    path = write_feed(str(tmp_path / "feed.csv"))
    lines = read_lines(spark, path)
    with pytest.raises(Exception, match="bad feed line"):
        parse_records(lines, on_error="fail").records.count()


def test_batch_job_end_to_end(spark, tmp_path):
    from skyledger.plans.job import run_job

    path = write_feed(str(tmp_path / "feed.csv"))
    lines = with_batches(read_lines(spark, path))
    paths = run_job(spark, lines, str(tmp_path / "out"), agency="dhs", label="F1")
    winners = spark.read.parquet(paths["agency_winners"])
    assert rows(winners, "batch_no", "agency_most_flight_segs", "num_of_flight_segs") == [
        (0, "[dhs, fbi]", 2),
        (1, "[fbi]", 2),
    ]
    latest = spark.read.parquet(paths["speed_stats_latest"])
    assert rows(latest, "flight_segment", "max_speed", "min_speed", "avg_speed", "num_of_flight_segments") == [
        ("F1", 80, 80, 80.0, 1)
    ]
    rejects = spark.read.parquet(paths["rejects"])
    assert rows(rejects, "line_no", "reason") == [(4, "number"), (9, "arity"), (11, "number")]
    assert rejects.filter(F.col("line").isNull()).count() == 0


def test_latest_per_key_modes(spark):
    from skyledger.operators import latest_per_key

    hist = spark.createDataFrame(
        [("x", 1, 10, "a"), ("x", 3, 30, "c"), ("y", 2, 20, "b")], "k string, batch_no long, v int, s string"
    )
    for unique in (True, False):
        got = latest_per_key(hist, ["k"], values=["v", "s"], keep_order_col=True, unique_order=unique)
        assert rows(got, "k", "v", "s", "batch_no") == [("x", 30, "c", 3), ("y", 20, "b", 2)]


def test_batch_job_cli(spark, tmp_path):
    from skyledger.plans.job import main

    path = write_feed(str(tmp_path / "feed.csv"))
    out = str(tmp_path / "out")
    main(["--input", path, "--output", out, "--agency", "dhs", "--flight", "F1"])
    stats = spark.read.parquet(f"{out}/speed_stats")
    # With --flight only F1's rows count: batch 0 only (FIXTURES.md section 1).
    assert rows(stats, "batch_no", "max_speed", "min_speed", "avg_speed", "num_of_flight_segments") == [
        (0, 120, 100, 110.0, 2)
    ]
