"""File streams by byte range, paced replays and first lines that stop early."""

import os
import time

import pytest
from pyspark.sql import functions as F
from test_streaming import TRICKY, drain, rows

from skyledger.operators import agency_counts, parse_records
from skyledger.schema import HEADER_LINE
from skyledger.sources import first_file_lines, read_events_feed, read_lines
from skyledger.streaming import (
    ResultTables,
    deliver_to_folder,
    place_lines,
    read_history,
    run_paced_replay,
    split_counts,
    split_lines_stream,
    stage_lines,
    start_paced_replay,
    with_row_ids,
)
from skyledger.streaming.sink import COUNTS, PREVIEW, REJECTS

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def feed_folder(spark, tmp_path, end="\n"):
    """A file of many splits, one of odd lines, one with a header only and an empty one."""
    body = [r["line"] for r in read_events_feed(spark, SF).orderBy("line_no").collect()]
    folder = tmp_path / "in"
    folder.mkdir()
    # A body line that equals the header, and blank lines, stay.
    long = [HEADER_LINE, HEADER_LINE, "", *body, ""]
    (folder / "a long.csv").write_bytes((end.join(long) + end).encode())
    (folder / "b_odd.csv").write_bytes(end.join([HEADER_LINE, *TRICKY]).encode())
    (folder / "c_header.csv").write_text(HEADER_LINE + "\n")
    (folder / "d_empty.csv").write_text("")
    return str(folder)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_file_stream_by_split_equals_read_lines(spark, tmp_path, small_splits, end):
    folder = feed_folder(spark, tmp_path, end)
    seen = []

    def place(batch, number):
        lines = with_row_ids(batch).persist()
        counts = split_counts(lines)
        in_tasks = lines.groupBy("source_file").agg(F.countDistinct(F.shiftright("row_id", 33)).alias("tasks"))
        seen.append((counts.count(), max(r["tasks"] for r in in_tasks.collect())))
        place_lines(lines, counts).write.mode("append").parquet(str(tmp_path / "out"))
        lines.unpersist()

    query = split_lines_stream(spark, folder).writeStream.foreachBatch(place).trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "ckpt")).start().awaitTermination(120)
    columns = ["source_file", "file_line_no", "line"]
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["line", "source_file", "file_line_no"] or set(columns) == set(got.columns)
    assert rows(got.select(*columns)) == rows(read_lines(spark, folder).select(*columns))
    assert seen[0][0] >= 8 and seen[0][1] > 4  # the long file was read by several tasks


@pytest.mark.parametrize("mode", ["reject", "fail"])
def test_consumer_reads_files_by_split_and_locates_rejects(spark, tmp_path, small_splits, mode):
    folder = feed_folder(spark, tmp_path)
    tables = ResultTables(str(tmp_path / "r"))
    stream = split_lines_stream(spark, folder)
    if mode == "fail":
        with pytest.raises(Exception, match="bad feed line"):
            drain(stream, tables, tmp_path, "split_fail", agency="click", on_error="fail")
        return
    drain(stream, tables, tmp_path, "split", agency="click", preview_rows=3)
    lines = read_lines(spark, folder)
    parsed = parse_records(lines.withColumn("batch_no", F.lit(0).cast("bigint")))
    assert rows(read_history(spark, tables, COUNTS)) == rows(agency_counts(parsed.records))
    got = read_history(spark, tables, REJECTS).select("source_file", "line_no", "line", "reason")
    want = parsed.rejects.select("source_file", F.col("file_line_no").alias("line_no"), "line", "reason")
    assert rows(got) == rows(want)
    first = read_history(spark, tables, PREVIEW).select("line_no", "line").orderBy("line_no").collect()
    assert [tuple(r) for r in first][:2] == [(0, HEADER_LINE), (1, "")]


def test_headers_alone_are_no_bad_lines(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = read_events_feed(spark, SF).filter("line_no in (1, 2, 3)").collect()
    (folder / "a.csv").write_text("\n".join([HEADER_LINE, *(r["line"] for r in good)]))
    (folder / "b.csv").write_text(HEADER_LINE)
    tables = ResultTables(str(tmp_path / "r"))
    drain(split_lines_stream(spark, str(folder)), tables, tmp_path, "headers", agency="click", on_error="fail")
    assert read_history(spark, tables, COUNTS).agg(F.sum("n")).first()[0] == 3
    assert read_history(spark, tables, REJECTS).isEmpty()


def test_paced_replay_delivers_steps_in_order_and_time(spark, tmp_path):
    feed = read_events_feed(spark, SF).filter("line_no < 27")
    staged, out = str(tmp_path / "staged"), str(tmp_path / "out")
    stage_lines(feed, staged, block_lines=10)  # steps of 6 cross blocks
    began = time.time()
    run_paced_replay(spark, staged, deliver_to_folder(out), 6, 2.0, str(tmp_path / "ckpt"), block_lines=10)
    assert time.time() - began >= 8  # five steps, four pauses
    got = spark.read.parquet(out)
    assert rows(got.select("line_no", "line")) == rows(feed.select("line_no", "line"))
    steps = got.groupBy("step").agg(
        F.min("line_no").alias("low"), F.max("line_no").alias("high"), F.min("arrived_at").alias("at"),
        F.countDistinct("arrived_at").alias("times"),
    ).orderBy("step").collect()
    assert [(r["low"], r["high"]) for r in steps] == [(0, 5), (6, 11), (12, 17), (18, 23), (24, 26)]
    assert all(r["times"] == 1 for r in steps)
    gaps = [(b["at"] - a["at"]).total_seconds() for a, b in zip(steps, steps[1:])]
    # Triggers lie two seconds apart; a step may start late within its own interval.
    assert all(g > 0.5 for g in gaps) and 6 < sum(gaps) < 20, gaps


def test_paced_replay_goes_on_where_it_stopped(spark, tmp_path):
    feed = read_events_feed(spark, SF).filter("line_no < 40")
    staged, out = str(tmp_path / "staged"), str(tmp_path / "out")
    stage_lines(feed, staged, block_lines=10)
    deliver = deliver_to_folder(out)
    options = dict(lines_per_step=8, step_s=1.0, checkpoint=str(tmp_path / "ckpt"), block_lines=10)
    query = start_paced_replay(spark, staged, deliver, query_name="stopped", **options)
    while not os.path.exists(f"{out}/step=000000000001/_SUCCESS"):
        query.awaitTermination(0.2)
    query.stop()
    run_paced_replay(spark, staged, deliver, **options)
    assert rows(spark.read.parquet(out).select("line_no", "line")) == rows(feed.select("line_no", "line"))


def test_first_file_lines_equal_read_lines(spark, tmp_path, small_splits):
    folder = feed_folder(spark, tmp_path)
    every = read_lines(spark, folder)
    total = every.count()
    for n in (0, 1, 5, 1002, 1003, 1004, total, total + 50):
        want = every.filter(F.col("line_no") < n)
        got = first_file_lines(spark, folder, n)
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got.select(*want.columns)) == rows(want)
    with pytest.raises(ValueError):
        first_file_lines(spark, folder, -1)
    with pytest.raises(ValueError):
        first_file_lines(spark, folder, 10_000_000)


def test_first_file_lines_read_leading_files_only(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(60):
        (folder / f"{k:03d}.csv").write_text("\n".join([HEADER_LINE, *(f"{k};{i}" for i in range(2000))]) + "\n")
    read = bytes_read(spark, lambda: first_file_lines(spark, str(folder), 20).collect())
    everything = sum(f.stat().st_size for f in folder.iterdir())
    assert read < everything / 20, (read, everything)
    got = first_file_lines(spark, str(folder), 4500).orderBy("line_no").collect()
    assert [r["line"] for r in got] == [f"{i // 2000};{i % 2000}" for i in range(4500)]
    assert [r["file_line_no"] for r in got] == [i % 2000 for i in range(4500)]


def bytes_read(spark, action):
    """Bytes that tasks of local mode read through Hadoop's file systems while ``action`` runs."""
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics
    before = sum(s.getBytesRead() for s in statistics())
    action()
    return sum(s.getBytesRead() for s in statistics()) - before


def test_kept_index_makes_the_second_read_one_pass(spark, tmp_path, small_splits):
    folder = feed_folder(spark, tmp_path)
    seen = []

    def read():
        seen.append(rows(read_lines(spark, folder, keep_index=True)))

    first, second = bytes_read(spark, read), bytes_read(spark, read)
    assert seen[0] == seen[1] == rows(read_lines(spark, folder))
    text = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder))
    assert first - second > 0.7 * text, (first, second, text)
    changed = f"{folder}/b_odd.csv"
    with open(changed, "ab") as file:
        file.write(b"\none more;line")
    read()
    assert seen[2] == rows(read_lines(spark, folder)) and len(seen[2]) == len(seen[0]) + 1
    # Another cut of the same files has a table of its own.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    read()
    assert seen[3] == seen[2]


def test_paced_step_looks_at_its_own_blocks_only(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader

    from skyledger.streaming import replay

    staged = str(tmp_path / "staged")
    lines = spark.range(100).selectExpr("id AS line_no", "concat('l', id) AS line").filter("line_no not between 40 and 59")
    stage_lines(lines, staged, block_lines=10)
    read, opened = DataFrameReader.parquet, []
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *paths, **o: opened.append(paths) or read(self, *paths, **o))
    got = replay.staged_range(spark, staged, 25, 44, 10).collect()
    assert sorted(r["line_no"] for r in got) == list(range(25, 40))
    assert opened == [(f"{staged}/block=2", f"{staged}/block=3")]
    assert replay.staged_range(spark, staged, 40, 59, 10).isEmpty()  # a gap
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        replay.staged_range(spark, str(tmp_path / "none"), 0, 9, 10).collect()
