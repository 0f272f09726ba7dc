"""Stream / batch parity: staged lines and feed files through foreachBatch."""

import os
import re

import pytest
from pyspark.sql import functions as F

from skyledger.operators import (
    agency_counts,
    agency_winners,
    agency_winners_latest,
    parse_records,
    speed_stats,
    speed_stats_latest,
    with_batches,
)
from skyledger.schema import HEADER_LINE
from skyledger.sources import read_events_feed, read_lines
from skyledger.streaming import (
    FeedBatchWriter,
    ResultTables,
    ensure_tables,
    file_lines_stream,
    latest_views,
    message_lines,
    read_history,
    snapshot_current,
    stage_lines,
    staged_lines_stream,
    start_consumer,
    write_feed_files,
)
from skyledger.streaming.sink import COUNTS, REJECTS, SPEED, WINNERS
from skyledger.streaming.source import STAGED_SCHEMA

SF = "/root/testdata/sf0.001"
TRICKY = [
    'A1;"F1";33.5;x',
    'a\\"b;c',
    "  leading and trailing  ",
    "\ttab\tinside",
    "",
    "   ",
    "# not a comment",
    "'single' quotes",
    "ends with backslash \\",
    "cut\u0001here",
    "uni: é ü ∑",
    '"',
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def drain(stream, tables, tmp_path, name, **options):
    query = start_consumer(
        stream,
        tables,
        query_name=name,
        checkpoint=str(tmp_path / f"ckpt-{name}"),
        available_now=True,
        **options,
    )
    query.awaitTermination(180)
    assert query.exception() is None
    return query


def replayed(spark, folder, files=1):
    return with_batches(staged_lines_stream(spark, folder, files)).drop("arrival_s")


def touch(path, order):
    os.utime(path, (1_000_000 + 10 * order,) * 2)


@pytest.mark.parametrize("database", [None, "feedstore"])
@pytest.mark.parametrize("block_lines", [100, 60])
def test_replay_equals_batch_whatever_the_blocks(spark, tmp_path, database, block_lines):
    """100 lines are no multiple of a batch: most blocks split one."""
    feed = read_events_feed(spark, SF)
    staged = str(tmp_path / "staged")
    stage_lines(feed, staged, block_lines=block_lines)
    name = f"{database or 'path'}_{block_lines}"
    tables = ResultTables(str(tmp_path / "results"), database, run_id=name)
    query = drain(
        replayed(spark, staged, files=3), tables, tmp_path, name, agency="click", label="F3", batches_from_input=True
    )
    assert len(query.recentProgress) >= 4
    parsed = parse_records(with_batches(feed).drop("arrival_s"))
    records = parsed.records
    assert rows(read_history(spark, tables, WINNERS)) == rows(agency_winners(records))
    assert rows(read_history(spark, tables, COUNTS)) == rows(agency_counts(records))
    assert rows(read_history(spark, tables, SPEED)) == rows(speed_stats(records, "click", label="F3"))
    got = read_history(spark, tables, REJECTS).select("batch_no", "line_no", "line", "reason")
    assert rows(got) == rows(parsed.rejects.select("batch_no", "line_no", "line", "reason"))
    if database:  # the reference's table names, as views
        assert rows(spark.table(tables.table(WINNERS))) == rows(agency_winners(records))
        assert rows(spark.table(tables.table(SPEED))) == rows(speed_stats(records, "click", label="F3"))


def test_batch_in_two_files_and_two_triggers_adds_up(spark, tmp_path):
    feed = read_events_feed(spark, SF).filter("line_no between 2 and 7").withColumn("line_no", F.col("line_no") - 2)
    staged = str(tmp_path / "staged")
    stage_lines(feed, staged, block_lines=3)
    tables = ResultTables(str(tmp_path / "results"))
    query = drain(replayed(spark, staged), tables, tmp_path, "two_files", agency="click", batches_from_input=True)
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 2
    assert [r["n"] for r in read_history(spark, tables, COUNTS).groupBy().agg(F.sum("n").alias("n")).collect()] == [6]


def test_small_files_lose_nothing(spark, tmp_path):
    feed = read_events_feed(spark, SF)
    staged, texts = str(tmp_path / "staged"), str(tmp_path / "texts")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        stage_lines(feed, staged, block_lines=250)
        write_feed_files(feed, texts, lines_per_file=250)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    tables = ResultTables(str(tmp_path / "results"))
    drain(replayed(spark, staged), tables, tmp_path, "small_files", agency="click", batches_from_input=True)
    assert read_history(spark, tables, REJECTS).count() == 20
    clicks = read_history(spark, tables, COUNTS).filter("agency = 'click'")
    assert clicks.agg(F.sum("n")).first()[0] == 205
    assert rows(read_lines(spark, texts).select("line_no", "line")) == rows(feed.select("line_no", "line"))


def test_batch_retry_is_idempotent(spark, tmp_path):
    tables = ResultTables(root=str(tmp_path / "results"))
    writer = FeedBatchWriter(tables, agency="click", label="F3")
    lines = read_events_feed(spark, SF).filter(F.col("line_no") < 12).select("line")
    writer(lines, 7)
    once = {n: rows(read_history(spark, tables, n)) for n in (WINNERS, SPEED, COUNTS, REJECTS)}
    writer(lines, 7)  # same batch again, as after a failure
    writer(lines.limit(0), 8)  # empty batch writes nothing
    assert {n: rows(read_history(spark, tables, n)) for n in once} == once
    assert [r["batch_no"] for r in read_history(spark, tables, WINNERS).collect()] == [7]


def test_staging_keeps_lines_verbatim(spark, tmp_path):
    lines = spark.createDataFrame([*enumerate(TRICKY), (len(TRICKY), None)], "line_no bigint, line string")
    staged, texts = str(tmp_path / "staged"), str(tmp_path / "texts")
    stage_lines(lines, staged, block_lines=5)
    assert rows(spark.read.schema(STAGED_SCHEMA).parquet(staged).select("line_no", "line")) == rows(lines)
    write_feed_files(lines, texts, lines_per_file=5)  # a null line is an empty one in a text file
    want = rows(lines.fillna("", ["line"]))
    assert rows(read_lines(spark, texts).select("line_no", "line")) == want


@pytest.mark.parametrize("end", ["\n", "\r\n", ""])
def test_file_stream_equals_file_batch_with_rejects(spark, tmp_path, end):
    good = read_events_feed(spark, SF).filter("line_no in (1, 2, 3)").collect()
    body = [*TRICKY, *(r["line"] for r in good)]
    folder = tmp_path / "in"
    folder.mkdir()
    text = (end or "\n").join([HEADER_LINE, *body]) + end
    (folder / "f.csv").write_bytes(text.encode())
    (folder / "only_header.csv").write_text(HEADER_LINE + "\n")
    (folder / "empty.csv").write_text("")
    tables = ResultTables(str(tmp_path / "results"))
    stream = file_lines_stream(spark, str(folder), None)
    drain(stream.select("line"), tables, tmp_path, f"verbatim{len(end)}", agency="click")
    parsed = parse_records(read_lines(spark, str(folder)).select("line"))
    assert parsed.records.count() == 3
    got = read_history(spark, tables, REJECTS)
    assert rows(got.select("line", "reason")) == rows(parsed.rejects) and got.count() == len(TRICKY)
    assert read_history(spark, tables, COUNTS).agg(F.sum("n")).first()[0] == 3


def test_live_batches_and_restart_from_checkpoint(spark, tmp_path):
    """One feed file per micro-batch: the reference's processing-time batches."""
    feed = read_events_feed(spark, SF).filter("line_no < 60")
    texts, arrive = str(tmp_path / "texts"), tmp_path / "arrive"
    write_feed_files(feed, texts, lines_per_file=6)
    arrive.mkdir()
    files = sorted(
        os.path.join(d, f) for d, _, names in os.walk(texts) for f in names if f.endswith(".txt")
    )
    assert len(files) == 10
    tables = ResultTables(str(tmp_path / "results"), run_id="r1")
    for chunk in (files[:4], files[4:]):  # the second start resumes after the four files done
        for path in chunk:
            copy = arrive / f"{files.index(path):04d}.txt"
            copy.write_bytes(open(path, "rb").read())
            touch(copy, files.index(path))
        stream = file_lines_stream(spark, str(arrive)).select("line")
        drain(stream, tables, tmp_path, "live", agency="click", label="F3")
    records = parse_records(with_batches(feed)).records
    assert rows(read_history(spark, tables, WINNERS)) == rows(agency_winners(records))
    assert rows(read_history(spark, tables, SPEED)) == rows(speed_stats(records, "click", label="F3"))
    views = latest_views(spark, tables)
    assert rows(views[WINNERS]) == rows(agency_winners_latest(agency_winners(records)))
    assert tables.path(COUNTS).endswith("run=r1/" + COUNTS)


def test_fail_mode_stops_the_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "f.csv").write_text(f"{HEADER_LINE}\nbad\n")
    query = start_consumer(
        file_lines_stream(spark, str(folder)).select("line"),
        ResultTables(str(tmp_path / "results")),
        agency="click",
        query_name="fail_mode",
        checkpoint=str(tmp_path / "ck"),
        available_now=True,
        on_error="fail",
    )
    with pytest.raises(Exception, match="bad feed line"):
        query.awaitTermination(120)


def test_write_jobs_carry_the_callers_job_group(spark):
    from skyledger.session import run_together

    seen = []
    context = spark.sparkContext
    context.setJobGroup("a-stream", "its jobs")
    try:
        run_together(spark, [lambda: seen.append(context.getLocalProperty("spark.jobGroup.id"))] * 3)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert seen == ["a-stream"] * 3


def test_topic_projection_and_options(spark):
    from skyledger.streaming.replay import topic_write_options
    from skyledger.streaming.source import topic_read_options

    messages = spark.createDataFrame(
        [(None, b"a;b", 2, 5), (None, None, 0, 6)], "key binary, value binary, partition int, offset bigint"
    )
    got = message_lines(messages)
    assert [tuple(r) for r in got.collect()] == [("a;b", 2, 5), (None, 0, 6)]
    parsed = parse_records(got)
    assert parsed.rejects.count() == 2 and parsed.records.count() == 0
    assert topic_read_options("h:1", max_offsets_per_trigger=9, min_partitions=4) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "feds",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "9",
        "minPartitions": "4",
    }
    assert topic_write_options("h:1") == {"kafka.bootstrap.servers": "h:1", "topic": "feds"}


def test_topic_rejects_keep_partition_and_offset(spark, tmp_path):
    lines = spark.createDataFrame([("bad", 3, 17)], "line string, partition int, line_no bigint")
    tables = ResultTables(str(tmp_path / "results"))
    FeedBatchWriter(tables, agency="click")(lines, 0)
    got = read_history(spark, tables, REJECTS).collect()
    assert [tuple(r) for r in got] == [(0, 3, 17, "bad", "arity", None)]


def test_topic_needs_connector(spark):
    from skyledger.streaming import kafka_lines_stream, publish_to_topic

    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_lines_stream(spark, "localhost:9092").writeStream.format("noop").start().stop()
    with pytest.raises(Exception, match="(?i)kafka"):
        publish_to_topic(read_events_feed(spark, SF).select("line"), "localhost:9092")


def test_echo_prints_agency_counts_and_history_has_them_all(spark, tmp_path, capsys):
    tables = ResultTables(root=str(tmp_path / "results"))
    writer = FeedBatchWriter(tables, agency="click", label="F3", echo_rows=1)
    feed = with_batches(read_events_feed(spark, SF).filter(F.col("line_no") < 6))
    writer(feed.select("line"), 0)
    out = capsys.readouterr().out
    assert "agency" in out and "|n" in out.replace(" ", "")
    assert rows(read_history(spark, tables, COUNTS)) == rows(agency_counts(parse_records(feed).records))


def test_snapshots_merge_only_new_batches(spark, tmp_path):
    tables = ResultTables(root=str(tmp_path / "results"))
    ensure_tables(spark, tables)
    writer = FeedBatchWriter(tables, agency="click", label="F3")
    feed = read_events_feed(spark, SF).select("line_no", "line")

    def full():
        # Independent of snapshots: latest per key over the whole history.
        return {
            WINNERS: agency_winners_latest(read_history(spark, tables, WINNERS)),
            SPEED: speed_stats_latest(read_history(spark, tables, SPEED)),
        }

    def check(paths):
        want = full()
        views = latest_views(spark, tables)
        for name in (WINNERS, SPEED):
            current = spark.read.parquet(paths[name])
            assert rows(current.drop("batch_no")) == rows(want[name])
            assert rows(views[name]) == rows(want[name])

    def write(batches):
        for b in batches:
            writer(feed.filter(F.col("line_no").between(12 * b, 12 * b + 11)), b)

    write(range(3))
    first = snapshot_current(spark, tables, upto=2)
    assert first[WINNERS].endswith("upto=2")
    check(first)
    write(range(3, 6))
    second = snapshot_current(spark, tables)  # upto found from the new partitions
    assert second[WINNERS].endswith("upto=5")
    check(second)
    assert snapshot_current(spark, tables) == second  # nothing new: same snapshot
    before = {n: rows(spark.read.parquet(second[n])) for n in (WINNERS, SPEED)}
    again = snapshot_current(spark, tables, upto=5)  # as after a retried batch 5
    assert again == second
    assert {n: rows(spark.read.parquet(again[n])) for n in (WINNERS, SPEED)} == before
    write(range(6, 8))  # newer than the last snapshot: the views add them
    want, views = full(), latest_views(spark, tables)
    for name in (WINNERS, SPEED):
        assert rows(views[name]) == rows(want[name])
        plan = views[name]._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*micro_batch#\d+L? > 5", plan)


def test_console_preview_consumes_the_stream(spark, tmp_path):
    from skyledger.streaming import start_preview

    staged = str(tmp_path / "staged")
    stage_lines(read_events_feed(spark, SF).filter("line_no < 60"), staged, block_lines=6)
    query = start_preview(staged_lines_stream(spark, staged, 5), rows=3, checkpoint=str(tmp_path / "ckpt"))
    try:
        query.processAllAvailable()
        assert query.exception() is None
        assert sum(p["numInputRows"] for p in query.recentProgress) == 60
    finally:
        query.stop()


def test_replay_and_consumer_command_lines(spark, tmp_path):
    from skyledger.streaming.consumer import main as consume
    from skyledger.streaming.replay import main as replay

    feed = read_events_feed(spark, SF)
    texts, staged, results = (str(tmp_path / n) for n in ("texts", "staged", "results"))
    write_feed_files(feed, texts, lines_per_file=400)
    replay(["--input", texts, "--output-dir", staged, "--block-lines", "250"])
    assert rows(spark.read.schema(STAGED_SCHEMA).parquet(staged).select("line_no", "line")) == rows(feed)
    consume([
        "--staged-dir", staged, "--max-per-trigger", "2", "--results", results, "--agency", "click",
        "--label", "F3", "--available-now", "--query-name", "cli_test", "--checkpoint", str(tmp_path / "ckpt"),
    ])
    want = agency_winners(parse_records(with_batches(feed)).records)
    assert rows(read_history(spark, ResultTables(results), WINNERS)) == rows(want)


def test_path_tables_read_empty_before_any_batch(spark, tmp_path):
    tables = ResultTables(root=str(tmp_path / "results"))
    ensure_tables(spark, tables)
    ensure_tables(spark, tables)  # again: nothing changes
    for name in (WINNERS, SPEED, COUNTS, REJECTS):
        assert read_history(spark, tables, name).count() == 0
