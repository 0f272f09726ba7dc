"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

The flight feed is rendered from the ``events`` table (one line per row,
``line_no = event_id``), then everything runs through the same operators a
file or stream feed would: parse, batch by replay time, aggregate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import event_time
from ..operators import (
    ReplayClock,
    agency_counts,
    agency_winners,
    agency_winners_latest,
    batch_counts,
    batch_preview,
    first_lines,
    parse_records,
    render_records,
    speed_stats,
    speed_stats_latest,
    with_batches,
    word_count,
    word_count_lines,
)
from ..operators.replay import BATCH_INTERVAL_S
from ..schema import FIELD_NAMES
from ..session import checkpoint_path
from ..sources import (
    events_feed,
    first_file_lines,
    read_documents,
    read_events,
    read_events_feed,
    read_lines,
)
from ..streaming.consumer import FILES_PER_TRIGGER, start_consumer
from ..streaming.replay import BLOCK_LINES, deliver_to_folder, run_paced_replay, stage_lines, write_feed_files
from ..streaming.sink import (
    COUNTS,
    PREVIEW,
    REJECTS,
    SPEED,
    SPEED_PARTS,
    WINNERS,
    ResultTables,
    latest_views,
    read_history,
)
from ..streaming.source import (
    STAGED_SCHEMA,
    message_lines,
    place_lines,
    split_counts,
    split_lines_stream,
    staged_lines_stream,
    with_row_ids,
)

# Parameters of the registered queries.
AGENCY = "click"
FLIGHT = "F3"
FIRST_LINES_N = 20
PREVIEW_N = 10
PREVIEW_BATCH_S = 300  # 60 lines per batch, so that the preview limit bites
TOPIC_PARTITIONS = 4
# Lines of a block whose micro-batches split batches (no multiple of a batch's six lines).
SPLIT_BLOCK_LINES = 8_001
# A paced replay of the whole feed, at a pace that suits a query.
PACED_LINES, PACED_S = 25_000, 1.0
# Lines of each of the feed files that the first lines are taken from.
FIRST_FILE_LINES = 2_000

Query = Callable[[SparkSession, str], DataFrame]


def feed_lines(
    spark: SparkSession, sf_dir: str, batch_s: int | None = None, spread: bool = True
) -> DataFrame:
    lines = read_events_feed(spark, sf_dir, spread)
    if batch_s is None:
        return with_batches(lines)
    return with_batches(lines, batch_s=batch_s)


def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(feed_lines(spark, sf_dir)).records


def _folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint root."""
    return checkpoint_path(spark, name, uuid.uuid4().hex)


def q_replay_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed staged for a replay and read back, with its replay times."""
    folder = _folder(spark, "staged-feed")
    stage_lines(read_events_feed(spark, sf_dir), folder)
    staged = spark.read.schema(STAGED_SCHEMA).parquet(folder)
    return with_batches(staged).select("line_no", "arrival_s", "batch_no", "line")


def q_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as header-per-file text files, read back and numbered.

    Exercises the file source: header skip per file and line numbers over
    several files.
    """
    folder = _folder(spark, "feed-files")
    write_feed_files(read_events_feed(spark, sf_dir), folder, BLOCK_LINES)
    return with_batches(read_lines(spark, folder)).select("line_no", "batch_no", "line")


def q_first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines: the lowest numbers first, then only these are rendered."""
    first = first_lines(read_events(spark, sf_dir), FIRST_LINES_N, "event_id")
    return events_feed(first)


def q_batch_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feed_lines(spark, sf_dir, batch_s=PREVIEW_BATCH_S)
    return batch_preview(lines, PREVIEW_N).select("batch_no", "line_no", "line")


def q_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records' timestamps as seconds since 1970 (UTC)."""
    records = feed_records(spark, sf_dir)
    return records.select("line_no", F.unix_seconds(event_time(F.col("timestamp"))).alias("epoch_s"))


def q_message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The projection of topic messages, on a frame with a topic's columns."""
    feed = read_events_feed(spark, sf_dir)
    partition = (F.col("line_no") % TOPIC_PARTITIONS).cast("int")
    messages = feed.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("line").cast("binary").alias("value"),
        partition.alias("partition"),
        F.col("line_no").alias("offset"),
    )
    return message_lines(messages)


def q_parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_records(spark, sf_dir).select("line_no", *FIELD_NAMES)


def q_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(feed_lines(spark, sf_dir)).rejects.select("line_no", "line", "reason")


def q_render_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_records(feed_records(spark, sf_dir)).select("line_no", "text")


def q_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_counts(feed_records(spark, sf_dir))


def q_agency_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agency_counts(feed_records(spark, sf_dir))


def q_agency_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agency_winners(feed_records(spark, sf_dir))


def q_agency_winners_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agency_winners_latest(agency_winners(feed_records(spark, sf_dir)))


def q_speed_stats_agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The reference's own behaviour: all rows of the agency, labelled with
    # the configured flight id.
    return speed_stats(feed_records(spark, sf_dir), AGENCY, label=FLIGHT)


def q_speed_stats_agency_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed_stats(feed_records(spark, sf_dir), AGENCY, flight=FLIGHT)


def q_speed_stats_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed_stats_latest(speed_stats(feed_records(spark, sf_dir), AGENCY, label=FLIGHT))


def q_word_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count_lines(word_count(read_documents(spark, sf_dir)))


def drain_feed_through_consumer(
    spark: SparkSession,
    sf_dir: str,
    *outputs: str,
    block_lines: int = BLOCK_LINES,
    files: int = FILES_PER_TRIGGER,
    batch_s: int = BATCH_INTERVAL_S,
    database: str | None = None,
    **options,
) -> ResultTables:
    """Stage the whole feed in blocks and run the stream consumer over them.

    Exercises the streaming path end to end: staged source, ``foreachBatch``,
    one parse persisted per micro-batch, mergeable parts.  A micro-batch
    takes a fixed number of blocks of fixed size; results are keyed by the
    replay time of the lines, so they are those of the batch queries however
    blocks, files and micro-batches fall.
    """
    root = _folder(spark, "stream-replay")
    stage_lines(read_events_feed(spark, sf_dir), f"{root}/staged", block_lines)
    tables = ResultTables(f"{root}/results", database)
    staged = staged_lines_stream(spark, f"{root}/staged", files)
    query = start_consumer(
        with_batches(staged, batch_s=batch_s).drop("arrival_s"),
        tables,
        agency=AGENCY,
        label=FLIGHT,
        query_name=f"feed_replay_{uuid.uuid4().hex[:12]}",
        checkpoint=f"{root}/checkpoint",
        available_now=True,
        batches_from_input=True,
        outputs=outputs,
        **options,
    )
    query.awaitTermination()  # raises if the stream failed
    return tables


def q_stream_agency_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_history(spark, drain_feed_through_consumer(spark, sf_dir, COUNTS), WINNERS)


def q_stream_agency_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_history(spark, drain_feed_through_consumer(spark, sf_dir, COUNTS), COUNTS)


def q_stream_speed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_history(spark, drain_feed_through_consumer(spark, sf_dir, SPEED_PARTS), SPEED)


def q_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = read_history(spark, drain_feed_through_consumer(spark, sf_dir, REJECTS), REJECTS)
    return rejects.select("batch_no", "line_no", "line", "reason")


def q_stream_batch_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of every batch, kept by the consumer as a table."""
    tables = drain_feed_through_consumer(spark, sf_dir, batch_s=PREVIEW_BATCH_S, preview_rows=PREVIEW_N)
    return read_history(spark, tables, PREVIEW).select("batch_no", "line_no", "line")


def q_stream_closed_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winners of the batches that are known to be complete: the feed's last batch is open
    unless its lines end with it."""
    tables = drain_feed_through_consumer(spark, sf_dir, COUNTS, clock=ReplayClock())
    return read_history(spark, tables, WINNERS, closed=True)


def q_latest_from_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current winners of a replay whose blocks split batches, with a snapshot after every micro-batch."""
    tables = drain_feed_through_consumer(
        spark, sf_dir, COUNTS, SPEED_PARTS, block_lines=SPLIT_BLOCK_LINES, files=1, snapshot_every=1
    )
    return latest_views(spark, tables, "current_")[WINNERS]


def q_folded_speed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed statistics from a history that is folded after every second micro-batch."""
    tables = drain_feed_through_consumer(
        spark, sf_dir, SPEED_PARTS, block_lines=SPLIT_BLOCK_LINES, files=1, fold_every=2
    )
    return read_history(spark, tables, SPEED)


def q_catalog_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winners through the catalog view of the reference's table name, created before any batch."""
    tables = drain_feed_through_consumer(spark, sf_dir, COUNTS, database=f"skyledger_{uuid.uuid4().hex[:12]}")
    return spark.read.table(tables.table(WINNERS))


def q_first_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of the feed's files, of which only the leading ones are opened."""
    folder = _folder(spark, "feed-files")
    write_feed_files(read_events_feed(spark, sf_dir), folder, FIRST_FILE_LINES)
    return first_file_lines(spark, folder, FIRST_LINES_N).select("line_no", "line")


def q_stream_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of feed files with their places, streamed by byte range."""
    root = _folder(spark, "stream-files")
    write_feed_files(read_events_feed(spark, sf_dir), f"{root}/files", BLOCK_LINES)

    def place(batch: DataFrame, number: int) -> None:
        lines = with_row_ids(batch).persist()
        try:
            placed = place_lines(lines, split_counts(lines)).select("source_file", "file_line_no", "line")
            placed.write.mode("overwrite").parquet(f"{root}/lines/micro_batch={number}")
        finally:
            lines.unpersist()

    stream = split_lines_stream(spark, f"{root}/files", FILES_PER_TRIGGER).writeStream.foreachBatch(place)
    stream.trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint").start().awaitTermination()
    number = F.regexp_extract("source_file", "/file=([0-9]+)/", 1).cast("bigint")
    lines = spark.read.parquet(f"{root}/lines")
    return lines.select(number.alias("file_no"), "file_line_no", "line")


def q_paced_replay_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed delivered step by step at a fixed pace, with the step of each line."""
    root = _folder(spark, "paced-replay")
    stage_lines(read_events_feed(spark, sf_dir), f"{root}/staged")
    run_paced_replay(
        spark,
        f"{root}/staged",
        deliver_to_folder(f"{root}/arrived"),
        PACED_LINES,
        PACED_S,
        f"{root}/checkpoint",
        query_name=f"paced_{uuid.uuid4().hex[:12]}",
    )
    arrived = spark.read.parquet(f"{root}/arrived")
    return arrived.select(F.col("step").cast("bigint").alias("step"), "line_no", "line")


def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(read_documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "replay_lines": q_replay_lines,
    "file_lines": q_file_lines,
    "first_lines": q_first_lines,
    "batch_preview": q_batch_preview,
    "parse_records": q_parse_records,
    "rejects": q_rejects,
    "render_records": q_render_records,
    "event_times": q_event_times,
    "message_lines": q_message_lines,
    "batch_counts": q_batch_counts,
    "agency_counts": q_agency_counts,
    "agency_winners": q_agency_winners,
    "agency_winners_latest": q_agency_winners_latest,
    "speed_stats_agency": q_speed_stats_agency,
    "speed_stats_agency_flight": q_speed_stats_agency_flight,
    "speed_stats_latest": q_speed_stats_latest,
    "word_count": q_word_count,
    "word_count_lines": q_word_count_lines,
    "stream_agency_winners": q_stream_agency_winners,
    "stream_agency_counts": q_stream_agency_counts,
    "stream_speed_stats": q_stream_speed_stats,
    "stream_rejects": q_stream_rejects,
    "first_file_lines": q_first_file_lines,
    "stream_batch_preview": q_stream_batch_preview,
    "stream_closed_winners": q_stream_closed_winners,
    "stream_file_lines": q_stream_file_lines,
    "latest_from_snapshot": q_latest_from_snapshot,
    "folded_speed_stats": q_folded_speed_stats,
    "catalog_winners": q_catalog_winners,
    "paced_replay_lines": q_paced_replay_lines,
}

# Queries that run a stream to completion; the bench times them apart.
STREAM_QUERIES = (
    "stream_agency_winners",
    "stream_agency_counts",
    "stream_speed_stats",
    "stream_rejects",
    "stream_batch_preview",
    "stream_closed_winners",
    "stream_file_lines",
    "latest_from_snapshot",
    "folded_speed_stats",
    "catalog_winners",
    "paced_replay_lines",
)
