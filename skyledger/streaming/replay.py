"""Replay of feed lines into a stream's input: staged blocks, feed files or a topic.

The reference sends one line every few seconds from a single loop.  Here the
lines are staged by one Spark job and delivered in steps: a paced replay is a
stream whose trigger is the clock and whose rate source says which line numbers
are due, so that every step moves the lines of one batch, however large
(``start_paced_replay``).  Without pacing the consumer's rate limit
(``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``) bounds a micro-batch.  Either
way the replay time of a line follows from its number (``with_batches``).
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import HEADER_LINE
from ..session import path_exists
from .source import FEED_TOPIC, STAGED_SCHEMA

# Lines of one staged block: 10,000 batches of the reference (6 lines each), about 9 MB.
BLOCK_LINES = 60_000


def stage_lines(
    lines: DataFrame,
    path: str,
    block_lines: int = BLOCK_LINES,
    line_col: str = "line",
    order_col: str = "line_no",
) -> None:
    """Write ``(line_no, line)`` as parquet, a folder ``block=<n>`` per ``block_lines`` line numbers.

    A line is kept byte for byte, null lines too.  The block size is fixed,
    so the work of a micro-batch of so many blocks does not depend on the
    size of the feed; a multiple of a batch's lines keeps most batches in
    one block, but nothing relies on it.
    """
    if block_lines <= 0:
        raise ValueError("block_lines must be > 0")
    staged = lines.select(
        F.expr(f"`{order_col}` div {int(block_lines)}").alias("block"),
        F.col(order_col).cast("bigint").alias("line_no"),
        F.col(line_col).alias("line"),
    )
    (
        staged.repartition("block")
        .sortWithinPartitions("block", "line_no")
        .write.mode("overwrite")
        .partitionBy("block")
        .parquet(path)
    )


def write_feed_files(
    lines: DataFrame,
    path: str,
    lines_per_file: int,
    line_col: str = "line",
    order_col: str = "line_no",
) -> None:
    """Write ``lines`` as text feed files in line order, a header in each.

    A file holds the lines whose numbers fall in one block of
    ``lines_per_file`` consecutive numbers, byte for byte (a null line is an
    empty one).  Files live in ``path/file=<block number, zero-padded>/``, so
    path order is line order, and reading the folder back with ``read_lines``
    restores the numbers.
    """
    if lines_per_file <= 0:
        raise ValueError("lines_per_file must be > 0")
    block = f"lpad(CAST(`{order_col}` div {int(lines_per_file)} AS STRING), 20, '0')"
    text = F.coalesce(F.col(line_col), F.lit(""))
    staged = lines.select(F.expr(block).alias("file"), F.col(order_col).alias("_order"), text.alias("value"))
    first = F.row_number().over(Window.partitionBy("file").orderBy("_order")) == 1
    with_header = F.when(first, F.concat(F.lit(HEADER_LINE + "\n"), "value")).otherwise(F.col("value"))
    (
        staged.withColumn("value", with_header)
        .sortWithinPartitions("file", "_order")
        .select("file", "value")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 0)  # a second file of a block would lack its header
        .partitionBy("file")
        .text(path)
    )


def topic_write_options(bootstrap_servers: str, topic: str = FEED_TOPIC) -> dict[str, str]:
    """Writer options of the topic sink."""
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}


def publish_to_topic(
    lines: DataFrame,
    bootstrap_servers: str,
    topic: str = FEED_TOPIC,
    line_col: str = "line",
) -> None:
    """Send every line as one message with a null key (needs the Kafka connector)."""
    (
        lines.select(F.col(line_col).cast("string").alias("value"))
        .write.format("kafka")
        .options(**topic_write_options(bootstrap_servers, topic))
        .save()
    )


def publish_stream_to_topic(
    lines_stream: DataFrame,
    bootstrap_servers: str,
    checkpoint: str,
    topic: str = FEED_TOPIC,
    line_col: str = "line",
    trigger_s: float | None = None,
):
    """Forward a stream of lines to a topic (needs the Kafka connector), a step every ``trigger_s`` seconds.

    The checkpoint makes the forwarding resume after a stop.  A stream of
    files forwards what has arrived; a paced replay of staged lines is
    ``start_paced_replay`` with ``deliver_to_topic``.
    """
    writer = (
        lines_stream.select(F.col(line_col).cast("string").alias("value"))
        .writeStream.format("kafka")
        .options(**topic_write_options(bootstrap_servers, topic))
        .option("checkpointLocation", checkpoint)
    )
    if trigger_s is not None:
        writer = writer.trigger(processingTime=f"{round(trigger_s * 1000)} milliseconds")
    return writer.start()


Deliver = Callable[[DataFrame, int], None]


def deliver_to_folder(path: str) -> Deliver:
    """Deliveries as parquet ``(line_no, line, arrived_at)`` in a folder ``step=<n>`` each.

    ``staged_lines_stream`` of the folder sees a step when it is complete; a
    step that is delivered again replaces itself.
    """

    def deliver(lines: DataFrame, step: int) -> None:
        stamped = lines.withColumn("arrived_at", F.current_timestamp())
        stamped.write.mode("overwrite").parquet(f"{path.rstrip('/')}/step={step:012d}")

    return deliver


def deliver_to_topic(bootstrap_servers: str, topic: str = FEED_TOPIC) -> Deliver:
    """Deliveries as messages of a topic (needs the Kafka connector)."""
    return lambda lines, step: publish_to_topic(lines, bootstrap_servers, topic)


def staged_range(spark: SparkSession, staged: str, first: int, last: int, block_lines: int = BLOCK_LINES) -> DataFrame:
    """The staged lines with numbers ``first`` to ``last``; only their blocks are listed and read."""
    blocks = range(first // block_lines, last // block_lines + 1)
    folders = [f"{staged.rstrip('/')}/block={block}" for block in blocks]
    folders = [f for f in folders if path_exists(spark, f)]
    if not folders and path_exists(spark, staged):
        return spark.createDataFrame([], STAGED_SCHEMA)
    lines = spark.read.schema(STAGED_SCHEMA).parquet(*(folders or [staged]))
    return lines.filter(F.col("line_no").between(first, last)).select("line_no", "line")


def start_paced_replay(
    spark: SparkSession,
    staged: str,
    deliver: Deliver,
    lines_per_step: int,
    step_s: float,
    checkpoint: str,
    block_lines: int = BLOCK_LINES,
    query_name: str = "paced_replay",
    last_line: int | None = None,
) -> StreamingQuery:
    """Deliver the lines of ``stage_lines`` in order, ``lines_per_step`` of them every ``step_s`` seconds.

    The stream's trigger is the clock.  Its source counts line numbers, a fixed
    number for each micro-batch, and its checkpoint knows the next one, so a
    restarted replay goes on where it stopped.  A step that is late shifts
    those after it and is not made up for by a burst.  Steps after the last
    line deliver nothing; if ``last_line`` names it, they read nothing either.
    """
    due = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", int(lines_per_step))
        .option("numPartitions", 1)
        .load()
    )

    began: list[float] = []

    def step(numbers: DataFrame, number: int) -> None:
        # Triggers fall on multiples of the interval, the first one anywhere between: its pause is a whole one too.
        if began:
            time.sleep(max(0.0, began.pop() + step_s - time.monotonic()))
        began.append(time.monotonic())
        # A micro-batch's numbers are a range, and follow from its own number.
        first = number * int(lines_per_step)
        if last_line is not None and first > last_line:
            return
        lines = staged_range(spark, staged, first, first + int(lines_per_step) - 1, block_lines)
        if not lines.isEmpty():
            deliver(lines, number)

    return (
        due.writeStream.queryName(query_name)
        .foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{round(step_s * 1000)} milliseconds")
        .start()
    )


def run_paced_replay(
    spark: SparkSession, staged: str, deliver: Deliver, lines_per_step: int, step_s: float, checkpoint: str, **options
) -> None:
    """``start_paced_replay``, stopped when the last staged line has been delivered."""
    last = spark.read.schema(STAGED_SCHEMA).parquet(staged).agg(F.max("line_no")).first()[0]
    if last is None:
        return
    done = last // int(lines_per_step)
    options["last_line"] = last
    query = start_paced_replay(spark, staged, deliver, lines_per_step, step_s, checkpoint, **options)
    try:
        while not query.awaitTermination(min(1.0, step_s)):
            progress = query.lastProgress
            if progress and progress["batchId"] >= done:  # reported when the step has ended
                return
        raise query.exception() or RuntimeError("the replay ended before its last line")
    finally:
        query.stop()


def main(argv: list[str] | None = None) -> None:
    """Replay feed files: to a topic, or as staged blocks for a stream.

    The header of every input file is skipped and lines keep file order.
    ``--kafka`` sends each line as one message with a null key;
    ``--output-dir`` writes blocks of ``--block-lines`` lines, to be read
    with the consumer's ``--staged-dir``.  With ``--pace`` the lines are
    staged first and then delivered at one line every ``--interval-s``
    seconds, those of ``--batch-s`` seconds in a step.
    """
    import argparse

    import uuid

    from ..operators.replay import BATCH_INTERVAL_S, PUBLISH_INTERVAL_S
    from ..session import build_session, checkpoint_path
    from ..sources import read_lines

    ap = argparse.ArgumentParser(description="Flight-segment feed replay")
    ap.add_argument("--input", required=True, nargs="+", help="feed files or folders")
    dest = ap.add_mutually_exclusive_group(required=True)
    dest.add_argument("--kafka", help="bootstrap servers")
    dest.add_argument("--output-dir", help="folder for the staged blocks")
    ap.add_argument("--topic", default=FEED_TOPIC)
    ap.add_argument("--block-lines", type=int, default=BLOCK_LINES)
    ap.add_argument("--pace", action="store_true", help="deliver lines when they are due")
    ap.add_argument("--interval-s", type=float, default=PUBLISH_INTERVAL_S, help="seconds per line")
    ap.add_argument("--batch-s", type=float, default=BATCH_INTERVAL_S, help="seconds per step")
    ap.add_argument("--master")
    args = ap.parse_args(argv)

    spark = build_session(args.master, app_name="skyledger-replay")
    lines = read_lines(spark, args.input)
    if args.pace:
        if args.interval_s <= 0 or args.batch_s <= 0:
            ap.error("--pace needs --interval-s and --batch-s above 0")
        root = checkpoint_path(spark, "paced-replay", uuid.uuid4().hex)
        stage_lines(lines, f"{root}/staged", block_lines=args.block_lines)
        deliver = deliver_to_topic(args.kafka, args.topic) if args.kafka else deliver_to_folder(args.output_dir)
        lines_per_step = max(1, round(args.batch_s / args.interval_s))
        run_paced_replay(
            spark, f"{root}/staged", deliver, lines_per_step, args.batch_s, f"{root}/checkpoint",
            block_lines=args.block_lines,
        )
    elif args.kafka:
        publish_to_topic(lines, args.kafka, args.topic)
    else:
        stage_lines(lines, args.output_dir, block_lines=args.block_lines)


if __name__ == "__main__":
    main()
