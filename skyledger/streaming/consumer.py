"""The stream consumer: parse each micro-batch once, write its mergeable parts.

``FeedBatchWriter`` is the ``foreachBatch`` function.  The batch key is the
micro-batch id (live), or the input's own ``batch_no`` (a replay, keyed by
``with_batches`` from the line number), so every operator is the same one the
batch job uses.  The parsed batch is persisted for its outputs, which are
written by concurrent jobs, and released after.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.aggregates import agency_counts, speed_parts
from ..operators.parse import parse_lines, split_parsed
from ..operators.replay import ReplayClock
from ..session import checkpoint_path
from .sink import (
    COUNTS,
    LINES,
    PREVIEW,
    REJECTS,
    SPEED_PARTS,
    CommitFacts,
    CommitLog,
    ResultTables,
    ensure_tables,
    fold_history,
    is_committed,
    is_current,
    lines_from,
    low_line,
    merge_parts,
    preview_parts,
    read_log,
    snapshot_current,
    write_attempt,
)
from .source import SPLIT_COLUMNS, place_lines, split_counts, with_row_ids

BATCH_SECONDS = 30
# Bounds of one micro-batch, which is persisted: files, or messages of a topic.
FILES_PER_TRIGGER = 8
MESSAGES_PER_TRIGGER = 1_000_000
OUTPUTS = (COUNTS, SPEED_PARTS, REJECTS)


@dataclass
class FeedBatchWriter:
    tables: ResultTables
    agency: str
    flight: str | None = None
    label: str | None = None
    outputs: tuple[str, ...] = OUTPUTS
    echo_rows: int = 0  # > 0: print up to this many agency counts per batch (all are in COUNTS)
    preview_rows: int = 0  # > 0: keep the first so many lines of every batch (in PREVIEW)
    snapshot_every: int = 0  # > 0: rewrite the current tables every N micro-batches
    fold_every: int = 0  # > 0: fold the history every N micro-batches
    # True: the input's own batch_no column is the batch key; otherwise the micro-batch id is.
    batches_from_input: bool = False
    clock: ReplayClock | None = None  # of a replay: tells which batches are complete
    header_lines: int = 1  # of a file whose lines come by byte range
    on_error: str = "reject"  # "fail": the first bad line fails the stream

    # What this writer knows of the tables, so that it need not look after every micro-batch.
    _log: CommitLog | None = field(default=None, init=False, repr=False)
    _low_line: int | None = field(default=None, init=False, repr=False)

    def __post_init__(self) -> None:
        if self.clock and not self.batches_from_input:
            raise ValueError("a replay clock needs the batches of the input")

    def results(self, parsed: DataFrame) -> dict[str, DataFrame]:
        """Parts of one parsed micro-batch (``parse_lines`` output with ``batch_no``)."""
        split = split_parsed(parsed)
        out = {}
        if COUNTS in self.outputs:
            out[COUNTS] = agency_counts(split.records)
        if SPEED_PARTS in self.outputs:
            out[SPEED_PARTS] = speed_parts(split.records, self.agency, self.flight, self.label)
        if REJECTS in self.outputs:
            out[REJECTS] = _located(split.rejects)
        if self.preview_rows > 0:
            columns = ("batch_no", "source_file", "partition", "line_no", "line")
            out[PREVIEW] = preview_parts(_located(parsed).select(*columns), self.preview_rows)
        if self.clock:
            out[LINES] = parsed.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_lines"))
        return out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self._is_done(spark, batch_id):  # the stream stopped between the commit and its own log
            return
        try:
            self._take(spark, batch, batch_id)
        except BaseException:
            self._log = None  # what was committed is to be read again
            raise

    def _take(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        key = "batch_no" if self.batches_from_input else int(batch_id)
        others = [f"`{c}`" for c in batch.columns if c != "batch_no"]
        lines = batch.selectExpr(f"CAST({key} AS BIGINT) AS batch_no", *others)
        if batch.rdd.getNumPartitions() == 1:
            # One task has it all: said to the planner, nothing is exchanged between tasks.
            lines = lines.coalesce(1)
        by_split = set(SPLIT_COLUMNS) <= set(lines.columns)
        if by_split:
            lines = with_row_ids(lines)
        # Raw text is kept for rejected lines only, unless it is to be shown: the persisted batch stays narrow.
        # Headers are still among the lines of byte ranges, and are no bad lines.
        early = "reject" if by_split else self.on_error
        parsed = parse_lines(lines, keep_good_lines=self.preview_rows > 0, on_error=early)
        kept = []
        if by_split or self.echo_rows > 0 or self._n_results() > 1:
            kept.append(parsed.persist(StorageLevel.MEMORY_AND_DISK))
        try:
            if by_split:
                kept.append(split_counts(parsed).persist(StorageLevel.MEMORY_AND_DISK))
                parsed = place_lines(parsed, kept[-1], self.header_lines)
                if self.on_error == "fail":
                    _fail_on_bad(split_parsed(parsed).rejects)
            if self.echo_rows > 0:
                counts = agency_counts(split_parsed(parsed).records)
                counts.orderBy(F.col("n").desc(), "agency").show(self.echo_rows, truncate=False)
            # The outputs read the same persisted parse; their jobs run side by side.
            results = self.results(parsed)
            if results:
                seen = parsed if kept else lines  # a single output parses the lines, nothing else need do so
                facts = write_attempt(results, batch_id, self.tables, lambda: self._facts(seen, results), self._log)
                self._low_line = facts.low_line
        finally:
            for frame in kept:
                frame.unpersist()
        if self.snapshot_every > 0 and (batch_id + 1) % self.snapshot_every == 0:
            snapshot_current(spark, self.tables, batch_id, self._log)
        if self.fold_every > 0 and (batch_id + 1) % self.fold_every == 0:
            fold_history(spark, self.tables, self._log)

    def _is_done(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether the micro-batch is committed; numbers rise, so one look at the tables serves until one comes back
        or another process folds them."""
        if self._log is None or not is_current(spark, self.tables, self._log):
            self._log = read_log(spark, self.tables)
        newest = self._log.last()
        return newest is not None and batch_id <= newest and is_committed(spark, self.tables, batch_id)

    def _n_results(self) -> int:
        stored = [name for name in OUTPUTS if name in self.outputs]
        return len(stored) + (self.preview_rows > 0) + (self.clock is not None)

    def _facts(self, seen: DataFrame, results: dict[str, DataFrame]) -> CommitFacts | None:
        """What the commit record says of a replay's micro-batch, from its lines."""
        if not self.batches_from_input:
            return None
        ends = seen.selectExpr("min(batch_no) AS first", "max(batch_no) AS last").first()
        if not self.clock:
            return CommitFacts(None, None, *ends)
        spark, clock = seen.sparkSession, self.clock
        low = low_line(spark, self.tables) if self._low_line is None else self._low_line
        # Only batches at or above the mark can close; earlier parts of theirs are few.
        start = clock.closed_upto(low)
        before = lines_from(spark, self.tables, start, self._log)
        found = merge_parts(before.unionByName(results[LINES]), LINES).filter(F.col("batch_no") >= start)
        low = max(low, _low_line(found, clock, low))
        return CommitFacts(clock.closed_upto(low), low, *ends)


def _low_line(seen: DataFrame, clock: ReplayClock, low: int) -> int:
    """The first line from ``low`` on that does not belong to a complete batch of ``seen``.

    A complete batch covers the lines up to the first one of the next batch;
    the mark is the least of these ends that no other complete batch begins at.
    """
    begin, end = clock.first_line(F.col("batch_no")), clock.first_line(F.col("batch_no") + 1)
    covered = seen.select(begin.alias("begin"), end.alias("end"), "n_lines")
    covered = covered.filter((F.col("n_lines") >= F.col("end") - F.col("begin")) & (F.col("end") > F.col("begin")))
    ends = covered.select(F.col("end").alias("at")).unionByName(covered.sparkSession.range(low, low + 1).toDF("at"))
    gaps = ends.filter(F.col("at") >= low).join(covered, F.col("at") == F.col("begin"), "left_anti")
    return gaps.agg(F.min("at")).first()[0]


def _located(lines: DataFrame) -> DataFrame:
    """Lines with all columns that say where they were: of a topic, a replay or a file."""
    if "line_no" not in lines.columns and "file_line_no" in lines.columns:
        lines = lines.withColumn("line_no", F.col("file_line_no"))
    for column in ("line_no", "partition", "source_file"):
        if column not in lines.columns:
            lines = lines.withColumn(column, F.lit(None))
    return lines


def _fail_on_bad(rejects: DataFrame) -> None:
    bad = rejects.select("reason", "line").first()
    if bad:
        raise ValueError(f"bad feed line ({bad['reason']}): {bad['line']}")


def start_consumer(
    lines_stream: DataFrame,
    tables: ResultTables,
    agency: str,
    flight: str | None = None,
    label: str | None = None,
    query_name: str = "feed_consumer",
    checkpoint: str | None = None,
    batch_seconds: int | None = BATCH_SECONDS,
    available_now: bool = False,
    **writer_options,
) -> StreamingQuery:
    """Start the consumer; parts go to ``tables`` per micro-batch.

    The tables are created first if absent (empty until a batch).
    ``writer_options`` are further fields of ``FeedBatchWriter``.

    The checkpoint defaults to a folder under the session's shared
    checkpoint root, so a restarted query resumes at its last offsets.
    """
    spark = lines_stream.sparkSession
    ensure_tables(spark, tables)
    location = checkpoint or checkpoint_path(spark, "streams", query_name)
    writer = (
        lines_stream.writeStream.queryName(query_name)
        .foreachBatch(FeedBatchWriter(tables, agency, flight, label, **writer_options))
        .option("checkpointLocation", location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif batch_seconds:
        writer = writer.trigger(processingTime=f"{int(batch_seconds)} seconds")
    return writer.start()


def start_preview(lines_stream: DataFrame, rows: int = 10, checkpoint: str | None = None) -> StreamingQuery:
    """Print the first ``rows`` lines of each micro-batch to the console."""
    spark = lines_stream.sparkSession
    location = checkpoint or checkpoint_path(spark, "streams", "feed_preview")
    return (
        lines_stream.writeStream.format("console")
        .option("numRows", rows)
        .option("truncate", "false")
        .option("checkpointLocation", location)
        .start()
    )


def main(argv: list[str] | None = None) -> None:
    """Run the consumer until stopped (or, with ``--available-now``, until drained)."""
    import argparse

    from ..operators.replay import BATCH_INTERVAL_S, PUBLISH_INTERVAL_S, with_batches
    from ..session import build_session
    from .source import FEED_TOPIC, kafka_lines_stream, split_lines_stream, staged_lines_stream

    ap = argparse.ArgumentParser(description="Flight-segment feed stream consumer")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input-dir", help="folder of feed files (one header line each)")
    src.add_argument("--staged-dir", help="folder of staged lines; results are keyed by replay time")
    src.add_argument("--kafka", help="bootstrap servers")
    ap.add_argument("--interval-s", type=int, default=PUBLISH_INTERVAL_S, help="staged-dir: seconds per line")
    ap.add_argument("--batch-s", type=int, default=BATCH_INTERVAL_S, help="staged-dir: seconds per batch")
    ap.add_argument("--topic", default=FEED_TOPIC)
    ap.add_argument("--starting-offsets", default="latest")
    ap.add_argument(
        "--max-per-trigger", type=int,
        help=f"per micro-batch: files (default {FILES_PER_TRIGGER}) or messages (default {MESSAGES_PER_TRIGGER})",
    )
    ap.add_argument(
        "--min-partitions", type=int, help="topic only: split topic partitions into at least this many tasks"
    )
    ap.add_argument("--results", required=True, help="result root, ideally with a run id")
    ap.add_argument("--database")
    ap.add_argument("--agency", required=True)
    ap.add_argument("--flight")
    ap.add_argument("--label")
    ap.add_argument("--on-error", choices=("reject", "fail"), default="reject")
    ap.add_argument("--batch-seconds", type=int, default=BATCH_SECONDS)
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--echo-rows", type=int, default=0)
    ap.add_argument("--preview-rows", type=int, default=0, help="keep the first N lines of every batch")
    ap.add_argument("--snapshot-every", type=int, default=0, help="rewrite current tables every N micro-batches")
    ap.add_argument("--fold-every", type=int, default=0, help="fold the history every N micro-batches")
    ap.add_argument("--feed-lines", type=int, help="staged-dir: lines of the whole feed, closes its last batch")
    ap.add_argument("--run-id", help="keeps this run's history apart (use one per checkpoint)")
    ap.add_argument("--query-name", default="feed_consumer")
    ap.add_argument(
        "--checkpoint", help="default: <spark.checkpoint.dir>/streams/<query name>; one per consumer"
    )
    ap.add_argument("--master")
    args = ap.parse_args(argv)

    spark = build_session(args.master, app_name="skyledger-consumer")
    files = args.max_per_trigger or FILES_PER_TRIGGER
    # With all lines due at once there is one batch, and nothing to follow.
    follows = args.staged_dir and args.interval_s > 0
    clock = ReplayClock(args.interval_s, args.batch_s, args.feed_lines) if follows else None
    if args.kafka:
        lines = kafka_lines_stream(
            spark,
            args.kafka,
            args.topic,
            args.starting_offsets,
            args.max_per_trigger or MESSAGES_PER_TRIGGER,
            min_partitions=args.min_partitions or spark.sparkContext.defaultParallelism,
        )
    elif args.staged_dir:
        staged = staged_lines_stream(spark, args.staged_dir, files)
        lines = with_batches(staged, args.interval_s, args.batch_s).drop("arrival_s")
    else:
        lines = split_lines_stream(spark, args.input_dir, files)
    query = start_consumer(
        lines,
        ResultTables(args.results, args.database, args.run_id),
        args.agency,
        args.flight,
        args.label,
        batch_seconds=args.batch_seconds,
        available_now=args.available_now,
        echo_rows=args.echo_rows,
        preview_rows=args.preview_rows,
        snapshot_every=args.snapshot_every,
        fold_every=args.fold_every,
        batches_from_input=bool(args.staged_dir),
        clock=clock,
        on_error=args.on_error,
        query_name=args.query_name,
        checkpoint=args.checkpoint,
    )
    query.awaitTermination()


if __name__ == "__main__":
    main()
