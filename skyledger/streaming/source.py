"""Streaming line sources: folders of feed files or staged lines, or a message topic.

All return a streaming DataFrame with a string column ``line``, byte for byte
as it was written; the topic source also carries partition and offset, which
identify a line, and the file source the file and byte range that a line is in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: the reference's topic name.
FEED_TOPIC = "feds"

STAGED_SCHEMA = "line_no BIGINT, line STRING"


# Columns of lines whose place in their file is not worked out yet.
SPLIT_COLUMNS = ("source_file", "split_start")


def split_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of files arriving in ``path``: ``(line, source_file, split_start)``.

    Files are cut into byte ranges like those of a batch read, so a file of
    any size is read by many tasks.  Headers are still among the lines: which
    line is the first of a file shows only when a micro-batch is read
    (``place_lines``, which the consumer applies).
    """
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("split_start"),
    )


def with_row_ids(lines: DataFrame) -> DataFrame:
    """Lines of one micro-batch with ``row_id``, which rises along every byte range."""
    return lines.withColumn("row_id", F.monotonically_increasing_id())


def split_counts(lines: DataFrame) -> DataFrame:
    """A row for each byte range of the micro-batch: its first row id, and the lines of its file before it."""
    counts = lines.groupBy(*SPLIT_COLUMNS).agg(F.min("row_id").alias("first_row"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("source_file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).drop("rows")


def place_lines(lines: DataFrame, splits: DataFrame, header_lines: int = 1) -> DataFrame:
    """``with_row_ids`` lines with ``file_line_no``, without the first ``header_lines`` lines of each file.

    A file belongs to one micro-batch, and the lines of a byte range to one
    task, in order; so a line's place is its row id less the first one of its
    range, plus the lines in the earlier ranges of its file (``split_counts``
    of the same, persisted, lines).  Lines of any content and blank ones count.
    """
    at = (F.col("before") + F.col("row_id") - F.col("first_row") - header_lines).cast("bigint")
    placed = lines.join(splits, list(SPLIT_COLUMNS)).withColumn("file_line_no", at)
    return placed.filter(F.col("file_line_no") >= 0).drop("row_id", "split_start", "first_row", "before")


def file_lines_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = 1,
    header_lines: int = 1,
) -> DataFrame:
    """Lines of files arriving in ``path``: ``(line, source_file, file_line_no)``.

    The first ``header_lines`` lines of a file are dropped by position; every
    other line is kept as it is, blank ones too.  A file is read whole by one
    task (it must be under 2 GB), which gives every line its place without a
    second look at the micro-batch: the reader for files of a batch or a few.
    ``split_lines_stream`` reads files of any size.
    ``max_files_per_trigger`` paces the replay: with one file per batch of
    lines, every micro-batch sees exactly one file.
    """
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    files = reader.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("source_file"))
    # As the batch reader has it: LF, CR LF or CR ends a line, and the last end opens no new line.
    text = F.regexp_replace("value", r"(\r\n|\n|\r)\z", "")
    lines = F.when(F.col("value") == "", F.array().cast("array<string>")).otherwise(F.split(text, r"\r\n|\n|\r", -1))
    return (
        files.select("source_file", F.posexplode(lines).alias("at", "line"))
        .filter(F.col("at") >= header_lines)
        .select("line", "source_file", (F.col("at") - header_lines).cast("bigint").alias("file_line_no"))
    )


def staged_lines_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = 1
) -> DataFrame:
    """``(line_no, line)`` of the blocks that ``stage_lines`` wrote to ``path``."""
    reader = spark.readStream.schema(STAGED_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(path).select("line_no", "line")


def topic_read_options(
    bootstrap_servers: str,
    topic: str = FEED_TOPIC,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options of the topic source."""
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions is not None:
        options["minPartitions"] = str(int(min_partitions))
    return options


def message_lines(messages: DataFrame) -> DataFrame:
    """``(line, partition, line_no)`` of a frame with a topic's columns; ``line_no`` is the offset."""
    return messages.select(
        F.col("value").cast("string").alias("line"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("line_no"),
    )


def kafka_lines_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = FEED_TOPIC,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    extra_options: dict[str, str] | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Lines from a topic, see ``message_lines``.

    ``startingOffsets`` defaults to ``latest`` like the reference's effective
    setting; the query's checkpoint makes a restart resume where it stopped.
    A topic with few partitions reads into as few tasks, and the parse of a
    micro-batch runs in them: ``min_partitions`` (the source's
    ``minPartitions``) cuts large topic partitions into offset ranges so a
    micro-batch spreads over at least that many tasks.
    Needs the Spark Kafka connector on the classpath.
    """
    options = topic_read_options(
        bootstrap_servers, topic, starting_offsets, max_offsets_per_trigger, min_partitions
    )
    reader = spark.readStream.format("kafka").options(**options, **(extra_options or {}))
    return message_lines(reader.load())
