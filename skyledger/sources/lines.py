"""Line sources: feed files read as text, with stable line numbers.

``read_lines`` numbers lines without putting them into one task: a text
scan keeps the lines of one file split together and in order, so a line's
position is ``row id - first row id of its split`` plus the number of lines
in the earlier splits of the same file and in earlier files.  The split
table has one row per file split (input bytes / split size), is written as
a parquet table to the shared checkpoint folder, and joined back by
broadcast when its estimated size allows, by a shuffle join when it does not.
Two passes over the text, like ``zipWithIndex``, and no sort of the lines.

Both passes must cut the files into the same splits.  Spark sizes splits
from ``spark.sql.files.minPartitionNum`` or, when unset, from the live
executor core count, which can change between passes under dynamic
allocation; so that setting is pinned when unset, and a line whose split
is missing from the table fails the job instead of being dropped.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_path

# Split tables up to this estimated size are broadcast, larger ones joined by
# a shuffle; the lines are the same either way.  A row is a file path and four
# longs: 160 MB is about a million splits with 100-character paths (100 TB in
# 128 MB splits is 800,000), for which the driver should have 4 GB.
MAX_BROADCAST_BYTES = 160 * 1024 * 1024
_SPLIT_ROW_FIXED_BYTES = 48


# Lines that ``first_file_lines`` brings to the driver at most.
MAX_FIRST_LINES = 1_000_000

SPLITS_CHANGED = (
    "file splits differ between the two passes of read_lines; "
    "keep spark.sql.files.* settings fixed while it runs"
)


def pin_split_sizing(spark: SparkSession) -> None:
    """Make file split sizes independent of the current executor count."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def _per_split(raw: DataFrame) -> DataFrame:
    """One row per file split: its first row id and its number of lines."""
    return raw.groupBy("source_file", "_split").agg(
        F.min("_row_id").alias("_first_row"), F.count(F.lit(1)).alias("_rows")
    )


def _split_table(splits: DataFrame, header_lines: int, folder: str) -> DataFrame:
    """Add each split's line offset in its file and its file's first line number.

    ``splits`` is ``_per_split`` output read back from storage: it feeds three
    branches here (per-file offsets, file totals, range totals), and each
    would otherwise rescan the text.  ``folder`` takes the ranged file totals.
    """
    # One row per split, so a file's window group holds its split count
    # (33 TB of one file = 260,000 rows), not its lines.
    before_in_file = Window.partitionBy("source_file").orderBy("_split").rowsBetween(
        Window.unboundedPreceding, -1
    )
    splits = splits.withColumn(
        "_file_offset", F.coalesce(F.sum("_rows").over(before_in_file), F.lit(0))
    )
    # One row per file: earlier files (by path) come first in the numbering.
    files = splits.groupBy("source_file").agg(
        F.greatest(F.sum("_rows") - header_lines, F.lit(0)).alias("_data_rows")
    )
    n_ranges = splits.sparkSession.sparkContext.defaultParallelism
    return splits.join(_file_line_bases(files, n_ranges, f"{folder}/files"), "source_file")


def _file_line_bases(files: DataFrame, n_ranges: int, folder: str) -> DataFrame:
    """``(source_file, _line_base)``: data lines in all files whose path sorts first.

    A prefix sum over the file list that never puts the list in one task:
    the files are range-partitioned by path, each range is totalled (one row
    per range), the few range totals get their own prefix sum, and each file
    adds the lines of the files before it in its range.  The ranges are
    sampled, so they are written to ``folder`` once and both uses read them.
    """
    before = (Window.unboundedPreceding, -1)
    files.repartitionByRange(n_ranges, "source_file").withColumn(
        "_range", F.spark_partition_id()
    ).write.parquet(folder)
    ranged = files.sparkSession.read.parquet(folder)
    range_base = (
        ranged.groupBy("_range")
        .agg(F.sum("_data_rows").alias("_range_rows"))
        .withColumn(
            "_range_base",
            F.coalesce(
                F.sum("_range_rows").over(Window.orderBy("_range").rowsBetween(*before)),
                F.lit(0),
            ),
        )
    )
    in_range = Window.partitionBy("_range").orderBy("source_file").rowsBetween(*before)
    # At most n_ranges rows: a bounded broadcast.
    return ranged.join(F.broadcast(range_base.select("_range", "_range_base")), "_range").select(
        "source_file",
        (
            F.col("_range_base") + F.coalesce(F.sum("_data_rows").over(in_range), F.lit(0))
        ).alias("_line_base"),
    )


# Settings that decide how files are cut into splits and these packed into tasks.
_SPLIT_SETTINGS = ("maxPartitionBytes", "openCostInBytes", "minPartitionNum", "maxPartitionNum")


def _index_entry(spark: SparkSession, paths: str | list[str], header_lines: int) -> str:
    """The folder that names the split table of these files as they are now, if one is kept.

    Two independent sums over the files' paths, sizes and times stand for the
    listing; no content is read for them.
    """
    listed = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    sums = [F.sum(F.xxhash64(F.lit(seed), *listed.columns).cast("decimal(38,0)")) for seed in (1, 2)]
    found = listed.agg(F.count(F.lit(1)), F.sum("length"), *sums).first()
    settings = [spark.conf.get(f"spark.sql.files.{name}", None) for name in _SPLIT_SETTINGS]
    named = repr((paths, header_lines, settings, [str(v) for v in found]))
    return checkpoint_path(spark, "line-index", hashlib.sha256(named.encode()).hexdigest())


def _kept_root(spark: SparkSession, entry: str) -> str | None:
    try:
        return spark.read.schema("root STRING").parquet(entry).agg(F.min("root")).first()[0]
    except AnalysisException:  # not kept yet
        return None


def read_lines(
    spark: SparkSession,
    paths: str | list[str],
    header_lines: int = 1,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    keep_index: bool = False,
) -> DataFrame:
    """Lines of feed files as ``(line_no, line, source_file, file_line_no)``.

    The first ``header_lines`` lines of every file are dropped.  ``line_no``
    counts data lines from 0 over all files in path order; ``file_line_no``
    counts within a file.  A missing path fails with Spark's own error.

    The call itself scans the text once and writes the split table (one row
    per file split) under ``<checkpoint folder>/line-splits``; the returned
    frame reads it, so it stays.  With ``keep_index`` a later read of the same
    files uses that table instead of counting again: it is found by path,
    size and modification time of all files and by the settings that cut them
    (a file that is rewritten within its time stamp's resolution to the same
    size is not noticed).  The session's ``spark.sql.files.minPartitionNum``
    is set if it was unset.
    """
    if header_lines < 0:
        raise ValueError("header_lines must be >= 0")
    pin_split_sizing(spark)
    raw = spark.read.text(paths).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row_id"),
    )
    # Written to the shared checkpoint folder: the per-split counts are the
    # only scan of the text in this pass (everything after reads one row per
    # split), and the numbering survives a lost executor without a rescan.
    entry = _index_entry(spark, paths, header_lines) if keep_index else None
    split_root = _kept_root(spark, entry) if entry else None
    if split_root is None:
        split_root = checkpoint_path(spark, "line-splits", uuid.uuid4().hex)
        _per_split(raw).write.parquet(f"{split_root}/counts")
        counts = spark.read.parquet(f"{split_root}/counts")
        _split_table(counts, header_lines, split_root).write.parquet(f"{split_root}/table")
        if entry:
            spark.range(0, 1, 1, 1).select(F.lit(split_root).alias("root")).write.mode("append").parquet(entry)
    splits = spark.read.parquet(f"{split_root}/table")
    size = splits.agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.length("source_file")).alias("path")
    ).first()
    estimate = size["rows"] * ((size["path"] or 0) + _SPLIT_ROW_FIXED_BYTES)
    side = F.broadcast(splits) if estimate <= max_broadcast_bytes else splits
    numbered = raw.join(side, ["source_file", "_split"], "left")
    # Every split-table column is guarded, so a line without its split raises
    # (and Catalyst cannot turn the outer join into an inner one that would
    # drop such lines).
    matched = F.col("_first_row").isNotNull()
    for col in ("_first_row", "_file_offset", "_line_base"):
        numbered = numbered.withColumn(
            col, F.when(matched, F.col(col)).otherwise(F.raise_error(F.lit(SPLITS_CHANGED)))
        )
    file_line = F.col("_file_offset") + F.col("_row_id") - F.col("_first_row")
    return (
        numbered.withColumn("file_line_no", file_line - header_lines)
        .filter(F.col("file_line_no") >= 0)
        .select(
            (F.col("_line_base") + F.col("file_line_no")).alias("line_no"),
            "line",
            "source_file",
            "file_line_no",
        )
    )


def first_file_lines(
    spark: SparkSession, paths: str | list[str], n: int, header_lines: int = 1, files_per_step: int = 32
) -> DataFrame:
    """The first ``n`` lines of feed files in path order: ``(line_no, line, source_file, file_line_no)``.

    As ``read_lines`` with ``line_no < n``, but reading stops when ``n`` lines
    are there: files are opened in path order, one, then two, four, up to
    ``files_per_step`` in a step, parts of a file in their order, and no task
    reads on after so many lines as are missing.  The lines pass through the
    driver, as a preview does, so ``n`` is at most ``MAX_FIRST_LINES``; beyond
    that filter ``read_lines``.  A missing path fails with Spark's own error.
    """
    if n < 0 or header_lines < 0:
        raise ValueError("n and header_lines must be >= 0")
    if n > MAX_FIRST_LINES:
        raise ValueError(f"more than {MAX_FIRST_LINES} lines: use read_lines and filter line_no")
    files = sorted(spark.read.text(paths).inputFiles())  # the driver holds this listing for any read
    found: list[tuple[int, str, str, int]] = []
    step, at = 1, 0
    while len(found) < n and at < len(files):
        group = files[at : at + step]
        # A union keeps the order of its sides, and a collected limit takes partitions in order.
        path = F.col("_metadata.file_path").alias("path")
        texts = [spark.read.text(unquote(f)).select(F.lit(k).alias("file"), "value", path) for k, f in enumerate(group)]
        leading = reduce(DataFrame.unionAll, texts).limit(n - len(found) + header_lines * len(group)).collect()
        places = dict.fromkeys(range(len(group)), -header_lines)
        for row in leading:
            place, places[row["file"]] = places[row["file"]], places[row["file"]] + 1
            if place >= 0 and len(found) < n:
                found.append((len(found), row["value"], row["path"], place))
        at, step = at + step, min(2 * step, files_per_step)
    return spark.createDataFrame(found, "line_no bigint, line string, source_file string, file_line_no bigint")


def first_lines_of(
    lines: DataFrame, n: int, order_col: str = "line_no", dense: bool = False
) -> DataFrame:
    """The first ``n`` lines by line number.

    ``dense=True`` states that line numbers run 0, 1, 2, ... without gaps
    (``read_lines`` output): the first ``n`` lines are then a filter, with no
    single-task merge of every partition's top ``n``.  Otherwise a top-n
    (partial per partition, merged in one task).
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    if dense:
        return lines.filter(F.col(order_col) < F.lit(n)).orderBy(order_col)
    return lines.orderBy(order_col).limit(n)
