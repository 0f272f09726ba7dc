"""Result tables: mergeable history per micro-batch, commit records, current tables.

The reference upserts into two tables keyed by winner label and by flight
segment.  Parquet tables cannot be merged into, so each micro-batch writes
what it found as parts that add up: counts by agency, maximum, minimum, sum and
count of the speeds, lines by batch, first lines.  Results are finished on read,
so a replay batch whose lines arrive in several files or micro-batches is
complete.

Commits.  All tables of a micro-batch are written under the name of one attempt
and become visible together, when a record naming the attempt is added to the
``feed_commits`` table.  Readers see the parts of committed attempts only (a
semi-join with the records), so a write that fails between two tables shows
nothing, and its retry shows all.  A micro-batch that is committed is not
written again; if two attempts were, the first by name counts.

Two clocks.  ``micro_batch`` says when a part arrived, ``batch_no`` which result
it belongs to.  They are the same for a live feed.  In a replay a late part may
reach an old batch, whose result then changes; a snapshot of the current tables
therefore remembers the micro-batch that it covers, and what arrives later
makes the batches that it touches be finished anew from all their parts.

Folding.  ``fold_history`` adds up the parts of the micro-batches since the last
fold into one set of files, together with earlier folds that cover no more
micro-batches than it does; so there are few folds, each at least twice as long
as the next, and a part is rewritten a logarithmic number of times.  What a fold
replaces is deleted by the fold after it, when no reader uses it any more.

Partitions are ``block`` (1000 micro-batches; -1 for folds) and ``micro_batch``.
A writer keeps the records that count in a ``CommitLog``, and so opens the
folders that it needs without listing a history that grows.

Work that follows every micro-batch (snapshots, folds) reads a few small files
most of the time.  Up to ``SMALL_BYTES`` of them one task adds up, as one job
without exchanges; more is shuffled.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import finish_speed_stats, winners_of_counts
from ..operators.latest import agency_winners_latest, speed_stats_latest
from ..schema import (
    COMMITS_SCHEMA,
    COUNT_PARTS_SCHEMA,
    LINE_PARTS_SCHEMA,
    PREVIEW_SCHEMA,
    REJECTS_SCHEMA,
    SPEED_LATEST_SCHEMA,
    SPEED_PARTS_SCHEMA,
    WINNERS_LATEST_SCHEMA,
)
from ..session import file_system, hadoop_path, numbered_folders, path_exists, run_together, stored_bytes

# Result names; winners and speed statistics are finished from parts.
WINNERS = "agencies_most_flight_segs"
SPEED = "speed_stat_table"
# Stored tables.
COUNTS = "agency_counts"
SPEED_PARTS = "speed_stat_parts"
REJECTS = "feed_rejects"
LINES = "batch_lines"
PREVIEW = "batch_preview"
COMMITS = "feed_commits"

STORED = {
    COUNTS: COUNT_PARTS_SCHEMA,
    SPEED_PARTS: SPEED_PARTS_SCHEMA,
    REJECTS: REJECTS_SCHEMA,
    LINES: LINE_PARTS_SCHEMA,
    PREVIEW: PREVIEW_SCHEMA,
}
BLOCK_MICRO_BATCHES = 1000
FOLDS = -1  # the block of folds
_PARTITIONS = ("block", "micro_batch")
_ATTEMPT = "attempt"
# Stored parts are summed up by these functions when they are folded or read.
_MERGED = {
    COUNTS: (("batch_no", "agency"), {"n": "sum"}),
    SPEED_PARTS: (
        ("batch_no", "flight_segment"),
        {"max_speed": "max", "min_speed": "min", "sum_speed": "sum", "n": "sum"},
    ),
    LINES: (("batch_no",), {"n_lines": "sum"}),
}


@dataclass(frozen=True)
class ResultTables:
    """Where the history of each result lives.

    Give a ``run_id`` per checkpoint: a stream restarted without its
    checkpoint counts micro-batches from 0 again, and these are taken as
    written already.
    """

    root: str
    database: str | None = None
    run_id: str | None = None

    def path(self, name: str) -> str:
        base = self.root.rstrip("/")
        if self.run_id:
            base = f"{base}/run={self.run_id}"
        return f"{base}/{name}"

    def table(self, name: str) -> str | None:
        if not self.database:
            return None
        suffix = f"_{self.run_id}" if self.run_id else ""
        return f"{self.database}.{name}{suffix}"


@dataclass(frozen=True)
class Fold:
    """A committed fold: the parts of the micro-batches ``since`` to ``micro_batch``; ``older`` has those before."""

    micro_batch: int
    attempt: str
    since: int = 0
    older: Fold | None = None

    def all(self) -> list[Fold]:
        return [self, *(self.older.all() if self.older else [])]


@dataclass(frozen=True)
class CommitFacts:
    """What the record of a micro-batch says beside its attempt.

    ``closed_upto``: no batch below it will get another part; ``low_line``:
    all lines of the feed below it are committed; ``first_batch`` and
    ``last_batch``: the batches that the parts belong to; ``since``: the first
    micro-batch of a fold.
    """

    closed_upto: int | None
    low_line: int | None
    first_batch: int | None
    last_batch: int | None
    since: int | None = None


_FACTS = {"closed_upto": max, "low_line": max, "first_batch": min, "last_batch": max}
# Up to so many folders are opened one by one; more are found by listing the table.
_FEW = 32
# Parquet files up to so many bytes together are added up by one task.
SMALL_BYTES = 1 << 20
_LAST_BATCH = 2**63 - 1


@dataclass(frozen=True)
class Commit:
    """A committed attempt at a micro-batch, or a fold."""

    block: int
    micro_batch: int
    attempt: str
    facts: CommitFacts


@dataclass
class CommitLog:
    """The records that count, a few numbers each, and the newest snapshot by table.

    Read once (``read_log``) and kept by the writer of a history, who adds what it commits.
    """

    commits: list[Commit] = field(default_factory=list)  # of micro-batches after the newest fold
    fold: Fold | None = None
    folds: list[Commit] = field(default_factory=list)  # the newest one first, as ``fold.all()``
    snapshots: dict[str, int] = field(default_factory=dict)

    def last(self) -> int | None:
        numbers = [c.micro_batch for c in (*self.commits, *self.folds)]
        return max(numbers) if numbers else None

    def chosen(
        self, after: int | None = None, upto: int | None = None, batches: tuple[int, int] | None = None
    ) -> list[Commit]:
        """As ``committed`` has them, of those that may hold some of the batches from the first to the last given."""
        found = [c for c in self.commits if after is None or c.micro_batch > after]
        found = [c for c in found if upto is None or c.micro_batch <= upto]
        if after is None:
            found += self.folds
        if batches is not None:
            found = [c for c in found if c.facts.last_batch is not None]
            found = [c for c in found if c.facts.first_batch <= batches[1] and c.facts.last_batch >= batches[0]]
        return found

    def batch_range(self, after: int | None, upto: int | None) -> tuple[int, int] | None:
        """The first and the last batch that the micro-batches after ``after`` and up to ``upto`` touch."""
        facts = [c.facts for c in self.chosen(after, upto) if c.facts.last_batch is not None]
        return (min(f.first_batch for f in facts), max(f.last_batch for f in facts)) if facts else None


def _merged_facts(commits: list[Commit], since: int) -> CommitFacts:
    facts = {}
    for name, choose in _FACTS.items():
        known = [getattr(c.facts, name) for c in commits if getattr(c.facts, name) is not None]
        facts[name] = choose(known, default=None)
    return CommitFacts(**facts, since=since)


def _schema(name: str) -> T.StructType:
    return COMMITS_SCHEMA if name == COMMITS else STORED[name]


def _stored_schema(name: str) -> T.StructType:
    """The table's columns, partition columns last."""
    schema = T.StructType([*_schema(name).fields, T.StructField(_ATTEMPT, T.StringType(), True)])
    for column in _PARTITIONS:
        schema = schema.add(column, T.LongType())
    return schema


def ensure_tables(spark: SparkSession, tables: ResultTables) -> None:
    """Create the history tables if absent, so they read as empty before any batch.

    Catalog tables: ``CREATE DATABASE / TABLE IF NOT EXISTS``, and views of
    the finished results under the reference's table names.  Path tables: an
    empty append, which makes the folder and leaves existing data alone.
    """
    stored = [*STORED, COMMITS]
    if not tables.database:
        for name in stored:
            empty = spark.createDataFrame([], _stored_schema(name))
            empty.write.mode("append").partitionBy(*_PARTITIONS).parquet(tables.path(name))
        return
    # Beside the tables, so that nothing goes to a warehouse folder of the driver's machine.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{tables.database}` LOCATION '{tables.path('database')}'")
    for name in stored:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _stored_schema(name).fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {tables.table(name)} ({cols}) USING parquet "
            f"PARTITIONED BY ({', '.join(_PARTITIONS)}) LOCATION '{tables.path(name)}'"
        )
    if "since" not in spark.table(tables.table(COMMITS)).columns:  # made before folds had several parts
        spark.sql(f"ALTER TABLE {tables.table(COMMITS)} ADD COLUMNS (since BIGINT)")

    def parts(name: str) -> str:
        commits = tables.table(COMMITS)
        return f"""(
          WITH folds AS (
            SELECT micro_batch, min(struct({_ATTEMPT}, coalesce(since, 0) AS since)) AS f FROM {commits}
            WHERE block = {FOLDS} GROUP BY micro_batch),
          seen AS (
            SELECT min(block) AS block, micro_batch, min({_ATTEMPT}) AS {_ATTEMPT} FROM {commits}
            WHERE block != {FOLDS} AND micro_batch > coalesce((SELECT max(micro_batch) FROM folds), -1)
            GROUP BY micro_batch
            UNION ALL
            SELECT {FOLDS}, old.micro_batch, old.f.{_ATTEMPT} FROM folds old LEFT ANTI JOIN folds new
            ON new.micro_batch > old.micro_batch AND new.f.since <= old.micro_batch)
          SELECT p.* FROM {tables.table(name)} p LEFT SEMI JOIN seen
          ON p.block = seen.block AND p.micro_batch = seen.micro_batch AND p.{_ATTEMPT} = seen.{_ATTEMPT})"""

    spark.sql(f"""
        CREATE OR REPLACE VIEW {tables.table(SPEED)} AS
        SELECT batch_no, flight_segment, max(max_speed) AS max_speed, min(min_speed) AS min_speed,
               sum(sum_speed) / sum(n) AS avg_speed, sum(n) AS num_of_flight_segments
        FROM {parts(SPEED_PARTS)} GROUP BY batch_no, flight_segment""")
    spark.sql(f"""
        CREATE OR REPLACE VIEW {tables.table(WINNERS)} AS
        SELECT batch_no, concat('[', array_join(sort_array(collect_list(agency)), ', '), ']')
                 AS agency_most_flight_segs, max(n) AS num_of_flight_segs
        FROM (SELECT batch_no, agency, n, rank() OVER (PARTITION BY batch_no ORDER BY n DESC) AS place
              FROM (SELECT batch_no, agency, sum(n) AS n FROM {parts(COUNTS)} GROUP BY batch_no, agency))
        WHERE place = 1 GROUP BY batch_no""")


def _write(df: DataFrame, block: int, micro_batch: int, attempt: str, tables: ResultTables, name: str) -> None:
    columns = {f.name: f"CAST(`{f.name}` AS {f.dataType.simpleString()})" for f in _schema(name).fields}
    columns[_ATTEMPT] = f"'{attempt}'"
    if tables.database:
        columns.update(block=f"CAST({block} AS BIGINT)", micro_batch=f"CAST({micro_batch} AS BIGINT)")
        order = df.sparkSession.table(tables.table(name)).columns
        out = df.selectExpr(*[f"{columns[c]} AS `{c}`" for c in order])
        out.write.insertInto(tables.table(name))
    else:
        # The one partition is known: no sort by it, and code that does not change with its number.
        out = df.selectExpr(*[f"{value} AS `{c}`" for c, value in columns.items()])
        out.write.mode("append").parquet(_folder(tables, name, block, micro_batch))


def _folder(tables: ResultTables, name: str, block: int, micro_batch: int) -> str:
    return f"{tables.path(name)}/block={block}/micro_batch={micro_batch}"


def _block(micro_batch: int) -> int:
    return micro_batch // BLOCK_MICRO_BATCHES


def _commit(
    spark: SparkSession, tables: ResultTables, block: int, micro_batch: int, attempt: str, facts: CommitFacts
) -> None:
    """Make an attempt visible: one row in one file, which appears whole or not at all."""
    said = {f.name: getattr(facts, f.name) for f in COMMITS_SCHEMA.fields}
    if not tables.database:  # no catalog to tell: a file of its own, without a job
        _write_record({**said, _ATTEMPT: attempt}, spark, _folder(tables, COMMITS, block, micro_batch))
        return
    values = ", ".join("CAST(NULL AS BIGINT)" if v is None else f"CAST({int(v)} AS BIGINT)" for v in said.values())
    record = spark.sql(f"SELECT * FROM VALUES ({values}) AS record({', '.join(said)})")
    _write(record, block, micro_batch, attempt, tables, COMMITS)


def _write_record(record: dict[str, int | str | None], spark: SparkSession, folder: str) -> None:
    """A row as a parquet file in ``folder``; it is hidden until it is whole."""
    types = {name: pa.string() if name == _ATTEMPT else pa.int64() for name in record}
    row = pa.table({name: pa.array([value], types[name]) for name, value in record.items()})
    data = io.BytesIO()
    pq.write_table(row, data)
    files, name = file_system(spark, folder), f"part-{record[_ATTEMPT]}.parquet"
    hidden, shown = (hadoop_path(spark, f"{folder}/{n}") for n in (f".{name}.tmp", name))
    out = files.create(hidden, True)
    try:
        out.write(bytearray(data.getvalue()))
    finally:
        out.close()
    if not files.rename(hidden, shown):
        raise OSError(f"cannot write {folder}/{name}")


def write_histories(
    frames: dict[str, DataFrame], micro_batch: int, tables: ResultTables, facts: CommitFacts | None = None
) -> bool:
    """Write the parts of one micro-batch, one Spark job per table side by side, then commit them.

    ``facts`` go into the record; by default the micro-batch is a batch of its
    own.  False if the micro-batch is committed already; then nothing is
    written.
    """
    if not frames or is_committed(next(iter(frames.values())).sparkSession, tables, micro_batch):
        return False
    write_attempt(frames, micro_batch, tables, facts)
    return True


def write_attempt(
    frames: dict[str, DataFrame],
    micro_batch: int,
    tables: ResultTables,
    facts: CommitFacts | Callable[[], CommitFacts | None] | None = None,
    log: CommitLog | None = None,
) -> CommitFacts:
    """``write_histories`` of a micro-batch that is known not to be committed.

    ``facts`` that have to be worked out are so beside the writes.  Returns the facts of the record.
    """
    spark = next(iter(frames.values())).sparkSession
    attempt, block = uuid.uuid4().hex, _block(micro_batch)
    writes = [partial(_write, df, block, micro_batch, attempt, tables, name) for name, df in frames.items()]
    found = []
    if callable(facts):
        writes.append(lambda: found.append(facts()))
    else:
        found.append(facts)
    run_together(spark, writes)
    said = found[0] or CommitFacts(micro_batch + 1, None, micro_batch, micro_batch)
    _commit(spark, tables, block, micro_batch, attempt, said)
    if log is not None:
        log.commits.append(Commit(block, micro_batch, attempt, said))
    return said


def _table(spark: SparkSession, tables: ResultTables, name: str) -> DataFrame:
    """A stored table as it lies, with the parts of all attempts; empty if there is none."""
    schema = _stored_schema(name)
    if tables.database:
        return spark.read.table(tables.table(name))
    try:
        return spark.read.schema(schema).parquet(tables.path(name))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def newest_fold(spark: SparkSession, tables: ResultTables) -> Fold | None:
    return _live_folds(_commits(_table(spark, tables, COMMITS).filter(F.col("block") == FOLDS)))[0]


def _commits(records: DataFrame) -> list[Commit]:
    """Records by micro-batch; of two attempts the first by name."""
    names = [f.name for f in COMMITS_SCHEMA.fields]
    kept = {}
    for r in records.select(*_PARTITIONS, _ATTEMPT, *names).collect():
        key = (r["micro_batch"], r["block"] == FOLDS)
        if key not in kept or r[_ATTEMPT] < kept[key].attempt:
            facts = CommitFacts(**{n: r[n] for n in names})
            kept[key] = Commit(r["block"], r["micro_batch"], r[_ATTEMPT], facts)
    return [kept[key] for key in sorted(kept)]


def _live_folds(folds: list[Commit]) -> tuple[Fold | None, list[Commit]]:
    """The newest fold, and the records of those that no later one covers, the newest first."""
    live: list[Commit] = []
    for c in folds:
        live = [c, *(old for old in live if old.micro_batch < (c.facts.since or 0))]
    fold = None
    for c in reversed(live):
        fold = Fold(c.micro_batch, c.attempt, c.facts.since or 0, fold)
    return fold, live


def is_current(spark: SparkSession, tables: ResultTables, log: CommitLog) -> bool:
    """Whether nobody else has folded the history since (from the few folders of folds)."""
    folds = [number for _, number in numbered_folders(spark, f"{tables.path(COMMITS)}/block={FOLDS}", "micro_batch=")]
    return max(folds, default=None) == (log.fold.micro_batch if log.fold else None)


def read_log(spark: SparkSession, tables: ResultTables) -> CommitLog:
    """The records that count, read in one job, and the newest snapshots."""
    commits = _commits(_table(spark, tables, COMMITS))
    fold, folds = _live_folds([c for c in commits if c.block == FOLDS])
    upto = fold.micro_batch if fold else -1
    log = CommitLog([c for c in commits if c.block != FOLDS and c.micro_batch > upto], fold, folds)
    for name in _LATEST:
        found = _snapshot_batches(spark, tables, name)
        if found:
            log.snapshots[name] = found[-1]
    return log


def _after(after: int) -> Column:
    return (F.col("micro_batch") > after) & (F.col("block") >= _block(after + 1))


def _upto(upto: int) -> Column:
    return (F.col("micro_batch") <= upto) & (F.col("block") <= _block(upto))


def committed(
    spark: SparkSession, tables: ResultTables, fold: Fold | None, after: int | None = None, upto: int | None = None
) -> DataFrame:
    """Records of the attempts that count: ``(block, micro_batch, attempt)`` and their facts.

    The folds, unless ``after`` is given, and one attempt for each later micro-batch.
    """
    records = _table(spark, tables, COMMITS)
    since = max(x for x in (-1, after, fold.micro_batch if fold else None) if x is not None)
    live = records.filter((F.col("block") != FOLDS) & _after(since))
    if upto is not None:
        live = live.filter(_upto(upto))
    one = F.min(F.struct(_ATTEMPT, *_FACTS)).alias("one")
    live = live.groupBy("block", "micro_batch").agg(one).select("block", "micro_batch", "one.*")
    if fold is None or after is not None:
        return live
    folds = records.filter((F.col("block") == FOLDS) & F.col(_ATTEMPT).isin([f.attempt for f in fold.all()]))
    return live.unionByName(folds.select(*live.columns))


def is_committed(spark: SparkSession, tables: ResultTables, micro_batch: int) -> bool:
    records = _table(spark, tables, COMMITS)
    own = (F.col("block") == _block(micro_batch)) & (F.col("micro_batch") == micro_batch)
    folded = (F.col("block") == FOLDS) & (F.col("micro_batch") >= micro_batch)
    return not records.filter(own | folded).isEmpty()


def last_committed(spark: SparkSession, tables: ResultTables) -> int | None:
    """The highest micro-batch that is committed."""
    return _table(spark, tables, COMMITS).agg(F.max("micro_batch")).first()[0]


def closed_upto(spark: SparkSession, tables: ResultTables) -> int:
    """The low-water mark of batches: all below it are complete."""
    return _table(spark, tables, COMMITS).agg(F.max("closed_upto")).first()[0] or 0


def low_line(spark: SparkSession, tables: ResultTables) -> int:
    """The low-water mark of lines: all below it are committed (0 if lines are not followed)."""
    return _table(spark, tables, COMMITS).agg(F.max("low_line")).first()[0] or 0


def read_parts(
    spark: SparkSession, tables: ResultTables, name: str, after: int | None = None, upto: int | None = None
) -> DataFrame:
    """The committed parts of a stored table, of the micro-batches after ``after`` and up to ``upto``
    (pruned at the scan).  Parts that are folded cannot be told apart by micro-batch any more."""
    return _parts(spark, tables, name, newest_fold(spark, tables), after, upto)


def _parts(
    spark: SparkSession,
    tables: ResultTables,
    name: str,
    fold: Fold | None,
    after: int | None = None,
    upto: int | None = None,
    batches: tuple[int | None, int | None] | None = None,
    log: CommitLog | None = None,
) -> DataFrame:
    """``read_parts`` with the newest fold known, and only of the batches from the first to the last
    given: the records tell which micro-batches hold some.  With the ``log`` known, only their folders
    are opened."""
    if fold and ((after is not None and after < fold.micro_batch) or (upto is not None and upto < fold.micro_batch)):
        raise ValueError(f"micro-batches up to {fold.micro_batch} are folded")
    chosen = log.chosen(after, upto, batches) if log is not None else None
    if chosen is not None and len(chosen) <= _FEW:
        return _parts_of(spark, tables, name, chosen, batches)
    df = _table(spark, tables, name)
    if after is not None:
        df = df.filter(_after(after))
    elif fold:
        own_fold = (F.col("block") == FOLDS) & F.col("micro_batch").isin([f.micro_batch for f in fold.all()])
        df = df.filter(own_fold | ((F.col("block") != FOLDS) & _after(fold.micro_batch)))
    if upto is not None:
        df = df.filter(_upto(upto) | (F.col("block") == FOLDS))
    seen = committed(spark, tables, fold, after, upto)
    if batches is not None:
        df = df.filter(F.col("batch_no").between(*batches))
        seen = seen.filter((F.col("last_batch") >= batches[0]) & (F.col("first_batch") <= batches[1]))
    parts = df.join(seen.select(*_PARTITIONS, _ATTEMPT), [*_PARTITIONS, _ATTEMPT], "left_semi")
    return parts.select(*[F.col(f.name).cast(f.dataType) for f in _schema(name).fields])


def _parts_of(
    spark: SparkSession, tables: ResultTables, name: str, chosen: list[Commit], batches: tuple[int, int] | None = None
) -> DataFrame:
    """The parts of these commits, each in its own folder; in one partition if they are small."""
    schema = _schema(name)
    sizes = stored_bytes(spark, [_folder(tables, name, c.block, c.micro_batch) for c in chosen])
    if not sizes:
        none = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]
        return spark.range(0).selectExpr(*none).coalesce(1)
    stored = T.StructType([*schema.fields, T.StructField(_ATTEMPT, T.StringType(), True)])
    attempts = ", ".join(f"'{c.attempt}'" for c in chosen)
    wanted = f"{_ATTEMPT} IN ({attempts})"
    if batches is not None:
        wanted += f" AND batch_no BETWEEN {batches[0]} AND {batches[1]}"
    df = spark.read.schema(stored).parquet(*sizes).filter(wanted).drop(_ATTEMPT)
    return df.coalesce(1) if sum(sizes.values()) <= SMALL_BYTES else df


def _is_small(spark: SparkSession, tables: ResultTables, name: str, chosen: list[Commit], *others: str) -> bool:
    """Whether the parts of these commits, and other folders, are few bytes together."""
    if len(chosen) > _FEW:
        return False
    folders = [*(_folder(tables, name, c.block, c.micro_batch) for c in chosen), *others]
    return sum(stored_bytes(spark, folders).values()) <= SMALL_BYTES


def lines_from(spark: SparkSession, tables: ResultTables, batch_no: int, log: CommitLog | None = None) -> DataFrame:
    """The committed line counts of batches from ``batch_no`` on."""
    fold = log.fold if log is not None else newest_fold(spark, tables)
    return _parts(spark, tables, LINES, fold, batches=(batch_no, _LAST_BATCH), log=log)


def merge_parts(parts: DataFrame, name: str) -> DataFrame:
    """Parts of the same keys added up; the first lines of a batch cut to as many as were asked for."""
    if name in _MERGED:
        keys, sums = _MERGED[name]
        return parts.groupBy(*keys).agg(*[F.expr(f"{f}({c}) AS {c}") for c, f in sums.items()])
    if name == PREVIEW:
        return _first_of_batches(parts, F.col("rows"))
    return parts


def preview_parts(lines: DataFrame, rows: int) -> DataFrame:
    """The first ``rows`` lines of every batch: a partial ``WindowGroupLimit`` before the shuffle."""
    return _first_of_batches(lines, F.lit(rows)).withColumn("rows", F.lit(rows))


def _first_of_batches(lines: DataFrame, rows: Column) -> DataFrame:
    order = [F.col(c).asc_nulls_first() for c in ("source_file", "partition", "line_no", "line")]
    at = F.row_number().over(Window.partitionBy("batch_no").orderBy(*order))
    return lines.withColumn("_at", at).filter(F.col("_at") <= rows).drop("_at")


def _finished(parts: DataFrame, name: str) -> DataFrame:
    """A result from its (committed) parts."""
    if name == SPEED:
        return finish_speed_stats(parts, merge=True)
    if name == WINNERS:
        return winners_of_counts(merge_parts(parts, COUNTS))
    return merge_parts(parts, name).drop("rows")


def _source(name: str) -> str:
    """The stored table of a result."""
    return {SPEED: SPEED_PARTS, WINNERS: COUNTS}.get(name, name)


def read_history(
    spark: SparkSession,
    tables: ResultTables,
    name: str,
    after: int | None = None,
    upto: int | None = None,
    closed: bool = False,
) -> DataFrame:
    """A result per batch: winners, speed statistics, agency counts, rejects, lines or first lines.

    ``closed`` leaves out batches that may still get lines: only those below the low-water mark stay.
    """
    parts = read_parts(spark, tables, _source(name), after, upto)
    if closed:
        parts = parts.filter(F.col("batch_no") < closed_upto(spark, tables))
    return _finished(parts, name)


# Current tables: their latest row, and their key.
_LATEST = {WINNERS: agency_winners_latest, SPEED: speed_stats_latest}
_LATEST_SCHEMA = {WINNERS: WINNERS_LATEST_SCHEMA, SPEED: SPEED_LATEST_SCHEMA}
_KEY = {WINNERS: "agency_most_flight_segs", SPEED: "flight_segment"}
_LOSES_KEYS = (WINNERS,)  # more parts can take a batch's row from a key


def latest_views(spark: SparkSession, tables: ResultTables, prefix: str = "") -> dict[str, DataFrame]:
    """Register and return the current (latest-per-key) result views.

    Each view starts from the newest snapshot, if any, and adds only the
    history partitions after it, so reading the current state does not
    aggregate the whole history once snapshots are kept.
    """
    log, views = read_log(spark, tables), {}
    for name in _LATEST:
        latest, _ = _latest_from(spark, tables, name, log, log.snapshots.get(name), scan=True)
        views[name] = latest.drop("batch_no")
        views[name].createOrReplaceTempView(f"{prefix}{name}")
    return views


def _snapshot_folder(tables: ResultTables, name: str) -> str:
    return tables.path(f"current/{name}")


def _snapshot_batches(spark: SparkSession, tables: ResultTables, name: str) -> list[int]:
    """The ``upto`` values of the snapshots (from the file listing)."""
    try:
        files = spark.read.schema(_LATEST_SCHEMA[name]).parquet(_snapshot_folder(tables, name)).inputFiles()
    except AnalysisException:  # no snapshot yet
        return []
    found = set()
    for path in files:
        for part in path.split("/"):
            if part.startswith("upto=") and part[5:].lstrip("-").isdigit():
                found.add(int(part[5:]))
    return sorted(found)


def _latest_from(
    spark: SparkSession,
    tables: ResultTables,
    name: str,
    log: CommitLog,
    snapshot: int | None,
    upto: int | None = None,
    scan: bool = False,
) -> tuple[DataFrame, list[DataFrame]]:
    """Latest row per key (with ``batch_no``) of the micro-batches up to ``upto``, and what was persisted for it.

    Without a snapshot, from the whole history.  With one: the batches that
    later micro-batches may touch (from their first to their last) are finished
    anew from all their parts, rows of the snapshot that stem from them go, and
    the rest of it stays.  A key whose row goes, and that no renewed batch as
    late bears any more, falls back to the latest of its other batches, which
    only the history knows.  ``scan``, for frames that are kept by others,
    reads tables with partition filters and persists nothing.
    """
    latest, key, source, schema = _LATEST[name], _KEY[name], _source(name), _LATEST_SCHEMA[name]

    def parts(after: int | None = None, batches: tuple[int, int] | None = None) -> DataFrame:
        return _parts(spark, tables, source, log.fold, after, upto, batches, None if scan else log)

    if snapshot is None:
        return latest(_finished(parts(), name), keep_batch=True), []
    columns, folder = schema.fieldNames(), f"{_snapshot_folder(tables, name)}/upto={snapshot}"
    before = spark.read.schema(schema).parquet(folder)
    new = log.batch_range(snapshot, upto)
    if new is None:
        return before, []
    chosen = log.chosen(None, upto, new)
    if not scan and len(chosen) <= _FEW and not _any_parts(spark, tables, source, chosen):
        return before, []  # no parts of these batches: none of its rows stem from them
    small = not scan and _is_small(spark, tables, source, chosen, folder)

    def together(df: DataFrame) -> DataFrame:
        return df.coalesce(1) if small else df

    if all(c.micro_batch > snapshot for c in chosen):
        # Nothing late: what is new belongs to batches that the snapshot has not seen.
        rows = before.unionByName(_finished(parts(after=snapshot), name).select(*columns))
        return latest(together(rows), keep_batch=True), []
    renewed = F.expr(f"coalesce(batch_no BETWEEN {new[0]} AND {new[1]}, false)")
    rows = before.filter(~renewed).unionByName(_finished(parts(batches=new), name).select(*columns))
    if name not in _LOSES_KEYS:
        return latest(together(rows), keep_batch=True), []
    # In one look, what a key has now and the batch of its row that goes.
    values = [c for c in columns if c not in (key, "batch_no")]
    went = before.filter(renewed).selectExpr(key, *values, "CAST(NULL AS BIGINT) AS batch_no", "batch_no AS was")
    both = rows.selectExpr(key, *values, "batch_no", "CAST(NULL AS BIGINT) AS was").unionByName(went)
    own = [f"max_by({c}, batch_no) AS {c}" for c in values]
    own += ["max(batch_no) AS batch_no", "max(was) AS was"]
    now = together(both).groupBy(key).agg(*[F.expr(e) for e in own])
    if not scan:
        # Kept rows are not coalesced by themselves: a row per key needs no task for each shuffle partition.
        now = (now if small else now.coalesce(spark.sparkContext.defaultParallelism)).persist()
    lost = now.filter("was IS NOT NULL AND coalesce(batch_no, -1) < was").selectExpr(f"{key} AS lost")
    found = now.filter("batch_no IS NOT NULL").selectExpr(*columns)
    if lost.isEmpty():
        return found, [] if scan else [now]
    others = _finished(parts().filter(~renewed), name)
    wanted = F.col(key).eqNullSafe(F.col("lost"))
    fallen = others.join(F.broadcast(lost), wanted, "left_semi").select(*columns)
    return latest(found.unionByName(fallen), keep_batch=True), [] if scan else [now]


def snapshot_current(
    spark: SparkSession, tables: ResultTables, upto: int | None = None, log: CommitLog | None = None
) -> dict[str, str]:
    """Write the current tables: one row per key with its latest batch, like upserts.

    A snapshot is the previous snapshot merged with the parts of the
    micro-batches after it (see ``_latest_from``), so its work grows with the
    new batches, not with the history, whether batches are keyed by micro-batch
    or by replay time.  Each snapshot has its own folder
    ``<root>/current/<name>/upto=<N>``, N being the last micro-batch it covers
    (the newest committed one unless given).  A snapshot is never overwritten
    while it is read, and a repeated run for the same N rebuilds that folder
    from the snapshot before it.  Returns the folder of the newest snapshot per
    table; rows carry ``batch_no``.  A ``log`` that is given is taken as it is
    and told of the new snapshots.
    """
    kept = log is not None
    log = log if kept else read_log(spark, tables)
    target = upto if upto is not None else log.last()
    target = -1 if target is None else target

    def write(name: str) -> None:
        newest = log.snapshots.get(name, -2)
        found = [newest] if kept and -2 < newest < target else _snapshot_batches(spark, tables, name)
        if upto is None and 0 <= target and target in found:  # nothing new since the last snapshot
            return
        earlier = [b for b in found if b < target]
        latest, kept_rows = _latest_from(spark, tables, name, log, earlier[-1] if earlier else None, target)
        try:
            latest.write.mode("overwrite").parquet(f"{_snapshot_folder(tables, name)}/upto={target}")
        finally:
            for rows in kept_rows:
                rows.unpersist()
        log.snapshots[name] = target

    run_together(spark, [partial(write, name) for name in _LATEST])
    return {name: f"{_snapshot_folder(tables, name)}/upto={target}" for name in _LATEST}


def fold_history(spark: SparkSession, tables: ResultTables, log: CommitLog | None = None) -> Fold | None:
    """Add up the parts of the micro-batches since the last fold into one set of files.

    The folds before it that cover no more micro-batches than the new one are
    added up with it, so that a part is rewritten as often as the length of
    the history doubles, and few folds are left.  The current tables are
    written beside them, before the record, for micro-batches that are folded cannot be told apart any
    more.  The folded parts take their place in the history with one record,
    like the parts of a micro-batch; a reader that started before still finds
    the files it has chosen.  What the fold before this one replaced (its
    micro-batches, the folds it was added to, older snapshots) is deleted.
    None if there is nothing to fold.  A ``log`` that is given is told of the fold.
    """
    log = log if log is not None else read_log(spark, tables)
    upto, before = log.last(), log.fold
    if upto is None or (before and before.micro_batch == upto):
        return before
    attempt, merged, left, older = uuid.uuid4().hex, list(log.commits), list(log.folds), before
    since = before.micro_batch + 1 if before else 0
    while older and older.micro_batch - older.since <= upto - since:
        merged.append(left.pop(0))
        since, older = older.since, older.older

    def fold(name: str) -> None:
        if len(merged) <= _FEW:
            parts = _parts_of(spark, tables, name, merged)
        else:
            parts = _parts(spark, tables, name, before, upto=upto)
        sums = merge_parts(parts, name)
        if not _is_small(spark, tables, name, merged):
            sums = sums.hint("rebalance")  # files of a size, however many micro-batches they come from
        _write(sums, FOLDS, upto, attempt, tables, name)

    folds = [partial(fold, name) for name in STORED if _any_parts(spark, tables, name, merged)]
    run_together(spark, [partial(snapshot_current, spark, tables, upto, log), *folds])
    facts = _merged_facts(merged, since)
    _commit(spark, tables, FOLDS, upto, attempt, facts)
    log.fold, log.commits = Fold(upto, attempt, since, older), []
    log.folds = [Commit(FOLDS, upto, attempt, facts), *left]
    if before:
        _delete_replaced(spark, tables, before)
    return log.fold


def _any_parts(spark: SparkSession, tables: ResultTables, name: str, commits: list[Commit]) -> bool:
    """Whether some of the commits wrote to the table."""
    for block in {c.block for c in commits}:  # most tables have no folder of a block at all
        if path_exists(spark, f"{tables.path(name)}/block={block}"):
            folders = (_folder(tables, name, block, c.micro_batch) for c in commits if c.block == block)
            if any(path_exists(spark, f) for f in folders):
                return True
    return False


def _delete_replaced(spark: SparkSession, tables: ResultTables, fold: Fold) -> None:
    """Delete what ``fold``, no longer the newest, has replaced."""

    def delete(path: str) -> None:
        file_system(spark, path).delete(hadoop_path(spark, path), True)

    def delete_parts(name: str) -> None:
        gone = []
        for block_path, block in numbered_folders(spark, tables.path(name), "block="):
            for path, number in numbered_folders(spark, block_path, "micro_batch="):
                if block == FOLDS:
                    replaced = fold.since <= number < fold.micro_batch
                else:
                    replaced = number <= fold.micro_batch
                if replaced:
                    gone.append((path, block, number))
            if block != FOLDS and block < _block(fold.micro_batch):
                gone.append((block_path, None, None))
        if tables.database:
            for _, block, number in gone:
                if number is not None:
                    partition = f"PARTITION (block = {block}, micro_batch = {number})"
                    spark.sql(f"ALTER TABLE {tables.table(name)} DROP IF EXISTS {partition}")
        for path, _, _ in gone:
            delete(path)

    def delete_snapshots(name: str) -> None:
        for path, upto in numbered_folders(spark, _snapshot_folder(tables, name), "upto="):
            if upto < fold.micro_batch:
                delete(path)

    deletions = [partial(delete_parts, name) for name in (*STORED, COMMITS)]
    deletions += [partial(delete_snapshots, name) for name in _LATEST]
    if tables.database:  # a catalog is told of every partition
        run_together(spark, deletions)
    else:
        for delete_some in deletions:
            delete_some()
