"""Commits, late parts, snapshots, folds, closed batches and previews of the stream's tables."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_streaming import drain, replayed, rows

from skyledger.operators import (
    ReplayClock,
    agency_counts,
    agency_winners,
    agency_winners_latest,
    batch_preview,
    parse_records,
    speed_stats,
    speed_stats_latest,
    with_batches,
)
from skyledger.sources import read_events_feed
from skyledger.streaming import (
    FeedBatchWriter,
    ResultTables,
    closed_upto,
    ensure_tables,
    fold_history,
    latest_views,
    read_history,
    read_parts,
    snapshot_current,
    sink,
    stage_lines,
    write_histories,
)
from skyledger.streaming.sink import COUNTS, LINES, PREVIEW, REJECTS, SPEED, SPEED_PARTS, STORED, WINNERS

SF = "/root/testdata/sf0.001"
RESULTS = (WINNERS, SPEED, COUNTS, REJECTS)


def part_frames(spark, counts):
    """Parts of counts and speeds from (batch, agency, n) rows; speeds follow from n."""
    speeds = [(b, "F1", n, -n, 10 * n, n) for b, a, n in counts if a == "dhs"]
    return {
        COUNTS: spark.createDataFrame(counts, STORED[COUNTS]),
        SPEED_PARTS: spark.createDataFrame(speeds, STORED[SPEED_PARTS]),
    }


def write_parts(spark, tables, micro_batch, counts):
    batches = [b for b, _, _ in counts]
    facts = sink.CommitFacts(None, None, min(batches), max(batches)) if batches else sink.CommitFacts(*[None] * 4)
    assert write_histories(part_frames(spark, counts), micro_batch, tables, facts)


def winners_by_hand(counts):
    """Winners per batch, then the latest row of every label, from all (batch, agency, n) rows."""
    sums = {}
    for b, a, n in counts:
        sums.setdefault(b, {}).setdefault(a, 0)
        sums[b][a] += n
    latest = {}
    for b in sorted(sums):
        top = max(sums[b].values())
        latest["[" + ", ".join(sorted(a for a in sums[b] if sums[b][a] == top)) + "]"] = top
    return sorted(latest.items())


def current(spark, tables):
    return sorted(tuple(r) for r in latest_views(spark, tables)[WINNERS].collect())


def speed_by_hand(counts):
    """The latest batch's speed statistics, from all rows."""
    mine = [(b, n) for b, a, n in counts if a == "dhs"]
    if not mine:
        return []
    last = [n for b, n in mine if b == max(b for b, _ in mine)]
    return [("F1", max(last), min(-n for n in last), 10.0, sum(last))]


def test_snapshot_keeps_batch_number_and_micro_batch_apart(spark, tmp_path):
    """Replay batch 500 in micro-batch 0, a snapshot, then batch 501 in micro-batch 1."""
    tables = ResultTables(str(tmp_path / "r"))
    write_parts(spark, tables, 0, [(500, "dhs", 3)])
    assert snapshot_current(spark, tables)[WINNERS].endswith("upto=0")
    write_parts(spark, tables, 1, [(501, "fbi", 2)])
    assert current(spark, tables) == [("[dhs]", 3), ("[fbi]", 2)]
    # A late part makes fbi the winner of batch 500 too: [dhs] goes, [fbi] keeps its later batch.
    write_parts(spark, tables, 2, [(500, "fbi", 9)])
    assert current(spark, tables) == [("[fbi]", 2)]


def test_label_lost_to_a_late_part_falls_back_to_its_earlier_batch(spark, tmp_path):
    tables = ResultTables(str(tmp_path / "r"))
    write_parts(spark, tables, 0, [(1, "dhs", 5), (2, "fbi", 4), (3, "dhs", 7)])
    snapshot_current(spark, tables)
    write_parts(spark, tables, 1, [(3, "fbi", 8)])
    assert current(spark, tables) == [("[dhs]", 5), ("[fbi]", 8)]
    snapshot_current(spark, tables)
    assert current(spark, tables) == [("[dhs]", 5), ("[fbi]", 8)]


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshots_and_folds_equal_full_recompute_with_late_and_split_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    tables = ResultTables(str(tmp_path / "r"))
    ensure_tables(spark, tables)
    seen = []
    for micro_batch in range(6):
        low = max(0, 2 * micro_batch - 5)  # batches overlap those of earlier micro-batches
        counts = [
            (rng.randrange(low, 2 * micro_batch + 3), rng.choice(["dhs", "fbi", "cbp"]), rng.randrange(1, 6))
            for _ in range(rng.randrange(0, 7))
        ]
        write_parts(spark, tables, micro_batch, counts)
        seen += counts
        step = rng.choice(["snapshot", "fold", "none"])
        if step == "snapshot":
            snapshot_current(spark, tables)
        elif step == "fold":
            fold_history(spark, tables)
        assert current(spark, tables) == winners_by_hand(seen), (micro_batch, step)
        speeds = [tuple(r) for r in latest_views(spark, tables)[SPEED].collect()]
        assert speeds == speed_by_hand(seen)
    totals = {}
    for b, a, n in seen:
        totals[b, a] = totals.get((b, a), 0) + n
    got = {(r["batch_no"], r["agency"]): r["n"] for r in read_history(spark, tables, COUNTS).collect()}
    assert got == totals


def folders(root):
    return sum(len(d) for _, d, _ in os.walk(root))


@pytest.mark.parametrize("database", [None, "foldstore"])
def test_folded_history_reads_the_same_and_folders_do_not_pile_up(spark, tmp_path, database):
    feed = read_events_feed(spark, SF)
    staged = str(tmp_path / "staged")
    stage_lines(feed, staged, block_lines=170)
    name = f"fold{database or ''}"
    tables = ResultTables(str(tmp_path / name), database, run_id=name)
    drain(
        replayed(spark, staged), tables, tmp_path, name, agency="click", label="F3", batches_from_input=True,
        clock=ReplayClock(feed_lines=1000), fold_every=2, preview_rows=2,
    )
    records = parse_records(with_batches(feed)).records
    assert rows(read_history(spark, tables, WINNERS)) == rows(agency_winners(records))
    assert rows(read_history(spark, tables, COUNTS)) == rows(agency_counts(records))
    assert rows(read_history(spark, tables, SPEED)) == rows(speed_stats(records, "click", label="F3"))
    assert read_history(spark, tables, REJECTS).count() == 20
    assert read_history(spark, tables, LINES).agg(F.sum("n_lines")).first()[0] == 1000
    assert closed_upto(spark, tables) == 167
    views = latest_views(spark, tables)
    assert rows(views[WINNERS]) == rows(agency_winners_latest(agency_winners(records)))
    assert rows(views[SPEED]) == rows(speed_stats_latest(speed_stats(records, "click", label="F3")))
    if database:
        assert rows(spark.table(tables.table(WINNERS))) == rows(agency_winners(records))
    with pytest.raises(ValueError, match="folded"):
        read_parts(spark, tables, COUNTS, after=0)
    # Folds after micro-batches 1, 3 and 5: what the second replaced is gone, what the third did is kept.
    left = [os.path.basename(d) for d, _, files in os.walk(tables.path(COUNTS)) if files]
    left = sorted(d for d in left if d.startswith("micro_batch="))
    assert left == ["micro_batch=3", "micro_batch=4", "micro_batch=5", "micro_batch=5"], left
    assert folders(tables.path(COUNTS)) <= 7


def test_reader_that_began_before_a_fold_still_reads_right(spark, tmp_path):
    tables = ResultTables(str(tmp_path / "r"))
    counts = [[(b, "dhs", b + 1), (b + 1, "fbi", 2)] for b in range(6)]
    for b in range(3):
        write_parts(spark, tables, b, counts[b])
    fold_history(spark, tables)
    for b in range(3, 6):
        write_parts(spark, tables, b, counts[b])
    early = read_history(spark, tables, COUNTS)  # planned, not run
    fold_history(spark, tables)
    assert rows(early) == rows(read_history(spark, tables, COUNTS))
    assert fold_history(spark, tables) == sink.newest_fold(spark, tables)  # nothing new: nothing done


def test_fold_that_fails_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    tables = ResultTables(str(tmp_path / "r"))
    for b in range(3):
        write_parts(spark, tables, b, [(b, "dhs", 1)])
    before, write = rows(read_history(spark, tables, COUNTS)), sink._write

    def failing(df, block, micro_batch, attempt, tables, name):
        if name == SPEED_PARTS:
            raise OSError("disk gone")
        write(df, block, micro_batch, attempt, tables, name)

    monkeypatch.setattr(sink, "_write", failing)
    with pytest.raises(OSError):
        fold_history(spark, tables)
    monkeypatch.undo()
    assert sink.newest_fold(spark, tables) is None
    assert rows(read_history(spark, tables, COUNTS)) == before
    fold_history(spark, tables)
    assert rows(read_history(spark, tables, COUNTS)) == before


@pytest.mark.parametrize("database", [None, "commitstore"])
def test_failed_write_shows_nothing_and_its_retry_all(spark, tmp_path, monkeypatch, database):
    tables = ResultTables(str(tmp_path / "r"), database, run_id="c" if database else None)
    ensure_tables(spark, tables)
    writer = FeedBatchWriter(tables, agency="click", label="F3", preview_rows=2)
    lines = read_events_feed(spark, SF).select("line_no", "line")
    writer(lines.filter("line_no < 60"), 0)
    before = {n: rows(read_history(spark, tables, n)) for n in (*RESULTS, PREVIEW)}
    write, calls = sink._write, []

    def failing(df, block, micro_batch, attempt, tables, name):
        calls.append(name)
        if name == SPEED_PARTS:
            raise OSError("disk gone")
        write(df, block, micro_batch, attempt, tables, name)

    monkeypatch.setattr(sink, "_write", failing)
    more = lines.filter("line_no between 60 and 299")
    with pytest.raises(OSError):
        writer(more, 1)
    assert COUNTS in calls and REJECTS in calls  # other tables were written
    monkeypatch.undo()
    assert {n: rows(read_history(spark, tables, n)) for n in before} == before
    if database:
        assert rows(spark.table(tables.table(WINNERS))) == before[WINNERS]
    writer(more, 1)
    after = {n: rows(read_history(spark, tables, n)) for n in before}
    assert all(len(after[n]) > len(before[n]) for n in before)
    keyed = lines.withColumn("batch_no", F.when(F.col("line_no") < 60, 0).otherwise(1).cast("bigint"))
    records = parse_records(keyed.filter("line_no < 300")).records
    assert after[WINNERS] == rows(agency_winners(records))
    assert after[SPEED] == rows(speed_stats(records, "click", label="F3"))


def test_committed_micro_batch_is_not_written_again(spark, tmp_path):
    tables = ResultTables(str(tmp_path / "r"))
    write_parts(spark, tables, 0, [(0, "dhs", 1)])
    assert not write_histories(part_frames(spark, [(0, "dhs", 50)]), 0, tables)
    assert [r["n"] for r in read_history(spark, tables, COUNTS).collect()] == [1]


def staged_feed(spark, tmp_path, blocks, n=100):
    """Blocks of the feed in the order given, one micro-batch each."""
    staged = str(tmp_path / "staged")
    stage_lines(read_events_feed(spark, SF), staged, block_lines=n)
    arrived = tmp_path / "arrived"
    arrived.mkdir()
    for at, block in enumerate(blocks):
        for name in os.listdir(f"{staged}/block={block}"):
            if name.endswith(".parquet"):
                copy = arrived / f"{at:03d}.parquet"
                copy.write_bytes(open(f"{staged}/block={block}/{name}", "rb").read())
                os.utime(copy, (1_000_000 + 10 * at,) * 2)
    return str(arrived)


def test_stopped_drain_lists_finished_batches_only(spark, tmp_path):
    """Blocks 0, 2, 1, 4 of 100 lines: lines 0-299 and 400-499 are there, so batches up to line 299 are closed."""
    arrived = staged_feed(spark, tmp_path, [0, 2, 1, 4])
    tables = ResultTables(str(tmp_path / "r"))
    drain(
        replayed(spark, arrived), tables, tmp_path, "half", agency="click", batches_from_input=True,
        clock=ReplayClock(feed_lines=1000),
    )
    marks = rows(sink._table(spark, tables, sink.COMMITS).select("micro_batch", "low_line", "closed_upto"))
    assert marks == [(0, 96, 16), (1, 96, 16), (2, 300, 50), (3, 300, 50)]
    records = parse_records(with_batches(read_events_feed(spark, SF))).records
    want = agency_winners(records.filter("batch_no < 50"))
    assert rows(read_history(spark, tables, WINNERS, closed=True)) == rows(want)
    assert read_history(spark, tables, WINNERS).count() > want.count()  # open ones are there too


@pytest.mark.parametrize("interval_s,batch_s,feed_lines", [(5, 30, None), (7, 30, 20), (40, 30, 9), (3, 10, 11)])
def test_replay_clock_equals_counting_lines(spark, interval_s, batch_s, feed_lines):
    clock = ReplayClock(interval_s, batch_s, feed_lines)
    n = feed_lines or 50
    due = [line * interval_s // batch_s for line in range(n)]
    batches = spark.range(0, due[-1] + 2).toDF("b")
    got = {r["b"]: r["at"] for r in batches.select("b", clock.first_line(F.col("b")).alias("at")).collect()}
    for b, at in got.items():
        first = next((line for line, d in enumerate(due) if d >= b), n)
        assert at == first or (feed_lines is None and first == n and at >= n)
    for low in range(n + 1):
        open_batches = due[low:] if feed_lines else [*due[low:], n * interval_s // batch_s]
        assert clock.closed_upto(low) == (min(open_batches) if open_batches else due[-1] + 1)


def test_closing_needs_every_line_of_sparse_batches(spark):
    from skyledger.streaming.consumer import _low_line

    clock = ReplayClock(40, 30, 12)  # some batches are due no line
    counts = [(line * 40 // 30, 1) for line in (0, 1, 2, 4, 5, 7)]
    seen = spark.createDataFrame(counts, STORED[LINES])
    assert _low_line(seen, clock, 0) == 3
    assert _low_line(seen.filter("batch_no <> 0"), clock, 0) == 0
    more = spark.createDataFrame([*counts, (4, 1), (8, 1)], STORED[LINES])
    assert _low_line(more, clock, 3) == 8
    with pytest.raises(ValueError):
        ReplayClock(0, 30)
    with pytest.raises(ValueError):
        FeedBatchWriter(ResultTables("x"), "click", clock=clock)


def test_stored_preview_equals_batch_preview(spark, tmp_path):
    """Batches of 60 lines in blocks of 100: the first lines of a batch lie in two micro-batches."""
    arrived = staged_feed(spark, tmp_path, [3, 1, 0, 2])
    tables = ResultTables(str(tmp_path / "r"))
    stream = with_batches(sink_stream(spark, arrived), batch_s=300).drop("arrival_s")
    drain(stream, tables, tmp_path, "preview", agency="click", batches_from_input=True, preview_rows=10)
    lines = with_batches(read_events_feed(spark, SF).filter("line_no < 400"), batch_s=300)
    want = batch_preview(lines, 10).select("batch_no", "line_no", "line")
    got = read_history(spark, tables, PREVIEW).select("batch_no", "line_no", "line")
    assert rows(got) == rows(want)
    parts = read_parts(spark, tables, PREVIEW).groupBy("batch_no").count()
    assert parts.filter("count > 20").isEmpty() and not parts.filter("count > 10").isEmpty()


def sink_stream(spark, folder):
    from skyledger.streaming import staged_lines_stream

    return staged_lines_stream(spark, folder, 1)


def listed_tables(monkeypatch):
    """The tables that are listed as a whole from now on."""
    listed, table = [], sink._table
    monkeypatch.setattr(sink, "_table", lambda spark, tables, name: listed.append(name) or table(spark, tables, name))
    return listed


def test_folds_rewrite_a_part_as_often_as_the_history_doubles(spark, tmp_path, monkeypatch):
    """A fold of the whole history after every micro-batch would write a row 16 times."""
    tables = ResultTables(str(tmp_path / "r"))
    log, seen, written, write = sink.CommitLog(), [], [], sink._write

    def counting(df, block, micro_batch, attempt, tables, name):
        write(df, block, micro_batch, attempt, tables, name)
        if block == sink.FOLDS and name == COUNTS:
            written.append(spark.read.parquet(sink._folder(tables, name, block, micro_batch)).count())

    monkeypatch.setattr(sink, "_write", counting)
    for b in range(16):
        counts = [(b, "dhs", b + 1), (b + 1, "fbi", 2)]  # batch b + 1 lies in two micro-batches
        sink.write_attempt(part_frames(spark, counts), b, tables, sink.CommitFacts(None, None, b, b + 1), log)
        seen += counts
        fold = fold_history(spark, tables, log)
        if b in (6, 11):
            assert current(spark, tables) == winners_by_hand(seen)
            assert sink.newest_fold(spark, tables) == fold
            assert sink.read_log(spark, tables) == log
    assert max(len(f.all()) for f in [fold, sink.newest_fold(spark, tables)]) == 1  # 16 is a power of 2
    assert sum(written) <= 2 * 16 * 5, written  # the length doubles 4 times
    assert current(spark, tables) == winners_by_hand(seen)
    history = read_history(spark, tables, COUNTS)
    assert history.agg(F.sum("n")).first()[0] == sum(n for _, _, n in seen)


def test_snapshots_open_no_more_of_a_longer_history(spark, tmp_path, monkeypatch):
    tables = ResultTables(str(tmp_path / "r"))
    ensure_tables(spark, tables)
    writer = FeedBatchWriter(
        tables, "click", label="F3", outputs=(COUNTS, SPEED_PARTS), batches_from_input=True, snapshot_every=1
    )
    lines = with_batches(read_events_feed(spark, SF).select("line_no", "line")).drop("arrival_s")
    writer(lines.filter("line_no < 51"), 0)
    listed, opened, parts_of = listed_tables(monkeypatch), [], sink._parts_of

    def opening(spark, tables, name, chosen, batches=None):
        opened.append(len(chosen))
        return parts_of(spark, tables, name, chosen, batches)

    monkeypatch.setattr(sink, "_parts_of", opening)
    for number in range(1, 6):
        writer(lines.filter(f"line_no div 51 = {number}"), number)
    # Every second micro-batch of 51 lines begins within a batch: its own parts and those of the one before.
    assert listed == [] and max(opened) == 2, (listed, opened)
    monkeypatch.undo()
    records = parse_records(lines.filter("line_no < 306")).records
    assert current(spark, tables) == sorted(tuple(r) for r in agency_winners_latest(agency_winners(records)).collect())


def test_writer_notices_a_fold_by_another_process(spark, tmp_path):
    tables = ResultTables(str(tmp_path / "r"))
    ensure_tables(spark, tables)
    writer = FeedBatchWriter(
        tables, "click", label="F3", outputs=(COUNTS, SPEED_PARTS), batches_from_input=True, snapshot_every=1
    )
    lines = with_batches(read_events_feed(spark, SF).select("line_no", "line")).drop("arrival_s")
    for number in range(6):
        writer(lines.filter(f"line_no div 51 = {number}"), number)
        fold_history(spark, tables)
    records = parse_records(lines.filter("line_no < 306")).records
    assert rows(read_history(spark, tables, WINNERS)) == rows(agency_winners(records))
    assert current(spark, tables) == sorted(tuple(r) for r in agency_winners_latest(agency_winners(records)).collect())


def jobs_of(spark, call):
    """How many Spark jobs a call runs, with those of its threads."""
    context, group = spark.sparkContext, f"counted-{random.random()}"
    context.setJobGroup(group, "counted")
    try:
        call()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def one_task_lines(spark, tmp_path, number, n=51):
    """Lines of one micro-batch, in one partition as a staged block has them."""
    lines = with_batches(read_events_feed(spark, SF).select("line_no", "line")).drop("arrival_s")
    folder = str(tmp_path / f"lines{number}")
    lines.filter(f"line_no div {n} = {number}").coalesce(1).write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize(
    "outputs,options,most",
    [((SPEED_PARTS,), {"fold_every": 1}, 6), ((COUNTS, SPEED_PARTS), {"snapshot_every": 1}, 12)],
)
def test_small_micro_batch_runs_few_jobs(spark, tmp_path, outputs, options, most):
    """No exchanges between tasks where one task has it all, and no job for a record of one row."""
    tables = ResultTables(str(tmp_path / "r"))
    ensure_tables(spark, tables)
    writer = FeedBatchWriter(tables, "click", label="F3", outputs=outputs, batches_from_input=True, **options)
    batches = [one_task_lines(spark, tmp_path, number) for number in range(5)]
    counted = [jobs_of(spark, lambda n=n: writer(batches[n], n)) for n in range(5)]
    assert max(counted[1:]) <= most, counted
    lines = with_batches(read_events_feed(spark, SF).select("line_no", "line")).filter("line_no < 255")
    records = parse_records(lines).records
    want = rows(speed_stats(records, "click", label="F3"))
    assert rows(read_history(spark, tables, SPEED)) == want
    assert rows(latest_views(spark, tables)[SPEED]) == rows(speed_stats_latest(speed_stats(records, "click", label="F3")))
    if COUNTS in outputs:
        assert rows(read_history(spark, tables, WINNERS)) == rows(agency_winners(records))
        assert rows(latest_views(spark, tables)[WINNERS]) == rows(agency_winners_latest(agency_winners(records)))


@pytest.mark.parametrize("small_bytes", [0, sink.SMALL_BYTES])
def test_history_of_any_size_is_added_up_the_same(spark, tmp_path, monkeypatch, small_bytes):
    """Late parts, a label that loses its batch, folds and snapshots: by one task, and by exchanges."""
    monkeypatch.setattr(sink, "SMALL_BYTES", small_bytes)
    tables, log, seen = ResultTables(str(tmp_path / "r")), sink.CommitLog(), []
    ensure_tables(spark, tables)
    steps = [
        [(1, "dhs", 5), (2, "fbi", 4), (3, "dhs", 7)],
        [(3, "fbi", 8), (4, "cbp", 1)],
        [(4, "dhs", 1), (2, "cbp", 9)],
        [(0, "cbp", 2), (5, "fbi", 3)],
    ]
    for number, counts in enumerate(steps):
        batches = [b for b, _, _ in counts]
        facts = sink.CommitFacts(None, None, min(batches), max(batches))
        sink.write_attempt(part_frames(spark, counts), number, tables, facts, log)
        seen += counts
        snapshot_current(spark, tables, number, log)
        if number == 2:
            fold_history(spark, tables, log)
        stored = spark.read.parquet(f"{sink._snapshot_folder(tables, WINNERS)}/upto={number}").drop("batch_no")
        assert sorted(tuple(r) for r in stored.collect()) == winners_by_hand(seen), number
        assert current(spark, tables) == winners_by_hand(seen), number
        assert [tuple(r) for r in latest_views(spark, tables)[SPEED].collect()] == speed_by_hand(seen)
    assert sink.read_log(spark, tables) == log


def test_commit_record_is_hidden_until_it_is_whole(spark, tmp_path, monkeypatch):
    tables = ResultTables(str(tmp_path / "r"))
    ensure_tables(spark, tables)
    write_parts(spark, tables, 0, [(7, "dhs", 1)])
    record = sink._table(spark, tables, sink.COMMITS).drop("attempt").collect()
    assert [r.asDict() for r in record] == [
        dict(closed_upto=None, low_line=None, first_batch=7, last_batch=7, since=None, block=0, micro_batch=0)
    ]
    real = sink.file_system

    class NoRename:
        def __init__(self, files):
            self.files = files

        def create(self, path, overwrite):
            return self.files.create(path, overwrite)

        def rename(self, hidden, shown):
            return False

    monkeypatch.setattr(sink, "file_system", lambda spark, path: NoRename(real(spark, path)))
    with pytest.raises(OSError):
        sink._commit(spark, tables, 0, 1, "a", sink.CommitFacts(2, None, 1, 1))
    monkeypatch.undo()
    assert not sink.is_committed(spark, tables, 1) and sink.last_committed(spark, tables) == 0
