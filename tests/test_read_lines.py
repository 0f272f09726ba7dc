"""Line numbering over several files and several splits per file."""

import os

import pytest

from skyledger.sources import first_lines_of, read_lines


def _write(path, header, n, tag):
    with open(path, "w") as fh:
        fh.write(header + "\n")
        for i in range(n):
            fh.write(f"{tag}-{i:05d}\n")


def test_numbering_across_files_and_splits(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _write(folder / "a.txt", "HEAD", 3000, "a")
    _write(folder / "b.txt", "HEAD", 10, "b")
    _write(folder / "c.txt", "HEAD", 0, "c")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        for limit in (10**9, 0):  # broadcast and shuffle join of the split table
            lines = read_lines(spark, str(folder), max_broadcast_bytes=limit)
            if limit:  # hinted; past the limit Spark's own size threshold decides
                assert "BroadcastHashJoin" in lines._jdf.queryExecution().executedPlan().toString()
            got = sorted((r["line_no"], r["line"], r["file_line_no"]) for r in lines.collect())
            want = [(i, f"a-{i:05d}", i) for i in range(3000)]
            want += [(3000 + i, f"b-{i:05d}", i) for i in range(10)]
            assert got == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_blank_lines_are_kept_and_crlf(spark, tmp_path):
    path = tmp_path / "f.txt"
    path.write_bytes(b"H\r\nx\r\n\r\ny\n")
    got = sorted((r["line_no"], r["line"]) for r in read_lines(spark, str(path)).collect())
    assert got == [(0, "x"), (1, ""), (2, "y")]


def test_first_lines(spark, tmp_path):
    path = tmp_path / "f.txt"
    _write(path, "H", 50, "z")
    lines = read_lines(spark, str(path))
    for dense in (False, True):
        got = [r["line"] for r in first_lines_of(lines, 3, dense=dense).collect()]
        assert got == ["z-00000", "z-00001", "z-00002"]
    assert "TakeOrderedAndProject" not in first_lines_of(lines, 3, dense=True)._jdf.queryExecution().executedPlan().toString()


def test_missing_path_fails(spark, tmp_path):
    import pytest

    with pytest.raises(Exception):
        read_lines(spark, os.path.join(str(tmp_path), "nope.csv"))


def test_changed_splits_fail_loudly(spark, tmp_path):
    import pytest

    folder = tmp_path / "in"
    folder.mkdir()
    _write(folder / "a.txt", "HEAD", 3000, "a")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "8")
    try:
        lines = read_lines(spark, str(folder))
        assert lines.count() == 3000
        # As if the cluster shrank: splits are cut differently at run time.
        spark.conf.set("spark.sql.files.minPartitionNum", "3")
        with pytest.raises(Exception, match="file splits differ"):
            lines.count()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_gzip_files(spark, tmp_path):
    import gzip

    folder = tmp_path / "gz"
    folder.mkdir()
    for name, tag, n in (("a.txt.gz", "a", 500), ("b.txt.gz", "b", 7)):
        with gzip.open(folder / name, "wt") as fh:
            fh.write("HEAD\n" + "".join(f"{tag}-{i:05d}\n" for i in range(n)))
    got = sorted((r["line_no"], r["line"]) for r in read_lines(spark, str(folder)).collect())
    want = [(i, f"a-{i:05d}") for i in range(500)] + [(500 + i, f"b-{i:05d}") for i in range(7)]
    assert got == want


def test_numbering_property(spark, tmp_path_factory):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(
        st.lists(st.integers(min_value=0, max_value=400), min_size=1, max_size=4),
        st.integers(min_value=300, max_value=5000),
        st.integers(min_value=0, max_value=2),
    )
    def check(sizes, split_bytes, headers):
        folder = tmp_path_factory.mktemp("prop")
        want = []
        for f, n in enumerate(sizes):
            body = [f"f{f}-{i:04d}" + "x" * (i % 7) for i in range(n)]
            head = [f"H{f}-{h}" for h in range(headers)]
            (folder / f"part-{f:03d}.txt").write_text("".join(line + "\n" for line in head + body))
            want += body
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            lines = read_lines(spark, str(folder), header_lines=headers)
            got = sorted((r["line_no"], r["line"]) for r in lines.collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert got == list(enumerate(want))

    check()


def test_file_line_bases_match_prefix_sum(spark, tmp_path):
    import random

    from skyledger.sources.lines import _file_line_bases

    rng = random.Random(7)
    counts = {f"file:/feed/part-{i:04d}.txt": rng.choice([0, 1, 5, 300]) for i in range(500)}
    files = spark.createDataFrame(list(counts.items()), "source_file string, _data_rows long")
    got = dict(_file_line_bases(files, 7, str(tmp_path / "files")).collect())
    want, total = {}, 0
    for path in sorted(counts):
        want[path] = total
        total += counts[path]
    assert got == want


def test_staged_feed_files_round_trip(spark, tmp_path):
    import glob

    from pyspark.sql import functions as F

    from skyledger.schema import HEADER_LINE
    from skyledger.streaming import write_feed_files

    lines = spark.range(50).select(
        F.col("id").alias("line_no"), F.concat(F.lit("row-"), F.col("id")).alias("line")
    )
    folder = str(tmp_path / "staged")
    write_feed_files(lines.repartition(3), folder, lines_per_file=7)
    dirs = sorted(glob.glob(f"{folder}/file=*"))
    assert len(dirs) == 8  # ceil(50 / 7) blocks, one folder each
    for k, d in enumerate(dirs):
        parts = glob.glob(f"{d}/*.txt")
        assert len(parts) == 1  # a block is written whole by one task
        text = open(parts[0]).read().splitlines()
        assert text[0] == HEADER_LINE
        assert text[1:] == [f"row-{i}" for i in range(7 * k, min(50, 7 * k + 7))]
    got = sorted((r["line_no"], r["line"]) for r in read_lines(spark, folder).collect())
    assert got == [(i, f"row-{i}") for i in range(50)]


def test_split_table_reads_counts_not_text(spark, tmp_path):
    from pyspark.sql import functions as F

    from skyledger.sources.lines import _per_split, _split_table

    folder = tmp_path / "feed"
    folder.mkdir()
    for k in range(3):
        _write(str(folder / f"part-{k}.txt"), "HEAD", 50, f"f{k}")
    raw = spark.read.text(str(folder)).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row_id"),
    )
    counts_path = str(tmp_path / "counts")
    _per_split(raw).write.parquet(counts_path)
    table = _split_table(spark.read.parquet(counts_path), 1, str(tmp_path / "table"))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan  # the one text scan was the counts write
    assert sorted(r["_line_base"] for r in table.collect()) == [0, 50, 100]


def test_file_line_bases_property(spark, tmp_path_factory):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from skyledger.sources.lines import _file_line_bases

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(
        st.lists(st.integers(min_value=0, max_value=1000), min_size=1, max_size=60),
        st.integers(min_value=1, max_value=16),
    )
    def check(rows, n_ranges):
        counts = {f"file:/f/{i:03d}-{r}": r for i, r in enumerate(rows)}
        files = spark.createDataFrame(list(counts.items()), "source_file string, _data_rows long")
        got = dict(_file_line_bases(files, n_ranges, str(tmp_path_factory.mktemp("bases") / "files")).collect())
        want, total = {}, 0
        for path in sorted(counts):
            want[path] = total
            total += counts[path]
        assert got == want

    check()


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_file_line_bases_do_not_rest_on_exchange_reuse(spark, tmp_path, reuse):
    from pyspark.sql import functions as F

    from skyledger.sources.lines import _file_line_bases

    n = 300_000
    name = F.concat(F.lit("file:/feed/"), F.lpad(F.col("id").cast("string"), 7, "0"))
    files = spark.range(n).select(name.alias("source_file"), (F.col("id") % 5).alias("_data_rows"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        bases = _file_line_bases(files.repartition(16), 64, str(tmp_path / "files"))
        # Whole groups of five files hold ten lines.
        number = F.substring("source_file", 12, 7).cast("bigint")
        within = F.expr("element_at(array(0, 0, 1, 3, 6), cast(k % 5 as int) + 1)")
        wrong = bases.withColumn("k", number).filter(F.col("_line_base") != F.expr("k div 5 * 10") + within)
        assert bases.count() == n and wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
