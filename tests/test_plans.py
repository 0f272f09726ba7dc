"""Physical plan shape: pushdown, pruning, partial aggregation, group limits."""

from skyledger.operators import agency_winners, batch_preview, parse_records, speed_stats, word_count
from skyledger.plans.queries import feed_lines, feed_records
from skyledger.sources import read_documents

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_winners_limit_before_shuffle(spark):
    text = plan(agency_winners(feed_records(spark, SF)))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "partial_count" in text


def test_accept_filter_does_not_split(spark):
    records = parse_records(feed_lines(spark, SF)).records
    physical = records._jdf.queryExecution().sparkPlan()
    filters = [n for n in physical.toString().splitlines() if "Filter" in n]
    assert filters and all("split(" not in f for f in filters)


def test_speed_stats_prunes_and_pushes(spark, tmp_path):
    path = str(tmp_path / "records")
    feed_records(spark, SF).write.parquet(path)
    stats = speed_stats(spark.read.parquet(path), "click", flight="F3")
    text = plan(stats)
    assert "PushedFilters: [IsNotNull(agency), IsNotNull(flight_id), EqualTo(agency,click), EqualTo(flight_id,F3)]" in text
    assert "ReadSchema: struct<batch_no:bigint,flight_id:string,speed:int,agency:string>" in text


def test_preview_limit_before_shuffle(spark):
    text = plan(batch_preview(feed_lines(spark, SF, batch_s=300), 10))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_word_count_reads_text_only(spark):
    text = plan(word_count(read_documents(spark, SF)))
    assert "ReadSchema: struct<text:string>" in text
    assert "partial_count" in text


def test_narrow_feed_parses_after_spreading(spark):
    # sf0.001 events is one row group, so the scan is one task and the feed
    # is spread; the accept filter must run after that shuffle, not in the scan.
    if spark.sparkContext.defaultParallelism < 2:
        return
    records = parse_records(feed_lines(spark, SF)).records
    lines = records._jdf.queryExecution().sparkPlan().toString().splitlines()
    exchange = next(i for i, n in enumerate(lines) if "RoundRobinPartitioning" in n)
    accept = next(i for i, n in enumerate(lines) if "Filter" in n and "RLIKE" in n)
    assert accept < exchange  # printed top-down: the filter sits above the shuffle


def test_spread_only_narrow_inputs(spark, tmp_path):
    from skyledger.sources import spread_narrow

    cores = spark.sparkContext.defaultParallelism
    wide = str(tmp_path / "wide")
    spark.range(cores * 100).repartition(cores).write.parquet(wide)
    df = spark.read.parquet(wide)
    assert spread_narrow(df) is df  # as many files as cores: left as is

    narrow = str(tmp_path / "narrow")
    spark.range(1000).coalesce(1).write.parquet(narrow)
    spread = spread_narrow(spark.read.parquet(narrow))
    if cores > 1:
        text = plan(spread)
        assert "RoundRobinPartitioning" in text and "CollectMetrics" in text
    assert spread.count() == 1000
