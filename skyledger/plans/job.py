"""Batch job: feed files -> parsed table -> both results and rejects.

The parse runs once: every line is written, typed, to a parquet table
(the raw text is kept only for rejected lines).  The results then read
that table; Catalyst prunes it to the columns each result needs and
pushes the agency / flight filters into the scan.

    python -m skyledger.plans.job --input FEED_FILES --output DIR --agency dhs \
        [--flight F1] [--label F1] [--interval-s 5] [--batch-s 30]
"""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..operators import (
    agency_winners,
    agency_winners_latest,
    parse_lines,
    speed_stats,
    speed_stats_latest,
    split_parsed,
    with_batches,
)
from ..operators.replay import BATCH_INTERVAL_S, PUBLISH_INTERVAL_S
from ..session import build_session, run_together
from ..sources import read_lines


def write_parsed(lines: DataFrame, path: str) -> None:
    """Parse once and keep the typed lines; raw text only where rejected.

    Each task sorts its own output by agency before writing (no shuffle), so
    every parquet row group holds few agencies and its min/max statistics
    let a scan with ``agency = x`` pushed down skip the other row groups.
    """
    parsed = parse_lines(lines, keep_good_lines=False)
    parsed.sortWithinPartitions("agency", "batch_no").write.mode("overwrite").parquet(path)


def run_job(
    spark: SparkSession,
    lines: DataFrame,
    output: str,
    agency: str,
    flight: str | None = None,
    label: str | None = None,
) -> dict[str, str]:
    """Write parsed lines, winners, speed statistics, rejects and latest views."""
    out = output.rstrip("/")
    write_parsed(lines, f"{out}/parsed")
    parsed = split_parsed(spark.read.parquet(f"{out}/parsed"))
    results = {
        "agency_winners": agency_winners(parsed.records),
        "speed_stats": speed_stats(parsed.records, agency, flight, label),
        "rejects": parsed.rejects,
    }
    paths = _write_all(results, out)
    latest = {
        "agency_winners_latest": agency_winners_latest(spark.read.parquet(paths["agency_winners"])),
        "speed_stats_latest": speed_stats_latest(spark.read.parquet(paths["speed_stats"])),
    }
    paths.update(_write_all(latest, out))
    return paths


def _write_all(frames: dict[str, DataFrame], out: str) -> dict[str, str]:
    """Write each frame to ``out/<name>``, one Spark job per frame, run concurrently
    so that a light result does not wait behind a heavy one's tail."""
    paths = {name: f"{out}/{name}" for name in frames}
    spark = next(iter(frames.values())).sparkSession
    run_together(spark, [partial(df.write.mode("overwrite").parquet, paths[name]) for name, df in frames.items()])
    return paths


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Flight-segment feed batch job")
    ap.add_argument("--input", required=True, nargs="+", help="feed files or folders")
    ap.add_argument("--output", required=True)
    ap.add_argument("--agency", required=True)
    ap.add_argument("--flight")
    ap.add_argument("--label")
    ap.add_argument("--interval-s", type=int, default=PUBLISH_INTERVAL_S)
    ap.add_argument("--batch-s", type=int, default=BATCH_INTERVAL_S)
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    spark = build_session(args.master, app_name="skyledger-job")
    lines = with_batches(read_lines(spark, args.input), args.interval_s, args.batch_s)
    for name, path in run_job(spark, lines, args.output, args.agency, args.flight, args.label).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
