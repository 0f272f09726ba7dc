"""Per-batch aggregates of parsed records.

All operators take records with batch key columns (``batch_no`` by
default) and group by them, so an empty batch simply has no row.  Every
aggregate is partial + final (map-side combine), which keeps a hot batch
or a hot agency from landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formatting import set_label

Keys = Sequence[str]
BATCH_KEYS: tuple[str, ...] = ("batch_no",)


def batch_counts(records: DataFrame, keys: Keys = BATCH_KEYS) -> DataFrame:
    """Rows per batch: ``(*keys, n)``."""
    return records.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def agency_counts(records: DataFrame, keys: Keys = BATCH_KEYS) -> DataFrame:
    """Flight segments per batch and agency: ``(*keys, agency, n)``."""
    return records.groupBy(*keys, "agency").agg(F.count(F.lit(1)).alias("n"))


def agency_leaders(records: DataFrame, keys: Keys = BATCH_KEYS) -> DataFrame:
    """Every agency whose count is the batch maximum: ``(*keys, agency, n)``.

    ``rank() = 1`` keeps all ties.  Spark plans it with a partial
    ``WindowGroupLimit`` before the shuffle on the batch key, so each map
    task forwards only its local leaders of a batch.
    """
    return leaders_of_counts(agency_counts(records, keys), keys)


def leaders_of_counts(counts: DataFrame, keys: Keys = BATCH_KEYS) -> DataFrame:
    """``agency_leaders`` from ``agency_counts`` output."""
    by_count = Window.partitionBy(*keys).orderBy(F.col("n").desc())
    return (
        counts.withColumn("_rank", F.rank().over(by_count))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def agency_winners(records: DataFrame, keys: Keys = BATCH_KEYS) -> DataFrame:
    """Agency or agencies with most flight segments per batch.

    ``(*keys, agency_most_flight_segs, num_of_flight_segs)``; the label
    lists all tied agencies sorted, e.g. ``[dhs, fbi]``.  Only the leaders
    are collected, and the grouping reuses the window's partitioning.
    """
    return winners_of_counts(agency_counts(records, keys), keys)


def winners_of_counts(counts: DataFrame, keys: Keys = BATCH_KEYS) -> DataFrame:
    """``agency_winners`` from ``agency_counts`` output."""
    leaders = leaders_of_counts(counts, keys)
    return leaders.groupBy(*keys).agg(
        set_label(F.collect_list("agency")).alias("agency_most_flight_segs"),
        F.max("n").alias("num_of_flight_segs"),
    )


def speed_stats(
    records: DataFrame,
    agency: str,
    flight: str | None = None,
    label: str | None = None,
    keys: Keys = BATCH_KEYS,
) -> DataFrame:
    """Max / min / average speed and row count per batch for one agency.

    ``flight=None`` reproduces the reference code: statistics over all rows
    of the agency, stored under ``label`` (its configured flight id).  With
    ``flight`` set only that flight's rows count, as its README describes;
    the label then defaults to the flight id.  Filters reach the scan when
    the records come from a columnar table.
    """
    return finish_speed_stats(speed_parts(records, agency, flight, label, keys), keys)


def speed_parts(
    records: DataFrame,
    agency: str,
    flight: str | None = None,
    label: str | None = None,
    keys: Keys = BATCH_KEYS,
) -> DataFrame:
    """Mergeable speed statistics of one agency: ``(*keys, flight_segment, max_speed, min_speed,
    sum_speed, n)``.  Parts of the same keys add up in ``finish_speed_stats``."""
    wanted = F.col("agency") == F.lit(agency)
    if flight is not None:
        wanted = wanted & (F.col("flight_id") == F.lit(flight))
    segment = label if label is not None else flight
    parts = records.filter(wanted).groupBy(*keys).agg(
        F.expr("max(speed) AS max_speed"),
        F.expr("min(speed) AS min_speed"),
        F.expr("sum(CAST(speed AS BIGINT)) AS sum_speed"),
        F.expr("count(1) AS n"),
    )
    return parts.withColumn("flight_segment", F.lit(segment).cast("string"))


_SPEED = (
    "flight_segment",
    "max_speed",
    "min_speed",
    "CAST(sum_speed AS DOUBLE) / n AS avg_speed",
    "n AS num_of_flight_segments",
)


def finish_speed_stats(parts: DataFrame, keys: Keys = BATCH_KEYS, merge: bool = False) -> DataFrame:
    """Statistics from ``speed_parts``; ``merge`` adds up several parts of the same keys first."""
    if merge:
        parts = parts.groupBy(*keys, "flight_segment").agg(
            F.expr("max(max_speed) AS max_speed"),
            F.expr("min(min_speed) AS min_speed"),
            F.expr("sum(sum_speed) AS sum_speed"),
            F.expr("sum(n) AS n"),
        )
    return parts.selectExpr(*[f"`{key}`" for key in keys], *_SPEED)
