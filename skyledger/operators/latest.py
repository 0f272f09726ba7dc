"""Latest-per-key views over result history.

The reference upserts one row per primary key (winner label, flight
segment).  Here results are kept per batch and the current table is the
row of the highest batch per key: ``max_by`` is a partial aggregate, so a
key present in most batches still combines map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    history: DataFrame,
    keys: Sequence[str],
    order_col: str = "batch_no",
    values: Sequence[str] | None = None,
    keep_order_col: bool = False,
    unique_order: bool = True,
) -> DataFrame:
    """For each key, the value columns of the row with the largest ``order_col``.

    With ``unique_order`` (one row per key and order value, as in a result
    history) every value column is its own ``max_by``: fixed-width values
    then aggregate in a hash aggregate.  Otherwise one ``max_by`` over a
    struct keeps the values of a single row.
    """
    keys = list(keys)
    if values is None:
        values = [c for c in history.columns if c not in keys and c != order_col]
    order = F.col(order_col)
    if unique_order:
        aggs = [F.expr(f"max_by(`{c}`, `{order_col}`) AS `{c}`") for c in values]
        if keep_order_col:
            aggs.append(F.expr(f"max(`{order_col}`) AS `{order_col}`"))
        return history.groupBy(*keys).agg(*aggs)
    payload = list(values) + ([order_col] if keep_order_col else [])
    latest = history.groupBy(*keys).agg(F.max_by(F.struct(*payload), order).alias("_latest"))
    return latest.select(*keys, *[F.col("_latest")[c].alias(c) for c in payload])


def agency_winners_latest(winners: DataFrame, keep_batch: bool = False) -> DataFrame:
    """One row per winner label with the count of its latest batch."""
    return latest_per_key(
        winners,
        ["agency_most_flight_segs"],
        values=["num_of_flight_segs"],
        keep_order_col=keep_batch,
    )


def speed_stats_latest(stats: DataFrame, keep_batch: bool = False) -> DataFrame:
    """One row per flight segment label with the statistics of its latest batch."""
    return latest_per_key(
        stats,
        ["flight_segment"],
        values=["max_speed", "min_speed", "avg_speed", "num_of_flight_segments"],
        keep_order_col=keep_batch,
    )
