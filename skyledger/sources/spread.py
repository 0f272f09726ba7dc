"""Spread a narrow scan over the cluster's cores.

A scan yields one task per file split; a few large unsplittable inputs
(one parquet row group, a gzip file) give fewer tasks than there are cores,
and everything before the first shuffle then runs in those few tasks.
``spread_narrow`` adds one round-robin shuffle in that case only.  On
inputs with at least as many splits as cores, the usual case at scale, it
returns the frame unchanged.

Catalyst moves deterministic filters below a repartition, so a per-row
filter applied later (the feed's accept pattern, say) would run back in
the scan's few tasks and the shuffle would only carry its survivors.  The
spread frame therefore ends in an observation of its row count: filters do
not move below ``observe``, so per-row work stays after the shuffle, and
the count (``rows``) is reported to listeners under ``spread_<id>`` when the
query runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_narrow(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        # Every file is at least one split.  The file list is already on the
        # driver (listed when the scan was built), so a wide input is known
        # without planning its splits, which for a very large scan would be
        # planned twice.  (All files of the table count, before partition
        # pruning; a heavily pruned scan is then left as it is.)
        if len(df.inputFiles()) >= target:
            return df
        current = df.rdd.getNumPartitions()
    except (NotImplementedError, AttributeError):  # a Spark Connect session has no RDD view
        return df
    if current >= target:
        return df
    # One observation name per spread frame: a plan may hold several.
    name = f"spread_{uuid.uuid4().hex[:12]}"
    return df.repartition(target).observe(name, F.count(F.lit(1)).alias("rows"))
