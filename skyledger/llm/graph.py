"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``); the root is the least node.

    Every round hooks each node's larger neighbours, then its smaller ones,
    to the least of them (large and small stars), on the shrinking edge table
    alone: aggregates and joins on one node at a time, no group is gathered.
    Both sides of a join are plain tables, so that adaptive execution can
    split the partition of a node with very many neighbours.  Rounds grow
    with the logarithm of the longest path.
    """
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    stars = materialize(edges.filter("a <> b").select(larger, smaller).distinct(), "edges")
    before = None
    while True:
        state = stars.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        now = tuple(state.first())
        if now == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = materialize(least, "least")
        hooked = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        hooked = materialize(hooked, "hooked")
        least = materialize(hooked.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = hooked.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialize(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
