"""Bit tables as array columns, built and probed with built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 1 << 10
MAX_WORDS = 1 << 20  # 8 MB: the proven bound of what a probe carries to each task


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def power_of_two(n: int) -> int:
    """The smallest power of two of at least ``n``, within the table bounds."""
    return min(MAX_WORDS, max(MIN_WORDS, 1 << max(0, n - 1).bit_length()))


def bit_table(masks: DataFrame, n_words: int) -> DataFrame:
    """One row, one column ``bits``: the OR of (``word``, ``mask``) rows as ``n_words`` longs.

    Rows of a word are combined before the shuffle; the table has
    ``n_words`` entries (at most ``MAX_WORDS``) however many masks come in.
    """
    spark = masks.sparkSession
    set_words = masks.groupBy("word").agg(F.bit_or("mask").alias("mask"))
    dense = spark.range(n_words).join(set_words, F.col("id") == F.col("word"), "left")
    in_order = F.array_sort(F.collect_list(F.struct("id", F.coalesce("mask", F.lit(0)).alias("mask"))))
    return dense.agg(F.transform(in_order, lambda x: x["mask"]).alias("bits"))
