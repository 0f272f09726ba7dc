"""Previews: first lines of a feed and the first lines of every batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.lines import first_lines_of

PREVIEW_ROWS = 10


def first_lines(
    lines: DataFrame, n: int, order_col: str = "line_no", dense: bool = False
) -> DataFrame:
    """The first ``n`` lines (the producer's ``readLines(n)``); see ``first_lines_of``."""
    return first_lines_of(lines, n, order_col, dense)


def batch_preview(
    lines: DataFrame,
    n: int = PREVIEW_ROWS,
    keys: Sequence[str] = ("batch_no",),
    order_col: str = "line_no",
) -> DataFrame:
    """The first ``n`` lines of every batch (a stream's ``print()``).

    ``row_number() <= n`` is planned with a partial ``WindowGroupLimit``:
    at most ``n`` rows per batch leave each map task.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    first = Window.partitionBy(*keys).orderBy(order_col)
    return (
        lines.withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") <= n)
        .drop("_rn")
    )
