"""Replay timing as columns.

The reference producer sends one line every ``interval_s`` seconds and the
consumer cuts the stream into micro-batches of ``batch_s`` seconds.  In a
batch run both are plain arithmetic on the line number: no sleeping, no
ordering step, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reference's configured pacing (seconds per line) and
# micro-batch length (seconds).
PUBLISH_INTERVAL_S = 5
BATCH_INTERVAL_S = 30


def with_batches(
    lines: DataFrame,
    interval_s: int = PUBLISH_INTERVAL_S,
    batch_s: int = BATCH_INTERVAL_S,
    line_col: str = "line_no",
) -> DataFrame:
    """Add ``arrival_s = line_no * interval_s`` and ``batch_no``."""
    if interval_s < 0 or batch_s <= 0:
        raise ValueError("interval_s must be >= 0 and batch_s > 0")
    arrival = f"CAST(`{line_col}` AS BIGINT) * {int(interval_s)}"
    return lines.withColumns(
        {"arrival_s": F.expr(arrival), "batch_no": F.expr(f"({arrival}) div {int(batch_s)}")}
    )


@dataclass(frozen=True)
class ReplayClock:
    """When the lines of a replay are due, and so which lines make up a batch.

    ``feed_lines``, the number of lines of the whole feed, is what tells that
    its last batch is complete; without it that batch stays open.
    """

    interval_s: int = PUBLISH_INTERVAL_S
    batch_s: int = BATCH_INTERVAL_S
    feed_lines: int | None = None

    def __post_init__(self) -> None:
        if self.interval_s <= 0 or self.batch_s <= 0:
            raise ValueError("a replay clock needs interval_s > 0 and batch_s > 0")

    @property
    def lines_per_batch(self) -> int:
        """Lines that are due in one batch (at least one, so that a replay gets on)."""
        return max(1, self.batch_s // self.interval_s)

    def first_line(self, batch: Column) -> Column:
        """The number of the first line due in ``batch`` or after it; a feed ends at its number of lines."""
        due = F.call_function("div", batch * self.batch_s + (self.interval_s - 1), F.lit(self.interval_s))
        return due if self.feed_lines is None else F.least(due, F.lit(self.feed_lines).cast("bigint"))

    def closed_upto(self, low_line: int) -> int:
        """The first batch that may still get lines when all lines below ``low_line`` have come."""
        if self.feed_lines is not None and low_line >= self.feed_lines > 0:
            return (self.feed_lines - 1) * self.interval_s // self.batch_s + 1
        return low_line * self.interval_s // self.batch_s
