"""Feed lines derived from the ``events`` table.

The reference's flight file is not public, so the tests and benchmarks
render one feed line per ``events`` row.  The rendering is plain column
arithmetic in Spark, so the feed grows with the table.  An empty speed
every 97th event and an empty agency every 101st make bad rows of both
kinds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import EVENTS_INPUT_SCHEMA, SEPARATOR
from .spread import spread_narrow

EMPTY_SPEED_EVERY = 97
EMPTY_AGENCY_EVERY = 101


# Feed fields as Spark SQL over ``events`` columns, in wire order.
# The text of a timestamp_ntz is zone-free ('yyyy-MM-dd HH:mm:ss[.ffffff]'),
# so the ISO form is cut from it rather than formatted in a session zone.
_FIELD_SQL = (
    "concat('A', user_id)",
    "concat('F', user_id % 10)",
    "concat(event_id % 90, '.5')",
    "concat('-', event_id % 180, '.25')",
    "CAST(event_id % 40000 AS STRING)",
    f"CASE WHEN event_id % {EMPTY_SPEED_EVERY} = 0 THEN '' "
    "ELSE CAST(CAST(floor(value) AS INT) AS STRING) END",
    "CAST(event_id % 360 AS STRING)",
    "lpad(CAST(event_id % 7777 AS STRING), 4, '0')",
    "'B'",
    "concat(substring(CAST(ts AS STRING), 1, 10), 'T', substring(CAST(ts AS STRING), 12, 8), 'Z')",
    "'NAME'",
    "''",
    "''",
    "concat('N', user_id)",
    "'SER'",
    "'2072738'",
    "'CESSNA'",
    "'182T'",
    "'2006'",
    "'4'",
    f"CASE WHEN event_id % {EMPTY_AGENCY_EVERY} = 0 THEN '' ELSE event_type END",
)

LINE_SQL = f"concat_ws('{SEPARATOR}', {', '.join(_FIELD_SQL)})"


def events_feed(events: DataFrame) -> DataFrame:
    """``(line_no, line)``: one feed line per event, ``line_no = event_id``."""
    return events.selectExpr("event_id AS line_no", f"{LINE_SQL} AS line")


def read_events_feed(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """The stand-in feed; ``spread`` spreads a narrow ``events`` scan over the cores
    (worth it when parsing or rendering follows, not for a bare projection)."""
    events = read_events(spark, sf_dir)
    return events_feed(spread_narrow(events) if spread else events)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_INPUT_SCHEMA).parquet(f"{sf_dir}/events.parquet")
