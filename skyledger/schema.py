"""Record and result schemas of the flight-segment feed.

The feed is positional: one line holds 21 ``;``-separated fields, in the
order below.  Nothing is inferred from the header line.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and kinds of one feed record, in wire order.
RECORD_FIELDS: tuple[tuple[str, str], ...] = (
    ("adshex", "string"),
    ("flight_id", "string"),
    ("latitude", "float"),
    ("longitude", "float"),
    ("altitude", "int"),
    ("speed", "int"),
    ("track", "int"),
    ("squawk", "int"),
    ("type", "string"),
    ("timestamp", "string"),
    ("name", "string"),
    ("other_names1", "string"),
    ("other_names2", "string"),
    ("n_number", "string"),
    ("serial_number", "string"),
    ("mfr_mdl_code", "int"),
    ("mfr", "string"),
    ("model", "string"),
    ("year_mfr", "int"),
    ("type_aircraft", "int"),
    ("agency", "string"),
)

FIELD_NAMES: tuple[str, ...] = tuple(name for name, _ in RECORD_FIELDS)
N_FIELDS = len(RECORD_FIELDS)

# Separator and header text of a feed file.
SEPARATOR = ";"
HEADER_LINE = SEPARATOR.join(FIELD_NAMES)

_SPARK_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "float": T.FloatType()}

RECORD_SCHEMA = T.StructType(
    [T.StructField(name, _SPARK_TYPES[kind], True) for name, kind in RECORD_FIELDS]
)

# Current tables: a row per key with its latest batch.
WINNERS_LATEST_SCHEMA = T.StructType(
    [
        T.StructField("agency_most_flight_segs", T.StringType(), True),
        T.StructField("num_of_flight_segs", T.LongType(), True),
        T.StructField("batch_no", T.LongType(), True),
    ]
)

SPEED_LATEST_SCHEMA = T.StructType(
    [
        T.StructField("flight_segment", T.StringType(), True),
        T.StructField("max_speed", T.IntegerType(), True),
        T.StructField("min_speed", T.IntegerType(), True),
        T.StructField("avg_speed", T.DoubleType(), True),
        T.StructField("num_of_flight_segments", T.LongType(), True),
        T.StructField("batch_no", T.LongType(), True),
    ]
)

# Stored history: parts of one micro-batch that add up by batch_no.
COUNT_PARTS_SCHEMA = T.StructType(
    [
        T.StructField("batch_no", T.LongType(), True),
        T.StructField("agency", T.StringType(), True),
        T.StructField("n", T.LongType(), True),
    ]
)

SPEED_PARTS_SCHEMA = T.StructType(
    [
        T.StructField("batch_no", T.LongType(), True),
        T.StructField("flight_segment", T.StringType(), True),
        T.StructField("max_speed", T.IntegerType(), True),
        T.StructField("min_speed", T.IntegerType(), True),
        T.StructField("sum_speed", T.LongType(), True),
        T.StructField("n", T.LongType(), True),
    ]
)

# A line of a topic is identified by its partition and offset (line_no), one of
# a feed file by the file and its place in it.
REJECTS_SCHEMA = T.StructType(
    [
        T.StructField("batch_no", T.LongType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("line_no", T.LongType(), True),
        T.StructField("line", T.StringType(), True),
        T.StructField("reason", T.StringType(), True),
        T.StructField("source_file", T.StringType(), True),
    ]
)

# First lines of a batch; parts are cut to ``rows`` lines again when they meet.
PREVIEW_SCHEMA = T.StructType(
    [*(f for f in REJECTS_SCHEMA.fields if f.name != "reason"), T.StructField("rows", T.IntegerType(), True)]
)

LINE_PARTS_SCHEMA = T.StructType(
    [T.StructField("batch_no", T.LongType(), True), T.StructField("n_lines", T.LongType(), True)]
)

# The record that makes the parts of a micro-batch visible.
COMMITS_SCHEMA = T.StructType(
    [
        T.StructField("closed_upto", T.LongType(), True),
        T.StructField("low_line", T.LongType(), True),
        T.StructField("first_batch", T.LongType(), True),
        T.StructField("last_batch", T.LongType(), True),
        T.StructField("since", T.LongType(), True),
    ]
)

# Input tables, as declared reads: only the columns used.  A declared
# schema spares the footer-reading job that schema inference runs for
# every read, and an incompatible column type fails the read.
EVENTS_INPUT_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"
)
DOCUMENTS_INPUT_SCHEMA = "text STRING"
