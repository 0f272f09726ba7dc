"""DuckDB SQL equal in result to each registered query.

The SQL works on the ``events`` table directly and never renders or parses
a feed line: an accepted record is an event whose id is not a multiple of
97 (empty speed) or 101 (empty agency), and its fields are the column
arithmetic the feed rendering uses.  So a parsing bug on the Spark side
shows up as a mismatch.
"""

from __future__ import annotations

from ..operators.replay import BATCH_INTERVAL_S, PUBLISH_INTERVAL_S
from ..sources.feed import EMPTY_AGENCY_EVERY, EMPTY_SPEED_EVERY
from ..streaming.replay import BLOCK_LINES
from .queries import (
    AGENCY,
    FIRST_LINES_N,
    FLIGHT,
    PACED_LINES,
    PREVIEW_BATCH_S,
    PREVIEW_N,
    TOPIC_PARTITIONS,
)

_BATCH = f"(event_id * {PUBLISH_INTERVAL_S}) // {BATCH_INTERVAL_S}"
_GOOD = f"event_id % {EMPTY_SPEED_EVERY} <> 0 AND event_id % {EMPTY_AGENCY_EVERY} <> 0"


def _records() -> str:
    return f"""
rec AS (
  SELECT
    event_id AS line_no,
    {_BATCH} AS batch_no,
    'A' || CAST(user_id AS VARCHAR) AS adshex,
    'F' || CAST(user_id % 10 AS VARCHAR) AS flight_id,
    CAST(event_id % 90 + 0.5 AS REAL) AS latitude,
    CAST(-(event_id % 180) - 0.25 AS REAL) AS longitude,
    CAST(event_id % 40000 AS INTEGER) AS altitude,
    CAST(floor(value) AS INTEGER) AS speed,
    CAST(event_id % 360 AS INTEGER) AS track,
    CAST(event_id % 7777 AS INTEGER) AS squawk,
    'B' AS "type",
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
    'NAME' AS "name",
    '' AS other_names1,
    '' AS other_names2,
    'N' || CAST(user_id AS VARCHAR) AS n_number,
    'SER' AS serial_number,
    CAST(2072738 AS INTEGER) AS mfr_mdl_code,
    'CESSNA' AS mfr,
    '182T' AS model,
    CAST(2006 AS INTEGER) AS year_mfr,
    CAST(4 AS INTEGER) AS type_aircraft,
    event_type AS agency
  FROM events
  WHERE {_GOOD}
)"""


_RECORDS = _records()

# Field names and the format of a record's text.
_FIELDS = (
    'adshex, flight_id, latitude, longitude, altitude, speed, track, squawk, "type", '
    '"timestamp", "name", other_names1, other_names2, n_number, serial_number, '
    "mfr_mdl_code, mfr, model, year_mfr, type_aircraft, agency"
)

_LINE = f"""concat_ws(';',
    'A' || CAST(user_id AS VARCHAR),
    'F' || CAST(user_id % 10 AS VARCHAR),
    CAST(event_id % 90 AS VARCHAR) || '.5',
    '-' || CAST(event_id % 180 AS VARCHAR) || '.25',
    CAST(event_id % 40000 AS VARCHAR),
    CASE WHEN event_id % {EMPTY_SPEED_EVERY} = 0 THEN ''
         ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END,
    CAST(event_id % 360 AS VARCHAR),
    lpad(CAST(event_id % 7777 AS VARCHAR), 4, '0'),
    'B',
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ'),
    'NAME', '', '',
    'N' || CAST(user_id AS VARCHAR),
    'SER', '2072738', 'CESSNA', '182T', '2006', '4',
    CASE WHEN event_id % {EMPTY_AGENCY_EVERY} = 0 THEN '' ELSE event_type END)"""

_COUNTS = "cnt AS (SELECT batch_no, agency, count(*) AS n FROM rec GROUP BY batch_no, agency)"

_WINNERS = f"""
{_COUNTS},
top AS (SELECT batch_no, max(n) AS mx FROM cnt GROUP BY batch_no),
win AS (
  SELECT cnt.batch_no,
         '[' || string_agg(cnt.agency, ', ' ORDER BY cnt.agency) || ']' AS agency_most_flight_segs,
         max(cnt.n) AS num_of_flight_segs
  FROM cnt JOIN top ON cnt.batch_no = top.batch_no AND cnt.n = top.mx
  GROUP BY cnt.batch_no
)"""


def _speed(extra_filter: str = "") -> str:
    return f"""
spd AS (
  SELECT batch_no,
         '{FLIGHT}' AS flight_segment,
         max(speed) AS max_speed,
         min(speed) AS min_speed,
         avg(speed) AS avg_speed,
         count(*) AS num_of_flight_segments
  FROM rec
  WHERE agency = '{AGENCY}' {extra_filter}
  GROUP BY batch_no
)"""


_RENDER_FORMAT = "%s,%s,%e,%e,%d,%d,%d,%d,%s,%s,%s,%s,%s,%s,%s,%d,%s,%s,%d,%d,%s"

_PREVIEW = f"""
SELECT batch_no, line_no, line FROM (
  SELECT (event_id * {PUBLISH_INTERVAL_S}) // {PREVIEW_BATCH_S} AS batch_no,
         event_id AS line_no, {_LINE} AS line,
         row_number() OVER (PARTITION BY (event_id * {PUBLISH_INTERVAL_S}) // {PREVIEW_BATCH_S}
                            ORDER BY event_id) AS rn
  FROM events) t
WHERE rn <= {PREVIEW_N}"""

_WINNERS_LATEST = f"""WITH {_RECORDS}, {_WINNERS}
SELECT agency_most_flight_segs, arg_max(num_of_flight_segs, batch_no) AS num_of_flight_segs
FROM win GROUP BY agency_most_flight_segs"""

ORACLE_SQL: dict[str, str] = {
    "replay_lines": f"""
SELECT event_id AS line_no,
       event_id * {PUBLISH_INTERVAL_S} AS arrival_s,
       {_BATCH} AS batch_no,
       {_LINE} AS line
FROM events""",
    "file_lines": f"""
SELECT event_id AS line_no, {_BATCH} AS batch_no, {_LINE} AS line
FROM events""",
    "first_lines": f"""
SELECT event_id AS line_no, {_LINE} AS line
FROM events ORDER BY event_id LIMIT {FIRST_LINES_N}""",
    "batch_preview": _PREVIEW,
    "parse_records": f"WITH {_RECORDS}\nSELECT line_no, {_FIELDS} FROM rec",
    "rejects": f"""
SELECT event_id AS line_no, {_LINE} AS line,
       CASE WHEN event_id % {EMPTY_AGENCY_EVERY} = 0 THEN 'arity' ELSE 'number' END AS reason
FROM events
WHERE NOT ({_GOOD})""",
    "render_records": f"""WITH {_RECORDS}
SELECT line_no, printf('{_RENDER_FORMAT}', {_FIELDS}) AS text FROM rec""",
    "event_times": f"""
SELECT event_id AS line_no, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s FROM events WHERE {_GOOD}""",
    "message_lines": f"""
SELECT {_LINE} AS line, CAST(event_id % {TOPIC_PARTITIONS} AS INTEGER) AS partition, event_id AS line_no
FROM events""",
    "batch_counts": f"WITH {_RECORDS}\nSELECT batch_no, count(*) AS n FROM rec GROUP BY batch_no",
    "agency_counts": f"WITH {_RECORDS}, {_COUNTS}\nSELECT batch_no, agency, n FROM cnt",
    "agency_winners": f"WITH {_RECORDS}, {_WINNERS}\nSELECT * FROM win",
    "agency_winners_latest": _WINNERS_LATEST,
    "speed_stats_agency": f"WITH {_RECORDS}, {_speed()}\nSELECT * FROM spd",
    "speed_stats_agency_flight": f"""WITH {_RECORDS}, {_speed(f"AND flight_id = '{FLIGHT}'")}
SELECT * FROM spd""",
    "speed_stats_latest": f"""WITH {_RECORDS}, {_speed()}
SELECT flight_segment,
       arg_max(max_speed, batch_no) AS max_speed,
       arg_max(min_speed, batch_no) AS min_speed,
       arg_max(avg_speed, batch_no) AS avg_speed,
       arg_max(num_of_flight_segments, batch_no) AS num_of_flight_segments
FROM spd GROUP BY flight_segment""",
    "stream_agency_winners": f"WITH {_RECORDS}, {_WINNERS}\nSELECT * FROM win",
    "stream_agency_counts": f"WITH {_RECORDS}, {_COUNTS}\nSELECT batch_no, agency, n FROM cnt",
    "stream_speed_stats": f"WITH {_RECORDS}, {_speed()}\nSELECT * FROM spd",
    "stream_rejects": f"""
SELECT {_BATCH} AS batch_no, event_id AS line_no, {_LINE} AS line,
       CASE WHEN event_id % {EMPTY_AGENCY_EVERY} = 0 THEN 'arity' ELSE 'number' END AS reason
FROM events
WHERE NOT ({_GOOD})""",
    "first_file_lines": f"""
SELECT event_id AS line_no, {_LINE} AS line
FROM events ORDER BY event_id LIMIT {FIRST_LINES_N}""",
    "stream_batch_preview": _PREVIEW,
    "stream_closed_winners": f"""WITH {_RECORDS}, {_WINNERS}
SELECT * FROM win
WHERE batch_no < (SELECT (max(event_id) + 1) * {PUBLISH_INTERVAL_S} // {BATCH_INTERVAL_S} FROM events)""",
    "stream_file_lines": f"""
SELECT event_id // {BLOCK_LINES} AS file_no, event_id % {BLOCK_LINES} AS file_line_no, {_LINE} AS line
FROM events""",
    "latest_from_snapshot": _WINNERS_LATEST,
    "folded_speed_stats": f"WITH {_RECORDS}, {_speed()}\nSELECT * FROM spd",
    "catalog_winners": f"WITH {_RECORDS}, {_WINNERS}\nSELECT * FROM win",
    "paced_replay_lines": f"""
SELECT event_id // {PACED_LINES} AS step, event_id AS line_no, {_LINE} AS line FROM events""",
    "word_count_lines": r"""
SELECT word || chr(9) || CAST(count(*) AS VARCHAR) AS line FROM (
  SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents) t
WHERE word <> ''
GROUP BY word
ORDER BY word""",
    "word_count": r"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM documents) t
WHERE word <> ''
GROUP BY word""",
}
