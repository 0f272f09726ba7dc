"""DataFrame -> DataFrame operators of the feed analytics."""

from .aggregates import (
    agency_counts,
    agency_leaders,
    agency_winners,
    batch_counts,
    finish_speed_stats,
    speed_parts,
    speed_stats,
    winners_of_counts,
)
from .latest import agency_winners_latest, latest_per_key, speed_stats_latest
from .parse import Parsed, parse_lines, parse_records, split_parsed
from .preview import batch_preview, first_lines
from .render import render_records
from .replay import BATCH_INTERVAL_S, PUBLISH_INTERVAL_S, ReplayClock, with_batches
from .wordcount import word_count, word_count_lines, words, write_word_counts

__all__ = [
    "BATCH_INTERVAL_S",
    "PUBLISH_INTERVAL_S",
    "Parsed",
    "ReplayClock",
    "agency_counts",
    "agency_leaders",
    "agency_winners",
    "agency_winners_latest",
    "batch_counts",
    "batch_preview",
    "finish_speed_stats",
    "first_lines",
    "latest_per_key",
    "parse_lines",
    "parse_records",
    "render_records",
    "speed_parts",
    "speed_stats",
    "speed_stats_latest",
    "split_parsed",
    "winners_of_counts",
    "with_batches",
    "word_count",
    "word_count_lines",
    "words",
    "write_word_counts",
]
