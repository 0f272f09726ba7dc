"""Batch sources: feed files, the events stand-in feed, text."""

from .feed import events_feed, read_events, read_events_feed
from .lines import first_file_lines, first_lines_of, read_lines
from .spread import spread_narrow
from .text import read_documents, read_text_files

__all__ = [
    "events_feed",
    "first_file_lines",
    "first_lines_of",
    "read_documents",
    "read_events",
    "read_events_feed",
    "read_lines",
    "read_text_files",
    "spread_narrow",
]
