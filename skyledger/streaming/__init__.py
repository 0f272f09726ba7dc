"""Structured Streaming: sources, the foreachBatch consumer, sinks, replay."""

from .consumer import FeedBatchWriter, start_consumer, start_preview
from .replay import (
    deliver_to_folder,
    deliver_to_topic,
    publish_stream_to_topic,
    publish_to_topic,
    run_paced_replay,
    stage_lines,
    start_paced_replay,
    write_feed_files,
)
from .sink import (
    CommitFacts,
    ResultTables,
    closed_upto,
    ensure_tables,
    fold_history,
    latest_views,
    read_history,
    read_parts,
    snapshot_current,
    write_histories,
)
from .source import (
    FEED_TOPIC,
    file_lines_stream,
    kafka_lines_stream,
    message_lines,
    place_lines,
    split_counts,
    split_lines_stream,
    staged_lines_stream,
    with_row_ids,
)

__all__ = [
    "CommitFacts",
    "FEED_TOPIC",
    "FeedBatchWriter",
    "ResultTables",
    "closed_upto",
    "deliver_to_folder",
    "deliver_to_topic",
    "ensure_tables",
    "file_lines_stream",
    "fold_history",
    "kafka_lines_stream",
    "latest_views",
    "message_lines",
    "place_lines",
    "publish_stream_to_topic",
    "publish_to_topic",
    "read_history",
    "read_parts",
    "run_paced_replay",
    "snapshot_current",
    "split_counts",
    "split_lines_stream",
    "stage_lines",
    "staged_lines_stream",
    "start_consumer",
    "start_paced_replay",
    "start_preview",
    "with_row_ids",
    "write_feed_files",
    "write_histories",
]
