"""eventlake: event-stream analytics on Spark.

JSON event messages from a topic (or a file replay of one) are parsed into a
fixed schema, validated, optionally de-duplicated, and kept as two append-only
tables: all valid events, and per-repository activity in event-time windows.
Around that core: incremental-ingest operators, batch summaries, message
publishing and health checks. Every operator maps DataFrame to DataFrame with
built-in Spark expressions, so batch and streaming share the code.
"""

__version__ = "0.1.0"

from .config import StreamConfig, kafka_sink_options, kafka_source_options
from .operators.activity import closed_windows, event_type_counts, repo_activity
from .operators.health import (
    health_report,
    health_status,
    partition_offsets,
    stream_health,
    topic_health,
)
from .operators.ingest import (
    advance_cursor,
    changed_feeds,
    dedup_events,
    dedup_events_stream,
    feed_fingerprints,
    new_since_last_seen,
)
from .operators.parse import parse_events
from .operators.publish import to_messages, write_messages
from .operators.quality import drop_reasons, observe_quality, validate
from .sources.cursors import load_cursor, save_cursor
from .sources.files import read_record_files, read_table, write_table
from .sources.kafka import decode_records, read_kafka_stream
from .streaming.jobs import run_ingest, start_events_v1, start_repo_activity
from .streaming.progress import ProgressRecorder
from .streaming.sinks import data_then_cursor, run_all, start_append

__all__ = [
    "StreamConfig",
    "kafka_source_options",
    "kafka_sink_options",
    "read_kafka_stream",
    "decode_records",
    "read_record_files",
    "read_table",
    "write_table",
    "load_cursor",
    "save_cursor",
    "parse_events",
    "validate",
    "drop_reasons",
    "observe_quality",
    "repo_activity",
    "closed_windows",
    "event_type_counts",
    "new_since_last_seen",
    "advance_cursor",
    "feed_fingerprints",
    "changed_feeds",
    "dedup_events",
    "dedup_events_stream",
    "to_messages",
    "write_messages",
    "partition_offsets",
    "topic_health",
    "stream_health",
    "health_report",
    "health_status",
    "start_append",
    "run_all",
    "data_then_cursor",
    "start_events_v1",
    "start_repo_activity",
    "run_ingest",
    "ProgressRecorder",
]
