"""Structured Streaming: append sinks, running queries, progress, the ingest job."""

from .jobs import events_table_stream, file_source, kafka_source, run_ingest, start_events_v1, start_repo_activity
from .keyed import feed_events
from .progress import ProgressRecorder
from .sinks import data_then_cursor, run_all, start_append
from .state import stateful_settings, use_state_store
from .upserts import compact, read_upserted, start_upserts, upsert_batches

__all__ = [
    "start_append",
    "run_all",
    "data_then_cursor",
    "feed_events",
    "ProgressRecorder",
    "use_state_store",
    "stateful_settings",
    "kafka_source",
    "file_source",
    "events_table_stream",
    "start_events_v1",
    "start_repo_activity",
    "run_ingest",
    "start_upserts",
    "upsert_batches",
    "read_upserted",
    "compact",
]
