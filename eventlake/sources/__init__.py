"""Sources: topic streams, file replays of topic records, stored tables, cursors."""

from .kafka import decode_records, read_kafka_stream
from .files import read_record_files, read_table, write_table
from .cursors import committed_versions, load_cursor, save_cursor
from .envelope import api_events, topic_records

__all__ = [
    "decode_records",
    "read_kafka_stream",
    "read_record_files",
    "read_table",
    "write_table",
    "committed_versions",
    "load_cursor",
    "save_cursor",
    "api_events",
    "topic_records",
]
