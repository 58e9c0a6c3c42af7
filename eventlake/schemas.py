"""Schemas and fixed values of the event model.

Everything here is data, not logic: the shape of a topic message, of the parsed
event, of the two output tables, and the constants that are part of the
behaviour (allowed types, window size, watermark delay).
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values (must equal the reference's for the same results) -----------
# Event types kept by validation, in the reference's order.
DEFAULT_ALLOWED_TYPES = ("PushEvent", "PullRequestEvent", "PullRequestReviewEvent", "IssuesEvent")
# Tumbling window size and event-time watermark delay of the activity table.
WINDOW_SIZE = "5 minutes"
WATERMARK_DELAY = "10 minutes"
# Event-time text format: ISO-8601 seconds with a zone designator ("...Z").
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"
# Source back-pressure: offsets per micro-batch.
MAX_OFFSETS_PER_TRIGGER = 50000
# -----------------------------------------------------------------------------

# JSON message body (fixed field names: the wire format), parsed permissively;
# unknown fields are ignored by the parse and survive in ``raw_payload``.
ENVELOPE_SCHEMA = StructType(
    [
        StructField("id", StringType(), True),
        StructField("type", StringType(), True),
        StructField("actor", StructType([StructField("login", StringType(), True)]), True),
        StructField("repo", StructType([StructField("name", StringType(), True)]), True),
        StructField("created_at", StringType(), True),
    ]
)

# A record as a topic source delivers it (the columns we use).
TOPIC_RECORD_SCHEMA = StructType(
    [
        StructField("key", BinaryType(), True),
        StructField("value", BinaryType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("timestamp", TimestampType(), True),
    ]
)

# After ``decode_records``.
DECODED_SCHEMA = StructType(
    [
        StructField("raw_json", StringType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("offset", LongType(), True),
        StructField("kafka_ingest_ts", TimestampType(), True),
    ]
)

# ``events_v1``: parsed and validated events.
EVENT_SCHEMA = StructType(
    [
        StructField("event_id", StringType(), True),
        StructField("event_type", StringType(), True),
        StructField("actor_login", StringType(), True),
        StructField("repo_name", StringType(), True),
        StructField("created_at", TimestampType(), True),
        StructField("raw_payload", StringType(), True),
        StructField("kafka_ingest_ts", TimestampType(), True),
    ]
)

# ``repo_activity_5m``.
ACTIVITY_SCHEMA = StructType(
    [
        StructField("window_start", TimestampType(), True),
        StructField("window_end", TimestampType(), True),
        StructField("repo_name", StringType(), True),
        StructField("event_count", LongType(), False),
        StructField("event_types", ArrayType(StringType(), False), False),
    ]
)

# Poller cursor, one row per feed.
CURSOR_SCHEMA = StructType(
    [
        StructField("feed", StringType(), True),
        StructField("etag", StringType(), True),
        StructField("last_event_id", StringType(), True),
    ]
)

# Stream progress rows recorded by ``streaming.progress.ProgressRecorder``.
PROGRESS_SCHEMA = StructType(
    [
        StructField("query", StringType(), True),
        StructField("ts", TimestampType(), True),
        StructField("state", StringType(), True),
        StructField("input_rows", LongType(), True),
        # rows the stateful operators dropped as late (counted after partial
        # aggregation, so a lower bound on late input rows)
        StructField("late_rows", LongType(), True),
    ]
)

# Source offsets of each micro-batch recorded by ``streaming.progress``.
OFFSETS_SCHEMA = StructType(
    [
        StructField("query", StringType(), True),
        StructField("ts", TimestampType(), True),
        StructField("topic", StringType(), True),
        StructField("partition", IntegerType(), True),
        StructField("low", LongType(), True),
        StructField("high", LongType(), True),
    ]
)

# Observed per-batch counters recorded by ``streaming.progress.ProgressRecorder``.
METRICS_SCHEMA = StructType(
    [
        StructField("query", StringType(), True),
        StructField("batch_id", LongType(), True),
        StructField("metric_set", StringType(), True),
        StructField("metric", StringType(), True),
        StructField("value", LongType(), True),
    ]
)
