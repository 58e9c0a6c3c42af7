"""Adapter from the ``events`` test table to the public-event message form.

``events(event_id, ts, user_id, event_type, value, props)`` becomes an API
event ``{id, type, actor{login}, repo{name}, created_at}`` and then a topic
record. Zone-free: ``ts`` is read as UTC wall clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import utc_ntz_to_instant, utc_text

# --- fixed values of the adapter ----------------------------------------------
TOPIC = "events.raw"
TOPIC_PARTITIONS = 3
REPOS = 20
# -----------------------------------------------------------------------------


def api_events(events: DataFrame) -> DataFrame:
    """One struct column ``event`` per row, shaped like a public API event,
    plus ``user_id``, ``event_id`` and ``ts`` for keys and ordering."""
    event = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.struct(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("login")).alias("actor"),
        F.struct(F.concat(F.lit("org/repo_"), (F.col("user_id") % REPOS).cast("string")).alias("name")).alias("repo"),
        utc_text("ts").alias("created_at"),
    )
    return events.select(event.alias("event"), "user_id", "event_id", "ts")


def topic_records(events: DataFrame) -> DataFrame:
    """Topic records as a producer would publish them: key = id bytes, value =
    whole event as UTF-8 JSON, partition by user, offset = event id, broker
    time = event time."""
    from ..operators.publish import to_messages

    msgs = to_messages(api_events(events), event_col="event")
    return msgs.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        utc_ntz_to_instant("ts").alias("timestamp"),
    )
