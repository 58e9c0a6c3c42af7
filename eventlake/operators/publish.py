"""Event → topic message (key = id, value = whole event as JSON) and the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import StreamConfig, kafka_sink_options


def to_messages(events: DataFrame, event_col: str = "event", id_field: str = "id") -> DataFrame:
    """Add ``key`` (event id text) and ``value`` (event as JSON text), drop
    the event struct, keep the other columns.

    ``to_json`` writes non-ASCII characters as they are, as the publisher does.
    """
    ev = F.col(event_col)
    return events.select(
        F.col(f"{event_col}.{id_field}").cast("string").alias("key"),
        F.to_json(ev).alias("value"),
        *[c for c in events.columns if c != event_col],
    )


def write_messages(messages: DataFrame, cfg: StreamConfig) -> None:
    """Publish ``key, value`` rows to the topic (batch).

    Producer settings: all replicas acknowledge, idempotent, 5 retries, 200 ms
    linger, gzip. A failed delivery fails the Spark task (and then the job),
    unlike a logging callback. Needs the Kafka connector on the classpath.
    """
    (
        messages.select(F.col("key").cast("binary"), F.col("value").cast("binary"))
        .write.format("kafka")
        .options(**kafka_sink_options(cfg))
        .save()
    )
