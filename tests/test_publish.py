from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from eventlake.config import StreamConfig
from eventlake.operators.parse import parse_events
from eventlake.operators.publish import to_messages, write_messages
from eventlake.sources.kafka import decode_records, read_kafka_stream


def events(spark):
    return spark.sql(
        """SELECT named_struct('id', '7', 'type', 'PushEvent', 'actor', named_struct('login', 'bé'),
                               'repo', named_struct('name', '한글/리포'), 'created_at', '2024-01-01T00:00:00Z') AS event,
                  1 AS other"""
    )


def test_message_shape_and_non_ascii(spark):
    msgs = to_messages(events(spark))
    assert msgs.columns == ["key", "value", "other"]
    r = msgs.first()
    assert r.key == "7"
    assert "한글/리포" in r.value and "\\u" not in r.value
    assert json.loads(r.value)["actor"]["login"] == "bé"


def test_message_roundtrip_through_parse(spark):
    msgs = to_messages(events(spark)).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    r = parse_events(decode_records(msgs)).first()
    assert (r.event_id, r.repo_name, r.actor_login) == ("7", "한글/리포", "bé")


def test_kafka_connector_absent_fails_loudly(spark):
    """No Kafka jar on this image: both ends fail with a clear error, never silently."""
    cfg = StreamConfig(bootstrap_servers="localhost:1", topic="t")
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_stream(spark, cfg)
    msgs = to_messages(events(spark)).select("key", "value")
    with pytest.raises(Exception, match="(?i)kafka"):
        write_messages(msgs, cfg)
