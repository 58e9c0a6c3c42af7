"""Property test: message building and parsing are inverse for any text."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventlake.operators.parse import parse_events
from eventlake.operators.publish import to_messages
from eventlake.sources.kafka import decode_records

# any text, incl. quotes, backslashes, control characters and non-BMP code points
text = st.text(st.characters(blacklist_categories=("Cs",)), max_size=12)
times = st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2100, 1, 1))
events = st.lists(st.tuples(text, text, text, text, times), min_size=1, max_size=20)

EVENT = StructType(
    [
        StructField("id", StringType()),
        StructField("type", StringType()),
        StructField("actor", StructType([StructField("login", StringType())])),
        StructField("repo", StructType([StructField("name", StringType())])),
        StructField("created_at", StringType()),
    ]
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(events)
def test_publish_then_parse_roundtrip(spark, rows):
    data = [
        ((i, t, (a,), (r,), c.strftime("%Y-%m-%dT%H:%M:%SZ")), n)
        for n, (i, t, a, r, c) in enumerate(rows)
    ]
    df = spark.createDataFrame(data, StructType([StructField("event", EVENT), StructField("n", LongType())]))
    msgs = to_messages(df).select(
        F.col("value").cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("n").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    parsed = parse_events(decode_records(msgs).withColumnRenamed("offset", "kafka_offset"), keep=["kafka_offset"])
    got = {r.kafka_offset: r for r in parsed.withColumn("epoch", F.unix_timestamp("created_at")).collect()}
    for n, (i, t, a, r, c) in enumerate(rows):
        p = got[n]
        assert (p.event_id, p.event_type, p.actor_login, p.repo_name) == (i, t, a, r)
        assert p.epoch == int(c.replace(tzinfo=dt.timezone.utc).timestamp())
