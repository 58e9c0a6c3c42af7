from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eventlake.operators.health import health_report, stream_health, topic_health
from eventlake.schemas import PROGRESS_SCHEMA

OFFSETS = "topic string, partition int, low long, high long"


def test_topic_offsets(spark):
    offs = spark.createDataFrame([("t", 0, 0, 10), ("t", 1, 5, 5), ("t", 2, 9, 3)], OFFSETS)
    r = topic_health(offs).first()
    assert (r.topic, r.partitions, r.messages) == ("t", 3, 10)


def report(spark, offs_rows, progress_rows=None, topic="t"):
    topics = topic_health(spark.createDataFrame(offs_rows, OFFSETS))
    streams = None
    if progress_rows is not None:
        streams = stream_health(spark.createDataFrame(progress_rows, PROGRESS_SCHEMA), now=F.lit(T(3)))
    return {r.check: (r.observed, r.ok) for r in health_report(topics, topic, streams).collect()}


def test_all_empty_topic_fails(spark):
    got = report(spark, [("t", 0, 4, 4), ("t", 1, 0, 0)])
    assert got == {"topic_exists": ("2", True), "topic_has_messages": ("0", False)}


def test_missing_topic_fails(spark):
    got = report(spark, [("other", 0, 0, 10)])
    assert got == {"topic_exists": ("0", False), "topic_has_messages": ("0", False)}


T = lambda m: dt.datetime(2024, 1, 1, 0, m, tzinfo=dt.timezone.utc)


def test_stream_states(spark):
    ok_rows = [("q", T(0), "PENDING", 0, 0), ("q", T(1), "RUNNING", 5, 0)]
    assert report(spark, [("t", 0, 0, 1)], ok_rows)["stream_running"] == ("RUNNING", True)
    pending = [("q", T(0), "PENDING", 0, 0)]
    assert report(spark, [("t", 0, 0, 1)], pending)["stream_running"] == ("PENDING", True)
    dead = [("q", T(0), "RUNNING", 5, 0), ("q", T(2), "FAILED", 0, 0)]
    assert report(spark, [("t", 0, 0, 1)], dead)["stream_running"] == ("q=FAILED", False)
    # one failed query fails the check, whichever reported last
    two = [("a", T(2), "RUNNING", 5, 0), ("b", T(0), "FAILED", 0, 0)]
    assert report(spark, [("t", 0, 0, 1)], two)["stream_running"] == ("b=FAILED", False)
    drained = [("q", T(0), "RUNNING", 5, 0), ("q", T(2), "TERMINATED", 0, 0)]
    assert report(spark, [("t", 0, 0, 1)], drained)["stream_running"] == ("TERMINATED", True)
    at_once = [("q", T(2), "FAILED", 0, 0), ("q", T(2), "RUNNING", 5, 0)]
    assert report(spark, [("t", 0, 0, 1)], at_once)["stream_running"] == ("q=FAILED", False)
    assert report(spark, [("t", 0, 0, 1)], [])["stream_running"] == ("NONE", False)


def test_stale_stream_not_live(spark):
    rows = [("q", T(0), "RUNNING", 5, 0)]
    df = spark.createDataFrame(rows, PROGRESS_SCHEMA)
    assert stream_health(df, now=F.lit(T(20))).first().ok
    assert not stream_health(df, now=F.lit(T(31))).first().ok
    assert not stream_health(df).first().ok


def test_health_status(spark):
    import pytest

    from eventlake.operators.health import health_status

    topics = topic_health(spark.createDataFrame([("t", 0, 0, 3)], OFFSETS))
    line = health_status(health_report(topics, "t"), now="2024-01-01T00:00:00Z")
    assert line == "OK at 2024-01-01T00:00:00Z: topic_exists=1, topic_has_messages=3"
    empty = topic_health(spark.createDataFrame([("t", 0, 3, 3)], OFFSETS))
    with pytest.raises(RuntimeError, match="topic_has_messages"):
        health_status(health_report(empty, "t"))
