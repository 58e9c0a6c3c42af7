"""Parse fixtures: every malformed shape, under ANSI on/off and two zones."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from eventlake.functions.timecols import instant_to_utc_ntz, parse_event_time, utc_ntz_to_instant
from eventlake.operators.parse import parse_events

GOOD = '{"id":"1","type":"PushEvent","actor":{"login":"a"},"repo":{"name":"o/r"},"created_at":"2024-01-01T00:00:00Z"}'

# (text, expected (event_id, event_type, actor_login, repo_name, created_at epoch seconds or None))
CASES = [
    (GOOD, ("1", "PushEvent", "a", "o/r", 1704067200)),
    ('{"id":1,"type":"PushEvent","created_at":"2024-01-01T00:00:00Z"}', ("1", "PushEvent", None, None, 1704067200)),
    ('{"id":{"x":1},"type":"T"}', ('{"x":1}', "T", None, None, None)),
    ('{"id":"","type":"T"}', ("", "T", None, None, None)),
    ("not json", (None, None, None, None, None)),
    ('{"id":"1","type":"T"', (None, None, None, None, None)),
    ('[{"id":"1"}]', (None, None, None, None, None)),
    ("", (None, None, None, None, None)),
    (None, (None, None, None, None, None)),
    ('{"id":"1","actor":"bob","repo":{"name":"o/r"}}', ("1", None, None, "o/r", None)),
    ('{"id":"1","extra":{"deep":[1,2]},"type":"T"}', ("1", "T", None, None, None)),
    ('{"id":"1","id":"2"}', ("2", None, None, None, None)),
    ('{"ID":"1"}', (None, None, None, None, None)),
    ('{"id":"1","created_at":"2024-01-01T00:00:00.123Z"}', ("1", None, None, None, None)),
    ('{"id":"1","created_at":"2024-01-01T09:00:00+09:00"}', ("1", None, None, None, None)),
    ('{"id":"1","created_at":"2024-01-01T00:00:00"}', ("1", None, None, None, None)),
    ('{"id":"1","created_at":"bad"}', ("1", None, None, None, None)),
    ('{"id":"1","created_at":""}', ("1", None, None, None, None)),
    ('{"id":"1","created_at":"2024-02-30T00:00:00Z"}', ("1", None, None, None, None)),
    ('{"id":"1","created_at":"2024-01-01T09:00:00+09"}', ("1", None, None, None, 1704067200)),
    ('{"id":"1","created_at":"2024-01-01T09:00:00+0900"}', ("1", None, None, None, 1704067200)),
    ('{"id":"1","created_at":"2024-01-01T00:00:00z"}', ("1", None, None, None, 1704067200)),
]

SCHEMA = StructType([StructField("raw_json", StringType()), StructField("kafka_ingest_ts", TimestampType())])


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_parse_table(spark, session_conf, ansi, zone):
    session_conf("spark.sql.ansi.enabled", ansi)
    session_conf("spark.sql.session.timeZone", zone)
    ingest = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(t, ingest) for t, _ in CASES], SCHEMA)
    out = parse_events(df).select(
        "event_id", "event_type", "actor_login", "repo_name", F.unix_timestamp("created_at").alias("t"), "raw_payload"
    )
    rows = out.collect()
    assert len(rows) == len(CASES)
    got = {r.raw_payload: (r.event_id, r.event_type, r.actor_login, r.repo_name, r.t) for r in rows}
    for text, expected in CASES:
        assert got[text] == expected, text


def test_parse_columns(spark):
    df = spark.createDataFrame([(GOOD, None)], SCHEMA)
    out = parse_events(df)
    assert out.columns == [
        "event_id", "event_type", "actor_login", "repo_name", "created_at", "raw_payload", "kafka_ingest_ts"
    ]
    assert dict(out.dtypes)["created_at"] == "timestamp"


def test_parse_once_in_plan(spark):
    """Validation filters must not repeat the JSON parse."""
    from eventlake.operators.quality import validate

    df = spark.createDataFrame([(GOOD, None)], SCHEMA)
    plan = validate(parse_events(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1, plan
    assert plan.count("try_to_timestamp") == 1, plan


def test_time_roundtrip_zone_free(spark, session_conf):
    for zone in ["UTC", "America/Los_Angeles", "Asia/Kolkata"]:
        session_conf("spark.sql.session.timeZone", zone)
        row = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.5' AS n").select(
            F.unix_micros(utc_ntz_to_instant("n")).alias("m"),
            instant_to_utc_ntz(utc_ntz_to_instant("n")).alias("back"),
            F.unix_timestamp(parse_event_time(F.lit("2024-01-01T00:00:00Z"))).alias("s"),
        ).first()
        assert row.m == 1704067207500000
        assert row.back == dt.datetime(2024, 1, 1, 0, 0, 7, 500000)
        assert row.s == 1704067200


def test_malformed_variants_transform_every_message(spark):
    from conftest import SF_SMALL

    from eventlake.plans import inputs

    v = inputs.malformed_variants(spark, SF_SMALL)
    orig = v.where(F.col("variant") == "original").select("kafka_ingest_ts", F.col("raw_json").alias("o"))
    joined = v.where(F.col("variant") != "original").join(orig, "kafka_ingest_ts")
    same = joined.where(F.col("raw_json") == F.col("o")).groupBy("variant").count().collect()
    assert same == [], same
    sample = {r.variant: r.raw_json for r in v.where(F.col("kafka_ingest_ts") == v.agg(F.min("kafka_ingest_ts")).first()[0]).collect()}
    assert sample["numeric_id"].startswith('{"id":0,') or sample["numeric_id"][7] != '"'
    assert '"actor":"user_' in sample["actor_text"]
    assert sample["offset"].endswith('+0900"}') and sample["fraction"].endswith('.5Z"}')
    assert sample["array"].startswith("[{") and not sample["truncated"].endswith("}")
