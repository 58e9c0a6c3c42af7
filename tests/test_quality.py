from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from eventlake.operators.quality import drop_reasons, observe_quality, validate

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = StructType(
    [StructField(c, StringType()) for c in ("event_id", "event_type", "actor_login", "repo_name")]
    + [StructField("created_at", TimestampType())]
)
ROWS = [
    ("1", "PushEvent", "a", "r", T0),          # kept
    ("2", None, "a", "r", T0),                 # NULL type: dropped
    ("3", "ForkEvent", "a", "r", T0),          # outside the list: dropped
    ("4", "IssuesEvent", "a", None, T0),       # NULL repo: kept
    ("5", "PullRequestEvent", None, "r", T0),  # NULL actor: kept
    (None, "PushEvent", "a", "r", T0),         # no id: dropped
    ("7", "PushEvent", "a", "r", None),        # no time: dropped
    ("", "PullRequestReviewEvent", "a", "r", T0),  # empty id passes
]


def test_validate(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = sorted(r.event_id for r in validate(df).collect())
    assert kept == ["", "1", "4", "5"]


def test_validate_custom_list(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = sorted(r.event_id for r in validate(df, ["ForkEvent"]).collect())
    assert kept == ["3"]


def test_drop_reasons(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r.reason: r.rows for r in drop_reasons(df).collect()}
    assert got == {"kept": 4, "type_not_allowed": 2, "missing_event_id": 1, "bad_created_at": 1}


def test_observe_quality_batch(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    obs = Observation("q")
    out = observe_quality(df, obs)
    assert out.count() == len(ROWS)
    assert obs.get == {
        "input_rows": 8, "missing_event_id": 1, "bad_created_at": 1, "type_not_allowed": 2,
    }


def test_pushdown_on_stored_table(spark, tmp_uri):
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.write.parquet(tmp_uri)
    plan = validate(spark.read.parquet(tmp_uri))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_id), IsNotNull(created_at), In(event_type" in plan, plan
