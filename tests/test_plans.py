"""Plan shape: one exchange per aggregation, no Python in the hot path."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from eventlake.operators.activity import repo_activity
from eventlake.operators.parse import parse_events
from eventlake.operators.quality import validate
from eventlake.sources.kafka import decode_records
from eventlake.plans import inputs
from eventlake.plans.catalog import QUERIES

from conftest import SF_SMALL

STREAMING = {"events_v1_stream", "repo_activity_5m_closed", "dedup_events_stream", "event_type_counts"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repo_activity_one_exchange(spark, tmp_uri):
    """On a table with enough splits: scan → parse → partial agg → one exchange."""
    inputs.records(spark, SF_SMALL).repartition(8).write.parquet(tmp_uri)
    events = validate(parse_events(decode_records(spark.read.parquet(tmp_uri))))
    plan = plan_of(repo_activity(events))
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert plan.count("from_json(") == 1, plan


def test_rows_are_spread_where_asked(spark):
    assert "Exchange RoundRobinPartitioning" in plan_of(inputs.records(spark, SF_SMALL, parallel=True))
    assert "Exchange" not in plan_of(inputs.records(spark, SF_SMALL))


def test_scan_prunes_columns(spark):
    plan = plan_of(repo_activity(inputs.validated(spark, SF_SMALL)))
    # value and props are never read.
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan, plan


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - STREAMING))
def test_no_python_udfs(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan, (name, plan)


def test_pairs_are_not_converted_one_by_one(spark):
    """The sessions' times are converted before the join, not for every pair."""
    plan = plan_of(entry.queries()["overlapping_sessions"](spark, SF_SMALL))
    assert "Join" in plan and "timestampadd" not in plan, plan


def test_closed_windows_reads_input_once(spark):
    from eventlake.operators.activity import closed_windows

    out = closed_windows(inputs.validated(spark, SF_SMALL))
    plan = plan_of(out)
    # the input was read by the eager checkpoint; the result reads only that
    assert "FileScan" not in plan and "from_json" not in plan, plan
    assert out.count() > 0


def test_stream_is_spread(spark):
    stream = inputs.record_stream(spark, SF_SMALL)
    assert stream.isStreaming
    assert "Repartition" in stream._jdf.queryExecution().logical().toString()
