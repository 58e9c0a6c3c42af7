"""Streams with state of their own: sessions, joins of two streams, and the
per-feed cursor with its idle alarm; over restarts, with late rows, and what
stays in the state."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from eventlake.operators.sessions import click_purchases, user_sessions
from eventlake.streaming import keyed
from eventlake.streaming.sinks import run_all, start_append
from eventlake.streaming.state import stateful_settings

SCHEMA = "event_id long, event_type string, actor_login string, created_at timestamp"
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


class Polls:
    """Files written one poll after the other and drained by one checkpoint."""

    def __init__(self, spark, folder):
        self.spark, self.base = spark, folder

    def put(self, rows):
        self.spark.createDataFrame([(i, kind, user, at(m)) for i, kind, user, m in rows], SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).parquet(f"{self.base}/in")

    def drain(self, out):
        with stateful_settings(self.spark, "rocksdb", 2):
            q = start_append(out, f"{self.base}/out", f"{self.base}/ck")
        run_all([q])
        return self.spark.read.parquet(f"{self.base}/out")

    def state(self, var):
        return self.spark.read.format("statestore").option("stateVarName", var).load(f"{self.base}/ck").count()


def session_rows(df):
    return sorted((r.actor_login or "", r.a, r.b, r.event_count, r.purchases) for r in df.selectExpr("*", "(unix_seconds(session_start) - 1704067200) div 60 AS a", "(unix_seconds(session_end) - 1704067200) div 60 AS b").collect())


def test_sessions_over_restarts_with_late_rows(spark, tmp_uri):
    polls = Polls(spark, tmp_uri)
    run = lambda: session_rows(polls.drain(user_sessions(polls.stream())))
    polls.put([(1, "click", "a", 0), (2, "purchase", "a", 30), (3, "click", "b", 0), (4, "click", None, 5), (5, "view", "b", 65)])
    # mark 55: only the NULL user's session (5 to 35) and b's first have ended
    assert run() == [("", 5, 35, 1, 0), ("b", 0, 30, 1, 0)]
    # out of order: 50 joins a's open session; 20 for b is late (it would end at 50)
    polls.put([(6, "click", "a", 50), (7, "purchase", "b", 20), (8, "view", "b", 90), (9, "click", "c", 200)])
    assert run() == [("", 5, 35, 1, 0), ("a", 0, 80, 3, 1), ("b", 0, 30, 1, 0), ("b", 65, 120, 2, 0)]
    # a row between two open sessions bridges them
    polls.put([(10, "click", "d", 300), (11, "click", "d", 350)])
    polls.put([(12, "click", "d", 325)])
    polls.put([(13, "click", "e", 900)])
    assert ("d", 300, 380, 3, 0) in run()


def test_streams_join_within_the_range(spark, tmp_uri):
    polls = Polls(spark, tmp_uri)

    def run():
        kind = lambda k: polls.stream().where(F.col("event_type") == k)
        return sorted((r.click_id, r.purchase_id) for r in polls.drain(click_purchases(kind("click"), kind("purchase"))).fillna(-1).collect())

    polls.put([(1, "click", "a", 0), (2, "click", "b", 0), (3, "purchase", "a", 5)])
    assert run() == [(1, 3)]
    # a restart joins with clicks kept in state; 31 minutes are too many
    polls.put([(4, "purchase", "a", 30), (5, "purchase", "b", 31), (6, "click", "c", 40)])
    assert run() == [(1, 3), (1, 4)]
    # b's click is alone for good when the mark of both sides has passed minute 30
    polls.put([(7, "click", "z", 200), (8, "purchase", "z", 210)])
    assert run() == [(1, 3), (1, 4), (2, -1), (6, -1), (7, 8)]
    # too late for a click that has left the state, and for the mark
    polls.put([(9, "purchase", "b", 1)])
    assert run() == [(1, 3), (1, 4), (2, -1), (6, -1), (7, 8)]


def events(stream):
    return stream.select(F.col("actor_login").alias("feed"), F.col("event_id").alias("id"), "created_at")


def feed_rows(df):
    return [(r.feed, r.kind, r.last_event_id, r.rows, r.m) for r in df.selectExpr("*", "(unix_seconds(at) - 1704067200) div 60 AS m").orderBy("m", "feed", "kind").collect()]


def test_cursor_alarm_and_expiry(spark, tmp_uri):
    polls = Polls(spark, tmp_uri)
    run = lambda: polls.drain(keyed.feed_events(events(polls.stream()), idle_minutes=60))
    polls.put([(5, "x", "a", 0), (7, "x", "a", 10), (6, "x", "a", 20), (1, "x", "b", 0), (2, "x", None, 0)])
    assert feed_rows(run()) == [("b", "cursor", "1", 1, 0), ("a", "cursor", "7", 3, 20)]
    assert polls.state("feed") == 2
    # a restart: 7 and 6 are not ahead of a's cursor, 8 is; the mark stays behind b's alarm
    polls.put([(7, "x", "a", 60), (6, "x", "a", 61), (8, "x", "a", 62)])
    assert feed_rows(run())[2:] == [("a", "cursor", "8", 1, 62)]
    # c moves the mark past b's time (60) and a's (122): both are idle and leave the state
    polls.put([(9, "x", "c", 300)])
    got = feed_rows(run())
    assert ("b", "idle", "1", 0, 60) in got and ("a", "idle", "8", 0, 122) in got and ("c", "cursor", "9", 1, 300) in got
    assert polls.state("feed") == 1
    # known again after expiry: a new cursor, lower ids count; the gap inside one batch is one alarm
    polls.put([(3, "x", "a", 310), (4, "x", "a", 400), (5, "x", "d", 295)])
    got = [r for r in feed_rows(run()) if r[4] > 300 or r[0] == "d"]
    assert ("a", "idle", None, 0, 370) in got and ("a", "cursor", "4", 2, 400) in got and ("d", "cursor", "5", 1, 295) in got
    # late for everybody: dropped
    before = len(feed_rows(run()))
    polls.put([(99, "x", "late", 1)])
    assert len(feed_rows(run())) == before


def test_gaps_equal_definition(spark, tmp_uri):
    """Random feeds over several polls in time order: one alarm for every gap."""
    rng = random.Random(7)
    rows = sorted(((rng.choice("abcd"), rng.randrange(0, 5000)) for _ in range(120)), key=lambda r: r[1])
    polls = Polls(spark, tmp_uri)
    for k in range(4):
        polls.put([(i, "x", f, m) for i, (f, m) in enumerate(rows) if i * 4 // len(rows) == k])
        out = polls.drain(keyed.feed_events(events(polls.stream()), idle_minutes=120))
    mark = rows[-1][1] - 10
    want = []
    for f in "abcd":
        times = [m for g, m in rows if g == f]
        want += [(f, a + 120) for a, b in zip(times, times[1:]) if b - a > 120]
        want += [(f, times[-1] + 120)] if times[-1] + 120 <= mark else []
    got = feed_rows(out)
    assert sorted((r[0], r[4]) for r in got if r[1] == "idle") == sorted(want)
    alive = {f for f in "abcd" if max(m for g, m in rows if g == f) + 120 > mark}
    assert polls.state("feed") == len(alive)


@pytest.mark.parametrize("idle", [0, 3, 100])
def test_merged_spans_do_not_depend_on_order(idle):
    rng = random.Random(idle)
    spans = [[a, a + rng.randrange(5)] for a in (rng.randrange(200) for _ in range(40))]
    want = keyed.merge_spans([list(s) for s in spans], idle)
    parts = keyed.merge_spans(keyed.merge_spans([list(s) for s in spans[:15]], idle) + [list(s) for s in spans[15:]], idle)
    assert parts == want
    assert all(b[0] - a[1] > idle for a, b in zip(want, want[1:]))


def test_a_feed_costs_few_calls_of_its_state():
    """A call of the state per feed and batch is what a stream of many feeds
    pays for: one read, no write of what has not changed, rows as they are."""
    calls = []

    class Handle:
        held = None

        def getValueState(self, *_):
            return self

        def __getattr__(self, name):
            def call(*args):
                calls.append((name, *args))
                if name == "update":
                    self.held = args[0]
                return self.held if name == "get" else None

            return call

    state = keyed.FeedState(60_000_000)
    state.init(Handle())

    def batch(ids, *spans):
        calls.clear()
        row = {"feed": "a", "ids": ids, "spans": [{"first": a * 10**6, "last": b * 10**6} for a, b in spans]}
        out = [(r.feed, r.kind, r.last_event_id, r.rows, r.at.timestamp()) for r in state.handleInputRows(("a",), iter([row]), None)]
        return out, list(calls)

    seconds = lambda s: s * 10**6
    assert batch([2, 1], (0, 5)) == ([("a", "cursor", "2", 2, 5.0)], [("get",), ("registerTimer", 65_000), ("update", (2, seconds(5)))])
    assert batch([1], (3, 5)) == ([], [("get",)])
    got, made = batch([4], (100, 100))
    assert got == [("a", "idle", None, 0, 65.0), ("a", "cursor", "4", 1, 100.0)]
    assert made == [("get",), ("deleteTimer", 65_000), ("registerTimer", 160_000), ("update", (4, seconds(100)))]
    calls.clear()
    (alarm,) = state.handleExpiredTimer(("a",), None, None)
    assert (alarm.kind, alarm.last_event_id, alarm.at.timestamp()) == ("idle", "4", 160.0) and calls == [("get",), ("clear",)]


def test_idle_time_is_checked(spark):
    with pytest.raises(ValueError):
        keyed.feed_events(spark.createDataFrame([], "feed string, id long, created_at timestamp"), idle_minutes=0)
