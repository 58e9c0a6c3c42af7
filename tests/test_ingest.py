"""Incremental ingest: the reference's cursor cases as tables, plus more."""

from __future__ import annotations

import os
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from eventlake.operators.ingest import (
    advance_cursor,
    ahead_of_cursor,
    changed_feeds,
    dedup_events,
    feed_fingerprints,
    new_since_last_seen,
)
from eventlake.plans.joins import likely_in, salted_join
from eventlake.schemas import CURSOR_SCHEMA
from eventlake.sources.cursors import load_cursor, save_cursor

FEED = StructType([StructField("feed", StringType()), StructField("pos", LongType()), StructField("event_id", StringType())])


def page(spark, feeds):
    """feeds: {feed: [ids newest first]} → rows with pos."""
    rows = [(f, i, eid) for f, ids in feeds.items() for i, eid in enumerate(ids)]
    return spark.createDataFrame(rows, FEED)


def cursors(spark, mapping):
    return spark.createDataFrame([(f, None, c) for f, c in mapping.items()], CURSOR_SCHEMA)


def new_ids(spark, feeds, cur, **kw):
    out = new_since_last_seen(page(spark, feeds), cursors(spark, cur), **kw)
    got = {}
    for r in out.orderBy("feed", "pos").collect():
        got.setdefault(r.feed, []).append(r.event_id)
    return got


def test_no_cursor(spark):
    assert new_ids(spark, {"f": ["3", "2", "1"]}, {}) == {"f": ["3", "2", "1"]}


def test_cursor_present(spark):
    assert new_ids(spark, {"f": ["4", "3", "2", "1"]}, {"f": "2"}) == {"f": ["4", "3"]}


def test_cursor_unknown(spark):
    assert new_ids(spark, {"f": ["4", "3"]}, {"f": "999"}) == {"f": ["4", "3"]}


def test_empty_feed(spark):
    assert new_ids(spark, {}, {"f": "1"}) == {}


def test_empty_cursor_means_none(spark):
    assert new_ids(spark, {"f": ["2", "1"]}, {"f": ""}) == {"f": ["2", "1"]}


def test_null_cursor_means_none(spark):
    assert new_ids(spark, {"f": ["2", "1"]}, {"f": None}) == {"f": ["2", "1"]}


def test_several_feeds_and_cursor_on_page_two(spark):
    # two pages of 3 concatenated: positions continue across pages.
    feeds = {"a": ["9", "8", "7", "6", "5", "4"], "b": ["3", "2", "1"], "c": ["x", "y"]}
    got = new_ids(spark, feeds, {"a": "5", "b": "3", "c": "zz"})
    assert got == {"a": ["9", "8", "7", "6"], "c": ["x", "y"]}


def test_repeated_id_stops_at_first(spark):
    assert new_ids(spark, {"f": ["4", "2", "3", "2", "1"]}, {"f": "2"}) == {"f": ["4"]}


def test_shuffle_path_matches_broadcast(spark):
    feeds = {str(k): [str(i) for i in range(20, 0, -1)] for k in range(5)}
    cur = {str(k): str(k + 3) for k in range(5)}
    assert new_ids(spark, feeds, cur, max_broadcast_bytes=0) == new_ids(spark, feeds, cur)


def test_numeric_ids_compared_as_text(spark):
    df = spark.createDataFrame([("f", 0, 4), ("f", 1, 3), ("f", 2, 2)], "feed string, pos long, event_id long")
    out = new_since_last_seen(df, cursors(spark, {"f": "3"}))
    assert [r.event_id for r in out.collect()] == [4]


def test_broadcast_plan(spark):
    out = new_since_last_seen(page(spark, {"f": ["2", "1"]}), cursors(spark, {"f": "1"}))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, plan


def test_advance_cursor(spark):
    new = page(spark, {"a": ["9", "8"], "c": ["5"]})
    old = spark.createDataFrame([("a", "e1", "7"), ("b", "e2", "3")], CURSOR_SCHEMA)
    got = {r.feed: (r.etag, r.last_event_id) for r in advance_cursor(new, old).collect()}
    assert got == {"a": ("e1", "9"), "b": ("e2", "3"), "c": (None, "5")}


def test_cursor_never_moves_back(spark):
    cur = spark.createDataFrame([("f", None, "9"), ("g", None, "10")], CURSOR_SCHEMA)
    batch = spark.createDataFrame([("f", 5), ("g", 11), ("g", 2), ("h", 1)], "feed string, id long")
    got = {r.feed: r.last_event_id for r in advance_cursor(batch, cur, id_col="id", order_col="id", newest_first=False).collect()}
    assert got == {"f": "9", "g": "11", "h": "1"}
    ahead = {(r.feed, r.id) for r in ahead_of_cursor(batch, cur, id_col="id").collect()}
    assert ahead == {("g", 11), ("h", 1)}


def test_advance_cursor_new_etags(spark):
    new = page(spark, {"a": []})
    old = spark.createDataFrame([("a", "e1", "7")], CURSOR_SCHEMA)
    etags = spark.createDataFrame([("a", "e9")], "feed string, etag string")
    got = advance_cursor(new, old, new_etags=etags).collect()
    assert [(r.feed, r.etag, r.last_event_id) for r in got] == [("a", "e9", "7")]


def test_fingerprints(spark):
    a = page(spark, {"f": ["1", "2", "3"], "g": ["1"]})
    b = page(spark, {"f": ["3", "1", "2"], "g": ["2"]})
    fa = {r.feed: r.fingerprint for r in feed_fingerprints(a).collect()}
    fb = {r.feed: r.fingerprint for r in feed_fingerprints(b).collect()}
    assert fa["f"] == fb["f"] and fa["g"] != fb["g"]
    dup = page(spark, {"f": ["1", "1", "2", "3"]})
    assert feed_fingerprints(dup).first().fingerprint != fa["f"]


def test_changed_feeds(spark):
    prev = feed_fingerprints(page(spark, {"f": ["1", "2"], "g": ["1"], "gone": ["7"]}))
    cur = page(spark, {"f": ["2", "1"], "g": ["1", "5"], "new": ["8"]})
    got = {r.feed: r.changed for r in changed_feeds(cur, prev).collect()}
    assert got == {"f": False, "g": True, "gone": True, "new": True}


def test_dedup_keeps_first_ingest(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h, tzinfo=dt.timezone.utc)
    schema = StructType([StructField("event_id", StringType()), StructField("raw_payload", StringType()), StructField("kafka_ingest_ts", TimestampType())])
    df = spark.createDataFrame([("1", "late", t(5)), ("1", "first", t(1)), ("1", "mid", t(3)), ("2", "only", t(2))], schema)
    got = {r.event_id: r.raw_payload for r in dedup_events(df).collect()}
    assert got == {"1": "first", "2": "only"}
    assert dedup_events(df).columns == df.columns


def test_salted_join_exact(spark):
    big = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id"))
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    got = salted_join(big, small, ["k"], "left", salt_buckets=7)
    assert got.count() == 1000
    assert got.where(F.col("v").isNull()).count() == big.where(F.col("k") == 2).count()
    with pytest.raises(ValueError):
        salted_join(big, small, ["k"], "full_outer")


def test_salted_join_leaves_copies_where_they_are(spark, tmp_uri):
    """A small side of a small file, copied once per salt, isn't broadcast."""
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(tmp_uri)
    got = salted_join(spark.range(5000).select((F.col("id") % 2000).alias("k"), "id"), spark.read.parquet(tmp_uri), ["k"], "inner")
    assert got.count() == 3000
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["id", "'k' || id", "-id", "cast(id AS int)", "double(id) - 50"])
def test_likely_in_keeps_every_partner(spark, key):
    keys = spark.range(0, 4000, 2).selectExpr(f"{key} AS k").union(spark.sql("SELECT NULL AS k"))
    big = spark.range(40_000).selectExpr(f"{key} AS k", "id")
    got = likely_in(big, keys, "k")
    assert got.columns == ["k", "id"]
    ids = {r.id for r in got.collect()}
    assert ids >= set(range(0, 4000, 2)) and got.count() == len(ids)
    assert len(ids) == 40_000 if key.startswith("double") else len(ids) < 6000
    assert {r.id for r in likely_in(big, keys, "k", 100).collect()} >= set(range(0, 4000, 2))
    assert likely_in(big, keys.limit(0), "k").count() in (0, 40_000) and likely_in(big, keys.selectExpr("string(k) AS k"), "k").count() in (len(ids), 40_000)


def test_cursor_store_roundtrip(spark, tmp_uri):
    assert load_cursor(spark, tmp_uri).count() == 0
    save_cursor(spark.createDataFrame([("f", "abc123", "42")], CURSOR_SCHEMA), tmp_uri, 1)
    got = load_cursor(spark, tmp_uri).collect()
    assert [(r.feed, r.etag, r.last_event_id) for r in got] == [("f", "abc123", "42")]
    save_cursor(spark.createDataFrame([("f", "def", "43")], CURSOR_SCHEMA), tmp_uri, 2)
    assert [r.last_event_id for r in load_cursor(spark, tmp_uri).collect()] == ["43"]


def test_cursor_missing_state_is_empty(spark, tmp_uri):
    cur = load_cursor(spark, tmp_uri + "/none")
    assert cur.count() == 0 and cur.columns == ["feed", "etag", "last_event_id"]


def test_cursor_corrupt_state_fails(spark, tmp_uri):
    path = tmp_uri[len("file://"):] + "/v=3"
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as fh:
        fh.write("not parquet")
    open(os.path.join(path, "_SUCCESS"), "w").close()
    with pytest.raises(Exception):
        load_cursor(spark, tmp_uri).collect()


def test_cursor_uncommitted_version_ignored(spark, tmp_uri):
    save_cursor(spark.createDataFrame([("f", None, "7")], CURSOR_SCHEMA), tmp_uri, 1)
    half = tmp_uri[len("file://"):] + "/v=2"
    os.makedirs(half)
    with open(os.path.join(half, "part-0.parquet"), "w") as fh:
        fh.write("partial")
    assert [r.last_event_id for r in load_cursor(spark, tmp_uri).collect()] == ["7"]


def test_cursor_versions_pruned(spark, tmp_uri):
    from eventlake.sources.cursors import committed_versions

    for v in range(1, 6):
        save_cursor(spark.createDataFrame([("f", None, str(v))], CURSOR_SCHEMA), tmp_uri, v, keep=2)
    assert committed_versions(spark, tmp_uri) == [4, 5]
    assert [r.last_event_id for r in load_cursor(spark, tmp_uri).collect()] == ["5"]


def test_hot_feed_spread_on_shuffle_path(spark, session_conf):
    """A feed holding a third of all rows is split over many tasks when the
    cursor table is too large to broadcast."""
    session_conf("spark.sql.adaptive.enabled", "false")
    session_conf("spark.sql.shuffle.partitions", "16")
    session_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    n = 3000
    feed = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("feed"),
        F.col("id").alias("pos"),
        F.col("id").cast("string").alias("event_id"),
    )
    cur = spark.createDataFrame([("hot", None, "2997")] + [(str(k), None, "x") for k in range(97)], CURSOR_SCHEMA)
    out = new_since_last_seen(feed, cur, max_broadcast_bytes=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    per_task = out.where(F.col("feed") == "hot").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 8
    assert max(r["count"] for r in per_task) < n // 3 // 4
    assert out.where(F.col("feed") == "hot").count() == 999


def test_shuffle_path_combines_copies_before_the_join(spark, session_conf):
    session_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    feed = spark.range(3000).select(
        F.lit("f").alias("feed"), (F.col("id") % 7).alias("pos"), (F.col("id") % 7).cast("string").alias("event_id")
    )
    cur = spark.createDataFrame([("f", None, "3")], CURSOR_SCHEMA)
    out = new_since_last_seen(feed, cur, max_broadcast_bytes=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(pos" in plan, plan
    assert sorted({r.event_id for r in out.collect()}) == ["0", "1", "2"]
    assert out.count() == sum(1 for i in range(3000) if i % 7 < 3)


def test_fingerprint_with_content(spark):
    a = spark.createDataFrame([("f", "1", "x"), ("f", "2", None)], "feed string, event_id string, body string")
    b = spark.createDataFrame([("f", "1", "y"), ("f", "2", None)], "feed string, event_id string, body string")
    c = spark.createDataFrame([("f", "1", "x"), ("f", "2", "")], "feed string, event_id string, body string")
    ids = lambda df: feed_fingerprints(df).first().fingerprint
    full = lambda df: feed_fingerprints(df, content_cols=["body"]).first().fingerprint
    assert ids(a) == ids(b) == ids(c)
    assert len({full(a), full(b), full(c)}) == 3
    prev = feed_fingerprints(a, content_cols=["body"])
    assert changed_feeds(b, prev, content_cols=["body"]).first().changed
    assert not changed_feeds(a, prev, content_cols=["body"]).first().changed
