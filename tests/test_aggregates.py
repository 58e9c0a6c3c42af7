"""Sketches, rollups, ranks and multiset differences against plain counts."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventlake.operators.multiset import multiset_diff, surplus
from eventlake.operators.ranking import ranked
from eventlake.operators.rollup import finest, roll_up
from eventlake.operators.sketches import estimates, merged, sketched
from eventlake.sources.files import read_table, write_table


# --- sketches --------------------------------------------------------------------


def test_stored_sketches_add_up_within_their_errors(spark, tmp_uri):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "cold"]), d, rng.randrange(30_000), rng.gauss(0, 10), int(rng.paretovariate(0.7))) for d in range(8) for _ in range(10_000)]
    df = spark.createDataFrame(rows, "k string, day int, user long, x double, page long").repartition(6)
    daily = sketched(df, ["k", "day"], {"users": "user"}, {"x": "x"}, {"pages": "page"})
    path = write_table(daily, tmp_uri)
    got = {r["k"]: r for r in estimates(merged(read_table(spark, path), ["k"]), (0.25, 0.5), top=5).collect()}
    assert set(got) == {"hot", "cold"}
    for k, r in got.items():
        mine = [x for x in rows if x[0] == k]
        assert r["rows"] == len(mine)
        exact = len({x[2] for x in mine})
        assert abs(r["users"] - exact) <= 0.08 * exact
        for share, q in zip((0.25, 0.5), r["x"]):
            assert abs(sum(x[3] <= q for x in mine) / len(mine) - share) < 0.05
        pages = Counter(str(x[4]) for x in mine)
        for item in r["pages"]:
            assert abs(item["count"] - pages[item["item"]]) <= 0.005 * len(mine)
        assert [i["item"] for i in r["pages"]][:3] == [p for p, _ in pages.most_common(3)]


def test_merging_in_steps_counts_what_merging_at_once_does(spark):
    df = spark.range(5_000).select((F.col("id") % 7).alias("a"), (F.col("id") % 5).alias("b"), F.col("id").alias("u"))
    daily = sketched(df, ["a", "b"], {"users": "u"})
    once = estimates(merged(daily, [F.lit(1).alias("all")])).first()
    steps = estimates(merged(merged(daily, ["a"]), [F.lit(1).alias("all")])).first()
    assert once["rows"] == steps["rows"] == 5_000 and abs(once["users"] - steps["users"]) <= 100


def test_sketches_of_nulls_and_nothing(spark):
    schema = "k string, u long, x double"
    df = spark.createDataFrame([(None, None, None), (None, 1, None), ("a", 2, 5.0)], schema)
    full = sketched(df, ["k"], {"users": "u"}, {"x": "x"}, {"top": "u"})
    got = {r["k"]: (r["rows"], r["users"], r["x"]) for r in estimates(full).collect()}
    assert got == {None: (2, 1, None), "a": (1, 1, [5.0])}
    assert estimates(merged(sketched(df.limit(0), ["k"], {"users": "u"}, {"x": "x"}), ["k"])).collect() == []
    with pytest.raises(ValueError, match="own"):
        sketched(df, ["k"], {"u": "u"}, {"u": "x"})


# --- rollups ---------------------------------------------------------------------

DIMS = ["a", "b"]
SETS = [("a", "b"), ("a",), ("b",), ()]
MEASURES = {"n": ("count", None), "known": ("count", "x"), "total": ("sum", "x"), "low": ("min", "x"), "high": ("max", "x")}


def rollup_brute(rows):
    out = []
    for s in SETS:
        groups = {}
        for r in rows:
            groups.setdefault(tuple(r[i] if d in s else None for i, d in enumerate(DIMS)), []).append(r[2])
        gid = sum((d not in s) << (len(DIMS) - 1 - i) for i, d in enumerate(DIMS))
        for k, xs in groups.items():
            seen = [x for x in xs if x is not None]
            out.append((*k, gid, len(xs), len(seen), sum(seen) if seen else None, min(seen, default=None), max(seen, default=None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("appends", [1, 3])
def test_rollup_of_appended_totals(spark, tmp_uri, appends):
    rng = random.Random(appends)
    rows = [(rng.choice(["hot", "hot", "x", None]), rng.choice(["p", "q", None]), rng.choice([None, rng.randrange(100)])) for _ in range(400)]
    for i in range(appends):
        write_table(finest(spark.createDataFrame(rows[i::appends], "a string, b string, x long"), DIMS, MEASURES), tmp_uri)
    got = roll_up(read_table(spark, tmp_uri), DIMS, SETS, MEASURES)
    assert got.columns == [*DIMS, "grouping_id", *MEASURES]
    assert sorted(map(tuple, got.collect()), key=repr) == rollup_brute(rows)


def test_rollup_of_nothing(spark):
    empty = finest(spark.createDataFrame([], "a string, b string, x long"), DIMS, MEASURES)
    assert roll_up(empty, DIMS, SETS, MEASURES).collect() == []
    with pytest.raises(ValueError, match="no dims"):
        roll_up(empty, DIMS, [("c",)], MEASURES)


# --- ranks -----------------------------------------------------------------------


def ranked_brute(rows, by):
    low = lambda v: (v is not None, v or 0)
    out, groups = [], {}
    for r in rows:
        groups.setdefault(r[0] if by else None, []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: (low(r[1]), low(r[2])))
        total = 0
        for i, r in enumerate(g):
            total += r[3] or 0
            rank = 1 + sum(low(o[1]) < low(r[1]) for o in g)
            out.append((*r, i + 1, rank, total))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 4, 64])
@pytest.mark.parametrize("by", [["k"], []])
def test_ranks_equal_sorting(spark, ranges, by):
    rng = random.Random(ranges)
    # a partition and an order value with a third of all rows or more
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.choice([50, 50, None, rng.randrange(100)]), i, rng.choice([None, rng.randrange(9)])) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, o int, t int, x int").repartition(5)
    got = ranked(df, by, "o", "t", {"total": "x"}, ranges=ranges)
    assert got.columns == ["k", "o", "t", "x", "row_number", "rank", "total"]
    assert sorted(map(tuple, got.collect()), key=repr) == ranked_brute(rows, bool(by))


def test_a_frequent_value_is_spread(spark):
    df = spark.range(20_000).select(F.lit("one").alias("k"), F.lit(7).alias("o"), F.col("id").alias("t"))
    got = ranked(df, ["k"], "o", "t", ranges=8)
    assert got.where("rank <> 1 or row_number <> t + 1").count() == 0


def test_ranks_shuffle_the_rows_once(spark, session_conf):
    session_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = spark.createDataFrame([(i % 3, i % 50, i) for i in range(500)], "k int, o int, t int")
    plan = ranked(df, ["k"], "o", "t", {"total": "t"})._jdf.queryExecution().executedPlan().toString()
    whole = [line for line in plan.splitlines() if "Exchange hashpartitioning(__k" in line]
    # rows by group, sizes by group, sizes by partition, offsets back by group
    assert len(whole) <= 4, plan


def test_ranks_of_nothing_and_clashing_names(spark):
    df = spark.createDataFrame([], "k string, o int, t int")
    assert ranked(df, ["k"], "o", "t").collect() == []
    with pytest.raises(ValueError, match="taken"):
        ranked(df.withColumnRenamed("k", "rank"), ["rank"], "o", "t")


# --- multisets -------------------------------------------------------------------


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_multiset_diff_counts_copies(spark, bound):
    rng = random.Random(1)
    value = lambda: (rng.choice(["", "a", "1:a", "-", None]), rng.choice([None, 1, 11]))
    left, right = [value() for _ in range(300)], [value() for _ in range(260)]
    left += [("hot", 0)] * 400
    right += [("hot", 0)] * 399
    ldf = spark.createDataFrame(left, "a string, b int").repartition(4)
    rdf = spark.createDataFrame(right, "a string, b int").select("b", "a").repartition(3)
    want = {k: (Counter(left)[k], Counter(right)[k]) for k in {*left, *right} if Counter(left)[k] != Counter(right)[k]}
    diff = multiset_diff(ldf, rdf, max_broadcast_bytes=bound)
    assert diff.columns == ["a", "b", "n_left", "n_right"]
    assert {(r["a"], r["b"]): (r["n_left"], r["n_right"]) for r in diff.collect()} == want
    assert Counter(map(tuple, surplus(diff).collect())) == Counter(left) - Counter(right)
    assert Counter(map(tuple, surplus(diff, "n_right", "n_left").collect())) == Counter(right) - Counter(left)


def test_multiset_diff_of_equal_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1)], "a string, b int")
    assert multiset_diff(df, df.repartition(3)).collect() == []
    assert [tuple(r) for r in multiset_diff(df, df.limit(0)).collect()] == [("a", 1, 2, 0)]
    with pytest.raises(ValueError, match="same columns"):
        multiset_diff(df, df.drop("b"))
    with pytest.raises(ValueError, match="type"):
        multiset_diff(df, df.withColumn("b", F.col("b").cast("long")))
    with pytest.raises(ValueError, match="nested"):
        multiset_diff(df.withColumn("c", F.array("b")), df.withColumn("c", F.array("b")))


def test_times_differ_to_the_microsecond(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00.000001' AS t")
    other = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00.000002' AS t")
    assert multiset_diff(df, other).count() == 2
