"""The table of changing rows: restarts, replays, compaction."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventlake.session import hadoop_path
from eventlake.sources.cursors import committed_versions, newest_version
from eventlake.streaming.sinks import run_all
from eventlake.streaming.upserts import compact, read_upserted, start_upserts, upsert_batches

KEYS = ["k"]


def batch(spark, *rows):
    return spark.createDataFrame(rows, "k string, n int")


def rows(spark, path):
    return sorted(map(tuple, read_upserted(spark, path, KEYS).collect()), key=repr)


def test_newest_version_of_each_key(spark, tmp_uri):
    write = upsert_batches(tmp_uri, KEYS)
    write(batch(spark, ("a", 1), ("b", 1), (None, 1)), 0)
    write(batch(spark, ("a", 2), (None, 5)), 1)
    assert rows(spark, tmp_uri) == sorted([("a", 2), ("b", 1), (None, 5)], key=repr)


def test_a_replayed_batch_counts_once(spark, tmp_uri):
    write = upsert_batches(tmp_uri, KEYS)
    write(batch(spark, ("a", 1)), 0)
    write(batch(spark, ("a", 2), ("b", 2)), 1)
    write(batch(spark, ("a", 2), ("b", 2)), 1)
    assert rows(spark, tmp_uri) == [("a", 2), ("b", 2)]
    # a later row with a smaller value still wins
    write(batch(spark, ("a", 0)), 2)
    assert rows(spark, tmp_uri) == [("a", 0), ("b", 2)]


def test_a_half_written_version_is_not_read(spark, tmp_uri):
    write = upsert_batches(tmp_uri, KEYS)
    write(batch(spark, ("a", 1)), 0)
    write(batch(spark, ("a", 2)), 1)
    fs, marker = hadoop_path(spark, f"{tmp_uri}/changes/v=1/_SUCCESS")
    fs.delete(marker, False)
    assert rows(spark, tmp_uri) == [("a", 1)]


def test_compaction_keeps_the_rows_and_drops_old_versions(spark, tmp_uri):
    write = upsert_batches(tmp_uri, KEYS, compact_every=2)
    for i in range(5):
        write(batch(spark, ("a", i), (f"k{i}", i)), i)
        assert rows(spark, tmp_uri) == sorted([("a", i), *[(f"k{j}", j) for j in range(i + 1)]])
    assert newest_version(spark, f"{tmp_uri}/snapshots") == 3
    assert committed_versions(spark, f"{tmp_uri}/changes") == [2, 3, 4]
    write(batch(spark, ("a", 3), ("k3", 3)), 3)  # batch 3 again, after its snapshot
    assert rows(spark, tmp_uri)[0] == ("a", 4)
    compact(spark, tmp_uri, KEYS)
    compact(spark, tmp_uri, KEYS)
    assert rows(spark, tmp_uri)[0] == ("a", 4) and len(rows(spark, tmp_uri)) == 6


def test_update_stream_over_restarts(spark, tmp_uri):
    src, path, ck = f"{tmp_uri}/src", f"{tmp_uri}/table", f"{tmp_uri}/ck"

    def drain(checkpoint=ck):
        counts = spark.readStream.schema("k string").parquet(src).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        run_all([start_upserts(counts, path, checkpoint, KEYS, compact_every=2)])

    for more in (["a", "b"], ["a"], ["c", None]):
        spark.createDataFrame([(m,) for m in more], "k string").write.mode("append").parquet(src)
        drain()
    drain()  # nothing new
    assert rows(spark, path) == sorted([("a", 2), ("b", 1), ("c", 1), (None, 1)], key=repr)
    with pytest.raises(ValueError, match="new"):
        drain(f"{tmp_uri}/other")


def test_a_table_never_written_raises(spark, tmp_uri):
    with pytest.raises(FileNotFoundError):
        read_upserted(spark, tmp_uri, KEYS)
    with pytest.raises(ValueError, match="own"):
        upsert_batches(tmp_uri, KEYS)(spark.range(1).withColumnRenamed("id", "v"), 0)
