"""A Parquet table of changing rows: the sink of update-mode queries.

Every micro-batch writes the rows that changed as a version of its own
(``changes/v=<batch id>``), published by the write job's commit marker. A batch
that runs again after a crash writes the same version again, so each change
counts exactly once. A reader takes, for every key, the row of the newest
version. ``compact`` folds versions into a snapshot, which bounds what is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import hadoop_path
from ..sources.cursors import committed_versions, newest_version

VERSION = "v"


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _parts(path: str) -> tuple[str, str]:
    return f"{path.rstrip('/')}/changes", f"{path.rstrip('/')}/snapshots"


def upsert_batches(path: str, keys: Sequence[str], compact_every: int | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for an update-mode query whose rows have
    unique ``keys`` in a batch. With ``compact_every``, each so many-th batch
    compacts the table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if VERSION in batch.columns:
            raise ValueError(f"column {VERSION!r} is the table's own")
        batch.write.mode("overwrite").parquet(f"{_parts(path)[0]}/{VERSION}={int(batch_id)}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path, keys)

    return write


def start_upserts(
    df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], trigger: str | None = "availableNow", compact_every: int | None = None
) -> StreamingQuery:
    """Start an update-mode query that keeps the table at ``path``."""
    spark = df.sparkSession
    fs, ck = hadoop_path(spark, checkpoint.rstrip("/") + "/offsets")
    if not fs.exists(ck) and (newest_version(spark, _parts(path)[0]) is not None or newest_version(spark, _parts(path)[1]) is not None):
        raise ValueError(f"{path} holds versions but checkpoint {checkpoint} is new: its batches would replace them")
    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(upsert_batches(path, keys, compact_every))
    writer = writer.trigger(availableNow=True) if trigger in (None, "availableNow") else writer.trigger(processingTime=trigger)
    return writer.start()


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The table's rows now: for every key the row of its newest committed
    version. NULL is a key like others. Raises if nothing was ever written.

    One aggregation on the keys; versions of a key combine map-side."""
    changes, snapshots = _parts(path)
    base = newest_version(spark, snapshots)
    newer = [v for v in committed_versions(spark, changes) if base is None or v > base]
    if base is None and not newer:
        raise FileNotFoundError(f"no version of an upserted table under {path}")
    rows = None
    if newer:
        rows = spark.read.option("basePath", changes).parquet(*[f"{changes}/{VERSION}={v}" for v in newer])
        rows = rows.withColumn(VERSION, F.col(VERSION).cast("long"))
    if base is not None:
        whole = spark.read.parquet(f"{snapshots}/{VERSION}={base}")
        if rows is None:
            return whole
        rows = rows.unionByName(whole.withColumn(VERSION, F.lit(base).cast("long")))
    columns = [c for c in rows.columns if c != VERSION]
    newest = rows.groupBy(*[_quoted(k) for k in keys]).agg(F.max_by(F.struct(*[_quoted(c) for c in columns]), F.col(VERSION)).alias("__row"))
    return newest.select(*[F.col("__row")[c].alias(c) for c in columns])


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Write the table's rows as a snapshot up to the newest version, then
    delete what the snapshot before covered, so a reader that began on that one
    can finish. Does nothing if no version is newer than the last snapshot."""
    changes, snapshots = _parts(path)
    newest, before = newest_version(spark, changes), newest_version(spark, snapshots)
    if newest is None or before is not None and newest <= before:
        return
    read_upserted(spark, path, keys).write.mode("overwrite").parquet(f"{snapshots}/{VERSION}={newest}")
    if before is None:
        return
    old = [f"{changes}/{VERSION}={v}" for v in committed_versions(spark, changes) if v <= before]
    old += [f"{snapshots}/{VERSION}={v}" for v in committed_versions(spark, snapshots) if v < before]
    for folder in old:
        fs, jpath = hadoop_path(spark, folder)
        fs.delete(jpath, True)
