"""Persisted poller cursors: one small versioned table per job.

Each save writes version ``n`` as its own folder ``v=<n>``; the write job's
commit marker (``_SUCCESS``) is what publishes it. A load lists the folder
once, takes the newest committed version and reads only that, so a half
written version (a crash, or an object store's non-atomic rename) is never
read, and the read cost does not grow with the number of saves. Older
versions stay readable until pruned (``keep``).

A missing table loads as no cursors (start fresh); an unreadable newest
version raises, on purpose: a silent fresh start would re-ingest everything.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CURSOR_SCHEMA
from ..session import hadoop_path

_VERSION_DIR = re.compile(r"^v=(\d+)$")
_MARKER = "_SUCCESS"


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions under ``path`` whose write committed, oldest first."""
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        m = _VERSION_DIR.match(status.getPath().getName())
        if m and status.isDirectory() and fs.exists(hadoop_path(spark, f"{status.getPath()}/{_MARKER}")[1]):
            out.append(int(m.group(1)))
    return sorted(out)


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The newest committed version: versions are tried newest first, so the
    cost doesn't grow with how many there are."""
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return None
    found = [m for st in fs.listStatus(root) if st.isDirectory() and (m := _VERSION_DIR.match(st.getPath().getName()))]
    for version in sorted((int(m.group(1)) for m in found), reverse=True):
        if fs.exists(hadoop_path(spark, f"{path.rstrip('/')}/v={version}/{_MARKER}")[1]):
            return version
    return None


def load_cursor(spark: SparkSession, path: str) -> DataFrame:
    """Newest saved cursors (``feed, etag, last_event_id``); none if never saved."""
    version = newest_version(spark, path)
    if version is None:
        return spark.createDataFrame([], CURSOR_SCHEMA)
    newest = f"{path.rstrip('/')}/v={version}"
    try:
        return spark.read.schema(CURSOR_SCHEMA).parquet(newest)
    except Exception as exc:  # noqa: BLE001 - any read failure of committed state
        raise RuntimeError(f"cursor table at {newest} is unreadable; refusing to start fresh") from exc


def save_cursor(cursors: DataFrame, path: str, version: int, keep: int | None = None) -> None:
    """Write ``cursors`` as ``version`` (the micro-batch id, or any increasing
    number). Call after the data it covers is written. Rewriting an existing
    version (a replayed batch) replaces it. With ``keep``, committed versions
    older than the newest ``keep`` are deleted afterwards."""
    (
        cursors.select(*[F.col(f.name).cast(f.dataType) for f in CURSOR_SCHEMA.fields])
        .write.mode("overwrite")
        .parquet(f"{path.rstrip('/')}/v={int(version)}")
    )
    if keep:
        spark = cursors.sparkSession
        for old in committed_versions(spark, path)[:-keep]:
            fs, old_path = hadoop_path(spark, f"{path.rstrip('/')}/v={old}")
            fs.delete(old_path, True)
