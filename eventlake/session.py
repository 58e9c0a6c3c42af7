"""Where jobs keep their state and intermediate tables.

On a cluster the shared folder is named by ``spark.checkpoint.dir``; it is read
from the session. Only when it is unset (local runs, tests) a folder is made
and registered, so later calls in the same session reuse it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder, created only if none is set."""
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if path:
        return path.rstrip("/")
    # The context may have been given a folder after start-up.
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get().rstrip("/")
    # Unset: local run. Make one folder and register it for the session.
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="eventlake-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared folder.

    Streaming sinks need a fresh output path for every fresh checkpoint (a file
    sink ignores batch ids it already logged), so every run takes a new one.
    """
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """``fresh_dir`` for intermediate tables: deleted when the application ends."""
    path = fresh_dir(spark, name)
    fs, jpath = hadoop_path(spark, path)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return f"{path}/t"


def hadoop_path(spark: SparkSession, path: str):
    """``(file_system, Path)`` for ``path`` on the cluster's file systems
    (HDFS, object stores, local), for metadata: existence, listing, times."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    """Set a session SQL setting for the block only (``None``: leave as is).

    Streaming queries capture settings such as the shuffle partition count
    when they start, so wrapping ``start()`` scopes the choice to that query.
    """
    if value is None:
        yield
        return
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
