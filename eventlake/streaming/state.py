"""State store choice for stateful queries (windowed counts, dedup).

The in-memory (HDFS-backed) store keeps all open windows on the executor
heap; with many repos and a long watermark, RocksDB keeps them off-heap and
spills to local disk, with the same checkpoint semantics. The provider is a
session setting read when a query starts and then fixed by its checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import SparkSession

from ..session import session_setting

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
PROVIDERS = {
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def use_state_store(spark: SparkSession, kind: str) -> None:
    """Select the state store for queries started next in this session.

    ``hdfs`` leaves the session as it is (Spark's default, or whatever the
    cluster configured)."""
    if kind == "hdfs":
        return
    if kind not in PROVIDERS:
        raise ValueError(f"unknown state store {kind!r}; one of {sorted(PROVIDERS)}")
    spark.conf.set(PROVIDER_CONF, PROVIDERS[kind])


@contextmanager
def stateful_settings(spark: SparkSession, kind: str, partitions: int | None) -> Iterator[None]:
    """Scope the state store kind and state partition count to the queries
    started inside the block (both are fixed per query at its start)."""
    if kind not in PROVIDERS:
        raise ValueError(f"unknown state store {kind!r}; one of {sorted(PROVIDERS)}")
    with ExitStack() as stack:
        if kind != "hdfs":
            stack.enter_context(session_setting(spark, PROVIDER_CONF, PROVIDERS[kind]))
        if partitions:
            stack.enter_context(session_setting(spark, "spark.sql.shuffle.partitions", str(partitions)))
        yield
