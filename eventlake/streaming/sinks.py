"""Append sinks and running several streaming queries to completion."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..session import hadoop_path


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: str | None = "availableNow",
    name: str | None = None,
    merge_schema: bool = False,
    partition_by: Iterable[str] | None = None,
) -> StreamingQuery:
    """Start an append-mode query writing ``df`` to the table at ``path``.

    ``trigger``: ``"availableNow"`` (drain what is there, then stop; a
    scheduler restarts it), ``"once"``, or a processing-time interval.
    Offsets and state live in ``checkpoint``; a fresh checkpoint needs a
    fresh ``path`` (a file sink skips batch ids already in its log).

    ``merge_schema``: lets the table's schema grow when a restarted query
    (same checkpoint) writes more columns. Delta takes the option; the Parquet
    file sink writes each file with its batch's schema and readers pass
    ``mergeSchema``. Both sinks are exactly-once through their commit logs.
    """
    if fmt != "delta":
        _refuse_orphaned_sink(df.sparkSession, path, checkpoint)
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format(fmt)
    if name:
        writer = writer.queryName(name)
    writer = _trigger(writer, trigger)
    if merge_schema and fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    cols = list(partition_by or [])
    if cols:
        writer = writer.partitionBy(*cols)
    return writer.start(path)


def _refuse_orphaned_sink(spark, path: str, checkpoint: str) -> None:
    """A file sink keeps a log of committed batch ids next to its data. A new
    checkpoint restarts batch ids at 0, which that log already holds, so the
    query would silently write nothing: refuse instead."""
    log_fs, log = hadoop_path(spark, path.rstrip("/") + "/_spark_metadata")
    ck_fs, ck = hadoop_path(spark, checkpoint.rstrip("/") + "/offsets")
    if log_fs.exists(log) and len(log_fs.listStatus(log)) > 0 and not ck_fs.exists(ck):
        raise ValueError(
            f"{path} already holds a file-sink log but checkpoint {checkpoint} is new: the query would write "
            "nothing. Use the table's own checkpoint, or a fresh output path."
        )


def run_all(
    queries: Iterable[StreamingQuery], timeout: float | None = None, stop_on_failure: bool = False, poll: float = 0.2
) -> None:
    """Wait for every query (not just the first to end); then raise the first
    error, if any. All are watched at once: with ``stop_on_failure`` (for
    queries that would run for ever) the first failure stops the others.
    ``timeout`` is for all of them together; queries still active then are
    stopped. An interrupt (Ctrl-C, or SIGTERM mapped to it) stops all of them
    and is re-raised: their checkpoints let a restart resume where they stopped."""
    queries = list(queries)
    pending = list(queries)
    first_error: BaseException | None = None
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        while pending:
            for q in list(pending):
                left = poll if deadline is None else min(poll, max(0.01, deadline - time.monotonic()))
                try:
                    if q.awaitTermination(left if len(pending) > 1 or deadline is not None or stop_on_failure else None) is False:
                        continue
                except Exception as exc:  # noqa: BLE001 - a failed query: the others are still to be waited for
                    first_error = first_error or exc
                pending.remove(q)
            if pending and (stop_on_failure and first_error or deadline is not None and time.monotonic() >= deadline):
                for q in pending:
                    q.stop()
                break
    except BaseException:
        for q in queries:
            q.stop()
        raise
    for q in queries:
        if first_error is None and q.exception() is not None:
            first_error = RuntimeError(str(q.exception()))
    if first_error is not None:
        raise first_error


def data_then_cursor(
    data_path: str,
    cursor_path: str,
    cursor_of: Callable[[DataFrame], DataFrame],
    fmt: str = "parquet",
    keep: int = 10,
    rows_of: Callable[[DataFrame], DataFrame] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends the batch's rows, then saves
    the cursor ``cursor_of(batch)`` as version ``batch_id``.

    Data first, cursor after: a crash in between replays the batch (its rows
    appear twice; read them through ``dedup_events``) and never leaves a
    cursor ahead of the data it covers. The batch is persisted for its two
    uses, so the source is read once (a lost cached block is recomputed from
    the batch's offsets); make ``cursor_of`` an aggregate per feed. The newest
    ``keep`` cursor versions stay. ``rows_of`` picks the rows to take in, such
    as those ahead of the cursor; it is applied to the batch first.
    """
    from ..sources.cursors import save_cursor

    def write(batch: DataFrame, batch_id: int) -> None:
        if rows_of is not None:
            batch = rows_of(batch)
        batch.persist()
        try:
            batch.write.mode("append").format(fmt).save(data_path)
            save_cursor(cursor_of(batch), cursor_path, batch_id, keep)
        finally:
            batch.unpersist()

    return write
