"""Health checks over topic offsets and stream progress, as tables.

Each check is a row ``check, observed, ok``; a scheduler (or a test) fails
when any ``ok`` is false. Checks read decoded records and recorded progress,
not a broker admin API or a job service, so they run on any table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------
LIVE_STATES = ("RUNNING", "PENDING")
# A drain-then-stop job is healthy between runs, as long as it ran lately.
HEALTHY_STATES = (*LIVE_STATES, "TERMINATED")
STALE_AFTER = "30 minutes"
# -----------------------------------------------------------------------------


def partition_offsets(records: DataFrame) -> DataFrame:
    """Offset bounds per partition from decoded records:
    ``topic, partition, low, high`` with ``low = min(offset)`` and
    ``high = max(offset) + 1`` (a broker's low/high watermarks).

    Over a broker, ``high - low`` counts retained offsets including compaction
    and transaction gaps; over a table the bounds come from the rows present.
    Partial aggregation; one row per partition.
    """
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"),
        (F.max("offset") + 1).alias("high"),
    )


def recorded_offsets(offsets: DataFrame) -> DataFrame:
    """Offset bounds per partition from recorded batches (``topic, partition,
    low, high``, as the ingest job keeps them): the lowest and the highest."""
    return offsets.groupBy("topic", "partition").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def topic_health(offsets: DataFrame) -> DataFrame:
    """Per topic: ``topic, partitions, messages`` from partition bounds
    (``topic, partition, low, high``); messages are
    ``sum(max(0, high - low))``, so a negative span counts zero.
    """
    return offsets.groupBy("topic").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum(F.greatest(F.lit(0), F.col("high") - F.col("low"))), F.lit(0)).alias("messages"),
    )


def stream_health(
    progress: DataFrame,
    healthy_states: Sequence[str] = HEALTHY_STATES,
    stale_after: str = STALE_AFTER,
    now: Column | None = None,
) -> DataFrame:
    """Latest state per query from progress rows (``query, ts, state,
    input_rows[, late_rows]``): ``query, state, last_ts, input_rows, ok``.

    ``ok`` when the latest state is healthy (running, pending, or ended without
    error) and the latest row is no older than ``stale_after`` before ``now``
    (default: the current time): a query that stopped reporting, as a killed
    driver's does, is not healthy. Of rows at one time, a failure counts.
    """
    latest = progress.groupBy("query").agg(
        F.max_by("state", F.struct("ts", (F.col("state") == "FAILED").alias("failed"))).alias("state"),
        F.max("ts").alias("last_ts"),
        F.max_by("input_rows", "ts").alias("input_rows"),
    )
    fresh = F.col("last_ts") >= (F.current_timestamp() if now is None else now) - F.expr(f"INTERVAL {stale_after}")
    return latest.withColumn("ok", F.coalesce(F.col("state").isin(list(healthy_states)) & fresh, F.lit(False)))


def health_report(
    topics: DataFrame,
    topic: str,
    streams: DataFrame | None = None,
    query: str | None = None,
) -> DataFrame:
    """One row per check: topic exists, topic has messages, [streams are healthy].

    The stream check covers every query of ``streams`` (or the one named): it
    fails if any isn't ok, and names those as ``query=state``; otherwise it
    lists the states. A missing topic gives zero partitions (not an error), a
    missing stream gives state ``NONE``: both fail their check. Global aggregates always
    return one row, so the report has a fixed number of rows.
    """
    t = topics.where(F.col("topic") == F.lit(topic)).agg(
        F.coalesce(F.sum("partitions"), F.lit(0)).cast("long").alias("partitions"),
        F.coalesce(F.sum("messages"), F.lit(0)).cast("long").alias("messages"),
    )
    rows = t.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("topic_exists").alias("check"),
                    F.col("partitions").cast("string").alias("observed"),
                    (F.col("partitions") > 0).alias("ok"),
                ),
                F.struct(
                    F.lit("topic_has_messages").alias("check"),
                    F.col("messages").cast("string").alias("observed"),
                    (F.col("messages") > 0).alias("ok"),
                ),
            )
        )
    )
    if streams is None:
        return rows
    s = streams
    if query is not None:
        s = s.where(F.col("query") == F.lit(query))
    live = s.agg(
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.concat_ws("=", "query", "state")))), ",").alias("bad"),
        F.array_join(F.array_sort(F.collect_set("state")), ",").alias("states"),
        F.coalesce(F.bool_and("ok"), F.lit(False)).alias("ok"),
    )
    live = live.withColumn("observed", F.when(F.col("bad") != "", F.col("bad")).when(F.col("states") != "", F.col("states")).otherwise("NONE")).select(F.lit("stream_running").alias("check"), "observed", "ok")
    return rows.unionByName(live)


def health_status(report: DataFrame, now: str | None = None) -> str:
    """Status line when every check passed; otherwise raise naming the first
    failing check in report order (topic, offsets, stream), as a scheduler's
    chained tasks would stop there. The report has one row per check, so
    collecting it is bounded."""
    rows = report.collect()
    for r in rows:
        if not r["ok"]:
            raise RuntimeError(f"health check {r['check']} failed (observed {r['observed']})")
    import datetime as _dt

    stamp = now or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return f"OK at {stamp}: " + ", ".join(f"{r['check']}={r['observed']}" for r in rows)
