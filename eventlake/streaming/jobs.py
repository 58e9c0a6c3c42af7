"""The ingest job: one validated stream feeding two independent queries.

``events_v1`` appends every valid event; ``repo_activity_5m`` appends closed
5-minute windows per repo. Each query has its own checkpoint and reads the
source itself, so one can fail or restart without the other.

With ``activity_from_table`` the windowed query tails ``events_v1`` (the file
sink's commit log lists exactly the committed files) instead of reading and
parsing the topic again: each message is parsed once, at the cost of the
activity lagging the events table by one commit.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from ..config import StreamConfig
from ..functions.timecols import instant_to_utc_ntz
from ..operators.activity import repo_activity
from ..operators.ingest import dedup_events_stream
from ..operators.parse import parse_events
from ..operators.quality import observe_quality, validate
from ..schemas import EVENT_SCHEMA
from ..sources.files import read_record_files
from ..sources.kafka import decode_records, read_kafka_stream
from .progress import recorded
from .sinks import run_all, start_append
from .state import stateful_settings

EVENTS_TABLE = "events_v1"
ACTIVITY_TABLE = "repo_activity_5m"

Source = Callable[[SparkSession], DataFrame]


def kafka_source(cfg: StreamConfig) -> Source:
    return lambda spark: read_kafka_stream(spark, cfg)


def file_source(cfg: StreamConfig, path: str) -> Source:
    """Replay of topic records from files, capped per micro-batch by
    ``cfg.max_files_per_trigger``."""
    return lambda spark: read_record_files(spark, path, max_files_per_trigger=cfg.max_files_per_trigger)


def validated_stream(records: DataFrame, cfg: StreamConfig, observe: str | None = None) -> DataFrame:
    """Records → decoded → parsed → [drop counters] → validated."""
    parsed = parse_events(decode_records(records))
    if observe:
        parsed = observe_quality(parsed, observe, cfg.allowed_types)
    return validate(parsed, cfg.allowed_types)


def start_events_v1(spark: SparkSession, cfg: StreamConfig, source: Source, trigger="availableNow") -> StreamingQuery:
    """Append every valid event. Drop counters per micro-batch arrive in the
    query progress as ``observedMetrics["events_v1_quality"]``. With
    ``partition_events_by_date`` the table is laid out by UTC event date, so
    batch reads of a date range prune files, and a micro-batch's rows are dealt
    out by date and id hash first: ``files_per_date`` files a date, not one
    from every task. The table keeps every valid event, repeated and late ones
    too; ``dedup`` is the windowed query's."""
    events = validated_stream(source(spark), cfg, observe=f"{EVENTS_TABLE}_quality")
    partition_by = None
    if cfg.partition_events_by_date:
        events = events.withColumn("event_date", F.to_date(instant_to_utc_ntz("created_at")))
        events = events.repartition(F.col("event_date"), F.pmod(F.xxhash64("event_id"), F.lit(cfg.files_per_date)))
        partition_by = ["event_date"]
    return start_append(
        events,
        cfg.table_path(EVENTS_TABLE),
        cfg.checkpoint_path(EVENTS_TABLE),
        fmt=cfg.sink_format,
        trigger=trigger,
        name=EVENTS_TABLE,
        merge_schema=True,
        partition_by=partition_by,
    )


def events_table_stream(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """Stream of the rows committed to ``events_v1``."""
    schema = EVENT_SCHEMA
    if cfg.partition_events_by_date:
        schema = StructType(EVENT_SCHEMA.fields + [StructField("event_date", DateType(), True)])
    reader = spark.readStream.format(cfg.sink_format)
    if cfg.sink_format != "delta":  # Delta has its own schema and refuses another
        reader = reader.schema(schema)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(cfg.max_files_per_trigger))
    return reader.load(cfg.table_path(EVENTS_TABLE))


def start_repo_activity(spark: SparkSession, cfg: StreamConfig, source: Source, trigger="availableNow") -> StreamingQuery:
    """Append closed windows per repo. Stored events are validated again: the
    allowed types may have changed since they were written. With ``dedup``,
    repeats within the watermark count once; rows behind the watermark are late
    for their windows in any case."""
    if cfg.activity_from_table:
        events = validate(events_table_stream(spark, cfg), cfg.allowed_types)
    else:
        events = validated_stream(source(spark), cfg)
    if cfg.dedup:
        events = dedup_events_stream(events, delay=cfg.watermark_delay)
    activity = repo_activity(events, cfg.window_size, cfg.watermark_delay)
    with stateful_settings(spark, cfg.state_store, cfg.state_partitions):
        return start_append(
            activity,
            cfg.table_path(ACTIVITY_TABLE),
            cfg.checkpoint_path(ACTIVITY_TABLE),
            fmt=cfg.sink_format,
            trigger=trigger,
            name=ACTIVITY_TABLE,
        )


def run_ingest(
    spark: SparkSession, cfg: StreamConfig, source: Source | None = None, trigger="availableNow", monitor: bool = True
) -> None:
    """Start both queries and wait for both; raise the first failure after
    both have stopped (with an interval trigger, the first failure stops the
    other). Drain-then-stop runs of the table-tailing form run the events query
    first, so the activity query sees what it committed.

    With ``monitor``, progress, drop counters and source offsets of every
    micro-batch go to the tables ``_progress``, ``_metrics`` and ``_offsets``
    beside the data, while the job runs and at its end."""
    source = source or kafka_source(cfg)
    drain = trigger in (None, "availableNow", "once")
    with recorded(spark, cfg.table_base) if monitor else nullcontext():
        if cfg.activity_from_table and drain:
            run_all([start_events_v1(spark, cfg, source, trigger)])
            run_all([start_repo_activity(spark, cfg, source, trigger)])
            return
        queries = [start_events_v1(spark, cfg, source, trigger)]
        try:
            queries.append(start_repo_activity(spark, cfg, source, trigger))
        except BaseException:
            queries[0].stop()
            raise
        run_all(queries, stop_on_failure=not drain)
