"""Command line: run the ingest job, the stored-table summary, or the health check.

    python -m eventlake ingest --table-base PATH --checkpoint-base PATH
                               (--bootstrap HOST:PORT --topic T | --source-dir PATH) [--dedup] [--trigger T]
    python -m eventlake counts --table PATH
    python -m eventlake health (--table-base PATH | --records PATH [--progress PATH]) [--topic T]
                               [--stale-after "30 minutes"]

``health --table-base`` checks what ``ingest`` recorded beside its tables:
source offsets and the progress of its queries.

Paths are Hadoop paths (hdfs://, s3a://, file:/...). Exits non-zero when a job
or a health check fails.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .config import StreamConfig
from .operators.activity import event_type_counts
from .operators.health import STALE_AFTER, health_report, health_status, partition_offsets, recorded_offsets, stream_health, topic_health
from .sources.files import read_table
from .streaming.jobs import file_source, kafka_source, run_ingest
from .streaming.progress import MONITOR_TABLES


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="eventlake")
    sub = p.add_subparsers(dest="cmd", required=True)

    ing = sub.add_parser("ingest", help="run events_v1 and repo_activity_5m")
    ing.add_argument("--table-base", required=True)
    ing.add_argument("--checkpoint-base", required=True)
    ing.add_argument("--bootstrap")
    ing.add_argument("--topic", default=StreamConfig.topic)
    ing.add_argument("--starting-offsets", default=StreamConfig.starting_offsets)
    ing.add_argument("--sasl-username", default="")
    ing.add_argument("--sasl-password", default="")
    ing.add_argument("--source-dir", help="replay topic records from files instead of a broker")
    ing.add_argument("--max-files-per-trigger", type=int)
    ing.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    ing.add_argument("--dedup", action="store_true")
    ing.add_argument("--min-partitions", type=int, help="split topic partitions into at least this many tasks")
    ing.add_argument("--activity-from-table", action="store_true", help="parse once: windows tail events_v1")
    ing.add_argument("--partition-by-date", action="store_true", help="lay events_v1 out by UTC event date")
    ing.add_argument("--state-store", default="hdfs", choices=["hdfs", "rocksdb"])
    ing.add_argument("--state-partitions", type=int, help="state/shuffle partitions of the stateful query")
    ing.add_argument("--trigger", default="availableNow", help='"availableNow", "once" or an interval')

    cnt = sub.add_parser("counts", help="events per type in a stored events table")
    cnt.add_argument("--table", required=True)
    cnt.add_argument("--format", default="parquet")

    hl = sub.add_parser("health", help="topic and stream checks")
    hl.add_argument("--table-base", help="the ingest job's tables, with what it recorded")
    hl.add_argument("--records", help="table of decoded records (topic, partition, offset)")
    hl.add_argument("--topic", help="default: the only topic there is")
    hl.add_argument("--progress", help="stream progress table")
    hl.add_argument("--query")
    hl.add_argument("--stale-after", default=STALE_AFTER)
    return p


def _interrupt_on_sigterm() -> None:
    """SIGTERM stops the streams like Ctrl-C: ``run_all`` stops every query."""
    import signal

    def handler(signum, frame):
        raise KeyboardInterrupt(f"signal {signum}")

    try:
        signal.signal(signal.SIGTERM, handler)
    except ValueError:  # not the main thread (embedded use): leave signals alone
        pass


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"eventlake-{args.cmd}").getOrCreate()
    if args.cmd == "ingest":
        cfg = StreamConfig(
            bootstrap_servers=args.bootstrap or StreamConfig.bootstrap_servers,
            topic=args.topic,
            starting_offsets=args.starting_offsets,
            sasl_username=args.sasl_username,
            sasl_password=args.sasl_password,
            checkpoint_base=args.checkpoint_base,
            table_base=args.table_base,
            sink_format=args.format,
            dedup=args.dedup,
            state_store=args.state_store,
            state_partitions=args.state_partitions,
            max_files_per_trigger=args.max_files_per_trigger,
            min_partitions=args.min_partitions,
            activity_from_table=args.activity_from_table,
            partition_events_by_date=args.partition_by_date,
        )
        source = file_source(cfg, args.source_dir) if args.source_dir else kafka_source(cfg)
        _interrupt_on_sigterm()
        try:
            run_ingest(spark, cfg, source, trigger=args.trigger)
        except KeyboardInterrupt:
            print("stopped; the checkpoints resume from here", file=sys.stderr)
            return 130
        return 0
    if args.cmd == "counts":
        event_type_counts(read_table(spark, args.table, args.format)).show(truncate=False)
        return 0
    progress, streams = args.progress, None
    if args.table_base:
        progress, _, offsets = (f"{args.table_base.rstrip('/')}/{name}" for name in MONITOR_TABLES)
        topics = topic_health(recorded_offsets(read_table(spark, offsets)))
    elif args.records:
        topics = topic_health(partition_offsets(read_table(spark, args.records)))
    else:
        print("health needs --table-base or --records", file=sys.stderr)
        return 2
    topic = args.topic
    if topic is None:
        named = topics.select("topic").limit(2).collect()
        if len(named) != 1:
            print("health needs --topic: there isn't exactly one", file=sys.stderr)
            return 2
        topic = named[0].topic
    if progress:
        streams = stream_health(read_table(spark, progress), stale_after=args.stale_after)
    try:
        print(health_status(health_report(topics, topic, streams, args.query)))
    except RuntimeError as exc:
        print(str(exc), file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
