"""Inputs of the registered queries, all derived from the given tables.

The ``events`` test table becomes topic records through the adapter in
``sources.envelope``; snapshots, feeds and replays below are rules over its
rows (time cut-offs and keys), so every input grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import parse_events
from ..operators.quality import validate
from ..sources.envelope import topic_records
from ..sources.kafka import decode_records
from ..session import hadoop_path
from .layout import spread

# --- fixed values of the test set-up -------------------------------------------
# Allowed types of the test table (the fifth, "error", exercises the type check).
TEST_ALLOWED_TYPES = ("click", "view", "purchase", "signup")
# Feeds: events are split into this many feeds by user.
FEEDS = 4
# Events per page of a feed listing.
PAGE_SIZE = 100
# The previous poll saw events before this time.
PREVIOUS_POLL = "2024-01-20 00:00:00"
# Changed-feed check: daily feeds, previous fingerprints taken at this time.
FINGERPRINT_POLL = "2024-01-20 12:00:00"
# Replay: a poller re-publishes events from this time on, one day later.
REPLAY_FROM = "2024-01-15 00:00:00"
REPLAY_DELAY = "1 day"
# A watermark delay that covers every repeat of the replay.
REPLAY_SPAN = "20 days"
# Polls: events before each time, those of every LATE_USERS-th user one poll late.
POLLS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", None)
LATE_USERS = 10
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def records(spark: SparkSession, sf_dir: str, parallel: bool = False) -> DataFrame:
    """Topic records of the events table; ``parallel`` deals the rows out to
    the cluster's cores first, for inputs of the JSON parse: the test table is
    one row group, and would be parsed by one task."""
    ev = events(spark, sf_dir)
    return topic_records(spread(ev, spark.sparkContext.defaultParallelism) if parallel else ev)


def record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table streamed as it lies, turned into topic records inside
    the stream: no copy of the data is written first. A folder of part files is
    its own source; a single file is read through its parent folder."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    reader = spark.readStream.schema(events(spark, sf_dir).schema)
    fs, jpath = hadoop_path(spark, path)
    if fs.getFileStatus(jpath).isDirectory():
        rows = reader.parquet(path)
    else:
        rows = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir.rstrip("/"))
    return topic_records(spread(rows, spark.sparkContext.defaultParallelism))


def decoded(spark: SparkSession, sf_dir: str, parallel: bool = False) -> DataFrame:
    return decode_records(records(spark, sf_dir, parallel))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(decoded(spark, sf_dir, parallel=True))


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(parsed(spark, sf_dir), TEST_ALLOWED_TYPES)


def _before(ts_col: str, when: str):
    return F.col(ts_col) < F.lit(when).cast("timestamp_ntz")


def first_poll_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records published by a first poll: events before ``PREVIOUS_POLL``."""
    ev = events(spark, sf_dir).where(_before("ts", PREVIOUS_POLL))
    return topic_records(spread(ev, spark.sparkContext.defaultParallelism))


def replayed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records published again by a later poll whose page had shifted: events
    from ``REPLAY_FROM`` on; the overlap with the first poll arrives a day
    later at higher offsets."""
    ev = events(spark, sf_dir).where(~_before("ts", REPLAY_FROM))
    rec = topic_records(spread(ev, spark.sparkContext.defaultParallelism))
    late = F.col("timestamp") + F.expr(f"INTERVAL {REPLAY_DELAY}")
    shift = F.lit(10**12)
    return rec.select(
        "key", "value", "topic", "partition", (F.col("offset") + shift).alias("offset"), late.alias("timestamp")
    )


def late_records(spark: SparkSession, sf_dir: str, poll: int) -> DataFrame:
    """Topic records that arrive in a poll: events since the poll before, but
    those of late users a poll after their time (the last poll takes all)."""
    ev = events(spark, sf_dir)
    due = F.lit(len(POLLS) - 1)
    for i in reversed(range(len(POLLS) - 1)):
        due = F.when(_before("ts", POLLS[i]), F.lit(i)).otherwise(due)
    late = F.when(F.col("user_id") % LATE_USERS == 0, F.least(due + 1, F.lit(len(POLLS) - 1))).otherwise(due)
    return topic_records(spread(ev.where(late == poll), spark.sparkContext.defaultParallelism))


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as newest-first feeds: ``feed, event_id, event_type, ts``;
    larger ids are newer."""
    return events(spark, sf_dir).select(
        (F.col("user_id") % FEEDS).alias("feed"), "event_id", "event_type", "ts"
    )


def _ranked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Feed rows and their rank from the newest id (the bound is a scalar
    subquery, not a per-feed sort)."""
    rows = feed_rows(spark, sf_dir)
    return rows, F.lit(rows.select(F.max("event_id")).scalar()) - F.col("event_id")


def first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first listing page, newest first: ``pos = struct(page, idx)``."""
    rows, rank = _ranked(spark, sf_dir)
    return rows.where(rank < PAGE_SIZE).withColumn("pos", F.struct(F.lit(1).alias("page"), rank.cast("int").alias("idx")))


def shifted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages after it, read when one more event had come in: each begins
    one event earlier, and the second with the last event of the first."""
    rows, rank = _ranked(spark, sf_dir)
    rank = rank - (PAGE_SIZE - 1)
    page = (F.floor(rank / PAGE_SIZE) + 2).cast("int")
    return rows.where(rank >= 0).withColumn("pos", F.struct(page.alias("page"), (rank % PAGE_SIZE).cast("int").alias("idx")))


def previous_feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_rows(spark, sf_dir).where(_before("ts", PREVIOUS_POLL))


def daily_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one feed per day: ``feed, event_id, ts``."""
    return events(spark, sf_dir).select(F.date_format("ts", "yyyy-MM-dd").alias("feed"), "event_id", "ts")


def malformed_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of the table in eight forms (one pass, ``explode``):
    ``variant, raw_json, kafka_ingest_ts``. The forms are the malformed
    shapes a topic delivers: cut-off text, a JSON array, event times without
    a zone, with fractions or a numeric offset, a numeric id, and a scalar
    where a struct belongs. The adapter's JSON ends with the event time."""
    dec = decoded(spark, sf_dir, parallel=True)
    raw = F.col("raw_json")
    forms = [
        ("original", raw),
        ("truncated", F.expr("substr(raw_json, 1, length(raw_json) - 1)")),
        ("array", F.concat(F.lit("["), raw, F.lit("]"))),
        ("no_zone", F.regexp_replace(raw, 'Z"}$', '"}')),
        ("fraction", F.regexp_replace(raw, 'Z"}$', '.5Z"}')),
        ("offset", F.regexp_replace(raw, 'Z"}$', '+0900"}')),
        ("numeric_id", F.regexp_replace(raw, '^\\{"id":"([0-9]+)"', '{"id":$1')),
        ("actor_text", F.regexp_replace(raw, '"actor":\\{"login":("[^"]*")\\}', '"actor":$1')),
    ]
    variants = F.array(*[F.struct(F.lit(n).alias("variant"), c.alias("text")) for n, c in forms])
    return dec.select(F.inline(variants), "kafka_ingest_ts").withColumnRenamed("text", "raw_json")


def time_ordered_replay(spark: SparkSession, sf_dir: str, path: str, batches: int) -> tuple[str, int]:
    """Write the table's topic records as files covering disjoint, increasing
    time ranges (range partitioning samples its bounds, so a busy period is
    split, not sent to one task), and stamp the files' modification times in
    range order so a file stream replays them oldest first. Only file metadata
    is touched on the driver.

    Returns the folder and the files of a micro-batch, as many as the session's
    shuffle partitions allow for ``batches`` batches. A store without settable
    times can't hold the order: that raises."""
    per_batch = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // batches))
    ev = events(spark, sf_dir).repartitionByRange(batches * per_batch, "ts")
    topic_records(ev).write.parquet(path)
    fs, root = hadoop_path(spark, path)

    def parts():
        found = [st for st in fs.listStatus(root) if st.getPath().getName().startswith("part-")]
        return sorted(found, key=lambda st: st.getPath().getName())

    base = 1_000_000_000_000  # ms; any increasing stamps do
    for i, st in enumerate(parts()):
        fs.setTimes(st.getPath(), base + i * 1000, -1)
    stamps = [st.getModificationTime() for st in parts()]
    if not all(a < b for a, b in zip(stamps, stamps[1:])):
        raise RuntimeError(f"{path}: file times can't be set, so the replay would be out of order")
    return path, per_batch
