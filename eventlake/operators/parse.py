"""JSON message → typed, flat event row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import parse_event_time
from ..schemas import ENVELOPE_SCHEMA


def parse_events(
    decoded: DataFrame,
    text_col: str = "raw_json",
    ingest_col: str = "kafka_ingest_ts",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse message text with the fixed envelope schema and flatten it.

    Output: ``event_id, event_type, actor_login, repo_name, created_at,
    raw_payload, kafka_ingest_ts``, then the ``keep`` columns of the input
    (e.g. topic, partition, offset for lineage).

    Permissive: broken JSON, arrays, empty or NULL text give NULL fields (and
    are dropped by ``validate`` for lack of an id); a scalar where a struct is
    expected nulls only that field; unknown fields are ignored here and kept
    in ``raw_payload``; numbers in ``id`` come out as their text.

    Plan shape: the parse goes through a one-element generator
    (``inline(array(from_json(..)))``). Without it Catalyst pushes the
    validation filters below the projection and repeats ``from_json`` once per
    predicate; the generator is a barrier, so each message is parsed once.
    The event-time parse sits behind a second one-element generator for the
    same reason (else the not-NULL filter evaluates it a second time).
    """
    parsed = decoded.select(
        F.col(text_col).alias("raw_payload"),
        F.col(ingest_col).alias("kafka_ingest_ts"),
        *[F.col(c) for c in keep],
        F.inline(F.array(F.from_json(F.col(text_col), ENVELOPE_SCHEMA))),
    )
    timed = parsed.select(
        "*", F.inline(F.array(F.struct(parse_event_time(F.col("created_at")).alias("__event_time"))))
    )
    return timed.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.name").alias("repo_name"),
        F.col("__event_time").alias("created_at"),
        F.col("raw_payload"),
        F.col("kafka_ingest_ts"),
        *[F.col(c) for c in keep],
    )
