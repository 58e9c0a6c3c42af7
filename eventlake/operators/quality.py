"""Validation: drop rows without id or time, or of a type not allowed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import DEFAULT_ALLOWED_TYPES

# --- fixed values: drop reasons, checked in this order -------------------------
MISSING_ID = "missing_event_id"
BAD_TIME = "bad_created_at"
TYPE_NOT_ALLOWED = "type_not_allowed"
KEPT = "kept"
# -----------------------------------------------------------------------------


def _type_allowed(allowed: Sequence[str]) -> Column:
    # SQL three-valued IN: a NULL type is not allowed.
    return F.col("event_type").isin(list(allowed))


def validate(events: DataFrame, allowed: Sequence[str] = DEFAULT_ALLOWED_TYPES) -> DataFrame:
    """Keep rows with an id, a parsed time and an allowed type.

    ``repo_name`` and ``actor_login`` are not checked: NULLs stay. An empty
    string id passes (it is not NULL). On a stored table the three predicates
    reach the Parquet scan as pushed filters.
    """
    return events.filter(
        F.col("event_id").isNotNull() & F.col("created_at").isNotNull() & _type_allowed(allowed)
    )


def drop_reason(allowed: Sequence[str] = DEFAULT_ALLOWED_TYPES) -> Column:
    """Why a parsed row is dropped (first failing check), or ``kept``."""
    return (
        F.when(F.col("event_id").isNull(), F.lit(MISSING_ID))
        .when(F.col("created_at").isNull(), F.lit(BAD_TIME))
        .when(~F.coalesce(_type_allowed(allowed), F.lit(False)), F.lit(TYPE_NOT_ALLOWED))
        .otherwise(F.lit(KEPT))
    )


def drop_reasons(events: DataFrame, allowed: Sequence[str] = DEFAULT_ALLOWED_TYPES) -> DataFrame:
    """Batch count of rows per drop reason: ``reason, rows``.

    Partial aggregation before the shuffle; output has at most four rows.
    """
    return events.groupBy(drop_reason(allowed).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def observe_quality(events: DataFrame, name: str | Observation = "quality", allowed: Sequence[str] = DEFAULT_ALLOWED_TYPES) -> DataFrame:
    """Attach per-batch drop counters to a (streaming or batch) frame.

    Returns the same rows; the counts arrive in
    ``StreamingQueryProgress.observedMetrics[name]`` per micro-batch (pass an
    ``Observation`` for batch), computed in the same pass as the data.
    """
    reason = drop_reason(allowed)
    return events.observe(
        name,
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(reason == MISSING_ID).alias(MISSING_ID),
        F.count_if(reason == BAD_TIME).alias(BAD_TIME),
        F.count_if(reason == TYPE_NOT_ALLOWED).alias(TYPE_NOT_ALLOWED),
    )
