"""Time-zone-exact conversions between instants and UTC wall-clock values.

None of these depend on ``spark.sql.session.timeZone`` or ANSI mode: they go
through epoch microseconds, which Spark stores for both timestamp kinds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EVENT_TIME_PATTERN

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utc_ntz_to_instant(col: Column | str) -> Column:
    """A ``TIMESTAMP_NTZ`` read as UTC wall clock → ``TIMESTAMP`` instant."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(col))
    return F.timestamp_micros(micros)


def instant_to_utc_ntz(col: Column | str) -> Column:
    """A ``TIMESTAMP`` instant → its UTC wall clock as ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), F.expr(_EPOCH_NTZ))


def utc_text(col: Column | str) -> Column:
    """A UTC wall-clock ``TIMESTAMP_NTZ`` → ``yyyy-MM-ddTHH:mm:ssZ`` (seconds cut)."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_event_time(col: Column | str) -> Column:
    """Event-time text → instant; anything that does not match gives NULL.

    The zone designator is parsed (``X``), so ``...Z`` is UTC whatever the
    session zone; ``+09`` / ``+0900`` offsets are honoured. Fractions, ``+09:00``
    and missing zones do not match and give NULL, never an error, so one bad
    message cannot stop a stream and validation drops it.
    """
    return F.try_to_timestamp(_c(col), F.lit(EVENT_TIME_PATTERN))
