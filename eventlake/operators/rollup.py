"""Totals over several grouping sets from stored finest-level totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How totals add up: the finest level's aggregate, and the one over totals.
MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def finest(df: DataFrame, dims: Sequence[str], measures: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """Totals of each combination of ``dims``. ``measures``: output name →
    (``count``, ``sum``, ``min`` or ``max``; column, None to count rows). Rows
    combine map-side; sums of decimals and whole numbers are exact."""
    make = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    return df.groupBy(*dims).agg(*[make[how](F.lit(1) if col is None else _quoted(col)).alias(name) for name, (how, col) in measures.items()])


def roll_up(
    parts: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]], measures: Mapping[str, tuple[str, str | None]]
) -> DataFrame:
    """Totals of every grouping set from a table of ``finest`` totals, which may
    hold a combination several times (one for each append): new events are
    added by appending their own finest totals, never by reading old events.

    Columns: ``dims`` (NULL where a set leaves one out), ``grouping_id`` (bit
    set for each dim left out, the last dim lowest, so a NULL value differs
    from a dim left out) and the measures. All sets come from one pass (a row
    is expanded once a set, then combined map-side). A set over an empty table
    has no rows, the grand total included.
    """
    unknown = {d for s in sets for d in s} - set(dims)
    if unknown:
        raise ValueError(f"grouping sets name no dims: {sorted(unknown)}")
    # first to one row a combination, so that appends aren't expanded once a set
    once = parts.groupBy(*dims).agg(*[MERGES[how](_quoted(name)).alias(name) for name, (how, _) in measures.items()])
    asked = [[_quoted(d) for d in s] for s in sets]
    return once.groupingSets(asked, *[_quoted(d) for d in dims]).agg(
        F.grouping_id().alias("grouping_id"), *[MERGES[how](_quoted(name)).alias(name) for name, (how, _) in measures.items()]
    )
