"""Approximate aggregates as stored columns: sketches of small, fixed size that
merge, so that days add up without their events.

``sketched`` makes one row of sketches for each group, ``merged`` adds rows of a
stored table up to coarser groups, and ``estimates`` reads the numbers out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^12 registers: a standard error of 1.6 % of a distinct count, 4 KB at most.
LG_REGISTERS = 12
#: 1.7 % of the rows is the error of a quantile's rank (99 % of the time).
QUANTILE_K = 200
#: Counters a group keeps for its heavy hitters.
TRACKED = 1000

KINDS = ("distinct", "quantiles", "frequent")


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _name(kind: str, name: str) -> str:
    return f"{name}__{kind}"


def sketched(
    df: DataFrame,
    keys: Sequence[str | Column],
    distinct: Mapping[str, str] | None = None,
    quantiles: Mapping[str, str] | None = None,
    frequent: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row for each group: the keys, ``rows``, and a sketch for each entry
    (output name → column) of ``distinct`` (distinct values), ``quantiles``
    (of a number) and ``frequent`` (values with most rows).

    NULL values are in no sketch, but their rows count; a NULL key is a group.
    Sketches are built map-side and only they are shuffled, so a group with a
    third of all rows costs its reducer one sketch a map task.
    """
    taken = [name for part in (distinct, quantiles, frequent) for name in part or {}]
    if len(set(taken)) != len(taken):
        raise ValueError("every sketch needs a name of its own")
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.hll_sketch_agg(_quoted(c), F.lit(LG_REGISTERS)).alias(_name("distinct", n)) for n, c in (distinct or {}).items()]
    aggs += [F.kll_sketch_agg_double(_quoted(c).cast("double"), F.lit(QUANTILE_K)).alias(_name("quantiles", n)) for n, c in (quantiles or {}).items()]
    # counted as text, so that a stored sketch tells its type the same way everywhere
    aggs += [F.call_function("approx_top_k_accumulate", _quoted(c).cast("string"), F.lit(TRACKED)).alias(_name("frequent", n)) for n, c in (frequent or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def _kinds(df: DataFrame) -> list[tuple[str, str, str]]:
    parts = [(c, *c.rsplit("__", 1)) for c in df.columns if "__" in c]
    return [(c, name, kind) for c, name, kind in parts if kind in KINDS]


def merged(stored: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows of ``sketched`` (or of this) added up to the groups of ``keys``."""
    how = {
        "distinct": lambda c: F.hll_union_agg(c),
        "quantiles": lambda c: F.kll_merge_agg_double(c),
        "frequent": lambda c: F.call_function("approx_top_k_combine", c, F.lit(TRACKED)),
    }
    return stored.groupBy(*keys).agg(F.sum("rows").alias("rows"), *[how[kind](_quoted(c)).alias(c) for c, _, kind in _kinds(stored)])


def estimates(df: DataFrame, shares: Sequence[float] = (0.5,), top: int = 10) -> DataFrame:
    """The numbers of each row's sketches, under the sketches' names: a
    distinct count; an array of the quantiles at ``shares`` (NULL if the group
    has no value); an array of ``item`` and ``count`` for the ``top`` values."""

    def quantiles_of(c: Column) -> Column:
        found = F.array(*[F.kll_sketch_get_quantile_double(c, F.lit(float(s))) for s in shares])
        return F.when(F.kll_sketch_get_n_double(c) > 0, found)

    read = {
        "distinct": lambda c: F.hll_sketch_estimate(c),
        "quantiles": quantiles_of,
        "frequent": lambda c: F.call_function("approx_top_k_estimate", c, F.lit(top)),
    }
    kinds = {c: (name, kind) for c, name, kind in _kinds(df)}
    return df.select(*[read[kinds[c][1]](_quoted(c)).alias(kinds[c][0]) if c in kinds else _quoted(c) for c in df.columns])
