"""As-of join: each row with the last record of its key at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that the times are cut into; a hot key is spread over all of them.
DEFAULT_RANGES = 64


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def time_ranges(times: DataFrame, ranges: int) -> list:
    """Times (column ``t``) that cut the rows into about equal ranges, by one
    aggregation with a bounded buffer."""
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = times.agg(F.percentile_approx("t", F.array(*[F.lit(s) for s in shares]), F.lit(10 * ranges)).alias("q")).first()["q"]
    return sorted(set(found or []))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: dict[str, str],
    order: Sequence[str] = (),
    tolerance: str | None = None,
    ranges: int = DEFAULT_RANGES,
) -> DataFrame:
    """All rows of ``left`` with ``values`` (right column → output name) of the
    last ``right`` row with equal ``keys`` and ``right_time <= left_time``;
    NULLs where there is none, or none within ``tolerance`` (an interval such
    as ``"1 hour"``). Of right rows at one time the greatest by ``order``, then
    by values, is the last. Rows with a NULL key or time match nothing; left
    ones stay. Output names must not occur in ``left``.

    One union, one shuffle on (keys, time range) and one sort carry the last
    record along. No range waits for the one before: the last record of each
    (key, range), a small aggregate, is handed on to the ranges after it and
    joined on the same partitioning, so that a key with a third of all rows is
    spread over ``ranges`` groups.
    """
    clash = set(values.values()) & set(left.columns)
    if clash:
        raise ValueError(f"output names are columns of the left side: {sorted(clash)}")
    ks = [f"__k{i}" for i in range(len(keys))]
    record = F.struct(_quoted(right_time).alias("t"), *[_quoted(c).alias(f"o{i}") for i, c in enumerate(order)], *[_quoted(c).alias(f"v{i}") for i, c in enumerate(values)])
    rows = left.select(F.struct(*[_quoted(c) for c in left.columns]).alias("__row"), *[_quoted(c).alias(k) for c, k in zip(keys, ks, strict=True)], _quoted(left_time).alias("t"))
    known = right.select(*[_quoted(c).alias(k) for c, k in zip(keys, ks, strict=True)], _quoted(right_time).alias("t"), record.alias("__rec"))
    known = known.where(F.col("t").isNotNull())
    for k in ks:
        known = known.where(F.col(k).isNotNull())
    both = rows.unionByName(known, allowMissingColumns=True)
    bounds = time_ranges(both.select("t"), ranges)

    def in_range(t: Column) -> Column:
        # NULL times are in the first range, where nothing comes before them
        return sum((F.coalesce(t >= F.lit(b), F.lit(False)).cast("int") for b in bounds), F.lit(0))

    both = both.withColumn("__range", in_range(F.col("t")))
    # at equal times records come first, in their order
    place = Window.partitionBy(*ks, "__range").orderBy(F.col("t").asc_nulls_first(), F.col("__row").isNotNull(), F.col("__rec")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("__seen", F.last("__rec", ignorenulls=True).over(place)).where(F.col("__row").isNotNull())

    ends = known.withColumn("__range", in_range(F.col("t"))).groupBy(*ks, "__range").agg(F.max("__rec").alias("__before"))
    # a record lasts to the next range that has one of its own
    until = F.coalesce(F.lead("__range").over(Window.partitionBy(*ks).orderBy("__range")), F.lit(len(bounds)))
    handed = ends.withColumn("__until", until).where(F.col("__until") > F.col("__range"))
    handed = handed.select(*ks, "__before", F.explode(F.sequence(F.col("__range") + 1, F.col("__until"))).alias("__range"))

    joined = seen.join(handed, [*ks, "__range"], "left")
    last = F.coalesce(F.col("__seen"), F.when(F.col("t").isNotNull(), F.col("__before")))
    joined = joined.withColumn("__last", last)
    found = F.col("__last").isNotNull()
    if tolerance is not None:
        found = found & (F.col("t") <= F.col("__last.t") + F.expr(f"INTERVAL {tolerance}"))
    return joined.select(
        *[F.col("__row")[c].alias(c) for c in left.columns],
        *[F.when(found, F.col(f"__last.v{i}")).alias(name) for i, name in enumerate(values.values())],
    )
