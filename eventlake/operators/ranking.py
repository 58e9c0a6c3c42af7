"""Ranks and running totals over partitions of any size, without a task that
sorts a whole partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that the order values are cut into, and a frequent value's ties.
DEFAULT_RANGES = 64


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _bounds(found: DataFrame, ranges: int) -> DataFrame:
    """Quantiles of column ``v`` by one aggregation with a bounded buffer."""
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    return found.agg(F.percentile_approx("v", shares, F.lit(10 * ranges)).alias("q"))


def ranked(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    tie: str,
    sums: Mapping[str, str] | None = None,
    ranges: int = DEFAULT_RANGES,
) -> DataFrame:
    """All rows with, in their partition ``by`` (may be empty: the whole table)
    and ascending in ``order`` (a number or time; NULLs first), ``row_number``
    (equal values by ``tie``, a number, NULLs first), ``rank`` (equal values
    alike) and a running total for each entry of ``sums`` (output name →
    column; NULL adds nothing; exact for whole numbers and decimals). Rows
    alike in ``order`` and ``tie`` are numbered in any order.

    The order values are cut into ranges at sampled quantiles; a value that is
    itself several of them is so frequent that its ties are cut by ``tie`` too.
    Rows are numbered inside (partition, range), which one shuffle brings
    together, and a table of one row a range, summed up from its start, gives
    what came before. So a partition with a third of all rows, or one value
    with a third of them, is spread over some ``ranges`` tasks. Both tables of
    bounds hold at most ``ranges`` squared numbers, whatever the input.
    """
    sums = dict(sums or {})
    clash = ({"row_number", "rank", *sums} & set(df.columns)) | ({"row_number", "rank"} & set(sums))
    if clash:
        raise ValueError(f"output names are taken: {sorted(clash)}")
    rows = df.select(
        F.struct(*[_quoted(c) for c in df.columns]).alias("__row"),
        # fields of a struct are equal when both are NULL, so its equality joins NULL keys too
        F.struct(F.lit(0).alias("k"), *[_quoted(c).alias(f"k{i}") for i, c in enumerate(by)]).alias("__k"),
        _quoted(order).alias("__o"),
        _quoted(tie).alias("__t"),
        *[_quoted(c).alias(f"__s{i}") for i, c in enumerate(sums.values())],
    )
    cuts, often = [], []
    if ranges > 1:
        found = _bounds(rows.select(F.col("__o").alias("v")), ranges).first()["q"] or []
        cuts, often = sorted(set(found)), sorted({v for v in found if found.count(v) > 1})
    ties = {}
    if often:
        hot = rows.where(F.col("__o").isin(often)).select("__o", F.col("__t").alias("v"))
        ties = {r["__o"]: sorted(set(r["q"] or [])) for r in _bounds(hot.groupBy("__o"), ranges).collect()}

    def at_least(c: Column, bound) -> Column:
        return F.coalesce(c >= F.lit(bound), F.lit(False)).cast("int")

    # a frequent value is a range of its own: a cut before and one after it
    spot = F.lit(0)
    for c in cuts:
        spot = spot + at_least(F.col("__o"), c)
    for v in often:
        spot = spot + F.coalesce(F.col("__o") > F.lit(v), F.lit(False)).cast("int")
    sub = F.lit(0)
    for v, bounds in ties.items():
        sub = F.when(F.col("__o") == F.lit(v), sum((at_least(F.col("__t"), b) for b in bounds), F.lit(0))).otherwise(sub)
    rows = rows.withColumn("__range", spot).withColumn("__sub", sub)

    group = ["__k", "__range", "__sub"]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"), *[F.sum(zero(f"__s{i}")).alias(f"__sum{i}") for i in range(len(sums))])
    before = Window.partitionBy("__k").orderBy("__range", "__sub").rowsBetween(Window.unboundedPreceding, -1)
    first = Window.partitionBy("__k", "__range").orderBy("__sub")
    offsets = sizes.select(
        *group,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        *[F.coalesce(F.sum(f"__sum{i}").over(before), F.lit(0)).alias(f"__total{i}") for i in range(len(sums))],
    )
    # a value cut by its ties has the rank of its first piece
    offsets = offsets.withColumn("__first", F.first("__before").over(first))

    here = Window.partitionBy(*group).orderBy(F.col("__o").asc_nulls_first(), F.col("__t").asc_nulls_first())
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    alike = Window.partitionBy(*group).orderBy(F.col("__o").asc_nulls_first())
    local = rows.select(
        "__row",
        *group,
        F.row_number().over(here).alias("__i"),
        F.rank().over(alike).alias("__r"),
        *[F.sum(zero(f"__s{i}")).over(upto).alias(f"__run{i}") for i in range(len(sums))],
    )
    joined = local.join(offsets, group)
    return joined.select(
        *[F.col("__row")[c].alias(c) for c in df.columns],
        (F.col("__before") + F.col("__i")).alias("row_number"),
        (F.when(F.col("__sub") > 0, F.col("__first")).otherwise(F.col("__before")) + F.col("__r")).alias("rank"),
        *[(F.col(f"__total{i}") + F.col(f"__run{i}")).alias(name) for i, name in enumerate(sums)],
    )
