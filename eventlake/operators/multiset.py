"""Differences of two tables as multisets: which rows one has more often."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..plans.joins import DEFAULT_MAX_BROADCAST_BYTES, fits
from ..session import shared_dir


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def row_fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """256 bits of a row's values, as text with their lengths, so that NULL and
    empty text differ and no two rows read alike."""
    types = {f.name: f.dataType for f in df.schema.fields}
    nested = [c for c in columns if isinstance(types[c], (ArrayType, MapType, StructType))]
    if nested:
        raise ValueError(f"nested columns have no text of their own: {nested}")
    texts = [_quoted(c).cast("string") for c in columns]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


def multiset_diff(left: DataFrame, right: DataFrame, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """The distinct rows that the tables don't hold equally often, with
    ``n_left`` and ``n_right`` (bigint): ``EXCEPT ALL`` in both directions.

    Both need the same columns; they are matched by name, NULL equals NULL, and
    types must agree. Rows are counted by fingerprint first: 32 bytes and two
    counts a distinct row are shuffled, combined map-side, so that neither wide
    rows nor a row repeated a billion times load a reducer. The counts that
    differ are checkpointed, and the tables are read again for their rows: while
    those counts take at most ``max_broadcast_bytes`` they go to the tasks, so
    only rows that differ move; beyond that, one copy of each distinct row does.
    """
    columns = left.columns
    if sorted(columns) != sorted(right.columns) or len(set(columns)) != len(columns):
        raise ValueError("both tables need the same columns")
    kinds = dict(right.dtypes)
    unlike = [c for c, t in left.dtypes if kinds[c] != t]
    if unlike:
        raise ValueError(f"columns differ in type: {unlike}")

    def side(df: DataFrame, n: int) -> DataFrame:
        return df.select(row_fingerprint(df, columns).alias("__fp"), F.struct(*[_quoted(c) for c in columns]).alias("__row"), F.lit(n).alias("__left"))

    both = side(left, 1).unionByName(side(right, 0))
    counts = both.groupBy("__fp").agg(F.sum("__left").alias("n_left"), F.sum(1 - F.col("__left")).alias("n_right"))
    shared_dir(left.sparkSession)
    unequal = counts.where(F.col("n_left") != F.col("n_right")).checkpoint()
    small = fits(unequal, max_broadcast_bytes)
    if small:
        both = both.join(F.broadcast(unequal.select("__fp")), "__fp", "left_semi")
    rows = both.groupBy("__fp").agg(F.min("__row").alias("__row"))
    return rows.join(unequal, "__fp").select(*[F.col("__row")[c].alias(c) for c in columns], "n_left", "n_right")


def surplus(diff: DataFrame, ahead: str = "n_left", behind: str = "n_right") -> DataFrame:
    """``EXCEPT ALL`` by a ``multiset_diff``: each row as often as one side has
    it more."""
    more = F.col(ahead) - F.col(behind)
    rows = [_quoted(c) for c in diff.columns if c not in ("n_left", "n_right")]
    return diff.where(more > 0).select(*rows, F.explode(F.sequence(F.lit(1).cast("long"), more)).alias("__i")).drop("__i")
