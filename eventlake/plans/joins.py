"""Join of a large side with a side that is usually small.

Broadcast only after the small side's size in bytes is checked (a sum that each
task of the small side takes part in). Beyond the bound the join shuffles, and the large side is
salted so one hot key (say a feed holding a third of all rows) is spread over
``salt_buckets`` tasks; the small side is replicated once per salt value.
The salt is a hash of the whole row, not ``rand()``, so a retried task routes
every row to the same place. Rows that differ in any column (in a feed, the
list position tells copies apart) land on different salts.

Where few rows of the large side have a partner, ``likely_in`` drops most
others before that shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of the small side (as JSON text) that may be broadcast.
DEFAULT_MAX_BROADCAST_BYTES = 32 << 20
DEFAULT_SALT_BUCKETS = 64
_SALT = "__salt"
# Bits of a key in ``likely_in``, and bits in one row of its map (Spark's bitmaps).
BITS_PER_KEY, BITMAP = 16, 1 << 15
# Types whose equal values have equal hashes.
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def fits(df: DataFrame, max_bytes: int) -> bool:
    """True when the rows of ``df`` take at most ``max_bytes`` as JSON text:
    one number from each task."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("long"))).first()[0]
    return (size or 0) <= max_bytes


def likely_in(big: DataFrame, keys: DataFrame, on: str, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``big`` without most of the rows that have no partner in ``keys``; all
    that have one stay, so an inner or semi join gives the same from it.

    Each key sets a bit by its hash; a row stays if its bit is set. The bits are
    broadcast: BITS_PER_KEY a key (one in 17 of the other rows stays), fewer if
    that is more than the bound. Keys of two types, or of types whose equal
    values may differ in hash, are left to the join.
    """
    kind = big.schema[on].dataType
    if kind != keys.schema[on].dataType or not (isinstance(kind, EXACT) or kind == T.StringType()):
        return big
    bits = max(1, min(BITS_PER_KEY * keys.count(), 8 * max_broadcast_bytes))
    place = F.pmod(F.xxhash64(F.col(f"`{on}`")), F.lit(bits))
    at = F.col("__place") % BITMAP
    maps = keys.select(place.alias("__place")).groupBy(F.expr(f"__place div {BITMAP}").alias("__map")).agg(F.bitmap_construct_agg(at).alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = big.withColumn("__place", place).withColumn("__map", F.expr(f"__place div {BITMAP}")).join(F.broadcast(maps), "__map")
    return rows.where(F.bit_get(byte, (at % 8).cast("int")) == 1).select(*[F.col(f"`{c}`") for c in big.columns])


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
) -> DataFrame:
    """Shuffle join on ``on`` + a salt; exact for inner and left joins.

    The small side is there once per salt value, which Spark's estimate (the
    size of its files) doesn't show: left to it, the copies might be broadcast,
    so the join is held to a merge. One bucket is no salt: for a side of nearly
    unique keys, where adaptive splits of a large partition are enough.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salted join keeps the big side whole only for inner/left joins, not {how!r}")
    salted_big = big.withColumn(_SALT, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.lit(salt_buckets)))
    replicated = small.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long"))))
    return salted_big.join(replicated.hint("merge"), [*on, _SALT], how).drop(_SALT)


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    small_fits: bool | None = None,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
) -> DataFrame:
    """Broadcast ``small`` when its size is proven bounded, else salt.

    ``small_fits`` lets a caller pass a bound it already proved (for example
    a per-key aggregate of a table whose size was checked).
    """
    if small_fits is None:
        small_fits = fits(small, max_broadcast_bytes)
    if small_fits:
        return big.join(F.broadcast(small), list(on), how)
    return salted_join(big, small, on, how, salt_buckets)
