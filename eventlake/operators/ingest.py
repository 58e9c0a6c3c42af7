"""Incremental ingest: rows since the last seen id, cursor update, changed-feed
detection, and removal of repeated events.

A *feed* is a newest-first list of events (an API page set, say). A
DataFrame has no list order, so the order is a column: ``order_col`` with
``newest_first=True`` means smaller values are newer (a list position, 0 =
newest); with ``newest_first=False`` larger values are newer (a time or an
increasing id). Several feeds are handled at once, keyed by ``feed_col``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import id_hash
from ..plans.joins import DEFAULT_MAX_BROADCAST_BYTES, fits, join_small

_CUR = "__cursor"
_HIT = "__hit"
_NEW = "__new_id"


def _cursor_ids(cursors: DataFrame, feed_col: str) -> DataFrame:
    # An empty-string cursor means "no cursor", as a falsy id does.
    cid = F.nullif(F.col("last_event_id").cast("string"), F.lit(""))
    return cursors.select(F.col(feed_col), cid.alias(_CUR)).where(F.col(_CUR).isNotNull())


def new_since_last_seen(
    feed: DataFrame,
    cursors: DataFrame,
    feed_col: str = "feed",
    id_col: str = "event_id",
    order_col: str = "pos",
    newest_first: bool = True,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Rows of each feed ahead of (newer than) the first occurrence of the
    feed's cursor id; ids are compared as text.

    No cursor, an empty cursor, or a cursor id not in the feed → the whole
    feed; empty feed → no rows. Equivalent to walking each list newest first
    and stopping at the known id, but without ordering a feed in one task:

    1. ``hits``: rows whose id equals their feed's cursor, reduced per feed to
       the newest position (a join with the cursor table, then a partial
       aggregate); at most one row per cursor.
    2. the feed joined with ``hits`` on the feed key, kept while ahead of it.

    The cursor table's size is checked once; it bounds ``hits`` too, so
    both are broadcast and the feed is never shuffled. Beyond the bound both
    joins shuffle: the first after a map-side reduction to one row per
    (feed, id), so copies of one event never pile up in a task; the second
    salted by a row hash against a hot feed.
    """
    cur = _cursor_ids(cursors, feed_col)
    small = fits(cur, max_broadcast_bytes)
    ids = feed.select(F.col(feed_col), F.col(id_col).cast("string").alias(_CUR), F.col(order_col))
    newest = F.min(order_col) if newest_first else F.max(order_col)
    if small:
        matched = ids.join(F.broadcast(cur), [feed_col, _CUR], "inner")
    else:
        # Shuffle path: first reduce to one row per (feed, id) — copies of an
        # event combine map-side — then join; the join reuses that partitioning.
        per_id = ids.groupBy(feed_col, _CUR).agg(newest.alias(order_col))
        matched = per_id.join(cur, [feed_col, _CUR], "inner")
    hits = matched.groupBy(feed_col).agg(newest.alias(_HIT))
    joined = join_small(feed, hits, [feed_col], "left", small_fits=small)
    ahead = F.col(order_col) < F.col(_HIT) if newest_first else F.col(order_col) > F.col(_HIT)
    return joined.where(F.col(_HIT).isNull() | ahead).select(*[F.col(f"`{c}`") for c in feed.columns])


def advance_cursor(
    new_rows: DataFrame,
    cursors: DataFrame,
    feed_col: str = "feed",
    id_col: str = "event_id",
    order_col: str = "pos",
    newest_first: bool = True,
    new_etags: DataFrame | None = None,
) -> DataFrame:
    """Next cursor per feed: the newest new id, or the old cursor when nothing
    is new. Output: ``feed, etag, last_event_id`` (one row per feed in any
    input). ``new_etags`` (``feed, etag``), when given, replaces the stored
    etag of its feeds. Where the order is the id's own (``order_col`` is
    ``id_col``, increasing), a cursor never moves back: rows older than it, as
    in a batch out of order, leave it.

    Write it after the data it covers (data first, cursor after): a crash in
    between re-reads events, it never skips them.

    ``min_by``/``max_by`` combine map-side, so the newest id of a huge feed
    comes from one small row per task; all join sides have one row per feed.
    """
    pick = F.min_by if newest_first else F.max_by
    # Aggregate the id in its own type (a numeric id keeps a fixed-width,
    # hash-aggregated buffer); the text form is taken after the shuffle.
    newest = new_rows.groupBy(feed_col).agg(pick(F.col(id_col), F.col(order_col)).alias(_NEW))
    newest = newest.select(F.col(feed_col), F.col(_NEW).cast("string").alias(_NEW))
    old = cursors.select(
        F.col(feed_col),
        F.col("etag"),
        F.nullif(F.col("last_event_id").cast("string"), F.lit("")).alias("last_event_id"),
    )
    both = old.join(newest, [feed_col], "full_outer")
    etag = F.col("etag")
    if new_etags is not None:
        both = both.join(new_etags.select(F.col(feed_col), F.col("etag").alias("__etag")), [feed_col], "full_outer")
        etag = F.coalesce(F.col("__etag"), F.col("etag"))
    newer = F.col(_NEW)
    if order_col == id_col and not newest_first:
        kind = new_rows.schema[id_col].dataType
        newer = F.when(F.col("last_event_id").try_cast(kind) > F.col(_NEW).try_cast(kind), F.col("last_event_id")).otherwise(newer)
    return both.select(
        F.col(feed_col),
        etag.alias("etag"),
        F.coalesce(newer, F.col("last_event_id")).alias("last_event_id"),
    )


def ahead_of_cursor(
    rows: DataFrame,
    cursors: DataFrame,
    feed_col: str = "feed",
    id_col: str = "event_id",
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Rows newer than their feed's cursor, where ids increase: the test of
    ``new_since_last_seen`` for rows that come in any order and lack a list to
    walk, such as a stream's micro-batch. No cursor, or one that isn't an id of
    this type: all rows."""
    kind = rows.schema[id_col].dataType
    seen = _cursor_ids(cursors, feed_col).select(feed_col, F.col(_CUR).try_cast(kind).alias(_HIT))
    joined = join_small(rows, seen, [feed_col], "left", max_broadcast_bytes)
    return joined.where(F.col(_HIT).isNull() | (F.col(id_col) > F.col(_HIT))).select(*[F.col(f"`{c}`") for c in rows.columns])


def feed_fingerprints(
    feed: DataFrame,
    feed_col: str = "feed",
    id_col: str = "event_id",
    content_cols: Sequence[str] = (),
) -> DataFrame:
    """Content fingerprint per feed: ``feed, fingerprint``.

    MD5 of ``count:sum(hash(item))`` where the hash is 60 bits of the item's
    MD5 and the sum is exact (DECIMAL(38,0)). Order-free and computed by
    partial aggregation, so no feed is ever collected into one task. The item
    is the id, which suffices when an event never changes after publication;
    otherwise name the columns that may change in ``content_cols`` and the
    item becomes the JSON of the id with them (NULLs stay distinguishable).
    """
    item = F.col(id_col)
    if content_cols:
        item = F.to_json(F.struct(F.col(id_col), *[F.col(c) for c in content_cols]))
    agg = feed.groupBy(feed_col).agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum(id_hash(item)).alias("__h"),
    )
    fp = F.md5(F.concat_ws(":", F.col("__n").cast("string"), F.col("__h").cast("string")))
    return agg.select(F.col(feed_col), fp.alias("fingerprint"))


def changed_feeds(
    feed: DataFrame,
    previous: DataFrame,
    feed_col: str = "feed",
    id_col: str = "event_id",
    content_cols: Sequence[str] = (),
) -> DataFrame:
    """Compare each feed's fingerprint with the one stored from the last poll
    (``previous``: ``feed, fingerprint``); the conditional-request test.

    Output: ``feed, fingerprint, prev_fingerprint, changed``; a feed present on
    one side only is changed (a vanished feed has a NULL fingerprint).
    """
    cur = feed_fingerprints(feed, feed_col, id_col, content_cols)
    prev = previous.select(F.col(feed_col), F.col("fingerprint").alias("prev_fingerprint"))
    both = cur.join(prev, [feed_col], "full_outer")
    return both.select(
        F.col(feed_col),
        F.col("fingerprint"),
        F.col("prev_fingerprint"),
        (~F.col("fingerprint").eqNullSafe(F.col("prev_fingerprint"))).alias("changed"),
    )


def dedup_events(
    events: DataFrame,
    key: str = "event_id",
    first_by: Sequence[str] = ("kafka_ingest_ts",),
) -> DataFrame:
    """Batch removal of repeated events: one row per ``key``, the copy first
    by ``first_by`` (then by all other columns, so the pick is deterministic).

    One aggregation on the key: the minimum of the row as a struct ordered
    ``first_by`` first. It combines map-side, so a key repeated a billion
    times shrinks to one row per task before the shuffle, and each row is
    carried once in the aggregation buffer.
    """
    rest = [c for c in events.columns if c != key and c not in first_by]
    ordered = [*first_by, *rest]
    picked = events.groupBy(key).agg(F.min(F.struct(*[F.col(c) for c in ordered])).alias("__row"))
    return picked.select(F.col(key), *[F.col(f"__row.{c}").alias(c) for c in ordered]).select(*events.columns)


def dedup_events_stream(
    events: DataFrame,
    key: str = "event_id",
    time_col: str = "created_at",
    delay: str = "10 minutes",
) -> DataFrame:
    """Streaming removal of repeats within the event-time watermark.

    State holds each id until the watermark passes its time plus ``delay``;
    a repeat arriving later than that is older than the watermark and is
    dropped as late. Composes with the windowed aggregate in append mode.
    """
    return events.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])
