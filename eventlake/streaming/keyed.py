"""Per-feed state kept by the stream itself: the cursor and an idle alarm.

``data_then_cursor`` rewrites a cursor table after every batch. Here the cursor
is a value in the query's own state store: committed with the batch's offsets,
read by the key's task alone, and gone when the feed has been idle. What leaves
the query is a row for each move of a cursor and each idle feed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Sent to the Python workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEED_STATE = "newest long, last long"
FEED_EVENTS = "feed string, kind string, last_event_id string, rows long, at timestamp"
_BATCH = "feed string, ids array<long>, spans array<struct<first: long, last: long>>, until timestamp"
_EVENT = Row("feed", "kind", "last_event_id", "rows", "at")
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
CURSOR, IDLE = "cursor", "idle"
DEFAULT_DELAY = "10 minutes"


def merge_spans(spans: list[list[int]], idle: int) -> list[list[int]]:
    """Stretches of time (microseconds), in order; those at most ``idle`` apart
    become one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a - out[-1][1] <= idle:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def combine(idle: int):
    """Rows of a task to one row a feed and Arrow batch: its ids, and the
    stretches of its times. A hot feed shrinks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by([("feed", "ascending"), ("at", "ascending")])
            feeds, ids = table["feed"].to_pylist(), table["id"].to_pylist()
            at = pc.cast(table["at"], pa.int64()).to_pylist()
            found: dict = {}
            for f, i, t in zip(feeds, ids, at, strict=True):
                mine, spans = found.setdefault(f, ([], []))
                mine.append(i)
                if spans and t - spans[-1]["last"] <= idle:
                    spans[-1]["last"] = t
                else:
                    spans.append({"first": t, "last": t})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(found), pa.string()),
                    pa.array([x[0] for x in found.values()], pa.list_(pa.int64())),
                    pa.array([x[1] for x in found.values()], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                    pa.array([x[1][-1]["last"] for x in found.values()], pa.timestamp("us", "UTC")),
                ],
                names=["feed", "ids", "spans", "until"],
            )

    return run


class FeedState(StatefulProcessor):
    """A feed's newest id and last event time, until it has been idle.

    Feeds are many and have few rows in a batch, so what counts is the cost of a
    call: rows come and go as they are, without a data frame for each feed, and
    the state is asked once."""

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("feed", FEED_STATE)

    def close(self) -> None:
        pass

    def _row(self, feed: str, kind: str, last_event_id: int | None, rows: int, at: int) -> Row:
        return _EVENT(feed, kind, None if last_event_id is None else str(last_event_id), rows, EPOCH + timedelta(microseconds=at))

    def _millis(self, last: int) -> int:
        # timers have whole milliseconds; none fires before its time
        return -(-(last + self.idle) // 1000)

    def handleInputRows(self, key, rows, timerValues):
        feed = key[0]
        newest, last = self.state.get() or (None, None)
        taken, top, spans = 0, newest, [] if last is None else [[last, last]]
        for row in rows:
            ahead = [i for i in row["ids"] if i is not None and (newest is None or i > newest)]
            taken += len(ahead)
            if ahead:
                top = max(ahead) if top is None else max(top, max(ahead))
            spans = merge_spans(spans + [[s["first"], s["last"]] for s in row["spans"]], self.idle)
        end = spans[-1][1]
        if end != last:
            if last is not None:
                self.handle.deleteTimer(self._millis(last))
            self.handle.registerTimer(self._millis(end))
        if (top, end) != (newest, last):
            self.state.update((top, end))
        # a gap that the batch itself shows is an alarm whose timer is not needed any more
        for a, _ in zip(spans, spans[1:], strict=False):
            yield self._row(feed, IDLE, None, 0, a[1] + self.idle)
        if taken:
            yield self._row(feed, CURSOR, top, taken, end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.state.get()
        if held:
            newest, last = held
            self.state.clear()
            yield self._row(key[0], IDLE, newest, 0, last + self.idle)


def feed_events(events: DataFrame, idle_minutes: int, delay: str = DEFAULT_DELAY, feed_col: str = "feed", id_col: str = "id", time_col: str = "created_at") -> DataFrame:
    """A stream of what happens to each feed: ``feed, kind, last_event_id,
    rows, at``.

    ``cursor``: a micro-batch had ``rows`` events with an id above the feed's
    cursor, which now is ``last_event_id``; events behind it are not counted.
    ``idle``: no event for more than ``idle_minutes`` of event time after the
    last one; ``at`` is the last one plus that time. One alarm comes for every
    such gap, whether the next events show it or the watermark (``delay``
    behind the newest event of all feeds) passes its end. In the latter case
    ``last_event_id`` is the cursor and the feed leaves the state: ids seen
    later start a new one.

    Rows of a feed that are all behind the watermark are late and dropped. Rows
    without a feed, id or time are dropped. Needs the RocksDB state store
    (``stateful_settings(spark, "rocksdb", n)`` around the start).
    """
    idle = idle_minutes * 60_000_000
    if idle <= 0:
        raise ValueError("idle_minutes must be positive")
    slim = events.select(F.col(feed_col).cast("string").alias("feed"), F.col(id_col).cast("long").alias("id"), F.col(time_col).cast("timestamp").alias("at"))
    packed = slim.dropna().mapInArrow(combine(idle), _BATCH).withWatermark("until", delay)
    return packed.groupBy("feed").transformWithState(
        statefulProcessor=FeedState(idle), outputStructType=FEED_EVENTS, outputMode="Append", timeMode="EventTime"
    )
