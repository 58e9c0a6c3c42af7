"""Stream liveness as data: progress events become rows of a small table."""

from __future__ import annotations

import ast
import datetime as dt
import json
import threading
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..schemas import METRICS_SCHEMA, OFFSETS_SCHEMA, PROGRESS_SCHEMA


#: Monitoring tables beside a job's data: progress, drop counters, offsets.
MONITOR_TABLES = ("_progress", "_metrics", "_offsets")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _parse_ts(text: str | None) -> dt.datetime:
    if not text:
        return _now()
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00"))


class ProgressRecorder(StreamingQueryListener):
    """Listener that keeps one row per lifecycle event and micro-batch:
    started → ``PENDING``, progress or idle → ``RUNNING``, terminated →
    ``TERMINATED`` or ``FAILED``. Rows are metadata (one per batch), not data.

    ``to_df`` / ``append_to`` hand them to ``stream_health``.
    """

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._metrics: list[tuple] = []
        self._offsets: list[tuple] = []
        self._names: dict[str, str] = {}
        self._started = self._ended = 0
        self._lock = threading.Lock()

    def _add(self, qid: str, ts: dt.datetime, state: str, rows: int, late: int = 0) -> None:
        with self._lock:
            self._rows.append((self._names.get(qid, qid), ts, state, int(rows), int(late)))

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._names[str(event.id)] = event.name or str(event.id)
            self._started += 1
        self._add(str(event.id), _parse_ts(event.timestamp), "PENDING", 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in (p.stateOperators or []))
        self._add(str(p.id), _parse_ts(p.timestamp), "RUNNING", p.numInputRows, late)
        # observe() counters of this micro-batch (e.g. drop reasons)
        observed = p.observedMetrics or {}
        with self._lock:
            name = self._names.get(str(p.id), str(p.id))
            for s in p.sources or []:
                bounds = offset_bounds(s.description, s.startOffset, s.latestOffset) or offset_bounds(s.description, s.startOffset, s.endOffset)
                self._offsets += [(name, _parse_ts(p.timestamp), *b) for b in bounds]
            for metric_set, row in observed.items():
                for metric, value in row.asDict().items():
                    self._metrics.append((name, int(p.batchId), metric_set, metric, int(value or 0)))

    def onQueryIdle(self, event) -> None:
        self._add(str(event.id), _parse_ts(event.timestamp), "RUNNING", 0)

    def onQueryTerminated(self, event) -> None:
        state = "FAILED" if event.exception else "TERMINATED"
        self._add(str(event.id), _now(), state, 0)
        with self._lock:
            self._ended += 1

    def rows(self) -> list[tuple]:
        with self._lock:
            return list(self._rows)

    def wait_terminated(self, queries: int = 1, timeout: float = 60.0) -> bool:
        """Wait until ``queries`` terminations were recorded (listener events
        arrive asynchronously, after ``awaitTermination`` returns)."""
        end = time.monotonic() + timeout
        while True:
            with self._lock:
                done = sum(1 for r in self._rows if r[2] in ("TERMINATED", "FAILED"))
            if done >= queries or time.monotonic() >= end:
                return done >= queries
            time.sleep(0.05)

    def wait_idle(self, timeout: float = 30.0) -> bool:
        """Wait until every query that was seen to start was seen to end."""
        end = time.monotonic() + timeout
        while True:
            with self._lock:
                states = [r[2] for r in self._rows]
                open_ = self._started - self._ended
            if not open_ and states or time.monotonic() >= end:
                return not open_
            time.sleep(0.05)

    def metrics(self) -> list[tuple]:
        """``(query, batch_id, metric_set, metric, value)`` per micro-batch."""
        with self._lock:
            return list(self._metrics)

    def metrics_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.metrics(), METRICS_SCHEMA)

    def offsets(self) -> list[tuple]:
        """``(query, ts, topic, partition, low, high)`` per micro-batch."""
        with self._lock:
            return list(self._offsets)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), PROGRESS_SCHEMA)

    def _move(self, spark: SparkSession, kept: str, schema, path: str | None) -> int:
        """Append the rows kept under an attribute to a table, and forget them
        once they are written; rows that arrive meanwhile stay."""
        with self._lock:
            rows = list(getattr(self, kept))
        if rows and path:
            spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
        with self._lock:
            setattr(self, kept, getattr(self, kept)[len(rows) :])
        return len(rows)

    def append_to(self, spark: SparkSession, path: str, metrics_path: str | None = None, offsets_path: str | None = None) -> int:
        """Move the kept rows to the progress table at ``path``, and drop
        counters and offsets to theirs (call it on a schedule in long-running
        jobs, so driver memory stays bounded). What can't be written stays for
        the next call; counters and offsets without a table are forgotten."""
        moved = self._move(spark, "_rows", PROGRESS_SCHEMA, path)
        self._move(spark, "_metrics", METRICS_SCHEMA, metrics_path)
        self._move(spark, "_offsets", OFFSETS_SCHEMA, offsets_path)
        return moved


def _offset(text):
    """An offset from progress: JSON, or the text of a Python dict (as the
    Python listener has it)."""
    if not isinstance(text, str):
        return text
    try:
        return json.loads(text)
    except ValueError:
        try:
            return ast.literal_eval(text)
        except (ValueError, SyntaxError):
            return None


def offset_bounds(source: str, start, latest) -> list[tuple[str, int, int, int]]:
    """``(topic, partition, low, high)`` of a source's offsets as progress
    reports them: from where the batch began to the newest known. A broker's are
    by topic and partition; a file source counts its listings, as one partition
    of the source itself."""
    start, latest = _offset(start), _offset(latest)
    if not isinstance(latest, dict):
        return []
    if "logOffset" in latest:
        return [(source, 0, 0, int(latest["logOffset"]) + 1)]
    out = []
    for topic, parts in latest.items():
        if isinstance(parts, dict):
            began = start.get(topic, {}) if isinstance(start, dict) else {}
            out += [(topic, int(p), int(began.get(p, 0)), int(high)) for p, high in parts.items()]
    return out


@contextmanager
def recorded(spark: SparkSession, table_base: str, every: float = 60.0):
    """Record all stream queries of the session while the block runs: rows go
    to the monitoring tables under ``table_base`` every so many seconds, and
    once more at the end, also after a failure."""
    recorder = ProgressRecorder()
    paths = [f"{table_base.rstrip('/')}/{name}" for name in MONITOR_TABLES]
    done = threading.Event()

    def flush() -> None:
        while not done.wait(every):
            try:
                recorder.append_to(spark, *paths)
            except Exception:  # noqa: BLE001 - kept for the next time; the last write below raises
                continue

    spark.streams.addListener(recorder)
    worker = threading.Thread(target=flush, daemon=True)
    worker.start()
    try:
        yield recorder
    finally:
        recorder.wait_idle()
        done.set()
        worker.join()
        spark.streams.removeListener(recorder)
        recorder.append_to(spark, *paths)
