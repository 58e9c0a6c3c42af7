"""run_all semantics with stand-in query handles (no Spark needed)."""

from __future__ import annotations

import pytest

from eventlake.streaming.sinks import run_all


class FakeQuery:
    def __init__(self, raises=None, error=None):
        self.raises, self.error, self.stopped, self.awaited = raises, error, False, False

    def awaitTermination(self, timeout=None):
        self.awaited = True
        if self.raises:
            raise self.raises
        return True

    def stop(self):
        self.stopped = True

    def exception(self):
        return self.error


def test_waits_for_all_then_raises_first_failure():
    a, b = FakeQuery(raises=RuntimeError("a failed")), FakeQuery()
    with pytest.raises(RuntimeError, match="a failed"):
        run_all([a, b])
    assert b.awaited and not b.stopped


def test_interrupt_stops_every_query():
    a, b = FakeQuery(raises=KeyboardInterrupt()), FakeQuery()
    with pytest.raises(KeyboardInterrupt):
        run_all([a, b])
    assert a.stopped and b.stopped and not b.awaited


def test_error_reported_by_query_state():
    a = FakeQuery(error="boom")
    with pytest.raises(RuntimeError, match="boom"):
        run_all([a])
