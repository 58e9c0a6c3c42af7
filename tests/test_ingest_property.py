"""Property test: the table form of "new since last seen" equals walking
each newest-first list and stopping at the first known id."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventlake.operators.ingest import advance_cursor, new_since_last_seen
from eventlake.schemas import CURSOR_SCHEMA

ids = st.integers(min_value=0, max_value=12).map(str)
feed = st.lists(ids, max_size=15)
cursor = st.one_of(st.none(), st.just(""), ids, st.just("999"))
feeds = st.lists(st.tuples(feed, cursor, st.booleans()), min_size=1, max_size=12)


def walk(items, last):
    if not last:
        return list(items)
    out = []
    for x in items:
        if x == last:
            break
        out.append(x)
    return out


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(feeds)
def test_new_since_last_seen_matches_walk(spark, data):
    rows, curs = [], []
    for f, (items, last, has_cursor_row) in enumerate(data):
        rows += [(str(f), pos, eid) for pos, eid in enumerate(items)]
        if has_cursor_row:
            curs.append((str(f), None, last))
    feed_df = spark.createDataFrame(rows, "feed string, pos long, event_id string")
    cur_df = spark.createDataFrame(curs, CURSOR_SCHEMA)
    new = new_since_last_seen(feed_df, cur_df)
    got = {}
    for r in new.collect():
        got.setdefault(r.feed, []).append((r.pos, r.event_id))
    nxt = {r.feed: r.last_event_id for r in advance_cursor(new, cur_df).collect()}
    for f, (items, last, has_cursor_row) in enumerate(data):
        expected = walk(items, last if has_cursor_row else None)
        assert [e for _, e in sorted(got.get(str(f), []))] == expected
        old = (last or None) if has_cursor_row else None
        want_next = expected[0] if expected else old
        assert nxt.get(str(f)) == want_next
