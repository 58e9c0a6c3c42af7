"""DataFrame → DataFrame operators; the same code serves batch and streams."""

from .parse import parse_events
from .quality import drop_reason, drop_reasons, observe_quality, validate
from .activity import closed_windows, event_type_counts, repo_activity
from .ingest import (
    advance_cursor,
    changed_feeds,
    dedup_events,
    dedup_events_stream,
    feed_fingerprints,
    new_since_last_seen,
)
from .health import health_report, health_status, partition_offsets, stream_health, topic_health
from .publish import to_messages, write_messages
from .asof import asof_join
from .intervals import interval_join
from .multiset import multiset_diff, surplus
from .ranking import ranked
from .rollup import finest, roll_up
from .sessions import click_purchases, user_sessions
from .sketches import estimates, merged, sketched

__all__ = [
    "parse_events",
    "validate",
    "drop_reason",
    "drop_reasons",
    "observe_quality",
    "repo_activity",
    "closed_windows",
    "event_type_counts",
    "new_since_last_seen",
    "advance_cursor",
    "feed_fingerprints",
    "changed_feeds",
    "dedup_events",
    "dedup_events_stream",
    "partition_offsets",
    "topic_health",
    "stream_health",
    "health_report",
    "health_status",
    "to_messages",
    "write_messages",
    "asof_join",
    "interval_join",
    "user_sessions",
    "click_purchases",
    "multiset_diff",
    "surplus",
    "ranked",
    "finest",
    "roll_up",
    "sketched",
    "merged",
    "estimates",
]
