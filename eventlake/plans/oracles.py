"""DuckDB SQL equal to each registered query (same column names).

Tables are the pre-registered views over the test parquet files. The CTEs
restate the adapter (events → topic records) and the parse in SQL; on the
test table every message is well formed, so parsing reduces to projection.
"""

from __future__ import annotations

# Topic records of the events table, as the adapter builds them.
_RECORDS = """
records AS (
  SELECT json_object('id', event_id::VARCHAR, 'type', event_type,
                     'actor', json_object('login', 'user_' || user_id::VARCHAR),
                     'repo', json_object('name', 'org/repo_' || (user_id % 20)::VARCHAR),
                     'created_at', strftime(ts, '%Y-%m-%dT%H:%M:%SZ'))::VARCHAR AS raw_json,
         'events.raw' AS topic, (user_id % 3)::INTEGER AS "partition", event_id AS "offset",
         ts AS kafka_ingest_ts, event_id, ts, user_id, event_type
  FROM events)"""

_PARSED = (
    _RECORDS
    + """,
parsed AS (
  SELECT event_id::VARCHAR AS event_id, event_type, 'user_' || user_id::VARCHAR AS actor_login,
         'org/repo_' || (user_id % 20)::VARCHAR AS repo_name, date_trunc('second', ts) AS created_at,
         raw_json AS raw_payload, kafka_ingest_ts
  FROM records)"""
)

_VALIDATED = (
    _PARSED
    + """,
validated AS (
  SELECT * FROM parsed WHERE event_type IN ('click', 'view', 'purchase', 'signup'))"""
)

_ACTIVITY = (
    _VALIDATED
    + """,
activity AS (
  SELECT time_bucket(INTERVAL 5 MINUTES, created_at) AS window_start,
         time_bucket(INTERVAL 5 MINUTES, created_at) + INTERVAL 5 MINUTES AS window_end,
         repo_name, count(*) AS event_count,
         string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
  FROM validated GROUP BY ALL)"""
)

_CLOSED = (
    "WITH"
    + _ACTIVITY
    + """
SELECT * FROM activity
WHERE window_end <= (SELECT max(created_at) FROM validated) - INTERVAL 10 MINUTES"""
)

# Sessions: an event more than 30 minutes after the one before opens one.
_SESSIONS = (
    _VALIDATED
    + """,
opened AS (
  SELECT *, CASE WHEN created_at <= lag(created_at) OVER u + INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS opens
  FROM validated WINDOW u AS (PARTITION BY actor_login ORDER BY created_at, event_id::BIGINT)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY actor_login ORDER BY created_at, event_id::BIGINT ROWS UNBOUNDED PRECEDING) AS n FROM opened),
sessions AS (
  SELECT min(created_at) AS session_start, max(created_at) + INTERVAL 30 MINUTES AS session_end, actor_login,
         any_value(repo_name) AS repo_name, count(*) AS event_count, count(*) FILTER (WHERE event_type = 'purchase') AS purchases
  FROM numbered GROUP BY actor_login, n)"""
)
_SESSION_COLS = "session_start, session_end, actor_login, event_count, purchases"
_SESSIONS_CLOSED = (
    "WITH" + _SESSIONS + f"\nSELECT {_SESSION_COLS} FROM sessions WHERE session_end <= (SELECT max(created_at) FROM validated) - INTERVAL 10 MINUTES"
)

_CLICK_PURCHASES = (
    _VALIDATED
    + """,
pairs AS (
  SELECT c.actor_login, c.event_id AS click_id, c.created_at AS click_at, p.event_id AS purchase_id, p.created_at AS purchase_at
  FROM (SELECT * FROM validated WHERE event_type = 'click') c LEFT JOIN (SELECT * FROM validated WHERE event_type = 'purchase') p
    ON p.actor_login = c.actor_login AND p.created_at BETWEEN c.created_at AND c.created_at + INTERVAL 30 MINUTES)"""
)

_PARSED_COLS = "event_id, event_type, actor_login, repo_name, created_at, raw_payload, kafka_ingest_ts"


def _fingerprint(id_expr: str) -> str:
    """md5('count:sum of 60-bit id hashes'), the set fingerprint."""
    h = f"('0x' || substr(md5(({id_expr})::VARCHAR), 1, 15))::HUGEINT"
    return f"md5(count(*)::VARCHAR || ':' || sum({h})::VARCHAR)"


# Feeds of the events table: feed = user % 4, newest first by id.
_FEEDS = f"""
f AS (SELECT user_id % 4 AS feed, event_id, event_type, ts FROM events),
prev AS (SELECT * FROM f WHERE ts < TIMESTAMP '2024-01-20 00:00:00'),
cursors AS (
  SELECT feed, {_fingerprint('event_id')} AS etag, arg_max(event_id, event_id)::VARCHAR AS last_event_id
  FROM prev GROUP BY feed),
hits AS (
  SELECT f.feed, max(f.event_id) AS hit
  FROM f JOIN cursors c ON f.feed = c.feed AND f.event_id::VARCHAR = c.last_event_id
  GROUP BY f.feed),
new_rows AS (
  SELECT f.* FROM f LEFT JOIN hits h ON f.feed = h.feed
  WHERE h.hit IS NULL OR f.event_id > h.hit)"""

# Replay: events before 2024-01-20 were published once; those from 2024-01-15 on
# were published (again) a day later. One copy per id survives, the earliest
# ingest: the original where there is one, else the replayed copy.
_DEDUPED = "WITH" + _VALIDATED + """
SELECT event_id, event_type, actor_login, repo_name, created_at, raw_payload,
       CASE WHEN kafka_ingest_ts < TIMESTAMP '2024-01-20 00:00:00' THEN kafka_ingest_ts
            ELSE kafka_ingest_ts + INTERVAL 1 DAY END AS kafka_ingest_ts
FROM validated"""

# Expected parse outcome of each malformed form (see inputs.malformed_variants).
_MALFORMED = """WITH
e AS (SELECT date_trunc('second', ts) AS c,
             CASE WHEN event_type IN ('click', 'view', 'purchase', 'signup') THEN 'kept'
                  ELSE 'type_not_allowed' END AS by_type
      FROM events),
v AS (
  SELECT 'original' AS variant, by_type AS reason, c AS created, 1 AS actor FROM e
  UNION ALL SELECT 'numeric_id', by_type, c, 1 FROM e
  UNION ALL SELECT 'actor_text', by_type, c, 0 FROM e
  UNION ALL SELECT 'offset', by_type, c - INTERVAL 9 HOUR, 1 FROM e
  UNION ALL SELECT 'truncated', 'missing_event_id', NULL, 0 FROM e
  UNION ALL SELECT 'array', 'missing_event_id', NULL, 0 FROM e
  UNION ALL SELECT 'no_zone', 'bad_created_at', NULL, 1 FROM e
  UNION ALL SELECT 'fraction', 'bad_created_at', NULL, 1 FROM e)
SELECT variant, reason, count(*) AS "rows", min(created) AS created_min, max(created) AS created_max,
       sum(actor)::BIGINT AS with_actor
FROM v GROUP BY ALL"""

ORACLES: dict[str, str] = {
    "decode_records": "WITH" + _RECORDS + """
SELECT raw_json, topic, "partition", "offset", kafka_ingest_ts FROM records""",
    "parse_events": "WITH" + _PARSED + f"\nSELECT {_PARSED_COLS} FROM parsed",
    "event_messages": "WITH" + _RECORDS + "\nSELECT event_id::VARCHAR AS key, raw_json AS value FROM records",
    "validated_events": "WITH" + _VALIDATED + f"\nSELECT {_PARSED_COLS} FROM validated",
    "drop_reasons": "WITH" + _PARSED + """
SELECT CASE WHEN event_id IS NULL THEN 'missing_event_id'
            WHEN created_at IS NULL THEN 'bad_created_at'
            WHEN event_type IN ('click', 'view', 'purchase', 'signup') THEN 'kept'
            ELSE 'type_not_allowed' END AS reason,
       count(*) AS "rows"
FROM parsed GROUP BY ALL""",
    "malformed_messages": _MALFORMED,
    "repo_activity_5m": "WITH" + _ACTIVITY + "\nSELECT * FROM activity",
    "repo_activity_5m_closed_batch": _CLOSED,
    "repo_activity_5m_closed": _CLOSED,
    "repo_activity_5m_closed_multibatch": _CLOSED,
    "repo_activity_5m_from_events_v1": _CLOSED,
    "event_type_counts": "WITH" + _VALIDATED + """
SELECT event_type, count(*) AS cnt FROM validated GROUP BY event_type ORDER BY cnt DESC, event_type""",
    "topic_health": "WITH" + _RECORDS + """,
parts AS (SELECT topic, "partition", min("offset") AS low, max("offset") + 1 AS high
          FROM records GROUP BY topic, "partition")
SELECT topic, count(*) AS partitions, sum(greatest(0, high - low))::BIGINT AS messages FROM parts GROUP BY topic""",
    "health_report": "WITH" + _RECORDS + """,
parts AS (SELECT topic, "partition", min("offset") AS low, max("offset") + 1 AS high
          FROM records GROUP BY topic, "partition"),
t AS (SELECT coalesce(count(*), 0)::BIGINT AS partitions, coalesce(sum(greatest(0, high - low)), 0)::BIGINT AS messages
      FROM parts WHERE topic = 'events.raw')
SELECT 'topic_exists' AS "check", partitions::VARCHAR AS observed, partitions > 0 AS ok FROM t
UNION ALL
SELECT 'topic_has_messages', messages::VARCHAR, messages > 0 FROM t""",
    "health_report_with_stream": "WITH" + _RECORDS + """,
parts AS (SELECT topic, "partition", min("offset") AS low, max("offset") + 1 AS high
          FROM records GROUP BY topic, "partition"),
t AS (SELECT coalesce(count(*), 0)::BIGINT AS partitions, coalesce(sum(greatest(0, high - low)), 0)::BIGINT AS messages
      FROM parts WHERE topic = 'events.raw'),
m AS (SELECT unnest(['after_run', 'a_day_later', 'failed']) AS moment)
SELECT moment, 'topic_exists' AS "check", partitions::VARCHAR AS observed, partitions > 0 AS ok FROM t, m
UNION ALL
SELECT moment, 'topic_has_messages', messages::VARCHAR, messages > 0 FROM t, m
UNION ALL
SELECT moment, 'stream_running',
       CASE moment WHEN 'after_run' THEN 'TERMINATED' WHEN 'failed' THEN 'repo_activity_5m=FAILED'
            ELSE 'events_v1=TERMINATED,repo_activity_5m=TERMINATED' END, moment = 'after_run' FROM m""",
    "new_since_last_seen": "WITH" + _FEEDS + "\nSELECT feed, event_id, event_type, ts FROM new_rows",
    "new_since_last_seen_pages": "WITH" + _FEEDS + """
SELECT feed, event_id, event_type, ts,
       CASE WHEN rank < 100 THEN 1 ELSE (rank - 99) // 100 + 2 END::INTEGER AS page,
       CASE WHEN rank < 100 THEN rank ELSE (rank - 99) % 100 END::INTEGER AS idx
FROM (SELECT *, (SELECT max(event_id) FROM events) - event_id AS rank FROM new_rows)""",
    "feed_cursor": "WITH" + _FEEDS + f""",
newest AS (SELECT feed, arg_max(event_id, event_id)::VARCHAR AS new_id FROM new_rows GROUP BY feed),
etags AS (SELECT feed, {_fingerprint('event_id')} AS new_etag FROM f GROUP BY feed)
SELECT coalesce(c.feed, n.feed, e.feed) AS feed, coalesce(e.new_etag, c.etag) AS etag,
       coalesce(n.new_id, c.last_event_id) AS last_event_id
FROM cursors c FULL JOIN newest n ON c.feed = n.feed FULL JOIN etags e ON coalesce(c.feed, n.feed) = e.feed""",
    "changed_feeds": f"""WITH
d AS (SELECT strftime(ts, '%Y-%m-%d') AS feed, event_id, ts FROM events),
cur AS (SELECT feed, {_fingerprint('event_id')} AS fingerprint FROM d GROUP BY feed),
prev AS (SELECT feed, {_fingerprint('event_id')} AS prev_fingerprint
         FROM d WHERE ts < TIMESTAMP '2024-01-20 12:00:00' GROUP BY feed)
SELECT coalesce(cur.feed, prev.feed) AS feed, fingerprint, prev_fingerprint,
       fingerprint IS DISTINCT FROM prev_fingerprint AS changed
FROM cur FULL JOIN prev ON cur.feed = prev.feed""",
    # Both drain-then-stop queries end TERMINATED, after the first read every
    # event and the second every valid one from the first one's table.
    "stream_health": "WITH" + _VALIDATED + """,
q AS (SELECT 'events_v1' AS query, count(*) AS total_rows FROM events
      UNION ALL SELECT 'repo_activity_5m', count(*) FROM validated),
m AS (SELECT unnest(['after_run', 'a_day_later', 'failed']) AS moment)
SELECT moment, query, CASE WHEN failing THEN 'FAILED' ELSE 'TERMINATED' END AS state,
       moment <> 'a_day_later' AND NOT failing AS ok, total_rows
FROM (SELECT *, moment = 'failed' AND query = 'repo_activity_5m' AS failing FROM q, m)""",
    # Polls by one checkpoint: a poll's rows count unless their window had ended
    # 10 minutes before the latest time of the polls before it.
    "repo_activity_5m_late": "WITH" + _VALIDATED + """,
polled AS (SELECT *, CASE WHEN split_part(actor_login, '_', 2)::BIGINT % 10 = 0 THEN least(due + 1, 2) ELSE due END AS poll
           FROM (SELECT *, CASE WHEN created_at < TIMESTAMP '2024-01-10 00:00:00' THEN 0
                                WHEN created_at < TIMESTAMP '2024-01-20 00:00:00' THEN 1 ELSE 2 END AS due FROM validated)),
latest AS (SELECT p.poll, max(e.created_at) AS seen FROM (SELECT DISTINCT poll FROM polled) p JOIN polled e ON e.poll < p.poll GROUP BY p.poll),
kept AS (SELECT v.*, time_bucket(INTERVAL 5 MINUTES, created_at) AS window_start FROM polled v LEFT JOIN latest USING (poll)
         WHERE seen IS NULL OR time_bucket(INTERVAL 5 MINUTES, created_at) + INTERVAL 5 MINUTES > seen - INTERVAL 10 MINUTES)
SELECT window_start, window_start + INTERVAL 5 MINUTES AS window_end, repo_name, count(*) AS event_count,
       string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
FROM kept GROUP BY window_start, repo_name
HAVING window_start + INTERVAL 5 MINUTES <= (SELECT max(created_at) FROM polled) - INTERVAL 10 MINUTES""",
    # The same drop rules over the table (checked in order: id, time, type).
    "stream_drop_counts": """
SELECT 'input_rows' AS metric, count(*) AS "rows" FROM events
UNION ALL SELECT 'missing_event_id', count(*) FILTER (WHERE event_id IS NULL) FROM events
UNION ALL SELECT 'bad_created_at', count(*) FILTER (WHERE event_id IS NOT NULL AND ts IS NULL) FROM events
UNION ALL SELECT 'type_not_allowed', count(*) FILTER (
    WHERE event_id IS NOT NULL AND ts IS NOT NULL
      AND (event_type IS NULL OR event_type NOT IN ('click', 'view', 'purchase', 'signup'))) FROM events""",
    "stream_cursor": """
SELECT 'org/repo_' || (user_id % 20)::VARCHAR AS feed, NULL::VARCHAR AS etag, max(event_id)::VARCHAR AS last_event_id,
       count(*) AS "rows"
FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup') GROUP BY 1""",
    "dedup_events": _DEDUPED,
    "dedup_events_stream": _DEDUPED,
    "events_v1_stream": "WITH" + _VALIDATED + f"\nSELECT {_PARSED_COLS} FROM validated",
    "purchase_last_click": "WITH"
    + _VALIDATED
    + """,
p AS (SELECT actor_login, event_id AS purchase_id, created_at AS purchase_at FROM validated WHERE event_type = 'purchase'),
c AS (SELECT actor_login, created_at, max(event_id::BIGINT)::VARCHAR AS id FROM validated WHERE event_type = 'click' GROUP BY ALL)
SELECT p.*, CASE WHEN purchase_at <= c.created_at + INTERVAL 1 DAY THEN c.id END AS click_id,
       CASE WHEN purchase_at <= c.created_at + INTERVAL 1 DAY THEN c.created_at END AS click_at
FROM p ASOF LEFT JOIN c ON p.actor_login = c.actor_login AND p.purchase_at >= c.created_at""",
    "user_sessions": "WITH" + _SESSIONS + f"\nSELECT {_SESSION_COLS} FROM sessions",
    "user_sessions_batch_closed": _SESSIONS_CLOSED,
    "user_sessions_closed": _SESSIONS_CLOSED,
    "overlapping_sessions": "WITH"
    + _SESSIONS
    + """
SELECT a.repo_name, a.session_start AS one_start, a.session_end AS one_end, a.actor_login AS one_user,
       b.session_start AS other_start, b.session_end AS other_end, b.actor_login AS other_user
FROM sessions a JOIN sessions b ON a.repo_name = b.repo_name AND a.actor_login < b.actor_login
  AND a.session_start < b.session_end AND b.session_start < a.session_end""",
    "click_purchases": "WITH" + _CLICK_PURCHASES + "\nSELECT * FROM pairs",
    # a click alone comes once the watermark is past the last time a purchase could have
    "click_purchases_stream": "WITH"
    + _CLICK_PURCHASES
    + """,
mark AS (SELECT least(max(created_at) FILTER (WHERE event_type = 'click'), max(created_at) FILTER (WHERE event_type = 'purchase')) - INTERVAL 10 MINUTES AS bound FROM validated)
SELECT * FROM pairs WHERE purchase_id IS NOT NULL OR click_at + INTERVAL 30 MINUTES < (SELECT bound FROM mark)""",
    "stream_cursor_state": """
SELECT 'org/repo_' || (user_id % 20)::VARCHAR AS feed, max(event_id)::VARCHAR AS last_event_id, count(*) AS "rows"
FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup') GROUP BY 1""",
    "idle_users_stream": "WITH"
    + _VALIDATED
    + """,
gaps AS (SELECT actor_login, created_at, lead(created_at) OVER (PARTITION BY actor_login ORDER BY created_at) AS later FROM validated)
SELECT actor_login AS feed, created_at + INTERVAL 1 DAY AS idle_at FROM gaps
WHERE later > created_at + INTERVAL 1 DAY
   OR later IS NULL AND created_at + INTERVAL 1 DAY <= (SELECT max(created_at) FROM validated) - INTERVAL 10 MINUTES""",
    "type_sketches": """
SELECT event_type, count(*) AS "rows", count(DISTINCT user_id) AS users,
       true AS users_close, true AS quantiles_close, true AS top_close
FROM events GROUP BY event_type""",
    "event_cube": "WITH"
    + _VALIDATED
    + """
SELECT day, repo_name, event_type, grouping(day, repo_name, event_type) AS grouping_id,
       count(*) AS event_count, min(created_at) AS first_at, max(created_at) AS last_at
FROM (SELECT *, strftime(created_at, '%Y-%m-%d') AS day FROM validated)
GROUP BY GROUPING SETS ((day, repo_name, event_type), (day, event_type), (repo_name, event_type), (day), (event_type), ())""",
    "ranked_events": """
SELECT event_id, event_type, hour, cents, row_number() OVER w AS row_number,
       rank() OVER (PARTITION BY event_type ORDER BY hour NULLS FIRST) AS rank,
       (sum(cents) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT AS running_cents
FROM (SELECT event_id, event_type, date_trunc('hour', ts) AS hour, round(value * 100)::BIGINT AS cents FROM events)
WINDOW w AS (PARTITION BY event_type ORDER BY hour NULLS FIRST, event_id NULLS FIRST)""",
    "replay_audit": "WITH"
    + _PARSED
    + """,
polls AS (SELECT * FROM parsed WHERE created_at < TIMESTAMP '2024-01-20 00:00:00'
          UNION ALL SELECT * FROM parsed WHERE created_at >= TIMESTAMP '2024-01-15 00:00:00'),
both_sides AS (SELECT event_id, event_type, actor_login, repo_name, created_at, 1 AS l FROM parsed
               UNION ALL SELECT event_id, event_type, actor_login, repo_name, created_at, 0 FROM polls)
SELECT event_id, event_type, actor_login, repo_name, created_at, sum(l)::BIGINT AS n_left, sum(1 - l)::BIGINT AS n_right
FROM both_sides GROUP BY ALL HAVING sum(l) <> sum(1 - l)""",
    "repo_activity_5m_updates": "WITH" + _ACTIVITY + "\nSELECT * FROM activity",
}
