"""Registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import Optional

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: Optional[str] = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its equivalent over the same tables."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


# The event log of ``event_log.event_messages`` in SQL, headers as columns.
LOG_SQL = """
log AS (
  SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS part, event_id AS off, ts,
         event_type, value,
         CASE event_id % 5 WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN 'abc' WHEN 4 THEN '7' END
           AS h_attempt,
         CASE WHEN event_id % 5 IN (1, 2) THEN 'events.src' END AS h_topic,
         CASE WHEN event_id % 5 IN (1, 2)
              THEN strftime(ts + to_minutes(event_id % 120), '%Y-%m-%dT%H:%M:%SZ') END AS h_time,
         CASE event_id % 5 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 4 THEN 7 ELSE 0 END AS attempts,
         CASE WHEN event_id % 50 = 0 THEN unhex('00FFFE') ELSE encode(props) END AS payload,
         event_type <> 'error' AS ok,
         CASE WHEN event_type = 'error' THEN 'bad event ' || event_id END AS error
  FROM events
)"""

# Retry routing of its failures: three attempts, one second doubling up to thirty.
ROUTED_SQL = LOG_SQL + """,
routed AS (
  SELECT *, attempts + 1 AS attempt,
         CASE WHEN attempts + 1 >= 3 THEN 'dlq' ELSE 'retry' END AS route,
         CAST(least(30000, 1000 * pow(2, attempts)) AS BIGINT) AS delay_ms,
         coalesce(h_topic, topic) AS orig_topic
  FROM log WHERE NOT ok
)"""

NUMBERED_SQL = LOG_SQL + """,
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY off) AS rn FROM log
)"""

# Count-or-time batches: five rows or twenty minutes.
BATCHES_SQL = NUMBERED_SQL + """,
walk AS (
  SELECT part, off, rn, ts AS first_ts, CAST(0 AS BIGINT) AS batch_id, 1 AS held
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT part, off, rn,
         CASE WHEN fresh THEN ts ELSE first_ts END,
         CASE WHEN fresh THEN batch_id + 1 ELSE batch_id END,
         CASE WHEN fresh THEN 1 ELSE held + 1 END
  FROM (SELECT m.part, m.off, m.rn, m.ts, w.first_ts, w.batch_id, w.held,
               w.held >= 5 OR m.ts - w.first_ts >= INTERVAL 20 MINUTE AS fresh
        FROM walk w JOIN numbered m ON m.part = w.part AND m.rn = w.rn + 1)
)"""

# Breaker replay: two failures, thirty minutes, two successes.
BREAKER_SQL = NUMBERED_SQL + """,
walk AS (
  SELECT DISTINCT part, CAST(0 AS BIGINT) AS rn, 'closed' AS state_before, 'closed' AS state,
         CAST(0 AS BIGINT) AS failures, CAST(0 AS BIGINT) AS successes,
         TIMESTAMP '2000-01-01' AS opened, '' AS action
  FROM numbered
  UNION ALL
  SELECT part, rn, state_before,
         CASE action WHEN 'tripped' THEN 'open' WHEN 'reopened' THEN 'open'
                     WHEN 'probe' THEN 'half-open' WHEN 'closed' THEN 'closed'
                     ELSE state_before END,
         CASE WHEN action IN ('continue', 'tripped') THEN failures + 1
              WHEN action IN ('reopened', 'closed') THEN 0
              WHEN action = 'ok' AND state_before = 'closed' THEN 0
              ELSE failures END,
         CASE WHEN action = 'ok' AND state_before = 'half-open' THEN successes + 1 ELSE 0 END,
         CASE WHEN action IN ('tripped', 'reopened') THEN ts ELSE opened END,
         action
  FROM (SELECT m.part, m.rn, m.ts, w.state AS state_before, w.failures, w.successes, w.opened,
               CASE WHEN w.state = 'closed' AND NOT m.ok
                      THEN CASE WHEN w.failures + 1 >= 2 THEN 'tripped' ELSE 'continue' END
                    WHEN w.state = 'open' AND NOT m.ok
                      THEN CASE WHEN m.ts - w.opened >= INTERVAL 30 MINUTE THEN 'probe' ELSE 'rejected' END
                    WHEN w.state = 'half-open' AND NOT m.ok THEN 'reopened'
                    WHEN w.state = 'half-open' AND w.successes + 1 >= 2 THEN 'closed'
                    ELSE 'ok' END AS action
        FROM walk w JOIN numbered m ON m.part = w.part AND m.rn = w.rn + 1)
),
breaker_log AS (
  SELECT m.*, w.state_before, w.state AS state_after, w.failures, w.successes, w.action,
         w.action IN ('tripped', 'rejected', 'reopened') AS fatal
  FROM walk w JOIN numbered m ON m.part = w.part AND m.rn = w.rn
)"""


def long_cooldown_sql(sql: str) -> str:
    """The same SQL where all but error events fail and a breaker stays open for two days."""
    changed = sql.replace("event_type <> 'error' AS ok", "event_type = 'error' AS ok").replace(
        "INTERVAL 30 MINUTE", "INTERVAL 2 DAY"
    )
    if changed.count("INTERVAL 2 DAY") != 1 or "event_type = 'error' AS ok" not in changed:
        raise ValueError("the outcome and the cooldown are named in one place")
    return changed


#: The slice of the growing log that a message comes in, by its offset.
SLICED_SQL = LOG_SQL + """,
bounds AS (SELECT min(off) AS low, max(off) + 1 - min(off) AS width FROM log),
sliced AS (
  SELECT log.*, CASE WHEN off >= low + 3 * width // 4 THEN 3 WHEN off >= low + 2 * width // 4 THEN 2
                     WHEN off >= low + width // 4 THEN 1 ELSE 0 END AS slice
  FROM log, bounds
)"""


def redelivered_sql(sql: str) -> str:
    """The same SQL over a log in which every tenth message is delivered twice."""
    once, twice = "FROM log\n)", "FROM (SELECT * FROM log UNION ALL SELECT * FROM log WHERE off % 10 = 0)\n)"
    if sql.count(once) != 1:
        raise ValueError("the numbered log is read in one place")
    return sql.replace(once, twice)
