"""Extension: event-time windows over `events`. The same functions run on a stream (see tessera.streaming) and,
here, on the whole table at once."""

from __future__ import annotations

from tessera.plans.registry import query, table
from tessera.streaming import windows as wd


@query("stream_tumbling", "ITER-01", "SELECT event_type, epoch_us(ts) // 3600000000 AS hour, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def tumbling(spark, d):
    return wd.tumbling(table(spark, d, "events"), "ts", "1 hour", ["event_type"], "value")


@query("stream_sessions", "ITER-02", "WITH g AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 7200000000 THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t RANGE UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, min(t) AS start, count(*) AS n FROM s GROUP BY user_id, sid")
def sessions(spark, d):
    return wd.sessions(table(spark, d, "events"), "ts", "2 hours", ["user_id"])
