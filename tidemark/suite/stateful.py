"""Per-key stateful rules run as batch jobs over the fixture tables (SS4,
SS13-SS16, SS19).  The same rules run on streams (``tidemark.streaming``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import regeneration
from ..operators.events import count_firings, held_delivery
from ..operators.sequence import time_bucket
from ..registry import register
from ..sources.fixtures import v_attempts, v_calls, v_changes, v_events, v_requests
from ..sources.tables import Tables
from ..streaming import stateful as st


def _t(spark, sf):
    return Tables(spark, sf)


@register("ss4_count_trigger", """
WITH r AS (SELECT tenant_id, row_number() OVER (PARTITION BY tenant_id ORDER BY ts, event_id) AS rn,
                  sum(CAST(round(amount * 100) AS BIGINT)) OVER (PARTITION BY tenant_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS c
           FROM v_events)
SELECT tenant_id, rn AS fired_at_count, CAST(c AS DOUBLE) / 100 AS running_total FROM r WHERE rn % 100 = 0""")
def ss4(spark, sf):
    e = v_events(_t(spark, sf)).select("tenant_id", "ts", "event_id", "amount")
    return count_firings(e, "tenant_id", ["ts", "event_id"], "amount", 100, time_bucket("ts"))


@register("ss13_delivery_attempts_stateful", """
WITH o AS (SELECT message_id, ts, acked, row_number() OVER (PARTITION BY message_id ORDER BY ts, attempt_id) AS pos,
                  CAST(sum(CASE WHEN acked THEN 0 ELSE 1 END) OVER (PARTITION BY message_id ORDER BY ts, attempt_id
                       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fails,
                  min(ts) OVER (PARTITION BY message_id) AS first_publish FROM v_attempts),
d AS (SELECT message_id, min(pos) FILTER (WHERE acked AND fails < 5) AS k, min(pos) FILTER (WHERE NOT acked AND fails = 5) AS f5
      FROM o GROUP BY 1),
x AS (SELECT message_id, CASE WHEN k IS NOT NULL AND (f5 IS NULL OR k < f5) THEN k ELSE f5 END AS p,
             CASE WHEN k IS NOT NULL AND (f5 IS NULL OR k < f5) THEN 'delivered' ELSE 'dead_letter' END AS outcome
      FROM d WHERE k IS NOT NULL OR f5 IS NOT NULL)
SELECT x.message_id, outcome, o.pos AS attempts, o.fails AS failures, o.first_publish, o.ts AS decided_at
FROM x JOIN o ON x.message_id = o.message_id AND o.pos = x.p""")
def ss13s(spark, sf):
    a = v_attempts(_t(spark, sf)).select("message_id", "ts", "acked", "attempt_id")
    return st.apply_rule(a, ["message_id"], st.DeliveryAttempts(5))


@register("ss14_held_delivery", """
WITH o AS (SELECT ordering_key, message_id, ts, acked, attempt_id,
                  sum(CASE WHEN acked THEN 0 ELSE 1 END) OVER (PARTITION BY ordering_key, message_id ORDER BY ts, attempt_id
                      ROWS UNBOUNDED PRECEDING) AS fails FROM v_attempts),
m AS (SELECT ordering_key, message_id AS seq, min(ts) AS first_publish, min(ts) FILTER (WHERE acked AND fails < 5) AS won,
             min(ts) FILTER (WHERE NOT acked AND fails = 5) AS lost FROM o GROUP BY 1, 2),
d AS (SELECT ordering_key, seq, first_publish, coalesce(won, lost) AS decided_at,
             CASE WHEN won IS NOT NULL THEN 'processed' WHEN lost IS NOT NULL THEN 'dead_letter' END AS outcome FROM m),
r AS (SELECT *, max(decided_at) OVER w AS latest, count(*) FILTER (WHERE decided_at IS NULL) OVER w AS stuck FROM d
      WINDOW w AS (PARTITION BY ordering_key ORDER BY seq ROWS UNBOUNDED PRECEDING))
SELECT ordering_key, seq, first_publish, decided_at, outcome, CASE WHEN stuck = 0 THEN latest END AS released_at,
       CASE WHEN stuck = 0 THEN (epoch_us(latest) - epoch_us(decided_at)) / 1e6 END AS held_s FROM r""")
def ss14(spark, sf):
    a = v_attempts(_t(spark, sf)).select("ordering_key", F.col("message_id").alias("seq"), "acked", "ts", "attempt_id")
    return held_delivery(a, "ordering_key", "seq", "ts", "acked", "attempt_id", block=100)


# the rule row by row: the allowed times inside the window and the end of the ban
_RATE = """
WITH RECURSIVE o AS MATERIALIZED (SELECT tenant_id, request_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY tenant_id ORDER BY ts, request_id) AS rn
                                  FROM v_requests),
w AS (SELECT tenant_id, rn, request_id, [us] AS recent, CAST(NULL AS BIGINT) AS ban, CAST(NULL AS VARCHAR) AS reason FROM o WHERE rn = 1
  UNION ALL
  SELECT tenant_id, rn, request_id, CASE WHEN banned OR full_ THEN live ELSE list_append(live, us) END,
         CASE WHEN full_ AND NOT banned THEN us + 7200000000 ELSE ban END,
         CASE WHEN banned THEN 'banned' WHEN full_ THEN 'rate_exceeded' END
  FROM (SELECT *, len(live) >= 3 AS full_
        FROM (SELECT o.tenant_id, o.rn, o.request_id, o.us, w.ban, coalesce(o.us < w.ban, false) AS banned,
                     list_filter(w.recent, lambda t: t > o.us - 3600000000) AS live
              FROM w JOIN o ON o.tenant_id = w.tenant_id AND o.rn = w.rn + 1)))
SELECT tenant_id, request_id, CASE WHEN reason IS NULL THEN 'allow' ELSE 'deny' END AS decision, reason FROM w"""


def _requests(spark, sf):
    return v_requests(_t(spark, sf)).select("tenant_id", "ts", "request_id")


@register("ss15_rate_limit_ban", _RATE)
def ss15(spark, sf):
    return st.apply_rule(_requests(spark, sf), ["tenant_id"], st.RateLimit(limit=3, window_s=3600, ban_s=7200))


@register("ss15b_rate_limit_pieces", _RATE)
def ss15b(spark, sf):
    """SS15 with a client cut at pauses of the window and the ban."""
    return regeneration.rate_limit(_requests(spark, sf), "tenant_id", st.RateLimit(limit=3, window_s=3600, ban_s=7200))


# mode 0 closed, 1 open; from mode 1 a call after the cool-down is the trial
_BREAKER = """
WITH RECURSIVE o AS MATERIALIZED (SELECT option_name, call_id, epoch_us(ts) AS us, failed AS bad,
                                         row_number() OVER (PARTITION BY option_name ORDER BY ts, call_id) AS rn FROM v_calls),
w AS (SELECT option_name, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS call_id, 0 AS mode, CAST([] AS BIGINT[]) AS fails,
             CAST(NULL AS BIGINT) AS opened, '' AS state, CAST(NULL AS VARCHAR) AS transition FROM o WHERE rn = 1
  UNION ALL
  SELECT option_name, rn, call_id,
         CASE WHEN waits THEN 1 WHEN trial THEN CASE WHEN bad THEN 1 ELSE 0 END WHEN len(live) >= 5 THEN 1 ELSE 0 END,
         CASE WHEN waits THEN fails WHEN trial OR len(live) >= 5 THEN [] ELSE live END,
         CASE WHEN (trial AND bad) OR (NOT waits AND NOT trial AND len(live) >= 5) THEN us ELSE opened END,
         CASE WHEN waits THEN 'open' WHEN trial THEN 'half_open' ELSE 'closed' END,
         CASE WHEN trial AND bad THEN 'half_open->open' WHEN trial THEN 'half_open->closed'
              WHEN NOT waits AND len(live) >= 5 THEN 'closed->open' END
  FROM (SELECT o.*, w.fails, w.opened, w.mode = 1 AND o.us - w.opened < 1800000000 AS waits, w.mode = 1 AND o.us - w.opened >= 1800000000 AS trial,
               CASE WHEN bad THEN list_append(list_filter(w.fails, lambda t: t > o.us - 21600000000), o.us) ELSE CAST([] AS BIGINT[]) END AS live
        FROM w JOIN o ON o.option_name = w.option_name AND o.rn = w.rn + 1))
SELECT option_name, call_id, CASE WHEN state = 'open' THEN 'fallback' ELSE 'primary' END AS route, state, transition FROM w WHERE rn > 0"""


def _calls(spark, sf):
    return v_calls(_t(spark, sf)).select("option_name", "ts", "call_id", "failed")


@register("ss16_circuit_breaker", _BREAKER)
def ss16(spark, sf):
    return st.apply_rule(_calls(spark, sf), ["option_name"], st.CircuitBreaker(threshold=5, window_s=21600, cooldown_s=1800))


@register("ss16b_breaker_pieces", _BREAKER)
def ss16b(spark, sf):
    """SS16 with a dependency cut at pauses, each piece run from both states
    it can be entered in."""
    return regeneration.circuit_breaker(_calls(spark, sf), "option_name", st.CircuitBreaker(threshold=5, window_s=21600, cooldown_s=1800))


_VERSIONS = """
WITH RECURSIVE o AS MATERIALIZED (SELECT id, version AS change_id, payload, version // 1000 - CASE WHEN version % 7 = 0 THEN 1 ELSE 0 END AS e,
                                         row_number() OVER (PARTITION BY id ORDER BY commit_ts, version) AS rn FROM v_changes),
w AS (SELECT id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS change_id, false AS accepted, CAST(0 AS BIGINT) AS version, CAST(NULL AS DOUBLE) AS payload
      FROM o WHERE rn = 1
  UNION ALL
  SELECT o.id, o.rn, o.change_id, o.e = w.version, w.version + CASE WHEN o.e = w.version THEN 1 ELSE 0 END,
         CASE WHEN o.e = w.version THEN o.payload ELSE w.payload END
  FROM w JOIN o ON o.id = w.id AND o.rn = w.rn + 1)
SELECT id, change_id, accepted, version, payload FROM w WHERE rn > 0"""


def _changes(spark, sf):
    return v_changes(_t(spark, sf)).select(
        "id", F.col("commit_ts").alias("ts"), F.col("version").alias("change_id"), "payload",
        (F.floor(F.col("version") / 1000) - F.when(F.col("version") % 7 == 0, 1).otherwise(0)).cast("bigint").alias("expected_version"))


@register("ss19_versioned_upsert", _VERSIONS)
def ss19(spark, sf):
    return st.apply_rule(_changes(spark, sf), ["id"], st.VersionedUpsert())


@register("ss19b_version_chains", _VERSIONS)
def ss19b(spark, sf):
    """SS19 by the path of accepted changes instead of a row loop."""
    return regeneration.versioned_upsert(_changes(spark, sf), "id")
