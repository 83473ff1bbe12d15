"""Event parsing, windows, sessions, dedup, sampling and change-log analyses
in batch form (PF5, PF9, PF14, SS1-SS3, SS9, SS13, SS17, SS18, SS20, SS25,
WI6-WI8, WI10, UD1-UD4, AG42)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import cents
from ..operators import events as ev
from ..operators.warehouse import undercount
from ..registry import register
from ..sources.fixtures import v_attempts, v_changes, v_events, v_spans
from ..sources.tables import Tables

EPOCH_TS = "TIMESTAMP '1970-01-01' + to_seconds({x})"


def _t(spark, sf):
    return Tables(spark, sf)


def raw_messages(t):
    """Message bodies as the producer publishes them (JSON text), with the
    malformed share of the reference's generator: truncated bodies, a
    missing required field, a wrongly typed amount, an unparsable time."""
    e = v_events(t)
    eid = F.col("event_id")
    body = F.to_json(F.struct(
        eid.cast("string").alias("event_id"), F.col("event_type"),
        F.when(eid % 89 != 0, F.col("tenant_id")).alias("tenant"),
        F.col("amount"),
        F.when(eid % 79 == 0, F.lit("not-a-time"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("event_time")))
    body = F.when(eid % 83 == 0, F.regexp_replace(body, r'"amount":[^,}]*', '"amount":"abc"')).otherwise(body)
    body = F.when(eid % 97 == 0, F.substring(body, 1, 20)).otherwise(body)
    return e.select(eid.alias("msg_id"), body.alias("raw"))


_EXPECTED = """x AS (SELECT event_id AS msg_id, event_type, tenant_id, amount, ts,
       CASE WHEN event_id % 97 = 0 THEN 'corrupt' WHEN event_id % 89 = 0 THEN 'missing_field'
            WHEN event_id % 83 = 0 THEN 'bad_amount' WHEN event_id % 79 = 0 THEN 'bad_time' END AS error
  FROM v_events)"""


@register("pf5_parse_events", f"""
WITH {_EXPECTED}
SELECT msg_id, CASE WHEN error = 'corrupt' THEN NULL ELSE CAST(msg_id AS VARCHAR) END AS event_id,
       CASE WHEN error IS NULL THEN event_type END AS event_type, CASE WHEN error IS NULL THEN tenant_id END AS tenant,
       CASE WHEN error IS NULL THEN amount END AS amount, CASE WHEN error IS NULL THEN ts END AS event_time, error
FROM x""")
def pf5(spark, sf):
    p = ev.parse_events(raw_messages(_t(spark, sf)))
    return p.select("msg_id", "event_id", "event_type", "tenant", "amount", "event_time", "error")


@register("ud2_tagged_outputs", f"""
WITH {_EXPECTED} SELECT coalesce(error, 'good') AS tag, count(*) AS n FROM x GROUP BY 1""")
def ud2(spark, sf):
    p = ev.parse_events(raw_messages(_t(spark, sf)))
    return p.groupBy(F.coalesce("error", F.lit("good")).alias("tag")).agg(F.count(F.lit(1)).alias("n"))


@register("pf14_schema_gate", """
SELECT event_id AS msg_id,
       CASE WHEN event_id % 97 = 0 THEN 'not_json' WHEN event_id % 89 = 0 THEN 'missing_key'
            WHEN event_id % 83 = 0 THEN 'wrong_type' END AS schema_reason,
       NOT (event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0) AS schema_ok
FROM events""")
def pf14(spark, sf):
    return ev.conforms(raw_messages(_t(spark, sf))).select("msg_id", "schema_reason", "schema_ok")


@register("pf9_payload_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def pf9(spark, sf):
    e = _t(spark, sf).events
    return e.select("event_id", ev.payload_field(e, "props", "$.k").alias("k"))


@register("ud1_element_function", """
SELECT event_id, unnest(json_keys(props)) AS payload_key FROM events""")
def ud1(spark, sf):
    return ev.payload_keys(_t(spark, sf).events, "props").select("event_id", "payload_key")


_SS1 = f"""w AS (SELECT {EPOCH_TS.format(x='CAST(floor(epoch(ts) / 60) * 60 AS BIGINT)')} AS window_start,
       {EPOCH_TS.format(x='CAST(floor(epoch(ts) / 60) * 60 + 60 AS BIGINT)')} AS window_end,
       CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS total, count(*) AS elements
  FROM v_events GROUP BY 1, 2)"""


@register("ss1_tumbling_window_sum", f"WITH {_SS1} SELECT * FROM w")
def ss1(spark, sf):
    return ev.tumbling_sum(v_events(_t(spark, sf)), "ts", cents("amount"), "60 seconds")


@register("ud3_window_labels", f"""
WITH {_SS1}
SELECT window_start, '[' || strftime(window_start, '%Y-%m-%d %H:%M:%S') || ', ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || ')' AS label, total
FROM w""")
def ud3(spark, sf):
    w = ev.tumbling_sum(v_events(_t(spark, sf)), "ts", cents("amount"), "60 seconds")
    return ev.window_labels(w).select("window_start", "label", "total")


@register("ud4_custom_combiner", f"""
SELECT {EPOCH_TS.format(x='CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT)')} AS window_start,
       CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM v_events GROUP BY 1""")
def ud4(spark, sf):
    return ev.custom_combine(v_events(_t(spark, sf)), "ts", "amount", "1 hour")


@register("ss2_sliding_window_sum", f"""
WITH s AS (SELECT CAST(floor(epoch(ts) / 60) * 60 AS BIGINT) - k * 60 AS st, amount
           FROM v_events, range(0, 5) r(k))
SELECT {EPOCH_TS.format(x='st')} AS window_start, {EPOCH_TS.format(x='st + 300')} AS window_end,
       CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS total, count(*) AS elements
FROM s GROUP BY st""")
def ss2(spark, sf):
    return ev.sliding_sum(v_events(_t(spark, sf)), "ts", cents("amount"), "300 seconds", "60 seconds")


_SESSIONS = """g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
              OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 21600000000
              THEN 1 ELSE 0 END AS st FROM v_events),
n AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sn FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS events
FROM n GROUP BY user_id, sn"""


@register("ss3_session_windows", f"WITH {_SESSIONS}")
def ss3(spark, sf):
    return ev.sessions_by_gap(v_events(_t(spark, sf)), "user_id", "ts", "event_id", 6 * 3600)


@register("wi10_sessionize_by_gap", f"WITH {_SESSIONS}")
def wi10(spark, sf):
    return ev.sessions_by_gap(v_events(_t(spark, sf)), "user_id", "ts", "event_id", 21600)


@register("ss9_dedup_first_copy", """
SELECT message_id, arg_min(attempt_id, (ts, attempt_id)) AS attempt_id, min(ts) AS ts, count(*) AS copies
FROM v_attempts GROUP BY message_id""")
def ss9(spark, sf):
    return ev.first_per_id(v_attempts(_t(spark, sf)), "message_id", ["ts", "attempt_id"], ["attempt_id", "ts"])


@register("ss13_delivery_quarantine", """
SELECT message_id, count(*) AS attempts, count(*) FILTER (WHERE NOT acked) AS failures, min(ts) AS first_publish,
       count(*) FILTER (WHERE NOT acked) >= 5 AS quarantined FROM v_attempts GROUP BY message_id""")
def ss13(spark, sf):
    return ev.delivery_quarantine(v_attempts(_t(spark, sf)), "message_id", "ts", "acked", 5)


@register("ss17_tail_sampling", """
WITH g AS (SELECT trace_id, count(*) FILTER (WHERE status = 'ERROR') AS e, max(duration_ms) AS m, count(*) AS spans
           FROM v_spans GROUP BY trace_id),
r AS (SELECT trace_id, spans, CASE WHEN e > 0 THEN 'error' WHEN m > 300 THEN 'slow'
                                   WHEN CAST(('0x' || substr(md5(CAST(trace_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 < 500 THEN 'sampled' END AS reason FROM g)
SELECT * FROM r WHERE reason IS NOT NULL""")
def ss17(spark, sf):
    return ev.tail_sample(v_spans(_t(spark, sf)), "trace_id", "status", "duration_ms", 300.0, 0.05)


@register("ss18_head_sampling", """
SELECT trace_id, count(*) AS spans, count(*) AS sampled_spans FROM v_spans
WHERE CAST(('0x' || substr(md5(CAST(trace_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 < 1000 GROUP BY trace_id""")
def ss18(spark, sf):
    s = ev.head_sample(v_spans(_t(spark, sf)), "trace_id", 0.1)
    g = s.groupBy("trace_id").agg(F.count(F.lit(1)).alias("spans"), F.count_if("sampled").alias("sampled_spans"))
    return g.where(F.col("sampled_spans") > 0)


@register("wi6_latest_version", """
SELECT id, max(version) AS version, arg_max(op, version) AS op, arg_max(payload, version) AS payload
FROM v_changes GROUP BY id""")
def wi6(spark, sf):
    return ev.latest_per_key(v_changes(_t(spark, sf)), "id", "version", ["op", "payload"])


@register("ss20_cdc_apply", """
SELECT id, version, payload FROM (
  SELECT id, max(version) AS version, arg_max(op, version) AS op, arg_max(payload, version) AS payload
  FROM v_changes GROUP BY id) WHERE op <> 'D'""")
def ss20(spark, sf):
    return ev.apply_changes(v_changes(_t(spark, sf)), "id", "version", "op", ["payload"])


@register("wi7_order_inversions", """
WITH l AS (SELECT ordering_key, message_id,
                  lag(message_id) OVER (PARTITION BY ordering_key ORDER BY ts, attempt_id) AS p FROM v_attempts)
SELECT ordering_key, count(*) AS messages, count(*) FILTER (WHERE message_id < p) AS inversions
FROM l GROUP BY ordering_key""")
def wi7(spark, sf):
    return ev.order_inversions(v_attempts(_t(spark, sf)), "ordering_key", "message_id", "ts", "attempt_id")


@register("wi8_inter_event_gap", """
SELECT event_id, user_id, ts,
       (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6 AS gap_s
FROM v_events""")
def wi8(spark, sf):
    return ev.inter_event_gap(v_events(_t(spark, sf)), "user_id", "ts", "event_id")


@register("ss25_processing_time_contrast", """
WITH e AS (SELECT date_trunc('hour', ts) AS window_start, count(*) AS n FROM v_events GROUP BY 1),
a AS (SELECT date_trunc('hour', ts + to_seconds(skew_s)) AS window_start, count(*) AS n FROM v_events GROUP BY 1)
SELECT coalesce(e.window_start, a.window_start) AS window_start, coalesce(e.n, 0) AS by_event_time,
       coalesce(a.n, 0) AS by_arrival_time, coalesce(e.n, 0) <> coalesce(a.n, 0) AS differs
FROM e FULL OUTER JOIN a ON e.window_start = a.window_start""")
def ss25(spark, sf):
    return ev.arrival_vs_event_windows(v_events(_t(spark, sf)), "ts", "skew_s")


@register("ag42_undercount", """
WITH t AS (SELECT CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS c,
                  CAST(sum(CAST(round(amount * 100) AS BIGINT)) FILTER (WHERE skew_s <= 300) AS BIGINT) AS d,
                  count(*) FILTER (WHERE skew_s > 300) AS dropped FROM v_events)
SELECT c / 100.0 AS counting_total, d / 100.0 AS dropping_total, dropped, round((c - d) / c * 100, 4) AS undercount_pct FROM t""")
def ag42(spark, sf):
    e = v_events(_t(spark, sf))
    return undercount(e, e.where(F.col("skew_s") <= 300), "amount")


@register("ss20b_cdc_cascade_children", """
WITH last AS (SELECT id, arg_max(op, version) AS op FROM v_changes GROUP BY id),
kids AS (SELECT l_orderkey % 1000 AS id, l_orderkey, l_linenumber FROM lineitem)
SELECT kids.id, count(*) AS children FROM kids
WHERE NOT EXISTS (SELECT 1 FROM last WHERE last.id = kids.id AND last.op = 'D') GROUP BY kids.id""")
def ss20b(spark, sf):
    t = _t(spark, sf)
    kids = t.lineitem.select((F.col("l_orderkey") % 1000).alias("id"), "l_orderkey", "l_linenumber")
    left = ev.cascade_deletes(kids, "id", v_changes(t), "id", "version", "op")
    return left.groupBy("id").agg(F.count(F.lit(1)).alias("children"))


@register("ag6b_skew_percentiles_approx")
def ag6b(spark, sf):
    from ..operators.warehouse import skew_percentiles_approx
    return skew_percentiles_approx(v_events(_t(spark, sf)), "skew_s")
