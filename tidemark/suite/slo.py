"""Observability, SLO and drill analyses (PF8, PF11, AG44-AG50, AG55-AG59,
AG65-AG68, WI3-WI5, SS23)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import slo
from ..operators.sequence import rank_values
from ..registry import register
from ..sources.fixtures import v_attempts, v_events, v_logs, v_probes, v_requests
from ..sources.tables import Tables

GOOD = "status IS NOT NULL AND (status < 500 OR status >= 600)"
BAD = "status IS NOT NULL AND NOT (status < 500 OR status >= 600)"
SEV = ("CASE severity WHEN 'DEFAULT' THEN 0 WHEN 'DEBUG' THEN 100 WHEN 'INFO' THEN 200 WHEN 'NOTICE' THEN 300 "
       "WHEN 'WARNING' THEN 400 WHEN 'ERROR' THEN 500 WHEN 'CRITICAL' THEN 600 WHEN 'ALERT' THEN 700 "
       "WHEN 'EMERGENCY' THEN 800 END")
EPOCH_TS = "TIMESTAMP '1970-01-01' + to_seconds({x})"


def _t(spark, sf):
    return Tables(spark, sf)


@register("pf8_severity_filter", f"SELECT log_id, severity, tenant_id FROM v_logs WHERE {SEV} >= 400")
def pf8(spark, sf):
    return slo.severity_filter(v_logs(_t(spark, sf)), "WARNING").select("log_id", "severity", "tenant_id")


@register("pf11_good_event_predicate", f"""
SELECT endpoint, count(*) FILTER (WHERE status IS NOT NULL) AS valid, count(*) FILTER (WHERE {GOOD}) AS good,
       count(*) FILTER (WHERE status BETWEEN 200 AND 299 AND latency_ms <= 300) AS latency_good
FROM v_requests GROUP BY endpoint""")
def pf11(spark, sf):
    g = slo.good_events(v_requests(_t(spark, sf)))
    return g.groupBy("endpoint").agg(F.count_if("valid").alias("valid"), F.count_if("good").alias("good"),
                                     F.count_if("latency_good").alias("latency_good"))


@register("ag44_top_error_codes", """
SELECT error_code, count(*) AS n FROM v_logs WHERE error_code IS NOT NULL GROUP BY 1 ORDER BY n DESC, error_code LIMIT 10""")
def ag44(spark, sf):
    return slo.top_error_codes(v_logs(_t(spark, sf)))


@register("ag45_tenant_error_rate", """
WITH e AS (SELECT tenant_id, count(*) AS errors FROM v_logs WHERE severity = 'ERROR' GROUP BY 1),
r AS (SELECT tenant_id, count(*) AS requests FROM v_requests GROUP BY 1),
j AS (SELECT r.tenant_id, requests, coalesce(errors, 0) AS errors, coalesce(errors, 0) / requests AS error_rate
      FROM r LEFT JOIN e ON r.tenant_id = e.tenant_id)
SELECT *, error_rate = (SELECT max(error_rate) FROM j) AS noisiest FROM j""")
def ag45(spark, sf):
    t = _t(spark, sf)
    return slo.tenant_error_rate(v_logs(t), v_requests(t))


@register("ag46_first_seen", """
SELECT error_code, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM v_logs
WHERE error_code IS NOT NULL GROUP BY 1""")
def ag46(spark, sf):
    return slo.first_seen(v_logs(_t(spark, sf)))


@register("ag47_minute_latency", """
WITH r AS (SELECT date_trunc('minute', ts) AS minute, latency_ms,
                  row_number() OVER (PARTITION BY date_trunc('minute', ts) ORDER BY latency_ms) AS rn,
                  count(*) OVER (PARTITION BY date_trunc('minute', ts)) AS n FROM v_requests)
SELECT minute, max(n) AS requests, CAST(max(n) AS DOUBLE) / 60 AS req_per_s,
       max(latency_ms) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.5) AS BIGINT))) AS p50_ms,
       max(latency_ms) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.99) AS BIGINT))) AS p99_ms
FROM r GROUP BY minute""")
def ag47(spark, sf):
    return slo.minute_latency(v_requests(_t(spark, sf)))


@register("ag48_daily_slis", f"""
WITH r AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE status IS NOT NULL) AS valid,
                  count(*) FILTER (WHERE {GOOD}) AS good,
                  count(*) FILTER (WHERE status BETWEEN 200 AND 299 AND latency_ms <= 300) AS lg
           FROM v_requests GROUP BY 1),
f AS (SELECT CAST(ts AS DATE) AS day, count(*) AS events, count(*) FILTER (WHERE skew_s <= 60) AS fresh FROM v_events GROUP BY 1)
SELECT coalesce(r.day, f.day) AS day, valid, good / valid AS availability_sli, lg / valid AS latency_sli,
       fresh / events AS freshness_sli
FROM r FULL OUTER JOIN f ON r.day = f.day""")
def ag48(spark, sf):
    t = _t(spark, sf)
    return slo.daily_slis(v_requests(t), v_events(t))


@register("ag49_good_minutes_sli", """
WITH m AS (SELECT date_trunc('minute', ts) AS m, count(*) AS n, count(*) FILTER (WHERE status >= 500) AS e
           FROM v_requests GROUP BY 1)
SELECT CAST(m AS DATE) AS day, count(*) AS minutes, count(*) FILTER (WHERE e / n < 0.01) AS good_minutes,
       count(*) FILTER (WHERE e / n < 0.01) / count(*) AS good_minute_sli FROM m GROUP BY 1""")
def ag49(spark, sf):
    return slo.good_minutes_sli(v_requests(_t(spark, sf)))


@register("ag50_error_budget", f"""
WITH g AS (SELECT tenant_id, count(*) FILTER (WHERE status IS NOT NULL) AS valid, count(*) FILTER (WHERE {BAD}) AS bad
           FROM v_requests WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-29' GROUP BY 1),
c AS (SELECT *, valid * CAST(0.001 AS DOUBLE) AS allowed_bad FROM g),
u AS (SELECT *, bad / allowed_bad AS budget_used, (bad / valid) / CAST(0.001 AS DOUBLE) AS burn_rate FROM c)
SELECT tenant_id, valid, bad, allowed_bad, budget_used, burn_rate,
       CASE WHEN burn_rate > 0 THEN CAST(28.0 AS DOUBLE) / burn_rate END AS days_to_exhaustion,
       CASE WHEN burn_rate > 0 THEN greatest(CAST(0 AS DOUBLE), CAST(28.0 AS DOUBLE) * (1 - budget_used) / burn_rate) END AS days_left,
       CASE WHEN budget_used >= 1.0 THEN 'exhausted' WHEN budget_used >= 0.9 THEN 'freeze'
            WHEN budget_used >= 0.75 THEN 'slow_down' WHEN budget_used >= 0.5 THEN 'review' ELSE 'ok' END AS policy
FROM u""")
def ag50(spark, sf):
    return slo.error_budget(v_requests(_t(spark, sf)), "tenant_id", 0.999, 28, "2024-01-01", "2024-01-29")


_BURN_SQL = f"""b AS (SELECT endpoint, CAST(floor(epoch(ts) / 300) * 300 AS BIGINT) AS bucket_epoch,
                  count(*) FILTER (WHERE status IS NOT NULL) AS valid, count(*) FILTER (WHERE {BAD}) AS bad
           FROM v_requests GROUP BY 1, 2),
br AS (SELECT endpoint, bucket_epoch, valid, bad,
       (sum(bad) OVER (PARTITION BY endpoint ORDER BY bucket_epoch RANGE BETWEEN 0 PRECEDING AND CURRENT ROW)
        / sum(valid) OVER (PARTITION BY endpoint ORDER BY bucket_epoch RANGE BETWEEN 0 PRECEDING AND CURRENT ROW)) / CAST(0.001 AS DOUBLE) AS burn_300s,
       (sum(bad) OVER (PARTITION BY endpoint ORDER BY bucket_epoch RANGE BETWEEN 1500 PRECEDING AND CURRENT ROW)
        / sum(valid) OVER (PARTITION BY endpoint ORDER BY bucket_epoch RANGE BETWEEN 1500 PRECEDING AND CURRENT ROW)) / CAST(0.001 AS DOUBLE) AS burn_1800s,
       (sum(bad) OVER (PARTITION BY endpoint ORDER BY bucket_epoch RANGE BETWEEN 3300 PRECEDING AND CURRENT ROW)
        / sum(valid) OVER (PARTITION BY endpoint ORDER BY bucket_epoch RANGE BETWEEN 3300 PRECEDING AND CURRENT ROW)) / CAST(0.001 AS DOUBLE) AS burn_3600s,
       (sum(bad) OVER (PARTITION BY endpoint ORDER BY bucket_epoch RANGE BETWEEN 21300 PRECEDING AND CURRENT ROW)
        / sum(valid) OVER (PARTITION BY endpoint ORDER BY bucket_epoch RANGE BETWEEN 21300 PRECEDING AND CURRENT ROW)) / CAST(0.001 AS DOUBLE) AS burn_21600s,
       (sum(bad) OVER (PARTITION BY endpoint ORDER BY bucket_epoch RANGE BETWEEN 258900 PRECEDING AND CURRENT ROW)
        / sum(valid) OVER (PARTITION BY endpoint ORDER BY bucket_epoch RANGE BETWEEN 258900 PRECEDING AND CURRENT ROW)) / CAST(0.001 AS DOUBLE) AS burn_259200s,
       {EPOCH_TS.format(x='bucket_epoch')} AS bucket_start
       FROM b)"""


@register("wi3_trailing_burn_rate", f"WITH {_BURN_SQL} SELECT * FROM br")
def wi3(spark, sf):
    return slo.burn_rates(v_requests(_t(spark, sf)), "endpoint", 0.999)


@register("wi4_multiwindow_alerts", f"""
WITH {_BURN_SQL}
SELECT endpoint, bucket_start, 'PAGE_FAST' AS alert FROM br WHERE burn_3600s > 14.4 AND burn_300s > 14.4
UNION ALL SELECT endpoint, bucket_start, 'PAGE_SLOW' FROM br WHERE burn_21600s > 6.0 AND burn_1800s > 6.0
UNION ALL SELECT endpoint, bucket_start, 'TICKET' FROM br WHERE burn_259200s > 1.0 AND burn_21600s > 1.0""")
def wi4(spark, sf):
    return slo.multiwindow_alerts(slo.burn_rates(v_requests(_t(spark, sf)), "endpoint", 0.999), "endpoint")


@register("wi4b_alert_episodes", f"""
WITH {_BURN_SQL},
al AS (SELECT endpoint, bucket_start, 'PAGE_FAST' AS alert FROM br WHERE burn_3600s > 14.4 AND burn_300s > 14.4
       UNION ALL SELECT endpoint, bucket_start, 'PAGE_SLOW' FROM br WHERE burn_21600s > 6.0 AND burn_1800s > 6.0
       UNION ALL SELECT endpoint, bucket_start, 'TICKET' FROM br WHERE burn_259200s > 1.0 AND burn_21600s > 1.0),
n AS (SELECT *, CASE WHEN bucket_start - lag(bucket_start) OVER (PARTITION BY endpoint, alert ORDER BY bucket_start)
                          <= INTERVAL 2100 SECOND THEN 0 ELSE 1 END AS new FROM al),
e AS (SELECT *, sum(new) OVER (PARTITION BY endpoint, alert ORDER BY bucket_start) AS episode FROM n)
SELECT endpoint, alert, min(bucket_start) AS opened_at, max(bucket_start) + INTERVAL 2100 SECOND AS closed_at,
       count(*) AS open_buckets FROM e GROUP BY endpoint, alert, episode""")
def wi4b(spark, sf):
    burn = slo.burn_rates(v_requests(_t(spark, sf)), "endpoint", 0.999)
    return slo.alert_episodes(slo.multiwindow_alerts(burn, "endpoint"), "endpoint")


_WI5_SQL = """p AS (SELECT seq, ts, ok, lag(ok) OVER (ORDER BY seq) AS pok FROM v_probes),
s AS (SELECT *, max(CASE WHEN pok IS NULL OR pok <> ok THEN seq END) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) AS isl FROM p),
q AS (SELECT *, row_number() OVER (PARTITION BY isl ORDER BY seq) AS pos FROM s),
f AS (SELECT seq, ts, ok, lag(ok) OVER (ORDER BY seq) AS before FROM q WHERE pos = 3),
t AS (SELECT seq, ts, ok FROM f WHERE coalesce(before <> ok, NOT ok)),
n AS (SELECT *, lead(seq) OVER (ORDER BY seq) AS recover_seq, lead(ts) OVER (ORDER BY seq) AS recover_ts FROM t),
inc AS (SELECT seq AS impact_seq, ts AS impact_ts, recover_seq, recover_ts, (epoch_us(recover_ts) - epoch_us(ts)) / 1e6 AS recovery_s
        FROM n WHERE NOT ok)"""


@register("wi5_breach_recovery_timeline", f"WITH {_WI5_SQL} SELECT * FROM inc")
def wi5(spark, sf):
    return slo.breach_timeline(v_probes(_t(spark, sf)))


@register("ag66_drill_verdict", f"""
WITH {_WI5_SQL},
u AS (SELECT ts FROM v_attempts WHERE NOT acked)
SELECT impact_seq, impact_ts, recover_ts, recovery_s,
       (SELECT count(*) FROM u WHERE u.ts < inc.impact_ts) AS dlq_at_impact,
       CASE WHEN recover_ts IS NOT NULL THEN (SELECT count(*) FROM u WHERE u.ts < inc.recover_ts) END AS dlq_at_recovery,
       CASE WHEN recovery_s < 300 AND (SELECT count(*) FROM u WHERE u.ts < inc.impact_ts)
                 = (SELECT count(*) FROM u WHERE u.ts < inc.recover_ts) THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM inc""")
def ag66(spark, sf):
    t = _t(spark, sf)
    return slo.drill_verdict(slo.breach_timeline(v_probes(t)), v_attempts(t))


@register("ag56_threshold_alert_islands", f"""
WITH b AS (SELECT endpoint, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS k FROM v_requests
           GROUP BY 1, 2 HAVING max(latency_ms) > 150),
i AS (SELECT endpoint, k, k - row_number() OVER (PARTITION BY endpoint ORDER BY k) AS isl FROM b),
g AS (SELECT endpoint, isl, min(k) AS s, max(k) AS e, count(*) AS buckets FROM i GROUP BY 1, 2)
SELECT endpoint, {EPOCH_TS.format(x='s * 3600')} AS episode_start, {EPOCH_TS.format(x='(e + 1) * 3600')} AS episode_end, buckets
FROM g WHERE buckets >= 3""")
def ag56(spark, sf):
    return slo.threshold_islands(v_requests(_t(spark, sf)), "endpoint", "ts", "latency_ms", 150.0, 3, 3600)


@register("ag57_traffic_floor", """
WITH c AS (SELECT endpoint, date_trunc('hour', ts) AS bucket, count(*) AS requests FROM v_requests GROUP BY 1, 2),
s AS (SELECT endpoint, unnest(generate_series(min(bucket), TIMESTAMP '2024-02-01 23:00:00', INTERVAL 1 HOUR)) AS bucket FROM c GROUP BY endpoint)
SELECT s.endpoint, s.bucket, coalesce(c.requests, 0) AS requests FROM s LEFT JOIN c ON s.bucket = c.bucket AND s.endpoint = c.endpoint
WHERE coalesce(c.requests, 0) < 2""")
def ag57(spark, sf):
    return slo.traffic_floor(v_requests(_t(spark, sf)), floor=2, keys=["endpoint"], as_of="2024-02-02 00:30:00")


@register("ag58_min_request_guard", """
SELECT date_trunc('hour', ts) AS bucket, count(*) AS requests, count(*) FILTER (WHERE status >= 500) AS errors,
       CASE WHEN count(*) >= 20 THEN count(*) FILTER (WHERE status >= 500) / count(*) END AS error_ratio
FROM v_requests GROUP BY 1""")
def ag58(spark, sf):
    return slo.guarded_ratio(v_requests(_t(spark, sf)), min_requests=20)


@register("ag59_label_cardinality", """
SELECT 'tenant_id' AS label, count(DISTINCT tenant_id) AS distinct_values, count(DISTINCT tenant_id) > 10 AS over_bound FROM v_requests
UNION ALL SELECT 'endpoint', count(DISTINCT endpoint), count(DISTINCT endpoint) > 10 FROM v_requests
UNION ALL SELECT 'status', count(DISTINCT status), count(DISTINCT status) > 10 FROM v_requests""")
def ag59(spark, sf):
    return slo.label_cardinality(v_requests(_t(spark, sf)), ["tenant_id", "endpoint", "status"], 10)


@register("ag65_cache_hit_ratio", """
SELECT endpoint, count(*) AS requests, avg(CAST(cache_hit AS INTEGER)) AS hit_ratio,
       count(*) FILTER (WHERE cache_hit) = 0 AS never_hit FROM v_requests GROUP BY 1""")
def ag65(spark, sf):
    return slo.cache_hit_ratio(v_requests(_t(spark, sf)))


@register("ag67_log_metric_per_minute", f"""
SELECT date_trunc('minute', ts) AS minute, count(*) AS entries FROM v_logs WHERE {SEV} >= 500 GROUP BY 1""")
def ag67(spark, sf):
    return slo.per_minute_count(slo.severity_filter(v_logs(_t(spark, sf)), "ERROR"))


@register("ag68_ordering_key_throughput", """
WITH s AS (SELECT ordering_key, date_trunc('second', ts) AS s, count(*) * 1024 AS b FROM v_attempts GROUP BY 1, 2)
SELECT ordering_key, max(b) AS peak_bytes_per_s, count(*) AS active_seconds, max(b) > 1000000 AS over_limit
FROM s GROUP BY 1""")
def ag68(spark, sf):
    return slo.key_throughput(v_attempts(_t(spark, sf)), "ordering_key", "ts", F.lit(1024).cast("bigint"))


@register("ag55_backlog_depth", f"""
WITH d AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS pub,
                  CASE WHEN acked THEN CAST(floor(epoch(ts)) AS BIGINT) + attempt_id % 30 * 700 END AS ack FROM v_attempts),
k AS (SELECT unnest(generate_series((SELECT min(pub) // 3600 FROM d), (SELECT greatest(max(pub), max(ack)) // 3600 FROM d))) AS k),
g AS (SELECT k.k, count(*) FILTER (WHERE pub // 3600 = k.k) AS published, count(*) FILTER (WHERE ack // 3600 = k.k) AS acked,
             count(*) FILTER (WHERE pub < (k.k + 1) * 3600) - count(*) FILTER (WHERE ack < (k.k + 1) * 3600) AS depth,
             min(pub) FILTER (WHERE pub < (k.k + 1) * 3600 AND (ack IS NULL OR ack >= (k.k + 1) * 3600)) AS oldest
      FROM k, d GROUP BY k.k)
SELECT {EPOCH_TS.format(x='(k + 1) * 3600')} AS bucket_end, published, acked, depth, (k + 1) * 3600 - oldest AS oldest_unacked_age_s,
       CASE WHEN (SELECT regr_slope(CAST(depth AS DOUBLE), CAST(k AS DOUBLE)) FROM g) > 0.01 THEN 'climbing' ELSE 'flat' END AS verdict
FROM g""")
def ag55(spark, sf):
    a = v_attempts(_t(spark, sf))
    return slo.backlog(a, "ts", "acked", F.col("attempt_id") % 30 * 700)


@register("wi5b_fault_recovery", f"""
WITH w AS (SELECT * FROM (VALUES (TIMESTAMP '2024-01-05 00:00:00'), (TIMESTAMP '2024-01-12 06:30:00'), (TIMESTAMP '2024-01-20 12:00:00')) v(fault_ts)),
z AS (SELECT v_probes.*, (SELECT max(fault_ts) FROM w WHERE w.fault_ts <= v_probes.ts) AS fault_ts FROM v_probes),
p AS (SELECT *, lag(ok) OVER (PARTITION BY fault_ts ORDER BY seq) AS pok FROM z WHERE fault_ts IS NOT NULL),
s AS (SELECT *, max(CASE WHEN pok IS NULL OR pok <> ok THEN seq END) OVER (PARTITION BY fault_ts ORDER BY seq ROWS UNBOUNDED PRECEDING) AS isl FROM p),
q AS (SELECT *, row_number() OVER (PARTITION BY fault_ts, isl ORDER BY seq) AS pos FROM s),
i AS (SELECT fault_ts, min(seq) AS impact_seq FROM q WHERE pos = 3 AND NOT ok GROUP BY 1),
r AS (SELECT i.fault_ts, i.impact_seq, min(q.seq) AS recover_seq FROM i JOIN q ON q.fault_ts = i.fault_ts AND q.ok AND q.pos = 3 AND q.seq > i.impact_seq GROUP BY 1, 2)
SELECT w.fault_ts, a.ts AS impact_ts, CASE WHEN i.impact_seq IS NULL THEN w.fault_ts ELSE b.ts END AS recover_ts,
       (epoch_us(CASE WHEN i.impact_seq IS NULL THEN w.fault_ts ELSE b.ts END) - epoch_us(w.fault_ts)) / 1e6 AS recovery_s
FROM w LEFT JOIN i ON i.fault_ts = w.fault_ts LEFT JOIN r ON r.fault_ts = w.fault_ts
LEFT JOIN z a ON a.seq = i.impact_seq LEFT JOIN z b ON b.seq = r.recover_seq""")
def wi5b(spark, sf):
    at = [dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 12, 6, 30), dt.datetime(2024, 1, 20, 12)]
    faults = spark.createDataFrame([(t,) for t in at], "fault_ts timestamp_ntz")
    return slo.fault_recovery(v_probes(_t(spark, sf)), faults)


@register("ss23_freshness_per_batch", """
WITH r AS (SELECT date_trunc('hour', ts) AS batch, skew_s,
                  row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY skew_s) AS rn,
                  count(*) OVER (PARTITION BY date_trunc('hour', ts)) AS n FROM v_events)
SELECT batch, max(n) AS events, max(skew_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.99) AS BIGINT))) AS p99_lag_s,
       max(skew_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.99) AS BIGINT))) < 60 AS meets_slo
FROM r GROUP BY batch""")
def ss23(spark, sf):
    e = v_events(_t(spark, sf)).withColumn("batch", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    p = rank_values(e, ["batch"], "skew_s", {"p99_lag_s": F.greatest(F.lit(1), F.ceil(F.col("n") * 0.99))})
    return p.select("batch", F.col("n").alias("events"), "p99_lag_s", (F.col("p99_lag_s") < 60).alias("meets_slo"))
