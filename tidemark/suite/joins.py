"""Join analyses and copy/manifest checks (JO1-JO6, JO9-JO15, SE1-SE2,
AG43)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import ts_range
from ..operators import joins as jn
from ..registry import register
from ..sources.fixtures import v_events, v_fx_rates, v_logs, v_source, v_spans, v_target, v_trips
from ..sources.tables import Tables


def _t(spark, sf):
    return Tables(spark, sf)


CONV = "CAST(sum(CAST(round({a} * {r} * 100) AS BIGINT)) AS DOUBLE) / 100"


@register("jo1_rate_join_full_key", f"""
SELECT t.currency, count(*) AS rows, {CONV.format(a='t.total_amount', r='r.rate')} AS converted
FROM v_trips t JOIN v_fx_rates r ON t.currency = r.currency AND CAST(t.pickup_datetime AS DATE) = r.rate_date
WHERE t.pickup_datetime >= TIMESTAMP '1997-01-01' AND t.pickup_datetime < TIMESTAMP '1998-01-01'
GROUP BY t.currency""")
def jo1(spark, sf):
    t = _t(spark, sf)
    trips = v_trips(t).where(ts_range("pickup_datetime", "1997-01-01", "1998-01-01"))
    # the rate-date range follows the fact range, so the rate side is pruned too
    rates = v_fx_rates(t).where((F.col("rate_date") >= F.lit("1997-01-01").cast("date"))
                                & (F.col("rate_date") < F.lit("1998-01-01").cast("date")))
    j = jn.enrich_rates(trips, rates, "currency", "pickup_datetime")
    return jn.converted_totals(j, "currency", "total_amount", "rate")


@register("jo2_aggregate_before_join", f"""
WITH m AS (SELECT currency, CAST(date_trunc('month', rate_date) AS DATE) AS month, round(avg(rate), 6) AS avg_rate
           FROM v_fx_rates GROUP BY 1, 2)
SELECT t.currency, count(*) AS rows, {CONV.format(a='t.total_amount', r='m.avg_rate')} AS converted
FROM v_trips t JOIN m ON t.currency = m.currency AND CAST(date_trunc('month', t.pickup_datetime) AS DATE) = m.month
GROUP BY t.currency""")
def jo2(spark, sf):
    t = _t(spark, sf)
    m = jn.monthly_rates(v_fx_rates(t), "currency")
    trips = v_trips(t).withColumn("month", F.trunc(F.col("pickup_datetime").cast("date"), "month"))
    j = trips.join(m, ["currency", "month"])
    return jn.converted_totals(j, "currency", "total_amount", "avg_rate")


@register("jo3_pair_count", """
SELECT currency, vendor_id, count(*) AS n, count(*) * count(*) AS pairs FROM v_trips GROUP BY currency, vendor_id""")
def jo3(spark, sf):
    return jn.pair_count(v_trips(_t(spark, sf)), ["currency", "vendor_id"])


@register("jo4_join_fanout", """
WITH l AS (SELECT currency, count(*) AS c FROM v_trips GROUP BY 1), r AS (SELECT currency, count(*) AS c FROM v_fx_rates GROUP BY 1)
SELECT CAST(coalesce(sum(l.c * r.c), 0) AS BIGINT) AS predicted_rows, CAST(coalesce(sum(l.c), 0) AS BIGINT) AS left_rows,
       max(l.c) AS max_left_per_key, max(r.c) AS max_right_per_key, coalesce(max(r.c) <= 1, true) AS right_unique
FROM l FULL OUTER JOIN r ON l.currency = r.currency""")
def jo4(spark, sf):
    t = _t(spark, sf)
    return jn.join_fanout(v_trips(t), v_fx_rates(t), ["currency"])


@register("jo6_left_join_totals", """
SELECT c.c_custkey AS customer_id, count(s.order_id) AS orders, CAST(coalesce(sum(s.total_cents), 0) AS BIGINT) AS total_cents
FROM customer c LEFT JOIN v_source s ON c.c_custkey = s.customer_id GROUP BY c.c_custkey""")
def jo6(spark, sf):
    t = _t(spark, sf)
    return jn.left_group_totals(t.customer.select(F.col("c_custkey").alias("customer_id")), v_source(t),
                                "customer_id", "total_cents")


@register("jo9_manifest_check", """
SELECT (SELECT count(*) FROM v_source) AS published, (SELECT count(*) FROM v_target) AS landed,
       (SELECT count(*) FROM (SELECT DISTINCT order_id FROM v_source) s
         WHERE NOT EXISTS (SELECT 1 FROM v_target t WHERE t.order_id = s.order_id)) AS lost,
       (SELECT count(*) FROM (SELECT DISTINCT order_id FROM v_target) t
         WHERE NOT EXISTS (SELECT 1 FROM v_source s WHERE t.order_id = s.order_id)) AS unexpected,
       (SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) FROM (SELECT count(*) AS k FROM v_target GROUP BY order_id)) AS duplicates""")
def jo9(spark, sf):
    t = _t(spark, sf)
    return jn.manifest_check(v_source(t), v_target(t), "order_id")


@register("se2_lost_ids", """
SELECT DISTINCT order_id FROM v_source s WHERE NOT EXISTS (SELECT 1 FROM v_target t WHERE t.order_id = s.order_id)""")
def se2(spark, sf):
    t = _t(spark, sf)
    return jn.lost_ids(v_source(t), v_target(t), "order_id")


@register("se1_bag_union", """
SELECT customer_id, count(*) AS rows FROM (SELECT * FROM v_source UNION ALL SELECT * FROM v_target) GROUP BY customer_id""")
def se1(spark, sf):
    t = _t(spark, sf)
    return jn.bag_union(v_source(t), v_target(t)).groupBy("customer_id").agg(F.count(F.lit(1)).alias("rows"))


@register("jo10_stream_batch_reconcile", """
WITH s AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, sum(CAST(round(amount * 100) AS BIGINT)) AS v
           FROM v_events WHERE skew_s <= 300 GROUP BY 1),
b AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, sum(CAST(round(amount * 100) AS BIGINT)) AS v
      FROM v_events GROUP BY 1),
j AS (SELECT coalesce(s.window_start, b.window_start) AS window_start, CAST(coalesce(s.v, 0) AS BIGINT) AS sv,
             CAST(coalesce(b.v, 0) AS BIGINT) AS bv FROM s FULL OUTER JOIN b ON s.window_start = b.window_start)
SELECT window_start, sv AS stream_value, bv AS batch_value,
       round(CASE WHEN bv = 0 THEN CASE WHEN sv = 0 THEN 0.0 ELSE 1.0 END ELSE abs(sv - bv) / abs(bv) END, 6) AS divergence,
       CASE WHEN bv = 0 THEN CASE WHEN sv = 0 THEN 0.0 ELSE 1.0 END ELSE abs(sv - bv) / abs(bv) END > 0.01 AS alert
FROM j""")
def jo10(spark, sf):
    e = v_events(_t(spark, sf)).withColumn("window_start", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    cents = F.sum(F.round(F.col("amount") * 100).cast("bigint")).alias("v")
    stream = e.where(F.col("skew_s") <= 300).groupBy("window_start").agg(cents)
    batch = e.groupBy("window_start").agg(cents)
    return jn.reconcile(stream, batch, ["window_start"], "v", 0.01)


@register("jo11_shadow_compare", """
WITH a AS (SELECT customer_id, count(*) AS src_rows, CAST(sum(total_cents) AS BIGINT) AS src_sum FROM v_source GROUP BY 1),
b AS (SELECT customer_id, count(*) AS tgt_rows, CAST(sum(total_cents) AS BIGINT) AS tgt_sum FROM v_target GROUP BY 1)
SELECT coalesce(a.customer_id, b.customer_id) AS customer_id, src_rows, src_sum, tgt_rows, tgt_sum
FROM a FULL OUTER JOIN b ON a.customer_id = b.customer_id
WHERE NOT (src_rows IS NOT DISTINCT FROM tgt_rows AND src_sum IS NOT DISTINCT FROM tgt_sum)""")
def jo11(spark, sf):
    t = _t(spark, sf)
    return jn.shadow_compare(v_source(t), v_target(t), "customer_id", "total_cents")


@register("jo12_span_tree", """
WITH c AS (SELECT s.trace_id, s.parent_span_id, s.duration_ms, p.span_id AS pid, p.duration_ms AS pdur
           FROM v_spans s LEFT JOIN v_spans p ON s.trace_id = p.trace_id AND s.parent_span_id = p.span_id)
SELECT trace_id, count(*) AS spans, sum(CASE WHEN parent_span_id IS NULL THEN duration_ms END) AS root_ms,
       count(*) FILTER (WHERE parent_span_id IS NOT NULL AND pid IS NULL) AS orphans,
       round(sum(CASE WHEN pid IS NOT NULL THEN duration_ms END) / sum(CASE WHEN pid IS NOT NULL THEN pdur END), 6) AS child_share
FROM c GROUP BY trace_id""")
def jo12(spark, sf):
    return jn.span_tree(v_spans(_t(spark, sf)))


@register("jo13_trace_log_correlation", """
WITH l AS (SELECT CAST(floor(log_id / 4) AS BIGINT) AS trace_id, log_id AS span_id, severity FROM v_logs)
SELECT s.trace_id, count(*) AS spans, count(*) FILTER (WHERE l.severity = 'ERROR') AS error_logs
FROM v_spans s LEFT JOIN l ON s.trace_id = l.trace_id AND s.span_id = l.span_id GROUP BY s.trace_id""")
def jo13(spark, sf):
    t = _t(spark, sf)
    logs = v_logs(t).select(F.floor(F.col("log_id") / 4).cast("bigint").alias("trace_id"),
                            F.col("log_id").alias("span_id"), "severity")
    j = jn.correlate_logs(v_spans(t).select("trace_id", "span_id"), logs, ["trace_id", "span_id"])
    return j.groupBy("trace_id").agg(F.count(F.lit(1)).alias("spans"),
                                     F.count_if(F.col("severity") == "ERROR").alias("error_logs"))


_ARRIVALS_SQL = """s AS (SELECT o_orderkey AS order_id, o_orderdate AS written_at FROM orders),
t AS (SELECT o_orderkey AS order_id, o_orderdate + to_seconds(CAST(o_orderkey % 97 * 3 AS BIGINT)) AS arrived_at
      FROM orders WHERE o_orderkey % 500 <> 0),
m AS (SELECT s.order_id, s.written_at, t.arrived_at, (epoch_us(t.arrived_at) - epoch_us(s.written_at)) / 1e6 AS lag_s
      FROM s LEFT JOIN t ON s.order_id = t.order_id AND t.arrived_at >= s.written_at
                        AND t.arrived_at <= s.written_at + INTERVAL 600 SECOND)"""


def _arrivals(t):
    o = t.orders
    src = o.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("written_at"))
    # target copy: the same rows that v_target keeps, landing 0-288 s later
    tgt = (o.where(F.col("o_orderkey") % 500 != 0)
           .select(F.col("o_orderkey").alias("order_id"),
                   F.expr("timestampadd(SECOND, CAST(o_orderkey % 97 * 3 AS INT), o_orderdate)").alias("arrived_at")))
    return jn.convergence(src, tgt, "order_id", "written_at", "arrived_at", 600)


@register("jo14_convergence_lag", f"WITH {_ARRIVALS_SQL} SELECT * FROM m")
def jo14(spark, sf):
    return _arrivals(_t(spark, sf))


@register("jo15_row_parity", """
SELECT (SELECT count(*) FROM v_source) AS source_rows, (SELECT count(*) FROM v_target) AS target_rows,
       (SELECT count(*) FROM v_source) - (SELECT count(*) FROM v_target) AS difference,
       (SELECT count(*) FROM v_source) = (SELECT count(*) FROM v_target) AS parity""")
def jo15(spark, sf):
    t = _t(spark, sf)
    return jn.row_parity(v_source(t), v_target(t))


@register("ag43_shadow_test_stats", f"""
WITH {_ARRIVALS_SQL},
b AS (SELECT m.order_id, m.lag_s, coalesce(src.total_cents = tgt.total_cents, false) AS matched
      FROM m JOIN v_source src ON m.order_id = src.order_id LEFT JOIN v_target tgt ON m.order_id = tgt.order_id),
r AS (SELECT lag_s, row_number() OVER (ORDER BY lag_s) AS rn, count(*) OVER () AS n FROM b WHERE lag_s IS NOT NULL)
SELECT (SELECT count(*) FROM b) AS comparisons, (SELECT count(*) FILTER (WHERE matched) FROM b) AS matches,
       (SELECT count(*) FILTER (WHERE lag_s IS NULL) FROM b) AS never_converged,
       (SELECT max(lag_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.5) AS BIGINT))) FROM r) AS p50_lag_s,
       (SELECT max(lag_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.95) AS BIGINT))) FROM r) AS p95_lag_s""")
def ag43(spark, sf):
    t = _t(spark, sf)
    m = _arrivals(t)
    src = v_source(t).select("order_id", F.col("total_cents").alias("_s"))
    tgt = v_target(t).select("order_id", F.col("total_cents").alias("_t"))
    b = m.join(src.hint("merge"), "order_id").join(tgt.hint("merge"), "order_id", "left")
    return jn.shadow_stats(b, "order_id", F.coalesce(F.col("_s") == F.col("_t"), F.lit(False)), "lag_s")
