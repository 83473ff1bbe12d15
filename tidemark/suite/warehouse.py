"""Scans, layout, warehouse aggregates, sorts (SO3-SO9, PF1-PF3, AG1-AG10,
AG34, AG36, AG40-AG42, SL1-SL3, WI1-WI2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import between_inclusive, date_equals, sum_money, year_range
from ..operators import layout, warehouse as wh
from ..operators.sequence import time_bucket
from ..registry import register
from ..session import scratch_path
from ..sources.fixtures import v_events, v_jobs, v_logs, v_requests, v_trips, v_attempts
from ..sources.tables import Tables


def _t(spark, sf):
    return Tables(spark, sf)


@register("so3_scan_range", """
SELECT trip_id, pickup_datetime, fare_amount FROM v_trips
WHERE pickup_datetime >= TIMESTAMP '1996-01-01' AND pickup_datetime < TIMESTAMP '1997-01-01'""")
def so3(spark, sf):
    from ..functions.columns import ts_range
    return layout.scan(v_trips(_t(spark, sf)), ["trip_id", "pickup_datetime", "fare_amount"],
                       ts_range("pickup_datetime", "1996-01-01", "1997-01-01"))


@register("pf1_named_projection", "SELECT trip_id, currency, total_amount FROM v_trips")
def pf1(spark, sf):
    return layout.scan(v_trips(_t(spark, sf)), ["trip_id", "currency", "total_amount"])


@register("pf2_day_range_pruned", """
SELECT event_id, ts, tenant_id, amount FROM v_events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'""")
def pf2(spark, sf):
    d = layout.day_range(v_events(_t(spark, sf)), "ts", "event_date", "2024-01-10", "2024-01-13")
    return d.select("event_id", "ts", "tenant_id", "amount")


@register("pf3_sargable_rewrites", """
SELECT vendor_id,
       CAST(count(*) FILTER (WHERE EXTRACT(YEAR FROM pickup_datetime) = 1997) AS BIGINT) AS trips_1997,
       CAST(count(*) FILTER (WHERE CAST(pickup_datetime AS DATE) = DATE '1997-03-14') AS BIGINT) AS trips_day,
       CAST(count(*) FILTER (WHERE pickup_datetime BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31') AS BIGINT) AS trips_between
FROM v_trips GROUP BY vendor_id""")
def pf3(spark, sf):
    d = v_trips(_t(spark, sf))
    return d.groupBy("vendor_id").agg(
        F.count_if(year_range("pickup_datetime", 1997)).alias("trips_1997"),
        F.count_if(date_equals("pickup_datetime", "1997-03-14")).alias("trips_day"),
        F.count_if(between_inclusive("pickup_datetime", "1997-03-01", "1997-03-31")).alias("trips_between"))


@register("so4_scan_shards", """
SELECT log_date, severity, count(*) AS n FROM v_logs
WHERE log_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY log_date, severity""")
def so4(spark, sf):
    d = v_logs(_t(spark, sf))
    d = d.where(F.col("log_date").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date")))
    return d.groupBy("log_date", "severity").agg(F.count(F.lit(1)).alias("n"))


@register("so5_write_partitioned_readback", """
SELECT event_date, tenant_id, count(*) AS n, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS amount
FROM v_events GROUP BY event_date, tenant_id""")
def so5(spark, sf):
    path = scratch_path(spark, f"so5-{uuid.uuid4().hex}")
    layout.write_partitioned(v_events(_t(spark, sf)), path, "event_date", cluster=["tenant_id", "event_type"])
    back = spark.read.parquet(path)
    return back.groupBy("event_date", "tenant_id").agg(F.count(F.lit(1)).alias("n"),
                                                        sum_money("amount").alias("amount"))


@register("so6_partition_granularity", """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS part_hour, count(*) AS n FROM v_events GROUP BY 1""")
def so6(spark, sf):
    d = layout.with_partition(v_events(_t(spark, sf)), "ts", "HOUR", name="part_hour")
    return d.groupBy(F.col("part_hour").cast("timestamp_ntz").alias("part_hour")).agg(F.count(F.lit(1)).alias("n"))


@register("so7_int_range_buckets", """
SELECT CASE WHEN user_id IS NULL THEN '__NULL__'
            WHEN user_id < 0 OR user_id >= 100 THEN '__UNPARTITIONED__'
            ELSE CAST(CAST(FLOOR((user_id - 0) / 10) AS BIGINT) AS VARCHAR) END AS bucket,
       count(*) AS n
FROM v_events GROUP BY 1""")
def so7(spark, sf):
    d = layout.with_int_range(v_events(_t(spark, sf)), "user_id", 0, 100, 10)
    return d.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@register("so8_null_partition", """
SELECT COALESCE(error_code, '__NULL__') AS partition_id, count(*) AS total_rows FROM v_logs GROUP BY 1""")
def so8(spark, sf):
    return layout.partition_stats(v_logs(_t(spark, sf)), "error_code")


@register("ag34_partition_stats", """
SELECT COALESCE(CAST(event_date AS VARCHAR), '__NULL__') AS partition_id, count(*) AS total_rows
FROM v_events GROUP BY 1""")
def ag34(spark, sf):
    return layout.partition_stats(v_events(_t(spark, sf)), "event_date")


@register("ag1_day_count_revenue", """
SELECT CAST(pickup_datetime AS DATE) AS day, count(*) AS trips, CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue
FROM v_trips GROUP BY 1""")
def ag1(spark, sf):
    return wh.day_count_revenue(v_trips(_t(spark, sf)), "pickup_datetime", "total_amount")


@register("ag2_group_count", "SELECT payment_type, count(*) AS n FROM v_trips GROUP BY payment_type")
def ag2(spark, sf):
    return wh.group_count(v_trips(_t(spark, sf)), "payment_type")


@register("ag3_avg_tip_ratio", """
SELECT vendor_id, round(avg(tip_amount / NULLIF(fare_amount, 0)) * 100, 2) AS avg_ratio_pct
FROM v_trips GROUP BY vendor_id""")
def ag3(spark, sf):
    return wh.avg_ratio_pct(v_trips(_t(spark, sf)), "vendor_id", "tip_amount", "fare_amount")


@register("ag4_hour_profile", "SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) AS n FROM v_events GROUP BY 1")
def ag4(spark, sf):
    return wh.hour_profile(v_events(_t(spark, sf)), "ts")


@register("ag5_duplicate_summary", """
SELECT count(*) AS total, count(DISTINCT message_id) AS distinct_ids,
       count(*) - count(DISTINCT message_id) AS duplicates FROM v_attempts""")
def ag5(spark, sf):
    return wh.duplicate_summary(v_attempts(_t(spark, sf)), "message_id")


@register("ag36_daily_rollup", """
SELECT event_date, tenant_id, event_type, count(*) AS events, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS amount,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases
FROM v_events GROUP BY event_date, tenant_id, event_type""")
def ag36(spark, sf):
    r = wh.daily_rollup(v_events(_t(spark, sf)), "event_date", ["tenant_id", "event_type"], "amount", "event_type")
    return r


@register("sl1_global_order", "SELECT trip_id, total_amount FROM v_trips ORDER BY total_amount DESC, trip_id")
def sl1(spark, sf):
    return wh.global_order(v_trips(_t(spark, sf)).select("trip_id", "total_amount"),
                           [F.desc("total_amount"), F.asc("trip_id")])


@register("sl2_top_n", """
SELECT trip_id, currency, total_amount FROM v_trips ORDER BY total_amount DESC, trip_id LIMIT 20""")
def sl2(spark, sf):
    return wh.top_n(v_trips(_t(spark, sf)).select("trip_id", "currency", "total_amount"),
                    [F.desc("total_amount"), F.asc("trip_id")], 20)


@register("sl3_top_k_per_group", """
SELECT user_email, job_id, total_bytes_billed, rank FROM (
  SELECT user_email, job_id, total_bytes_billed,
         row_number() OVER (PARTITION BY user_email ORDER BY total_bytes_billed DESC, job_id) AS rank
  FROM v_jobs) WHERE rank <= 3""")
def sl3(spark, sf):
    d = v_jobs(_t(spark, sf)).select("user_email", "job_id", "total_bytes_billed")
    r = wh.top_k_per_group(d, ["user_email"], [F.desc("total_bytes_billed"), F.asc("job_id")], 3)
    return r.withColumn("rank", F.col("rank").cast("bigint"))


@register("wi2_top_query_per_user", """
SELECT user_email, job_id, query FROM (
  SELECT user_email, job_id, query,
         row_number() OVER (PARTITION BY user_email ORDER BY total_bytes_billed DESC, job_id) AS rn
  FROM v_jobs) WHERE rn = 1""")
def wi2(spark, sf):
    d = v_jobs(_t(spark, sf)).select("user_email", "job_id", "query", "total_bytes_billed")
    r = wh.top_k_per_group(d, ["user_email"], [F.desc("total_bytes_billed"), F.asc("job_id")], 1)
    return r.select("user_email", "job_id", "query")


@register("wi1_label_by_group_max", """
SELECT event_id, tenant_id, event_date,
       max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY tenant_id, event_date) = 1 AS tenant_day_purchase
FROM v_events""")
def wi1(spark, sf):
    d = v_events(_t(spark, sf)).select("event_id", "tenant_id", "event_date", "event_type")
    r = wh.label_by_group_max(d, ["tenant_id", "event_date"], F.col("event_type") == "purchase",
                              "tenant_day_purchase")
    return r.select("event_id", "tenant_id", "event_date", "tenant_day_purchase")


@register("ag6_skew_percentiles", """
WITH r AS (SELECT skew_s, row_number() OVER (ORDER BY skew_s) AS rn, count(*) OVER () AS n FROM v_events)
SELECT max(n) AS n,
       max(skew_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.5) AS BIGINT))) AS p50,
       max(skew_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.99) AS BIGINT))) AS p99,
       max(skew_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.999) AS BIGINT))) AS p999,
       max(skew_s) AS max_s
FROM r""")
def ag6(spark, sf):
    return wh.skew_percentiles(v_events(_t(spark, sf)), "skew_s")


@register("ag7_recommend_lateness", """
WITH r AS (SELECT skew_s, row_number() OVER (ORDER BY skew_s) AS rn, count(*) OVER () AS n FROM v_events),
p AS (SELECT max(skew_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.999) AS BIGINT))) AS p999 FROM r),
b AS (SELECT p999, coalesce((SELECT min(x) FROM unnest([60, 120, 300, 600, 900, 1800, 3600, 7200, 21600, 43200, 86400, 172800]) t(x) WHERE x > p999), (CAST(floor(p999 / 86400) AS BIGINT) + 1) * 86400) AS bound_s FROM p)
SELECT b.bound_s, b.p999, count(*) AS events, count(*) FILTER (WHERE e.skew_s > b.bound_s) AS dropped,
       round(count(*) FILTER (WHERE e.skew_s > b.bound_s) / count(*) * 100, 4) AS dropped_pct
FROM v_events e, b GROUP BY b.bound_s, b.p999""")
def ag7(spark, sf):
    return wh.recommend_lateness(v_events(_t(spark, sf)), "skew_s")


@register("ag8_session_gap_distribution", """
WITH g AS (SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6 AS gap_s FROM v_events),
r AS (SELECT gap_s, row_number() OVER (ORDER BY gap_s) AS rn, count(*) OVER () AS n FROM g WHERE gap_s IS NOT NULL)
SELECT max(n) AS gaps,
       max(gap_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.5) AS BIGINT))) AS p50_gap_s,
       max(gap_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.9) AS BIGINT))) AS p90_gap_s,
       max(gap_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.99) AS BIGINT))) AS p99_gap_s
FROM r""")
def ag8(spark, sf):
    d = v_events(_t(spark, sf))
    return wh.gap_distribution(d, "user_id", "ts", "event_id", time_bucket("ts"))


@register("ag9_error_share_literal", """
SELECT tenant_id, date_trunc('week', ts) AS week, status, count(*) AS requests,
       count(*) FILTER (WHERE status >= 500) AS errors,
       round(count(*) FILTER (WHERE status >= 500) / count(*), 6) AS error_rate
FROM v_requests GROUP BY tenant_id, date_trunc('week', ts), status""")
def ag9(spark, sf):
    d = v_requests(_t(spark, sf))
    return wh.error_share(d, [F.col("tenant_id"), F.date_trunc("week", "ts").cast("timestamp_ntz").alias("week"),
                              F.col("status")], "status")


@register("ag9b_error_share_per_tenant", """
SELECT tenant_id, date_trunc('week', ts) AS week, count(*) AS requests,
       count(*) FILTER (WHERE status >= 500) AS errors,
       round(count(*) FILTER (WHERE status >= 500) / count(*), 6) AS error_rate
FROM v_requests GROUP BY tenant_id, date_trunc('week', ts)""")
def ag9b(spark, sf):
    d = v_requests(_t(spark, sf))
    return wh.error_share(d, [F.col("tenant_id"), F.date_trunc("week", "ts").cast("timestamp_ntz").alias("week")],
                          "status")


@register("ag10_p99_top_endpoints", """
WITH r AS (SELECT tenant_id, latency_ms, row_number() OVER (PARTITION BY tenant_id ORDER BY latency_ms) AS rn,
                  count(*) OVER (PARTITION BY tenant_id) AS n FROM v_requests)
SELECT tenant_id, max(n) AS n, max(latency_ms) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.99) AS BIGINT))) AS p99_ms
FROM r GROUP BY tenant_id ORDER BY p99_ms DESC, tenant_id LIMIT 10""")
def ag10(spark, sf):
    return wh.p99_top(v_requests(_t(spark, sf)), "tenant_id", "latency_ms", 10)


@register("ag40_hot_keys", """
WITH c AS (SELECT tenant_id, count(*) AS n FROM v_events GROUP BY tenant_id)
SELECT tenant_id, n, round(n / (SELECT sum(n) FROM c) * 100, 4) AS share_pct FROM c
ORDER BY n DESC, tenant_id LIMIT 10""")
def ag40(spark, sf):
    return wh.hot_keys(v_events(_t(spark, sf)), "tenant_id", 10)


@register("ag41_salted_aggregate", """
SELECT tenant_id, count(*) AS n, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total FROM v_events GROUP BY tenant_id""")
def ag41(spark, sf):
    return wh.salted_sum(v_events(_t(spark, sf)), "tenant_id", "amount", "event_id", 16)


@register("ag34b_partition_storage")
def ag34b(spark, sf):
    """AG34 with storage: rows, bytes and files per day partition of the
    event table written with the SO5 layout (footer statistics, R check)."""
    from ..plans.guards import partition_storage
    path = scratch_path(spark, f"ag34b-{uuid.uuid4().hex}")
    layout.write_partitioned(v_events(_t(spark, sf)), path, "event_date", cluster=["tenant_id"])
    return partition_storage(spark.read.parquet(path), "event_date")


@register("ag8b_session_gap_per_key", """
WITH g AS (SELECT tenant_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY tenant_id ORDER BY ts, event_id))) / 1e6 AS gap_s
           FROM v_events),
r AS (SELECT tenant_id, gap_s, row_number() OVER (PARTITION BY tenant_id ORDER BY gap_s) AS rn,
             count(*) OVER (PARTITION BY tenant_id) AS n FROM g WHERE gap_s IS NOT NULL)
SELECT tenant_id, max(n) AS gaps,
       max(gap_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.5) AS BIGINT))) AS p50_gap_s,
       max(gap_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.9) AS BIGINT))) AS p90_gap_s,
       max(gap_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.99) AS BIGINT))) AS p99_gap_s
FROM r GROUP BY tenant_id""")
def ag8b(spark, sf):
    d = v_events(_t(spark, sf))
    return wh.gap_distribution(d, "tenant_id", "ts", "event_id", time_bucket("ts"), per_key=True)
