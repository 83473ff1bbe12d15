"""Billing, serving and compute cost analyses (AG11-AG18, AG23-AG30,
AG60-AG62, AG70, PF10, JO7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import cents, label_value
from ..operators import finops as fo
from ..registry import register
from ..sources.fixtures import v_events, v_billing, v_calls, v_jobs, v_requests
from ..sources.tables import Tables

# SQL fragments mirroring the integer-cents arithmetic of the operators
COST_C = "CAST(round(cost * 100) AS BIGINT)"
CRED_C = "CAST(round((CASE WHEN credit_amount < 0 THEN credit_amount ELSE 0.0 END) * 100) AS BIGINT)"


def _t(spark, sf):
    return Tables(spark, sf)


@register("ag11_effective_cost", f"""
SELECT service, sku, CAST(sum({COST_C}) AS DOUBLE) / 100 AS list_cost,
       CAST(sum({CRED_C}) AS DOUBLE) / 100 AS credits,
       CAST(sum({COST_C}) + sum({CRED_C}) AS DOUBLE) / 100 AS effective_cost
FROM v_billing GROUP BY service, sku""")
def ag11(spark, sf):
    return fo.effective_cost(v_billing(_t(spark, sf)), ["service", "sku"])


@register("ag12_discount_share", f"""
SELECT service, CAST(sum({COST_C}) AS DOUBLE) / 100 AS list_cost, CAST(sum({CRED_C}) AS DOUBLE) / 100 AS credits,
       round(CAST(-sum({CRED_C}) AS DOUBLE) * 100 / CAST(sum({COST_C}) AS DOUBLE), 2) AS discount_pct
FROM v_billing GROUP BY service""")
def ag12(spark, sf):
    return fo.discount_share(v_billing(_t(spark, sf)), ["service"])


@register("ag13_daily_effective_cost", f"""
SELECT service, CAST(usage_start_time AS DATE) AS day, CAST(sum({COST_C}) + sum({CRED_C}) AS BIGINT) AS effective_cents,
       CAST(sum({COST_C}) + sum({CRED_C}) AS DOUBLE) / 100 AS effective_cost
FROM v_billing GROUP BY service, CAST(usage_start_time AS DATE)""")
def ag13(spark, sf):
    return fo.daily_effective(v_billing(_t(spark, sf)), ["service"])


_DAILY_BY_SERVICE = f"""d AS (
  SELECT service, CAST(usage_start_time AS DATE) AS day, CAST(sum({COST_C}) + sum({CRED_C}) AS BIGINT) AS effective_cents,
         CAST(sum({COST_C}) + sum({CRED_C}) AS DOUBLE) / 100 AS effective_cost
  FROM v_billing GROUP BY service, CAST(usage_start_time AS DATE))"""


@register("ag14_trend_shape", f"""
WITH {_DAILY_BY_SERVICE},
s AS (SELECT service, count(*) AS days, CAST(sum(effective_cents) AS DOUBLE) / count(*) / 100 AS m,
             stddev_pop(effective_cost) AS sd, min(effective_cost) AS min_daily, max(effective_cost) AS max_daily,
             regr_slope(effective_cost, CAST(day - DATE '1970-01-01' AS DOUBLE)) AS slope,
             CAST(max(day - DATE '1970-01-01') - min(day - DATE '1970-01-01') + 1 AS DOUBLE) AS span
      FROM d GROUP BY service)
SELECT service, days, round(m, 2) AS avg_daily, min_daily, max_daily,
       CASE WHEN slope * span / m >= 0.5 THEN 'rising' WHEN sd / m <= 0.25 THEN 'flat' ELSE 'sawtooth' END AS shape
FROM s""")
def ag14(spark, sf):
    return fo.trend_shape(fo.daily_effective(v_billing(_t(spark, sf)), ["service"]), "service")


@register("ag15_cost_center_showback", f"""
WITH g AS (SELECT cost_center, sum({COST_C}) + sum({CRED_C}) AS e FROM v_billing GROUP BY cost_center)
SELECT cost_center, CAST(e AS DOUBLE) / 100 AS effective_cost, round(CAST(e AS DOUBLE) / (SELECT sum(e) FROM g) * 100, 4) AS share_pct
FROM g""")
def ag15(spark, sf):
    return fo.showback(v_billing(_t(spark, sf)))


@register("pf10_label_lookup", "SELECT service, sku, cost, cost_center FROM v_billing")
def pf10(spark, sf):
    b = v_billing(_t(spark, sf))
    return b.select("service", "sku", "cost", label_value("labels", "cost_center").alias("cost_center"))


@register("ag16_invoice_month_top", f"""
SELECT service, CAST(sum({COST_C}) + sum({CRED_C}) AS DOUBLE) / 100 AS effective_cost, '199703' AS invoice_month
FROM v_billing WHERE strftime(usage_start_time, '%Y%m') = '199703'
GROUP BY service ORDER BY effective_cost DESC, service LIMIT 20""")
def ag16(spark, sf):
    return fo.invoice_month_top(v_billing(_t(spark, sf)), "199703", "service", 20)


@register("ag17_commitment_saving", f"""
WITH {_DAILY_BY_SERVICE},
s AS (SELECT service, count(*) AS days, sum(effective_cents) AS tot, min(effective_cents) AS mn FROM d GROUP BY service),
m AS (SELECT *, CAST(floor((tot * 30 * 2 + days) / (days * 2)) AS BIGINT) AS monthly FROM s),
a AS (SELECT *, monthly * 12 AS annual FROM m),
c AS (SELECT *, CAST(floor((annual * 63 * 2 + 100) / 200) AS BIGINT) AS committed,
             round(CAST(mn AS DOUBLE) * days * 100.0 / tot, 4) AS floor_pct FROM a)
SELECT service, monthly / 100.0 AS monthly_on_demand, annual / 100.0 AS annual_on_demand,
       committed / 100.0 AS annual_committed, (annual - committed) / 100.0 AS annual_saving,
       CAST(63.0 AS DOUBLE) AS breakeven_pct, floor_pct, CASE WHEN floor_pct >= 63.0 THEN 'COMMIT' ELSE 'HOLD' END AS verdict
FROM c""")
def ag17(spark, sf):
    return fo.commitment_saving(fo.daily_effective(v_billing(_t(spark, sf)), ["service"]), "service", 37)


@register("ag18_budget_crossings", f"""
WITH d AS (SELECT strftime(usage_start_time, '%Y%m') AS invoice_month, CAST(usage_start_time AS DATE) AS day,
                  sum({COST_C}) + sum({CRED_C}) AS c FROM v_billing GROUP BY 1, 2),
b AS (SELECT avg(m) AS budget FROM (SELECT sum(c) AS m FROM d GROUP BY invoice_month)),
r AS (SELECT invoice_month, day, sum(c) OVER (PARTITION BY invoice_month ORDER BY day ROWS UNBOUNDED PRECEDING) AS cum FROM d),
x AS (SELECT r.invoice_month, r.day, t.kind, t.threshold,
             CASE WHEN t.kind = 'actual' THEN r.cum >= t.threshold * b.budget
                  ELSE CAST(r.cum AS DOUBLE) / dayofmonth(r.day) * dayofmonth(last_day(r.day)) >= b.budget END AS hit
      FROM r, b, (VALUES ('actual', 0.5), ('actual', 0.9), ('actual', 1.0), ('forecast', 1.0)) t(kind, threshold))
SELECT invoice_month, kind, CAST(threshold AS DOUBLE) AS threshold, min(day) AS first_day FROM x WHERE hit
GROUP BY invoice_month, kind, threshold""")
def ag18(spark, sf):
    return fo.budget_crossings(v_billing(_t(spark, sf)))


@register("jo7_replay_30_days", """
SELECT CAST(usage_start_time + to_days(CAST(o AS INTEGER)) AS DATE) AS day, count(*) AS rows_replayed,
       CAST(sum(CAST(round(cost * 100) AS BIGINT)) AS DOUBLE) / 100 AS cost
FROM v_billing, range(0, 30) r(o) GROUP BY 1""")
def jo7(spark, sf):
    # aggregate before the fan-out: rows per day are reduced to one row per
    # day (partial aggregation), then each day row is replayed 30 times --
    # the same totals as replaying every billing row, 1/rows-per-day the data
    b = v_billing(_t(spark, sf))
    daily = b.groupBy(F.col("usage_start_time").cast("date").alias("usage_start_time")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(cents("cost")).alias("_c"))
    r = fo.replay_days(daily.withColumn("usage_start_time", F.col("usage_start_time").cast("timestamp_ntz")), 30)
    return r.groupBy(F.col("usage_start_time").cast("date").alias("day")).agg(
        F.sum("_n").alias("rows_replayed"), (F.sum("_c") / 100.0).alias("cost"))


@register("ag23_token_cost", """
SELECT option_name, count(*) AS requests, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
       round((sum(input_tokens) * 0.075 + sum(output_tokens) * 0.30) / 1e6, 6) AS cost_usd,
       round((sum(input_tokens) * 0.075 + sum(output_tokens) * 0.30) / 1e6 / count(*) * 1000, 6) AS usd_per_1000
FROM v_calls GROUP BY option_name""")
def ag23(spark, sf):
    return fo.token_cost(v_calls(_t(spark, sf)), "option_name")


@register("ag24_node_crossover", """
WITH g AS (SELECT option_name, avg(input_tokens) AS i, avg(output_tokens) AS o FROM v_calls GROUP BY option_name),
c AS (SELECT option_name, 1000 * (i * 0.075 + o * 0.30) / 1e6 AS api,
             (0.71 / (1200 * 3600.0) * 1e6) * o * 1000 / 1e6 AS node FROM g)
SELECT option_name, round(api, 6) AS api_usd_per_1000, round(node, 6) AS node_usd_per_1000,
       round(0.71 / (1200 * 3600.0) * 1e6, 6) AS node_usd_per_m_out,
       CASE WHEN node / api <= 1 THEN round(node / api * 100, 2) END AS crossover_duty_pct
FROM c""")
def ag24(spark, sf):
    return fo.node_crossover(v_calls(_t(spark, sf)), "option_name")


@register("ag24b_node_at_duty", """
WITH g AS (SELECT option_name, avg(input_tokens) AS i, avg(output_tokens) AS o FROM v_calls GROUP BY option_name),
p AS (SELECT g.*, CASE WHEN option_name = 'api' THEN 0.15 ELSE 0.075 END AS pi, CASE WHEN option_name = 'api' THEN 0.60 ELSE 0.30 END AS po,
             CASE WHEN option_name = 'api' THEN 1.42 ELSE 0.71 END AS h, CASE WHEN option_name = 'api' THEN 3000.0 ELSE 1200.0 END AS t FROM g),
c AS (SELECT option_name, 1000 * (i * pi + o * po) / 1e6 AS api, h / (t * 3600.0) * 1e6 AS fm, o FROM p)
SELECT option_name, round(api, 6) AS api_usd_per_1000, round(fm / 0.25 * o * 1000 / 1e6, 6) AS node_usd_per_1000,
       round(fm / 0.25, 6) AS node_usd_per_m_out, CASE WHEN fm * o * 1000 / 1e6 / api <= 1 THEN round(fm * o * 1000 / 1e6 / api * 100, 2) END AS crossover_duty_pct
FROM c""")
def ag24b(spark, sf):
    own = spark.createDataFrame([("api", 0.15, 0.60, 1.42, 3000.0)], "option_name string, usd_in double, usd_out double, usd_hour double, tokens_s double")
    return fo.node_crossover(v_calls(_t(spark, sf)), "option_name", duty=0.25, prices=own)


@register("ag18b_budget_messages", """
WITH m AS (SELECT tenant_id AS budget_id, ts AS publish_time, CASE WHEN event_id % 7 = 0 THEN 0.5 WHEN event_id % 31 = 0 THEN 0.9 END AS alert_threshold FROM v_events)
SELECT budget_id, CAST(alert_threshold AS DOUBLE) AS alert_threshold, min(publish_time) AS first_alert, count(*) AS messages FROM m WHERE alert_threshold IS NOT NULL GROUP BY 1, 2""")
def ag18b(spark, sf):
    e = v_events(_t(spark, sf))
    m = e.select(F.col("tenant_id").alias("budget_id"), F.col("ts").alias("publish_time"),
                 F.when(F.col("event_id") % 7 == 0, F.lit(0.5)).when(F.col("event_id") % 31 == 0, F.lit(0.9)).alias("alert_threshold"))
    return fo.budget_alerts(m)


def _pod_rows(t):
    r = v_requests(t)
    return r.select(F.col("endpoint").alias("workload"), ((F.col("request_id") % 8) * 0.125).alias("cpu"),
                    ((F.col("request_id") % 6) * 0.25).alias("mem_gib"), (F.col("latency_ms") / 60.0).alias("hours"))


@register("ag29_pod_request_cost", """
WITH p AS (SELECT endpoint AS workload, (request_id % 8) * CAST(0.125 AS DOUBLE) AS cpu, (request_id % 6) * CAST(0.25 AS DOUBLE) AS mem_gib,
                  latency_ms / 60.0 AS hours FROM v_requests)
SELECT workload, count(*) AS pods,
       round(sum(hours * (greatest(cpu, 0.25) * 0.0445 + greatest(mem_gib, 0.5) * 0.0049)), 4) AS cost_usd,
       round(sum(greatest(cpu, 0.25)), 4) AS billed_vcpu, round(sum(greatest(mem_gib, 0.5)), 4) AS billed_gib
FROM p GROUP BY workload""")
def ag29(spark, sf):
    return fo.pod_request_cost(_pod_rows(_t(spark, sf)), "workload", "cpu", "mem_gib", "hours")


@register("ag27_request_priced_cost", """
SELECT endpoint, count(*) AS requests, round(sum(latency_ms) / 1000.0, 3) AS active_s,
       round(sum(latency_ms) / 1000.0 * (1.0 * 0.000024 + 0.5 * 0.0000025) + count(*) * (0.40 / 1000000), 6) AS cost_usd
FROM v_requests GROUP BY endpoint""")
def ag27(spark, sf):
    return fo.request_priced_cost(v_requests(_t(spark, sf)), "endpoint", "latency_ms")


@register("ag26_perf_per_dollar", """
WITH p(option_name, usd_per_hour) AS (VALUES ('api', CAST(0.134 AS DOUBLE)), ('endpoint', CAST(0.71 AS DOUBLE)), ('self_hosted', CAST(0.2 AS DOUBLE))),
g AS (SELECT option_name, count(*) AS requests, epoch(max(ts)) - epoch(min(ts)) AS span FROM v_calls GROUP BY option_name),
o AS (SELECT g.option_name, round(requests / span, 6) AS req_per_s, round(requests / span * 3600 / usd_per_hour, 4) AS req_per_usd_hour
      FROM g JOIN p USING (option_name))
SELECT *, round(req_per_usd_hour / (SELECT req_per_usd_hour FROM o WHERE option_name = 'api'), 4) AS ratio_to_baseline FROM o""")
def ag26(spark, sf):
    price = fo.price_table(spark, [("api", 0.134), ("endpoint", 0.71), ("self_hosted", 0.2)],
                           "option_name string, usd_per_hour double")
    return fo.perf_per_dollar(v_calls(_t(spark, sf)), "option_name", price, "ts", "api")


@register("ag60_cost_share", f"""
WITH g AS (SELECT service, sum({COST_C}) AS c, count(*) AS units FROM v_billing GROUP BY service)
SELECT service, CAST(c AS DOUBLE) / 100 AS cost, round(CAST(c AS DOUBLE) / (SELECT sum(c) FROM g) * 100, 4) AS share_pct,
       units, round(CAST(c AS DOUBLE) / 100 / units, 6) AS cost_per_unit FROM g""")
def ag60(spark, sf):
    b = fo.with_effective(v_billing(_t(spark, sf))).withColumn("units", F.lit(1).cast("bigint"))
    return fo.cost_share(b, "service", "_cost_c", "units")


@register("ag61_stream_volume_cost", """
WITH g AS (SELECT event_type, count(*) AS messages, avg(length(props)) AS b, epoch(max(ts)) - epoch(min(ts)) AS span
           FROM events GROUP BY event_type)
SELECT event_type, round(messages / span, 6) AS msg_per_s, round(b, 4) AS avg_bytes,
       round(messages / span * b * 86400 * 30 / 1073741824, 6) AS monthly_gib,
       round(messages / span * b * 86400 * 30 / 1073741824 / 1024 * 40.0, 6) AS monthly_usd FROM g""")
def ag61(spark, sf):
    return fo.stream_volume_cost(_t(spark, sf).events, "event_type", "ts", "props")


@register("ag62_reservation_idle", """
SELECT day, used_slot_s, greatest(CAST(0 AS DOUBLE), 1 - used_slot_s / 8640000) * 100 AS idle_pct,
       greatest(CAST(0 AS DOUBLE), 1 - used_slot_s / 8640000) * 100 * 24 * CAST(0.06 AS DOUBLE) AS idle_usd
FROM (SELECT CAST(creation_time AS DATE) AS day, CAST(sum(total_slot_ms) AS DOUBLE) / 1000 AS used_slot_s FROM v_jobs GROUP BY 1)""")
def ag62(spark, sf):
    return fo.reservation_idle(v_jobs(_t(spark, sf)), "creation_time", "total_slot_ms", 100)


@register("ag30_on_demand_vs_reservation", """
SELECT CAST(creation_time AS DATE) AS day, count(*) AS jobs, round(sum(total_bytes_billed) / 1099511627776.0, 6) AS tib,
       round(sum(total_bytes_billed) / 1099511627776.0 * 6.25, 4) AS on_demand_usd, CAST(6.0 AS DOUBLE) AS reservation_usd,
       sum(total_slot_ms) <= 360000000 AS fits_reservation, CAST(0.96 AS DOUBLE) AS breakeven_tib,
       CASE WHEN sum(total_bytes_billed) / 1099511627776.0 * 6.25 > 6.0 AND sum(total_slot_ms) <= 360000000
            THEN 'reservation' ELSE 'on_demand' END AS choice,
       round(sum(total_slot_ms) / 3600000.0 * CAST(0.06 AS DOUBLE), 6) AS autoscale_usd,
       CASE WHEN sum(total_slot_ms) / 3600000.0 * CAST(0.06 AS DOUBLE) <= sum(total_bytes_billed) / 1099511627776.0 * 6.25
                 AND (sum(total_slot_ms) > 360000000 OR sum(total_slot_ms) / 3600000.0 * CAST(0.06 AS DOUBLE) <= 6.0)
            THEN 'autoscale'
            WHEN sum(total_slot_ms) <= 360000000 AND 6.0 < sum(total_bytes_billed) / 1099511627776.0 * 6.25 THEN 'reservation'
            ELSE 'on_demand' END AS choice_3way
FROM v_jobs GROUP BY 1""")
def ag30(spark, sf):
    return fo.on_demand_vs_reservation(v_jobs(_t(spark, sf)), "creation_time", "total_bytes_billed", "total_slot_ms")


# Edge price list (illustrative list prices; fixed values).
EDGE_PRICES = [("armor_requests_m", 0.75), ("cdn_lookups_10k", 0.0075), ("origin_requests_m", 0.40)]


@register("ag70_edge_bill", """
WITH u AS (SELECT 'armor_requests_m' AS component, count(*) / 1e6 AS quantity FROM v_requests
           UNION ALL SELECT 'cdn_lookups_10k', count(*) FILTER (WHERE cache_hit) / 1e4 FROM v_requests
           UNION ALL SELECT 'origin_requests_m', count(*) FILTER (WHERE NOT cache_hit) / 1e6 FROM v_requests),
p(component, unit_price) AS (VALUES ('armor_requests_m', CAST(0.75 AS DOUBLE)), ('cdn_lookups_10k', CAST(0.0075 AS DOUBLE)), ('origin_requests_m', CAST(0.40 AS DOUBLE))),
b AS (SELECT u.component, quantity, unit_price, round(quantity * unit_price, 4) AS monthly_usd FROM u JOIN p USING (component))
SELECT *, round((SELECT sum(monthly_usd) FROM b), 4) AS total_usd,
       component = (SELECT arg_max(component, monthly_usd) FROM b) AS is_largest FROM b""")
def ag70(spark, sf):
    r = v_requests(_t(spark, sf))
    q = r.agg((F.count(F.lit(1)) / 1e6).alias("armor_requests_m"),
              (F.count_if("cache_hit") / 1e4).alias("cdn_lookups_10k"),
              (F.count_if(~F.col("cache_hit")) / 1e6).alias("origin_requests_m"))
    usage = q.select(F.explode(F.array(*[F.struct(F.lit(c).alias("component"), F.col(c).alias("quantity"))
                                         for c, _ in EDGE_PRICES])).alias("u")).select("u.*")
    price = fo.price_table(spark, EDGE_PRICES, "component string, unit_price double")
    return fo.line_item_bill(usage, price)


@register("ag25_serving_comparison", """
WITH r AS (SELECT option_name, latency_ms, row_number() OVER (PARTITION BY option_name ORDER BY latency_ms) AS rn,
                  count(*) OVER (PARTITION BY option_name) AS n FROM v_calls),
p AS (SELECT option_name, max(n) AS n,
             max(latency_ms) FILTER (WHERE rn = greatest(1, least(n, CAST(round_even(0.5 * n + 0.5, 0) AS BIGINT)))) AS p50_ms,
             max(latency_ms) FILTER (WHERE rn = greatest(1, least(n, CAST(round_even(0.9 * n + 0.5, 0) AS BIGINT)))) AS p90_ms,
             max(latency_ms) FILTER (WHERE rn = greatest(1, least(n, CAST(round_even(0.99 * n + 0.5, 0) AS BIGINT)))) AS p99_ms
      FROM r GROUP BY option_name),
g AS (SELECT option_name, count(*) AS requests, count(*) FILTER (WHERE failed) AS errors,
             epoch(max(ts)) - epoch(min(ts)) AS span, sum(input_tokens) AS i, sum(output_tokens) AS o
      FROM v_calls GROUP BY option_name)
SELECT p.option_name, p.n, p50_ms, p90_ms, p99_ms, round(requests / span, 6) AS req_per_s,
       round(errors / requests, 6) AS error_rate,
       round((i * 0.075 + o * 0.30) / 1e6 / requests * 1000, 6) AS usd_per_1000
FROM p JOIN g USING (option_name)""")
def ag25(spark, sf):
    from ..operators.serving import serving_comparison
    return serving_comparison(v_calls(_t(spark, sf)), "option_name")


@register("ag22_latency_nearest_rank", """
WITH r AS (SELECT option_name, latency_ms, row_number() OVER (PARTITION BY option_name ORDER BY latency_ms) AS rn,
                  count(*) OVER (PARTITION BY option_name) AS n FROM v_calls)
SELECT option_name, max(n) AS n,
       max(latency_ms) FILTER (WHERE rn = greatest(1, least(n, CAST(round_even(0.5 * n + 0.5, 0) AS BIGINT)))) AS p50_ms,
       max(latency_ms) FILTER (WHERE rn = greatest(1, least(n, CAST(round_even(0.9 * n + 0.5, 0) AS BIGINT)))) AS p90_ms,
       max(latency_ms) FILTER (WHERE rn = greatest(1, least(n, CAST(round_even(0.99 * n + 0.5, 0) AS BIGINT)))) AS p99_ms
FROM r GROUP BY option_name""")
def ag22(spark, sf):
    from ..operators.serving import latency_percentiles
    return latency_percentiles(v_calls(_t(spark, sf)), ["option_name"], "latency_ms")


@register("ag28_cold_start_share", """
WITH g AS (SELECT endpoint, ts, lag(ts) OVER (PARTITION BY endpoint ORDER BY ts, request_id) AS prev FROM v_requests),
c AS (SELECT endpoint, count(*) AS requests,
             count(*) FILTER (WHERE prev IS NULL OR epoch(ts) - epoch(prev) > 900) AS cold_starts FROM g GROUP BY endpoint)
SELECT endpoint, requests, cold_starts, round(cold_starts / requests * 100, 4) AS cold_pct,
       cold_starts / requests > 0.01 AS breaches_slo FROM c""")
def ag28(spark, sf):
    from ..operators.serving import cold_start_share
    r = v_requests(_t(spark, sf))
    return cold_start_share(r, "endpoint", "ts", "request_id", idle_s=900)
