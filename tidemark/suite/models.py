"""Model and rollup analyses (ML1-ML6, AG38)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..operators import ml, rollup
from ..registry import register
from ..session import scratch_path
from ..sources.fixtures import v_events
from ..sources.tables import Tables


def _t(spark, sf):
    return Tables(spark, sf)


@register("ml3_feature_info", """
WITH r AS (SELECT amount, row_number() OVER (ORDER BY amount) AS rn, count(*) OVER () AS n FROM v_events WHERE amount IS NOT NULL),
s AS (SELECT skew_s, row_number() OVER (ORDER BY skew_s) AS rn, count(*) OVER () AS n FROM v_events WHERE skew_s IS NOT NULL)
SELECT 'amount' AS feature, min(amount) AS min, max(amount) AS max, round(avg(amount), 6) AS mean,
       (SELECT max(amount) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.5) AS BIGINT))) FROM r) AS median,
       round(stddev_samp(amount), 6) AS stddev, count(DISTINCT amount) AS distinct_values,
       count(*) FILTER (WHERE amount IS NULL) AS nulls FROM v_events
UNION ALL
SELECT 'skew_s', CAST(min(skew_s) AS DOUBLE), CAST(max(skew_s) AS DOUBLE), round(avg(skew_s), 6),
       (SELECT CAST(max(skew_s) FILTER (WHERE rn = greatest(1, CAST(ceil(n * 0.5) AS BIGINT))) AS DOUBLE) FROM s),
       round(stddev_samp(skew_s), 6), count(DISTINCT skew_s), count(*) FILTER (WHERE skew_s IS NULL) FROM v_events
UNION ALL
SELECT 'tenant_id', NULL, NULL, NULL, NULL, NULL, count(DISTINCT tenant_id), count(*) FILTER (WHERE tenant_id IS NULL) FROM v_events
UNION ALL
SELECT 'event_type', NULL, NULL, NULL, NULL, NULL, count(DISTINCT event_type), count(*) FILTER (WHERE event_type IS NULL) FROM v_events""")
def ml3(spark, sf):
    return ml.feature_info(v_events(_t(spark, sf)), ["amount", "skew_s"], ["tenant_id", "event_type"])


KEYS = ["tenant_id", "user_id", "event_date"]


def _features(spark, sf):
    """User-day rows, written once per query: some of them buy and some do
    not at every scale (of a tenant's days all may have a purchase)."""
    path = scratch_path(spark, f"features-{uuid.uuid4().hex}")
    ml.daily_features(v_events(_t(spark, sf)), unit=KEYS[:2]).write.parquet(path)
    return spark.read.parquet(path)


@register("ml2_train_evaluate")
def ml2(spark, sf):
    train, test = ml.split(_features(spark, sf), KEYS)
    return ml.evaluate(ml.train_logistic(train), test)


@register("ml2b_metrics_of_predictions", """
WITH d AS (SELECT user_id, event_date, count(*) AS events, sum(CAST(round(amount * 100) AS BIGINT)) AS cents,
                  max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS y FROM v_events GROUP BY 1, 2),
s AS (SELECT y, greatest(1, least(99, events * 20 + cents % 7)) / 100.0 AS p FROM d),
z AS (SELECT y, p, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS z FROM s),
r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r FROM z),
c AS (SELECT count(*) AS n, sum(y) AS pos, count(*) FILTER (WHERE y = 1 AND z = 1) AS tp, count(*) FILTER (WHERE y = 0 AND z = 0) AS tn,
             count(*) FILTER (WHERE y = 0 AND z = 1) AS fp, count(*) FILTER (WHERE y = 1 AND z = 0) AS fn,
             -sum(ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)) / count(*) AS log_loss FROM z),
m AS (SELECT *, tp / (tp + fp) AS p1, tn / (tn + fn) AS p0, tp / (tp + fn) AS r1, tn / (tn + fp) AS r0 FROM c)
SELECT round((SELECT (sum(r) FILTER (WHERE y = 1) - any_value(pos) * (any_value(pos) + 1) / 2) / (any_value(pos) * (any_value(n) - any_value(pos))) FROM r, m), 9) AS roc_auc,
       round((tp + tn) / n, 9) AS accuracy, round((p1 * pos + p0 * (n - pos)) / n, 9) AS precision, round((r1 * pos + r0 * (n - pos)) / n, 9) AS recall,
       round((2 * p1 * r1 / (p1 + r1) * pos + 2 * p0 * r0 / (p0 + r0) * (n - pos)) / n, 9) AS f1, round(log_loss, 9) AS log_loss FROM m""")
def ml2b(spark, sf):
    """ML2: the measures of written predictions; a rule of two features
    stands for the model."""
    path = scratch_path(spark, f"predictions-{uuid.uuid4().hex}")
    p = F.greatest(F.lit(1), F.least(F.lit(99), F.col("events") * 20 + F.col("cents") % 7)) / 100.0
    (v_events(_t(spark, sf)).groupBy("user_id", "event_date")
     .agg(F.count(F.lit(1)).alias("events"), F.sum(F.round(F.col("amount") * 100).cast("bigint")).alias("cents"),
          F.max((F.col("event_type") == "purchase").cast("int")).alias("label"))
     .select("label", p.alias("probability"), (p > 0.5).cast("int").alias("prediction")).write.parquet(path))
    m = ml.metrics(spark.read.parquet(path))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@register("ml4_predict_day")
def ml4(spark, sf):
    f = _features(spark, sf)
    day = f.select(F.max("event_date")).scalar()
    return ml.predict(ml.train_logistic(ml.split(f, KEYS)[0]), f.where(F.col("event_date") == day), KEYS)


@register("ml5_ticket_scoring")
def ml5(spark, sf):
    c = _t(spark, sf).conversations
    d = c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("msg_id"), "text")
    return ml.score_batch(d, "text", "msg_id")


@register("ml6_model_families")
def ml6(spark, sf):
    """ML6: each family's prediction for every feature row (and, for the
    factorisation, every user and item that occur)."""
    e = v_events(_t(spark, sf))
    f = _features(spark, sf)
    num = ["events", "n_click", "n_view", "n_signup", "n_error", "active_hours"]
    key = F.concat_ws("|", *KEYS).alias("row_key")
    out = [m.transform(f).select(F.lit(name).alias("model"), key, F.col("prediction").cast("double").alias("prediction"))
           for name, m in (("linear_regression", ml.train_linear(f, "amount", num)), ("kmeans", ml.train_kmeans(f, num)),
                           ("gbt_classifier", ml.train_gbt(f, "purchased", num)))]
    ratings = e.groupBy("user_id", F.pmod(F.xxhash64("event_type"), F.lit(50)).cast("int").alias("item")).agg(
        F.count(F.lit(1)).cast("float").alias("rating"))
    als = ml.train_als(ratings, "user_id", "item", "rating").transform(ratings)
    out.append(als.select(F.lit("als").alias("model"), F.concat_ws("|", "user_id", "item").alias("row_key"),
                          F.col("prediction").cast("double").alias("prediction")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@register("ag38_answer_from_rollup", """
SELECT tenant_id, event_type, count(*) AS events, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS amount,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases
FROM v_events WHERE event_date >= DATE '2024-01-05' AND event_date < DATE '2024-01-20'
GROUP BY tenant_id, event_type""")
def ag38(spark, sf):
    e = v_events(_t(spark, sf))
    path = scratch_path(spark, f"rollup-{uuid.uuid4().hex}")
    rollup.write_rollup(rollup.build_rollup(e), path, dt.datetime(2024, 2, 1))
    out, source = rollup.answer(spark, path, e, ["tenant_id", "event_type"], "2024-01-05", "2024-01-20")
    assert source == "rollup"
    return out.select("tenant_id", "event_type", F.col("events").cast("bigint").alias("events"),
                      "amount", F.col("purchases").cast("bigint").alias("purchases"))



@register("ag38b_distinct_and_p99_from_rollup", """
SELECT tenant_id, count(DISTINCT user_id) AS users, count(*) AS events, true AS users_near, true AS p50_near, true AS p99_near
FROM v_events WHERE event_date >= DATE '2024-01-05' AND event_date < DATE '2024-01-20' GROUP BY tenant_id""")
def ag38b(spark, sf):
    """AG36, AG38: users and percentiles per tenant from a daily rollup.  The
    users by bitmaps are exact; the estimates from sketches are held against
    the events: the count within three standard errors, the share of values
    up to a percentile within the rank error (and what ties add)."""
    e = v_events(_t(spark, sf))
    days = lambda d: d.where((F.col("event_date") >= F.lit(dt.date(2024, 1, 5))) & (F.col("event_date") < F.lit(dt.date(2024, 1, 20))))
    stored = []
    for name, r in (("presence", rollup.build_presence(e, "user_id")), ("sketches", rollup.build_sketches(e, "user_id", "amount"))):
        path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        r.write.partitionBy("event_date").parquet(path)
        stored.append(days(spark.read.parquet(path)))
    exact = rollup.answer_presence(stored[0], ["tenant_id"], "users")
    near = rollup.answer_sketches(stored[1], ["tenant_id"], {"p50": 0.5, "p99": 0.99})
    shares = lambda p: [F.avg((F.col("amount") < F.col(p)).cast("double")).alias(f"{p}_lo"),
                        F.avg((F.col("amount") <= F.col(p)).cast("double")).alias(f"{p}_hi")]
    seen = days(e).join(near, "tenant_id").groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("events"), F.first("distinct_count").alias("guess"), *shares("p50"), *shares("p99"))
    inside = lambda p, q: ((F.col(f"{p}_lo") <= q + 0.01) & (F.col(f"{p}_hi") >= q - 0.01)).alias(f"{p}_near")
    return exact.join(seen, "tenant_id").select(
        "tenant_id", "users", "events", (F.abs(F.col("guess") - F.col("users")) <= F.greatest(F.lit(1.0), 0.05 * F.col("users"))).alias("users_near"),
        inside("p50", 0.5), inside("p99", 0.99))


@register("pf12_unenriched_batch_pull", """
SELECT conv_id, turn, length(text) AS n_chars
FROM conversations WHERE role <> 'assistant' ORDER BY conv_id, turn, n_chars LIMIT 100""")
def pf12(spark, sf):
    """PF12: the next batch of rows whose enrichment is missing, in key order
    so reruns pull the same batch.  The filter is on the enrichment column,
    which pulling does not compute (assistant turns stand for labelled rows)."""
    c = _t(spark, sf).conversations
    enriched = c.select("conv_id", "turn", "text", F.when(F.col("role") == "assistant", F.lit("done")).alias("label"))
    return (enriched.where(F.col("label").isNull())
            .select("conv_id", "turn", F.length("text").cast("bigint").alias("n_chars"))
            .orderBy("conv_id", "turn", "n_chars").limit(100))


@register("pf7_scan_bytes_estimate")
def pf7(spark, sf):
    """PF7: planned bytes per column of a two-column query over one year of
    lineitem (distributed footer read)."""
    from ..plans.guards import estimate_scan_bytes
    li = _t(spark, sf).lineitem
    q = li.where((F.col("l_shipdate") >= F.lit(dt.datetime(1997, 1, 1)))
                 & (F.col("l_shipdate") < F.lit(dt.datetime(1998, 1, 1)))).select("l_orderkey", "l_extendedprice")
    return estimate_scan_bytes(q)
