"""Cost analysis over billing exports and usage logs (AG11-AG18, AG23-AG30,
AG60-AG62, AG70, PF10, JO7).

Money is summed as integer cents (``sum_money``/``cents``) so results do not
depend on the order Spark combines partial sums.  Nested credits are reduced
per row with the higher-order ``aggregate`` (no explode, no correlated
subquery), then grouped once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import cents, credits_total, label_value

# ---- fixed values (public list prices the reference works with) -------------
# Request-priced service: USD per vCPU-second, per GiB-second, per request.
RUN_VCPU_SECOND = 0.000024
RUN_GIB_SECOND = 0.0000025
RUN_PER_REQUEST = 0.40 / 1_000_000
# Pod-request pricing: USD per vCPU-hour and GiB-hour, and request floors.
POD_VCPU_HOUR = 0.0445
POD_GIB_HOUR = 0.0049
POD_MIN_VCPU = 0.25
POD_MIN_GIB = 0.5
# Model serving: API price per million input/output tokens, node price per
# hour and node throughput in output tokens per second.
API_USD_PER_M_IN = 0.075
API_USD_PER_M_OUT = 0.30
NODE_USD_PER_HOUR = 0.71
NODE_TOKENS_PER_S = 1200
# Slot reservation: USD per slot-hour.
SLOT_HOUR_USD = 0.06


def with_effective(df: DataFrame, cost: str = "cost", credits: str = "credits") -> DataFrame:
    """Per-row cents of list cost, credits and effective cost."""
    return df.withColumn("_cost_c", cents(cost)).withColumn("_cred_c", cents(credits_total(credits)))


def _money(c: str) -> Column:
    return (F.sum(c) / F.lit(100.0)).cast("double")


def effective_cost(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG11: sum(cost) + sum(credits[].amount) per keys."""
    d = with_effective(df)
    return (d.groupBy(*keys)
            .agg(_money("_cost_c").alias("list_cost"), _money("_cred_c").alias("credits"),
                 ((F.sum("_cost_c") + F.sum("_cred_c")) / F.lit(100.0)).alias("effective_cost")))


def discount_share(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG12: list cost, credits and percent already discounted."""
    d = with_effective(df)
    return (d.groupBy(*keys)
            .agg(F.sum("_cost_c").alias("_l"), F.sum("_cred_c").alias("_c"))
            .select(*keys, (F.col("_l") / 100.0).alias("list_cost"), (F.col("_c") / 100.0).alias("credits"),
                    F.round(F.try_divide(-F.col("_c") * 100.0, F.col("_l")), 2).alias("discount_pct")))


def daily_effective(df: DataFrame, keys: Sequence[str], ts: str = "usage_start_time") -> DataFrame:
    """AG13: effective cost per keys and usage day (in cents and USD)."""
    d = with_effective(df)
    return (d.groupBy(*keys, F.col(ts).cast("date").alias("day"))
            .agg((F.sum("_cost_c") + F.sum("_cred_c")).alias("effective_cents"))
            .withColumn("effective_cost", F.col("effective_cents") / 100.0))


# Trend thresholds (ours; the reference names the shapes only):
#   rising   : fitted slope x days / mean >= 0.5 (grows by half over the span)
#   flat     : coefficient of variation <= 0.25
#   sawtooth : anything else
RISING_GROWTH = 0.5
FLAT_CV = 0.25


def trend_shape(daily: DataFrame, key: str, day: str = "day", value: str = "effective_cost",
                cents_col: str = "effective_cents") -> DataFrame:
    """AG14: flat / sawtooth / rising per key from its daily series."""
    dn = F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).cast("double")
    s = daily.groupBy(key).agg(
        F.count(F.lit(1)).alias("days"), (F.sum(cents_col) / F.count(F.lit(1)) / 100.0).alias("_mean"),
        F.stddev_pop(value).alias("_sd"),
        F.min(value).alias("min_daily"), F.max(value).alias("max_daily"),
        F.regr_slope(F.col(value), dn).alias("_slope"),
        (F.max(dn) - F.min(dn) + 1).alias("_span"))
    cv = F.col("_sd") / F.col("_mean")
    growth = F.col("_slope") * F.col("_span") / F.col("_mean")
    return s.select(
        key, "days", F.round("_mean", 2).alias("avg_daily"), "min_daily", "max_daily",
        F.when(growth >= RISING_GROWTH, "rising").when(cv <= FLAT_CV, "flat").otherwise("sawtooth").alias("shape"))


def showback(df: DataFrame, label_key: str = "cost_center", labels: str = "labels") -> DataFrame:
    """AG15: effective cost per label value; the NULL bucket is kept and its
    share reported like any other (share of the grand total is a scalar
    subquery)."""
    d = with_effective(df).withColumn(label_key, label_value(labels, label_key))
    g = d.groupBy(label_key).agg((F.sum("_cost_c") + F.sum("_cred_c")).alias("_e"))
    tot = g.select(F.sum("_e")).scalar()
    return g.select(label_key, (F.col("_e") / 100.0).alias("effective_cost"),
                    F.round(F.col("_e") / tot * 100, 4).alias("share_pct"))


def invoice_month_top(df: DataFrame, month: str, key: str, n: int = 20,
                      ts: str = "usage_start_time") -> DataFrame:
    """AG16: spend per key in invoice month ``yyyyMM``, top ``n``.

    The month test is rewritten to a half-open range on the timestamp so it
    stays sargable (pushed to the scan)."""
    import datetime as dt
    y, m = int(month[:4]), int(month[4:])
    lo = dt.datetime(y, m, 1)
    hi = dt.datetime(y + (m == 12), m % 12 + 1, 1)
    d = df.where((F.col(ts) >= F.lit(lo)) & (F.col(ts) < F.lit(hi)))
    d = with_effective(d)
    g = d.groupBy(key).agg(((F.sum("_cost_c") + F.sum("_cred_c")) / 100.0).alias("effective_cost"))
    return g.withColumn("invoice_month", F.lit(month)).orderBy(F.desc("effective_cost"), F.asc(key)).limit(n)


def _round_div(a: Column, b: Column) -> Column:
    """round(a / b) for non-negative integers a and positive b, exactly
    (floor((2a + b) / 2b)); avoids half-way ties of decimal rounding."""
    return F.floor((a * 2 + b) / (b * 2)).cast("bigint")


def commitment_saving(daily: DataFrame, key: str, discount_pct: int = 37,
                      value: str = "effective_cents") -> DataFrame:
    """AG17: monthly and annualised on-demand spend, committed spend at
    ``discount_pct``, saving, breakeven utilisation (%), and a verdict
    against the demonstrated floor ``min(daily) / avg(daily)`` (our
    definition of the floor).  Money is kept in integer cents."""
    s = daily.groupBy(key).agg(F.count(F.lit(1)).alias("days"), F.sum(value).alias("_tot"),
                               F.min(value).alias("_min"))
    monthly = _round_div(F.col("_tot") * 30, F.col("days"))
    annual = monthly * 12
    committed = _round_div(annual * (100 - discount_pct), F.lit(100))
    floor_pct = F.round(F.col("_min") * F.col("days") * 100.0 / F.col("_tot"), 4)
    breakeven = F.lit(float(100 - discount_pct))
    return s.select(key, (monthly / 100.0).alias("monthly_on_demand"), (annual / 100.0).alias("annual_on_demand"),
                    (committed / 100.0).alias("annual_committed"),
                    ((annual - committed) / 100.0).alias("annual_saving"),
                    breakeven.alias("breakeven_pct"), floor_pct.alias("floor_pct"),
                    F.when(floor_pct >= breakeven, "COMMIT").otherwise("HOLD").alias("verdict"))


def budget_crossings(df: DataFrame, thresholds: Sequence[float] = (0.5, 0.9, 1.0),
                     ts: str = "usage_start_time", budget_cents: Column | None = None) -> DataFrame:
    """AG18: per invoice month, the first day actual spend crosses each
    threshold of the budget, and the first day the run-rate forecast
    (spend so far / day of month x days in month) reaches 100%.

    The running sum is windowed per month over at most 31 daily rows.  With
    no budget given it is the average monthly spend (a scalar subquery)."""
    d = with_effective(df)
    daily = (d.groupBy(F.date_format(ts, "yyyyMM").alias("invoice_month"), F.col(ts).cast("date").alias("day"))
             .agg((F.sum("_cost_c") + F.sum("_cred_c")).alias("_c")))
    if budget_cents is None:
        monthly = daily.groupBy("invoice_month").agg(F.sum("_c").alias("_m"))
        budget_cents = monthly.select(F.avg("_m")).scalar()
    w = Window.partitionBy("invoice_month").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    # the budget (a scalar subquery) is attached once and referenced by name
    r = daily.withColumn("_cum", F.sum("_c").over(w)).withColumn("_budget", budget_cents)
    forecast = F.col("_cum") / F.dayofmonth("day") * F.dayofmonth(F.last_day("day"))
    rows = r.select("invoice_month", "day", F.explode(F.array(
        *[F.struct(F.lit("actual").alias("kind"), F.lit(float(t)).alias("threshold"),
                   (F.col("_cum") >= F.lit(float(t)) * F.col("_budget")).alias("hit")) for t in thresholds],
        F.struct(F.lit("forecast").alias("kind"), F.lit(1.0).alias("threshold"),
                 (forecast >= F.col("_budget")).alias("hit")))).alias("x"))
    return (rows.where("x.hit").groupBy("invoice_month", F.col("x.kind").alias("kind"),
                                         F.col("x.threshold").alias("threshold"))
            .agg(F.min("day").alias("first_day")))


def budget_alerts(messages: DataFrame, budget: str = "budget_id", at: str = "publish_time",
                  threshold: str = "alert_threshold") -> DataFrame:
    """AG18 (messages): of a budget's notifications, which come several times
    a day whatever the spend, the first one per threshold crossed.  Messages
    without a threshold (nothing crossed yet) raise no alert."""
    crossed = messages.where(F.col(threshold).isNotNull())
    return (crossed.groupBy(budget, threshold)
            .agg(F.min(at).alias("first_alert"), F.count(F.lit(1)).alias("messages")))


def replay_days(df: DataFrame, days: int, ts: str = "usage_start_time") -> DataFrame:
    """JO7: each row repeated for day offsets 0..days-1 (row x array join via
    ``explode(sequence())``, generated per row, no join operator)."""
    return (df.withColumn("day_offset", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
            .withColumn(ts, F.col(ts) + F.make_dt_interval(F.col("day_offset"))))


# ---- request-priced and pod-priced compute -----------------------------------

def request_priced_cost(df: DataFrame, key: str, latency_ms: str, vcpu: float = 1.0, mem_gib: float = 0.5,
                        concurrency: int = 1) -> DataFrame:
    """AG27: active seconds x (vCPU, memory) prices + per-request price."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("requests"),
                            (F.sum(latency_ms) / 1000.0 / concurrency).alias("_active_s"))
    return g.select(
        key, "requests", F.round("_active_s", 3).alias("active_s"),
        F.round(F.col("_active_s") * (vcpu * RUN_VCPU_SECOND + mem_gib * RUN_GIB_SECOND)
                + F.col("requests") * RUN_PER_REQUEST, 6).alias("cost_usd"))


def pod_request_cost(df: DataFrame, key: str, cpu: str, mem: str, hours: str) -> DataFrame:
    """AG29: pod cost with the 0.25 vCPU / 0.5 GiB request floors, by workload."""
    c = F.greatest(F.col(cpu), F.lit(POD_MIN_VCPU))
    m = F.greatest(F.col(mem), F.lit(POD_MIN_GIB))
    per = F.col(hours) * (c * POD_VCPU_HOUR + m * POD_GIB_HOUR)
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("pods"),
                               F.round(F.sum(per), 4).alias("cost_usd"),
                               F.round(F.sum(c), 4).alias("billed_vcpu"), F.round(F.sum(m), 4).alias("billed_gib"))


def token_cost(df: DataFrame, key: str, in_tok: str = "input_tokens", out_tok: str = "output_tokens") -> DataFrame:
    """AG23: token cost per request and per 1000 requests."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("requests"), F.sum(in_tok).alias("input_tokens"),
                            F.sum(out_tok).alias("output_tokens"))
    cost = (F.col("input_tokens") * API_USD_PER_M_IN + F.col("output_tokens") * API_USD_PER_M_OUT) / 1e6
    return g.select(key, "requests", "input_tokens", "output_tokens", F.round(cost, 6).alias("cost_usd"),
                    F.round(cost / F.col("requests") * 1000, 6).alias("usd_per_1000"))


def node_crossover(df: DataFrame, key: str, in_tok: str = "input_tokens", out_tok: str = "output_tokens",
                   duty: float = 1.0, prices: DataFrame | None = None) -> DataFrame:
    """AG24: node cost per 1000 requests and per 1M output tokens at a duty
    cycle (the share of the hour the node is busy), API cost per 1000, and the
    duty cycle where the node becomes cheaper (NULL when it never is).

    ``prices`` has per key ``usd_in`` and ``usd_out`` (USD per 1M tokens),
    ``usd_hour`` and ``tokens_s`` of the node; keys it does not name, and calls without it, take the
    published figures."""
    g = df.groupBy(key).agg(F.avg(in_tok).alias("_in"), F.avg(out_tok).alias("_out"))
    fixed = {"usd_in": API_USD_PER_M_IN, "usd_out": API_USD_PER_M_OUT, "usd_hour": NODE_USD_PER_HOUR, "tokens_s": NODE_TOKENS_PER_S}
    if prices is not None:
        g = g.join(prices.select(key, *fixed), key, "left")
    p = {c: F.coalesce(F.col(c), F.lit(float(v))) if prices is not None else F.lit(float(v)) for c, v in fixed.items()}
    api = 1000 * (F.col("_in") * p["usd_in"] + F.col("_out") * p["usd_out"]) / 1e6
    full = p["usd_hour"] / (p["tokens_s"] * 3600.0) * 1e6
    per_m = full / duty
    node = per_m * F.col("_out") * 1000 / 1e6
    at = full * F.col("_out") * 1000 / 1e6 / api
    return g.select(key, F.round(api, 6).alias("api_usd_per_1000"), F.round(node, 6).alias("node_usd_per_1000"),
                    F.round(per_m, 6).alias("node_usd_per_m_out"), F.when(at <= 1, F.round(at * 100, 2)).alias("crossover_duty_pct"))


def perf_per_dollar(df: DataFrame, key: str, price: DataFrame, ts: str, baseline: str) -> DataFrame:
    """AG26: throughput per USD-hour and its ratio to a baseline option.

    ``price`` is the (small, literal) option -> USD/hour table; the baseline
    value is a scalar subquery."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("requests"),
                            (F.unix_seconds(F.max(ts).cast("timestamp"))
                             - F.unix_seconds(F.min(ts).cast("timestamp"))).alias("_span"))
    g = g.join(price, key)
    rate = F.col("requests") / F.col("_span")
    per = rate * 3600 / F.col("usd_per_hour")
    out = g.select(key, F.round(rate, 6).alias("req_per_s"), F.round(per, 4).alias("req_per_usd_hour"))
    base = out.where(F.col(key) == baseline).select("req_per_usd_hour").scalar()
    return out.withColumn("ratio_to_baseline", F.round(F.col("req_per_usd_hour") / base, 4))


def cost_share(df: DataFrame, key: str, cost_cents: str, units: str) -> DataFrame:
    """AG60: cost per component, share of total, cost per unit."""
    g = df.groupBy(key).agg(F.sum(cost_cents).alias("_c"), F.sum(units).alias("units"))
    tot = g.select(F.sum("_c")).scalar()
    return g.select(key, (F.col("_c") / 100.0).alias("cost"), F.round(F.col("_c") / tot * 100, 4).alias("share_pct"),
                    "units", F.round(F.col("_c") / 100.0 / F.col("units"), 6).alias("cost_per_unit"))


def line_item_bill(usage: DataFrame, price: DataFrame, key: str = "component") -> DataFrame:
    """AG70: quantity x unit price per component, total and the largest item.

    ``usage`` is aggregated from the logs (one row per component); the price
    list is a literal table; total and largest item are scalar subqueries."""
    b = usage.join(price, key).withColumn(
        "monthly_usd", F.round(F.col("quantity") * F.col("unit_price"), 4))
    total = b.select(F.sum("monthly_usd")).scalar()
    largest = b.select(F.max_by(key, F.struct("monthly_usd", key))).scalar()
    return b.select(key, "quantity", "unit_price", "monthly_usd", F.round(total, 4).alias("total_usd"),
                    (F.col(key) == largest).alias("is_largest"))


def on_demand_vs_reservation(jobs: DataFrame, ts: str, bytes_col: str, slot_ms: str,
                             slots: int = 100, window_hours: float = 1.0,
                             commit_usd_per_slot_hour: float | None = None) -> DataFrame:
    """AG30: per nightly batch window (day), on-demand cost of the bytes
    scanned vs a reservation of ``slots`` for ``window_hours``; capacity
    check (slot-ms needed vs bought), breakeven TiB and the choice; plus the
    autoscaling variant (pay for the slot-hours used, baseline 0) and the
    three-way choice.  With ``commit_usd_per_slot_hour`` (a multi-year
    commitment rate) the committed window cost and its breakeven TiB are
    added."""
    from ..functions.columns import TIB, USD_PER_TIB
    g = jobs.groupBy(F.col(ts).cast("date").alias("day")).agg(
        F.sum(bytes_col).alias("bytes"), F.sum(slot_ms).alias("slot_ms"), F.count(F.lit(1)).alias("jobs"))
    reserve = slots * window_hours * SLOT_HOUR_USD
    on_demand = F.col("bytes") / float(TIB) * USD_PER_TIB
    bought_ms = slots * window_hours * 3600 * 1000
    out = g.select(
        "day", "jobs", F.round(F.col("bytes") / float(TIB), 6).alias("tib"),
        F.round(on_demand, 4).alias("on_demand_usd"), F.lit(round(reserve, 4)).alias("reservation_usd"),
        (F.col("slot_ms") <= bought_ms).alias("fits_reservation"),
        F.lit(round(reserve / USD_PER_TIB, 4)).alias("breakeven_tib"),
        F.when((on_demand > reserve) & (F.col("slot_ms") <= bought_ms), "reservation")
         .otherwise("on_demand").alias("choice"),
        F.round(F.col("slot_ms") / 3600000.0 * SLOT_HOUR_USD, 6).alias("autoscale_usd"),
        F.when((F.col("slot_ms") / 3600000.0 * SLOT_HOUR_USD <= on_demand)
               & ((F.col("slot_ms") > bought_ms) | (F.col("slot_ms") / 3600000.0 * SLOT_HOUR_USD <= reserve)),
               "autoscale")
         .when((F.col("slot_ms") <= bought_ms) & (F.lit(reserve) < on_demand), "reservation")
         .otherwise("on_demand").alias("choice_3way"))
    if commit_usd_per_slot_hour is not None:
        commit = slots * window_hours * commit_usd_per_slot_hour
        out = out.withColumn("commit_usd", F.lit(round(commit, 4))).withColumn(
            "breakeven_commit_tib", F.lit(round(commit / USD_PER_TIB, 4)))
    return out


def reservation_idle(jobs: DataFrame, ts: str, slot_ms: str, slots: int = 100) -> DataFrame:
    """AG62: slot-seconds used vs bought per day, idle share and idle cost."""
    bought_s = slots * 86400
    g = jobs.groupBy(F.col(ts).cast("date").alias("day")).agg((F.sum(slot_ms) / 1000.0).alias("used_slot_s"))
    idle = F.greatest(F.lit(0.0), 1 - F.col("used_slot_s") / bought_s)
    # exact inputs (integer sums) and the same operation order as SQL: no
    # rounding needed, and none that could split a half-way tie differently
    return g.select("day", "used_slot_s", (idle * 100).alias("idle_pct"),
                    (idle * slots * 24 * SLOT_HOUR_USD).alias("idle_usd"))


def stream_volume_cost(df: DataFrame, key: str, ts: str, payload: str, usd_per_tib: float = 40.0,
                       days: int = 30) -> DataFrame:
    """AG61: measured message rate and size -> monthly volume and the
    throughput-priced cost per component/key."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("messages"), F.avg(F.length(payload)).alias("_b"),
                            (F.unix_seconds(F.max(ts).cast("timestamp"))
                             - F.unix_seconds(F.min(ts).cast("timestamp"))).alias("_span"))
    rate = F.col("messages") / F.col("_span")
    gib = rate * F.col("_b") * 86400 * days / 2 ** 30
    return g.select(key, F.round(rate, 6).alias("msg_per_s"), F.round("_b", 4).alias("avg_bytes"),
                    F.round(gib, 6).alias("monthly_gib"), F.round(gib / 1024 * usd_per_tib, 6).alias("monthly_usd"))


def price_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small literal price list (fixed size: safe to broadcast)."""
    return spark.createDataFrame(rows, schema)
