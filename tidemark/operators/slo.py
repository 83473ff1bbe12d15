"""Observability: log routing metrics, SLIs, error budgets, burn-rate
alerts, threshold and traffic-floor alerts, backlog, breach/recovery
timelines (PF8, PF11, AG44-AG50, AG55-AG59, AG65-AG68, WI3-WI5).

Time-ordered work is first reduced to fixed time buckets (one row per
series and bucket, partially aggregated), so every window below runs over
at most ``span / bucket`` rows per series, whatever the request volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import at_least_severity
from .sequence import _join_back, prev_within, rank_values, running_sum, time_bucket

# ---- fixed values: burn-rate alert pairs of the reference ------------------
# (name, long lookback s, short lookback s, burn threshold)
BURN_ALERTS = [("PAGE_FAST", 3600, 300, 14.4), ("PAGE_SLOW", 21600, 1800, 6.0), ("TICKET", 259200, 21600, 1.0)]
LOOKBACKS_S = [300, 1800, 3600, 21600, 259200]
# Error-budget policy buckets (share of budget used).
BUDGET_POLICY = [(1.0, "exhausted"), (0.9, "freeze"), (0.75, "slow_down"), (0.5, "review")]


def _epoch_s(c) -> Column:
    return F.unix_seconds(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp"))


def severity_filter(logs: DataFrame, level: str, col: str = "severity") -> DataFrame:
    """PF8: entries at or above ``level`` in severity order."""
    return logs.where(at_least_severity(col, level))


def good_events(df: DataFrame, status: str = "status", latency: str = "latency_ms",
                latency_ms: float = 300.0) -> DataFrame:
    """PF11: ``valid`` (status present), ``good`` (not 5xx) and
    ``latency_good`` (2xx within ``latency_ms``) columns."""
    s = F.col(status)
    return df.select("*", s.isNotNull().alias("valid"), (s.isNotNull() & ((s < 500) | (s >= 600))).alias("good"),
                     (s.between(200, 299) & (F.col(latency) <= latency_ms)).alias("latency_good"))


def top_error_codes(logs: DataFrame, code: str = "error_code", n: int = 10) -> DataFrame:
    """AG44: most frequent error codes."""
    return (logs.where(F.col(code).isNotNull()).groupBy(code).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(code)).limit(n))


def tenant_error_rate(logs: DataFrame, requests: DataFrame, tenant: str = "tenant_id") -> DataFrame:
    """AG45: error log entries per tenant over its requests, and the noisiest
    tenant (highest rate; the maximum is a scalar subquery)."""
    e = logs.where(F.col("severity") == "ERROR").groupBy(tenant).agg(F.count(F.lit(1)).alias("errors"))
    r = requests.groupBy(tenant).agg(F.count(F.lit(1)).alias("requests"))
    j = r.join(e, tenant, "left").select(tenant, "requests", F.coalesce("errors", F.lit(0)).alias("errors"))
    j = j.withColumn("error_rate", F.col("errors") / F.col("requests"))
    top = j.select(F.max("error_rate")).scalar()
    return j.withColumn("noisiest", F.col("error_rate") == top)


def first_seen(logs: DataFrame, code: str = "error_code", ts: str = "ts") -> DataFrame:
    """AG46: first and last occurrence and count per error code."""
    return (logs.where(F.col(code).isNotNull()).groupBy(code)
            .agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count(F.lit(1)).alias("n")))


def minute_latency(requests: DataFrame, ts: str = "ts", latency: str = "latency_ms") -> DataFrame:
    """AG47: per minute: requests, request rate per second, nearest-rank
    p50/p99 latency."""
    d = requests.withColumn("minute", F.date_trunc("minute", ts).cast("timestamp_ntz"))
    n = F.col("n")
    p = rank_values(d, ["minute"], latency, {"p50_ms": F.greatest(F.lit(1), F.ceil(n * 0.5)),
                                             "p99_ms": F.greatest(F.lit(1), F.ceil(n * 0.99))})
    return p.select("minute", F.col("n").alias("requests"), (F.col("n") / 60.0).alias("req_per_s"), "p50_ms", "p99_ms")


def daily_slis(requests: DataFrame, events: DataFrame, latency_ms: float = 300.0,
               fresh_s: int = 60) -> DataFrame:
    """AG48: per day, request SLI good/valid, latency SLI and freshness SLI
    (share of events landed within ``fresh_s`` of event time)."""
    g = good_events(requests, latency_ms=latency_ms)
    r = g.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count_if("valid").alias("valid"), F.count_if("good").alias("good"),
        F.count_if("latency_good").alias("latency_good"))
    f = events.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("skew_s") <= fresh_s).alias("fresh"))
    j = r.join(f, "day", "full_outer")
    return j.select("day", "valid", (F.col("good") / F.col("valid")).alias("availability_sli"),
                    (F.col("latency_good") / F.col("valid")).alias("latency_sli"),
                    (F.col("fresh") / F.col("events")).alias("freshness_sli"))


def good_minutes_sli(requests: DataFrame, max_error_rate: float = 0.01) -> DataFrame:
    """AG49: windows-based SLI: per day, share of (non-empty) minutes whose
    error rate is below ``max_error_rate``."""
    m = requests.groupBy(F.date_trunc("minute", "ts").alias("_m")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("status") >= 500).alias("_e"))
    return (m.groupBy(F.col("_m").cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("minutes"),
                 F.count_if(F.col("_e") / F.col("_n") < max_error_rate).alias("good_minutes"))
            .withColumn("good_minute_sli", F.col("good_minutes") / F.col("minutes")))


def error_budget(requests: DataFrame, key: str, goal: float, window_days: int, lo: str, hi: str) -> DataFrame:
    """AG50: allowed bad events, used fraction, burn rate, days to exhaust a
    full ``window_days`` budget at that burn (``window_days / burn``), days
    left for the remaining budget, and the policy bucket, per key over
    ``[lo, hi)``.  A goal of 1.0 leaves no budget and is rejected."""
    if not 0 < goal < 1:
        raise ValueError("SLO goal must be in (0, 1); 1.0 leaves no error budget")
    budget = round(1 - goal, 12)
    d = good_events(requests.where((F.col("ts") >= F.to_timestamp_ntz(F.lit(lo)))
                                   & (F.col("ts") < F.to_timestamp_ntz(F.lit(hi)))))
    g = d.groupBy(key).agg(F.count_if("valid").alias("valid"), F.count_if(F.col("valid") & ~F.col("good")).alias("bad"))
    allowed = F.col("valid") * F.lit(budget)
    used = F.col("bad") / allowed
    burn = (F.col("bad") / F.col("valid")) / F.lit(budget)
    policy = F.lit("ok")
    for th, name in reversed(BUDGET_POLICY):
        policy = F.when(used >= th, name).otherwise(policy)
    return g.select(key, "valid", "bad", allowed.alias("allowed_bad"), used.alias("budget_used"),
                    burn.alias("burn_rate"),
                    F.when(burn > 0, F.lit(float(window_days)) / burn).alias("days_to_exhaustion"),
                    F.when(burn > 0, F.greatest(F.lit(0.0), F.lit(float(window_days)) * (1 - used) / burn))
                    .alias("days_left"),
                    policy.alias("policy"))


def burn_rates(requests: DataFrame, key: str, goal: float, bucket_s: int = 300,
               lookbacks: Sequence[int] = LOOKBACKS_S) -> DataFrame:
    """WI3: trailing burn rate ``(1 - SLI) / (1 - goal)`` over each lookback,
    per key and ``bucket_s`` bucket.  Requests are pre-aggregated to one row
    per key and bucket, then ``rangeBetween`` windows sum the buckets."""
    budget = round(1 - goal, 12)
    d = good_events(requests)
    b = (d.groupBy(key, (F.floor(_epoch_s("ts") / bucket_s) * bucket_s).cast("bigint").alias("bucket_epoch"))
         .agg(F.count_if("valid").alias("valid"), F.count_if(F.col("valid") & ~F.col("good")).alias("bad")))
    out = b
    for lb in lookbacks:
        w = Window.partitionBy(key).orderBy("bucket_epoch").rangeBetween(-(lb - bucket_s), 0)
        out = out.withColumn(f"burn_{lb}s", (F.sum("bad").over(w) / F.sum("valid").over(w)) / F.lit(budget))
    return out.withColumn("bucket_start", F.timestamp_seconds("bucket_epoch").cast("timestamp_ntz"))


def multiwindow_alerts(burn: DataFrame, key: str) -> DataFrame:
    """WI4: an alert is open in a bucket when both its long and short
    lookback burn rates exceed the threshold.  Returns the open (key,
    bucket, alert) rows; ``alert_episodes`` joins them to episodes."""
    rows = []
    for name, long_s, short_s, th in BURN_ALERTS:
        fire = (F.col(f"burn_{long_s}s") > th) & (F.col(f"burn_{short_s}s") > th)
        rows.append(F.struct(F.lit(name).alias("alert"), fire.alias("open")))
    x = burn.select(key, "bucket_start", F.explode(F.array(*rows)).alias("_a"))
    return x.where("_a.open").select(key, "bucket_start", F.col("_a.alert").alias("alert"))


def alert_episodes(alerts: DataFrame, key: str, bucket_s: int = 300, auto_close_s: int = 1800) -> DataFrame:
    """WI4: episodes of an alert.  An episode opens with its first open
    bucket, stays open over pauses (buckets below the threshold or without
    traffic) of up to ``auto_close_s`` and closes that long after the end of
    its last open bucket.  Input: one row per key, alert and open bucket."""
    e = alerts.select(key, "alert", "bucket_start", _epoch_s("bucket_start").alias("_e"))
    day = F.floor(F.col("_e") / 86400)
    e = prev_within(e, [key, "alert"], ["_e"], ["_e"], day)
    new = F.col("prev__e").isNull() | (F.col("_e") - F.col("prev__e") - bucket_s > auto_close_s)
    e = running_sum(e.withColumn("_new", new.cast("int")), [key, "alert"], ["_e"], "_new", day, "_episode")
    g = e.groupBy(key, "alert", "_episode").agg(F.min("_e").alias("_a"), F.max("_e").alias("_z"), F.count(F.lit(1)).alias("open_buckets"))
    stamp = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return g.select(key, "alert", stamp(F.col("_a")).alias("opened_at"),
                    stamp(F.col("_z") + bucket_s + auto_close_s).alias("closed_at"), "open_buckets")


def runs(df: DataFrame, keys: Sequence[str], seq: str, flag: str, bucket: Column) -> tuple[DataFrame, DataFrame]:
    """Gaps-and-islands over an ordered series, bucket-split.

    Returns ``(rows, runs)``: ``rows`` adds ``run_start`` (``seq`` of the
    first row of the row's run of equal ``flag``) and ``pos`` (1-based
    position in the run); ``runs`` has one row per run with its flag,
    length, end and the run before it (``prev_run_start``).  ``seq`` must
    be unique and sortable per key, and ``bucket`` non-decreasing in
    ``seq`` (e.g. the hour of the timestamp).

    Plan (no window ever orders all rows, pieces or runs of a key):
      1. rows: the classic ``row_number() - row_number() per flag`` islands
         inside each (key, bucket) -- one exchange;
      2. pieces: one row per island and bucket, aggregated on the same
         partitioning, ordered inside their bucket;
      3. buckets: one row per key and bucket (first and last piece); a
         window over buckets per key carries a run across bucket borders,
         through buckets that are one single continuing piece;
      4. rows get their run and offset back by a null-safe equi-join."""
    keys = list(keys)
    d = df.withColumn("_b", bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(seq)
    wf = Window.partitionBy(*keys, "_b", flag).orderBy(seq)
    d = d.withColumn("_rf", F.row_number().over(wf)).withColumn("_g", F.row_number().over(w) - F.col("_rf"))
    pieces = d.groupBy(*keys, "_b", flag, "_g").agg(
        F.min(seq).alias("_s"), F.max(seq).alias("_e"), F.count(F.lit(1)).alias("_n"), F.min("_rf").alias("_rf0"))
    wpb = Window.partitionBy(*keys, "_b").orderBy("_s")
    pieces = pieces.withColumn("_pi", F.row_number().over(wpb))
    piece = F.struct(F.col(flag).alias("f"), F.col("_s").alias("s"), F.col("_n").alias("n"))
    bs = pieces.groupBy(*keys, "_b").agg(
        F.min_by(piece, F.col("_s")).alias("_first"), F.max_by(piece, F.col("_s")).alias("_last"),
        F.count(F.lit(1)).alias("_np"), F.sum("_n").alias("_bn"))
    wk = Window.partitionBy(*keys).orderBy("_b")
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    bs = (bs.withColumn("_cont", F.coalesce(F.lag("_last.f").over(wk) == F.col("_first.f"), F.lit(False)))
          .withColumn("_pass", (F.col("_np") == 1) & F.col("_cont"))
          .withColumn("_cum", F.sum("_bn").over(wk.rowsBetween(Window.unboundedPreceding, 0))))
    # the latest earlier bucket that is not one continuing piece: the run of
    # this bucket's first piece (when it continues) starts at its last piece
    anchor = F.when(~F.col("_pass"), F.struct(F.col("_last.s").alias("s"), F.col("_last.n").alias("n"),
                                                F.col("_cum").alias("cum")))
    bs = bs.withColumn("_anc", F.last(anchor, ignorenulls=True).over(before))
    carried = F.col("_anc.n") + (F.col("_cum") - F.col("_bn") - F.col("_anc.cum"))
    bs = (bs.withColumn("_first_rs", F.when(F.col("_cont"), F.col("_anc.s")).otherwise(F.col("_first.s")))
          .withColumn("_first_off", F.when(F.col("_cont"), carried).otherwise(F.lit(0)).cast("bigint")))
    last_rs = F.when(F.col("_np") == 1, F.col("_first_rs")).otherwise(F.col("_last.s"))
    bs = bs.withColumn("_prev_last_rs", F.lag(last_rs).over(wk))
    pieces = pieces.join(bs.select(*keys, "_b", "_cont", "_first_rs", "_first_off", "_prev_last_rs"), [*keys, "_b"])
    first = F.col("_pi") == 1
    pieces = (pieces.withColumn("run_start", F.when(first, F.col("_first_rs")).otherwise(F.col("_s")))
              .withColumn("_off", F.when(first, F.col("_first_off")).otherwise(F.lit(0)).cast("bigint"))
              .withColumn("_new", ~(first & F.col("_cont"))))
    pieces = pieces.withColumn("_prev_rs", F.when(first, F.col("_prev_last_rs"))
                               .otherwise(F.lag("run_start").over(wpb)))
    run_tbl = pieces.groupBy(*keys, "run_start", flag).agg(
        F.sum("_n").alias("length"), F.max("_e").alias("run_end"),
        F.max(F.when(F.col("_new"), F.col("_prev_rs"))).alias("prev_run_start"))
    rows = _join_back(d, pieces.select(*keys, "_b", flag, "_g", "run_start", "_off", "_rf0"), [*keys, "_b", flag, "_g"])
    rows = rows.withColumn("pos", F.col("_off") + F.col("_rf") - F.col("_rf0") + 1).drop(
        "_b", "_rf", "_g", "_off", "_rf0")
    return rows, run_tbl


def breach_timeline(probes: DataFrame, seq: str = "seq", ts: str = "ts", ok: str = "ok",
                    hysteresis: int = 3, bucket: Column | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """WI5: incidents of a probe series.  An incident opens at the
    ``hysteresis``-th bad probe in a row (impact) and closes at the first
    later ``hysteresis``-th good probe in a row (recovery); shorter runs in
    between change nothing.  An incident without recovery keeps NULLs.

    Only runs of that length matter, one row each (the probe that completes
    it); where their state changes, an incident opens or closes."""
    b = bucket if bucket is not None else time_bucket(ts)
    k = [*keys] or ["_series"]
    d = probes if keys else probes.withColumn("_series", F.lit(1))
    rows, _ = runs(d.select(*k, seq, ts, ok), k, seq, ok, b)
    full = rows.where(F.col("pos") == hysteresis).select(*k, seq, ts, ok)
    full = prev_within(full, k, [seq], [ok], b)
    turn = full.where(F.coalesce(F.col("prev_" + ok) != F.col(ok), ~F.col(ok))).select(*k, seq, ts, ok)
    turn = prev_within(turn, k, [seq], [seq, ts], b)
    opened = turn.where(~F.col(ok)).select(*k, F.col(seq).alias("impact_seq"), F.col(ts).alias("impact_ts"))
    closed = turn.where(F.col(ok)).select(*[F.col(c).alias(f"{c}__r") for c in k], F.col("prev_" + seq).alias("impact_seq__r"),
                                          F.col(seq).alias("recover_seq"), F.col(ts).alias("recover_ts"))
    cond = F.col("impact_seq") == F.col("impact_seq__r")
    for c in k:
        cond = cond & F.col(c).eqNullSafe(F.col(f"{c}__r"))
    g = opened.join(closed, cond, "left")
    rs = (F.unix_micros(F.col("recover_ts").cast("timestamp")) - F.unix_micros(F.col("impact_ts").cast("timestamp"))) / 1e6
    return g.select(*keys, "impact_seq", "impact_ts", "recover_seq", "recover_ts", rs.alias("recovery_s"))


def fault_recovery(probes: DataFrame, faults: DataFrame, seq: str = "seq", ts: str = "ts", ok: str = "ok",
                   hysteresis: int = 3) -> DataFrame:
    """WI5 against injected faults (``faults(fault_ts)``): of the probes from
    a fault to the next one the first incident; recovery is counted from the
    fault.  A fault without a sustained breach was absorbed: its recovery is
    the fault time."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    null = F.lit(None)
    marks = faults.select(null.cast("bigint").alias(seq), F.col("fault_ts").alias(ts), null.cast("boolean").alias(ok), F.lit(1).alias("_mark"))
    u = probes.select(F.col(seq).cast("bigint").alias(seq), ts, ok, F.lit(0).alias("_mark")).unionByName(marks).withColumn("_series", F.lit(1))
    u = u.withColumn("_first", F.when(F.col("_mark") == 1, 0).otherwise(1))
    u = running_sum(u, ["_series"], [ts, "_first", seq], "_mark", time_bucket(ts), "fault_no")
    named = u.where("_mark = 1").select("fault_no", F.col(ts).alias("fault_ts"))
    inc = breach_timeline(u.where("_mark = 0 AND fault_no > 0"), seq, ts, ok, hysteresis, keys=["fault_no"])
    first = inc.groupBy("fault_no").agg(F.min(F.struct("impact_seq", "impact_ts", "recover_seq", "recover_ts")).alias("_i"))
    j = named.join(first, "fault_no", "left").select("fault_ts", F.col("_i.impact_ts").alias("impact_ts"),
                                                     F.when(F.col("_i").isNull(), F.col("fault_ts")).otherwise(F.col("_i.recover_ts"))
                                                     .alias("recover_ts"))
    return j.withColumn("recovery_s", (us("recover_ts") - us("fault_ts")) / 1e6)


def drill_verdict(incidents: DataFrame, attempts: DataFrame, ts: str = "ts", acked: str = "acked",
                  max_recovery_s: float = 300.0) -> DataFrame:
    """AG66: per incident, dead-letter depth (never-acked messages published
    before the instant) at impact and at recovery, and the verdict PASS when
    recovery took under ``max_recovery_s`` and the depth did not change.

    The "count of rows before t" is a running count over one ordered series
    of messages and incident markers, bucket-split by hour, so no non-equi
    join is planned.  The incident table (small: one row per incident) is
    used three times, so it is checkpointed to the shared checkpoint folder
    first."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(incidents.sparkSession)
    incidents = incidents.checkpoint(eager=True)
    msgs = attempts.where(~F.col(acked)).select(F.col(ts).alias("_t"), F.lit(1).alias("_kind"),
                                                F.lit(1).alias("_v"), F.lit(None).cast("bigint").alias("_inc"),
                                                F.lit(None).cast("string").alias("_tag"))
    mk_i = incidents.select(F.col("impact_ts").alias("_t"), F.lit(0).alias("_kind"), F.lit(0).alias("_v"),
                            F.col("impact_seq").alias("_inc"), F.lit("impact").alias("_tag"))
    mk_r = incidents.where(F.col("recover_ts").isNotNull()).select(
        F.col("recover_ts").alias("_t"), F.lit(0).alias("_kind"), F.lit(0).alias("_v"),
        F.col("impact_seq").alias("_inc"), F.lit("recover").alias("_tag"))
    u = msgs.unionByName(mk_i).unionByName(mk_r).withColumn("_series", F.lit(1))
    r = running_sum(u, ["_series"], ["_t", "_kind", "_inc", "_tag"], "_v", time_bucket("_t"), "_depth")
    m = r.where(F.col("_kind") == 0).groupBy(F.col("_inc").alias("impact_seq")).agg(
        F.max(F.when(F.col("_tag") == "impact", F.col("_depth"))).alias("dlq_at_impact"),
        F.max(F.when(F.col("_tag") == "recover", F.col("_depth"))).alias("dlq_at_recovery"))
    j = incidents.join(m, "impact_seq", "left")
    ok = (F.col("recovery_s") < max_recovery_s) & (F.col("dlq_at_impact") == F.col("dlq_at_recovery"))
    return j.select("impact_seq", "impact_ts", "recover_ts", "recovery_s", "dlq_at_impact", "dlq_at_recovery",
                    F.when(ok, "PASS").otherwise("FAIL").alias("verdict"))


def threshold_islands(df: DataFrame, key: str, ts: str, value: str, threshold: float, min_buckets: int,
                      bucket_s: int = 600) -> DataFrame:
    """AG56: ``max(value) > threshold`` for at least ``min_buckets``
    consecutive buckets, per key: start, end and length of each episode.
    Islands by ``bucket_index - row_number`` over the breaching buckets."""
    b = (df.groupBy(key, F.floor(_epoch_s(ts) / bucket_s).cast("bigint").alias("_k"))
         .agg(F.max(value).alias("_v")).where(F.col("_v") > threshold))
    w = Window.partitionBy(key).orderBy("_k")
    b = b.withColumn("_isl", F.col("_k") - F.row_number().over(w))
    g = b.groupBy(key, "_isl").agg(F.min("_k").alias("_s"), F.max("_k").alias("_e"), F.count(F.lit(1)).alias("buckets"))
    return g.where(F.col("buckets") >= min_buckets).select(
        key, F.timestamp_seconds(F.col("_s") * bucket_s).cast("timestamp_ntz").alias("episode_start"),
        F.timestamp_seconds((F.col("_e") + 1) * bucket_s).cast("timestamp_ntz").alias("episode_end"), "buckets")


def traffic_floor(requests: DataFrame, ts: str = "ts", unit: str = "hour", floor: int = 3,
                  keys: Sequence[str] = (), as_of: str | None = None) -> DataFrame:
    """AG57: buckets below ``floor`` requests, empty ones included, per series
    (``keys``).  The spine of a series runs from its first bucket to the last
    whole one before ``as_of`` (without it to the last bucket of the table), so traffic that
    fell to nothing and stayed there is reported; its size is the time span."""
    c = requests.groupBy(*keys, F.date_trunc(unit, ts).cast("timestamp_ntz").alias("bucket")).agg(
        F.count(F.lit(1)).alias("requests"))
    one = F.expr(f"INTERVAL 1 {unit.upper()}")
    end = (F.date_trunc(unit, F.lit(as_of).cast("timestamp_ntz")).cast("timestamp_ntz") - one if as_of
           else c.select(F.max("bucket")).scalar())
    span = (c.groupBy(*keys) if keys else c).agg(F.min("bucket").alias("_lo")).where(F.col("_lo") <= end)
    spine = span.select(*[F.col(k).alias(f"{k}__r") for k in keys], F.explode(F.sequence("_lo", end, one)).alias("bucket__r"))
    cond = F.col("bucket") == F.col("bucket__r")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"{k}__r"))
    j = spine.join(c, cond, "left").select(*[F.col(f"{k}__r").alias(k) for k in keys], F.col("bucket__r").alias("bucket"),
                                           F.coalesce("requests", F.lit(0)).alias("requests"))
    return j.where(F.col("requests") < floor)


def guarded_ratio(requests: DataFrame, ts: str = "ts", unit: str = "hour", min_requests: int = 20) -> DataFrame:
    """AG58: error ratio per bucket, NULL when fewer than ``min_requests``."""
    g = requests.groupBy(F.date_trunc(unit, ts).cast("timestamp_ntz").alias("bucket")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status") >= 500).alias("errors"))
    return g.withColumn("error_ratio", F.when(F.col("requests") >= min_requests,
                                              F.col("errors") / F.col("requests")))


def label_cardinality(df: DataFrame, labels: Sequence[str], bound: int, approx: bool = False,
                      rsd: float = 0.02) -> DataFrame:
    """AG59: distinct values per metric label against a cardinality bound.
    Exact ``count(DISTINCT)`` by default (one expand + two-level aggregate);
    ``approx=True`` uses HyperLogLog++ sketches (``approx_count_distinct``,
    fixed memory per label, one pass) for very wide tables."""
    agg = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    a = df.agg(*[agg(c).alias(c) for c in labels])
    x = a.select(F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("distinct_values"))
                                     for c in labels])).alias("_x")).select("_x.*")
    return x.withColumn("over_bound", F.col("distinct_values") > bound)


def cache_hit_ratio(requests: DataFrame, path: str = "endpoint", hit: str = "cache_hit") -> DataFrame:
    """AG65: hit ratio per path and paths that never hit."""
    return (requests.groupBy(path).agg(F.count(F.lit(1)).alias("requests"),
                                       F.avg(F.col(hit).cast("int")).alias("hit_ratio"),
                                       (F.count_if(hit) == 0).alias("never_hit")))


def per_minute_count(logs: DataFrame, ts: str = "ts") -> DataFrame:
    """AG67: log-based metric, entries per 1-minute event-time window."""
    return (logs.groupBy(F.window(F.col(ts).cast("timestamp"), "1 minute").alias("w"))
            .agg(F.count(F.lit(1)).alias("entries"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("minute"), "entries"))


def key_throughput(df: DataFrame, key: str, ts: str, msg_bytes: Column, limit_bytes_s: int = 1_000_000) -> DataFrame:
    """AG68: bytes per ordering key and second; peak per key vs the 1 MB/s
    per-key bound."""
    s = df.groupBy(key, F.date_trunc("second", ts).alias("_s")).agg(F.sum(msg_bytes).alias("_b"))
    return (s.groupBy(key).agg(F.max("_b").alias("peak_bytes_per_s"), F.count(F.lit(1)).alias("active_seconds"))
            .withColumn("over_limit", F.col("peak_bytes_per_s") > limit_bytes_s))


def backlog(attempts: DataFrame, ts: str, acked: str, ack_lag_s: Column, bucket_s: int = 3600) -> DataFrame:
    """AG55: per time bucket, messages published and acked, backlog depth
    at the bucket end (running sum of +1 publish / -1 ack over buckets) and
    the age of the oldest unacked message; plus the verdict ``climbing`` /
    ``flat`` from the slope of depth over buckets (scalar subquery).

    A message is open at every bucket end from its publish to its ack,
    however long that takes.  Never-acked ones stay open (running minimum);
    the others are first reduced to the oldest publish per (publish bucket,
    ack bucket) and those rows, one per pair of buckets, are spread over the
    bucket ends between.  Buckets in which nothing was published or acked
    are on the spine too."""
    e = _epoch_s(ts)
    d = attempts.select(F.floor(e / bucket_s).cast("bigint").alias("_k"), e.alias("_pub"),
                        F.when(F.col(acked), e + ack_lag_s).alias("_ack"))
    d = d.withColumn("_ka", F.floor(F.col("_ack") / bucket_s).cast("bigint"))
    pub = d.groupBy("_k").agg(F.count(F.lit(1)).alias("published"),
                              F.min(F.when(F.col("_ack").isNull(), F.col("_pub"))).alias("_min_never"))
    ack = d.where(F.col("_ack").isNotNull()).groupBy(F.col("_ka").alias("_k")).agg(F.count(F.lit(1)).alias("acked"))
    held = (d.where(F.col("_ka") > F.col("_k")).groupBy("_k", "_ka").agg(F.min("_pub").alias("_pub"))
            .select(F.explode(F.sequence(F.col("_k"), F.col("_ka") - 1)).alias("_k"), "_pub")
            .groupBy("_k").agg(F.min("_pub").alias("_min_cross")))
    last = F.greatest(F.max("_k"), F.max("_ka"))
    spine = d.agg(F.min("_k").alias("_lo"), last.alias("_hi")).where("_lo IS NOT NULL").select(
        F.explode(F.sequence("_lo", "_hi")).alias("_k"))
    g = (spine.join(pub, "_k", "left").join(ack, "_k", "left").join(held, "_k", "left")
         .select("_k", F.coalesce("published", F.lit(0)).alias("published"), F.coalesce("acked", F.lit(0)).alias("acked"),
                 "_min_never", "_min_cross"))
    w = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    g = (g.withColumn("depth", F.sum(F.col("published") - F.col("acked")).over(w))
         .withColumn("_never_run", F.min("_min_never").over(w)))
    oldest = F.least(F.col("_never_run"), F.col("_min_cross"))
    out = g.select(F.timestamp_seconds((F.col("_k") + 1) * bucket_s).cast("timestamp_ntz").alias("bucket_end"),
                   "published", "acked", "depth",
                   ((F.col("_k") + 1) * bucket_s - oldest).alias("oldest_unacked_age_s"), F.col("_k"))
    slope = out.select(F.regr_slope(F.col("depth").cast("double"), F.col("_k").cast("double"))).scalar()
    return out.withColumn("verdict", F.when(slope > 0.01, "climbing").otherwise("flat")).drop("_k")
