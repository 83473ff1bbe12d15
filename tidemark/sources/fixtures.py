"""The analysis tables the operators run on, derived from the base tables.

Each builder mirrors one view of FIXTURES.md section 2 with the DataFrame
API.  Where the reference's data model is nested (billing credits and
labels, job stages) the Spark view carries the nested column as well, so the
nested operators are exercised against flat SQL oracles.

All builders are lazy: they add projections and joins to the plan and let
Catalyst prune the parquet columns each query actually reads.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Tables


def _tenant(user_id: Column) -> Column:
    return F.concat(F.lit("tenant_"), (user_id % 20).cast("string"))


def v_events(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        "event_id", "ts", F.col("ts").cast("date").alias("event_date"),
        _tenant(F.col("user_id")).alias("tenant_id"),
        "user_id", "event_type", F.col("value").alias("amount"),
        F.when(F.col("event_id") % 1000 == 0, F.lit(37000).cast("bigint"))
         .when(F.col("event_id") % 20 == 0, 45 + F.col("event_id") % 166)
         .otherwise(F.col("event_id") % 5).alias("skew_s"))


def v_requests(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        F.col("event_id").alias("request_id"), "ts", _tenant(F.col("user_id")).alias("tenant_id"),
        F.col("event_type").alias("endpoint"), F.col("value").alias("latency_ms"),
        F.when(F.col("event_id") % 997 == 0, 500)
         .when((F.col("event_type") == "error") & F.dayofmonth("ts").isin(10, 11), 503)
         .otherwise(200).alias("status"),
        ((F.col("event_id") % 3 == 0) & (F.col("event_type") != "purchase")).alias("cache_hit"))


def v_logs(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        F.col("event_id").alias("log_id"), "ts", F.col("ts").cast("date").alias("log_date"),
        F.when(F.col("event_type") == "error", "ERROR")
         .when(F.col("event_type") == "signup", "WARNING").otherwise("INFO").alias("severity"),
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("E_"), (F.col("event_id") % 7).cast("string"))).alias("error_code"),
        _tenant(F.col("user_id")).alias("tenant_id"))


def _lineitem_customer(t: Tables) -> DataFrame:
    """lineitem joined to its order's customer (two equi-joins on keys)."""
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return (t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(c, F.col("o_custkey") == F.col("c_custkey")))


def v_trips(t: Tables) -> DataFrame:
    n = t.nation.select("n_nationkey", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    lc = (_lineitem_customer(t)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return lc.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_id"),
        F.col("l_shipdate").alias("pickup_datetime"),
        (F.col("l_linenumber") % 2 + 1).alias("vendor_id"),
        (F.col("l_partkey") % 4 + 1).alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("tip_amount"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("total_amount"),
        F.col("r_name").alias("currency"))


def v_fx_rates(t: Tables) -> DataFrame:
    """One rate per (currency, calendar day).

    The day list is the distinct ship days (bounded by the calendar, not by
    row count).  Each day is expanded over the region keys with ``explode``
    and then equi-joined to region, so no Cartesian operator is planned.
    """
    days = t.lineitem.select(F.col("l_shipdate").cast("date").alias("rate_date")).distinct()
    lo = t.region.select(F.min("r_regionkey")).scalar()
    hi = t.region.select(F.max("r_regionkey")).scalar()
    r = t.region.select("r_regionkey", "r_name")
    exp = days.withColumn("r_regionkey", F.explode(F.sequence(lo, hi)))
    return (exp.join(r, "r_regionkey")
            .select(F.col("r_name").alias("currency"), "rate_date",
                    # decimal arithmetic, then double: the exact rate rounded once
                    (F.lit(1) + F.col("r_regionkey") * F.lit(Decimal("0.1"))
                     + F.dayofmonth("rate_date") * F.lit(Decimal("0.001"))).cast("double").alias("rate")))


def v_billing(t: Tables) -> DataFrame:
    p = t.part.select("p_partkey", "p_type", "p_brand")
    lc = _lineitem_customer(t).join(p, F.col("l_partkey") == F.col("p_partkey"))
    credit = -F.col("l_extendedprice") * F.col("l_discount")
    cost_center = F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    out = lc.select(
        F.col("p_type").alias("service"), F.col("p_brand").alias("sku"),
        F.col("l_shipdate").alias("usage_start_time"), F.col("l_extendedprice").alias("cost"),
        credit.alias("credit_amount"), cost_center.alias("cost_center"))
    # nested forms of the export: credits[] and labels[]
    credit_struct = F.struct(F.col("credit_amount").alias("amount"),
                             F.lit("discount").alias("name"), F.lit("DISCOUNT").alias("type"))
    label_struct = F.struct(F.lit("cost_center").alias("key"), F.col("cost_center").alias("value"))
    return out.select(
        "*",
        F.when(F.col("credit_amount") < 0, F.array(credit_struct))
         .otherwise(F.array().cast("array<struct<amount:double,name:string,type:string>>")).alias("credits"),
        F.when(F.col("cost_center").isNotNull(), F.array(label_struct))
         .otherwise(F.array().cast("array<struct<key:string,value:string>>")).alias("labels"))


def v_job_stages(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(
        F.col("l_orderkey").alias("job_id"), F.col("l_linenumber").alias("stage_id"),
        (F.col("l_quantity").cast("bigint") * (F.col("l_partkey") % 3) * 100).alias("records_read"),
        F.floor("l_extendedprice").cast("bigint").alias("records_written"),
        (F.col("l_suppkey") % 13 * 100).alias("slot_ms"),
        (F.col("l_linenumber") <= 2).alias("reads_from_table"))


def v_jobs(t: Tables, nested: bool = False) -> DataFrame:
    c = t.customer.select("c_custkey", "c_name")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    jobs = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("job_id"), F.col("c_name").alias("user_email"),
        F.col("o_orderdate").alias("creation_time"),
        F.concat(F.lit("SELECT "), F.col("o_orderpriority"), F.lit("  FROM  t")).alias("query"),
        (F.floor("o_totalprice").cast("bigint") * 1000000).alias("total_bytes_billed"),
        (F.col("o_orderkey") % 97 * 1000).alias("total_slot_ms"),
        (F.floor("o_totalprice").cast("bigint") * 999000).alias("total_bytes_processed"),
        F.when(F.col("o_orderkey") % 11 == 0, "LOAD").otherwise("QUERY").alias("job_type"),
        F.when(F.col("o_orderkey") % 13 == 0, "RUNNING").otherwise("DONE").alias("state"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 5).cast("int"))).alias("start_time"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 5 + F.col("o_orderkey") % 301).cast("int"))).alias("end_time"))
    if not nested:
        return jobs
    # job_stages ARRAY<STRUCT> as in the job history view: stages per job
    # are few (<= 7), so collect_list per job is bounded.
    st = (v_job_stages(t).groupBy("job_id")
          .agg(F.collect_list(F.struct("stage_id", "records_read", "records_written", "slot_ms",
                                       "reads_from_table")).alias("job_stages")))
    return jobs.join(st, "job_id", "left")


def v_source(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                           F.floor(F.col("o_totalprice") * 100).cast("bigint").alias("total_cents"))


def v_target(t: Tables) -> DataFrame:
    o = t.orders.where(F.col("o_orderkey") % 500 != 0)
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    (F.floor(F.col("o_totalprice") * 100).cast("bigint")
                     + F.when(F.col("o_orderkey") % 333 == 0, 1).otherwise(0)).alias("total_cents"))


def v_changes(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(
        (F.col("o_orderkey") % 1000).alias("id"), F.col("o_orderkey").alias("version"),
        F.col("o_orderdate").alias("commit_ts"),
        F.when(F.col("o_orderkey") % 17 == 0, "D").when(F.col("o_orderkey") < 1000, "I")
         .otherwise("U").alias("op"),
        F.col("o_totalprice").alias("payload"))


def v_spans(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        F.floor(F.col("event_id") / 4).cast("bigint").alias("trace_id"), F.col("event_id").alias("span_id"),
        F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("event_id") - 1).alias("parent_span_id"),
        F.col("ts").alias("start_time"), F.col("value").alias("duration_ms"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("OK").alias("status"))


def v_probes(t: Tables) -> DataFrame:
    e = t.events
    return e.select(F.col("event_id").alias("seq"), "ts",
                    (~(F.col("event_id") % 100).between(40, 55)).alias("ok"),
                    F.col("value").alias("latency_ms"))


def v_attempts(t: Tables) -> DataFrame:
    e = t.events
    return e.select(F.col("event_id").alias("attempt_id"), (F.col("event_id") % 500).alias("message_id"),
                    F.concat(F.lit("acct-"), (F.col("event_id") % 25).cast("string")).alias("ordering_key"),
                    "ts", (F.col("event_id") % 500 % 50 != 0).alias("acked"))


ROLE_BY_MOD = ["roles/owner", "roles/editor", "roles/viewer", "roles/iam.serviceAccountUser",
               "roles/storage.admin", "projects/p/roles/custom"]


def v_bindings(t: Tables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    role = F.when(k % 6 == 0, ROLE_BY_MOD[0])
    for i, r in enumerate(ROLE_BY_MOD[1:-1], start=1):
        role = role.when(k % 6 == i, r)
    role = role.otherwise(ROLE_BY_MOD[-1])
    member = F.concat(F.when(k % 4 == 0, "group:g").otherwise("serviceAccount:sa"), (k % 40).cast("string"))
    return c.select(role.alias("role"), member.alias("member"), (k % 9 == 0).alias("has_condition"))


def v_calls(t: Tables) -> DataFrame:
    e = t.events
    u = F.col("user_id") % 3
    return e.select(
        F.col("event_id").alias("call_id"), "ts",
        F.when(u == 0, "endpoint").when(u == 1, "api").otherwise("self_hosted").alias("option_name"),
        F.col("value").alias("latency_ms"), (40 + F.col("event_id") % 10).alias("input_tokens"),
        (50 + F.col("event_id") % 20).alias("output_tokens"), (F.col("event_type") == "error").alias("failed"))


def v_audit(t: Tables) -> DataFrame:
    e = t.events
    eid = F.col("event_id")
    return e.select(
        eid.alias("entry_id"), "ts",
        F.concat(F.lit("user"), (F.col("user_id") % 30).cast("string"), F.lit("@example.com")).alias("principal"),
        F.when(eid % 2 == 0, "bigquery").otherwise("storage").alias("service"),
        F.col("event_type").alias("method"), (eid % 40 == 0).alias("dry_run_denied"),
        F.when(eid % 40 == 0, F.when(eid % 80 == 0, "NO_MATCHING_ACCESS_LEVEL")
               .otherwise("NETWORK_NOT_IN_SAME_PERIMETER")).alias("violation_reason"))


BUILDERS = {
    "v_events": v_events, "v_requests": v_requests, "v_logs": v_logs, "v_trips": v_trips,
    "v_fx_rates": v_fx_rates, "v_billing": v_billing, "v_jobs": v_jobs, "v_job_stages": v_job_stages,
    "v_source": v_source, "v_target": v_target, "v_changes": v_changes, "v_spans": v_spans,
    "v_probes": v_probes, "v_attempts": v_attempts, "v_bindings": v_bindings, "v_calls": v_calls,
    "v_audit": v_audit,
}

