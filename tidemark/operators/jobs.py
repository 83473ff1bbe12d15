"""Job-history analyses: cost per job and user, billing minimum and free
tier, stage-level plan reading, and layout advice (AG19-AG21, AG31-AG33,
AG69).

Stage arrays are read per row with higher-order functions (``filter``,
``transform``, ``array_max``), so per-job stage questions need no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import TIB, USD_PER_TIB, billed_bytes, on_demand_usd


def query_snippet(q, n: int) -> Column:
    """First ``n`` characters of the query with whitespace runs collapsed."""
    c = F.col(q) if isinstance(q, str) else q
    return F.substring(F.regexp_replace(c, r"\s+", " "), 1, n)


def job_cost_top(jobs: DataFrame, n: int = 20, bytes_col: str = "total_bytes_billed", lo: str | None = None,
                 hi: str | None = None) -> DataFrame:
    """AG19: top ``n`` finished query jobs created in ``[lo, hi)`` by bytes
    billed: bytes processed and billed, USD, slot and elapsed milliseconds and
    a 60-char snippet."""
    j = jobs.where((F.col("job_type") == "QUERY") & (F.col("state") == "DONE"))
    if lo:
        j = j.where(F.col("creation_time") >= F.to_timestamp_ntz(F.lit(lo)))
    if hi:
        j = j.where(F.col("creation_time") < F.to_timestamp_ntz(F.lit(hi)))
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    return (j.select("job_id", "user_email", "total_bytes_processed", F.col(bytes_col).alias("bytes_billed"),
                     on_demand_usd(bytes_col).alias("usd"), "total_slot_ms",
                     (ms("end_time") - ms("start_time")).alias("elapsed_ms"), query_snippet("query", 60).alias("snippet"))
            .orderBy(F.desc("bytes_billed"), F.asc("job_id")).limit(n))


def user_spend(jobs: DataFrame, lo: str, hi: str, ts: str = "creation_time",
               bytes_col: str = "total_bytes_billed") -> DataFrame:
    """AG20: per user over ``[lo, hi)``: bytes, USD, jobs and the most
    expensive query (80 chars; ties broken by the lower job id)."""
    d = jobs.where((F.col(ts) >= F.to_timestamp_ntz(F.lit(lo))) & (F.col(ts) < F.to_timestamp_ntz(F.lit(hi))))
    g = d.groupBy("user_email").agg(
        F.sum(bytes_col).alias("bytes_billed"), F.count(F.lit(1)).alias("jobs"),
        F.max_by("query", F.struct(F.col(bytes_col), -F.col("job_id"))).alias("_q"))
    return g.select("user_email", "bytes_billed", on_demand_usd("bytes_billed").alias("usd"), "jobs",
                    query_snippet("_q", 80).alias("top_query"))


def monthly_billing(jobs: DataFrame, ts: str = "creation_time", bytes_col: str = "total_bytes_billed",
                    free_tib: float = 1.0) -> DataFrame:
    """AG21: bytes billed per month with the 10 MB per-query minimum, the
    free first TiB of the month shown apart, and the billable remainder.

    The free tier is applied to the month total (an aggregate), not by a
    per-job running sum, so no window over all jobs of a month is needed."""
    free = int(free_tib * TIB)
    g = jobs.groupBy(F.date_format(ts, "yyyyMM").alias("month")).agg(
        F.count(F.lit(1)).alias("jobs"), F.sum(billed_bytes(bytes_col)).alias("billed_bytes"))
    return g.select("month", "jobs", "billed_bytes",
                    F.least(F.col("billed_bytes"), F.lit(free)).alias("free_bytes"),
                    F.greatest(F.col("billed_bytes") - F.lit(free), F.lit(0)).alias("billable_bytes"),
                    (F.greatest(F.col("billed_bytes") - F.lit(free), F.lit(0)) / float(TIB) * USD_PER_TIB)
                    .alias("usd"))


def scan_stage(jobs: DataFrame, stages: str = "job_stages") -> DataFrame:
    """AG31: per job, the table-reading stage with most records read (ties:
    lower stage id); NULL when the job has none.  Per-row array work."""
    reading = F.filter(F.col(stages), lambda s: s["reads_from_table"])
    best = F.array_max(F.transform(reading, lambda s: F.struct(
        s["records_read"].alias("r"), (-s["stage_id"]).alias("neg_id"), s["stage_id"].alias("stage_id"))))
    return jobs.select("job_id", best["stage_id"].alias("scan_stage_id"), best["r"].alias("scan_records_read"))


def fanout_stages(jobs: DataFrame, min_ratio: float = 4.0, stages: str = "job_stages") -> DataFrame:
    """AG32: stages whose written/max(read, 1) >= ``min_ratio``; producers
    that read nothing are flagged."""
    s = jobs.select("job_id", F.inline(stages))
    ratio = F.col("records_written") / F.greatest(F.col("records_read"), F.lit(1))
    return (s.where(ratio >= min_ratio)
            .select("job_id", "stage_id", "records_read", "records_written", ratio.alias("ratio"),
                    (F.col("records_read") == 0).alias("zero_read_producer"))
            .orderBy(F.desc("ratio"), "job_id", "stage_id"))


def slot_fingerprint(jobs: DataFrame, pct: float = 0.9, bytes_col: str = "total_bytes_billed",
                     slot_col: str = "total_slot_ms") -> DataFrame:
    """AG33: slot-ms per billed byte, its percentile rank among all jobs
    (``percent_rank`` computed from the distributed value histogram), and a
    low-bytes/high-slot flag for jobs at or above the ``pct`` nearest-rank
    percentile."""
    from .sequence import percent_rank_of, rank_values
    d = jobs.select("job_id", (F.col(slot_col) / billed_bytes(bytes_col)).alias("slot_ms_per_byte"))
    p = rank_values(d, [], "slot_ms_per_byte", {"_p": F.greatest(F.lit(1), F.ceil(F.col("n") * pct))})
    cut = p.select("_p").scalar()
    d = percent_rank_of(d, [], "slot_ms_per_byte")
    return d.select("job_id", "slot_ms_per_byte", "pct_rank", (F.col("slot_ms_per_byte") >= cut).alias("high_slot"))


def layout_advice(jobs: DataFrame, column_types: DataFrame, filters: str = "filter_columns",
                  bytes_col: str = "total_bytes_billed", max_cluster: int = 4) -> DataFrame:
    """AG69: rank filter columns by frequency x bytes; the first time or
    integer column becomes the partition column, the next ones (up to 4)
    ordered cluster keys.  Column lists are input; no SQL text is parsed.

    The ranking runs over one row per distinct column name (small), after a
    partial aggregate over the exploded job rows."""
    e = jobs.select(F.explode(filters).alias("column_name"), F.col(bytes_col).alias("_b"))
    g = e.groupBy("column_name").agg(F.count(F.lit(1)).alias("uses"), F.sum("_b").alias("bytes"))
    g = g.join(column_types, "column_name", "left")
    g = g.withColumn("score", F.col("uses").cast("double") * F.col("bytes").cast("double"))
    # one row per distinct filter column (bounded by the table's width)
    w = Window.orderBy(F.desc("score"), F.asc("column_name"))
    g = g.withColumn("rank", F.row_number().over(w).cast("bigint"))
    part_ok = F.col("data_type").isin("TIMESTAMP", "DATE", "INT64")
    first_part = g.where(part_ok).select(F.min("rank")).scalar()
    g = g.withColumn("_is_part", F.col("rank") == F.coalesce(first_part, F.lit(-1)))
    wc = Window.orderBy("rank")
    g = g.withColumn("_ci", F.sum(F.when(~F.col("_is_part"), 1).otherwise(0)).over(
        wc.rowsBetween(Window.unboundedPreceding, 0)))
    role = (F.when(F.col("_is_part"), "partition")
            .when(F.col("_ci") <= max_cluster, F.concat(F.lit("cluster_"), F.col("_ci").cast("string")))
            .otherwise("none"))
    return g.select("column_name", "data_type", "uses", "bytes", "score", "rank", role.alias("role"))


def filter_columns_expr(job_id: str, names: Sequence[str]) -> Column:
    """Deterministic filter-column list per job used by the fixtures."""
    arr = F.array(*[F.lit(n) for n in names])
    k = F.col(job_id)
    return F.array_distinct(F.array(F.element_at(arr, (k % len(names) + 1).cast("int")),
                                    F.element_at(arr, (k % 3 + 1).cast("int"))))
