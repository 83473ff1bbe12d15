"""Joins and the checks built on them: rate enrichment, fan-out
prediction, manifest/loss checks, reconciliation between two copies, span
assembly (JO1-JO15, SE1-SE2, AG43).

Physical strategy is left to Catalyst/AQE: equi-joins on keys become
sort-merge joins, or broadcast hash joins when the runtime size of a side is
under the (checked) broadcast threshold; skewed partitions are split by
AQE.  No operator here plans a Cartesian product: pair counts per key are
computed from key counts (``sum(n_left * n_right)``), never by emitting the
pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import cents


def enrich_rates(facts: DataFrame, rates: DataFrame, cur: str, ts: str, rate_date: str = "rate_date") -> DataFrame:
    """JO1: equi-join on the full key ``(currency, day)``."""
    f = facts.withColumn("_day", F.col(ts).cast("date"))
    r = rates.withColumnRenamed(rate_date, "_day")
    return f.join(r, [cur, "_day"], "inner").drop("_day")


def monthly_rates(rates: DataFrame, cur: str, rate_date: str = "rate_date", rate: str = "rate") -> DataFrame:
    """JO2 (first half): average rate per currency and month (aggregate
    before the join, so the join key is unique on the rate side)."""
    return (rates.groupBy(cur, F.trunc(rate_date, "month").alias("month"))
            .agg(F.round(F.avg(rate), 6).alias("avg_rate")))


def converted_totals(df: DataFrame, key: str, amount: str, rate: str) -> DataFrame:
    """Sum of ``amount * rate`` per key in integer cents."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"),
                               (F.sum(cents(F.col(amount) * F.col(rate))) / 100.0).alias("converted"))


def pair_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JO3: rows an equi self-join on ``keys`` would produce per key
    (``n * n``), computed from counts -- the pairs are never emitted."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("pairs", F.col("n") * F.col("n"))


def join_fanout(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """JO4: predicted output rows of ``left JOIN right USING key``, the
    largest multiplicity on each side and whether the right side is unique
    on the key (one row)."""
    lc = left.groupBy(*key).agg(F.count(F.lit(1)).alias("_l"))
    rc = right.groupBy(*key).agg(F.count(F.lit(1)).alias("_r"))
    j = lc.join(rc, list(key), "full_outer")
    return j.agg(
        F.coalesce(F.sum(F.col("_l") * F.col("_r")), F.lit(0)).cast("bigint").alias("predicted_rows"),
        F.coalesce(F.sum("_l"), F.lit(0)).cast("bigint").alias("left_rows"),
        F.max("_l").alias("max_left_per_key"), F.max("_r").alias("max_right_per_key"),
        F.coalesce(F.max("_r") <= 1, F.lit(True)).alias("right_unique"))


def left_group_totals(parent: DataFrame, child: DataFrame, key: str, amount: str) -> DataFrame:
    """JO6: per parent row, number of children and their total (0 when none).

    The child side is aggregated first, so the join is one-to-one."""
    c = child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_s"))
    j = parent.select(key).join(c, key, "left")
    return j.select(key, F.coalesce("_n", F.lit(0)).cast("bigint").alias("orders"),
                    F.coalesce("_s", F.lit(0)).cast("bigint").alias("total_cents"))


def manifest_check(published: DataFrame, landed: DataFrame, id_col: str,
                   dead_letter: DataFrame | None = None) -> DataFrame:
    """JO9: lost ids (published, not landed), unexpected ids (landed, never
    published), duplicate landings, and dead-letter parity -- one row, from
    one full outer join of the per-id counts of both sides (each side is
    scanned once and partially aggregated)."""
    p = published.groupBy(id_col).agg(F.count(F.lit(1)).alias("_p"))
    l_counts = landed.groupBy(id_col).agg(F.count(F.lit(1)).alias("_l"))
    j = p.join(l_counts, id_col, "full_outer")
    out = j.agg(
        F.coalesce(F.sum("_p"), F.lit(0)).cast("bigint").alias("published"),
        F.coalesce(F.sum("_l"), F.lit(0)).cast("bigint").alias("landed"),
        F.count_if(F.col("_l").isNull()).alias("lost"),
        F.count_if(F.col("_p").isNull()).alias("unexpected"),
        F.coalesce(F.sum(F.greatest(F.col("_l") - 1, F.lit(0))), F.lit(0)).cast("bigint").alias("duplicates"))
    if dead_letter is not None:
        out = out.withColumn("dead_lettered", dead_letter.select(F.count(F.lit(1))).scalar())
    return out


def lost_ids(published: DataFrame, landed: DataFrame, id_col: str) -> DataFrame:
    """SE2: set difference of ids (``left_anti``).  Both sides are whole
    tables, whose ids take many times their size on disk in memory, so they
    meet by shuffle and none is gathered in the driver."""
    return published.select(id_col).join(landed.select(id_col).hint("merge"), id_col, "left_anti").distinct()


def reconcile(stream: DataFrame, batch: DataFrame, key: Sequence[str], value: str, tol: float = 0.01) -> DataFrame:
    """JO10 / SS24: per key (window), streaming vs batch value, divergence and an
    alert flag when it exceeds ``tol`` (NULL-safe: a key missing on one side
    counts as 0 there)."""
    s = stream.select(*key, F.col(value).alias("stream_value"))
    b = batch.select(*key, F.col(value).alias("batch_value"))
    j = s.join(b, list(key), "full_outer")
    sv = F.coalesce("stream_value", F.lit(0))
    bv = F.coalesce("batch_value", F.lit(0))
    div = F.when(bv == 0, F.when(sv == 0, 0.0).otherwise(1.0)).otherwise(F.abs(sv - bv) / F.abs(bv))
    return j.select(*key, sv.alias("stream_value"), bv.alias("batch_value"),
                    F.round(div, 6).alias("divergence"), (div > tol).alias("alert"))


def shadow_compare(source: DataFrame, target: DataFrame, key: str, value: str) -> DataFrame:
    """JO11: per key count and sum on both copies; rows whose numbers differ
    (``eqNullSafe``), including keys present on one side only."""
    a = source.groupBy(key).agg(F.count(F.lit(1)).alias("src_rows"), F.sum(value).alias("src_sum"))
    b = target.groupBy(key).agg(F.count(F.lit(1)).alias("tgt_rows"), F.sum(value).alias("tgt_sum"))
    j = a.join(b, key, "full_outer")
    same = F.col("src_rows").eqNullSafe(F.col("tgt_rows")) & F.col("src_sum").eqNullSafe(F.col("tgt_sum"))
    return j.where(~same)


def span_tree(spans: DataFrame, trace: str = "trace_id", span: str = "span_id", parent: str = "parent_span_id",
              duration: str = "duration_ms") -> DataFrame:
    """JO12: assemble traces from a parent/child self join on
    ``(trace_id, parent_span_id) = (trace_id, span_id)``: spans per trace,
    root duration, children's share of their parents' time, orphan spans
    (parent id set but parent missing).  The join is many-to-one (span ids
    are unique), so it cannot fan out."""
    p = spans.select(F.col(trace).alias("_ptrace"), F.col(span).alias("_pid"), F.col(duration).alias("_pdur"))
    c = spans.join(p, (F.col(trace) == F.col("_ptrace")) & (F.col(parent) == F.col("_pid")), "left")
    return c.groupBy(trace).agg(
        F.count(F.lit(1)).alias("spans"),
        F.sum(F.when(F.col(parent).isNull(), F.col(duration))).alias("root_ms"),
        F.count_if(F.col(parent).isNotNull() & F.col("_pid").isNull()).alias("orphans"),
        F.round(F.sum(F.when(F.col("_pid").isNotNull(), F.col(duration)))
                / F.sum(F.when(F.col("_pid").isNotNull(), F.col("_pdur"))), 6).alias("child_share"))


def correlate_logs(spans: DataFrame, logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JO13: trace-log correlation, equi left join on ``(trace_id, span_id)``."""
    return spans.join(logs, list(keys), "left")


def convergence(source: DataFrame, target: DataFrame, key: str, written: str, arrived: str,
                max_lag_s: int) -> DataFrame:
    """JO14 (batch form): match each source write to its target arrival
    within ``[written, written + max_lag]``; lag in seconds.  The streaming
    form runs the same condition on two watermarked streams
    (``tidemark.streaming.windows.match_arrivals``).  The copies are tables of
    one size, so they meet by shuffle (see ``lost_ids``)."""
    s = source.select(key, written)
    t = target.select(F.col(key).alias("_k"), arrived)
    cond = ((F.col(key) == F.col("_k")) & (F.col(arrived) >= F.col(written))
            & (F.col(arrived) <= F.col(written) + F.expr(f"INTERVAL {int(max_lag_s)} SECONDS")))
    j = s.join(t.hint("merge"), cond, "left")
    lag = (F.unix_micros(F.col(arrived).cast("timestamp")) - F.unix_micros(F.col(written).cast("timestamp"))) / 1e6
    return j.select(key, written, arrived, lag.alias("lag_s"))


def row_parity(source: DataFrame, target: DataFrame) -> DataFrame:
    """JO15: row counts of both tables and whether they agree (one row)."""
    a = source.select(F.count(F.lit(1))).scalar()
    b = target.select(F.count(F.lit(1))).scalar()
    return source.sparkSession.range(1).select(a.alias("source_rows"), b.alias("target_rows"),
                                               (a - b).alias("difference"), (a == b).alias("parity"))


def bag_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """SE1: flatten two collections (duplicates kept)."""
    return a.unionByName(b)


def shadow_stats(compare_base: DataFrame, key: str, matched: Column, lag: str) -> DataFrame:
    """AG43: comparisons, matches, never-converged keys and median/p95 lag
    (nearest rank) over a per-key comparison table."""
    from .sequence import rank_values
    s = compare_base.agg(F.count(F.lit(1)).alias("comparisons"), F.count_if(matched).alias("matches"),
                         F.count_if(F.col(lag).isNull()).alias("never_converged"))
    n = F.col("n")
    p = rank_values(compare_base.select(lag), [], lag, {
        "p50_lag_s": F.greatest(F.lit(1), F.ceil(n * 0.5)), "p95_lag_s": F.greatest(F.lit(1), F.ceil(n * 0.95))})
    q = p.select(F.struct("p50_lag_s", "p95_lag_s")).scalar()   # one subquery for both
    return s.withColumn("_q", q).select("comparisons", "matches", "never_converged",
                                        F.col("_q.p50_lag_s").alias("p50_lag_s"), F.col("_q.p95_lag_s").alias("p95_lag_s"))
