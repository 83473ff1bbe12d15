"""Model-serving call logs: latency percentiles by the reference's rank
rule, comparison tables, cold starts, and batch scoring with a fallback
path (AG22, AG25, AG28, ML5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import nearest_rank
from .finops import API_USD_PER_M_IN, API_USD_PER_M_OUT
from .sequence import prev_within, rank_values, time_bucket


def latency_percentiles(df: DataFrame, group: Sequence[str], latency: str,
                        ps: Sequence[float] = (50, 90, 99)) -> DataFrame:
    """AG22: p50/p90/p99 with ``idx = clamp(round_half_even(p/100*n+0.5))``.

    Exact, from a (group, value) histogram: the shuffle carries one row per
    distinct latency per group after partial aggregation."""
    ranks = {f"p{int(p) if float(p).is_integer() else p}_ms": nearest_rank(p, "n") for p in ps}
    return rank_values(df, group, latency, ranks)


def serving_comparison(df: DataFrame, option: str) -> DataFrame:
    """AG25: per serving option: nearest-rank p50/p90/p99, throughput,
    error rate and token cost per 1000 requests."""
    p = latency_percentiles(df, [option], "latency_ms")
    g = df.groupBy(option).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("failed").alias("errors"),
        (F.unix_seconds(F.max("ts").cast("timestamp")) - F.unix_seconds(F.min("ts").cast("timestamp"))).alias("_span"),
        F.sum("input_tokens").alias("_i"), F.sum("output_tokens").alias("_o"))
    g = g.select(option, F.round(F.col("requests") / F.col("_span"), 6).alias("req_per_s"),
                 F.round(F.col("errors") / F.col("requests"), 6).alias("error_rate"),
                 F.round((F.col("_i") * API_USD_PER_M_IN + F.col("_o") * API_USD_PER_M_OUT) / 1e6
                         / F.col("requests") * 1000, 6).alias("usd_per_1000"))
    return p.join(g, option)


def cold_start_share(df: DataFrame, key: str, ts: str, tie: str, idle_s: int = 900,
                     slo_share: float = 0.01) -> DataFrame:
    """AG28: a request is a cold start when it is the first of its key or
    follows an idle gap longer than ``idle_s``; share per key vs the 1% SLO."""
    g = prev_within(df.select(key, ts, tie), [key], [ts, tie], [ts], time_bucket(ts))
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("prev_" + ts).cast("timestamp"))
    cold = F.col("prev_" + ts).isNull() | (gap > idle_s * 1_000_000)
    c = g.groupBy(key).agg(F.count(F.lit(1)).alias("requests"), F.count_if(cold).alias("cold_starts"))
    return c.select(key, "requests", "cold_starts",
                    F.round(F.col("cold_starts") / F.col("requests") * 100, 4).alias("cold_pct"),
                    (F.col("cold_starts") / F.col("requests") > slo_share).alias("breaches_slo"))
