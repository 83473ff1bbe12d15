"""Warehouse-style aggregates over event and trip tables (AG1-AG10, AG36,
AG40-AG42, SL1-SL3, WI1-WI2).

All aggregates are algebraic (count/sum/min/max/count_if), so Spark plans a
partial aggregate before the shuffle: a hot key costs one row per map task
in the exchange, not one row per input row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_divide, sum_money
from .sequence import rank_values, top_k


def day_count_revenue(df: DataFrame, ts_col: str, amount_col: str) -> DataFrame:
    """AG1: trips and revenue per day."""
    return (df.groupBy(F.col(ts_col).cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("trips"), sum_money(amount_col).alias("revenue")))


def group_count(df: DataFrame, key: str) -> DataFrame:
    """AG2: rows per group, largest first (order is cosmetic; ties by key)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(key)))


def avg_ratio_pct(df: DataFrame, key: str, num: str, den: str) -> DataFrame:
    """AG3: ``round(avg(num / nullif(den, 0)) * 100, 2)`` per group."""
    return (df.groupBy(key)
            .agg(F.round(F.avg(safe_divide(num, den) * 100), 2).alias("avg_ratio_pct")))


def hour_profile(df: DataFrame, ts_col: str) -> DataFrame:
    """AG4: rows per hour of day."""
    return (df.groupBy(F.hour(ts_col).cast("bigint").alias("hour"))
            .agg(F.count(F.lit(1)).alias("n")))


def duplicate_summary(df: DataFrame, id_col: str) -> DataFrame:
    """AG5: total rows, distinct ids and duplicates (total - distinct).

    ``count(DISTINCT)`` is planned as a two-level aggregate (distinct ids
    first, partially aggregated), so it scales with distinct ids."""
    return (df.agg(F.count(F.lit(1)).alias("total"), F.countDistinct(id_col).alias("distinct_ids"))
            .withColumn("duplicates", F.col("total") - F.col("distinct_ids")))


def daily_rollup(df: DataFrame, day_col: str, keys: Sequence[str], amount_col: str,
                 type_col: str, purchase_value: str = "purchase") -> DataFrame:
    """AG36: events, amount and purchases per day and keys."""
    return (df.groupBy(day_col, *keys)
            .agg(F.count(F.lit(1)).alias("events"),
                 sum_money(amount_col).alias("amount"),
                 F.count_if(F.col(type_col) == purchase_value).alias("purchases")))


def global_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """SL1: full sort without limit (range-partitioned shuffle)."""
    return df.orderBy(*order)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """SL2: ``ORDER BY ... LIMIT n`` -> TakeOrderedAndProject (per-task
    top-n, then one merge of n x tasks rows)."""
    return df.orderBy(*order).limit(n)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """SL3 / WI2: rows ranked 1..k per group (``rank`` column added)."""
    return top_k(df, group, order, k, rank_name="rank")


def label_by_group_max(df: DataFrame, group: Sequence[str], predicate: Column, name: str) -> DataFrame:
    """WI1: every row gets ``max(predicate)`` of its group.

    Written as aggregate-then-join instead of ``max() OVER (PARTITION BY)``:
    the aggregate is partial (skew-safe), and the join attaches one value per
    group; AQE splits a skewed join partition."""
    lab = df.groupBy(*group).agg(F.max(predicate.cast("int")).cast("boolean").alias(name))
    return df.join(lab, list(group), "left")


def skew_percentiles(df: DataFrame, skew_col: str, group: Sequence[str] = ()) -> DataFrame:
    """AG6 (exact form): p50/p99/p99.9 by nearest rank (``ceil(p*n)``), and max."""
    n = F.col("n")
    ranks = {
        "p50": F.greatest(F.lit(1), F.ceil(n * 0.5)),
        "p99": F.greatest(F.lit(1), F.ceil(n * 0.99)),
        "p999": F.greatest(F.lit(1), F.ceil(n * 0.999)),
        "max_s": n,
    }
    return rank_values(df, group, skew_col, ranks)


def skew_percentiles_approx(df: DataFrame, skew_col: str, accuracy: int = 10000) -> DataFrame:
    """AG6 (sketch form): bounded-memory percentiles for very large inputs."""
    return df.agg(F.percentile_approx(skew_col, [0.5, 0.99, 0.999], accuracy).alias("q"),
                  F.max(skew_col).alias("max_s")).select(
        F.col("q")[0].alias("p50"), F.col("q")[1].alias("p99"), F.col("q")[2].alias("p999"), "max_s")


ROUND_BOUNDS_S = [60, 120, 300, 600, 900, 1800, 3600, 7200, 21600, 43200, 86400, 172800]


def recommend_lateness(df: DataFrame, skew_col: str, bounds: Sequence[int] = ROUND_BOUNDS_S) -> DataFrame:
    """AG7: smallest round bound above p99.9 of the skew (whole days beyond
    the largest of ``bounds``), and the share of events that bound would still drop.  The bound is a scalar subquery
    (evaluated once, broadcast as a value), not a join."""
    p999 = skew_percentiles(df, skew_col).select("p999")
    arr = F.array(*[F.lit(b) for b in bounds])
    pick = p999.select(F.struct(
        F.coalesce(F.array_min(F.filter(arr, lambda b: b > F.col("p999"))), ((F.floor(F.col("p999") / 86400) + 1) * 86400)).cast("bigint").alias("bound_s"),
        "p999")).scalar()                            # one subquery, used by name below
    d = df.select(skew_col).withColumn("_pick", pick)
    agg = d.groupBy(F.col("_pick.bound_s").alias("bound_s"), F.col("_pick.p999").alias("p999")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col(skew_col) > F.col("_pick.bound_s")).alias("dropped"))
    return agg.select("bound_s", "p999", "events", "dropped",
                      F.round(F.col("dropped") / F.col("events") * 100, 4).alias("dropped_pct"))


def gap_distribution(df: DataFrame, key: str, ts_col: str, tie: str, bucket: Column,
                     per_key: bool = False) -> DataFrame:
    """AG8: inter-event gaps within each key (seconds) and their percentiles,
    over all keys or (``per_key``) for every key -- the input for choosing a
    session gap."""
    from .sequence import prev_within
    g = prev_within(df.select(key, ts_col, tie), [key], [ts_col, tie], [ts_col], bucket)
    gaps = g.where(F.col("prev_" + ts_col).isNotNull()).select(
        key, (F.unix_micros(F.col(ts_col).cast("timestamp"))
              - F.unix_micros(F.col("prev_" + ts_col).cast("timestamp"))).cast("double").alias("_us"))
    gaps = gaps.select(key, (F.col("_us") / 1e6).alias("gap_s"))
    n = F.col("gaps")
    return rank_values(gaps, [key] if per_key else [], "gap_s", {
        "p50_gap_s": F.greatest(F.lit(1), F.ceil(n * 0.5)),
        "p90_gap_s": F.greatest(F.lit(1), F.ceil(n * 0.9)),
        "p99_gap_s": F.greatest(F.lit(1), F.ceil(n * 0.99)),
    }, n_name="gaps")


def error_share(df: DataFrame, group: Sequence[Column], status_col: str, threshold: int = 500) -> DataFrame:
    """AG9: ``count_if(status >= 500) / count(*)`` per group."""
    return (df.groupBy(*group)
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.count_if(F.col(status_col) >= threshold).alias("errors"))
            .withColumn("error_rate", F.round(F.col("errors") / F.col("requests"), 6)))


def p99_top(df: DataFrame, key: str, value: str, n: int = 10) -> DataFrame:
    """AG10: p99 (nearest rank) per key, top ``n`` slowest."""
    p = rank_values(df, [key], value, {"p99_ms": F.greatest(F.lit(1), F.ceil(F.col("n") * 0.99))})
    return p.orderBy(F.desc("p99_ms"), F.asc(key)).limit(n)


def hot_keys(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """AG40: top keys by rows and their share of all rows (total is a scalar
    subquery over the partial counts)."""
    c = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    tot = c.select(F.sum("n")).scalar()
    out = c.select(key, "n", F.round(F.col("n") / tot * 100, 4).alias("share_pct"))
    return out.orderBy(F.desc("n"), F.asc(key)).limit(n)


def salted_sum(df: DataFrame, key: str, value: str, salt_col: str, salts: int = 16) -> DataFrame:
    """AG41: two-stage aggregate with ``key#0..N-1`` salt; equals the direct
    aggregate.  Stage one spreads a hot key over ``salts`` shuffle
    partitions; stage two merges at most ``salts`` rows per key."""
    s1 = (df.withColumn("_salt", F.pmod(F.xxhash64(salt_col), F.lit(salts)))
          .groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.round(F.col(value) * 100).cast("bigint")).alias("_s")))
    return s1.groupBy(key).agg(F.sum("_n").alias("n"), (F.sum("_s") / 100.0).alias("total"))


def undercount(counting: DataFrame, dropping: DataFrame, value: str) -> DataFrame:
    """AG42: what a pipeline that drops late rows misses against one that
    counts them: (counting total - dropping total) / counting total * 100, and
    the rows dropped.  Totals in cents, as scalar subqueries."""
    cents = F.sum(F.round(F.col(value) * 100).cast("bigint"))
    c, d = counting.select(cents).scalar(), dropping.select(cents).scalar()
    rows = counting.select(F.count(F.lit(1))).scalar() - dropping.select(F.count(F.lit(1))).scalar()
    one = counting.sparkSession.range(1)
    return one.select((c / 100.0).alias("counting_total"), (d / 100.0).alias("dropping_total"), rows.alias("dropped"),
                      F.round((c - d) / c * 100, 4).alias("undercount_pct"))
