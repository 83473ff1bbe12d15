"""Materialized rollups kept by partition refresh, and answering coarser
queries from them (AG37-AG39).

Spark has no automatic materialized-view rewrite; ``answer`` is the
explicit user-level form: it uses the rollup when the query's grouping
columns are a subset of the rollup keys and its filter is day-aligned, and
re-aggregates the stored sums (sums of sums, counts of counts).
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import commits
from ..functions.columns import sum_money
from .warehouse import daily_rollup

ROLLUP_KEYS = ("event_date", "tenant_id", "event_type")
ADDITIVE = ("events", "amount", "purchases")


def build_rollup(events: DataFrame) -> DataFrame:
    """AG36 output in the stored layout (one row per day, tenant, type)."""
    return daily_rollup(events, "event_date", ["tenant_id", "event_type"], "amount", "event_type")


def write_rollup(rollup: DataFrame, path: str, refreshed_at: dt.datetime, days: Sequence[str] | None = None,
                 batch: str | None = None) -> None:
    """Write (or replace) rollup partitions in one commit and record the
    refresh time next to the data.  Of the ``days`` named, those without a
    row in ``rollup`` are emptied."""
    spark = rollup.sparkSession
    d = rollup.repartitionByRange("event_date", "tenant_id").sortWithinPartitions("event_date", "tenant_id")
    commits.replace_partitions(d, path, "event_date", tuple(days or ()), batch)
    meta = spark.createDataFrame([(refreshed_at, json.dumps(list(days) if days else None))],
                                 "refreshed_at timestamp_ntz, days string")
    meta.coalesce(1).write.mode("append").parquet(path.rstrip("/") + "_meta")


def refresh_rollup(events: DataFrame, path: str, changed_days: Sequence[str], refreshed_at: dt.datetime) -> None:
    """AG37: recompute only the days touched by new, changed or removed input
    and replace exactly those partitions; a day that lost all its events loses
    its partition.  Re-running with the same input gives the same table."""
    days = [dt.date.fromisoformat(d) for d in changed_days]
    part = events.where(F.col("event_date").isin(days))
    write_rollup(build_rollup(part), path, refreshed_at, changed_days)


def append_rollup(new_events: DataFrame, path: str, refreshed_at: dt.datetime, batch_id: str) -> bool:
    """AG37 (append-only input): add the new rows' partial sums to the stored
    rows of the days they touch instead of recomputing those days from the
    base table.  Counts and sums are additive, so the result equals a full
    recompute.  ``batch_id`` names the new rows; it is noted in the commit of
    the sums, and a batch that was applied before is skipped (returns False)."""
    spark = new_events.sparkSession
    if commits.applied(spark, path, batch_id):
        return False
    keys = list(ROLLUP_KEYS)
    merged = build_rollup(new_events).select(*keys, *ADDITIVE)
    stored = commits.read(spark, path)
    if stored is not None:
        cur = stored.join(merged.select("event_date").distinct(), "event_date", "left_semi")
        merged = (cur.select(*keys, *ADDITIVE).unionByName(merged)
                  .groupBy(*keys).agg(F.sum("events").alias("events"), sum_money("amount").alias("amount"),
                                      F.sum("purchases").alias("purchases")))
    write_rollup(merged, path, refreshed_at, batch=batch_id)
    return True


def last_refresh(spark: SparkSession, path: str) -> dt.datetime | None:
    """AG39: time of the latest refresh recorded next to the rollup."""
    m = spark.read.parquet(path.rstrip("/") + "_meta")
    return m.agg(F.max("refreshed_at")).first()[0]


def answer(spark: SparkSession, rollup_path: str, base: DataFrame, group_cols: Sequence[str],
           day_from: str | None = None, day_to: str | None = None) -> tuple[DataFrame, str]:
    """AG38: answer ``SELECT group_cols, count, sum(amount), purchases``
    over ``[day_from, day_to)`` from the rollup when possible, else from the
    base table.  Returns (result, source) with source ``rollup`` or ``base``."""
    def day_filter(df):
        c = F.col("event_date")
        if day_from:
            df = df.where(c >= F.lit(day_from).cast("date"))
        if day_to:
            df = df.where(c < F.lit(day_to).cast("date"))
        return df

    if set(group_cols) <= set(ROLLUP_KEYS):
        r = day_filter(spark.read.parquet(rollup_path))
        out = r.groupBy(*group_cols).agg(F.sum("events").alias("events"), sum_money("amount").alias("amount"),
                                         F.sum("purchases").alias("purchases"))
        return out, "rollup"
    b = day_filter(base).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("events"), sum_money("amount").alias("amount"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    return b, "base"


def answer_fresh(spark: SparkSession, rollup_path: str, base: DataFrame, group_cols: Sequence[str],
                 now: dt.datetime, max_staleness: dt.timedelta, refreshed_through: str) -> tuple[DataFrame, str]:
    """AG39: use the rollup only when ``now - refreshed_at <= max_staleness``;
    otherwise combine the rollup (days before ``refreshed_through``) with a
    recompute of the later, unrefreshed days from the base table."""
    ra = last_refresh(spark, rollup_path)
    if ra is not None and now - ra <= max_staleness:
        return answer(spark, rollup_path, base, group_cols)
    old, _ = answer(spark, rollup_path, base, list(ROLLUP_KEYS), day_to=refreshed_through)
    new = build_rollup(base.where(F.col("event_date") >= F.lit(refreshed_through).cast("date")))
    u = old.unionByName(new)
    return (u.groupBy(*group_cols).agg(F.sum("events").alias("events"), F.sum("amount").alias("amount"),
                                       F.sum("purchases").alias("purchases")), "rollup+base")


# ---- measures that do not add up: distinct users, percentiles ----------------

HLL_BITS = 12   # relative standard error of a distinct count: 1.04 / sqrt(2 ** bits) = 1.6 %
KLL_K = 400     # rank error of a quantile: about 0.7 % with 99 % certainty
_SKETCHES = ("distinct_sketch", "value_sketch")


def build_sketches(events: DataFrame, distinct: str, value: str, keys: Sequence[str] = ROLLUP_KEYS) -> DataFrame:
    """AG36 with mergeable sketches: per rollup key a HyperLogLog of
    ``distinct`` (any type, compared as text) and a KLL sketch of ``value``."""
    return events.groupBy(*keys).agg(F.hll_sketch_agg(F.col(distinct).cast("string"), HLL_BITS).alias(_SKETCHES[0]),
                                     F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_K).alias(_SKETCHES[1]))


def answer_sketches(sketches: DataFrame, group_cols: Sequence[str], ranks: dict[str, float]) -> DataFrame:
    """AG38 for distinct counts and percentiles of a coarser grouping, from
    ``build_sketches`` rows alone: ``distinct_count`` and one column per
    wanted quantile.  Sketches merge in any order and partly, so a group is
    combined map-side like a sum; the errors are those of one sketch over the
    group's events."""
    merged = sketches.groupBy(*group_cols).agg(F.hll_union_agg(_SKETCHES[0]).alias("_d"), F.kll_merge_agg_double(_SKETCHES[1]).alias("_v"))
    return merged.select(*group_cols, F.hll_sketch_estimate("_d").alias("distinct_count"),
                         *[F.kll_sketch_get_quantile_double("_v", F.lit(q)).alias(n) for n, q in ranks.items()])


def build_presence(events: DataFrame, number: str, keys: Sequence[str] = ROLLUP_KEYS) -> DataFrame:
    """AG36 with exact distinct counts of a whole-number id: per rollup key and
    range of 32,768 ids a bitmap of those that occur (null ids do not)."""
    e = events.where(F.col(number).isNotNull()).withColumn("_range", F.bitmap_bucket_number(F.col(number)))
    return e.groupBy(*keys, "_range").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias("_ids"))


def answer_presence(presence: DataFrame, group_cols: Sequence[str], name: str = "distinct_count") -> DataFrame:
    """AG38: exact distinct counts of a coarser grouping from ``build_presence``
    rows: bitmaps of a range are united, their bits added over the ranges."""
    united = presence.groupBy(*group_cols, "_range").agg(F.bitmap_or_agg("_ids").alias("_ids"))
    return united.groupBy(*group_cols).agg(F.sum(F.bitmap_count("_ids")).cast("bigint").alias(name))
