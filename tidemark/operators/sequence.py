"""Order-dependent building blocks that stay distributed when one key holds
a large share of the rows.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task.  The helpers here split each key by a *bucket* that is monotone in
the order column (for example the hour of the timestamp), do the ordered
work inside ``(key, bucket)``, and repair the bucket boundaries with a small
per-bucket summary table (one row per key and bucket).  The result is exact.

* ``prev_within``  -- LAG over a key, bucket-split.
* ``carry_within`` -- the last non-null value before a row, or the first after
  it, bucket-split.
* ``rank_values``  -- exact k-th smallest value per group: the values are cut
  into ranges by a quantile sketch, and only the ranges that hold a wanted
  rank are ordered.
* ``top_k``        -- ``row_number() <= k``; Spark plans a partial
  ``WindowGroupLimit`` before the shuffle, so a hot group ships at most
  k rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Width of the time buckets that split ordered per-key work.  One bucket of
# one key is sorted in one task: an hour keeps that bounded even for a key
# holding a large share of a year of events; the per-bucket summary tables
# stay at one row per key and hour.
BUCKET_UNIT = "hour"


def time_bucket(ts, unit: str = BUCKET_UNIT) -> Column:
    """Monotone time bucket of an order timestamp (for ``prev_within``,
    ``running_sum`` and the island helpers)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc(unit, c.cast("timestamp"))


def _join_back(d: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of the row table with a per-(key, bucket) table on
    null-safe key equality.  Null-safe equality keeps NULL keys correct and
    stops the optimizer from adding an ``isnotnull`` filter to one branch
    only, so both branches keep the same scan + exchange and Spark reuses
    it (one scan of the input)."""
    ren = small.select(*[F.col(c).alias(f"{c}__r") for c in on],
                       *[F.col(c) for c in small.columns if c not in on])
    cond = None
    for c in on:
        e = F.col(c).eqNullSafe(F.col(f"{c}__r"))
        cond = e if cond is None else cond & e
    return d.join(ren, cond, "left").drop(*[f"{c}__r" for c in on])


def prev_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                bucket: Column, prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<c>`` = value of ``c`` on the previous row of the same key
    (ordered by ``order``; include a unique tie-break column in ``order``).

    ``bucket`` must be non-decreasing along ``order`` within a key (e.g.
    ``date_trunc('hour', ts)`` when ordering by ``ts``)."""
    keys = list(keys)
    order = list(order)
    b = "_bkt"
    d = df.withColumn(b, bucket)
    w = Window.partitionBy(*keys, b).orderBy(*order)
    for c in cols:
        d = d.withColumn(prefix + c, F.lag(c).over(w))
    wall = Window.partitionBy(*keys, b)
    d = (d.withColumn("_rn", F.row_number().over(w))
         .withColumn("_is_first", F.col("_rn") == 1).withColumn("_rows", F.count(F.lit(1)).over(wall)))
    # last row of each (key, bucket), read off the windowed rows (no second
    # aggregation; the per-bucket table is one row per key and bucket)
    last = d.where(F.col("_rn") == F.col("_rows")).select(*keys, b, F.struct(*cols).alias("_last"))
    wb = Window.partitionBy(*keys).orderBy(b)
    carry = last.select(*keys, b, F.lag("_last").over(wb).alias("_carry"))
    d = _join_back(d, carry, [*keys, b])
    for c in cols:
        d = d.withColumn(prefix + c, F.when(F.col("_is_first"), F.col("_carry")[c])
                         .otherwise(F.col(prefix + c)))
    return d.drop(b, "_is_first", "_carry", "_rn", "_rows")


def carry_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, bucket: Column, name: str,
                 following: bool = False) -> DataFrame:
    """Add ``name``: the last non-null ``value`` on the rows of the key before
    this one (``following``: the first on the rows after it), split by a
    bucket that does not decrease along ``order``."""
    keys = list(keys)
    d = df.withColumn("_bkt", bucket).withColumn("_val", value)
    turn = (lambda c: F.col(c).desc()) if following else (lambda c: F.col(c).asc())
    inside = Window.partitionBy(*keys, "_bkt").orderBy(*map(turn, order)).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.last("_val", ignorenulls=True).over(inside))
    # one row per bucket: its value nearest to the buckets that look at it
    nearest = F.min_by if following else F.max_by
    at = F.when(F.col("_val").isNotNull(), F.struct(*order))
    ends = d.groupBy(*keys, "_bkt").agg(nearest("_val", at).alias("_end"))
    across = Window.partitionBy(*keys).orderBy(turn("_bkt")).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*keys, "_bkt", F.last("_end", ignorenulls=True).over(across).alias("_carry"))
    d = _join_back(d, carry, [*keys, "_bkt"])
    return d.withColumn(name, F.coalesce("_in", "_carry")).drop("_bkt", "_val", "_in", "_carry")


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, bucket: Column,
                name: str = "running") -> DataFrame:
    """Running ``sum(value)`` per key along ``order`` (inclusive of the
    current row), bucket-split: in-bucket running sum plus the total of all
    earlier buckets of the key (one row per bucket)."""
    keys = list(keys)
    b = "_bkt"
    d = df.withColumn(b, bucket)
    w = Window.partitionBy(*keys, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = (d.withColumn("_in", F.sum(value).over(w))
         .withColumn("_bt", F.sum(value).over(Window.partitionBy(*keys, b)))
         .withColumn("_rn1", F.row_number().over(Window.partitionBy(*keys, b).orderBy(*order))))
    # bucket totals read off the windowed rows (one row per key and bucket)
    tot = d.where(F.col("_rn1") == 1).select(*keys, b, "_bt")
    wb = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*keys, b, F.coalesce(F.sum("_bt").over(wb), F.lit(0)).alias("_before"))
    d = _join_back(d, tot, [*keys, b])
    return d.withColumn(name, F.col("_before") + F.col("_in")).drop(b, "_in", "_before", "_bt", "_rn1")


CUTS = 128  # ranges that the values of a group are cut into, a power of two


def _ranged(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Rows with a non-null value and ``_b``, the number of cut points below
    the value.  The cuts are approximate quantiles of the group's own values,
    so ranges hold similar shares of any distribution; the counts per range
    that the callers use are exact.  NaN sorts above every number."""
    base = df.where(F.col(value).isNotNull())
    at = [i / CUTS for i in range(1, CUTS)]
    ren = [F.col(c).alias(f"{c}__r") for c in group]
    cuts = F.array_sort(F.array_distinct(F.percentile_approx(value, at, 20 * CUTS))).alias("_cuts")
    if group:
        sk = base.groupBy(*group).agg(cuts).select(*ren, "_cuts")
        d = base.join(sk, _same(group), "left").drop(*[f"{c}__r" for c in group])
    else:
        d = base.withColumn("_cuts", base.select(cuts).scalar())
    # the cuts are sorted: their number below the value by halving steps
    d = d.withColumn("_b", F.lit(0))
    step = CUTS // 2
    while step:
        below = F.coalesce(F.try_element_at("_cuts", F.col("_b") + step) < F.col(value), F.lit(False))
        d = d.withColumn("_b", F.col("_b") + F.when(below, step).otherwise(0))
        step //= 2
    return d.drop("_cuts")


def _same(cols: Sequence[str]) -> Column:
    """Null-safe equality of ``c`` and ``c__r`` for all columns."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"{c}__r"))
    return cond


def _ranges(hist: DataFrame, group: list[str]) -> DataFrame:
    """Counts of each range, up to its start and of the group."""
    wg = Window.partitionBy(*group)
    wb = wg.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (hist.groupBy(*group, "_b").agg(F.sum("_cnt").alias("_bc"))
            .withColumn("_from", F.sum("_bc").over(wb) - F.col("_bc")).withColumn("_all", F.sum("_bc").over(wg)))


def rank_values(df: DataFrame, group: Sequence[str], value: str,
                ranks: dict[str, Column], n_name: str = "n") -> DataFrame:
    """Exact order statistics per group.

    ``ranks`` maps an output name to a 1-based rank expression in terms of
    the group size column ``n_name`` (e.g. ``nearest_rank(99, 'n')``).
    Returns one row per group: group columns, ``n`` and one column per rank.
    NULL values are ignored, as percentile functions do; a NULL group is a
    group; NaN ranks above every number.

    Plan (all distributed, lazy and exact):
      1. a quantile sketch per group cuts its values into ``CUTS`` ranges;
      2. exact counts per (group, range), summed over the ranges before (a
         hundred rows a group), tell which range holds each wanted rank;
      3. only the values of those ranges are histogrammed (a value repeated a
         billion times is one row after the map side) and ordered, one range
         in one task.
    """
    group = list(group)
    rows = _ranged(df, group, value)
    rg = _ranges(rows.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_cnt")), group)
    rg = rg.withColumn(n_name, F.col("_all"))
    want = F.array(*[F.struct(F.lit(k).alias("name"), r.cast("bigint").alias("rank")) for k, r in ranks.items()])
    hit = rg.select(*group, "_b", "_bc", "_from", n_name, F.explode(want).alias("_w")).where(
        (F.col("_w.rank") > F.col("_from")) & (F.col("_w.rank") <= F.col("_from") + F.col("_bc")))
    wanted = hit.groupBy(*group, "_b").agg(F.first("_from").alias("_from"), F.first(n_name).alias(n_name),
                                           F.collect_list("_w").alias("_w"))
    ren = wanted.select(*[F.col(c).alias(f"{c}__r") for c in [*group, "_b"]], "_from", n_name, "_w")
    if not group:
        ren = F.broadcast(ren)  # a row per rank at most; without the hint the rows may be the side that is sent
    h = (rows.join(ren, _same([*group, "_b"]), "inner")
         .groupBy(*group, "_b", value).agg(F.count(F.lit(1)).alias("_cnt"), F.first("_from").alias("_from"),
                                           F.first(n_name).alias(n_name), F.first("_w").alias("_w")))
    wv = Window.partitionBy(*group, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.withColumn("_cum", F.col("_from") + F.sum("_cnt").over(wv))
    aggs = [F.max(n_name).alias(n_name)]
    for name in ranks:
        rank = F.try_element_at(F.map_from_entries("_w"), F.lit(name))
        mine = (rank <= F.col("_cum")) & (rank > F.col("_cum") - F.col("_cnt"))
        aggs.append(F.max(F.when(mine, F.col(value))).alias(name))
    return h.groupBy(*group).agg(*aggs) if group else h.agg(*aggs)


def percent_rank_of(df: DataFrame, group: Sequence[str], value: str, name: str = "pct_rank") -> DataFrame:
    """``percent_rank()`` of ``value`` within each group -- (rows with a
    smaller value) / (n - 1) -- without a window over all rows of a group:
    the counts come from the range-cut value histogram (as ``rank_values``)
    and are joined back to the rows by (group, value), null-safe."""
    group = list(group)
    hist = _ranged(df, group, value).groupBy(*group, "_b", value).agg(F.count(F.lit(1)).alias("_cnt"))
    rg = _ranges(hist, group)
    ren = rg.select(*[F.col(c).alias(f"{c}__r") for c in [*group, "_b"]], "_from", "_all")
    h = hist.join(ren, _same([*group, "_b"]), "inner")
    wv = Window.partitionBy(*group, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.col("_from") + F.sum("_cnt").over(wv) - F.col("_cnt")
    pr = F.when(F.col("_all") > 1, below / (F.col("_all") - 1)).otherwise(F.lit(0.0))
    ranks = h.select(*[F.col(c).alias(f"{c}__r") for c in [*group, value]], pr.alias(name))
    return df.join(ranks, _same([*group, value]), "left").drop(*[f"{c}__r" for c in [*group, value]])


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
          rank_name: str | None = None) -> DataFrame:
    """Rows ranked 1..k per group by ``order`` (add a tie-break to ``order``)."""
    w = Window.partitionBy(*group).orderBy(*order)
    rn = rank_name or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= k)
    return out if rank_name else out.drop(rn)
