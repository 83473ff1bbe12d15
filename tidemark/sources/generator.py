"""Synthetic event messages for load and failure drills (SO17).

Generated in parallel from ``spark.range``: ids, times, tenants and
amounts are functions of the row id and the seed, so two runs with the same
seed give the same messages; a ``bad_rate`` share is malformed (truncated,
missing field, wrong type).  The manifest of published ids is the second
output, for the loss/duplicate check (JO9).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_TYPES = ["view", "click", "add_to_cart", "purchase", "signup", "logout"]


def generate_events(spark: SparkSession, n: int, days: int = 90, tenants: int = 20, bad_rate: float = 0.02,
                    seed: int = 42, start: dt.datetime = dt.datetime(2024, 1, 1),
                    partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """SO17: ``n`` synthetic messages over ``days`` and ``tenants`` with a
    ``bad_rate`` malformed share, and the manifest of published ids."""
    ids = spark.range(0, n, numPartitions=partitions or spark.sparkContext.defaultParallelism)
    h = lambda salt: F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(salt)), F.lit(1 << 30))
    types = F.array(*[F.lit(t) for t in EVENT_TYPES])
    base = ids.select(
        F.concat(F.lit("evt-"), F.lpad(F.col("id").cast("string"), 12, "0")).alias("event_id"),
        F.element_at(types, (F.pmod(h(1), F.lit(len(EVENT_TYPES))) + 1).cast("int")).alias("event_type"),
        F.concat(F.lit("tenant_"), F.pmod(h(2), F.lit(tenants)).cast("string")).alias("tenant"),
        F.round(F.pmod(h(3), F.lit(50000)) / 100.0, 2).alias("amount"),
        (F.lit(start) + F.make_dt_interval(secs=F.pmod(h(4), F.lit(days * 86400)).cast("int"))).alias("event_ts"),
        (F.pmod(h(5), F.lit(10000)) < int(bad_rate * 10000)).alias("_bad"), F.pmod(h(6), F.lit(3)).alias("_kind"))
    body = F.to_json(F.struct("event_id", "event_type", "tenant", "amount",
                              F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time")))
    bad = (F.when(F.col("_kind") == 0, F.substring(body, 1, 25))
           .when(F.col("_kind") == 1, F.regexp_replace(body, r'"tenant":"[^"]*",', ""))
           .otherwise(F.regexp_replace(body, r'"amount":[^,}]*', '"amount":"n/a"')))
    msgs = base.select("event_id", F.when(F.col("_bad"), bad).otherwise(body).alias("raw"),
                       F.col("event_ts").alias("publish_time"))
    manifest = base.select("event_id", "_bad")
    return msgs, manifest.withColumnRenamed("_bad", "malformed")
