"""Event-stream operators in their batch form (PF5, PF9, PF14, SS1-SS3,
SS9, SS13, SS17, SS18, SS20, SS25, WI6-WI8, WI10, UD1-UD4, AG42).

The same functions take streaming DataFrames where Structured Streaming
allows the operation (parsing, windows, dedup); the stateful variants live
in ``tidemark.streaming``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequence import prev_within, running_sum, time_bucket

# Raw message schema: every field read as text first, so type problems are
# detected by this operator instead of silently turning into NULLs.
RAW_FIELDS = ["event_id", "event_type", "tenant", "amount", "event_time"]
REQUIRED = ["event_id", "event_type", "tenant", "event_time"]
RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in RAW_FIELDS]
                          + [T.StructField("_corrupt_record", T.StringType())])


def parse_events(raw: DataFrame, text: str = "raw", required: Sequence[str] = REQUIRED) -> DataFrame:
    """PF5: decode one JSON message per row; required fields present,
    ``amount`` coerced to double (0.0 when absent), event time parsed
    (RFC 3339).  Any failure sets ``error`` (corrupt, missing_field,
    bad_amount, bad_time); good rows have ``error`` NULL.  Split good and
    dead-letter outputs with two filters on ``error`` (UD2)."""
    p = raw.withColumn("_j", F.from_json(F.col(text), RAW_SCHEMA,
                                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    j = F.col("_j")
    missing = F.lit(False)
    for f in required:
        missing = missing | j[f].isNull()
    amount = F.when(j["amount"].isNull(), F.lit(0.0)).otherwise(F.expr("try_cast(_j.amount AS DOUBLE)"))
    when = F.try_to_timestamp(j["event_time"])
    error = (F.when(j["_corrupt_record"].isNotNull(), "corrupt")
             .when(missing, "missing_field")
             .when(amount.isNull(), "bad_amount")
             .when(when.isNull(), "bad_time"))
    ok = error.isNull()
    return p.select(
        "*", j["event_id"].alias("event_id"),
        F.when(ok, j["event_type"]).alias("event_type"), F.when(ok, j["tenant"]).alias("tenant"),
        F.when(ok, amount).alias("amount"), F.when(ok, when.cast("timestamp_ntz")).alias("event_time"),
        error.alias("error")).drop("_j")


MESSAGE_SCHEMA = "event_id string, event_type string, tenant string, amount double, event_time string"
# JSON kinds that a column type takes
_KINDS = {"string": ("STRING",), "boolean": ("BOOLEAN",), "bigint": ("BIGINT",), "int": ("BIGINT",),
          "double": ("DOUBLE", "DECIMAL", "BIGINT", "FLOAT"), "float": ("DOUBLE", "DECIMAL", "BIGINT", "FLOAT"),
          "array": ("ARRAY",), "struct": ("OBJECT",), "map": ("OBJECT",)}


def conforms(raw: DataFrame, schema: str | T.StructType = MESSAGE_SCHEMA, text: str = "raw",
             required: Sequence[str] = REQUIRED) -> DataFrame:
    """PF14: structural gate before parsing: a valid JSON object, every
    required key present with a value, and every field of ``schema`` that is
    present of the JSON kind its type takes.  Adds ``schema_ok`` and
    ``schema_reason``; rejected rows are kept apart from semantic dead letters
    (which ``parse_events`` finds on the rows that pass).  Nested fields of
    the same name do not count."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    d = raw.withColumn("_v", F.try_parse_json(F.col(text)))
    kind = {f: F.schema_of_variant(F.try_variant_get("_v", f"$['{f}']", "variant")) for f in {*required, *fields.names}}
    missing, wrong = F.lit(False), F.lit(False)
    for f in required:
        missing = missing | F.coalesce(kind[f], F.lit("VOID")).isin("VOID")
    for f in fields:
        takes = next((k for t, k in _KINDS.items() if f.dataType.simpleString().startswith(t)), ("STRING",))
        fits = F.lit(False)
        for t in (*takes, "VOID"):
            fits = fits | kind[f.name].startswith(t)
        wrong = wrong | ~F.coalesce(fits, F.lit(True))
    not_object = ~F.coalesce(F.schema_of_variant("_v"), F.lit("")).startswith("OBJECT")
    reason = F.when(not_object, "not_json").when(missing, "missing_key").when(wrong, "wrong_type")
    return d.withColumn("schema_reason", reason).withColumn("schema_ok", F.col("schema_reason").isNull()).drop("_v")


def payload_field(df: DataFrame, payload: str, path: str, cast: str = "bigint") -> Column:
    """PF9: a field of a JSON payload column (``jsonPayload.x``)."""
    return F.get_json_object(F.col(payload), path).cast(cast)


def tumbling_sum(df: DataFrame, ts: str, value: Column, size: str, keys: Sequence[str] = ()) -> DataFrame:
    """SS1: fixed event-time windows, sum; windows with no element produce
    no row (UD4).  Works on batch and on watermarked streams."""
    return (df.groupBy(F.window(F.col(ts).cast("timestamp"), size).alias("w"), *keys)
            .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("elements"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, "total", "elements"))


def sliding_sum(df: DataFrame, ts: str, value: Column, size: str, slide: str) -> DataFrame:
    """SS2: sliding windows (each element falls in size/slide windows)."""
    return (df.groupBy(F.window(F.col(ts).cast("timestamp"), size, slide).alias("w"))
            .agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("elements"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "total", "elements"))


def sessions_by_gap(df: DataFrame, key: str, ts: str, tie: str, gap_s: int) -> DataFrame:
    """SS3, WI10: session windows per key over a batch: a gap larger than
    ``gap_s`` splits.  By ``lag`` and a running count of session starts, both
    bucket-split (per hour), so one key with many events is not sorted in one
    task (the stream form is ``streaming.windows.session_counts``)."""
    b = time_bucket(ts)
    d = prev_within(df.select(key, ts, tie), [key], [ts, tie], [ts], b)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    start = F.col("prev_" + ts).isNull() | (us - F.unix_micros(F.col("prev_" + ts).cast("timestamp")) > gap_s * 1_000_000)
    d = d.withColumn("_start", start.cast("int"))
    d = running_sum(d, [key], [ts, tie], "_start", b, "session_no")
    return (d.groupBy(key, "session_no")
            .agg(F.min(ts).alias("session_start"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("events"))
            .select(key, F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                    (F.col("_last") + F.make_dt_interval(secs=F.lit(gap_s))).cast("timestamp_ntz").alias("session_end"),
                    "events"))


def first_per_id(df: DataFrame, id_col: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """SS9 (batch form): one row per id, the first by ``order`` (partial
    aggregation with ``min_by``; a hot id is one row per map task)."""
    o = F.struct(*[F.col(c) for c in order])
    return df.groupBy(id_col).agg(*[F.min_by(c, o).alias(c) for c in cols], F.count(F.lit(1)).alias("copies"))


def latest_per_key(df: DataFrame, key: str, version: str, cols: Sequence[str]) -> DataFrame:
    """WI6: latest version per key (``max_by``)."""
    return df.groupBy(key).agg(F.max(version).alias(version), *[F.max_by(c, F.col(version)).alias(c) for c in cols])


def apply_changes(changes: DataFrame, key: str, version: str, op: str, cols: Sequence[str]) -> DataFrame:
    """SS20 (batch form): apply a change log in commit order -- the latest
    change per key wins; a latest delete removes the key."""
    last = latest_per_key(changes, key, version, [op, *cols])
    return last.where(F.col(op) != "D").drop(op)


def cascade_deletes(children: DataFrame, parent_key: str, changes: DataFrame, key: str, version: str,
                    op: str) -> DataFrame:
    """SS20 cascade: child rows whose parent's latest change is a delete are
    removed (``left_anti`` against the deleted parent keys)."""
    last = latest_per_key(changes, key, version, [op])
    deleted = last.where(F.col(op) == "D").select(F.col(key).alias(parent_key))
    return children.join(deleted, parent_key, "left_anti")


def order_inversions(df: DataFrame, key: str, seq: str, arrival: str, tie: str) -> DataFrame:
    """WI7: per ordering key, messages that arrived after a higher sequence
    number (``seq < lag(seq)`` in arrival order)."""
    d = prev_within(df.select(key, seq, arrival, tie), [key], [arrival, tie], [seq], time_bucket(arrival))
    return d.groupBy(key).agg(F.count(F.lit(1)).alias("messages"),
                              F.count_if(F.col(seq) < F.col("prev_" + seq)).alias("inversions"))


def inter_event_gap(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """WI8: seconds since the previous event of the same key."""
    d = prev_within(df.select(key, ts, tie), [key], [ts, tie], [ts], time_bucket(ts))
    gap = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("prev_" + ts).cast("timestamp"))) / 1e6
    return d.select(tie, key, ts, gap.alias("gap_s"))


def delivery_quarantine(attempts: DataFrame, msg: str, ts: str, ok: str, max_failures: int = 5) -> DataFrame:
    """SS13 (batch form): failures per message; quarantined after
    ``max_failures`` failed deliveries, with attempt count and first publish."""
    return (attempts.groupBy(msg).agg(F.count(F.lit(1)).alias("attempts"),
                                      F.count_if(~F.col(ok)).alias("failures"), F.min(ts).alias("first_publish"))
            .withColumn("quarantined", F.col("failures") >= max_failures))


def id_bucket(c) -> Column:
    """Sampling bucket 0..9999 of an id of any type: a hash of its text (the
    same in SQL and in Python, so sampled sets can be checked)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.md5(x.cast("string")), 1, 8), 16, 10).cast("bigint") % 10000


def tail_sample(spans: DataFrame, trace: str, status: str, duration: str, slow_ms: float, keep_ratio: float) -> DataFrame:
    """SS17 (batch form): per complete trace, keep it when any span errored,
    when any span is slower than ``slow_ms``, else a ``keep_ratio`` share by
    trace-id hash."""
    g = spans.groupBy(trace).agg(F.count_if(F.col(status) == "ERROR").alias("_err"),
                                 F.max(duration).alias("_max"), F.count(F.lit(1)).alias("spans"))
    reason = (F.when(F.col("_err") > 0, "error").when(F.col("_max") > slow_ms, "slow")
              .when(id_bucket(trace) < int(keep_ratio * 10000), "sampled"))
    return g.select(trace, "spans", reason.alias("reason")).where(F.col("reason").isNotNull())


def head_sample(spans: DataFrame, trace: str, ratio: float, parent: str | None = None) -> DataFrame:
    """SS18: head sampling by trace-id ratio.  Only the trace id is hashed,
    so every span of a trace gets one decision; where a caller's decision came
    with the request (``parent``, a boolean, null for a new trace), it
    stands."""
    own = id_bucket(trace) < int(ratio * 10000)
    return spans.withColumn("sampled", F.coalesce(F.col(parent), own) if parent else own)


def window_labels(windows: DataFrame) -> DataFrame:
    """UD3: ``[start, end)`` label of each window row."""
    return windows.withColumn("label", F.format_string(
        "[%s, %s)", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"),
        F.date_format("window_end", "yyyy-MM-dd HH:mm:ss")))


class CentsSum:
    """UD4: a combiner: an accumulator per group, values added in batches,
    accumulators merged, the result read off."""

    def create(self) -> int:
        return 0

    def add(self, acc: int, values: pd.Series) -> int:
        return acc + int((values * 100).round().astype("int64").sum())

    def merge(self, a: int, b: int) -> int:
        return a + b

    def extract(self, acc: int) -> int:
        return acc


def custom_combine(df: DataFrame, ts: str, value: str, size: str, combiner=None) -> DataFrame:
    """UD4: per-window combine with a Python combiner; empty windows give no
    row, windows of nulls alone a null total.  Every map task folds its Arrow
    batches to one accumulator per window before the shuffle; after it only
    accumulators are merged, so a window with any share of the rows is one
    small row per task.  A task without rows yields nothing."""
    c = combiner or CentsSum()
    rows = df.select(F.window(F.col(ts).cast("timestamp"), size).start.alias("w"), F.col(value).alias("v"))

    def fold(batches):
        acc: dict = {}
        seen: dict = {}
        for pdf in batches:
            for w, v in pdf.groupby("w")["v"]:
                v = v.dropna()
                acc[w] = c.add(acc.get(w, c.create()), v)
                seen[w] = seen.get(w, 0) + len(v)
        if acc:
            yield pd.DataFrame({"w": list(acc), "acc": list(acc.values()), "seen": list(seen.values())})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        acc = c.create()
        for x in pdf["acc"]:
            acc = c.merge(acc, int(x))
        total = c.extract(acc) if pdf["seen"].sum() else None
        return pd.DataFrame({"w": pdf["w"][:1], "total_cents": pd.array([total], dtype="Int64")})

    parts = rows.mapInPandas(fold, "w timestamp, acc long, seen long")
    out = parts.groupBy("w").applyInPandas(merge, "w timestamp, total_cents long")
    return out.select(F.col("w").cast("timestamp_ntz").alias("window_start"), "total_cents")


def count_firings(df: DataFrame, key: str, order: Sequence[str], value: str, n: int, bucket: Column) -> DataFrame:
    """SS4 (batch form): the firings of a global window per key that emits
    (count, running total) every ``n`` elements, accumulating.  Totals in
    cents; count and total are running sums split by ``bucket``."""
    d = df.select(key, *order, F.round(F.col(value) * 100).cast("bigint").alias("_c"), F.lit(1).alias("_one"))
    d = running_sum(d, [key], order, "_one", bucket, "fired_at_count")
    d = running_sum(d, [key], order, "_c", bucket, "_cents")
    return d.where(F.col("fired_at_count") % n == 0).select(
        key, F.col("fired_at_count").cast("bigint").alias("fired_at_count"), (F.col("_cents") / 100.0).alias("running_total"))


def payload_keys(df: DataFrame, payload: str) -> DataFrame:
    """UD1: element function with 0..n outputs per input (one row per key of
    the JSON payload), as a generator expression -- no Python per row."""
    return df.select("*", F.explode(F.json_object_keys(F.col(payload))).alias("payload_key"))


def arrival_vs_event_windows(df: DataFrame, ts: str, skew_s: str, unit: str = "hour") -> DataFrame:
    """SS25: counts per window by event time and by arrival (processing)
    time; the difference is the pitfall of processing-time windows."""
    arr = F.col(ts) + F.make_dt_interval(secs=F.col(skew_s).cast("int"))
    e = df.groupBy(F.date_trunc(unit, ts).cast("timestamp_ntz").alias("window_start")).agg(
        F.count(F.lit(1)).alias("by_event_time"))
    a = df.groupBy(F.date_trunc(unit, arr).cast("timestamp_ntz").alias("window_start")).agg(
        F.count(F.lit(1)).alias("by_arrival_time"))
    j = e.join(a, "window_start", "full_outer")
    return j.select("window_start", F.coalesce("by_event_time", F.lit(0)).alias("by_event_time"),
                    F.coalesce("by_arrival_time", F.lit(0)).alias("by_arrival_time")).withColumn(
        "differs", F.col("by_event_time") != F.col("by_arrival_time"))


def held_delivery(attempts: DataFrame, key: str, seq: str, ts: str, ok: str, tie: str, max_failures: int = 5,
                  block: int = 10_000) -> DataFrame:
    """SS14: per-key ordered processing, read off the delivery log.  A message
    is decided at its first success, or dead-lettered at its ``max_failures``th
    failure; with delivery in sequence it is released when it and all earlier
    messages of its key are decided.  An undecided message holds all later
    ones (``released_at`` null).

    Attempts of one message are ordered together; the running maximum over a
    key is taken inside blocks of ``block`` sequence numbers and over the
    block maxima, so a hot key is many tasks."""
    w = Window.partitionBy(key, seq).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = attempts.select(key, seq, ts, tie, F.col(ok).alias("_ok")).withColumn("_fails", F.sum((~F.col("_ok")).cast("int")).over(w))
    won = F.min(F.when(F.col("_ok") & (F.col("_fails") < max_failures), F.col(ts)))
    lost = F.min(F.when(~F.col("_ok") & (F.col("_fails") == max_failures), F.col(ts)))
    m = d.groupBy(key, seq).agg(F.min(ts).alias("first_publish"), won.alias("_won"), lost.alias("_lost"))
    # fewer failures than the limit before it, so a success comes first
    m = m.withColumn("decided_at", F.coalesce("_won", "_lost")).withColumn(
        "outcome", F.when(F.col("_won").isNotNull(), "processed").when(F.col("_lost").isNotNull(), "dead_letter"))
    m = m.withColumn("_blk", F.floor(F.col(seq) / block)).withColumn("_open", F.col("decided_at").isNull().cast("int"))
    wk = Window.partitionBy(key, "_blk").orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = m.withColumn("_in", F.max("decided_at").over(wk)).withColumn("_stuck", F.sum("_open").over(wk))
    before = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    b = (m.groupBy(key, "_blk").agg(F.max("decided_at").alias("_max"), F.sum("_open").alias("_n"))
         .select(key, "_blk", F.max("_max").over(before).alias("_prev"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    from .sequence import _join_back
    m = _join_back(m, b, [key, "_blk"])
    free = (F.col("_stuck") + F.col("_before")) == 0
    return m.select(key, seq, "first_publish", "decided_at", "outcome",
                    F.when(free, F.greatest("_in", "_prev")).alias("released_at")).withColumn(
        "held_s", (F.unix_micros(F.col("released_at").cast("timestamp")) - F.unix_micros(F.col("decided_at").cast("timestamp"))) / 1e6)
