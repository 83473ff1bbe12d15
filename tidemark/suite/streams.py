"""Streaming operators run to the end of the given tables: the rows arrive
in slices (one or more micro-batches each), the sink lands them, and the
landed table is the result that the SQL checks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import commits
from ..keyed import KeyedTable
from ..operators import events as ev
from ..operators import joins, layout, rollup
from ..operators.slo import severity_filter
from ..plans import guards
from ..registry import register
from ..session import scratch_path
from ..sources import segment_log
from ..sources.fixtures import v_changes, v_events, v_logs, v_requests
from ..sources.tables import Tables
from ..streaming import enrich
from ..streaming import io as sio
from ..streaming import stateful as st
from ..streaming import windows as sw
from .events import raw_messages

HOUR = "date_trunc('hour', ts)"


def _t(spark, sf):
    return Tables(spark, sf)


class _Run:
    """Scratch folders of one run, and the source that its rows arrive by.

    A slice arrives as one file per task that wrote it.  A micro-batch takes
    as many files as a slice of its source has at most, so the batches, and
    what each costs, do not grow in number with the input, and the files of a
    slice are read side by side."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = scratch_path(spark, f"stream-{tag}-{uuid.uuid4().hex}")
        self.files: dict[str, int] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def arrive(self, *slices: DataFrame, name: str = "source") -> None:
        for s in slices:
            before = self._count(name)
            s.write.mode("append").parquet(self.path(name))
            self.files[name] = max(self.files.get(name, 1), self._count(name) - before)

    def _count(self, name: str) -> int:
        path = self.path(name)
        if not commits.exists(self.spark, path):
            return 0
        return sum(f.endswith(".parquet") for f in commits.files(self.spark, path))

    def stream(self, schema, name: str = "source") -> DataFrame:
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files.get(name, 1)).parquet(self.path(name))

    def land(self, df: DataFrame, sink, mode: str = "append", name: str = "ckpt") -> None:
        sw.run_available(df, sink, self.path(name), mode=mode)


def _thirds(df: DataFrame, col: str) -> list[DataFrame]:
    return [df.where(F.col(col) % 3 == i) for i in range(3)]


def _events(spark, sf) -> DataFrame:
    e = v_events(_t(spark, sf))
    return e.withColumn("cents", F.round(F.col("amount") * 100).cast("bigint")).withColumn("ts", F.col("ts").cast("timestamp"))


def _hour(col="window.start"):
    return F.col(col).cast("timestamp_ntz").alias("window_start")


CENTS = "CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT)"


@register("so10_upsert_windows", f"""
SELECT {HOUR} AS window_start, {CENTS} AS total, count(*) AS elements FROM v_events GROUP BY 1""")
def so10(spark, sf):
    """SO10, SS1, SS5-SS7: hourly windows, re-emitted on every change while
    the lateness lasts, replaced by window key in the sink."""
    e, run = _events(spark, sf), _Run(spark, "so10")
    run.arrive(*_thirds(e, "event_id"))
    agg = sw.windowed_sum(run.stream(e.schema), "ts", "cents", "1 hour", lateness="60 days")
    run.land(agg, sio.upsert(run.path("t"), ["window"], "elements"), mode="update")
    return spark.read.parquet(run.path("t")).select(_hour(), "total", "elements")


@register("so10b_keyed_upsert", """
SELECT CASE WHEN user_id % 50 = 0 THEN NULL ELSE user_id END AS user_key, event_type, max(event_id) AS event_id,
       arg_max(event_date, event_id) AS event_date, arg_max(amount, event_id) AS amount
FROM v_events GROUP BY 1, 2""")
def so10b(spark, sf):
    """SO10: the latest event per user and type, some users null, keys that
    move to other days; every slice is delivered twice and out of order."""
    e, run = v_events(_t(spark, sf)), _Run(spark, "so10b")
    e = e.select(F.when(F.col("user_id") % 50 != 0, F.col("user_id")).alias("user_key"), "event_type", "event_id", "event_date", "amount")
    a, b, c = _thirds(e, "event_id")
    run.arrive(b, a, c, a, b)
    keys = ["user_key", "event_type"]
    run.land(run.stream(e.schema), sio.keyed_upsert(run.path("t"), keys, "event_id", keep_newer=True))
    return KeyedTable(spark, run.path("t"), keys).read()


@register("so11_discarding_deltas", f"""
SELECT event_type, CAST({CENTS} AS BIGINT) AS cents FROM v_events GROUP BY event_type""")
def so11(spark, sf):
    """SO11, SS8: each batch appends its own increments; a replayed batch
    replaces itself; the reader sums."""
    e, run = _events(spark, sf), _Run(spark, "so11")
    run.arrive(*_thirds(e, "event_id"))
    put = sio.append_deltas(run.path("t"))

    def twice(batch, batch_id):
        d = batch.groupBy("event_type").agg(F.sum("cents").alias("cents"))
        put(d, batch_id)
        put(d, batch_id)

    run.land(run.stream(e.schema), twice)
    return sio.read_deltas(spark, run.path("t"), ["event_type"], "cents")


@register("so12_exactly_once", """
SELECT event_type, count(*) AS landed, count(DISTINCT event_id) AS ids FROM v_events GROUP BY event_type""")
def so12(spark, sf):
    """SO12, SS9, SS12: a third of the ids is delivered twice, and the first run
    stops after the first two slices; every id lands once."""
    e, run = _events(spark, sf), _Run(spark, "so12")
    a, b, c = _thirds(e, "event_id")
    sink = sio.exactly_once(run.path("t"), "event_id")
    run.arrive(a, b)
    run.land(sw.dedup(run.stream(e.schema), "event_id", "ts", "60 days"), sink)
    run.arrive(a, c)
    run.land(sw.dedup(run.stream(e.schema), "event_id", "ts", "60 days"), sink)
    return spark.read.parquet(run.path("t")).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("landed"), F.countDistinct("event_id").alias("ids"))


@register("so12b_exactly_once_ever", """
SELECT event_type, count(*) AS landed, count(DISTINCT event_id) AS ids, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS cents
FROM v_events GROUP BY event_type""")
def so12b(spark, sf):
    """SO12, SS9: ids delivered again by a later run that has no state of the
    first one, with other amounts; the first delivery stays."""
    e, run = _events(spark, sf).select("event_id", "event_type", "cents"), _Run(spark, "so12b")
    a, b, c = _thirds(e, "event_id")
    sink = sio.exactly_once_ever(run.path("t"), "event_id")
    run.arrive(a, b)
    run.land(run.stream(e.schema), sink)
    run.arrive(a.withColumn("cents", F.lit(0).cast("bigint")), c, b, name="later")
    run.land(run.stream(e.schema, "later"), sink, name="other")
    return KeyedTable(spark, run.path("t"), ["event_id"]).read().groupBy("event_type").agg(
        F.count(F.lit(1)).alias("landed"), F.countDistinct("event_id").alias("ids"), F.sum("cents").alias("cents"))


@register("so13_dead_letters", """
WITH x AS (SELECT event_id, event_type,
                  CASE WHEN event_id % 97 = 0 THEN 'corrupt' WHEN event_id % 89 = 0 THEN 'missing_field'
                       WHEN event_id % 83 = 0 THEN 'bad_amount' WHEN event_id % 79 = 0 THEN 'bad_time' ELSE 'good' END AS reason FROM events)
SELECT reason, CASE WHEN reason = 'good' THEN event_type END AS event_type, count(*) AS n FROM x GROUP BY 1, 2""")
def so13(spark, sf):
    """SO13, SS21: one parse, good rows and dead letters apart, and counts by
    type of the good ones as a second output of the same batch."""
    m, run = raw_messages(_t(spark, sf)).select("msg_id", "raw"), _Run(spark, "so13")
    run.arrive(*_thirds(m, "msg_id"))

    def counts(parsed, batch_id):
        sio.append_deltas(run.path("counts"))(parsed.where(F.col("error").isNull()).groupBy("event_type")
                                              .agg(F.count(F.lit(1)).alias("n")), batch_id)

    run.land(run.stream(m.schema), sio.parse_and_route(run.path("good"), run.path("dead"), ev.parse_events, extra=counts))
    dead = spark.read.parquet(run.path("dead")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    good = sio.read_deltas(spark, run.path("counts"), ["event_type"], "n")
    return (dead.select("reason", F.lit(None).cast("string").alias("event_type"), "n")
            .unionByName(good.select(F.lit("good").alias("reason"), "event_type", "n")))


@register("so14_route_logs", """
SELECT 'all' AS route, severity, count(*) AS n FROM v_logs GROUP BY severity
UNION ALL SELECT 'errors', severity, count(*) FROM v_logs WHERE severity = 'ERROR' GROUP BY severity
UNION ALL SELECT 'copy', severity, count(*) FROM v_logs GROUP BY severity""")
def so14(spark, sf):
    """SO14, SO18: severity routes of one consumer, and a second consumer
    that sees every message."""
    logs, run = v_logs(_t(spark, sf)).select("log_id", "severity"), _Run(spark, "so14")
    run.arrive(*_thirds(logs, "log_id"))
    paths = {k: run.path(k) for k in ("errors", "all", "copy")}
    router = sio.route({"errors": (lambda b: severity_filter(b, "ERROR"), paths["errors"]), "all": (lambda b: b, paths["all"])})
    tag = uuid.uuid4().hex
    for q in sio.fan_out(run.stream(logs.schema), {f"router-{tag}": router, f"copy-{tag}": sio.route({"c": (lambda b: b, paths["copy"])})},
                         run.path("ck")):
        q.awaitTermination()
    out = [spark.read.parquet(p).groupBy("severity").agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("route"), "severity", "n")
           for k, p in paths.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("so15_merge_enrichment", """
SELECT CASE WHEN c_custkey % 4 = 0 THEN 'vip' WHEN c_custkey % 3 = 0 THEN 'old' END AS label, count(*) AS n,
       CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer GROUP BY 1""")
def so15(spark, sf):
    """SO15: labels written back by key, twice, over a table that has some."""
    c, run = _t(spark, sf).customer, _Run(spark, "so15")
    c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.lit("old")).alias("label")).write.parquet(run.path("t"))
    new = c.where(F.col("c_custkey") % 4 == 0).select("c_custkey", F.lit("vip").alias("label"))
    for _ in range(2):
        sio.merge_enrichment(spark, run.path("t"), new, "c_custkey")
    return spark.read.parquet(run.path("t")).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


@register("so15b_keyed_enrichment", """
SELECT CASE WHEN c_custkey % 4 = 0 THEN 'vip' WHEN c_custkey % 3 = 0 THEN 'old' END AS label, count(*) AS n,
       CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer GROUP BY 1""")
def so15b(spark, sf):
    """SO15: labels written back into a keyed table, twice; keys that it does
    not have are left out."""
    c, run = _t(spark, sf).customer, _Run(spark, "so15b")
    t = KeyedTable(spark, run.path("t"), ["c_custkey"], rows_per_piece=5_000)
    t.upsert(c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.lit("old")).alias("label")))
    new = c.where(F.col("c_custkey") % 4 == 0).select("c_custkey", F.lit("vip").alias("label"))
    for _ in range(2):
        t.merge_columns(new.unionByName(new.select((-F.col("c_custkey")).alias("c_custkey"), "label")))
    return t.read().groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


@register("so16_replay_range", f"""
SELECT {HOUR} AS window_start, CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' THEN 2 ELSE 1 END * {CENTS} AS total
FROM v_events GROUP BY 1, ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'""")
def so16(spark, sf):
    """SO16: two days replayed through a corrected transform (amounts twice
    as high) replace exactly their windows."""
    e, run = v_events(_t(spark, sf)), _Run(spark, "so16")
    e.write.parquet(run.path("log"))

    def totals(factor):
        return lambda d: (d.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start"))
                          .agg((F.sum(F.round(F.col("amount") * 100).cast("bigint")) * factor).alias("total")))

    sink = sio.upsert(run.path("t"), ["window_start"], "total")
    sio.replay(spark, run.path("log"), "ts", "2000-01-01", totals(1), sink, 0)
    sio.replay(spark, run.path("log"), "ts", "2024-01-10", totals(2), sink, 1, to_ts="2024-01-12")
    return spark.read.parquet(run.path("t"))


@register("ss10_late_side_output", """
WITH w AS (SELECT max(epoch_us(ts)) AS mark FROM v_events WHERE skew_s <= 100),
x AS (SELECT ts, skew_s > 100 AND (epoch_us(ts) // 3600000000 + 1) * 3600000000 <= mark AS late FROM v_events, w)
SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE NOT late) AS counted, count(*) FILTER (WHERE late) AS late FROM x GROUP BY 1""")
def ss10(spark, sf):
    """SS10: rows that took over 100 s arrive last; those whose hour the
    watermark has passed come out beside, none is lost."""
    e, run = _events(spark, sf), _Run(spark, "ss10")
    e.where("skew_s <= 100").write.parquet(run.path("first"))
    e.where("skew_s > 100").write.parquet(run.path("then"))
    sink = sio.late_side_output(sio.append_deltas(run.path("t")), run.path("late"), run.path("clock"), "ts", 0, 3600)
    for i, part in enumerate(("first", "then")):
        sink(spark.read.parquet(run.path(part)), i)
    day = F.col("ts").cast("timestamp_ntz").cast("date").alias("day")
    a = spark.read.parquet(run.path("t")).groupBy(day).agg(F.count(F.lit(1)).alias("counted"))
    b = spark.read.parquet(run.path("late")).groupBy(day).agg(F.count(F.lit(1)).alias("late"))
    return a.join(b, "day", "full_outer").select("day", F.coalesce("counted", F.lit(0)).alias("counted"), F.coalesce("late", F.lit(0)).alias("late"))


@register("ss11_drain_windows", f"""
SELECT {HOUR} AS window_start, {CENTS} AS total, count(*) AS elements FROM v_events GROUP BY 1""")
def ss11(spark, sf):
    """SS11: append mode, drained: the last windows come out too."""
    e, run = _events(spark, sf), _Run(spark, "ss11")
    run.arrive(e)
    far = e.limit(1).withColumn("ts", F.lit("2100-01-01").cast("timestamp"))
    put = sio.append_deltas(run.path("t"))
    sw.drain(lambda s: sw.windowed_sum(s, "ts", "cents", "1 hour", lateness="60 days"), run.stream(e.schema),
             lambda: run.arrive(far), lambda b, i: put(b, i), run.path("ckpt"))
    return spark.read.parquet(run.path("t")).select(_hour(), "total", "elements")


@register("ss20_cdc_stream", """
WITH last AS (SELECT id, max(version) AS version, arg_max(op, version) AS op, arg_max(payload, version) AS payload FROM v_changes GROUP BY id)
SELECT id, version, payload FROM last WHERE op <> 'D'""")
def ss20s(spark, sf):
    """SS20: changes in the wrong order over three slices; deletes stay."""
    c, run = v_changes(_t(spark, sf)).select("id", "version", "op", "payload"), _Run(spark, "ss20")
    run.arrive(*reversed(_thirds(c, "version")))
    run.land(run.stream(c.schema), sio.cdc_apply(run.path("t"), "id", "version"))
    return sio.read_changes(spark, run.path("t")).select("id", "version", "payload")


@register("ss20c_keyed_changes", """
WITH last AS (SELECT id, max(version) AS version, arg_max(op, version) AS op, arg_max(payload, version) AS payload FROM v_changes GROUP BY id)
SELECT id, version, payload FROM last WHERE op <> 'D'""")
def ss20c(spark, sf):
    """SS20 into a keyed table, changes in the wrong order."""
    c, run = v_changes(_t(spark, sf)).select("id", "version", "op", "payload"), _Run(spark, "ss20c")
    run.arrive(*reversed(_thirds(c, "version")))
    run.land(run.stream(c.schema), sio.keyed_changes(run.path("t"), "id", "version"))
    return sio.read_keyed_changes(spark, run.path("t"), "id").select("id", "version", "payload")


@register("jo8_stream_enrichment", """
SELECT c_mktsegment AS segment, count(*) AS requests FROM v_requests LEFT JOIN customer ON c_custkey = request_id % 500 GROUP BY 1""")
def jo8(spark, sf):
    r = v_requests(_t(spark, sf)).select("request_id", (F.col("request_id") % 500).alias("c_custkey"))
    run = _Run(spark, "jo8")
    run.arrive(*_thirds(r, "request_id"))
    dim = _t(spark, sf).customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    run.land(sw.enrich(run.stream(r.schema), dim, "c_custkey"), sio.append_deltas(run.path("t")))
    return spark.read.parquet(run.path("t")).groupBy("segment").agg(F.count(F.lit(1)).alias("requests"))


@register("ss24_stream_batch_reconcile", f"""
WITH b AS (SELECT {HOUR} AS window_start, CAST(count(*) AS BIGINT) AS batch_value, CAST(count(*) FILTER (WHERE skew_s <= 100) AS BIGINT) AS stream_value
           FROM v_events GROUP BY 1)
SELECT window_start, stream_value, batch_value, round(abs(stream_value - batch_value) / batch_value, 6) AS divergence,
       abs(stream_value - batch_value) / batch_value > 0.01 AS alert FROM b""")
def ss24(spark, sf):
    """SS24: the stream saw only what arrived within 100 s."""
    e, run = _events(spark, sf), _Run(spark, "ss24")
    run.arrive(*_thirds(e.where("skew_s <= 100"), "event_id"))
    agg = sw.windowed_sum(run.stream(e.schema), "ts", "cents", "1 hour", lateness="60 days")
    run.land(agg, sio.upsert(run.path("t"), ["window"], "elements"), mode="update")
    s = spark.read.parquet(run.path("t")).select(_hour(), F.col("elements").alias("n"))
    b = v_events(_t(spark, sf)).groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start")).agg(F.count(F.lit(1)).alias("n"))
    return joins.reconcile(s, b, ["window_start"], "n")


_ROLLUP = """SELECT event_date, tenant_id, event_type, count(*) AS events,
       CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS amount, count(*) FILTER (WHERE event_type = 'purchase') AS purchases
FROM v_events {where} GROUP BY 1, 2, 3"""
_ROLLUP_COLS = ["event_date", "tenant_id", "event_type", "events", "amount", "purchases"]


def _rolled(spark, path: str) -> DataFrame:
    r = spark.read.parquet(path).select(*_ROLLUP_COLS)
    return r.withColumn("events", F.col("events").cast("bigint")).withColumn("purchases", F.col("purchases").cast("bigint"))


@register("ag37_incremental_refresh", _ROLLUP.format(where="WHERE CAST(ts AS DATE) <> DATE '2024-01-07'"))
def ag37(spark, sf):
    """AG37: a day without its events any more, and rows appended twice."""
    e, path = v_events(_t(spark, sf)), _Run(spark, "ag37").path("r")
    late = F.col("event_id") % 5 == 0
    day = F.col("event_date") == F.lit(dt.date(2024, 1, 7))
    rollup.write_rollup(rollup.build_rollup(e.where(~late | day)), path, dt.datetime(2024, 2, 1))
    for _ in range(2):
        rollup.append_rollup(e.where(late & ~day), path, dt.datetime(2024, 2, 2), "late")
    rollup.refresh_rollup(e.where(~day), path, ["2024-01-07", "2024-01-08"], dt.datetime(2024, 2, 3))
    return _rolled(spark, path)


@register("ag39_fresh_or_recomputed", """
SELECT 'rollup' AS source, tenant_id, count(*) AS events FROM v_events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY tenant_id
UNION ALL SELECT 'rollup+base', tenant_id, count(*) FROM v_events GROUP BY tenant_id""")
def ag39(spark, sf):
    """AG39: within the staleness the rollup answers, beyond it the days
    since its refresh are added from the base table."""
    e, path = v_events(_t(spark, sf)), _Run(spark, "ag39").path("r")
    rollup.write_rollup(rollup.build_rollup(e.where(F.col("ts") < F.lit(dt.datetime(2024, 1, 15)))), path, dt.datetime(2024, 1, 15))
    out = []
    for now in (dt.datetime(2024, 1, 15, 1), dt.datetime(2024, 2, 1)):
        d, source = rollup.answer_fresh(spark, path, e, ["tenant_id"], now, dt.timedelta(hours=2), "2024-01-15")
        out.append(d.select(F.lit(source).alias("source"), "tenant_id", F.col("events").cast("bigint").alias("events")))
    return out[0].unionByName(out[1])


def _refused(check) -> bool:
    try:
        check()
    except guards.GuardError:
        return True
    return False


@register("pf4_guards_on_plans", """
SELECT * FROM (VALUES ('unbounded scan refused', true), ('not null is no bound', true), ('day and dimension pass', true),
  ('cartesian refused', true), ('limit leaves the scan', true), ('aggregate is priced', true)) v("check", passed)
WHERE (SELECT count(*) FROM events) > 0""")
def pf4(spark, sf):
    """PF4, PF6, JO5, SL4: the guards on plans over the partitioned events."""
    e, path = v_events(_t(spark, sf)), _Run(spark, "pf4").path("t")
    layout.write_partitioned(e, path, "event_date", cluster=["tenant_id"])
    t, n = spark.read.parquet(path), _t(spark, sf).nation
    day = t.where(F.col("event_date") == F.lit(dt.date(2024, 1, 10)))
    joined = day.join(n, F.col("user_id") % 25 == F.col("n_nationkey"))
    rows = [("unbounded scan refused", _refused(lambda: guards.require_partition_filter(t.where("amount > 1"), ["event_date"]))),
            ("not null is no bound", _refused(lambda: guards.require_partition_filter(t.where("event_date IS NOT NULL"), ["event_date"]))),
            ("day and dimension pass", not _refused(lambda: guards.require_partition_filter(joined, ["event_date"]))),
            ("cartesian refused", _refused(lambda: guards.forbid_cartesian(day.crossJoin(n)))),
            ("limit leaves the scan", guards.limit_does_not_cut_scan(t.orderBy("amount"), 10)),
            ("aggregate is priced", _refused(lambda: guards.max_bytes_guard(t.groupBy("tenant_id").count(), 0)))]
    return spark.createDataFrame(rows, "check string, passed boolean")


# batch in which an event arrives: early days in parts 0, 1, 3 and 4, late
# days in 2, 3 and 5
_PART = """CASE WHEN day(ts) <= 15 THEN CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 4 END
                ELSE CASE event_id % 4 WHEN 2 THEN 3 WHEN 3 THEN 5 ELSE 2 END END"""
_LATE_DAYS = 10


def _parts(e: DataFrame, run: _Run) -> None:
    """Six arrivals, one file each, so that a micro-batch is one of them."""
    for i in range(6):
        run.arrive(e.where(F.expr(_PART) == i).coalesce(1))


def _clock(before: int = 1) -> str:
    """The clock of a batch is the latest event time up to so many batches
    before it; ``kept`` is what is not too late by it."""
    return f"""
b AS (SELECT *, {_PART} AS batch, date_trunc('day', ts) AS w, CAST(round(amount * 100) AS BIGINT) AS cents FROM v_events),
k AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND {before} PRECEDING) AS clock FROM b GROUP BY batch),
g AS (SELECT w, b.batch, sum(cents) AS cents, count(*) AS n, any_value(date_trunc('millisecond', clock)) AS clock FROM b JOIN k ON k.batch = b.batch GROUP BY 1, 2),
kept AS (SELECT * FROM g WHERE clock IS NULL OR clock - INTERVAL {_LATE_DAYS} DAY < w + INTERVAL 1 DAY)"""


@register("ss7_window_firings", f"""
WITH {_clock()},
told AS (SELECT w, batch, 1 AS turn, CASE WHEN clock IS NULL OR clock < w + INTERVAL 1 DAY THEN 'early' ELSE 'late' END AS kind,
                sum(cents) OVER (PARTITION BY w ORDER BY batch ROWS UNBOUNDED PRECEDING) AS total FROM kept),
clocks AS (SELECT batch, date_trunc('millisecond', clock) AS clock FROM k UNION ALL SELECT 6, date_trunc('millisecond', max(ts)) FROM b),
closed AS (SELECT w, min(c.batch) AS batch FROM (SELECT DISTINCT w FROM kept) JOIN clocks c ON c.clock >= w + INTERVAL 1 DAY GROUP BY w),
on_time AS (SELECT t.w, c.batch, 0 AS turn, 'on_time' AS kind, arg_max(t.total, t.batch) AS total
            FROM told t JOIN closed c ON c.w = t.w AND t.batch < c.batch GROUP BY 1, 2),
x AS (SELECT * FROM told UNION ALL SELECT * FROM on_time)
SELECT w AS window_start, kind, row_number() OVER (PARTITION BY w ORDER BY batch, turn) AS firing, CAST(total AS DOUBLE) AS total FROM x""")
def ss7(spark, sf):
    """SS5-SS8: early, on-time and late firings of daily windows over six
    arrivals, ten days of allowed lateness, later elements dropped."""
    e, run = _events(spark, sf).select("event_id", "ts", "cents"), _Run(spark, "ss7")
    _parts(e, run)
    s = run.stream(e.schema).withWatermark("ts", f"{_LATE_DAYS} days")
    run.land(st.window_firings(s, "ts", "cents", 86_400, _LATE_DAYS * 86_400), sio.append_deltas(run.path("t")))
    out = spark.read.parquet(run.path("t"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "kind", "firing", "total")


@register("ss8_discarding_firings", f"""
WITH {_clock()}
SELECT w AS window_start, CAST(sum(cents) AS DOUBLE) AS total FROM kept GROUP BY w""")
def ss8(spark, sf):
    """SS8: firings of increments, appended and summed at read."""
    e, run = _events(spark, sf).select("event_id", "ts", "cents"), _Run(spark, "ss8")
    _parts(e, run)
    s = run.stream(e.schema).withWatermark("ts", f"{_LATE_DAYS} days")
    run.land(st.window_firings(s, "ts", "cents", 86_400, _LATE_DAYS * 86_400, accumulate=False), sio.append_deltas(run.path("t")))
    return sio.read_deltas(spark, run.path("t"), [F.col("window_start").cast("timestamp_ntz").alias("window_start")], "total")


@register("ss6_allowed_lateness", f"""
WITH {_clock(2)} SELECT w AS window_start, CAST(sum(cents) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS elements FROM kept GROUP BY w""")
def ss6(spark, sf):
    """SS5, SS6: windows corrected by elements up to ten days late.  The
    engine drops an element by the watermark of the batch before its own."""
    e, run = _events(spark, sf).select("event_id", "ts", "cents"), _Run(spark, "ss6")
    _parts(e, run)
    agg = sw.windowed_sum(run.stream(e.schema), "ts", "cents", "1 day", lateness=f"{_LATE_DAYS} days")
    run.land(agg, sio.upsert(run.path("t"), ["window"], "elements"), mode="update")
    return spark.read.parquet(run.path("t")).select(_hour(), "total", "elements")


@register("ss12_recovery", """
SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM v_events GROUP BY event_type""")
def ss12(spark, sf):
    """SS12: the writer is lost after the rows of its second batch are down
    and before the batch is committed; a second run goes on."""
    e, run = _events(spark, sf).select("event_id", "event_type"), _Run(spark, "ss12")
    run.arrive(*_thirds(e, "event_id"))
    put, lost = sio.append_deltas(run.path("t")), []

    def once_lost(batch, batch_id):
        put(batch, batch_id)
        if batch_id == 1 and not lost:
            lost.append(batch_id)
            raise OSError("writer lost")

    try:
        run.land(run.stream(e.schema), once_lost)
    except StreamingQueryException:
        run.land(run.stream(e.schema), once_lost)
    return spark.read.parquet(run.path("t")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"))


@register("ss21_second_output", f"""
WITH good AS (SELECT * FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 AND event_id % 79 <> 0)
SELECT 'rows' AS output, CAST(NULL AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM good GROUP BY event_type
UNION ALL SELECT 'counts', date_trunc('day', ts), event_type, count(*) FROM good GROUP BY 2, 3""")
def ss21(spark, sf):
    """SS21: daily counts by type as second output of the batches that land
    the parsed rows."""
    m, run = raw_messages(_t(spark, sf)).select("msg_id", "raw"), _Run(spark, "ss21")
    run.arrive(*_thirds(m, "msg_id"))

    def counts(parsed, batch_id):
        day = F.date_trunc("day", F.col("event_time")).cast("timestamp_ntz").alias("window_start")
        sio.append_deltas(run.path("counts"))(parsed.where(F.col("error").isNull()).groupBy(day, "event_type")
                                              .agg(F.count(F.lit(1)).alias("n")), batch_id)

    run.land(run.stream(m.schema), sio.parse_and_route(run.path("good"), run.path("dead"), ev.parse_events, extra=counts))
    rows = spark.read.parquet(run.path("good")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    seen = sio.read_deltas(spark, run.path("counts"), ["window_start", "event_type"], "n")
    return (rows.select(F.lit("rows").alias("output"), F.lit(None).cast("timestamp_ntz").alias("window_start"), "event_type", "n")
            .unionByName(seen.select(F.lit("counts").alias("output"), "window_start", "event_type", "n")))


@register("ss22_progress_table", f"""
WITH s AS (SELECT ts, CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 4 END AS batch FROM v_events
           UNION ALL SELECT ts, 2 FROM v_events WHERE day(ts) <= 20 AND event_id % 2 = 0
           UNION ALL SELECT ts, 3 FROM v_events WHERE day(ts) <= 20 AND event_id % 2 = 1),
c AS (SELECT batch, count(*) AS input_rows, max(ts) AS latest FROM s GROUP BY batch),
w AS (SELECT batch, input_rows, date_trunc('millisecond', max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) - INTERVAL 1 HOUR AS m FROM c)
SELECT CAST(batch AS BIGINT) AS batch_id, input_rows, coalesce(m, TIMESTAMP '1970-01-01') AS watermark, batch IN (3, 4) AS stuck FROM w""")
def ss22(spark, sf):
    """SS22: progress kept as a table; two redeliveries leave the watermark
    where it was, and the detector tells the batches."""
    e, run = _events(spark, sf).select("event_id", "ts", "cents"), _Run(spark, "ss22")
    day = F.dayofmonth("ts")
    again = e.where(day <= 20)
    for part in (e.where(day <= 10), e.where((day > 10) & (day <= 20)), again.where("event_id % 2 = 0"), again.where("event_id % 2 = 1"),
                 e.where(day > 20)):
        run.arrive(part.coalesce(1))
    recorder = sw.ProgressRecorder(spark, run.path("progress"))
    spark.streams.addListener(recorder)
    try:
        agg = sw.windowed_sum(run.stream(e.schema), "ts", "cents", "1 hour", lateness="1 hour")
        run.land(agg, sio.append_deltas(run.path("t")))
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(recorder)
    seen = sw.read_progress(spark, run.path("progress")).where("input_rows > 0")
    still = sw.stuck_watermarks(seen, 2).select(F.col("query_id").alias("q"), "from_batch", "to_batch")
    near = (F.col("query_id") == F.col("q")) & F.col("batch_id").between(F.col("from_batch"), F.col("to_batch"))
    return seen.join(still, near, "left").select(
        "batch_id", "input_rows", F.col("watermark").cast("timestamp").cast("timestamp_ntz").alias("watermark"),
        F.col("q").isNotNull().alias("stuck"))


@register("so9_expire_partitions", """
SELECT event_date, count(*) AS events FROM v_events WHERE event_date >= DATE '2024-01-11' GROUP BY event_date""")
def so9(spark, sf):
    """SO9: day partitions more than 20 days older than January 31 go."""
    path = _Run(spark, "so9").path("t")
    layout.write_partitioned(v_events(_t(spark, sf)), path, "event_date", cluster=["tenant_id"])
    sio.expire_partitions(spark, path, "event_date", "2024-01-31", 20)
    return spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


@register("so18_fan_out", """
SELECT c AS consumer, event_type, count(*) AS events, count(DISTINCT event_id) AS ids FROM v_events, (VALUES ('billing'), ('fraud'), ('late')) t(c) GROUP BY 1, 2""")
def so18(spark, sf):
    """SO18: three consumers, one of them subscribed after the others had read
    everything; each sees every message once."""
    e, run = _events(spark, sf).select("event_id", "event_type"), _Run(spark, "so18")
    tag = uuid.uuid4().hex

    def consume(*names):
        sinks = {f"{n}-{tag}": sio.append_deltas(run.path(n)) for n in names}
        for q in sio.fan_out(run.stream(e.schema), sinks, run.path("ck")):
            q.awaitTermination()

    a, b, c = _thirds(e, "event_id")
    run.arrive(a, b)
    consume("billing", "fraud")
    run.arrive(c)
    consume("billing", "fraud", "late")
    out = [spark.read.parquet(run.path(n)).select(F.lit(n).alias("consumer"), "event_type", "event_id") for n in ("billing", "fraud", "late")]
    return out[0].unionByName(out[1]).unionByName(out[2]).groupBy("consumer", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids"))


@register("so1_message_log", """
SELECT CAST(user_id % 4 AS INTEGER) AS "partition", event_type, count(*) AS messages, count(*) AS offsets,
       CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS cents FROM v_events GROUP BY 1, 2""")
def so1(spark, sf):
    """SO1: JSON messages in a partitioned log, read with an admission limit;
    the consumer stops, the log grows, and a second run goes on from the
    offsets of the checkpoint."""
    e, run = v_events(_t(spark, sf)), _Run(spark, "so1")
    fmt = segment_log.register(spark)
    body = F.to_json(F.struct("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"), "amount"))
    m = e.select("ts", F.col("user_id").cast("string").alias("key"), body.alias("value"), "event_id")

    def consume():
        options = {"path": run.path("log"), "limit": str(max(1, n // 8)), "group": "rows"}
        s = sio.read_events(spark, None, "event_id long, event_type string, event_time string, amount double", "event_time", "60 days", fmt, options=options)
        sw.run_caught_up(s, sio.append_deltas(run.path("t")), run.path("ck"))

    n = 0
    for part in (e.event_id % 5 < 3, e.event_id % 5 >= 3):
        n = segment_log.append(m.where(part), run.path("log"), F.col("key").cast("int") % 4, ["ts", "event_id"], F.date_trunc("day", "ts"), 500)
        consume()
    return spark.read.parquet(run.path("t")).groupBy("partition", "event_type").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("offset").alias("offsets"),
        F.sum(F.round(F.col("amount") * 100).cast("bigint")).alias("cents"))


@register("so2_new_objects", """
SELECT event_date, CAST(sum(length(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS bytes, count(*) AS newlines FROM v_events GROUP BY event_date""")
def so2(spark, sf):
    """SO2: an object of lines per day, half of them there when the watcher
    starts, the others before its second run; each counted once."""
    e, run = v_events(_t(spark, sf)).select("event_date", F.col("event_id").cast("string").alias("value")), _Run(spark, "so2")
    for half in (F.dayofmonth("event_date") <= 15, F.dayofmonth("event_date") > 15):
        e.where(half).repartition("event_date").write.mode("append").partitionBy("event_date").text(run.path("objects"))
        run.land(sio.watch_objects(spark, run.path("objects"), "*.txt", 10), sio.count_objects(run.path("t")))
    seen = spark.read.parquet(run.path("t"))
    return seen.select(F.to_date(F.regexp_extract("path", "event_date=([0-9-]+)", 1)).alias("event_date"), "bytes", "newlines")


@register("jo8b_enrichment_as_of", """
WITH r AS (SELECT request_id, ts, request_id % 500 AS k FROM v_requests)
SELECT CASE WHEN c_custkey IS NULL THEN NULL WHEN ts >= TIMESTAMP '2024-01-20' AND k % 7 = 0 THEN 'late' WHEN ts >= TIMESTAMP '2024-01-12' AND k % 5 = 0 THEN 'new'
            ELSE c_mktsegment END AS segment, count(*) AS requests
FROM r LEFT JOIN customer ON c_custkey = k GROUP BY 1""")
def jo8b(spark, sf):
    """JO8: requests take the segment of their time.  Some segments change on
    the 12th; those of the 20th are told after all requests have landed."""
    r = v_requests(_t(spark, sf)).select("request_id", "ts", (F.col("request_id") % 500).alias("c_custkey"))
    run, c = _Run(spark, "jo8b"), _t(spark, sf).customer

    def versions(day, label, keys):
        return c.where(keys).select("c_custkey", F.lit(dt.datetime(2024, 1, day)).cast("timestamp_ntz").alias("valid_from"), label.alias("segment"))

    told = enrich.version_sink(run.path("versions"), "c_custkey", "valid_from", {"segment": "string"}, run.path("t"), "request_id", "ts")
    land = enrich.enrich_sink(run.path("t"), run.path("versions"), "request_id", "c_custkey", "ts", "valid_from", {"segment": "string"})
    first = versions(1, F.col("c_mktsegment"), "true").unionByName(versions(12, F.lit("new"), "c_custkey % 5 = 0"))
    run.arrive(first, name="changes")
    run.land(run.stream(first.schema, "changes"), told, name="told")
    run.arrive(*_thirds(r, "request_id"))
    run.land(run.stream(r.schema), land)
    run.arrive(versions(20, F.lit("late"), "c_custkey % 7 = 0"), name="changes")
    run.land(run.stream(first.schema, "changes"), told, name="told")
    return KeyedTable(spark, run.path("t"), ["request_id"]).read().groupBy("segment").agg(F.count(F.lit(1)).alias("requests"))
