"""Structured Streaming behaviour: lateness, re-emits, dedup, exactly-once
restart, dead letters, new-object source, event-time timers, stream joins
(SO1, SO2, SO10-SO14, SO18, SS1, SS5-SS12, SS17, SS21, SS22, SS24, JO8,
JO14).  Arrival order is controlled with one file per micro-batch."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.events import parse_events
from tidemark.operators.joins import manifest_check, reconcile
from tidemark.streaming import io as sio
from tidemark.streaming import stateful as st
from tidemark.streaming import windows as sw

ON_TIME = [(10, 100), (45, 50), (70, 200), (130, 75), (200, 300), (260, 40), (290, 60)]
SENTINEL = [(100000, 0)]
LATE = [(15, 25), (95, 15), (135, 35)]


def _write_steps(d, steps, name="step"):
    """One file per arrival step; modification times increase so the file
    source picks them up in step order."""
    os.makedirs(d, exist_ok=True)
    t0 = 1_700_000_000
    for i, rows in enumerate(steps):
        p = os.path.join(d, f"{name}-{i:03d}.json")
        with open(p, "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")
        os.utime(p, (t0 + i * 10, t0 + i * 10))


def _lateness_stream(spark, src):
    s = (spark.readStream.schema("event_time_s long, revenue double").option("maxFilesPerTrigger", 1).json(src)
         .withColumn("ts", F.timestamp_seconds("event_time_s")))
    return s


def _final_total(spark, tmp, delay):
    src = os.path.join(tmp, "src")
    _write_steps(src, [[{"event_time_s": t, "revenue": v} for t, v in step] for step in (ON_TIME, SENTINEL, LATE)])
    agg = sw.windowed_sum(_lateness_stream(spark, src), "ts", "revenue", "60 seconds", lateness=delay)
    target = os.path.join(tmp, "windows")
    sink = sio.upsert(target, ["window"], "total")
    sw.run_available(agg, sink, os.path.join(tmp, "ckpt"), mode="update")
    res = spark.read.parquet(target)
    return res.where(F.col("window.start") < F.lit("1970-01-02").cast("timestamp")).agg(F.sum("total")).first()[0]


def test_allowed_lateness_825_vs_900(spark, tmp_path):
    assert _final_total(spark, str(tmp_path / "a"), "0 seconds") == 825.0
    assert _final_total(spark, str(tmp_path / "b"), "30 hours") == 900.0


def test_discarding_deltas_sum_to_accumulating(spark, tmp_path):
    tmp = str(tmp_path)
    src = os.path.join(tmp, "src")
    _write_steps(src, [[{"event_time_s": t, "revenue": v} for t, v in step] for step in (ON_TIME, SENTINEL, LATE)])
    s = _lateness_stream(spark, src)
    # discarding: each batch's own contribution per window, summed at read
    deltas = os.path.join(tmp, "deltas")

    def per_batch(batch, batch_id):
        b = batch.groupBy(F.window("ts", "60 seconds").alias("window")).agg(F.sum("revenue").alias("total"))
        sio.append_deltas(deltas)(b, batch_id)

    q = (s.writeStream.foreachBatch(per_batch).option("checkpointLocation", os.path.join(tmp, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    tot = sio.read_deltas(spark, deltas, ["window"], "total").agg(F.sum("total")).first()[0]
    assert tot == 900.0


def test_update_mode_reemits_trace(spark, tmp_path):
    # A 12:03:02 100, B 12:03:40 50, sentinel later, C 12:03:47 25 arriving late
    base = int(dt.datetime(2024, 1, 1, 12, 3, 0, tzinfo=dt.timezone.utc).timestamp())
    steps = [[(base + 2, 100)], [(base + 40, 50)], [(base + 240, 0)], [(base + 47, 25)]]
    src = str(tmp_path / "src")
    _write_steps(src, [[{"event_time_s": t, "revenue": v} for t, v in s] for s in steps])
    agg = sw.windowed_sum(_lateness_stream(spark, src), "ts", "revenue", "60 seconds", lateness="10 minutes")
    seen = []

    def sink(batch, batch_id):
        for r in batch.where(F.col("window.start") == F.timestamp_seconds(F.lit(base))).collect():
            seen.append(r.total)

    sw.run_available(agg, sink, str(tmp_path / "ck"))
    # Spark update mode re-emits on every change: early 100, 150, late 175
    # (the unchanged on-time value is not re-emitted; see README "lateness")
    assert seen == [100.0, 150.0, 175.0]


def test_dedup_within_watermark(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_steps(src, [[{"id": "a", "t": 1001}, {"id": "b", "t": 1002}], [{"id": "a", "t": 1003}, {"id": "c", "t": 1004}]])
    s = (spark.readStream.schema("id string, t long").option("maxFilesPerTrigger", 1).json(src)
         .withColumn("ts", F.timestamp_seconds("t")))
    out = []
    sw.run_available(sw.dedup(s, "id", "ts", "1 hour"), lambda b, i: out.extend(r.id for r in b.collect()),
                     str(tmp_path / "ck"), mode="append")
    assert sorted(out) == ["a", "b", "c"]


def test_exactly_once_across_restart(spark, tmp_path):
    src = str(tmp_path / "src")
    ids = [f"e{i}" for i in range(30)]
    _write_steps(src, [[{"event_id": x, "t": 1000 + i} for i, x in enumerate(ids[k:k + 10])] for k in (0, 10, 20)])
    target, ck = str(tmp_path / "landed"), str(tmp_path / "ck")
    sink = sio.exactly_once(target, "event_id")

    def failing(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("worker lost after writing")

    s = lambda: (spark.readStream.schema("event_id string, t long").option("maxFilesPerTrigger", 1).json(src)
                 .withColumn("ts", F.timestamp_seconds("t")))
    with pytest.raises(Exception):
        sw.run_available(sw.dedup(s(), "event_id", "ts", "1 hour"), failing, ck, mode="append")
    sw.run_available(sw.dedup(s(), "event_id", "ts", "1 hour"), sink, ck, mode="append")
    landed = spark.read.parquet(target)
    pub = spark.createDataFrame([(x,) for x in ids], "event_id string")
    r = manifest_check(pub, landed, "event_id").first()
    assert (r.published, r.landed, r.lost, r.unexpected, r.duplicates) == (30, 30, 0, 0, 0)


def test_dead_letters_and_second_output(spark, tmp_path):
    src = str(tmp_path / "src")
    good = {"event_id": "1", "event_type": "click", "tenant": "t1", "amount": 2.5, "event_time": "2024-01-01T00:00:00Z"}
    rows = [json.dumps(good), '{"event_id": "2", "event_ty', json.dumps({**good, "event_id": "3", "amount": "x"})]
    os.makedirs(src)
    with open(os.path.join(src, "m.txt"), "w") as f:
        f.write("\n".join(rows) + "\n")
    raw = spark.readStream.text(src).withColumnRenamed("value", "raw")
    counts = str(tmp_path / "counts")

    def extra(parsed, batch_id):
        (parsed.where(F.col("error").isNull()).groupBy("event_type").count().withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").partitionBy("batch_id").parquet(counts))

    sink = sio.parse_and_route(str(tmp_path / "good"), str(tmp_path / "dead"), parse_events, extra=extra)
    sw.run_available(raw, sink, str(tmp_path / "ck"), mode="append")
    dead = spark.read.parquet(str(tmp_path / "dead")).collect()
    assert sorted(r.reason for r in dead) == ["bad_amount", "corrupt"]
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1
    assert spark.read.parquet(counts).first()["count"] == 1


def test_new_objects_once(spark, tmp_path):
    d = str(tmp_path / "objs")
    os.makedirs(d)
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("a\nb\nc\n")
    seen = []
    ck = str(tmp_path / "ck")
    sink = lambda b, i: seen.extend((os.path.basename(r.path), r.bytes, r.newlines) for r in b.collect())
    sw.run_available(sio.read_new_objects(spark, d), sink, ck, mode="append")
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write("x\n")
    sw.run_available(sio.read_new_objects(spark, d), sink, ck, mode="append")
    assert seen == [("a.txt", 6, 3), ("b.txt", 2, 1)]


def test_late_side_output(spark, tmp_path):
    """The three late events come out; counted and late make 900."""
    src = str(tmp_path / "src")
    _write_steps(src, [[{"event_time_s": t, "revenue": v} for t, v in step] for step in (ON_TIME, SENTINEL, LATE)])
    good, late, clock = (str(tmp_path / x) for x in ("good", "late", "clock"))
    sink = sio.late_side_output(sio.append_deltas(good), late, clock, "ts", lateness_s=0, window_s=60)
    sw.run_available(_lateness_stream(spark, src), sink, str(tmp_path / "ck"), mode="append")
    out = spark.read.parquet(late)
    assert sorted(r.event_time_s for r in out.collect()) == [15, 95, 135]
    counted = spark.read.parquet(good).agg(F.sum("revenue")).first()[0]
    assert counted == 825.0 and counted + out.agg(F.sum("revenue")).first()[0] == 900.0
    # a replayed batch is split as it was the first time
    batch = spark.createDataFrame([(t, float(v)) for t, v in LATE], "event_time_s long, revenue double").withColumn(
        "ts", F.timestamp_seconds("event_time_s"))
    sink(batch, 2)
    assert spark.read.parquet(late).count() == 3


def test_drain_closes_the_last_windows(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_steps(src, [[{"event_time_s": t, "revenue": v} for t, v in ON_TIME]])
    out = []
    sw.drain(lambda s: sw.windowed_sum(s, "ts", "revenue", "60 seconds", lateness="0 seconds"), _lateness_stream(spark, src),
             lambda: _write_steps(src, [[{"event_time_s": 10**9, "revenue": 0}]], name="z-last"),
             lambda b, i: out.extend(b.collect()), str(tmp_path / "ck"))
    assert sum(r.total for r in out) == 825.0


def test_decoded_messages_and_ids(spark):
    msgs = spark.createDataFrame([(bytearray(b'{"id": "a", "at": "2024-01-01T00:00:00Z"}'), 7), (bytearray(b"no json"), 8)],
                                 "value binary, offset long")
    got = sio.decode_messages(msgs, "id string, at string").orderBy("offset").collect()
    assert [(r.id, r.offset) for r in got] == [("a", 7), (None, 8)]


def test_upsert_refuses_other_columns_and_survives_a_crash(spark, tmp_path, monkeypatch):
    from tidemark import commits
    tgt = str(tmp_path / "t")
    for part in (None, "d"):
        path = tgt + str(part)
        sink = sio.upsert(path, ["k"], "v", part)
        sink(spark.createDataFrame([(1, 1, "x"), (2, 1, "y")], "k long, v long, d string"), 0)
        with pytest.raises(Exception):
            sink(spark.createDataFrame([(3, 1, "x", 1)], "k long, v long, d string, extra int"), 1)
        assert spark.read.parquet(path).count() == 2
        # the writer dies after its content is ready, before it is in place
        with monkeypatch.context() as m:
            m.setattr(commits, "recover", lambda spark, path: None)
            sink(spark.createDataFrame([(1, 5, "x")], "k long, v long, d string"), 2)
        sink(spark.createDataFrame([(2, 7, "y")], "k long, v long, d string"), 3)
        assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, 5), (2, 7)]


def test_tail_sampling_keeps_whole_traces_and_its_decision(spark, tmp_path):
    src = str(tmp_path / "src")
    span = lambda tr, i, t, s="OK": {"trace_id": tr, "span_id": i, "t": t, "status": s, "duration_ms": 1.0}
    steps = [[span("a" * 32, i, 1000) for i in range(20_000)] + [span("a" * 32, 20_000, 1001, "ERROR"), span("b" * 32, 1, 1000)],
             [span("c" * 32, 2, 1100)], [span("c" * 32, 3, 1101), span("a" * 32, 30_000, 1101)], [span("c" * 32, 4, 1102)]]
    _write_steps(src, steps)
    s = (spark.readStream.schema("trace_id string, span_id long, t long, status string, duration_ms double")
         .option("maxFilesPerTrigger", 1).json(src)
         .withColumn("start_time", F.timestamp_seconds("t")).withWatermark("start_time", "0 seconds"))
    out = []
    sw.run_available(st.tail_sampling(s, keep_ratio=0.0), lambda b, i: out.extend(b.collect()), str(tmp_path / "ck"), mode="append")
    mine = [r.span_id for r in out if r.trace_id == "a" * 32]
    assert len(mine) == len(set(mine)) == 20_002 and 30_000 in mine
    assert not any(r.trace_id == "b" * 32 for r in out)


def test_tail_sampling_timer(spark, tmp_path):
    src = str(tmp_path / "src")
    spans = [[{"trace_id": 1, "span_id": 1, "t": 1000, "status": "ERROR", "duration_ms": 5.0},
              {"trace_id": 2, "span_id": 2, "t": 1001, "status": "OK", "duration_ms": 5.0},
              {"trace_id": 1, "span_id": 3, "t": 1002, "status": "OK", "duration_ms": 5.0}],
             [{"trace_id": 9, "span_id": 9, "t": 1100, "status": "OK", "duration_ms": 1.0}],
             [{"trace_id": 9, "span_id": 10, "t": 1200, "status": "OK", "duration_ms": 1.0}]]
    _write_steps(src, spans)
    s = (spark.readStream.schema("trace_id long, span_id long, t long, status string, duration_ms double")
         .option("maxFilesPerTrigger", 1).json(src)
         .withColumn("start_time", F.timestamp_seconds("t")).withWatermark("start_time", "0 seconds"))
    out = []
    sw.run_available(st.tail_sampling(s), lambda b, i: out.extend(b.collect()), str(tmp_path / "ck"), mode="append")
    kept = {(r.trace_id, r.span_id, r.reason) for r in out}
    assert (1, 1, "error") in kept and (1, 3, "error") in kept
    assert not any(r.trace_id == 2 for r in out)


def test_progress_recorder_and_stuck_watermark(spark, tmp_path):
    rec = sw.ProgressRecorder()
    spark.streams.addListener(rec)
    try:
        src = str(tmp_path / "src")
        _write_steps(src, [[{"event_time_s": t, "revenue": v} for t, v in ON_TIME]])
        agg = sw.windowed_sum(_lateness_stream(spark, src), "ts", "revenue", "60 seconds", lateness="0 seconds")
        sw.run_available(agg, lambda b, i: b.count(), str(tmp_path / "ck"))
        import time
        time.sleep(1)
    finally:
        spark.streams.removeListener(rec)
    assert rec.rows
    prog = spark.createDataFrame([("q", i, "x", 10, "2024-01-01T00:00:00.000Z") for i in range(5)],
                                 "query_id string, batch_id long, at string, input_rows long, watermark string")
    s = sw.stuck_watermarks(prog, 3).collect()
    assert len(s) == 1 and s[0].batches == 4


def test_stream_static_enrich_and_stream_join(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_steps(src, [[{"k": 1, "t": 10}, {"k": 2, "t": 20}]])
    s = spark.readStream.schema("k long, t long").json(src).withColumn("ts", F.timestamp_seconds("t"))
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k long, name string")
    out = []
    sw.run_available(sw.enrich(s, dim, "k"), lambda b, i: out.extend(b.collect()), str(tmp_path / "ck1"), mode="append")
    assert sorted(r.name for r in out) == ["one", "two"]
    tgt = str(tmp_path / "tgt")
    _write_steps(tgt, [[{"k": 1, "a": 15}, {"k": 2, "a": 500}]])
    t = spark.readStream.schema("k long, a long").json(tgt).withColumn("arrived", F.timestamp_seconds("a")).drop("a")
    src2 = s.withColumnRenamed("ts", "written").drop("t")
    m = []
    sw.run_available(sw.match_arrivals(src2, t, "k", "written", "arrived", "60 seconds", "10 minutes"),
                     lambda b, i: m.extend(b.collect()), str(tmp_path / "ck2"), mode="append")
    assert [(r.k, r.lag_s) for r in m] == [(1, 5.0)]


def test_fan_out_and_routes(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_steps(src, [[{"id": i, "severity": s} for i, s in enumerate(["INFO", "ERROR", "WARNING", "ERROR"])]])
    s = spark.readStream.schema("id long, severity string").json(src)
    from tidemark.operators.slo import severity_filter
    routes = {"errors": (lambda b: severity_filter(b, "ERROR"), str(tmp_path / "err")),
              "archive": (lambda b: b, str(tmp_path / "all"))}
    qs = sio.fan_out(s, {"router": sio.route(routes), "copy": sio.route({"c": (lambda b: b, str(tmp_path / "copy"))})},
                     str(tmp_path / "ck"))
    for q in qs:
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "err")).count() == 2
    assert spark.read.parquet(str(tmp_path / "all")).count() == 4
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 4


def test_stream_batch_reconcile(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_steps(src, [[{"event_time_s": t, "revenue": v} for t, v in step] for step in (ON_TIME, SENTINEL, LATE)])
    agg = sw.windowed_sum(_lateness_stream(spark, src), "ts", "revenue", "60 seconds", lateness="0 seconds")
    target = str(tmp_path / "w")
    sw.run_available(agg, sio.upsert(target, ["window"], "total"), str(tmp_path / "ck"))
    stream = spark.read.parquet(target).select(F.col("window.start").alias("ws"), "total")
    allrows = [(t, float(v)) for step in (ON_TIME, SENTINEL, LATE) for t, v in step]
    b = (spark.createDataFrame(allrows, "t long, revenue double").withColumn("ts", F.timestamp_seconds("t"))
         .groupBy(F.window("ts", "60 seconds").start.alias("ws")).agg(F.sum("revenue").alias("total")))
    r = {x.ws.replace(tzinfo=None): x for x in reconcile(stream, b, ["ws"], "total").collect()}
    alerts = sorted(k for k, v in r.items() if v.alert)
    assert len(alerts) == 3     # the three windows that lost late data diverge by more than 1%


def test_early_on_time_late_firings(spark, tmp_path):
    """The reference's trace: A 100, B 50 early; on-time when the watermark
    passes the window end; C 25 late -> 100, 150, 150, 175."""
    base = int(dt.datetime(2024, 1, 1, 12, 3, 0, tzinfo=dt.timezone.utc).timestamp())
    steps = [[(base + 2, 100)], [(base + 40, 50)], [(base + 240, 0)], [(base + 241, 0)], [(base + 47, 25)]]
    src = str(tmp_path / "src")
    _write_steps(src, [[{"event_time_s": t, "revenue": v} for t, v in s] for s in steps])
    s = _lateness_stream(spark, src).withWatermark("ts", "600 seconds")
    out = []
    q = st.window_firings(s, "ts", "revenue", 60, 600)
    sw.run_available(q, lambda b, i: out.extend(b.collect()), str(tmp_path / "ck"), mode="append")
    trace = [(r.total, r.kind) for r in sorted(out, key=lambda r: r.firing)
             if r.window_start.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 12, 3)]
    assert trace == [(100.0, "early"), (150.0, "early"), (150.0, "on_time"), (175.0, "late")]


def test_read_events_source(spark, tmp_path):
    src = str(tmp_path / "src")
    msgs = [{"event_id": f"e{i}", "event_time": f"2024-01-01T00:0{i}:00Z", "amount": float(i)} for i in range(3)]
    _write_steps(src, [msgs])
    s = sio.read_events(spark, src, "event_id string, event_time string, amount double", "event_time",
                        "5 minutes", max_files_per_trigger=1)
    agg = sw.windowed_sum(s, "event_ts", "amount", "1 minute")
    out = []
    sw.run_available(agg, lambda b, i: out.extend(b.collect()), str(tmp_path / "ck"))
    assert sorted(r.total for r in out) == [0.0, 1.0, 2.0]


def test_cdc_apply_stream_and_cascade(spark, tmp_path):
    from tidemark.operators.events import apply_changes, cascade_deletes
    src = str(tmp_path / "src")
    steps = [[{"id": 1, "version": 1, "op": "I", "payload": 1.0}, {"id": 2, "version": 1, "op": "I", "payload": 2.0}],
             [{"id": 1, "version": 2, "op": "U", "payload": 10.0}, {"id": 2, "version": 2, "op": "D", "payload": 0.0}],
             [{"id": 1, "version": 1, "op": "U", "payload": 99.0}]]     # stale replay: ignored
    _write_steps(src, steps)
    s = spark.readStream.schema("id long, version long, op string, payload double").option("maxFilesPerTrigger", 1).json(src)
    tgt = str(tmp_path / "tgt")
    sw.run_available(s, sio.cdc_apply(tgt, "id", "version"), str(tmp_path / "ck"), mode="append")
    assert [(r.id, r.version, r.payload) for r in sio.read_changes(spark, tgt).collect()] == [(1, 2, 10.0)]
    late = spark.createDataFrame([(2, 1, "U", 7.0)], "id long, version long, op string, payload double")
    sio.cdc_apply(tgt, "id", "version")(late, 9)      # older than the delete: the row stays away
    assert [r.id for r in sio.read_changes(spark, tgt).collect()] == [1]
    allc = spark.createDataFrame([r for st in steps for r in st])
    batch = apply_changes(allc, "id", "version", "op", ["payload"]).collect()
    assert [(r.id, r.payload) for r in batch] == [(1, 10.0)]
    kids = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id long, child string")
    assert [r.child for r in cascade_deletes(kids, "id", allc, "id", "version", "op").collect()] == ["a"]


def test_rule_state_carries_across_micro_batches(spark, tmp_path):
    """A ban decided in one micro-batch holds in the next (state store)."""
    src = str(tmp_path / "src")
    first = [{"ip": "1.2.3.4", "request_id": i, "t": 1000 + i} for i in range(4)]      # 4th exceeds limit 3
    second = [{"ip": "1.2.3.4", "request_id": 10, "t": 1100}, {"ip": "5.6.7.8", "request_id": 11, "t": 1100}]
    _write_steps(src, [first, second])
    s = (spark.readStream.schema("ip string, request_id long, t long").option("maxFilesPerTrigger", 1).json(src)
         .withColumn("ts", F.timestamp_seconds("t")))
    out = []
    q = st.apply_rule(s, ["ip"], st.RateLimit(limit=3, window_s=60, ban_s=600), key_types={"ip": "string"})
    sw.run_available(q, lambda b, i: out.extend(b.collect()), str(tmp_path / "ck"), mode="append")
    d = {r.request_id: (r.decision, r.reason) for r in out}
    assert d[3] == ("deny", "rate_exceeded")
    assert d[10] == ("deny", "banned") and d[11][0] == "allow"


@pytest.mark.parametrize("split", ["1", "7", "64", "10m"])
def test_objects_of_any_split_size(spark, tmp_path, split):
    """Newlines equal a plain count whatever the byte ranges are."""
    src = tmp_path / "objects"
    src.mkdir()
    bodies = {"a.bin": b"one\ntwo\n", "b [x]{1}*.bin": b"no end", "c.bin": b"", "d.bin": b"\n\n\n", "e.bin": b"cr\r\nlf\n\xff\xfe raw\nlast",
              "f.bin": b"x" * 90 + b"\n"}
    for name, body in bodies.items():
        (src / name).write_bytes(body)
    (src / "g.skip").write_bytes(b"\n")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for _ in range(2):
            sw.run_available(sio.watch_objects(spark, str(src), "*.bin", 4), sio.count_objects(out), ck, mode="append")
        (src / "h.bin").write_bytes(b"later\n")
        sw.run_available(sio.watch_objects(spark, str(src), "*.bin", 4), sio.count_objects(out), ck, mode="append")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    bodies["h.bin"] = b"later\n"
    got = sorted((r.path.rsplit("/", 1)[1], r.bytes, r.newlines) for r in spark.read.parquet(out).collect())
    assert got == sorted((n, len(b), b.count(b"\n")) for n, b in bodies.items() if b)
