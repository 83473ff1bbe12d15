"""Invariants between operators: sliding total = 5 x
event total, salted = direct, lag-sessions = session windows, rollup =
base, refresh twice = once, merge rerun = once, generator determinism."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.columns import cents
from tidemark.operators import events as ev
from tidemark.operators import rollup
from tidemark.operators import warehouse as wh
from tidemark.sources.fixtures import v_events
from tidemark.sources.generator import generate_events
from tidemark.sources.tables import Tables
from tidemark.streaming import io as sio

from .conftest import MEDIUM, SMALL


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_sliding_total_is_five_times(spark):
    e = v_events(Tables(spark, MEDIUM))
    tot = e.select(F.sum(cents("amount"))).first()[0]
    s = ev.sliding_sum(e, "ts", cents("amount"), "300 seconds", "60 seconds").agg(F.sum("total")).first()[0]
    assert s == 5 * tot


def test_salted_equals_direct(spark):
    e = v_events(Tables(spark, MEDIUM))
    direct = e.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("n"), (F.sum(cents("amount")) / 100.0).alias("total"))
    assert _sorted(wh.salted_sum(e, "tenant_id", "amount", "event_id", 16)) == _sorted(direct)


def test_lag_sessions_equal_session_windows(spark):
    e = v_events(Tables(spark, SMALL))
    a = (e.groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "2 hours").alias("s"))
         .agg(F.count(F.lit(1)).alias("events"))
         .select("user_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                 F.col("s.end").cast("timestamp_ntz").alias("session_end"), "events"))
    b = ev.sessions_by_gap(e, "user_id", "ts", "event_id", 7200)
    assert _sorted(a) == _sorted(b)


def test_rollup_refresh_equals_full_and_is_idempotent(spark, tmp_path):
    e = v_events(Tables(spark, SMALL))
    path = str(tmp_path / "r")
    rollup.write_rollup(rollup.build_rollup(e), path, dt.datetime(2024, 2, 1))
    days = ["2024-01-05", "2024-01-06"]
    rollup.refresh_rollup(e, path, days, dt.datetime(2024, 2, 2))
    rollup.refresh_rollup(e, path, days, dt.datetime(2024, 2, 3))
    stored = spark.read.parquet(path).select("event_date", "tenant_id", "event_type", "events", "amount", "purchases")
    full = rollup.build_rollup(e).select("event_date", "tenant_id", "event_type", "events", "amount", "purchases")
    assert _sorted(stored) == _sorted(full)
    ans, src = rollup.answer(spark, path, e, ["tenant_id"], "2024-01-03", "2024-01-20")
    assert src == "rollup"
    base = rollup.build_rollup(e.where((F.col("event_date") >= F.lit("2024-01-03").cast("date"))
                                       & (F.col("event_date") < F.lit("2024-01-20").cast("date"))))
    b = base.groupBy("tenant_id").agg(F.sum("events").alias("events"), F.sum("purchases").alias("purchases"))
    assert _sorted(ans.select("tenant_id", "events", "purchases")) == _sorted(b)
    _, src2 = rollup.answer(spark, path, e, ["user_id"])
    assert src2 == "base"


def test_staleness_rule(spark, tmp_path):
    e = v_events(Tables(spark, SMALL))
    path = str(tmp_path / "r")
    rollup.write_rollup(rollup.build_rollup(e.where(F.col("event_date") < F.lit("2024-01-15").cast("date"))),
                        path, dt.datetime(2024, 1, 15))
    fresh, s1 = rollup.answer_fresh(spark, path, e, ["tenant_id"], dt.datetime(2024, 1, 15, 1), dt.timedelta(hours=2),
                                    "2024-01-15")
    assert s1 == "rollup"
    stale, s2 = rollup.answer_fresh(spark, path, e, ["tenant_id"], dt.datetime(2024, 2, 1), dt.timedelta(hours=2),
                                    "2024-01-15")
    assert s2 == "rollup+base"
    whole = rollup.build_rollup(e).groupBy("tenant_id").agg(F.sum("events").alias("events"))
    assert _sorted(stale.select("tenant_id", "events")) == _sorted(whole)


def test_merge_enrichment_rerun_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(i, None, None) for i in range(10)], "id long, label string, tokens long") \
        .write.parquet(path)
    upd = spark.createDataFrame([(i, "x", i * 2) for i in range(0, 10, 3)], "id long, label string, tokens long")
    sio.merge_enrichment(spark, path, upd, "id")
    once = _sorted(spark.read.parquet(path))
    sio.merge_enrichment(spark, path, upd, "id")
    assert _sorted(spark.read.parquet(path)) == once
    assert sum(1 for r in once if r[1] == "x") == 4


def test_replay_through_upsert(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(i)) for i in range(24)],
                          "id long, ts timestamp_ntz, v double").write.parquet(src)
    tgt = str(tmp_path / "tgt")
    sink = sio.upsert(tgt, ["id"], "v")
    sio.replay(spark, src, "ts", "2024-01-01 12:00:00", lambda d: d, sink, 0)
    sio.replay(spark, src, "ts", "2024-01-01 06:00:00", lambda d: d.withColumn("v", F.col("v") * 2), sink, 1)
    out = {r.id: r.v for r in spark.read.parquet(tgt).collect()}
    assert len(out) == 18 and out[12] == 24.0 and out[6] == 12.0


def test_generator_deterministic_with_bad_share(spark):
    m1, man = generate_events(spark, 20000, seed=7)
    m2, _ = generate_events(spark, 20000, seed=7)
    assert _sorted(m1.select("event_id", "raw")) == _sorted(m2.select("event_id", "raw"))
    parsed = ev.parse_events(m1)
    bad = parsed.where(F.col("error").isNotNull()).count()
    assert 0.01 < bad / 20000 < 0.03
    assert man.where("malformed").count() == bad


def test_append_rollup_equals_full(spark, tmp_path):
    e = v_events(Tables(spark, SMALL))
    cut = F.col("event_id") % 3 == 0          # rows arriving later
    path = str(tmp_path / "r")
    rollup.write_rollup(rollup.build_rollup(e.where(~cut)), path, dt.datetime(2024, 2, 1))
    assert rollup.append_rollup(e.where(cut), path, dt.datetime(2024, 2, 2), "late-1")
    assert not rollup.append_rollup(e.where(cut), path, dt.datetime(2024, 2, 2), "late-1")   # a replay counts once
    stored = spark.read.parquet(path).select("event_date", "tenant_id", "event_type", "events", "amount", "purchases")
    full = rollup.build_rollup(e).select("event_date", "tenant_id", "event_type", "events", "amount", "purchases")
    assert _sorted(stored) == _sorted(full)


def test_refresh_empties_a_day_without_events(spark, tmp_path):
    e = v_events(Tables(spark, SMALL))
    path = str(tmp_path / "r")
    rollup.write_rollup(rollup.build_rollup(e), path, dt.datetime(2024, 2, 1))
    gone = F.col("event_date") == F.lit("2024-01-05").cast("date")
    left = e.where(~gone)
    for _ in range(2):
        rollup.refresh_rollup(left, path, ["2024-01-05", "2024-01-06"], dt.datetime(2024, 2, 2))
    cols = ["event_date", "tenant_id", "event_type", "events", "amount", "purchases"]
    assert _sorted(spark.read.parquet(path).select(*cols)) == _sorted(rollup.build_rollup(left).select(*cols))


def test_append_survives_a_crash_between_commit_and_move(spark, tmp_path, monkeypatch):
    from tidemark import commits
    e = v_events(Tables(spark, SMALL))
    cut, path = F.col("event_id") % 3 == 0, str(tmp_path / "r")
    rollup.write_rollup(rollup.build_rollup(e.where(~cut)), path, dt.datetime(2024, 2, 1))
    with monkeypatch.context() as m:
        m.setattr(commits, "recover", lambda spark, path: None)
        rollup.append_rollup(e.where(cut), path, dt.datetime(2024, 2, 2), "b1")
    assert not rollup.append_rollup(e.where(cut), path, dt.datetime(2024, 2, 2), "b1")
    cols = ["event_date", "tenant_id", "event_type", "events", "amount", "purchases"]
    assert _sorted(spark.read.parquet(path).select(*cols)) == _sorted(rollup.build_rollup(e).select(*cols))
