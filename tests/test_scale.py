"""What the queries do with empty tasks, sessions of other settings and tables
whose size on disk hides their size in memory."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.keyed import KeyedTable
from tidemark.operators import events as ev
from tidemark.operators import joins as jn
from tidemark.operators.sequence import rank_values
from tidemark.session import CORE_CONF, tune
from tidemark.sources import segment_log as sl
from tidemark.streaming import io as sio
from tidemark.streaming import windows as sw
from tidemark.suite.streams import _Run, _thirds

STORE = "spark.sql.streaming.stateStore.providerClass"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tune_sets_the_state_store(spark):
    """firings keep several states a window, which Spark's
    default state store refuses."""
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    tune(spark)
    assert spark.conf.get(STORE) == CORE_CONF[STORE]


def test_combiner_with_empty_tasks_and_nulls(spark):
    """a task without rows, a null value, and a window of nulls alone."""
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    rows = [(at(1, 2), 1.5), (at(1, 3), None), (at(3, 2), 2.25), (at(5, 0), None)]
    d = spark.createDataFrame(rows, "ts timestamp_ntz, amount double").repartition(9)
    got = {r.window_start.hour: r.total_cents for r in ev.custom_combine(d, "ts", "amount", "1 hour").collect()}
    assert got == {1: 150, 3: 225, 5: None}
    assert ev.custom_combine(d.where("amount > 9"), "ts", "amount", "1 hour").collect() == []


def test_lost_ids_meet_by_shuffle(spark):
    """neither copy's ids are gathered in the driver."""
    a, b = (spark.createDataFrame([(k,) for k in ks], "id bigint") for ks in ([1, 1, 2, 3, None], [2, None]))
    d = jn.lost_ids(a, b, "id")
    assert "BroadcastExchange" not in _plan(d)
    assert sorted(r.id or 0 for r in d.collect()) == [0, 1, 3]


def test_arrivals_meet_by_shuffle(spark):
    """as above, for the copies of the shadow comparison."""
    s = spark.createDataFrame([(k, dt.datetime(2024, 1, 1)) for k in (1, 2, 3)], "id bigint, w timestamp_ntz")
    t = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 9)), (2, dt.datetime(2024, 1, 2))], "id bigint, a timestamp_ntz")
    d = jn.convergence(s, t, "id", "w", "a", 60)
    assert "BroadcastExchange" not in _plan(d)
    assert {r.id: r.lag_s for r in d.collect()} == {1: 9.0, 2: None, 3: None}


def test_ranks_are_the_broadcast_side(spark):
    """of rows and wanted ranks, the ranks are sent."""
    d = spark.range(1000).select((F.col("id") % 100).alias("v"))
    p = rank_values(d, [], "v", {"p50": F.ceil(F.col("n") * 0.5)})
    assert "strategy=broadcast" in p._jdf.queryExecution().optimizedPlan().toString()
    assert p.first().p50 == 49


def test_a_slice_is_a_batch(spark):
    """F8-F11, F13-F16: the micro-batches do not grow with the files."""
    run, seen = _Run(spark, "slices"), []
    d = spark.range(0, 90, 1, 6)
    run.arrive(*_thirds(d, "id"))
    run.land(run.stream(d.schema), lambda b, i: seen.append(sorted(r.id for r in b.collect())))
    assert seen == [[k for k in range(90) if k % 3 == i] for i in range(3)]


def test_keyed_table_sends_no_keys(spark, tmp_path):
    """F8-F10: keys of a batch and of the table meet by shuffle."""
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    t.upsert(spark.range(50).select(F.col("id").alias("k")))
    for how in ("left_semi", "left_anti"):
        assert "BroadcastExchange" not in _plan(t._same(t.read(), spark.range(9).select(F.col("id").alias("k")), how))


def test_short_segments_share_tasks(spark, tmp_path):
    """a task reads about ``ROWS_PER_TASK`` messages, whole and once."""
    pieces = [sl.Piece(0, f"f{i}", i * 500, i * 500 + 500) for i in range(1000)]
    packs = sl.packed(pieces)
    assert len(packs) == 5 and [p for x in packs for p in x.pieces] == pieces
    m = spark.range(300).select(F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"), F.col("id").cast("string").alias("key"),
                                F.lit(b"x").alias("value"), "id")
    sl.append(m, str(tmp_path / "log"), F.col("id") % 2, ["ts", "id"], F.date_trunc("minute", "ts"), 10)
    log = spark.read.format(sl.register(spark)).option("path", str(tmp_path / "log")).load()
    assert log.rdd.getNumPartitions() == 1 and sorted(int(r.key) for r in log.collect()) == list(range(300))


def test_large_dimension_is_shuffled(spark, tmp_path):
    """a dimension beyond ``broadcast_rows`` is not sent each batch."""
    run = _Run(spark, "dim")
    d = spark.range(30).select((F.col("id") % 7).alias("k"))
    run.arrive(d)
    dim = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined, hints = [], []
    for rows in (5, 4):
        j = sw.enrich(run.stream(d.schema), dim, "k", rows)
        hints.append("strategy=merge" in j._jdf.queryExecution().analyzed().toString())
        run.land(j, sio.append_deltas(run.path(f"t{rows}")), name=f"ck{rows}")
        joined.append(sorted((r.k, r.v if r.v is not None else -1) for r in spark.read.parquet(run.path(f"t{rows}")).collect()))
    assert hints == [False, True] and joined[0] == joined[1] and len(joined[0]) == 30
