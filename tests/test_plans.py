"""Plan-level checks: partition pruning, pushdown, column pruning, scan-byte
estimates and guards (SO5, PF1-PF4, PF6, PF7, JO5, SL4, AG35), plus the
plan shapes the scale design relies on."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import layout
from tidemark.operators.warehouse import top_k_per_group
from tidemark.plans import guards as g
from tidemark.sources.fixtures import v_events, v_trips
from tidemark.sources.tables import Tables

from .conftest import MEDIUM


@pytest.fixture(scope="module")
def events_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "events")
    layout.write_partitioned(v_events(Tables(spark, MEDIUM)), path, "event_date", cluster=["tenant_id", "event_type"])
    return path


def test_partition_filter_from_ts_range(spark, events_table):
    t = spark.read.parquet(events_table)
    pruned = layout.day_range(t, "ts", "event_date", "2024-01-10", "2024-01-11")
    assert any("event_date" in pf for pf in g.partition_filters(pruned))
    g.require_partition_filter(pruned, ["event_date"])
    with pytest.raises(g.GuardError):
        g.require_partition_filter(t.where(F.col("amount") > 1), ["event_date"])


def test_one_day_scan_under_five_percent(spark, events_table):
    t = spark.read.parquet(events_table)
    full = g.total_scan_bytes(t)
    one_day = layout.day_range(t, "ts", "event_date", "2024-01-10", "2024-01-11").select("tenant_id", "amount")
    part = g.total_scan_bytes(one_day, ["tenant_id", "amount"])
    assert 0 < part < 0.05 * full


def test_scan_bytes_per_column_and_limit(spark, events_table):
    t = spark.read.parquet(events_table).select("tenant_id", "amount")
    est = {r.column_name: r.bytes for r in g.estimate_scan_bytes(t, ["tenant_id", "amount"]).collect()}
    assert set(est) == {"tenant_id", "amount"} and all(v > 0 for v in est.values())
    assert g.limit_does_not_cut_scan(t.orderBy("amount"), 10)
    with pytest.raises(g.GuardError):
        g.max_bytes_guard(t, 10, ["tenant_id", "amount"])
    g.max_bytes_guard(t, 10 ** 12, ["tenant_id", "amount"])


def test_pushdown_and_column_pruning(spark):
    trips = v_trips(Tables(spark, MEDIUM))
    q = trips.where(F.col("pickup_datetime") >= F.lit(dt.datetime(1997, 1, 1))).select("trip_id", "fare_amount")
    assert g.has_pushed_filters(q)
    li = [s for s in g.read_schema(q) if "l_orderkey" in s][0]
    assert "l_returnflag" not in li and "l_shipdate" in li


def test_cartesian_guard(spark):
    a = spark.range(5)
    b = spark.range(5).withColumnRenamed("id", "x")
    with pytest.raises(g.GuardError):
        g.forbid_cartesian(a.crossJoin(b))
    with pytest.raises(g.GuardError):
        g.join_on(a, b, None)
    g.join_on(a, b.withColumnRenamed("x", "id"), "id")


def test_top_k_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    plan = g.physical_plan(top_k_per_group(df, ["g"], [F.desc("v")], 3))
    assert "WindowGroupLimit" in plan


def test_column_metadata(spark, events_table):
    t = spark.read.parquet(events_table)
    m = {r.column_name: r for r in layout.column_metadata(spark, t, ["event_date"], ["tenant_id", "event_type"]).collect()}
    assert m["event_date"].is_partitioning_column
    assert m["tenant_id"].clustering_ordinal_position == 1 and m["event_type"].clustering_ordinal_position == 2


def test_expire_partitions(spark, tmp_path):
    from tidemark.streaming.io import expire_partitions
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in range(1, 11)], "event_date date, v int")
    layout.write_partitioned(df, path, "event_date")
    gone = expire_partitions(spark, path, "event_date", "2024-01-10", 3)
    assert gone == [f"2024-01-0{d}" for d in range(1, 7)]
    assert spark.read.parquet(path).count() == 4


def test_partition_storage_matches_counts(spark, events_table):
    t = spark.read.parquet(events_table)
    st = {r.partition_id: r for r in g.partition_storage(t, "event_date").collect()}
    counts = {str(r.event_date): r["count"] for r in t.groupBy("event_date").count().collect()}
    assert {k: v.total_rows for k, v in st.items()} == counts
    assert all(v.total_bytes > 0 and v.files >= 1 for v in st.values())


def test_read_date_shards(spark, tmp_path):
    root = str(tmp_path / "logs")
    for d in range(1, 6):
        spark.createDataFrame([(d, "ERROR")] * d, "v int, severity string").write.parquet(f"{root}/app_logs_2024010{d}")
    got = layout.read_shards(spark, root, "app_logs_", "2024-01-02", "2024-01-04")
    rows = {str(r.shard_date): r["count"] for r in got.groupBy("shard_date").count().collect()}
    assert rows == {"2024-01-02": 2, "2024-01-03": 3, "2024-01-04": 4}


def test_no_join_carries_a_broadcast_hint(spark):
    """Broadcasts are left to the engine's size threshold."""
    from tidemark.sources.fixtures import v_fx_rates, v_trips
    t = Tables(spark, MEDIUM)
    for df in (v_trips(t), v_fx_rates(t)):
        assert "strategy=broadcast" not in df._jdf.queryExecution().analyzed().toString()


def test_scan_guards_read_plans_not_data(spark, events_table):
    t = spark.read.parquet(events_table)
    # an aggregate is priced by the columns its scan reads, filters included
    with pytest.raises(g.GuardError):
        g.max_bytes_guard(t.groupBy("tenant_id").count(), 0)
    q = t.where((F.col("event_date") == F.lit("2024-01-05").cast("date")) & (F.col("amount") > 1)).select("tenant_id")
    est = {r.column_name: r for r in g.estimate_scan_bytes(q).collect()}
    assert set(est) == {"tenant_id", "amount"} and all(r.bytes > 0 for r in est.values())
    day = [f for f in t.inputFiles() if "event_date=2024-01-05" in f]
    assert {r.files for r in est.values()} == {len(day)}


def test_partition_filter_must_bound_the_scan(spark, events_table):
    t = spark.read.parquet(events_table)
    plain = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(g.GuardError):
        g.require_partition_filter(t.where(F.col("event_date").isNotNull()), ["event_date"])
    one = t.where(F.col("event_date") == F.lit("2024-01-05").cast("date"))
    g.require_partition_filter(one.join(plain, F.col("event_id") == F.col("k")), ["event_date"])
    with pytest.raises(g.GuardError):
        g.require_partition_filter(one.select("event_id").unionByName(t.select("event_id")), ["event_date"])


def test_shared_folder_is_asked_for_off_the_local_master(spark, monkeypatch):
    from tidemark import session

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_cluster_tuning(spark):
    from tidemark.session import CLUSTER_CONF, tune
    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        tune(spark, cluster=True)
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "8192"
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_join_is_split_by_aqe(spark):
    """One key holds a third of the rows: with the session settings, AQE
    splits the skewed sort-merge-join partition (broadcast disabled here to
    force the shuffle join)."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        n = 30000
        facts = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("v"))
        dim = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        j = facts.join(dim, "k")
        assert j.count() == n
        plan = j._jdf.queryExecution().executedPlan().toString()
        j._jdf.queryExecution().toRdd().count()
        final = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "skew=true" in final
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_aggregates_combine_before_the_shuffle(spark):
    """Grouped measures are partial-aggregated map-side (a hot key costs one
    row per map task in the exchange)."""
    from tidemark.operators.warehouse import daily_rollup
    e = v_events(Tables(spark, MEDIUM))
    plan = g.physical_plan(daily_rollup(e, "event_date", ["tenant_id", "event_type"], "amount", "event_type"))
    ex = plan.index("Exchange hashpartitioning")
    assert "partial_count" in plan[ex:] and "partial_sum" in plan[ex:]
