"""Rules cut into pieces give the decisions of the rule run row by row."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import regeneration as rg
from tidemark.operators.sequence import carry_within
from tidemark.streaming import stateful as st

START = dt.datetime(2024, 1, 1)


def log(seed, n, pause, keys=("a", "b", None)):
    """Bursts, pauses on both sides of the limits, equal times."""
    rng, rows, now = random.Random(seed), [], dict.fromkeys(keys, 0.0)
    for i in range(n):
        k = rng.choice(keys)
        now[k] += rng.choice([0, 0, 1, 2, 5, pause - 1, pause, pause + 1] if rng.random() < 0.3 else [0, 1, 3])
        rows.append((k, START + dt.timedelta(seconds=now[k]), i, rng.random() < 0.5))
    return rows


def row_by_row(rule, rows):
    out = []
    for k in {r[0] for r in rows}:
        pdf = pd.DataFrame([r for r in sorted(rows, key=lambda r: (r[1], r[2])) if r[0] == k], columns=["key", "ts", "id", "failed"])
        out += [(k, *o.values()) for o in rule.step(rule.initial(), pdf)[1]]
    return sorted(map(str, out))


def got(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("seed,mode", [(1, "ban"), (2, "throttle")])
def test_rate_limit(spark, seed, mode):
    rows = log(seed, 600, 40)
    rule = st.RateLimit(limit=3, window_s=10, ban_s=40, mode=mode, tie="id")
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id long, failed boolean").repartition(5)
    assert got(rg.rate_limit(df, "key", rule)) == row_by_row(rule, rows)


@pytest.mark.parametrize("seed,cool,win", [(1, 20, 60), (2, 60, 20), (3, 5, 5)])
def test_circuit_breaker(spark, seed, cool, win):
    rows = log(seed, 600, cool)
    rule = st.CircuitBreaker(threshold=3, window_s=win, cooldown_s=cool, tie="id")
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id long, failed boolean").repartition(5)
    want = row_by_row(rule, rows)
    assert got(rg.circuit_breaker(df, "key", rule)) == want
    assert sum("half_open->open" in w for w in want) > 3 and sum("half_open->closed" in w for w in want) > 3


def test_one_key_is_many_pieces(spark):
    rows = [r for r in log(5, 800, 20, keys=("hot",))]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id long, failed boolean")
    rule = st.CircuitBreaker(threshold=3, window_s=60, cooldown_s=20, tie="id")
    d = rg.cut_pieces(df, "key", "ts", "id", lambda gap, prev: (gap >= 20) & (~prev["failed"] | (gap >= 60)), ["failed"])
    sizes = [r["count"] for r in d.groupBy("_piece").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 200
    assert got(rg.circuit_breaker(df, "key", rule)) == row_by_row(rule, rows)


def versions(rows):
    out, state = [], {}
    for k, ts, i, exp, pay in sorted((r for r in rows if r[1]), key=lambda r: (r[1], r[2])):
        v, p = state.get(k, (0, None))
        ok = exp == v
        state[k] = (v + 1, pay) if ok else (v, p)
        out.append((k, i, ok, *state[k]))
    return sorted(map(str, out))


@pytest.mark.parametrize("seed", [1, 2])
def test_versioned_upsert(spark, seed):
    rng, rows, head = random.Random(seed), [], {}
    for i in range(700):
        k = rng.choice(["hot", "hot", "hot", "b", None])
        v = head.get(k, 0)
        exp = rng.choice([v, v, v, v - 1, v + 1, None, -1])
        if exp == v:
            head[k] = v + 1
        rows.append((k, START + dt.timedelta(minutes=i // 2), i, exp, rng.choice([None, float(i)])))
    rows.append(("hot", None, 900, 0, 1.0))
    df = spark.createDataFrame(rows, "id string, ts timestamp_ntz, change_id long, expected_version long, payload double").repartition(4)
    want = versions(rows)
    assert max(head.values()) > 100
    assert got(rg.versioned_upsert(df, "id")) == want
    rule = st.VersionedUpsert()
    assert got(st.apply_rule(df.where("id IS NOT NULL"), ["id"], rule)) == [w for w in want if not w.startswith("(None")]


def test_nulls_in_the_rules(spark):
    """Null times take no part, null outcomes are no failures, null ids stay."""
    rows = [("a", START, None, None), ("a", None, 2, True), ("a", START + dt.timedelta(seconds=1), 3, None)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id long, failed boolean")
    breaker = st.CircuitBreaker(threshold=1, tie="id")
    limit = st.RateLimit(limit=1, tie="id")
    for out in (rg.circuit_breaker(df, "key", breaker), st.apply_rule(df, ["key"], breaker)):
        assert [(r.id, r.state) for r in out.orderBy(F.col("id").asc_nulls_first()).collect()] == [(None, "closed"), (3, "closed")]
    for out in (rg.rate_limit(df, "key", limit), st.apply_rule(df, ["key"], limit)):
        assert [(r.id, r.decision) for r in out.orderBy(F.col("id").asc_nulls_first()).collect()] == [(None, "allow"), (3, "deny")]


def test_carry_within(spark):
    rows = [("k", h, i, v) for h, i, v in [(0, 1, 5), (0, 2, None), (1, 3, None), (3, 4, 7), (3, 5, None), (5, 6, 8)]]
    df = spark.createDataFrame(rows, "k string, h int, i int, v int")
    back = carry_within(df, ["k"], ["i"], F.col("v"), F.col("h"), "c").orderBy("i").collect()
    assert [r.c for r in back] == [None, 5, 5, 5, 7, 7]
    ahead = carry_within(df, ["k"], ["i"], F.col("v"), F.col("h"), "c", following=True).orderBy("i").collect()
    assert [r.c for r in ahead] == [7, 7, 7, 8, 8, None]
