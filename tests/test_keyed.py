"""Keyed tables: SO10, SO12, SO15 and SS20 without rewriting the table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark import commits
from tidemark.keyed import Conflict, KeyedTable
from tidemark.streaming import io as sio

SCHEMA = "k string, d string, n long, v double"


def table(spark, tmp_path, rows=1000, keys=("k",), name="t"):
    return KeyedTable(spark, str(tmp_path / name), list(keys), rows)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(t):
    return sorted(map(str, (tuple(r) for r in t.read().collect())))


def test_null_and_moved_keys_stay_single(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.read() is None and t.version() == 0
    first = frame(spark, [(None, "d1", 1, 1.0), ("a", "d1", 1, 1.0), ("b", "d1", 1, None)])
    moved = frame(spark, [(None, "d2", 2, 9.0), ("a", "d2", 2, 5.0), ("a", "d3", 1, 4.0)])
    for _ in range(3):
        t.upsert(first, "n")
        t.upsert(moved, "n")
    assert state(t) == sorted(map(str, [(None, "d2", 2, 9.0), ("a", "d2", 2, 5.0), ("b", "d1", 1, None)]))


def test_random_batches_against_a_dict(spark, tmp_path):
    rng = random.Random(1)
    t, want = table(spark, tmp_path, rows=20, keys=("k", "d")), {}
    for step in range(6):
        batch = {}
        for _ in range(rng.choice([5, 40, 150])):
            k = (rng.choice([None, "x", f"k{rng.randrange(120)}"]), rng.choice([None, "p", "q"]))
            batch[k] = (*k, step, float(rng.randrange(99)))
        want |= batch
        t.upsert(frame(spark, list(batch.values())), "n")
        assert state(t) == sorted(map(str, want.values()))
    live = t.manifest()
    assert len(live) > 3 and sum(p.rows for p in live) == len(want)
    t.vacuum()
    assert state(t) == sorted(map(str, want.values()))


def test_rewritten_rows_follow_the_batch(spark, tmp_path):
    """Ten changed keys of 20,000 rewrite ten pieces at most, ten new keys
    none of the large ones, whatever the size of the table."""
    t = table(spark, tmp_path, rows=500)
    base = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("d").alias("d"), F.lit(0).cast("long").alias("n"),
                                      F.lit(0.0).alias("v"))
    t.upsert(base)
    pieces = {p.piece for p in t.manifest()}
    assert len(pieces) == 40 and max(p.rows for p in t.manifest()) < 700
    c = t.upsert(frame(spark, [(f"k{i * 1999}", "e", 1, 1.0) for i in range(10)]))
    assert c.applied == 10 and 0 < c.rewritten_pieces <= 10 and c.rewritten_rows < 10 * 700
    assert len(pieces & {p.piece for p in t.manifest()}) >= 30
    c = t.upsert(frame(spark, [(f"new{i}", "e", 1, 1.0) for i in range(10)]))
    assert c.rewritten_rows <= 20  # the ten rows before, folded
    assert t.read().count() == 20_010 and t.read().where("d = 'e'").count() == 20


def test_insert_new_once_ever(spark, tmp_path):
    t = table(spark, tmp_path, rows=100)
    for lo in (0, 50, 0, 400, 50):
        rows = [(f"k{i}", "d", lo, 1.0) for i in range(lo, lo + 100)] + [(None, "d", lo, 0.0)] * 2
        t.insert_new(frame(spark, rows), "n")
    got = t.read().collect()
    assert len(got) == 251 and len({r.k for r in got}) == 251
    assert {r.n for r in got if r.k in (None, "k7")} == {0}
    c = t.insert_new(frame(spark, [("k7", "d", 9, 9.0)]))
    assert (c.applied, c.rewritten_rows) == (0, 0)


def test_merge_columns(spark, tmp_path):
    t = table(spark, tmp_path, rows=50)
    t.upsert(frame(spark, [(f"k{i}", "old", i, None) for i in range(200)] + [(None, "old", -1, None)]))
    up = spark.createDataFrame([("k3", "new", None), (None, "new", 2.0), ("absent", "new", 1.0)], "k string, d string, v double")
    for _ in range(2):
        c = t.merge_columns(up)
    assert c.applied == 2 and c.rewritten_pieces <= 2
    got = {r.k: (r.d, r.n, r.v) for r in t.read().collect()}
    assert len(got) == 201 and got["k3"] == ("new", 3, None) and got[None] == ("new", -1, 2.0) and got["k4"] == ("old", 4, None)


def test_newer_rows_stay(spark, tmp_path):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [("a", "d", 5, 5.0), ("b", "d", 1, 1.0)]), newer_by="n")
    for _ in range(2):
        t.upsert(frame(spark, [("a", "late", 3, 3.0), ("b", "d", 2, 2.0), ("c", "d", 1, 0.0)]), newer_by="n")
    assert {r.k: r.n for r in t.read().collect()} == {"a": 5, "b": 2, "c": 1}


def test_commits_are_all_or_nothing(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.upsert(frame(spark, [("a", "d", 1, 1.0)]))
    before = t.read()
    monkeypatch.setattr(KeyedTable, "_publish", lambda *a: (_ for _ in ()).throw(OSError("writer lost")))
    with pytest.raises(OSError):
        t.upsert(frame(spark, [("a", "d", 2, 2.0), ("b", "d", 2, 2.0)]))
    monkeypatch.undo()
    assert state(t) == [str(("a", "d", 1, 1.0))]
    t.upsert(frame(spark, [("a", "d", 2, 2.0)]))
    assert before.first().n == 1 and t.read().first().n == 2 and t.read(1).first().n == 1
    with pytest.raises(Conflict):
        t._publish(2, "other")
    t.vacuum()
    assert t.read().first().n == 2
    with pytest.raises(ValueError, match="columns"):
        t.upsert(frame(spark, [("a", "d", 1, 1.0)]).drop("v"))


def test_empty_batches(spark, tmp_path):
    t = table(spark, tmp_path)
    t.insert_new(frame(spark, []))
    assert t.read().count() == 0
    t.upsert(frame(spark, [("a", "d", 1, 1.0)]))
    assert t.upsert(frame(spark, [])).applied == 0 and t.read().count() == 1


def test_copies_beyond_the_watermark_land_once(spark, tmp_path):
    """A copy 30 days later, in another run, and a batch that failed after
    its pieces were written."""
    path = str(tmp_path / "landed")
    sink = sio.exactly_once_ever(path, "k")
    a = frame(spark, [(f"k{i}", "2024-01-01", 1, 1.0) for i in range(50)])
    b = frame(spark, [(f"k{i}", "2024-02-01", 2, 2.0) for i in range(25, 75)])
    sink(a, 0)
    real = KeyedTable._publish
    try:
        KeyedTable._publish = lambda *x: (_ for _ in ()).throw(OSError("lost"))
        with pytest.raises(OSError):
            sink(b, 1)
    finally:
        KeyedTable._publish = real
    sink(b, 1)
    sink(b, 0)
    got = KeyedTable(spark, path, ["k"]).read().collect()
    assert len(got) == 75 and {r.n for r in got if r.k == "k30"} == {1}


def test_partitioned_upsert_of_null_and_moved_keys(spark, tmp_path):
    """The plain sink: null keys, and keys that change partition."""
    path = str(tmp_path / "p")
    write = sio.upsert(path, ["k"], "n", "d")
    for _ in range(3):
        write(frame(spark, [(None, "d1", 1, 1.0), ("a", "d1", 1, 1.0), ("b", "d1", 1, 2.0)]), 0)
    write(frame(spark, [(None, "d2", 2, 1.0), ("a", "d2", 2, 5.0)]), 1)
    got = sorted(str((r.k, r.d, r.n)) for r in commits.read(spark, path).collect())
    assert got == sorted(map(str, [(None, "d2", 2), ("a", "d2", 2), ("b", "d1", 1)]))
    write(frame(spark, [("b", "d3", 3, 5.0)]), 2)
    assert sorted(r.d for r in commits.read(spark, path).collect()) == ["d2", "d2", "d3"]
