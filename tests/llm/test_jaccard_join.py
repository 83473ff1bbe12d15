"""The join against brute force over exact word tuples."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join as jj

from .conftest import ODD, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t, n):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n, num, den):
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                root[find(a)] = find(b)
    group = {}
    for k, (i, _) in enumerate(sets):
        group.setdefault(find(k), []).append(i)
    return sorted((i, len(s), min(group[find(k)])) for k, (i, s) in enumerate(sets))


def near_copies():
    """Families of copies at all distances around the threshold, one large
    family, a passage that many share, and chains."""
    rng = random.Random(5)
    rows = []

    def add(words):
        rows.append((len(rows) * 3 + 1, " ".join(words)))
    for size in (5, 8, 20, 60, 300, 900):
        for _ in range(6):
            base = prose(rng, size)
            add(base)
            for edits in (0, 1, 1, 2, 3, 5, 8):
                w = list(base)
                for _ in range(min(edits * max(1, size // 60), size)):
                    w[rng.randrange(size)] = "zz" + str(rng.randrange(10**6))
                add(w)
    base = prose(rng, 70)
    for _ in range(120):  # a large family, many pairs just under and over
        w = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3))):
            w[rng.randrange(70)] = "yy" + str(rng.randrange(10**6))
        add(w)
    passage = prose(rng, 30)
    for _ in range(80):
        add(passage + prose(rng, 25))
    walk = prose(rng, 100)
    for _ in range(25):  # a chain whose ends are far apart
        walk = [*walk[2:], *prose(rng, 2)]
        add(walk)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,num,block,many", [(4, 85, 256, 2048), (5, 80, 16, 12)])
def test_equals_brute_force(spark, monkeypatch, n, num, block, many):
    monkeypatch.setattr(jj, "BLOCK", block)
    monkeypatch.setattr(jj, "MANY", many)
    monkeypatch.setattr(jj, "PER_TASK", 7)
    rows = near_copies()
    got = jj.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), n, num, 100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(rows, n, num, 100)


def test_slices_never_lose_a_linked_pair():
    import numpy as np
    rng = np.random.default_rng(3)
    space = jj.Space(4, 85, 100)
    for size in [*range(6, 40), 77, 150, 400, 2000]:
        for _ in range(12):
            u = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            apart = int(rng.integers(1, max(2, int(0.1621 * len(u)) + 1)))
            drop = int(rng.integers(0, apart + 1))
            v = np.unique(np.concatenate([u[rng.permutation(len(u))[drop:]], rng.integers(0, 2**64, apart - drop, dtype=np.uint64)]))
            inter = len(np.intersect1d(u, v))
            if space.linked(inter, len(u), len(v)) and inter < len(np.union1d(u, v)):
                for seed in (0, 1):
                    assert np.intersect1d(space.regions(u, seed), space.regions(v, seed)).size


def test_odd_rows(docs_of):
    got = jj.link_documents(docs_of(ODD).withColumn("cls", F.lit(1)).withColumn("key", F.lit("k")), 4, 85, 100)
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str)
    assert rows == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 1, None), (4, 1, 4), (5, 1, 5), (5, 1, 5), (6, 1, 6)], key=str)


def nameless_families():
    """Twelve bases without a doc_id, each with two edited texts that are
    linked, and texts that only rows without a doc_id have."""
    rng, rows = random.Random(21), []
    for k in range(12):
        base = prose(rng, 120)
        x, y = list(base), list(base)
        x[30], y[90] = f"xx{k}", f"yy{k}"
        rows += [(None, " ".join(base)), (None, " ".join(base)), (10 * k + 5, " ".join(x)), (10 * k + 2, " ".join(y))]
        lone = prose(rng, 60)
        rows += [(None, " ".join(lone)), (None, " ".join([*lone, "more"])), (None, " ".join(lone))]
    return rows


def test_texts_without_an_id_keep_their_links(docs_of):
    rows = nameless_families()
    d = docs_of([(i, t, None, None) for i, t in rows])
    got = sorted((r.component_id, r.doc_id) for r in jj.link_documents(d, 4, 85, 100).collect() if r.doc_id is not None)
    assert got == sorted((10 * k + 2, 10 * k + j) for k in range(12) for j in (2, 5))
    kept = jj.keep_one(d.withColumn("key", F.lit("k")), 4, 85, 100)
    assert kept.columns == [*d.columns, "key"]
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(i for i, _ in left if i is not None) == [10 * k + 2 for k in range(12)]
    assert len({t for i, t in left if i is None}) == len([t for i, t in left if i is None]) == 12


def test_empty_table(docs_of):
    assert jj.link_documents(docs_of([])).count() == 0
    assert jj.keep_one(docs_of([])).count() == 0


def test_keep_one_keeps_the_smallest_id_and_all_columns(docs_of):
    text = " ".join(prose(random.Random(1), 80))
    d = docs_of([(9, text, "en", "a"), (3, text + " tail", "en", "b"), (4, "other words in this one", "en", None), (1, None, None, None)])
    got = jj.keep_one(d.withColumn("component_id", F.lit(7)))
    assert got.columns == [*d.columns, "component_id"]
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 4]


def test_a_pivot_shared_by_many_is_dealt_over_tasks(spark):
    from tidemark.llm.common import Scratch
    base = prose(random.Random(2), 50)
    rows = [(i, " ".join([*base[:49], f"w{i}"])) for i in range(jj.PER_TASK * 2)]
    s = Scratch(spark, "test")
    import pyarrow as pa
    space = jj.Space(4, 85, 100)
    from tidemark.llm import textops as tx
    sets = list(tx.shingle_sets(pa.array([t for _, t in rows]), 4))
    cls = [jj.class_hash(u) for u in sets]
    texts = spark.createDataFrame([(c, t) for c, (_, t) in zip(cls, rows)], "cls bigint, text string").mapInArrow(
        jj._pack, "cls bigint, text binary")
    pairs = spark.createDataFrame([(c, cls[0]) for c in cls[1:]], "cls bigint, pivot bigint")
    d = jj._compare(space, pairs, texts, s, "d").collect()
    assert len(d) == len(rows) - 1 and all(r.link and r.inter == 46 for r in d)


def test_linked_sets_share_as_many_regions_as_they_need():
    import numpy as np
    rng = np.random.default_rng(8)
    space = jj.Space(5, 80, 100)
    for size in [*range(4, 40), 90, 300, 1500]:
        for _ in range(12):
            u = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            apart = int(rng.integers(1, max(2, int(0.2223 * len(u)) + 1)))
            drop = int(rng.integers(0, apart + 1))
            v = np.unique(np.concatenate([u[rng.permutation(len(u))[drop:]], rng.integers(0, 2**64, apart - drop, dtype=np.uint64)]))
            inter = len(np.intersect1d(u, v))
            if not space.linked(inter, len(u), len(v)) or inter == len(np.union1d(u, v)):
                continue
            met = np.intersect1d(space.regions(u), space.regions(v)) & np.uint64(jj.CELL_BITS)
            j = min(space.cells(len(u))[0], space.cells(len(v))[0])
            for need in ({x % 64: x // 64 for x in space.needs(w)} for w in (u, v)):
                assert need[j] <= int((met == j).sum())


def test_a_common_passage_moves_no_text(spark, monkeypatch):
    rng = random.Random(4)
    passage = prose(rng, 40)
    texts = [" ".join(prose(rng, 120) + passage + prose(rng, 120)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, texts[0] + " tail")]
    moved, join = [], jj._compare
    monkeypatch.setattr(jj, "_compare", lambda space, pairs, texts, s, name: moved.append(texts.count()) or join(space, pairs, texts, s, name))
    got = jj.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85, 100)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [*((i, i) for i in range(60)), (100, 0)]
    assert moved and max(moved) == 2


def test_a_written_table_leaves_no_shuffle_files(spark):
    from tidemark.llm.common import CLEANUP, Scratch
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in found.split("\n") if "shuffle_" in f}
    before, was = files(), spark.conf.get(CLEANUP)
    rows = spark.range(20000).withColumn("k", F.xxhash64("id")).repartition(5, "k")
    got = Scratch(spark, "test").write(rows, "rows")
    assert not files() - before
    assert got.count() == 20000 and spark.conf.get(CLEANUP) == was
