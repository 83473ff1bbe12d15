from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import source_mix as sm

from .conftest import ODD, prose


def water_fill(sizes, factor=1.5, most=2.0):
    """Targets by the rule as told: share, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, open_ = factor * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    names = ["b", "a", None, "Z", "é", "\U0001F600", "￮", "aa"]
    share = [130, 5, 20, 60, 1, 90, 40, 54]
    rows = [(i, " ".join(prose(rng, rng.randint(0, 60))), None, rng.choices(names, share)[0]) for i in range(n)]
    return rows


def test_targets_and_budgets(docs_of):
    rows = corpus()
    got = sm.mix(docs_of(rows)).collect()
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    want = water_fill(size)
    taken = {}
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.epochs * r.size + r.part
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.5
    assert len(got) == len(rows)


def test_complete_epochs_come_before_the_fraction(docs_of):
    for r in sm.mix(docs_of(corpus())).collect():
        if r.source_size:
            assert r.epochs == int(r.target / r.source_size)


def test_partial_documents_are_few_and_reruns_agree(docs_of):
    d = docs_of(corpus())
    a = sorted(map(str, sm.mix(d).collect()))
    assert a == sorted(map(str, sm.mix(d.repartition(7)).collect()))
    assert a != sorted(map(str, sm.mix(d, seed=8).collect()))
    cut = [r for r in sm.mix(d).collect() if 0 < r.part < r.size]
    assert len(cut) == len({r.source for r in cut})  # one boundary document a source


def test_slots_do_not_change_the_result(docs_of, monkeypatch):
    d = docs_of(corpus())
    a = sorted(map(str, sm.mix(d).collect()))
    monkeypatch.setattr(sm, "slots_for", lambda n: 37)
    assert a == sorted(map(str, sm.mix(d).collect()))


def test_better_documents_are_drawn_more_often(docs_of):
    good = [(i, "plain letters only here " * 3, None, "a") for i in range(400)]
    bad = [(i + 400, "1234 56 78 90123 #### 12 " * 2, None, "a") for i in range(400)]
    other = [(i + 800, "more words of another source " * 40, None, "b") for i in range(100)]
    got = [r for r in sm.mix(docs_of(good + bad + other), factor=0.5, weights=(1, 3)).collect() if r.source == "a"]
    share = lambda lo: sum(r.part > 0 for r in got if lo <= r.doc_id < lo + 400) / 400
    assert share(0) > share(400) + 0.2


def test_prefix_of_an_exponential_race(spark):
    """u^(1/w) in descending order is the order of -ln(u)/w ascending."""
    import math
    rng = random.Random(2)
    pairs = [(rng.random(), rng.uniform(0.05, 1)) for _ in range(200)]
    assert sorted(pairs, key=lambda p: -p[0] ** (1 / p[1])) == sorted(pairs, key=lambda p: -math.log(p[0]) / p[1])


def test_odd_rows(docs_of):
    d = docs_of(ODD).withColumn("target", F.lit("x")).withColumn("key", F.lit(1))
    got = sm.mix(d).collect()
    assert len(got) == len(ODD) and all(r.taken == 0 for r in got if r.size == 0)
    assert sum(r.size for r in got) == 10
    assert sm.mix(docs_of([])).count() == 0 and sm.apply_mix(docs_of([])).count() == 0
    only_empty = docs_of([(1, None, None, None), (2, "", None, "a")])
    assert [r.taken for r in sm.mix(only_empty).collect()] == [0, 0]


def test_applied_mix_repeats_documents_by_epoch(docs_of):
    rows = corpus(3, 200)
    d = docs_of(rows).withColumn("taken", F.lit(-1))
    plan = {r.doc_id: r for r in sm.mix(d.withColumn("doc_id", F.xxhash64("doc_id", "text", "source"))).collect()}
    out = sm.apply_mix(d)
    assert out.columns == d.columns
    names = {r.doc_id: r.h for r in d.select("doc_id", F.xxhash64("doc_id", "text", "source").alias("h")).collect()}
    count = {}
    for r in out.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    for i, h in names.items():
        p = plan[h]
        assert count.get(i, 0) == (p.epochs + (p.part > 0) if p.size else 0)
