from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import winnow_prints as wp

from .conftest import ODD, prose


def gram(text, k):
    """The documented hash of one k-gram, digit by digit."""
    m = (1 << 64) - 1
    x = sum((ord(c) + 1) * pow(int(wp._ROLL), i, 1 << 64) for i, c in enumerate(text[:k])) & m
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m
    return (x ^ (x >> 31)) >> 24


def brute(text, k, w):
    if not text:
        return []
    if len(text) < k:
        return [(0, gram(text, len(text)))]
    h = [gram(text[i:], k) for i in range(len(text) - k + 1)]
    out = set()
    for lo in range(max(1, len(h) - w + 1)):
        win = range(lo, min(lo + w, len(h)))
        out.add(max((i for i in win if h[i] == min(h[j] for j in win))))
    return sorted((i, h[i]) for i in out)


def pairs(p):
    return list(zip(p[1].tolist(), p[0].tolist()))


def samples(seed):
    rng = random.Random(seed)
    out = ["", "a", "ab" * 40, "x" * 300, "é\U0001F600" * 50]
    out += [" ".join(prose(rng, rng.randint(1, 60))) for _ in range(40)]
    out += ["".join(rng.choice("ab") for _ in range(rng.randint(1, 90))) for _ in range(40)]
    return out


@pytest.mark.parametrize("k,w", [(24, 32), (3, 4), (5, 7), (2, 1)])
def test_against_every_window(k, w):
    texts = samples(1)
    for t, p in zip(texts, wp.winnow_all(texts, k, w)):
        assert pairs(p) == brute(t, k, w) == pairs(wp.winnow(t, k, w)), t


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc") for _ in range(n)) for n in (99, 100, 101, 480, 731)] + ["z" * 500]
    whole = [pairs(p) for p in wp.winnow_all(texts, 4, 6)]
    monkeypatch.setattr(wp, "CHUNK", 50)
    assert [pairs(p) for p in wp.winnow_all(texts, 4, 6)] == whole == [brute(t, 4, 6) for t in texts]


def test_match_guarantee():
    """A shared passage of k + w - 1 code points is found, at its place."""
    rng = random.Random(3)
    for _ in range(60):
        passage = "".join(rng.choice("abcdefgh ") for _ in range(wp.K + wp.W - 1))
        a, b = (" ".join(prose(rng, rng.randint(0, 40))) for _ in range(2))
        at, bt = rng.randint(0, len(a)), rng.randint(0, len(b))
        x = wp.winnow(a[:at] + passage + a[at:])
        y = wp.winnow(b[:bt] + passage + b[bt:])
        inside = {(h, p - at) for h, p in zip(x[0].tolist(), x[1].tolist())}
        assert inside & {(h, p - bt) for h, p in zip(y[0].tolist(), y[1].tolist())}


def expect(rows, k=wp.K, w=wp.W):
    out = []
    for i, (doc, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        m = len(text) // 4
        new = text[:len(text) - m] + nxt[:m]
        a, b, c = (brute(t, k, w) for t in (text, new, nxt))

        def like(x, y):
            x, y = {h for _, h in x}, {h for _, h in y}
            return len(x & y) / len(x | y) if x | y else 1.0

        show = lambda p: ",".join(f"{q}:{h:010x}" for q, h in p)
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), show(a), show(b), like(a, b), like(a, c)))
    return sorted(map(str, out))


def got(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("per_slot", [2000, 7, 1])
def test_compare_with_next(docs_of, monkeypatch, per_slot):
    monkeypatch.setattr(wp, "PER_SLOT", per_slot)
    rng = random.Random(4)
    ids = rng.sample(range(10_000), 60)
    rows = [(i, " ".join(prose(rng, rng.choice([0, 1, 5, 40, 90])))) for i in ids]
    d = docs_of([(i, t, None, None) for i, t in rows]).repartition(5)
    assert got(wp.compare_with_next(d)) == expect(sorted(rows))


def test_hot_ids_are_cut_by_hash(docs_of, spark, monkeypatch):
    """A null id, and one id of a third of the rows, in many slots."""
    monkeypatch.setattr(wp, "PER_SLOT", 4)
    rng = random.Random(6)
    rows = [(i if i % 3 == 0 else None if i % 3 == 1 else 50, " ".join(prose(rng, 12))) for i in range(90)]
    d = docs_of([(i, t, None, None) for i, t in rows])
    h = {r.text: r.h for r in d.select("text", F.xxhash64("text").alias("h")).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, h[r[1]]))
    assert got(wp.compare_with_next(d)) == expect(ordered)
    order = wp._order(d.select(F.col("doc_id").alias("id")))
    assert len({order.slot(i, h[t]) for i, t in rows if i is None}) > 4
    assert len({order.slot(i, h[t]) for i, t in rows if i == 50}) > 4


def test_odd_rows(docs_of):
    same = [(9, "one text " * 30), (10, "one text " * 30), (10, "one text " * 30)]
    rows = [(i, t or "") for i, t, _, _ in ODD] + same
    d = docs_of([(i, t, None, None) for i, t in rows if t is not None]).withColumn("id", F.lit("x")).withColumn("slot", F.lit(0))
    out = wp.compare_with_next(d).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[9][0].fingerprint == by[10][0].fingerprint != "" and by[9][0].near_next == 1.0
    assert by[1][0].fingerprint == "" and by[1][0].near_edited == 1.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert wp.compare_with_next(docs_of([])).count() == 0
    one = wp.compare_with_next(docs_of([(1, "abcd" * 30, None, None)])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    nulls = wp.compare_with_next(docs_of([(1, None, None, None), (2, None, None, None)])).collect()
    assert [(r.n_chars, r.fingerprint, r.near_next) for r in nulls] == [(0, "", 1.0)] * 2


def test_prints_and_shared_passages(docs_of):
    rng = random.Random(8)
    passage = " ".join(prose(rng, 20))
    rows = [(i, " ".join(prose(rng, 30)) + (" " + passage + " " if i % 3 == 0 else "") + " ".join(prose(rng, 9))) for i in range(30)]
    d = docs_of([(i, t, None, None) for i, t in rows] + [(None, passage, None, None)]).withColumn("prints", F.lit(1))
    p = wp.fingerprints(d, keep=("doc_id", "prints"))
    assert {r.doc_id: [(x.pos, x.hash) for x in r.prints] for r in p.collect() if r.doc_id is not None} == {
        i: brute(t, wp.K, wp.W) for i, t in rows}
    hits = wp.shared_passages(p).collect()
    text = dict(rows)
    assert {r.doc_id for r in hits} == {i for i, _ in rows if i % 3 == 0 and i} == {r.doc_id for r in hits if r.first_id == 0}
    for r in hits:
        assert text[r.doc_id][r.pos:r.pos + wp.K] == text[r.first_id][r.first_pos:r.first_pos + wp.K]
    assert len(hits) <= sum(len(brute(t, wp.K, wp.W)) for _, t in rows)


def test_likeness():
    a = np.array([1, 2, 2, 3], np.uint64)
    assert wp.likeness(a, a) == 1 and wp.likeness(a, np.array([3, 4], np.uint64)) == 0.25
    assert wp.likeness(a, a[:0]) == 0 and wp.likeness(a[:0], a[:0]) == 1
