from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import length_buckets as lb

from .conftest import ODD


def padding(lengths, counts, tops):
    return sum(c * (min(t for t in tops if t >= x) - x) for x, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(8))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    lengths = rng.sample(range(1, 60), 9)
    counts = [rng.randint(1, 50) for _ in lengths]
    for k in (1, 2, 3, 4):
        tops = lb.boundaries(lengths, counts, k)
        best = min(padding(lengths, counts, [*c, max(lengths)]) for c in itertools.combinations(sorted(lengths)[:-1], k - 1))
        assert len(tops) == k and tops == sorted(tops) and tops[-1] == max(lengths)
        assert padding(lengths, counts, tops) == best


def test_boundaries_of_few_lengths():
    assert lb.boundaries([], [], 4) == []
    assert lb.boundaries([7], [3], 4) == [7]
    assert lb.boundaries([3, 5], [1, 1], 9) == [3, 5]


@pytest.mark.parametrize("slots", [1, 13])
def test_every_word_is_in_one_piece_and_batches_keep_the_budget(docs_of, monkeypatch, slots):
    monkeypatch.setattr(lb, "slots_for", lambda n: slots)
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 31, 32, 33, 64, 200])), None, None) for i in range(300)]
    got = lb.pack(docs_of(rows), max_len=32, buckets=4, budget=100).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.n_tokens))
        assert r.n_tokens + r.padding == r.bucket_len <= 32
    for i, t, *_ in rows:
        n = len(t.split())
        want = [(k, 32 * k, min(32, n - 32 * k)) for k in range(-(-n // 32))]
        assert sorted(pieces.get(i, [])) == want
    batches = {}
    for r in got:
        batches.setdefault((r.bucket_len, r.batch_id), []).append(r.slot)
    full = {}
    for (top, name), slots_ in batches.items():
        assert sorted(slots_) == list(range(len(slots_))) and len(slots_) * top <= 100
        full.setdefault(top, []).append(len(slots_) == 100 // top)
    assert all(f.count(False) <= 1 for f in full.values())  # only the last batch of a bucket is short


def test_odd_rows(docs_of):
    d = docs_of(ODD).withColumn("piece", F.lit("x")).withColumn("bucket_len", F.lit("y"))
    got = lb.pack(d).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == [("4", 1), ("5", 2), ("5", 2), ("6", 2), ("None", 3)]
    empty = lb.pack(docs_of([]))
    assert empty.count() == 0 and empty.columns == lb.pack(d).columns
    with pytest.raises(ValueError):
        lb.pack(d, max_len=10, budget=5)
