from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import target_resample as tr
from tidemark.llm import textops as tx

from .conftest import ODD, prose

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, order):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return len(w), [" ".join(w[i:i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, order=1, buckets=10_000, share=(10, 100), min_words=20):
    def counts(texts):
        n = [0] * buckets
        for t in texts:
            for g in grams(t, order)[1]:
                n[zlib.crc32(g.encode()) % buckets] += 1
        return n
    s, t = counts(x for _, x in docs), counts(target)
    a, b = sum(s) + buckets, sum(t) + buckets
    gain = [math.floor(1000 * math.log((y + 1) * a / ((x + 1) * b))) for x, y in zip(s, t)]
    rows = []
    for i, text in docs:
        n, g = grams(text, order)
        w = sum(gain[zlib.crc32(x.encode()) % buckets] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for k, r in enumerate(able[:len(able) * share[0] // share[1]]):
        r[5] = k + 1
    return sorted(map(str, rows))


def got(df):
    return sorted(str([r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]]) for r in df.collect())


def texts(seed, n):
    rng = random.Random(seed)
    vocab = prose(rng, 300) + ["Übung", "naïve", "x9", "007", "ΑΒΓ", "日本", "word" * 300, "A-b_c"]
    return [(i, ", ".join(rng.choice(vocab) for _ in range(rng.choice([0, 3, 19, 20, 21, 60])))) for i in range(n)]


def test_crc_matrices():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 31):
        m = rng.integers(0, 256, (50, n), np.uint8)
        assert tx.crc_matrix(m).tolist() == [zlib.crc32(r.tobytes()) for r in m]
        before = rng.integers(0, 1 << 32, 50, np.uint32)
        assert tx.crc_matrix(m, before).tolist() == [zlib.crc32(r.tobytes(), int(b)) for r, b in zip(m, before)]
    some = [bytes(rng.integers(0, 256, k, np.uint8)) for k in (0, 1, 1, 5, 9, 5, 3000, 1024, 1025)]
    assert tr.crc_distinct(pa.array(some, pa.large_binary())).tolist() == [zlib.crc32(x) for x in some]
    assert len(tr.crc_distinct(pa.array([], pa.large_binary()))) == 0


@pytest.mark.parametrize("order,chunk", [(1, 1 << 20), (1, 40), (3, 1 << 20), (3, 40)])
def test_features_of_pieces(monkeypatch, order, chunk):
    """Whole texts, and long texts in pieces, have the same features."""
    whole = tx.cut_chunks
    monkeypatch.setattr(tx, "cut_chunks", lambda col, inside: whole(col, inside, chunk))
    rows = [t for _, t in texts(3, 60)] + [None, "", " ", "one", "a" * 500 + " b", "x y z " * 200]
    n_words, found = [0] * len(rows), [[] for _ in rows]
    for of_word, of_feature, crc in tr.features(pa.array(rows), order):
        for i in of_word:
            n_words[i] += 1
        for i, c in zip(of_feature, crc):
            found[i].append(int(c))
    for t, n, f in zip(rows, n_words, found):
        want = grams(t, order)
        assert n == want[0] and sorted(f) == sorted(zlib.crc32(g.encode()) for g in want[1])


@pytest.mark.parametrize("order,buckets", [(1, 10_000), (2, 97)])
def test_against_brute_force(spark, docs_of, order, buckets):
    docs = texts(1, 400)
    target = [t for _, t in texts(2, 40)] + [None]
    t = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id bigint, text string")
    d = docs_of([(i, x, None, None) for i, x in docs]).repartition(7)
    assert got(tr.resample(d, t, order=order, buckets=buckets)) == brute(docs, target, order, buckets)


def test_documents_like_the_target_are_drawn(spark, docs_of):
    rng = random.Random(5)
    near, far = prose(rng, 40), prose(rng, 40)
    rows = [(i, " ".join(rng.choice(near if i % 4 == 0 else far) for _ in range(30))) for i in range(800)]
    t = spark.createDataFrame([(1, " ".join(near * 5))], "item_id bigint, text string")
    out = [r for r in tr.resample(docs_of([(i, x, None, None) for i, x in rows]), t).collect() if r["rank"]]
    # an even draw would take 20 of the 200 near ones; smoothing and noise leave some far ones in
    assert len(out) == 80 and sum(r.doc_id % 4 == 0 for r in out) >= 40
    assert sorted(r["rank"] for r in out) == list(range(1, 81))


def test_ties_repeats_and_odd_rows(spark, docs_of):
    t = spark.createDataFrame([(1, "one two"), (2, None)], "item_id bigint, text string")
    docs = [(i, x) for i, x, _, _ in ODD] + [(7, "w " * 25)] * 30 + [(None, "v " * 25)] * 30
    d = docs_of([(i, x, None, "s") for i, x in docs]).withColumn("rank", F.lit(-1)).withColumn("__part", F.lit("x"))
    out = tr.resample(d, t, keep=("doc_id", "rank", "source"))
    assert got(out) == brute(docs, ["one two", None]) and out.columns[:2] == ["doc_id", "source"]
    nothing = docs_of([])
    assert tr.resample(nothing, t).count() == 0
    assert got(tr.resample(d, t.limit(0))) == brute(docs, [])
