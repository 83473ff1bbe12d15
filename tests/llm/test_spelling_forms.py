from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import spelling_forms as sp
from tidemark.llm import textops as tx

from .conftest import ODD


def count(rows, every=97):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    """By trying every edit."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    out = {}
    for w in n:
        near = sorted((v for v in n if v != w and one_edit(w, v)), key=lambda v: (-n[v], v))
        form = near[0] if near and n[near[0]] >= 2 * n[w] else None
        out[w] = (n[w], len(near), form, n[form] if form else None)
    def root(w):
        while out[w][2]:
            w = out[w][2]
        return w
    return {w: (*v, root(w)) for w, v in out.items()}


def result(df):
    rows = df.collect()
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(got) == len(rows)
    return got


def misspelt(rng, w, letters):
    i = rng.randrange(len(w) + 1)
    kind = rng.random()
    if kind < 0.3:
        return w[:i] + rng.choice(letters) + w[i:]
    if kind < 0.6:
        return w[:i] + w[i + 1:]
    return w[:i] + rng.choice(letters) + w[i + 1:]


def vocabulary(seed, n=150, letters="abcéÿ", longest=14):
    rng = random.Random(seed)
    words = {}
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.choice([5, 6, 7, 9, longest, 26, 40])))
        words[w] = rng.randint(3, 400)
        for _ in range(rng.randint(0, 4)):
            w = misspelt(rng, w, letters)
            words.setdefault(w, rng.randint(3, 60))
    return {w: c for w, c in words.items() if len(w) >= 5}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_words_against_all_pairs(spark, seed):
    n = vocabulary(seed)
    want = brute(n)
    assert sum(v[1] for v in want.values()) > 50
    assert result(sp.group_variants(spark.createDataFrame(list(n.items()), "word string, n bigint"))) == want


@pytest.mark.parametrize("tile,small,cells", [(8, 32, 1 << 22), (16, 4, 300), (1000, 2, 100)])
def test_large_tiles_in_blocks(spark, monkeypatch, tile, small, cells):
    """Words that agree on all but one part, in blocks, small matrices and
    many batches."""
    rng = random.Random(9)
    n = {"zz" + "".join(rng.choice("abcd") for _ in range(3)) + "yyy": rng.randint(3, 99) for _ in range(120)}
    n |= {"zz" + "".join(rng.choice("abcd") for _ in range(4)) + "yyy": rng.randint(3, 99) for _ in range(120)}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    monkeypatch.setattr(sp, "TILE", tile)
    monkeypatch.setattr(sp, "SMALL", small)
    monkeypatch.setattr(sp, "CELLS", cells)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        # the kernel runs in workers that import their own settings
        rows = sp._blocks(sp._tiles(df, 5)).orderBy("size", "tile", "part", "i", "j").toArrow()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    near, best = Counter(), {}
    for b in sp._compare(iter(rows.to_batches(max_chunksize=50))):
        for r in b.to_pylist():
            near[r["word"]] += r["near"]
            best[r["word"]] = min(best.get(r["word"], (0, "")), (-r["best_n"], r["best"]))
    want = brute(n)
    assert near == {w: v[1] for w, v in want.items() if v[1]}
    for w, (m, x) in best.items():
        assert (-m, x) == min(((n[v], v) for v in n if v != w and one_edit(w, v)), key=lambda t: (-t[0], t[1]))


def test_no_row_per_pair(spark):
    """A dense family: rows grow with the words, not with their pairs."""
    words = [(f"stem{a}{b}word", 3) for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    df = spark.createDataFrame(words, "word string, n bigint")
    got = sp.near_words(df).collect()
    assert len(got) == len(words) and all(r.n_near == 50 for r in got)


def test_words_of_texts(docs_of):
    rng = random.Random(4)
    base = ["Language", "spelling", "Études", "straße", "colour", "color", "mixed×up", "tiny", "Škoda"]
    rows = []
    for i in range(300):
        words = [misspelt(rng, rng.choice(base), "abc") if rng.random() < 0.2 else rng.choice(base) for _ in range(40)]
        rows.append((i if i % 7 else None, " ".join(words)))
    got = result(sp.variants(docs_of([(i, t, None, None) for i, t in rows]), every=5))
    assert got == brute(count(rows, 5)) and len(got) > 20
    plain = result(sp.variants(docs_of([(i, t, None, None) for i, t in rows]), every=0))
    assert plain == brute(count(rows, 0))


@pytest.mark.parametrize("chunk,merge", [(1 << 20, 1 << 18), (16, 4)])
def test_counts_by_chunk(monkeypatch, chunk, merge):
    """Long texts in pieces, letters on both sides of the range, words that
    end where a text ends."""
    whole = tx.cut_chunks
    monkeypatch.setattr(tx, "cut_chunks", lambda col, inside: whole(col, inside, chunk))
    monkeypatch.setattr(sp, "MERGE", merge)
    rng = random.Random(7)
    bits = ["Straße", "naïve", "ÀÿÖ×÷", "¿abcde", "żółwie", "日本語words", "\U0001F600smile", "abcdef", "ABCDEF", "x" * 40, "-", "\n"]
    rows = [(i, rng.choice(["", " ", "."]).join(rng.choice(bits) for _ in range(rng.randint(0, 30)))) for i in range(80)] + [(None, None), (7, "")]
    n = Counter()
    table = pa.record_batch({"id": [None if i is None else str(i) for i, _ in rows], "text": [t for _, t in rows]})
    for b in sp._counts(5, 5)(iter([table, table.slice(3, 20)])):
        for r in b.to_pylist():
            n[r["word"]] += r["n"]
    assert {w: c for w, c in n.items() if c >= 3} == count(rows + rows[3:23], 5)


def test_roots_follow_chains(spark):
    chain = [("aaaaaa", 3), ("aaaaab", 6), ("aaaabb", 12), ("aaabbb", 24), ("aabbbb", 48), ("abbbbb", 96), ("bbbbbb", 192)]
    got = result(sp.group_variants(spark.createDataFrame(chain, "word string, n bigint")))
    assert {v[4] for v in got.values()} == {"bbbbbb"} and got == brute(dict(chain))


def test_ties_and_odd_rows(spark, docs_of):
    tie = spark.createDataFrame([("words", 3), ("wordz", 9), ("worda", 9), (None, 5), ("abc", 99)], "word string, n bigint")
    got = result(sp.group_variants(tie.withColumn("tile", F.lit("x")).withColumn("root", F.lit(1))))
    assert got["words"] == (3, 2, "worda", 9, "worda") and set(got) == {"words", "wordz", "worda"}
    rows = [(i, t) for i, t, _, _ in ODD] * 3
    d = docs_of(ODD * 3).withColumn("run", F.lit(0)).withColumn("word", F.lit("x"))
    got = result(sp.variants(d))
    assert got == brute(count(rows)) and max(map(len, got)) >= 299_999
    assert sp.variants(docs_of([])).count() == 0
    long = [("y" * 100_000 + x, 3 + i) for i, x in enumerate(["", "a", "b", "ab", "cb"])]
    assert result(sp.group_variants(spark.createDataFrame(long, "word string, n bigint"))) == brute(dict(long))
