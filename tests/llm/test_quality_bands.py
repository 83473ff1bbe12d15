from __future__ import annotations

import base64
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import quality_bands as qb

from .conftest import ODD, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(t):
    w = WORD.findall(t or "")
    c = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    hit = {k + j for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_base_counts_equal_plain_python(docs_of):
    rng = random.Random(3)
    texts = [None, "", "\n\n", "a\nb\na\n \nb\na", "a b c a b c a", "x\x0by\x0cz\r\nx\r\n", "é ß ü #<|>\n\né ß ü #<|>"]
    for _ in range(60):
        w = [rng.choice(["a", "bb", "é", "#%", "long" * 5]) for _ in range(rng.randint(1, 200))]
        texts.append("".join(x + rng.choice([" ", "\n", "\t", "  "]) for x in w))
    d = docs_of([(i, t, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in qb.score(d).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def verdicts(docs_of, texts):
    return [r.kept for r in qb.score(docs_of([(i, t, None, None) for i, t in enumerate(texts)])).orderBy("doc_id").collect()]


def test_bands_reject_repetitive_and_random_text_and_keep_prose(docs_of):
    rng = random.Random(8)
    vowels = "aeiou"
    lexicon = ["".join(rng.choice("bcdfglmnprst") + rng.choice(vowels) for _ in range(rng.randint(1, 4))) for _ in range(900)]
    prose_text = [" ".join(rng.choice(lexicon) for _ in range(n)) for n in (60, 300, 2000, 20000)]
    cycle = [" ".join(f"item{i % 97} costs {i % 89} in row{i % 101}" for i in range(3000))]
    noise = base64.b64encode(rng.randbytes(9000)).decode()
    random_text = [" ".join(noise[i:i + 40] for i in range(0, len(noise), 40))]
    mixed = [" ".join(lexicon[:900]) + " " + random_text[0]]  # chunks give it away
    assert verdicts(docs_of, prose_text) == [True] * 4
    assert verdicts(docs_of, cycle + random_text + mixed) == [False, False, False]


def test_limits_follow_the_length():
    b = qb.Bands()
    assert b.limits(0) == (b.low[0], b.high[0])
    assert b.limits(127) == (b.low[0], b.high[0])
    assert b.limits(128) == (b.low[1], b.high[1])
    assert b.limits(10**9) == (b.low[-1], b.high[-1])


def test_odd_rows_and_all_columns(docs_of):
    d = docs_of([*ODD, (8, " ".join(prose(random.Random(1), 90)), "en", "a")]).withColumn("kept", F.lit("x")).withColumn("ratio", F.lit(1))
    got = qb.score(d).collect()
    assert len(got) == len(ODD) + 1 and [r.doc_id for r in got if r.kept] == [8]
    good = qb.keep_good(d)
    assert good.columns == d.columns
    assert [(r.doc_id, r.lang, r.kept, r.ratio) for r in good.collect()] == [(8, "en", "x", 1)]
    assert qb.score(docs_of([])).count() == 0 and qb.keep_good(docs_of([])).count() == 0


def test_every_byte_of_a_text_longer_than_a_chunk_is_judged(docs_of):
    rng = random.Random(9)
    lexicon = prose(rng, 900, "etaoinshrdlu")
    words = lambda n: (" ".join(rng.choice(lexicon) for _ in range(n)))[:n]
    coded = lambda n: "\n".join(base64.b64encode(rng.randbytes(57)).decode() for _ in range(n // 76 + 1))[:n]
    again = lambda n: ("the same line of a menu over and over again\n" * n)[:n]
    good = [words(n) for n in (4000, 4097, 4200, 6000, 8100, 8191, 12_200, 100_000)]
    bad = [words(3600) + coded(2400), words(4455) + coded(3645), words(8192) + coded(4008), words(8192) + again(4008)]
    assert verdicts(docs_of, good) == [True] * 8
    assert verdicts(docs_of, bad) == [False] * 4
    r = qb.score(docs_of([(1, bad[2], None, None)])).first()
    assert abs(r.odd_chunks - 4008 / 12_200) < 1e-12
