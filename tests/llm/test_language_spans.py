from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_spans as ls

from .conftest import ODD, prose

ALPHABETS = {"aa": "etaoinshrdlu", "bb": "qxzwkjvyetao", "ru": "абвгдежзийкл", "el": "αβγδεζηθικλμ"}


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(ALPHABETS))
        rows.append((i, " ".join(prose(rng, rng.randint(3, 60), ALPHABETS[lang])), lang, None))
    return rows


def test_held_out_accuracy(docs_of):
    rows = corpus()
    got = {r.doc_id: r for r in ls.split_and_identify(docs_of(rows)).collect()}
    lang = {i: la for i, _, la, _ in rows}
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    out = [r.lang_pred == lang[r.doc_id] for r in got.values() if r.held_out]
    assert len(out) > 50 and np.mean(out) >= 0.97


def test_spans_of_mixed_text(docs_of):
    model = ls.train(docs_of(corpus()))
    rng = random.Random(7)
    a, b = " ".join(prose(rng, 12, ALPHABETS["aa"])), " ".join(prose(rng, 20, ALPHABETS["ru"]))
    row = ls.identify(docs_of([(1, f"{a}. 12 {b}", None, None)]), model).first()
    assert row.lang_pred == "ru" and [s.lang for s in row.spans] == ["aa", "ru"]
    assert (row.spans[0].s, row.spans[0].e) == (0, len(a)) and row.spans[1].e == len(a) + 5 + len(b)


def best_path(score, switch):
    best = [(0.0, ())]
    n = len(score[0])
    best = {k: (score[0][k], (k,)) for k in range(n)}
    for row in score[1:]:
        best = {k: max(((v - (switch if p[-1] != k else 0)) + row[k], (*p, k)) for v, p in best.values()) for k in range(n)}
    return max(best.values())


@pytest.mark.parametrize("seed,scale", [(4, 1.0), (5, 0.3), (6, 0.1)])
def test_viterbi_is_optimal(seed, scale):
    rng = np.random.default_rng(seed)
    sizes = [1, 7, 0, 3, 7, 5, 0]
    first = np.concatenate([[0], np.cumsum(sizes)])
    score = rng.normal(size=(first[-1], 3)) * scale
    for got, (a, b) in itertools.product((ls.viterbi(score, first, 1.0), ls.decode(score, first, 1.0)), zip(first[:-1], first[1:])):
        if b > a:
            value = sum(score[i, got[i]] for i in range(a, b)) - sum(got[i] != got[i - 1] for i in range(a + 1, b))
            assert abs(value - best_path(score[a:b].tolist(), 1.0)[0]) < 1e-9


def test_labels_of_the_held_out_fold_do_not_matter(docs_of):
    rows = corpus(120)
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else la, "s") for i, t, la, _ in rows]
    a = {r.doc_id: (r.lang_pred, r.score) for r in ls.split_and_identify(docs_of(rows)).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in ls.split_and_identify(docs_of(wrong)).collect()}


def test_chunks_do_not_change_the_result(docs_of, monkeypatch):
    d = docs_of(corpus(150))
    a = sorted(map(str, ls.split_and_identify(d).collect()))
    monkeypatch.setattr(ls.tx, "CHUNK", 4000)
    assert a == sorted(map(str, ls.split_and_identify(d).collect()))


def test_odd_rows(docs_of):
    d = docs_of([*ODD, *[(i + 100, t, la, s) for i, t, la, s in corpus(60)], (999, "12 34 !", "aa", None)])
    got = {}
    for r in ls.split_and_identify(d.withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1))).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert got[1] == got[2] == got[3] == got[999] == [("und", 0.0)] and len(got[5]) == 2
    assert got[4][0][0] != "und"
    unlabelled = docs_of([(1, "some words", None, None)])
    assert [(r.lang_pred, r.score) for r in ls.split_and_identify(unlabelled).collect()] == [("und", 0.0)]
    assert ls.split_and_identify(docs_of([])).count() == 0


def test_rare_labels_beyond_the_first_64_are_learned(docs_of):
    rng = random.Random(11)
    alphabet = {f"l{k:03d}": "".join(chr(0x4E00 + 8 * k + j) for j in range(8)) for k in range(150)}
    rows = [(i, " ".join(prose(rng, 30, a)), la, None) for i, (la, a) in enumerate(itertools.chain(*[alphabet.items()] * 6))]
    model = ls.train(docs_of([r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]))
    known = {la for i, _, la, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert set(model.langs) == known and len(known) > 128
    lang = {i: la for i, _, la, _ in rows}
    got = ls.split_and_identify(docs_of(rows)).where("held_out").collect()
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if lang[r.doc_id] in known]) >= 0.97


def test_sparse_counts_give_the_same_model(docs_of):
    d = docs_of(corpus(200))
    a, b = ls.train(d), ls.train(d, langs=3)
    assert a.langs == b.langs and np.allclose(a.table, b.table, atol=1e-4) and (a.writes == b.writes).all()


def test_letters_are_unicode_letters(docs_of):
    """Digits, marks and signs of any script make no word, letters of any
    block do, and marks stay inside their words."""
    import sys
    import unicodedata
    kind = [unicodedata.category(chr(i)) for i in range(sys.maxunicode + 1)]
    for i in itertools.chain(range(0x3000), range(0xA000, 0xAC00), range(0xF900, 0x11000)):
        if kind[i] == "Cs":
            continue
        _, _, starts, ends = ls.words_of(f"{chr(i)} ")
        assert (len(starts) == 1) == (kind[i][0] == "L"), hex(i)
    marks = "\u0301"
    for text, words in ((f"a{marks}b {marks} c", 2), ("\u0939\u093f\u0928\u094d\u0926\u0940", 1), ("\u0966\u0967 \u0e51", 0), (f"{marks}{marks}", 0)):
        cp, script, starts, ends = ls.words_of(text + " ")
        assert len(starts) == words and ((script > 0).sum() == (ends - starts).sum())
    model = ls.train(docs_of(corpus(100)))
    rows = [(1, "\u0966\u0967\u0968\u0969", None, None), (2, "\u0e51\u0e52\u0e53", None, None), (3, marks * 3, None, None), (4, "12 \u0660 -", None, None)]
    assert [(r.lang_pred, r.score) for r in ls.identify(docs_of(rows), model).collect()] == [("und", 0.0)] * 4
