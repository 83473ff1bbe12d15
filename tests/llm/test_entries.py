"""Every registered query runs on the small tables; those with SQL equal it."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from tidemark.llm import common
from tidemark.llm.entries import ORACLES, QUERIES

from ..conftest import SMALL

COLUMNS = {
    "op1": ["page_id", "url", "text", "n_chars"],
    "op3": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op4": ["doc_id", "n_shingles", "component_id"],
    "op5": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op7": ["doc_id", "size", "source_size", "target", "taken"],
    "op8": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9": ["query_id", "rank", "vec_id", "score"],
    "op10": ["doc_id", "held_out", "lang_pred", "score"],
    "op11": ["word", "form", "root", "n", "n_near", "form_n"],
    "op12": ["doc_id", "n_features", "weight", "score", "rank"],
    "op13": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
}


def test_one_query_per_operator():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{i}" for i in range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    out = QUERIES[name](spark, SMALL)
    want = COLUMNS.get(name.split("_")[0], [])
    assert set(want) <= set(out.columns)
    rows = [tuple(r) for r in out.select(*sorted(out.columns)).collect()]
    assert rows
    if name in ORACLES:
        con = duckdb.connect()
        for t in ("documents", "pages", "embeddings", "conversations", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
        got = con.execute(ORACLES[name])
        names = [d[0] for d in got.description]
        at = [names.index(c) for c in sorted(out.columns)]
        assert sorted(map(str, rows)) == sorted(str(tuple(r[i] for i in at)) for r in got.fetchall())


def test_stages_by_brute_force(spark):
    """Stage by stage on the small table: what each keeps and changes."""
    from tidemark.llm import jaccard_join, length_buckets, quality_bands, secret_scan, source_mix
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    cols, tables = docs.columns, common.Scratch(spark, "stages")
    by_id = {r.doc_id: r for r in docs.collect()}
    state, names = docs, [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    out = []
    for name, stage in corpus_pipeline.STAGES:
        state = tables.write(stage(spark, state, SMALL), name)
        out.append(state)
    for d in out[:-1]:
        assert d.columns == cols
    kept = {r.doc_id for r in quality_bands.score(docs).where("kept").collect()}
    assert {r.doc_id for r in out[0].collect()} == kept
    from .test_jaccard_join import brute
    links = brute([(i, by_id[i].text) for i in sorted(kept)], 5, 80, 100)
    assert {r.doc_id for r in out[1].collect()} == {i for i, _, c in links if i == c}
    clean = {r.doc_id: r.text for r in out[2].collect()}
    spans = {r.doc_id: r.secrets for r in secret_scan.scan(out[1]).collect()}
    for i, t in clean.items():
        assert (t != by_id[i].text) == bool(spans[i])
    assert not [r for r in secret_scan.scan(out[2]).collect() if r.n_access or r.n_hex]
    copies = {}
    for r in out[3].collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert r.text == clean[r.doc_id]
    assert max(copies.values()) <= 3 and len(copies) > len(clean) // 3
    words = sum(len(clean[i].split()) * n for i, n in copies.items())
    assert sum(r.n_tokens for r in out[4].collect()) == words
    assert sorted(out[4].columns) == sorted(length_buckets.pack(docs).columns)
    assert source_mix.mix(out[2]).count() == len(clean) and jaccard_join.keep_one(out[1]).count() == len(clean)
