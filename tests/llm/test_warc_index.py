from __future__ import annotations

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc_index as wi
from tidemark.llm.common import Scratch


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def sample(rng):
    same, other, short = "<p>same</p>" * 20, "é" * 60, "short"
    rows = [(i, f"http://h/{i}?q=é {i}\r\nX: y", rng.choice([same, other, short, f"<p>{i}</p>" * 30, "", None])) for i in range(200)]
    return [*rows, (None, None, same), (500, None, "a\r\n\r\nb" * 30), (7, "u", same), (7, "u", same)]


def expected(rows):
    body = [(i, u, (h or "").encode()) for i, u, h in rows]
    out, first = [], {}
    for i, u, b in sorted(body, key=lambda r: (r[0] is None, r[0] or 0)):
        d = hashlib.sha256(b).hexdigest()
        kind = "revisit" if len(b) >= 100 and d in first else "response"
        out.append((i, u, len(b), d, kind, first[d] if kind == "revisit" else None))
        if len(b) >= 100:
            first.setdefault(d, i)
    return out


def key(r):
    return tuple(str(x) for x in r)


def test_round_trip(spark):
    rows = sample(random.Random(1))
    got = wi.round_trip(pages(spark, rows).withColumn("digest", F.lit(1)))
    # among equal page ids any one may be the response
    assert sorted((key(r)[:1] + key(r)[2:] for r in got.collect())) == sorted(key(r)[:1] + key(r)[2:] for r in expected(rows))


def test_selected_records_come_back_with_their_payloads(spark, monkeypatch):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (1 + i % 50)) for i in range(300)]
    base = Scratch(spark, "warc-test").base
    index = wi.write_archives(pages(spark, rows), base)
    picked = index.where("page_id % 7 = 3")
    want = {i: h for i, _, h in rows if i % 7 == 3}
    got = {r.page_id: r for r in wi.read_records(picked).collect()}
    assert {i: bytes(r.payload).decode() for i, r in got.items()} == want
    assert all(r.url == f"http://h/{i}" for i, r in got.items())


def test_files_are_warc_and_the_index_points_into_them(spark):
    base = Scratch(spark, "warc-test").base
    index = wi.write_archives(pages(spark, [(1, "http://h/", "x" * 200), (2, None, "x" * 200)]), base).collect()
    for r in index:
        data = wi._fs(r.file)[0].open_input_file(wi._fs(r.file)[1]).read_at(r.length, r.offset)
        raw = gzip.decompress(data)
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        assert (r.record_type == "revisit") == (b"WARC-Refers-To: <urn:page:1:" in raw)
        assert (b"x" * 200 in raw) == (r.record_type == "response")


def test_ranges_are_coalesced_within_bounds(monkeypatch):
    monkeypatch.setattr(wi, "GAP", 10)
    monkeypatch.setattr(wi, "READ_BYTES", 100)
    assert wi._ranges([(0, 20), (20, 20), (45, 20), (80, 10), (90, 15)]) == [(0, 3, 0, 65), (3, 5, 80, 105)]
    assert wi._ranges([(0, 500), (500, 10)]) == [(0, 1, 0, 500), (1, 2, 500, 510)]
    assert wi._ranges([]) == []


def test_a_changed_archive_is_noticed():
    rec = wi.make_record(1, 0, "http://h/", b"payload", 7, hashlib.sha256(b"other").hexdigest(), None, "2000-01-01T00:00:00Z")
    entry = {"file": "f", "offset": 0, "url": None, "digest": hashlib.sha256(b"other").hexdigest()}
    with pytest.raises(ValueError):
        wi._records([(entry, rec)], True)


def test_files_roll_over(spark, monkeypatch):
    rows = [(i, None, f"{i}" * 100) for i in range(40)]
    import pyarrow as pa
    base = Scratch(spark, "warc-test").base
    monkeypatch.setattr(wi, "FILE_BYTES", 500)
    cols = {"page_id": [r[0] for r in rows], "url": [None] * 40, "html": [r[2] for r in rows], "row": list(range(40)),
            "digest": [hashlib.sha256(r[2].encode()).hexdigest() for r in rows], "n": [len(r[2]) for r in rows],
            "revisit": [False] * 40, "ref_page": [None] * 40, "ref_row": [None] * 40}
    out = list(wi._writer(f"{base}/archives", "2000-01-01T00:00:00Z")(iter([pa.RecordBatch.from_pydict(cols)])))
    assert len({f for b in out for f in b.column("file").to_pylist()}) > 5


def test_empty_table(spark):
    assert wi.round_trip(pages(spark, [])).count() == 0
