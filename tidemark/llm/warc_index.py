"""WARC archives with an index written first.

Writing: every task writes its records, one gzip member each, to files of its
own under the shared folder and returns an index row per record (file, offset,
length, URL, payload digest, kind).  Only the rows of finished task attempts
reach the index table; what a lost attempt wrote is never referred to.

Reading: the index rows that are selected are dealt by file and byte range,
sorted, and neighbouring ranges are read in one request; records are cut out
of the bytes, and their digests checked against their payloads.

Equal payloads from ``least`` bytes on are stored once, as the response of the
smallest page_id (null last; among equal ones the row read first); the others
become revisit records that refer to it.  Rows must come from a stable read
(a table), since that order decides ties.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, prepare

INDEX = ("file string, offset bigint, length bigint, page_id bigint, url string, digest string, payload_bytes bigint, "
         "record_type string")
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
          "payload binary")
FILE_BYTES = 256 << 20   # a task starts a new file beyond this
READ_BYTES = 8 << 20     # most bytes of one read request, but for longer records
GAP = 64 << 10           # unselected bytes read over rather than asked for apart
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URL_SAFE = "".join(chr(c) for c in range(33, 127))


def _fs(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def page_of(record: str | None) -> int | None:
    part = record.strip("<>").split(":")[2] if record else ""
    return int(part) if part else None


def make_record(page_id, row, url, payload: bytes | None, n_bytes: int, digest: str, refers: str | None, date: str) -> bytes:
    """One gzip member.  A revisit (``payload`` None) keeps the HTTP header
    of the response, so it tells the length of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {record_id(page_id, row)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if refers:
        head += [f"WARC-Refers-To: {refers}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def parse_record(member: bytes) -> dict:
    """Header fields, kind, payload and its length of a gzip member."""
    raw = zlib.decompress(member, wbits=31)
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    block = raw[end + 4:end + 4 + int(head["Content-Length"])]
    cut = block.index(b"\r\n\r\n")
    http = dict(x.split(": ", 1) for x in block[:cut].decode().split("\r\n")[1:])
    return {"head": head, "payload": block[cut + 4:], "payload_bytes": int(http["Content-Length"])}


def _writer(base: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, "", 0
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    fs, path = _fs(name)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out, at = fs.open_output_stream(path, compression=None), 0
                refers = record_id(r["ref_page"], r["ref_row"]) if r["revisit"] else None
                payload = None if refers else r["html"].encode()
                rec = make_record(r["page_id"], r["row"], r["url"], payload, r["n"], r["digest"], refers, date)
                out.write(rec)
                rows.append((name, at, len(rec), r["page_id"], r["url"], r["digest"], r["n"],
                             "revisit" if refers else "response"))
                at += len(rec)
            if rows:
                file, offset, length, page, url, digest, n, kind = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file, pa.string()), pa.array(offset, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(page, pa.int64()), pa.array(url, pa.string()), pa.array(digest, pa.string()),
                     pa.array(n, pa.int64()), pa.array(kind, pa.string())], names=[x.split()[0] for x in INDEX.split(", ")])
        if out is not None:
            out.close()
    return run


def write_archives(pages: DataFrame, base: str, least: int = 100, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` below ``base``
    and the index as a table in ``<base>/index``; returns the index."""
    spark = pages.sparkSession
    prepare(spark)
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = (pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", body.alias("html"))
            .withColumn("row", F.monotonically_increasing_id())
            .withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("n", F.octet_length("html").cast("bigint")))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row"))
    # only payloads that occur twice or more take part in the join
    shared = (rows.where(F.col("n") >= least).groupBy(F.col("digest").alias("same")).agg(first.alias("first"), F.count(F.lit(1)).alias("c"))
              .where("c > 1").select("same", F.col("first.page_id").alias("ref_page"), F.col("first.row").alias("ref_row")))
    plan = (rows.join(shared, F.col("digest") == F.col("same"), "left")
            .withColumn("revisit", F.col("same").isNotNull() & (F.col("row") != F.col("ref_row")))
            .withColumn("html", F.when(~F.col("revisit"), F.col("html")))
            .select("page_id", "url", "html", "row", "digest", "n", "revisit", "ref_page", "ref_row"))
    plan.mapInArrow(_writer(f"{base}/archives", date), INDEX).write.parquet(f"{base}/index")
    return read_index(spark, base)


def read_index(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{base}/index")


def _ranges(rows: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(first row, end row, offset, end) of the reads that serve rows sorted
    by offset."""
    out: list[tuple[int, int, int, int]] = []
    for i, (at, n) in enumerate(rows):
        if out and at - out[-1][3] <= GAP and at + n - out[-1][2] <= READ_BYTES:
            a, _, lo, hi = out[-1]
            out[-1] = (a, i + 1, lo, max(hi, at + n))
        else:
            out.append((i, i + 1, at, at + n))
    return out


def _reader(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, src = None, None
        for b in batches:
            index = b.to_pylist()
            i = 0
            while i < len(index):
                j = i
                while j < len(index) and index[j]["file"] == index[i]["file"]:
                    j += 1
                if index[i]["file"] != name:
                    if src is not None:
                        src.close()
                    name = index[i]["file"]
                    fs, path = _fs(name)
                    src = fs.open_input_file(path)
                part = index[i:j]
                for a, e, lo, hi in _ranges([(r["offset"], r["length"]) for r in part]):
                    data = src.read_at(hi - lo, lo)
                    yield _records([(r, data[r["offset"] - lo:r["offset"] - lo + r["length"]]) for r in part[a:e]], payloads)
                i = j
        if src is not None:
            src.close()
    return run


def _records(found: list[tuple[dict, bytes]], payloads: bool) -> pa.RecordBatch:
    rows = []
    for entry, member in found:
        rec = parse_record(member)
        head = rec["head"]
        digest = head["WARC-Payload-Digest"].split(":", 1)[1]
        kind = head["WARC-Type"]
        if kind == "response" and hashlib.sha256(rec["payload"]).hexdigest() != digest or digest != entry["digest"]:
            raise ValueError(f"digest of the record at {entry['file']}:{entry['offset']} does not fit")
        rows.append((page_of(head["WARC-Record-ID"]), entry["url"], rec["payload_bytes"], digest, kind,
                     page_of(head.get("WARC-Refers-To")), rec["payload"] if payloads and kind == "response" else None))
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=[x.split()[0] for x in RECORD.split(", ")])


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the selected index rows, with payloads if asked for.
    Reads are dealt by file and byte range, so a large archive is read by
    many tasks and each reads on in one direction."""
    part = F.floor(F.col("offset") / (4 * READ_BYTES))
    dealt = (index.select("file", "offset", "length", "url", "digest").withColumn("part", part)
             .repartition("file", "part").sortWithinPartitions("file", "offset").drop("part"))
    out = dealt.mapInArrow(_reader(payloads), RECORD)
    return out if payloads else out.drop("payload")


def round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write every row of ``pages`` and read all records back: ``page_id``,
    ``url``, ``payload_bytes``, ``payload_digest``, ``record_type`` and
    ``refers_to``.

    A null html is the empty payload, a null url has no target header, a null
    page_id an empty id; repeated rows are records of their own, of which one
    is the response.  An empty table gives no records."""
    prepare(pages.sparkSession)
    base = Scratch(pages.sparkSession, "warc").base
    return read_records(write_archives(pages, base, least), payloads=False)
