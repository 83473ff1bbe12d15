"""Document fingerprints by winnowing.

The hashes of all k-grams (runs of ``k`` code points) roll over a text; of
every ``w`` k-grams in a row the one with the least hash is kept, on ties the
rightmost, with its position.  Two texts that share a passage of
``k + w - 1`` code points or more share a kept (hash, offset in the passage):
the window of the passage picks the same k-gram in both.  A passage shorter
than ``k`` is never matched.  A text of fewer than w k-grams keeps the least
of them, one of fewer than k code points the hash of the whole.

Texts are worked on in chunks of many rows at once; a long text in pieces that
overlap by a window, so memory follows the chunk, not the text.

``compare_with_next`` needs each document beside the next one.  Documents go
once through the shuffle, compressed, dealt to slots of the order (doc_id,
null last, then hash of the text); a slot also gets the first row of the next
one as a guest, and is read as a stream.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare
from .textops import mix

K, W = 24, 32
CHUNK = 1 << 19        # code points worked on at once
PER_SLOT = 2_000       # rows of a slot
SLOTS = 10_000         # most slots; beyond it slots grow, and are streamed
U = np.uint64
BITS = 40              # bits of a hash; the others of a word hold a position
_ROLL = U(0x9E3779B97F4A7C15 | 1)
_BACK = U(pow(int(_ROLL), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_ROLL, 2 * CHUNK + 1), _powers(_BACK, 2 * CHUNK + 1)


def gram_hashes(cp: np.ndarray, k: int) -> np.ndarray:
    """``BITS``-bit hash of the k code points from each position on, from the
    running sum of a polynomial."""
    total = np.zeros(len(cp) + 1, U)
    np.cumsum((cp.astype(U) + U(1)) * _UP[:len(cp)], out=total[1:])
    n = max(0, len(cp) - k + 1)
    return mix((total[k:] - total[:n]) * _DOWN[:n]) >> U(64 - BITS)


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` in a row, in log2(w) steps."""
    span, out = 1, x
    while span < w:
        step = min(span, w - span)
        out = np.minimum(out[:len(out) - step], out[step:])
        span += step
    return out


def _kept(h: np.ndarray, w: int) -> np.ndarray:
    """Positions of the rightmost least hash of each window of ``w``."""
    back = U(len(h) - 1) - np.arange(len(h), dtype=U)
    least = _window_min((h << U(64 - BITS)) | back, w)
    return (U(len(h) - 1) - (least & U((1 << (64 - BITS)) - 1))).astype(np.int64)


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions (code points) of one text of any length."""
    n = len(text)
    if n < k:
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return gram_hashes(cp, max(1, n))[:1], np.zeros(min(1, n), np.int64)
    if n < k + w:
        h = gram_hashes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), k)
        at = _kept(h, min(w, len(h)))[:1] if len(h) <= w else np.unique(_kept(h, w))
        return h[at], at
    hashes, places, last = [], [], -1
    for lo in range(0, n - k - w + 2, CHUNK):
        cp = np.frombuffer(text[lo:lo + CHUNK + k + w - 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        h = gram_hashes(cp, k)
        at = np.unique(_kept(h, w))
        if len(at) and lo + at[0] == last:  # the window across the cut kept it already
            at = at[1:]
        hashes.append(h[at])
        places.append(lo + at)
        last = int(lo + at[-1]) if len(at) else last
    return np.concatenate(hashes), np.concatenate(places)


def winnow_all(texts: list[str], k: int = K, w: int = W) -> list[tuple[np.ndarray, np.ndarray]]:
    """``winnow`` of each text, those of ordinary length many at once."""
    out: list = [None] * len(texts)
    run: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if len(t) < k + w - 1 or len(t) > CHUNK:
            out[i] = winnow(t, k, w)
            continue
        if size + len(t) > CHUNK:
            _winnow_run(texts, run, k, w, out)
            run, size = [], 0
        run.append(i)
        size += len(t)
    _winnow_run(texts, run, k, w, out)
    return out


def _winnow_run(texts: list[str], run: list[int], k: int, w: int, out: list) -> None:
    if not run:
        return
    size = np.array([len(texts[i]) for i in run])
    end = np.cumsum(size)
    h = gram_hashes(np.frombuffer("".join(texts[i] for i in run).encode("utf-32-le", "surrogatepass"), np.uint32), k)
    at = _kept(h, w)
    # windows that lie in one text
    start = end - size
    row = np.repeat(np.arange(len(run)), size)[:len(at)]
    inside = np.arange(len(at)) + (k + w - 1) <= end[row]
    row, at = row[inside], at[inside]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    row, at = row[new], at[new]
    bounds = np.searchsorted(row, np.arange(len(run) + 1))
    for j, i in enumerate(run):
        mine = at[bounds[j]:bounds[j + 1]]
        out[i] = (h[mine], mine - start[j])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; 1 if both are empty."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def as_text(print_: tuple[np.ndarray, np.ndarray]) -> str:
    """``position:hash`` in order of position, hashes as hex, comma-joined."""
    h, p = print_
    return ",".join(f"{b}:{a:0{BITS // 4}x}" for a, b in zip(h.tolist(), p.tolist()))


PRINT = "array<struct<pos:bigint,hash:bigint>>"
_PRINT = pa.list_(pa.struct([("pos", pa.int64()), ("hash", pa.int64())]))


def _prints(k: int, w: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            found = winnow_all(texts, k, w)
            size = np.array([len(h) for h, _ in found], np.int64)
            offs = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)]).astype(np.int32)
            flat = [np.concatenate([np.zeros(0, np.int64), *(f[i].astype(np.int64) for f in found)]) for i in (1, 0)]
            items = pa.StructArray.from_arrays([pa.array(x) for x in flat], names=["pos", "hash"])
            keep = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array([len(t) for t in texts], pa.int64()),
                                              pa.ListArray.from_arrays(offs, items).cast(_PRINT)],
                                             names=[*b.schema.names[:-1], "n_chars", "prints"])
    return run


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """The ``keep`` columns of every row with ``n_chars`` (code points) and
    ``prints``, the kept (position, hash) in order of position.  Null and
    empty texts have none; equal texts have equal prints.  Kept columns that
    have the name of a result are left out."""
    prepare(docs.sparkSession)
    rows = docs.select(*[c for c in keep if c not in ("n_chars", "prints")], F.col(text).alias("__text"))
    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_prints(k, w), f"{head}n_chars bigint, prints {PRINT}")


def shared_passages(prints: DataFrame, k: int = K, doc_id: str = "doc_id") -> DataFrame:
    """Passages that documents share with the first document that holds them,
    one row per hash, document and position: ``hash``, ``first_id``,
    ``first_pos``, ``doc_id``, ``pos``.  The first holder is the least (id,
    position), so rows grow with the prints, not with the pairs of holders;
    rows without an id are left out."""
    p = prints.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.explode("prints").alias("p"))
    p = p.select("doc_id", "p.pos", "p.hash")
    first = (p.groupBy("hash").agg(F.min(F.struct("doc_id", "pos")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("hash", F.col("f.doc_id").alias("first_id"), F.col("f.pos").alias("first_pos")))
    out = p.join(first, "hash").where("doc_id <> first_id OR pos <> first_pos")
    return out.select("hash", "first_id", "first_pos", "doc_id", "pos")


class Order:
    """Slots of the order (doc_id, null last, hash of the text): cuts at
    quantiles of the ids.  An id with several cuts, and the null id, is cut
    by hash as well."""

    def __init__(self, cuts: list[int], nulls: int):
        self.cuts, self.nulls = cuts, nulls

    def slot(self, doc_id: int | None, h: int) -> int:
        if doc_id is None:
            lo, several = len(self.cuts) + 1, self.nulls
        else:
            lo = bisect_left(self.cuts, doc_id)
            several = bisect_right(self.cuts, doc_id) - lo + 1
        return lo + (((h + (1 << 63)) * several) >> 64)


def _order(ids: DataFrame) -> Order | None:
    """Cuts for the ids; the driver takes at most ``SLOTS`` of them."""
    n, nulls = ids.agg(F.count(F.lit(1)), F.count_if(F.col("id").isNull())).first()
    if not n:
        return None
    slots = lambda m: max(1, min(SLOTS, -(-m // PER_SLOT)))
    parts = slots(n - nulls)
    cuts = []
    if parts > 1:
        share = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        cuts = ids.agg(F.percentile_approx("id", share, max(10_000, 20 * parts))).first()[0] or []
    return Order(sorted(int(c) for c in cuts), slots(nulls))


def _slots(order: Order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, tuple] = {}
        for b in batches:
            for i, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s, key = order.slot(i, h), (i is None, i or 0, h)
                if s not in first or key < first[s]:
                    first[s] = key
        rows = [(s, None if k[0] else k[1], k[2]) for s, k in first.items()]
        cols = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["slot", "id", "h"])
    return run


def _deal(order: Order, slots: list[int], first: dict[int, tuple]):
    """Rows with their slot, texts compressed; the first row of a slot also
    as a guest of the slot before (the first of all: of the last slot)."""
    before = {s: slots[i - 1] for i, s in enumerate(slots)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            ids, hashes = b.column(0).to_pylist(), b.column(1).to_pylist()
            packed = [z.compress(x or b"") for x in b.column(2).cast(pa.binary()).to_pylist()]
            slot = [order.slot(i, h) for i, h in zip(ids, hashes)]
            rows = list(range(len(ids)))
            guests = [r for r in rows if first[slot[r]] == (ids[r], hashes[r])]
            take = rows + guests
            yield pa.RecordBatch.from_arrays(
                [pa.array([*slot, *(before[slot[r]] for r in guests)], pa.int64()),
                 pa.array([False] * len(rows) + [True] * len(guests), pa.bool_()),
                 pa.array([ids[r] for r in take], pa.int64()), pa.array([hashes[r] for r in take], pa.int64()),
                 pa.array([packed[r] for r in take], pa.binary())], names=["slot", "guest", "id", "h", "packed"])
    return run


OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
       ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the next one."""
    m = len(text) // 4
    return text[:len(text) - m] + following[:m]


def _walk(k: int, w: int):
    def emit(rows: list) -> Iterator[pa.RecordBatch]:
        # rows: (id, text, print) and the row after each
        later = [edited(t, rows[i + 1][1]) for i, (_, t, _) in enumerate(rows[:-1])]
        prints = winnow_all(later, k, w)
        cols = [[] for _ in OUT]
        for i, (new, p) in enumerate(zip(later, prints)):
            doc, text, mine = rows[i]
            digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
            for c, v in zip(cols, (doc, len(text), digest, as_text(mine), as_text(p), likeness(mine[0], p[0]),
                                   likeness(mine[0], rows[i + 1][2][0]))):
                c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, OUT)], names=[n for n, _ in OUT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        held, slot, done = [], None, False  # held: rows of the slot whose next row is not known
        for b in batches:
            at, guests, ids = (b.column(i).to_pylist() for i in range(3))
            packed = b.column(4)
            i = 0
            while i < len(at):
                fresh, size, meta = [], 0, []
                while i < len(at) and size < CHUNK:  # bounded work, however long the texts of a batch
                    if at[i] != slot or not (done and guests[i]):
                        if at[i] != slot:
                            slot, done = at[i], False
                        fresh.append(z.decompress(packed[i].as_py()).decode("utf-8", "surrogatepass"))
                        size += len(fresh[-1])
                        meta.append((at[i], guests[i], ids[i]))
                        done = guests[i]
                    i += 1
                for (_, guest, doc), text, p in zip(meta, fresh, winnow_all(fresh, k, w)):
                    held.append((doc, text, p))
                    if guest:  # the slot ends
                        yield from emit(held)
                        held = []
                if len(held) > 1:
                    yield from emit(held)
                    held = held[-1:]
    return run


def compare_with_next(docs: DataFrame, k: int = K, w: int = W, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_chars``, ``fingerprint``
    of the text, ``edited_sha256`` and ``edited_fingerprint`` of the text whose
    last quarter is replaced by the start of the next document, and the
    likeness of the fingerprint to those of the edited text (``near_edited``)
    and of the next document (``near_next``).

    The next document is that of the next doc_id (ascending, null last; rows
    of one id by the xxhash64 of their text), after the last the first; a
    single document is its own next.  Null texts are empty, have the empty
    fingerprint, and are like other empty ones.  Other columns are left out;
    an empty table gives no rows."""
    spark = docs.sparkSession
    prepare(spark)
    schema = ", ".join(f"{n} {'bigint' if t == pa.int64() else 'double' if t == pa.float64() else 'string'}" for n, t in OUT)
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.xxhash64(t).alias("h"), t.alias("text"))
    order = _order(rows.select("id"))
    if order is None:
        return spark.createDataFrame([], schema)
    found: dict[int, tuple] = {}
    least = rows.select("id", "h").mapInArrow(_slots(order), "slot bigint, id bigint, h bigint")
    least = least.groupBy("slot").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "h")).alias("f"))
    for r in least.collect():  # a row per slot
        found[r.slot] = (r.f.id, r.f.h)
    dealt = rows.mapInArrow(_deal(order, sorted(found), found), "slot bigint, guest boolean, id bigint, h bigint, packed binary")
    return (dealt.repartition("slot").sortWithinPartitions("slot", "guest", F.col("id").asc_nulls_last(), "h", "packed")
            .mapInArrow(_walk(k, w), schema))
