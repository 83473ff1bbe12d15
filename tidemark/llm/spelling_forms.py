"""Spelling variants: words one edit apart, grouped under the commonest form.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  With p code points of common prefix and q of common suffix
that is p + q >= length of the longer word - 1.

**Tiles.**  A word of length L is cut into ``pieces(L)`` parts.  One edit
falls into one part and leaves the others alone, so near words agree on all
parts but one: a tile holds the words (of length L, or L + 1 for the longer
one of an insertion) that agree on all parts but the s-th.  The words of a
tile become padded code-point matrices, aligned left and right, and blocks of
them are compared column by column for common prefixes and suffixes.  A pair
counts in the tile of the part in which its common prefix ends, so in exactly
one.  Tiles of more than ``TILE`` words, or ``CHARS`` code points, are dealt to
tasks as pairs of blocks; what leaves a task is one row per word, never a row
per pair.

**Forms.**  A word's form is its near word of largest count (ties: first in
code-point order) if that count is at least ``ratio`` times its own.  Counts
grow along forms, so following them ends; it is done by pointer doubling.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .common import Scratch, prepare

# words are runs of [A-Za-z\u00C0-\u00FF]
_ASCII = np.zeros(256, bool)
_ASCII[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_INSIDE = _ASCII.copy()  # bytes at which no chunk may start
_INSIDE[[0xC3, *range(0x80, 0xC0)]] = True
LONG = 1024           # words of more bytes are hashed one by one
MERGE = 1 << 18       # counted words a task holds before it merges them
PIECES = (3, 8)       # least and most parts of a word
TILE = 512            # words of a block
CHARS = 1 << 20       # code points of a block
CELLS = 1 << 22       # cells of a matrix, or of a comparison, at a time
SMALL = 32            # tiles up to this size are compared many at once


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to code points of the words: ASCII letters, and the
    two bytes of U+00C0 to U+00FF (C3 and what follows it)."""
    out = _ASCII[data]
    lead = data == 0xC3
    out |= lead
    out[1:] |= lead[:-1]
    return out


def _words(data: np.ndarray, offs: np.ndarray, ids: list[bytes], every: int, min_length: int) -> pa.Array:
    """The words of the rows ``offs`` of a chunk, as Arrow strings of bytes."""
    data = tx.lower_ascii(data)
    solid = _letters(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    wide = np.concatenate([np.zeros(1, np.int64), np.cumsum(data == 0xC3)])
    size = ends - starts - (wide[ends] - wide[starts])  # code points
    keep = size >= min_length
    starts, ends, size = starts[keep], ends[keep], size[keep]
    if not every or not len(starts):
        return tx.take_spans(data, starts, ends)
    prefix = np.array([zlib.crc32(i + b":") for i in ids], np.uint32)
    prefix = prefix[np.searchsorted(offs, starts, "right") - 1]
    h = np.empty(len(starts), np.uint32)
    for n, at in tx.by_length(ends - starts):
        if n > LONG:
            h[at] = [zlib.crc32(data[starts[i]:ends[i]], int(prefix[i])) for i in at]
        else:
            h[at] = tx.crc_matrix(data[starts[at][:, None] + np.arange(n)], prefix[at])
    hit = h % np.uint32(every) == 0
    changed = []
    for i in np.flatnonzero(hit & (size > min_length)):
        word, at = data[starts[i]:ends[i]].tobytes().decode(), int(h[i] % size[i])
        changed.append((word[:at] + word[at + 1:]).encode())
    return pa.concat_arrays([tx.take_spans(data, starts[~hit], ends[~hit]), pa.array(changed, pa.large_binary())])


def _counts(every: int, min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, counted = [(i or "").encode() for i in b.column(0).to_pylist()], []
            for lo, data, offs, _ in tx.cut_chunks(b.column(1), _INSIDE):
                c = _words(data, offs, ids[lo:lo + len(offs) - 1], every, min_length).value_counts()
                counted.append(pa.table({"word": c.field("values"), "n": c.field("counts")}))
                if sum(map(len, counted)) > MERGE:
                    counted = [_merged(counted)]
                    if len(counted[0]) > MERGE // 2:
                        yield from _as_words(counted.pop())
            if counted:
                yield from _as_words(_merged(counted))
    return run


def _merged(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
    return pa.table({"word": t.column("word"), "n": t.column("n_sum")})


def _as_words(t: pa.Table) -> Iterator[pa.RecordBatch]:
    return iter(pa.table({"word": t.column("word").cast(pa.large_string()).cast(pa.string()), "n": t.column("n")}).to_batches(10_000))


def count_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", every: int = 97, min_length: int = 5,
               min_count: int = 3) -> DataFrame:
    """Rows ``(word, n)``: the words of whole texts with their occurrences.

    Words are maximal runs of ``[A-Za-z\u00C0-\u00FF]``, A-Z lower cased.  If ``every`` divides
    the crc32 of ``<doc_id>:<word>`` (a null doc_id counts as empty text), the
    code point at crc32 mod length goes; ``every`` 0 leaves all words alone.
    Words of under ``min_length`` code points or ``min_count`` occurrences are
    no words here.  Null and empty texts have none.  Tasks count by chunk, so
    the shuffle holds a row per distinct word of a batch, not per occurrence."""
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    return (rows.mapInArrow(_counts(every, min_length), "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def pieces(length):
    """Number of parts of a word of that length (int or column)."""
    least, most = PIECES
    if isinstance(length, Column):
        return F.greatest(F.lit(least), F.least(F.lit(most), F.ceil(length / 3).cast("int")))
    return max(least, min(most, -(-length // 3)))


def _tiles(words: DataFrame, min_length: int) -> DataFrame:
    """A row per word and tile: ``tile, size, part, word, n``."""
    w, size = F.col("word"), F.col("size")
    sizes = F.filter(F.array(F.length("word"), F.length("word") - 1), lambda x: x >= min_length)
    r = (words.where(F.length("word") >= min_length)
         .select("word", "n", F.explode(sizes).alias("size")).withColumn("k", pieces(size))
         .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("k") - 1))))
    start = F.floor(F.col("part") * size / F.col("k")).cast("int")
    rest = size - F.floor((F.col("part") + 1) * size / F.col("k")).cast("int")
    ends = F.xxhash64(size, "part", F.substring(w, F.lit(1), start), F.when(rest > 0, F.right(w, rest)).otherwise(F.lit("")))
    return r.select(ends.alias("tile"), "size", "part", "word", "n")


def _blocks(rows: DataFrame) -> DataFrame:
    """Tiles of two words and more, the large ones as pairs of blocks
    ``(i, j)`` that one task compares; ``own`` is the block of a word."""
    key = ["tile", "size", "part"]
    sums = (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("m"), F.sum(F.length("word")).alias("chars")).where("m > 1")
            .select(*key, F.greatest(F.ceil(F.col("m") / TILE), F.ceil(F.col("chars") / CHARS)).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64(F.lit(1), "word"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j")))
    return (rows.join(sums, key).withColumn("own", own).withColumn("b", F.explode(pairs))
            .select(*key, "b.i", "b.j", "own", "word", "n"))


def common_run(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the common start of code-point columns ``left[c]`` and
    ``right[c]``, whose other axes broadcast against each other."""
    alive = left[0] == right[0]
    out = alive.astype(np.int32)
    for c in range(1, len(left)):
        alive &= left[c] == right[c]
        if not alive.any():
            break
        out += alive
    return out


def matrices(words: list[str], size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Padded code-point matrices (columns first), read from the start and
    from the end of the words."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), size)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    col = np.arange(len(flat)) - first[row]
    head = np.zeros((width, len(words)), np.uint32)
    tail = np.zeros((width, len(words)), np.uint32)
    head[col, row] = flat
    tail[size[row] - 1 - col, row] = flat
    return head, tail


def _near(head, tail, a, b, size, length, part):
    """Of the candidate comparison ``a`` x ``b`` (index arrays that
    broadcast), which are one edit apart and belong to this tile."""
    p = common_run(head[:, a], head[:, b])
    q = common_run(tail[:, a], tail[:, b])
    longer, shorter = np.maximum(size[a], size[b]), np.minimum(size[a], size[b])
    k = pieces(length)
    lo, hi = part * length // k, (part + 1) * length // k
    here = (p >= lo) & ((p < hi) | (part == k - 1))
    return (p + q >= longer - 1) & (shorter == length) & here


def compare_tiles(words: list[str], size: np.ndarray, n: np.ndarray, length: int, part: np.ndarray, group: np.ndarray,
                  own: np.ndarray, cross: np.ndarray):
    """Near pairs inside groups of rows of one shorter length: index arrays
    (a, b).  Rows of a group are adjacent; in ``cross`` groups only rows of
    different blocks are compared."""
    head, tail = matrices(words, size, length + 1)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    count = np.diff(np.append(starts, len(group)))
    found = []
    small = np.flatnonzero(np.repeat(count <= SMALL, count))
    if len(small):
        widest = int(count[count <= SMALL].max())
        g = group[small]
        for shift in range(1, widest):
            same = np.flatnonzero(g[shift:] == g[:-shift])
            if not len(same):
                break
            a, b = small[same], small[same + shift]
            keep = ~cross[a] | (own[a] != own[b])
            a, b = a[keep], b[keep]
            if len(a):
                hit = _near(head, tail, a, b, size, length, part[a])
                found.append((a[hit], b[hit]))
    for at, m in zip(starts[count > SMALL], count[count > SMALL]):
        rows = np.arange(at, at + m)
        step = max(1, CELLS // (int(m) * 8))
        for lo in range(0, int(m), step):
            a, b = rows[lo:lo + step, None], rows[None, :]
            hit = _near(head, tail, a, b, size, length, int(part[at])) & (a < b)
            if cross[at]:
                hit &= own[a] != own[b]
            i, j = np.nonzero(hit)
            found.append((rows[lo + i], rows[j]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _summaries(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Near words of whole tiles: per word their number and the best one."""
    table = table.combine_chunks()
    num = {c: table.column(c).to_numpy() for c in ("tile", "size", "part", "i", "j", "own", "n")}
    new = np.zeros(len(table), bool)
    for c in ("tile", "size", "part", "i", "j"):
        new[1:] |= num[c][1:] != num[c][:-1]
    group = np.cumsum(new)
    text = table.column("word").to_pylist()
    size = np.fromiter(map(len, text), np.int64, len(text))
    lo = 0
    while lo < len(text):
        length = int(num["size"][lo])
        hi = lo + int(np.searchsorted(num["size"][lo:], length, "right"))
        most = lo + max(1, CELLS // (length + 1))
        if most < hi:  # cut where a group starts
            hi = max(int(np.searchsorted(group, group[most])), int(np.searchsorted(group, group[lo], "right")))
        s = slice(lo, hi)
        words, n = text[s], num["n"][s]
        a, b = compare_tiles(words, size[s], n, length, num["part"][s], group[s], num["own"][s], num["i"][s] != num["j"][s])
        if len(a):
            x, y = np.concatenate([a, b]), np.concatenate([b, a])
            used = np.unique(y)
            rank = np.empty(len(words), np.int64)
            rank[sorted(used.tolist(), key=words.__getitem__)] = np.arange(len(used))
            order = np.lexsort((rank[y], -n[y], x))
            x, y = x[order], y[order]
            first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            near = np.diff(np.append(first, len(x)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[i] for i in x[first]], pa.string()), pa.array(near, pa.int64()), pa.array(n[y[first]], pa.int64()),
                 pa.array([words[i] for i in y[first]], pa.string())], names=["word", "near", "best_n", "best"])
        lo = hi


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of tiles to summaries; an unfinished tile waits for the
    next batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = [b.column(b.schema.get_field_index(c)).to_numpy() for c in ("tile", "size", "part", "i", "j")]
        turn = np.zeros(b.num_rows, bool)
        for k in keys:
            turn[1:] |= k[1:] != k[:-1]
        now = tuple(int(k[0]) for k in keys)
        if held and now != last:
            yield from _summaries(pa.Table.from_batches(held))
            held = []
        at = np.flatnonzero(turn)
        if len(at):
            cut = int(at[-1])
            yield from _summaries(pa.Table.from_batches([*held, b.slice(0, cut)]))
            held = []
            b = b.slice(cut)
        held.append(b)
        last = tuple(int(k[-1]) for k in keys)
    if held:
        yield from _summaries(pa.Table.from_batches(held))


def near_words(words: DataFrame, min_length: int = 5) -> DataFrame:
    """For ``words(word, n)`` of distinct words: rows ``(word, n_near,
    best, best_n)`` of those that have near words of at least ``min_length``
    code points."""
    rows = (_blocks(_tiles(words, min_length)).repartition("tile", "i", "j")
            .sortWithinPartitions("size", "tile", "part", "i", "j")
            .mapInArrow(_compare, "word string, near bigint, best_n bigint, best string"))
    return (rows.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("x"))
            .select("word", "n_near", "x.best", (-F.col("x.m")).alias("best_n")))


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """The last form of each word of ``forms(word, form)``, by doubling."""
    cur, k = scratch.write(forms.select("word", F.col("form").alias("root")), "root0"), 0
    while True:
        step = cur.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        nxt = scratch.write(cur.join(step, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"),
                                                                  F.col("beyond").isNotNull().alias("moved")), f"root{k + 1}")
        scratch.drop(f"root{k}")
        k += 1
        cur = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return cur


def group_variants(words: DataFrame, ratio: int = 2, min_length: int = 5) -> DataFrame:
    """Forms and roots of ``words(word, n)``, one row per distinct word.

    Rows ``(word, n, n_near, form, form_n, root)``: ``form`` and ``form_n``
    are null for a word without a near word that is ``ratio`` times as common;
    ``root`` is then the word itself.  Null words and words of under
    ``min_length`` code points have no row; other columns are left out; an
    empty table gives no rows."""
    spark = words.sparkSession
    prepare(spark)
    s = Scratch(spark, "spelling")
    known = s.write(words.where(F.length("word") >= min_length).select("word", F.col("n").cast("bigint").alias("n")), "words")
    near = known.join(near_words(known, min_length), "word", "left")
    formed = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    near = s.write(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                               F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "near")
    root = _roots(near.where("form IS NOT NULL").select("word", "form"), s)
    return near.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", every: int = 97) -> DataFrame:
    """``group_variants`` of the words of whole texts (see ``count_runs``)."""
    prepare(docs.sparkSession)
    return group_variants(count_runs(docs, text, doc_id, every))
