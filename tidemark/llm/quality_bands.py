"""Quality rules by compression bands.

Repetitive text compresses far better than prose and random text (encoded
binaries, key material) hardly at all.  The zstandard ratio (bytes before /
after) of the whole document must lie inside a band that depends on its
length, since short text always compresses badly and long text better.  The
same holds for fixed chunks of a text longer than one: a document with too
large a share of its bytes in chunks outside the chunk band is rejected although
its whole ratio is fine.  What remains after the last full chunk is a chunk
too, held against the band of its own length.
Cheap base rules (too few words, too many words inside repeated three-word
windows) come first.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .common import prepare

U = np.uint64


@dataclass(frozen=True)
class Bands:
    """Limits by length in bytes: row i holds from ``lengths[i]`` on."""

    lengths: tuple[int, ...] = (0, 128, 256, 512, 1024, 4096, 65536)
    low: tuple[float, ...] = (0.0, 1.0, 1.15, 1.35, 1.5, 1.6, 1.6)
    high: tuple[float, ...] = (2.2, 2.5, 2.6, 2.8, 3.2, 3.6, 4.5)
    chunk: int = 4096
    chunk_low: float = 1.5
    chunk_high: float = 8.0
    chunk_share: float = 0.3
    level: int = 3
    min_words: int = 50
    repeat_percent: int = 50

    def limits(self, n: int) -> tuple[float, float]:
        i = bisect_right(self.lengths, n) - 1
        return self.low[i], self.high[i]


SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
FIELDS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "ratio double, odd_chunks double, band_ok boolean")


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offs])


def _repeated(values: np.ndarray, owner: np.ndarray, first_too: bool) -> np.ndarray:
    """Which values occur more than once for their owner: all of them, or all
    but the first."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    same = np.zeros(len(v), bool)
    same[1:] = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
    if first_too:
        same[:-1] |= same[1:]
    out = np.empty(len(v), bool)
    out[order] = same
    return out


def base_counts(data: np.ndarray, offs: np.ndarray):
    """Per row of a chunk: words, code points in words, symbols, repeated
    lines, words in repeated three-word windows."""
    starts, ends, first = tx.find_words(data, offs)
    rows = len(offs) - 1
    owner = np.repeat(np.arange(rows), np.diff(first))
    lead = ((data & 0xC0) != 0x80) & ~tx._SPACE[data]
    words = tx.span_hashes(data, starts, ends)
    repeat = np.zeros(len(words), bool)
    if len(words) >= 3:
        window = tx.shingle_hashes(words, 3)
        whole = np.flatnonzero(owner[:-2] == owner[2:])
        hit = whole[_repeated(window[whole], owner[whole], True)]
        for j in range(3):
            repeat[hit + j] = True
    # lines: between breaks and row ends
    brk = np.flatnonzero(data == 0x0A)
    # a break at the end of a row opens an empty line at the start of the next
    # one, which counts once; past the last row there is no line
    l0 = np.unique(np.concatenate([offs[:-1], brk + 1]))
    row_of = np.searchsorted(offs, l0, "right") - 1
    ok = row_of < rows
    l0, row_of = l0[ok], row_of[ok]
    nxt = np.searchsorted(brk, l0)
    l1 = np.minimum(np.append(brk, len(data))[nxt], offs[row_of + 1])
    solid = np.searchsorted(starts, l1) > np.searchsorted(starts, l0)
    l0, l1, row_of = l0[solid], l1[solid], row_of[solid]
    again = _repeated(tx.span_hashes(data, l0, l1), row_of, False)
    return (np.diff(first), _per_row(lead, offs), _per_row(SYMBOLS[data], offs),
            np.bincount(row_of[again], minlength=rows), np.bincount(owner[repeat], minlength=rows))


def ratios(raw: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Whole ratio, share of bytes in chunks outside their band, verdict."""
    if not raw:
        return 0.0, 0.0, False
    whole = len(raw) / len(packer.compress(raw))
    odd = 0
    if len(raw) > bands.chunk:
        for k in range(0, len(raw), bands.chunk):
            part = raw[k:k + bands.chunk]
            low, high = (bands.chunk_low, bands.chunk_high) if len(part) == bands.chunk else bands.limits(len(part))
            if not low <= len(part) / len(packer.compress(part)) <= high:
                odd += len(part)
    share = odd / len(raw)
    low, high = bands.limits(len(raw))
    return whole, share, low <= whole <= high and share <= bands.chunk_share


def _judge(bands: Bands, text_too: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
        for b in batches:
            text = b.column(b.num_columns - 1)
            parts: list[list[np.ndarray]] = [[] for _ in range(5)]
            ratio, odd, fine = [], [], []
            for lo, hi, data, offs in tx.text_chunks(text):
                for p, x in zip(parts, base_counts(data, offs)):
                    p.append(x)
                for i in range(hi - lo):
                    r, o, k = ratios(data[offs[i]:offs[i + 1]].tobytes(), bands, packer)
                    ratio.append(r)
                    odd.append(o)
                    fine.append(k)
            cols = [pa.array(np.concatenate(p) if p else np.zeros(0), pa.int64()) for p in parts]
            cols += [pa.array(ratio, pa.float64()), pa.array(odd, pa.float64()), pa.array(fine, pa.bool_())]
            n = b.num_columns - (not text_too)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(n)], *cols],
                                             names=[*b.schema.names[:n], *[x.split()[0] for x in FIELDS.split(", ")]])
    return run


def score(docs: DataFrame, bands: Bands = Bands(), text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of every row with the base counts, the ratios,
    ``base_failed`` and ``kept``.

    Words are runs of anything but ASCII white space; a null or empty text
    has none and fails.  Repeated rows are judged alike, one result each."""
    prepare(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    return _verdict(rows, bands, False)


def _verdict(rows: DataFrame, bands: Bands, text_too: bool) -> DataFrame:
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:None if text_too else -1])
    out = rows.mapInArrow(_judge(bands, text_too), f"{head}, {FIELDS}")
    failed = (F.col("n_words") < bands.min_words) | \
        (100 * F.col("n_repeat_words") > bands.repeat_percent * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & F.col("band_ok"))


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    prepare(docs.sparkSession)
    cols = docs.columns
    # the other columns travel in a struct, so no name can clash
    rest = F.struct(F.lit(0).alias("__any"), *[c for c in cols if c != "text"]).alias("__row")
    rows = docs.select(rest, F.col("text").alias("__text"))
    good = _verdict(rows, bands, True).where("kept")
    return good.select(*[F.col("__text").alias(c) if c == "text" else F.col("__row").getField(c).alias(c) for c in cols])
