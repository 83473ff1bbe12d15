"""Importance resampling of a corpus towards a target distribution.

Word n-grams of a text are hashed into a fixed number of buckets.  The gain of
a bucket is the log ratio of its smoothed shares in the target and in the
corpus; a document weighs the mean gain of its features.  The weight plus
Gumbel noise drawn from the doc_id is the score, and the highest scores are a
sample without replacement in proportion to the weights.

**Length-bucketed CRC matrices.**  The bucket of a feature is the crc32 of its
bytes.  The features of a chunk of texts are made distinct, those of equal
length form a matrix of bytes, and all its CRCs are updated one column at a
time; the buckets are scattered back to the occurrences.

The corpus is read twice: once for the counts, of which every task gives at
most one row a bucket, and once for the weights.  Ranks come from one range
sort of (score, id) rows, written and numbered part by part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .common import Scratch, prepare, running_total

BUCKETS = 10_000
RESULTS = ("n_words", "n_features", "weight", "score", "rank")
LONG = 1024  # features of more bytes are hashed one by one, a matrix of them would have one row
# bytes of words: digits, letters and all of any non-ASCII character
_WORD = np.ones(256, bool)
_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
_INSIDE = _WORD | _WORD[tx.lower_ascii(np.arange(256, dtype=np.uint8))]  # with capitals


def crc_distinct(features: pa.LargeBinaryArray) -> np.ndarray:
    """CRC-32 of each string of bytes, one matrix per length."""
    offs = np.frombuffer(features.buffers()[1], np.int64)[features.offset:features.offset + len(features) + 1]
    data = np.frombuffer(features.buffers()[2] or b"", np.uint8)
    out = np.empty(len(features), np.uint32)
    for n, at in tx.by_length(np.diff(offs)):
        if n > LONG:
            out[at] = [zlib.crc32(data[offs[i]:offs[i + 1]]) for i in at]
        else:
            out[at] = tx.crc_matrix(data[offs[at][:, None] + np.arange(n)])
    return out


def find_words(data: np.ndarray, offs: np.ndarray):
    """Starts and ends of the words of lower-cased rows ``offs``, and the row
    of each word."""
    word = _WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[offs] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | first[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | first[1:-1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offs, starts, "right") - 1


def features(col: pa.Array, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(rows of the words, rows of the features, crc32 of the features)`` by
    chunks; features are runs of 1 to ``order`` words, joined by a blank."""
    carry = np.zeros(0, np.uint8)  # the last order - 1 words of a row that goes on
    for lo, data, offs, on in tx.cut_chunks(col, _INSIDE):
        data, old = tx.lower_ascii(data), 0
        if on and len(carry):
            data = np.concatenate([carry, data])
            offs = np.array([0, len(data)])
        starts, ends, row = find_words(data, offs)
        if on and len(carry):
            old = int(np.searchsorted(starts, len(carry)))
        # the words one blank apart, so that a feature is one span
        size = ends - starts
        to = np.concatenate([np.zeros(1, np.int64), np.cumsum(size + 1)])
        joined = np.full(to[-1], 32, np.uint8)
        words = np.repeat(starts - to[:-1], size) + (at := np.repeat(to[:-1] - (np.cumsum(size) - size), size) + np.arange(size.sum()))
        joined[at] = data[words]
        rows, crcs = [], []
        for k in range(1, order + 1):
            last = np.arange(max(old, k - 1), len(starts))
            last = last[row[last] == row[last - k + 1]]
            if not len(last):
                continue
            found = tx.take_spans(joined, to[last - k + 1], to[last] + size[last]).dictionary_encode()
            crcs.append(crc_distinct(found.dictionary)[found.indices.to_numpy()])
            rows.append(row[last])
        keep = order - 1
        carry = joined[to[max(0, len(starts) - keep)]:] if keep else carry
        none = np.zeros(0, np.int64)
        yield lo + row[old:], lo + np.concatenate([none, *rows]), np.concatenate([none.astype(np.uint32), *crcs])


def _count(order: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, crc in features(b.column(0), order):
                n += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], names=["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, text: str = "text", order: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Rows ``(bucket, n)``: features of all texts by bucket (empty ones left out)."""
    counted = texts.select(F.col(text)).mapInArrow(_count(order, buckets), "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares) per bucket.  The driver
    takes at most one row per bucket."""
    n = np.zeros((2, buckets))
    both = corpus.select("bucket", "n", F.lit(0).alias("side")).unionByName(target.select("bucket", "n", F.lit(1).alias("side")))
    sums = both.groupBy("bucket").pivot("side", [0, 1]).agg(F.sum("n")).select("bucket", F.col("0").alias("s"), F.col("1").alias("t"))
    for r in sums.collect():
        n[0, r.bucket], n[1, r.bucket] = r.s or 0, r.t or 0
    all_s, all_t = n.sum(axis=1) + buckets
    return np.array([math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t))) for s, t in n.T], np.int64)


def _weigh(order: int, gain: np.ndarray):
    buckets = np.uint32(len(gain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, feats, total = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for of_word, of_feature, crc in features(b.column(b.num_columns - 1), order):
                np.add.at(words, of_word, 1)
                np.add.at(feats, of_feature, 1)
                np.add.at(total, of_feature, gain[crc % buckets])
            weight = np.where(feats > 0, total // np.maximum(feats, 1), 0)
            keep = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*keep, *(pa.array(x, pa.int64()) for x in (words, feats, weight))],
                                             names=[*b.schema.names[:-1], "n_words", "n_features", "weight"])
    return run


def weigh(docs: DataFrame, target: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", order: int = 1,
          buckets: int = BUCKETS) -> DataFrame:
    """The ``keep`` columns of every row of ``docs`` with ``n_words``,
    ``n_features`` and ``weight``, the floored mean of the gains of the row's
    features (0 for a text without words, or null).

    Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``, A-Z lower
    cased.  ``target`` is a table with a column of the same name; where it or
    ``docs`` is empty its shares are even.  Kept columns that have the name of
    a result are left out.  Repeated rows count, and come back, as often."""
    prepare(docs.sparkSession)
    gain = gains(bucket_counts(docs, text, order, buckets), bucket_counts(target, text, order, buckets), buckets)
    rows = docs.select(*[c for c in keep if c not in RESULTS], F.col(text).alias("__text"))
    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_weigh(order, gain), f"{head}n_words bigint, n_features bigint, weight bigint")


def gumbel(seed: str, doc_id: Column) -> Column:
    """floor(1000 times Gumbel noise) from the hash of ``<seed>:<doc_id>``; a
    null doc_id counts as empty text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000.0 * F.ln(-F.ln((h.cast("double") + 0.5) / 4294967296.0)))


def draw(weighed: DataFrame, share: tuple[int, int] = (10, 100), min_words: int = 20, seed: str = "2024",
         doc_id: str = "doc_id") -> DataFrame:
    """Adds ``score`` and ``rank`` to ``weigh`` rows.  Of the rows of at least
    ``min_words`` words the floor of ``share`` of them with the highest scores
    have ranks from 1 on (ties: smaller doc_id, null last, then fewer
    features); the rank of all others is null.  The result is written to the
    shared folder."""
    s = Scratch(weighed.sparkSession, "resample")
    number, of = share
    rows = weighed.withColumn("score", F.col("weight") + gumbel(seed, F.col(doc_id)))
    order = [F.col("n_words") < min_words, F.col("score").desc(), F.col(doc_id).asc_nulls_last(), F.col("n_features"), F.col("weight")]
    rows = s.write(rows.orderBy(*order).withColumn("__part", F.spark_partition_id()), "sorted")
    drawn = rows.where(F.col("n_words") >= min_words).count() * number // of
    rows = running_total(rows, [], F.col("__part"), order, F.lit(1), "__ahead")
    return rows.withColumn("rank", F.when(F.col("__ahead") < drawn, F.col("__ahead") + 1)).drop("__part", "__ahead")


def resample(docs: DataFrame, target: DataFrame, keep: tuple[str, ...] = ("doc_id",), order: int = 1, buckets: int = BUCKETS,
             share: tuple[int, int] = (10, 100), min_words: int = 20, seed: str = "2024") -> DataFrame:
    """``draw`` of ``weigh``: every row of ``docs`` with its rank in the
    sample; ``keep`` with all columns of ``docs`` gives whole rows."""
    keep = ("doc_id", *[c for c in keep if c != "doc_id"])
    return draw(weigh(docs, target, keep, order=order, buckets=buckets), share, min_words, seed)
