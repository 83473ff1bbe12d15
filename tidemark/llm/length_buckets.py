"""Packing by optimal length buckets.

Texts are counted in words and cut into pieces of at most ``max_len`` words,
so the global histogram of piece lengths has at most ``max_len`` rows and may
go to the driver.  Dynamic programming over it chooses ``buckets`` boundaries
that minimise the padding of all pieces to their bucket's boundary.  Inside a
bucket of boundary L a batch takes floor(budget / L) pieces, numbered
exactly over hash slots, so a bucket with any share of the rows is no task
of its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, n_words, prepare, running_total, slots_for


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Boundaries (the largest length last) with the least total padding.

    cost(i, j) of one bucket over the sorted lengths i..j is
    length[j] * count(i..j) - words(i..j); best[b][j] is the least cost of the
    first j lengths in b buckets."""
    if not lengths:
        return []
    order = np.argsort(lengths)
    x = np.asarray(lengths, np.float64)[order]
    c = np.asarray(counts, np.float64)[order]
    n = len(x)
    num = np.concatenate([[0.0], np.cumsum(c)])
    words = np.concatenate([[0.0], np.cumsum(c * x)])
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cuts = []
    for _ in range(min(buckets, n)):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0.0
        for j in range(1, n + 1):
            cost = best[:j] + x[j - 1] * (num[j] - num[:j]) - (words[j] - words[:j])
            cut[j] = int(np.argmin(cost))
            new[j] = cost[cut[j]]
        cuts.append(cut)
        best = new
    out, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        out.append(int(x[j - 1]))
        j = int(cut[j])
    return out[::-1]


def pack(docs: DataFrame, max_len: int = 2048, buckets: int = 16, budget: int = 16384, text: str = "text",
         doc_id: str = "doc_id", length: Column | None = None) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece`` (from 0), ``start`` (first
    word), ``n_tokens``, ``bucket_len``, ``batch_id`` (``<bucket_len>-<n>``),
    ``slot`` (place in the batch) and ``padding``.

    Every word of every text is in exactly one piece; null, empty and
    wordless texts have none.  Repeated rows are packed as often as they
    occur; a null doc_id is packed like any other.  Within a bucket pieces
    are ordered by a hash of (doc_id, piece)."""
    if not 0 < max_len <= budget:
        raise ValueError("max_len must lie between 1 and the token budget")
    spark = docs.sparkSession
    prepare(spark)
    s = Scratch(spark, "pack")
    sized = docs.select(F.col(doc_id).alias("doc_id"), (length if length is not None else n_words(text)).alias("words"))
    cut = F.explode(F.sequence(F.lit(0), F.floor((F.col("words") - 1) / max_len).cast("int")))
    pieces = sized.where("words > 0").withColumn("piece", cut)
    pieces = pieces.select("doc_id", "piece", (F.col("piece") * max_len).cast("bigint").alias("start"),
                           F.least(F.lit(max_len), F.col("words") - F.col("piece") * max_len).cast("int").alias("n_tokens"))
    pieces = s.write(pieces, "pieces")
    hist = pieces.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()  # at most max_len rows
    tops = boundaries([r[0] for r in hist], [r[1] for r in hist], buckets)
    if not tops:
        return pieces.select("doc_id", "piece", "start", "n_tokens", F.lit(0).alias("bucket_len"),
                             F.lit("").alias("batch_id"), F.lit(0).cast("bigint").alias("slot"), F.lit(0).alias("padding"))
    top = F.lit(tops[-1])
    for t in reversed(tops[:-1]):
        top = F.when(F.col("n_tokens") <= t, F.lit(t)).otherwise(top)
    rows = pieces.withColumn("bucket_len", top).withColumn("__h", F.xxhash64("doc_id", "piece"))
    slots = slots_for(sum(r[1] for r in hist))
    low = F.lit(-(1 << 63)).cast("decimal(20,0)")
    slot = F.floor((F.col("__h").cast("decimal(20,0)") - low).cast("double") / float(1 << 64) * slots)
    slot = F.least(slot, F.lit(slots - 1)).cast("int")
    order = [F.col("__h"), F.col("doc_id").asc_nulls_last(), F.col("piece"), F.col("n_tokens")]
    rows = running_total(rows, ["bucket_len"], slot, order, F.lit(1), "__at")
    per = F.floor(F.lit(budget) / F.col("bucket_len"))
    return rows.select("doc_id", "piece", "start", "n_tokens", "bucket_len",
                       F.concat_ws("-", F.col("bucket_len").cast("string"),
                                   F.floor(F.col("__at") / per).cast("string")).alias("batch_id"),
                       (F.col("__at") % per).cast("bigint").alias("slot"),
                       (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
