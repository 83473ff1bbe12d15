"""Approximate nearest neighbours by balanced posting lists.

Vectors are grouped by value first: of equal vectors only the ``k`` + 1
smallest ids can be among anyone's k nearest, so a vector that a third of the
rows share is one entry of the index.  Centroids are fitted to a bounded
sample (``sample`` rows with the smallest id hash).  A vector belongs to the
list of its nearest centroid and is replicated to others within ``1 + rim``
of that distance, unless a chosen centroid lies nearer to them than the vector
does.  Centroids are found by best-first search over an in-memory neighbour
graph.  A query reads the lists whose centroid lies within ``1 + reach`` of its
nearest one, but at least its ``fewest`` nearest lists, and further ones until
those it reads own ``enough`` vectors, or all lists are read: a query that is
a centroid itself has no distance to multiply.  Lists are cut into shards of at most about ``shard`` entries and the
queries of a list into parts, so no list is one task.  Scores are exact: the
cosine of the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, prepare


@dataclass(frozen=True)
class Rules:
    k: int = 5
    sample: int = 20_000       # rows that centroids are fitted to
    list_size: int = 200       # aimed entries of a list
    most_lists: int = 2048     # bound of the broadcast centroid table
    rim: float = 0.15
    copies: int = 6            # most lists of a vector, its nearest first
    reach: float = 0.22
    fewest: int = 8            # nearest lists that a query reads at any distance
    enough: int = 400          # vectors that its lists own at least, without copies
    beam: int = 96             # centroids that the graph search expands
    degree: int = 16
    shard: int = 4096
    part: int = 1024


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(x: np.ndarray, n: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Spherical k-means; an empty or tiny cluster is started anew at a member
    of the largest one, which keeps the lists balanced.  The last rounds only
    refit, so that a centroid started late can move to the mean of its members;
    where it keeps none but itself, ``_probed`` reads the lists around."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), n, replace=False)]
    for turn in range(rounds):
        own = np.concatenate([np.argmax(x[i:i + 4096] @ c.T, axis=1) for i in range(0, len(x), 4096)])
        size = np.bincount(own, minlength=n)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        small = np.flatnonzero(size < max(1, len(x) // n // 8))
        for j, big in zip(small if turn < rounds - 3 else (), np.argsort(-size)):
            total[j] = x[rng.choice(np.flatnonzero(own == big))]
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(norm > 0, total / np.where(norm > 0, norm, 1), c)
    return c


class Graph:
    """Neighbour graph over centroids: each is joined to its nearest ones and
    to a few fixed far ones, so that a search reaches every region."""

    def __init__(self, c: np.ndarray, degree: int, beam: int):
        self.c, self.beam = c, min(beam, len(c))
        n = len(c)
        near = np.argsort(-(c @ c.T), axis=1, kind="stable")[:, 1:degree + 1]
        far = (np.arange(n)[:, None] + np.array([n // 2, n // 3, n // 5, n // 7])[None, :]) % n
        self.next = np.concatenate([near, far], axis=1) if n > 1 else np.zeros((1, 1), np.int64)
        self.entry = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(int))

    def search(self, x: np.ndarray) -> np.ndarray:
        """Scores of the centroids seen, -inf for the others (rows x n)."""
        rows = np.arange(len(x))
        seen = np.full((len(x), len(self.c)), -np.inf)
        seen[:, self.entry] = x @ self.c[self.entry].T
        todo = seen.copy()
        for _ in range(self.beam):
            at = np.argmax(todo, axis=1)
            open_ = todo[rows, at] > -np.inf
            if not open_.any():
                break
            todo[rows, at] = -np.inf
            new = self.next[at]
            score = np.einsum("ij,ikj->ik", x, self.c[new])
            fresh = np.isneginf(np.take_along_axis(seen, new, 1))
            for j in range(new.shape[1]):
                r = rows[fresh[:, j] & open_]
                todo[r, new[r, j]] = np.where(np.isneginf(seen[r, new[r, j]]), score[r, j], todo[r, new[r, j]])
                seen[r, new[r, j]] = score[r, j]
        return seen


def _distance(cos):
    return np.sqrt(np.maximum(0.0, 2 - 2 * cos))


def usual_distance(x: np.ndarray, c: np.ndarray) -> float:
    """Tenth percentile of the distances to the nearest centroid."""
    near = [(x[i:i + 4096] @ c.T).max(axis=1) for i in range(0, len(x), 4096)]
    return float(np.quantile(_distance(np.concatenate(near)), 0.1)) if len(x) else 0.0


def choose_lists(graph: Graph, x: np.ndarray, r: Rules, owned: np.ndarray | None = None, usual: float = 0.0) -> list[list[int]]:
    """Lists of each vector (replication) or, given the number of vectors that
    each list owns and a usual distance to the nearest centroid, of each query
    (ratio pruning)."""
    out = []
    between = _distance(graph.c @ graph.c.T)
    for lo in range(0, len(x), 512):
        score = graph.search(x[lo:lo + 512])
        d = np.where(np.isneginf(score), np.inf, _distance(np.where(np.isneginf(score), 0, score)))
        for i, row in enumerate(d):
            order = np.argsort(row, kind="stable")
            if owned is not None:
                out.append(_probed(graph, x[lo + i], row, order, r, owned, usual))
                continue
            order = order[row[order] <= row[order[0]] * (1 + r.rim) + 1e-9]
            mine = [int(order[0])]
            for c in order[1:]:
                if len(mine) >= r.copies:
                    break
                if all(between[c, m] >= row[c] for m in mine):
                    mine.append(int(c))
            out.append(mine)
    return out


def _probed(graph: Graph, x: np.ndarray, row: np.ndarray, order: np.ndarray, r: Rules, owned: np.ndarray, usual: float) -> list[int]:
    """Lists a query reads.  Each vector is owned by one list, so the lists
    hold at least as many vectors as they own together.  A query unusually
    near to a centroid is pruned as if at the usual distance, or that of the
    second centroid if less."""
    wanted = max(r.enough, r.k + 1)

    def least(order: np.ndarray) -> int:
        return max(r.fewest, int(np.searchsorted(np.cumsum(owned[order]), wanted)) + 1)

    n = least(order)
    if not np.isfinite(row[order[:n]]).all():  # beyond what the search has seen
        row = _distance(graph.c @ x)
        order = np.argsort(row, kind="stable")
        n = least(order)
    base = max(row[order[0]], min(usual, row[order[min(1, len(order) - 1)]]))
    near = int((row <= base * (1 + r.reach) + 1e-9).sum())
    return order[:max(n, near)].tolist()


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _assign(centroids: np.ndarray, dim: int, r: Rules, owned: np.ndarray | None = None, usual: float = 0.0):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = Graph(centroids, r.degree, r.beam)
        for b in batches:
            if b.num_rows:
                lists = choose_lists(graph, unit(_matrix(b.column(1), dim)), r, owned, usual)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["cls", "lists"])
    return run


def _scan(dim: int, k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            v = np.concatenate([_matrix(c, dim) for c in left.column("embedding").chunks]).astype(np.float64)
            q = np.concatenate([_matrix(c, dim) for c in right.column("embedding").chunks]).astype(np.float64)
            ids = left.column("ids").to_pylist()
            nv, nq = np.sqrt((v * v).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
            uv = v / nv[:, None]
            for i, name in enumerate(right.column("cls").to_pylist()):
                rough = uv @ (q[i] / nq[i])
                take = min(k + 1, len(rough))
                least = np.partition(rough, len(rough) - take)[len(rough) - take]
                near = np.flatnonzero(rough >= least - 1e-9)
                exact = (v[near] * q[i]).sum(axis=1) / (nv[near] * nq[i])
                found = sorted(((-s, x) for s, j in zip(exact.tolist(), near) for x in ids[j]))[:k + 1]
                out[0].extend([name] * len(found))
                out[1].extend(x for _, x in found)
                out[2].extend(-s for s, _ in found)
        return pa.table({"cls": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})
    return run


def search(vectors: DataFrame, is_query, rules: Rules = Rules()) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the k nearest rows of
    every row for which ``is_query`` (a column over ``vec_id``) holds.

    Rows with a null id, or with a vector that is null, zero, of another
    length than most, or holds a null or non-finite component, take no part.
    Equal rows count as one.  An empty table gives no rows."""
    spark = vectors.sparkSession
    prepare(spark)
    r, s = rules, Scratch(vectors.sparkSession, "ann")
    e = F.col("embedding")
    fine = ~F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists(e, lambda c: c != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), e.cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & e.isNotNull() & fine)
    common = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if common is None:
        return empty
    dim = common["n"]
    rows = rows.where(F.size("embedding") == dim)
    # classes of equal vectors with the smallest ids that can be anyone's neighbours
    nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    kept = rows.distinct().withColumn("nth", nth).where(F.col("nth") <= r.k + 1)
    classes = s.write(kept.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                      .withColumn("cls", F.col("ids")[0]), "classes")
    ask = s.write(rows.where(is_query).select("vec_id", "embedding").distinct()
                  .join(classes.select("cls", "embedding"), "embedding").select("vec_id", "cls"), "queries")
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("cls"), "cls").limit(r.sample).select("embedding")
    x = unit(np.array([row[0] for row in sample.collect()], np.float64).reshape(-1, dim))
    lists = int(max(1, min(r.most_lists, n // r.list_size, len(x))))
    centroids = fit_centroids(x, lists)
    usual = usual_distance(x, centroids)
    placed = s.write(classes.select("cls", "embedding").mapInArrow(_assign(centroids, dim, r), "cls bigint, lists array<int>")
                     .select("cls", F.posexplode("lists").alias("place", "list")), "lists")
    owned = np.zeros(len(centroids), np.int64)
    for row in placed.where("place = 0").groupBy("list").count().collect():  # at most most_lists rows
        owned[row["list"]] = row["count"]
    wanted = s.write(classes.select("cls", "embedding").join(ask.select("cls").distinct(), "cls", "left_semi")
                     .mapInArrow(_assign(centroids, dim, r, owned, usual), "cls bigint, lists array<int>")
                     .select("cls", F.explode("lists").alias("list")), "probes")
    shards = placed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / r.shard).cast("int").alias("shards"))
    parts = wanted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / r.part).cast("int").alias("parts"))
    plan = s.write(shards.join(parts, "list"), "plan")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    post = (placed.join(plan, "list").withColumn("shard", F.pmod(F.xxhash64("cls"), F.col("shards")).cast("int"))
            .withColumn("part", each("parts")).select("cls", "list", "shard", "part")
            .join(classes, "cls").select("list", "shard", "part", "ids", "embedding"))
    again, plan2 = s.read("classes", classes.schema), s.read("plan", plan.schema)
    probe = (wanted.join(plan2, "list").withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
             .withColumn("shard", each("shards")).select("cls", "list", "shard", "part")
             .join(again.select("cls", "embedding"), "cls"))
    key = ["list", "shard", "part"]
    found = (post.groupBy(*key).cogroup(probe.groupBy(*key))
             .applyInArrow(_scan(dim, r.k), "cls bigint, vec_id bigint, score double").distinct())
    order = [F.col("score").desc(), F.col("vec_id")]
    top = found.withColumn("n", F.row_number().over(Window.partitionBy("cls").orderBy(*order))).where(F.col("n") <= r.k + 1)
    near = top.groupBy("cls").agg(F.collect_list(F.struct("score", "vec_id")).alias("near"))
    pairs = (ask.withColumnRenamed("vec_id", "query_id").join(near, "cls").select("query_id", F.explode("near").alias("x"))
             .select("query_id", "x.vec_id", "x.score").where("vec_id <> query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return pairs.withColumn("rank", rank.cast("int")).where(F.col("rank") <= r.k).select("query_id", "rank", "vec_id", "score")
