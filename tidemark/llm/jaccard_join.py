"""N-gram Jaccard self join of whole documents in the Jaccard metric space.

The distance of two shingle sets, d = 1 - |x & y| / |x | y|, is a metric.
Documents of one text are one *class*; the join works on classes.

1. **Size pivots.**  Reducing a set to its size is a contraction:
   1 - min/max of two sizes never exceeds d.  Pivots on the size axis at a
   fixed ratio cut it into Voronoi cells; a class is replicated to a lower
   cell if, by the triangle inequality, a partner within eps can lie there.
2. **Slice regions.**  In a cell two linked sets differ in at most D
   shingles.  The hash range of shingles is cut into more than D slices, so a
   linked pair has a slice on which both parts are equal and not empty
   (distance 0 to the same pivot part).  A region is (cell, slice, part).
   A class with too few filled slices for that argument also joins the
   regions of its empty slices.  Of f > D filled slices a linked partner
   shares at least f - D, so a class that meets others in fewer regions of a
   cell has no link there and leaves it (``needs``); texts that only have some
   common passage go before any text is moved.
3. **Document pivots.**  In each region the class of least hash is the pivot.
   Each class is first compared with the least of its pivots; in regions that
   still hold several components the exact distance of every member to the
   pivot is computed.  Members within
   eps of it are linked to it (one component).  The cell of a pivot holds the
   classes that meet it and lie within ``CELL`` of it; by the triangle
   inequality the window up to ``CELL`` + eps is replicated to it, and of its
   ball only members at least as far as the nearest outsider less eps.  A cell
   that still holds several components is joined exactly, in blocks of
   ``BLOCK`` classes, by counting shared shingles; only a forest of the links
   found leaves a task, never all pairs.
4. **Recursion.**  Members of a region beyond ``CELL`` of its pivot form a
   region of their own (one for all regions with the same such members).  Up
   to ``MANY`` classes are joined exactly in blocks like a cell; more are cut
   again into slices under another hash seed and get new pivots.  Every round
   takes at least the pivot out of a region, so it ends, without caps.

Pairs whose classes are already in one component are not compared again.
Shingles and classes are 64-bit hashes; a link is decided by exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .common import Scratch, components, prepare

MANY = 2048
CELL = 0.5
BLOCK = 256
RATIO = 1.6
PER_TASK = 200  # members of a pivot's group that one task compares
TINY = 1e-9
CELL_BITS = 63  # bits of a region key that hold its cell
U = np.uint64


def _as_long(x) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


class Space:
    """Cells, slices and link rule for threshold num / den."""

    def __init__(self, n: int = 4, num: int = 85, den: int = 100):
        if not 0 < num < den:
            raise ValueError("the threshold must lie between 0 and 1")
        self.n, self.num, self.den = n, num, den
        self.tops = [1]

    def top(self, j: int) -> int:
        """Largest size in cell j."""
        while len(self.tops) <= j:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * RATIO)))
        return self.tops[j]

    def cells(self, size: int) -> list[int]:
        """The home cell of a size and the lower cells that partners within
        the threshold can have as home."""
        j = 0
        while self.top(j) < size:
            j += 1
        out = [j]
        least = -(-self.num * size // self.den)
        while j and self.top(j - 1) >= least:
            j -= 1
            out.append(j)
        return out

    def most_apart(self, j: int) -> int:
        """Most shingles in which a linked pair that meets in cell j differs."""
        return (self.den - self.num) * self.top(j) // self.num

    def _slices(self, u: np.ndarray) -> Iterator[tuple]:
        """``(cell, D, number of slices, filled slices, where they start)``."""
        high = u >> U(32)
        for j in self.cells(len(u)):
            d = self.most_apart(j)
            if d == 0:
                continue  # only equal sets link, and they are one class
            k = d + 1 + max(1, d // 8)
            part = (high * U(k)) >> U(32)
            at = np.flatnonzero(part[1:] != part[:-1]) + 1
            at = np.concatenate([np.zeros(1, np.int64), at])
            yield j, d, k, part[at], at

    def regions(self, u: np.ndarray, seed: int = 0) -> np.ndarray:
        """Region keys of a sorted distinct shingle set; the cell is in the
        low bits (``CELL_BITS``)."""
        out = []
        if seed:
            u = np.sort(tx.mix(u ^ tx.mix(np.array([seed], U))))
        for j, d, k, here, at in self._slices(u):
            sums = np.add.reduceat(u, at)
            if len(at) <= d:  # too few filled slices: the empty ones count too
                empty = np.setdiff1d(np.arange(k, dtype=U), here)
                here, sums = np.concatenate([here, empty]), np.concatenate([sums, np.zeros(len(empty), U)])
            out.append(tx.mix(sums ^ tx.mix(here + U(j << 32) + U(1))) & U(~CELL_BITS & (1 << 64) - 1) | U(j & CELL_BITS))
        return np.concatenate(out) if out else np.zeros(0, U)

    def needs(self, u: np.ndarray) -> list[int]:
        """Per cell the fewest regions that a class of this set shares with a
        class linked to it there, times 64, plus the cell.  With too few
        filled slices a partner may share just one."""
        return [max(1, len(at) - d) * (CELL_BITS + 1) + (j & CELL_BITS) for j, d, _, _, at in self._slices(u)]

    def linked(self, inter, a, b):
        return self.den * inter >= self.num * (a + b - inter)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: pairs and groups send them several times."""
    z = zstandard.ZstdCompressor(level=3)
    for b in batches:
        raw = b.column(1).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([z.compress(x) for x in raw], pa.binary())], names=["cls", "text"])


def _unpack(col: pa.Array) -> pa.Array:
    z = zstandard.ZstdDecompressor()
    return pa.array([z.decompress(x) for x in col.to_pylist()], pa.large_binary())


def class_hash(u: np.ndarray) -> int:
    """64-bit hash of a shingle set."""
    both = np.array([u.sum(dtype=U), np.bitwise_xor.reduce(tx.mix(u ^ U(0x5851F42D4C957F2D))), len(u)], U)
    return int(_as_long(tx.mix(tx.mix(both[:1]) * U(3) + both[1:2] + both[2:]))[0])


def _prints(space: Space):
    """(doc_id, text) to (doc_id, set size, class, needs of its cells)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = tx.shingle_sets(b.column(1), space.n)
            rows = [(len(u), class_hash(u), space.needs(u)) if len(u) else (0, None, None) for u in sets]
            n, cls, needs = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                                              pa.array(needs, pa.list_(pa.int64()))],
                                             names=["doc_id", "n_shingles", "cls", "needs"])
    return run


def _class_texts(space: Space):
    """Texts to (class, compressed text), once per class and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            cls, text = [], []
            for i, u in enumerate(tx.shingle_sets(b.column(0), space.n)):
                c = class_hash(u) if len(u) else None
                if c is not None and c not in seen:
                    seen.add(c)
                    cls.append(c)
                    text.append(z.compress(b.column(0)[i].as_py().encode()))
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(text, pa.binary())], names=["cls", "text"])
    return run


def _keys(space: Space):
    """Texts to the region keys of their classes, once per class and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            keys, cls = [], []
            for u in tx.shingle_sets(b.column(0), space.n):
                c = class_hash(u) if len(u) else None
                if c is None or c in seen:
                    continue
                seen.add(c)
                k = space.regions(u)
                keys.append(_as_long(k))
                cls.append(np.full(len(k), c, np.int64))
                if sum(map(len, keys[-64:])) > 1 << 18 or len(keys) >= 512:
                    yield _pair_batch(keys, cls)
                    keys, cls = [], []
            if keys:
                yield _pair_batch(keys, cls)
    return run


def _pair_batch(keys: list, cls: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(cls))], names=["key", "cls"])


def _shared_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (key, cls): the regions of two or more classes as
    (key, cls, pivot); the pivot has the least class hash."""
    key = piv = None
    told = True
    for b in batches:
        k, c = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(k):
            continue
        carried = key is not None
        if carried:
            k, c = np.concatenate([[key], k]), np.concatenate([[piv], c])
        new = np.ones(len(k), bool)
        new[1:] = k[1:] != k[:-1]
        keep = new.copy()
        keep[1:] |= c[1:] != c[:-1]
        k, c, new = k[keep], c[keep], new[keep]
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(k)))
        lead = np.repeat(c[at], size)
        out = np.repeat(size > 1, size)
        if carried and told:
            out[0] = False
        key, piv = k[at[-1]], c[at[-1]]
        told = bool(size[-1] > 1) or (carried and told and len(at) == 1)
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(k[out]), pa.array(c[out]), pa.array(lead[out])],
                                             names=["key", "cls", "pivot"])


def _regions(rows: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    r = (rows.repartition("key").sortWithinPartitions("key", "cls")
         .mapInArrow(_shared_regions, "key bigint, cls bigint, pivot bigint"))
    return scratch.write(r, name)


def _likely(shared: DataFrame, prints: DataFrame) -> DataFrame:
    """The rows of ``shared`` (regions of two or more classes) whose class
    meets others in as many regions of the cell as a link would need."""
    cell = F.col("key").bitwiseAND(F.lit(CELL_BITS).cast("bigint"))
    need = (prints.select("cls", F.explode("needs").alias("need")).distinct()
            .select("cls", F.pmod("need", F.lit(CELL_BITS + 1)).alias("cell"), F.floor(F.col("need") / (CELL_BITS + 1)).alias("need")))
    rows = shared.withColumn("cell", cell)
    met = rows.groupBy("cls", "cell").agg(F.count(F.lit(1)).alias("m"))
    enough = met.join(need, ["cls", "cell"]).where("m >= need").select("cls", "cell")
    return rows.join(enough, ["cls", "cell"], "left_semi").select("key", "cls")


def _distances(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pivot = None, None
        for b in batches:
            g = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            mine = b.column(2).to_pylist()
            out = []
            for i, u in enumerate(tx.shingle_sets(_unpack(b.column(3)), space.n)):
                if mine[i] is None or g[i] != group:
                    if g[i] != group:
                        group, pivot = g[i], None
                    if mine[i] is None:
                        if class_hash(u) == g[i][0]:
                            pivot = u
                        continue
                if pivot is None or class_hash(u) != mine[i]:
                    continue  # another text under the same doc_id
                both = np.sort(np.concatenate([u, pivot]))
                inter = int((both[1:] == both[:-1]).sum())
                out.append((mine[i], g[i][0], len(u), len(pivot), inter))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols],
                                             names=["cls", "pivot", "n", "np", "inter"])
    return run


def _compare(space: Space, pairs: DataFrame, texts: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Exact intersection sizes of class pairs (cls, pivot).  A pivot with
    many partners is dealt over several tasks."""
    salt = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    parts = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PER_TASK).cast("int").alias("parts"))
    # ids first, the text once at the end: a row per pair, and per pivot and part
    members = pairs.join(parts, "pivot").select("pivot", salt.alias("part"), "cls", F.col("cls").alias("of"))
    pivots = parts.select("pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                          F.lit(None).cast("bigint").alias("cls"), F.col("pivot").alias("of"))
    d = (members.unionByName(pivots).join(texts.withColumnRenamed("cls", "of"), "of").select("pivot", "part", "cls", "text")
         .repartition("pivot", "part").sortWithinPartitions("pivot", "part", F.col("cls").asc_nulls_first())
         .mapInArrow(_distances(space), "cls bigint, pivot bigint, n bigint, np bigint, inter bigint"))
    union = F.col("n") + F.col("np") - F.col("inter")
    return scratch.write(d.withColumn("link", space.den * F.col("inter") >= space.num * union)
                         .withColumn("d", 1 - F.col("inter") / union), name)


def _reslice(space: Space, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls = b.column(0).to_pylist()
            sets = list(tx.shingle_sets(_unpack(b.column(1)), space.n))
            keep = [i for i, u in enumerate(sets) if class_hash(u) == cls[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([cls[i] for i in keep], pa.int64()),
                 pa.array([_as_long(space.regions(sets[i], seed)) for i in keep], pa.list_(pa.int64()))],
                names=["cls", "keys"])
    return run


def _group_links(space: Space):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cls = table.column("cls").to_numpy()
        text = table.column("text").chunk(0) if len(table) else pa.array([], pa.binary())
        sets = list(tx.shingle_sets(_unpack(text), space.n))
        right = [i for i, u in enumerate(sets) if class_hash(u) == cls[i]]
        cls, sets = cls[right], [sets[i] for i in right]
        m = len(sets)
        size = np.array([len(u) for u in sets], np.int64)
        owner = np.repeat(np.arange(m), size)
        _, col, count = np.unique(np.concatenate(sets) if m else np.zeros(0, U), return_inverse=True, return_counts=True)
        shared = count > 1
        slot = np.cumsum(shared) - 1
        owner, col = owner[shared[col]], slot[col[shared[col]]]
        order = np.argsort(col, kind="stable")
        owner, col = owner[order], col[order]
        inter = np.zeros((m, m), np.float32)
        for lo in range(0, int(shared.sum()), 4096):
            a, b = np.searchsorted(col, [lo, lo + 4096])
            x = np.zeros((m, 4096), np.float32)
            x[owner[a:b], col[a:b] - lo] = 1
            inter += x @ x.T
        link = space.linked(inter.astype(np.int64), size[:, None], size[None, :]) if m else np.zeros((0, 0), bool)
        label = np.arange(m)
        while m:
            new = np.minimum(label, np.where(link, label[None, :], m).min(axis=1))
            new = new[new]
            if (new == label).all():
                break
            label = new
        out = np.flatnonzero(label != np.arange(m))
        return pa.table({"a": pa.array(cls[out], pa.int64()), "b": pa.array(cls[label[out]], pa.int64())})
    return run


def _join_groups(space: Space, groups: DataFrame, texts: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Links (a, b) that connect whatever is linked inside a group.  A group
    of several blocks is joined block by block pair."""
    own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    task = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                                 lambda j: F.struct(F.least(j, F.col("own")).alias("i"),
                                                    F.greatest(j, F.col("own")).alias("j"))))
    rows = (groups.withColumn("own", own).select("grp", "cls", task.alias("t"))
            .select("grp", "t.i", "t.j", "cls").join(texts, "cls"))
    return scratch.write(rows.groupBy("grp", "i", "j").applyInArrow(_group_links(space), "a bigint, b bigint"), name)


def link_documents(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, text: str = "text",
                   doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``,
    ``component_id`` (smallest doc_id reachable by links, its own included)
    and ``class_id`` (smallest doc_id with the same shingle set).

    Words are runs of anything but ASCII white space, A-Z lower cased.  Null
    and wordless texts have no shingles and no links; exact copies link.  A
    null doc_id takes no part in ids: its row gets the ids of the others of
    its component (null if there are none).  An empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    space = Space(n, num, den)
    eps = (den - num) / den
    s = Scratch(spark, "jaccard")
    base = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    prints = s.write(base.mapInArrow(_prints(space), "doc_id bigint, n_shingles bigint, cls bigint, needs array<bigint>"), "prints")
    # doc_id is null only where no other row of the class has one
    classes = s.write(prints.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("rep")), "classes")
    # the texts are read a second time: keys on disk would be as large as they
    shared = _regions(base.select("text").mapInArrow(_keys(space), "key bigint, cls bigint"), s, "shared")
    s.free()
    region = _regions(_likely(shared, prints), s, "regions0")
    s.drop("shared")
    wanted = region.select("cls").distinct().join(classes, "cls")
    texts = (wanted.join(base.withColumnRenamed("doc_id", "rep"), "rep").where("text IS NOT NULL").select("cls", "text")
             .mapInArrow(_pack, "cls bigint, text binary"))
    # a class all of whose rows lack a doc_id has its text from any of them
    nameless = (base.where("doc_id IS NULL AND text IS NOT NULL").select("text")
                .mapInArrow(_class_texts(space), "cls bigint, text binary")
                .join(wanted.where("rep IS NULL").select("cls"), "cls", "left_semi")
                .groupBy("cls").agg(F.min("text").alias("text")))
    texts = s.write(texts.unionByName(nameless), "texts")
    s.free()
    links, r = None, 0
    while not region.isEmpty():
        # one pivot of each class first: most regions then hold one component
        star = region.where("cls <> pivot").select("cls", "pivot").distinct()
        one = _compare(space, star.groupBy("cls").agg(F.min("pivot").alias("pivot")), texts, s, f"one{r}")
        s.free()
        found = one.where("link").select(F.col("cls").alias("a"), F.col("pivot").alias("b"))
        links = found if links is None else links.unionByName(found)
        root = components(links, s, f"one{r}").select(F.col("node").alias("cls"), "root")
        labelled = region.join(root, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        several = labelled.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key")
        # then all pairs with a pivot in the regions of several components
        region = s.write(region.join(several, "key", "left_semi"), f"mixed{r}")
        s.drop(*([f"regions{r}"] if r else ["regions0"]))
        star = region.where("cls <> pivot").select("cls", "pivot").distinct()
        known = one.join(star, ["cls", "pivot"], "left_semi")
        rest = _compare(space, star.join(one.select("cls", "pivot"), ["cls", "pivot"], "left_anti"), texts, s, f"star{r}")
        s.free()
        dist = known.unionByName(rest)
        links = links.unionByName(rest.where("link").select(F.col("cls").alias("a"), F.col("pivot").alias("b")))
        if dist.where("NOT link").isEmpty():
            break
        comp = components(links, s, f"r{r}")
        root = comp.select(F.col("node").alias("cls"), "root")
        dist = s.write(dist.select("cls", "pivot", "n", "link", "d").join(root, "cls", "left")
                       .withColumn("root", F.coalesce("root", "cls")), f"dist{r}")
        s.drop(f"one{r}", f"star{r}")
        # cells of pivots: outsiders, their window and the ball's rim
        near = dist.where(F.col("d") <= CELL + eps + TINY)
        rim = near.where("NOT link").groupBy("pivot").agg((F.min("d") - eps - TINY).alias("rim"))
        cell = near.join(rim, "pivot").where(F.col("d") >= F.col("rim"))
        several = [F.count(F.lit(1)).alias("m"), F.min("root").alias("r0"), F.max("root").alias("r1")]
        blocks = F.ceil(F.col("m") / BLOCK).cast("int").alias("parts")
        mixed = cell.groupBy("pivot").agg(*several).where("r0 <> r1").select("pivot", blocks)
        cell = cell.join(mixed, "pivot").select(F.xxhash64(F.lit("cell"), "pivot").alias("grp"), "cls", "parts")
        # members beyond the cell of their region's pivot, a region per set of members
        far = s.write(region.where("cls <> pivot").join(dist.where(F.col("d") > CELL), ["cls", "pivot"])
                      .select("key", "cls", "root"), f"far{r}")
        name = [F.bit_xor(F.xxhash64("cls")).alias("x"), F.sum(F.xxhash64(F.lit(1), "cls").cast("decimal(38,0)")).alias("y")]
        size = (far.groupBy("key").agg(*several, *name).where("r0 <> r1")
                .groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key", "m", blocks))
        rest = far.join(size, "key")
        apart = rest.where(F.col("m") <= MANY).select(F.xxhash64(F.lit("far"), "key").alias("grp"), "cls", "parts")
        groups = s.write(cell.unionByName(apart), f"groups{r}")
        s.free()
        links = comp.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(
            _join_groups(space, groups, texts, s, f"found{r}"))
        large = s.write(rest.where(F.col("m") > MANY).select("key", "cls"), f"large{r}")
        s.drop(f"dist{r}", f"far{r}", f"groups{r}", f"mixed{r}")
        if large.isEmpty():
            break
        r += 1
        again = (large.select("cls").distinct().join(texts, "cls").select("cls", "text")
                 .mapInArrow(_reslice(space, r), "cls bigint, keys array<bigint>"))
        region = _regions(large.join(again, "cls")
                          .select(F.explode("keys").alias("sub"), "key", "cls")
                          .select(F.xxhash64("key", "sub").alias("key"), "cls"), s, f"regions{r}")
    if links is None:
        group = classes.select("cls", F.col("rep").alias("class_id"), F.col("rep").alias("component_id"))
    else:
        comp = components(links, s, "all")
        known = (classes.join(comp.withColumnRenamed("node", "cls"), "cls", "left")
                 .withColumn("root", F.coalesce("root", "cls")))
        least = known.groupBy("root").agg(F.min("rep").alias("component_id"))
        group = known.join(least, "root").select("cls", F.col("rep").alias("class_id"), "component_id")
    group = s.write(group, "groups")
    s.drop("texts", "regions0", "mixed0")
    return (prints.select("doc_id", "n_shingles", "cls").join(group, "cls", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("class_id", "doc_id").alias("class_id")))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component,
    with all their columns; rows without words stay.

    Rows without a doc_id come after all others (they are named by 2**62 and a
    hash of their text, which no doc_id should reach): they go if their
    component holds a row with one, else one of them stays."""
    if docs.where("doc_id IS NULL").isEmpty():
        ids = link_documents(docs.select("doc_id", "text"), n, num, den)
        gone = ids.where("doc_id <> component_id").select("doc_id").distinct()
        return docs.join(gone, "doc_id", "left_anti")
    name = "key"
    while name in docs.columns:
        name = f"_{name}"
    nameless = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 3)
    rows = docs.withColumn(name, F.coalesce(F.col("doc_id").cast("bigint"), nameless))
    ids = link_documents(rows.select(name, "text"), n, num, den, doc_id=name)
    rows = rows.join(ids.where("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct(), name, "left_anti")
    worded = F.col("doc_id").isNull() & F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    once = rows.where(worded).dropDuplicates([name])
    return rows.where(~F.coalesce(worded, F.lit(False))).unionByName(once).select(*docs.columns)
