"""Tables of one row per key, changed at the price of the batch.

A table is a set of immutable *pieces* (folders of Parquet files that one task
wrote), and a manifest that lists the live ones with their rows and the range
of their key hashes.  Beside every piece lies a blocked Bloom filter of its key
hashes, as bitmaps of 4 KiB.  A change finds the pieces that may hold a key of
the batch by range and filter, reads the key columns of those to be sure, and
rewrites only pieces that do hold one.  New rows go into pieces of their own;
small pieces are folded into the next batch of their size, so a row is
rewritten a number of times that grows with the logarithm of the table.

A commit is one rename of a small file that names the new manifest.  Readers
see the state before or after it, never a part; a writer that dies before the
rename has changed nothing, and of two writers at once the second is refused.
Old pieces stay readable until ``vacuum``.  Keys compare null-safe.

The driver holds the manifest: one row per piece of up to ``rows_per_piece``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits
from .session import ensure_checkpoint_dir

BITS = 32_768          # of a bitmap, the size of Spark's bitmap functions
BITS_PER_KEY = 10
PROBES = 4             # bits per key, all in one bitmap: about 1.5 % false hits
PREFIX = 52            # hashes meet ranges by their upper 12 bits
FOLD = 2               # pieces of up to so many times the batch's rows are folded
MANIFEST = "piece string, rows bigint, lo bigint, hi bigint, segs int"


class Conflict(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class Change:
    """What a commit did: rows of the batch that took effect, and the rows
    and number of the pieces it rewrote."""

    version: int
    applied: int
    rewritten_rows: int
    rewritten_pieces: int


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], rows_per_piece: int = 1_000_000):
        ensure_checkpoint_dir(spark)
        self.spark, self.path, self.keys, self.rows = spark, path.rstrip("/"), list(keys), rows_per_piece

    # ---- state ---------------------------------------------------------------

    def version(self) -> int:
        """Number of the last commit, 0 for a table without one."""
        if not commits.exists(self.spark, f"{self.path}/commits"):
            return 0
        fs, folder = commits._fs(self.spark, self.path), commits._path(self.spark, f"{self.path}/commits")
        return max((int(n) for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.isdigit()), default=0)

    def manifest(self, version: int | None = None) -> list:
        """The live pieces of a version (default: the last)."""
        v = self.version() if version is None else version
        if v == 0:
            return []
        name = self.spark.read.text(f"{self.path}/commits/{v}").first()[0]
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/{name}").collect()

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, or None where there is none yet."""
        v = self.version() if version is None else version
        return self._rows([p.piece for p in self.manifest(v)]) if v else None

    def _schema(self):
        return self.spark.read.parquet(f"{self.path}/schema").schema

    def _rows(self, pieces: list[str]) -> DataFrame:
        if not pieces:
            return self.spark.createDataFrame([], self._schema())
        return self.spark.read.schema(self._schema()).parquet(*[f"{self.path}/pieces/{p}" for p in pieces])

    # ---- keys ----------------------------------------------------------------

    def hash(self) -> Column:
        return F.xxhash64(*[c for k in self.keys for c in (F.col(k), F.col(k).isNull())])

    def _same(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Join on the keys, nulls equal; ``right`` holds distinct keys.  Both
        sides grow with the batch, whose size on disk hides that in memory, so
        they meet by shuffle."""
        r = right.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)],
                         *[F.col(c).alias(f"__new_{c}") for c in right.columns if c not in self.keys])
        cond = F.lit(True)
        for i, k in enumerate(self.keys):
            cond = cond & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        return left.join(r.hint("merge"), cond, how)

    @staticmethod
    def _probe(h: Column, segs: Column) -> tuple[Column, list[Column]]:
        """Bitmap of a hash and the bits it has there."""
        return F.pmod(F.xxhash64(F.lit(1), h), segs).cast("int"), [
            F.pmod(F.xxhash64(F.lit(j + 2), h), F.lit(BITS)).cast("int") for j in range(PROBES)]

    def _holding(self, batch: DataFrame, live: list) -> list[str]:
        """The pieces that hold a key of ``batch``."""
        if not live:
            return []
        h, lo, hi = (F.shiftright(c, PREFIX) for c in ("h", "lo", "hi"))
        pieces = self.spark.createDataFrame(live, MANIFEST).withColumn("prefix", F.explode(F.sequence(lo, hi)))
        asked = batch.select(self.hash().alias("h")).distinct().withColumn("prefix", h)
        near = asked.join(F.broadcast(pieces), "prefix").where("h BETWEEN lo AND hi")  # the manifest is the driver's already
        seg, bits = self._probe(F.col("h"), F.col("segs"))
        near = near.select("piece", seg.alias("seg"), F.array(*bits).alias("asked"))
        versions = sorted({p.piece.split("/")[0] for p in live})
        filters = self.spark.read.parquet(*[f"{self.path}/filters/{v}" for v in versions])
        byte = lambda b: F.conv(F.hex(F.substring("bits", (b / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
        may = near.join(filters.hint("merge"), ["piece", "seg"]).where(F.forall("asked", lambda b: F.getbit(byte(b), b % 8) == 1))
        maybe = [r.piece for r in may.select("piece").distinct().collect()]
        if not maybe:
            return []
        stored = self._rows(maybe).select(*self.keys, _piece().alias("__piece"))
        return [r[0] for r in self._same(stored, batch.select(*self.keys), "left_semi").select("__piece").distinct().collect()]

    # ---- changes -------------------------------------------------------------

    def upsert(self, batch: DataFrame, order: str | None = None, newer_by: str | None = None) -> Change:
        """Each key of the batch has the batch's row from now on: of several
        the one with the greatest ``order``.  With ``newer_by`` a stored row
        that is greater in that column stays.  A batch applied again gives
        the same table."""
        last = self._distinct(batch, order or newer_by, F.max_by)
        v, live = self._start(last)
        n = last.count()
        if not n:
            return Change(v, 0, 0, 0)
        hit = self._holding(last, live)
        if newer_by and hit:
            kept = self._same(self._rows(hit), last.select(*self.keys), "left_semi")
            last = _staged(self._distinct(kept.unionByName(last), newer_by, F.max_by, stage=False))
        fold = self._small(live, n, set(hit))
        big, small = [p for p in hit if p not in fold], sorted(fold)
        rest = lambda ps: self._same(self._rows(ps), last.select(*self.keys), "left_anti")
        pool = last.unionByName(rest(small)) if small else last
        home = rest(big).withColumn("__home", _piece()) if big else None
        return self._commit(v, live, {*big, *small}, home, pool, n + sum(p.rows for p in live if p.piece in fold), n)

    def insert_new(self, batch: DataFrame, order: str | None = None) -> Change:
        """Rows of keys the table never had; of several of a key the one with
        the least ``order``.  Stored rows stay, whatever copies come later."""
        first = self._distinct(batch, order, F.min_by)
        v, live = self._start(first)
        hit = self._holding(first, live)
        if hit:
            first = _staged(self._same(first, self._rows(hit).select(*self.keys).distinct(), "left_anti"))
        n = first.count()
        if not n and v:
            return Change(v, 0, 0, 0)
        fold = self._small(live, n, set())
        pool = first.unionByName(self._rows(sorted(fold))) if fold else first
        return self._commit(v, live, fold, None, pool, n + sum(p.rows for p in live if p.piece in fold), n)

    def merge_columns(self, updates: DataFrame) -> Change:
        """The other columns of ``updates`` replace those of stored rows of the
        same key where they are not null; keys the table has not are left
        out.  Rows stay in their piece."""
        new = self._distinct(updates, None, F.max_by)
        v, live = self._start(None)
        hit = self._holding(new, live)
        if not hit:
            return Change(v, 0, 0, 0)
        cols = self._schema().names
        joined = self._same(self._rows(hit).withColumn("__home", _piece()), new.withColumn("__hit", F.lit(1)), "left")
        value = lambda c: F.coalesce(f"__new_{c}", c).alias(c) if c in new.columns and c not in self.keys else F.col(c)
        found = self._same(self._rows(hit).select(*self.keys), new.select(*self.keys), "left_semi").count()
        return self._commit(v, live, set(hit), joined.select(*map(value, cols), "__home"), None, 0, found)

    def vacuum(self) -> None:
        """Delete what the last version does not read (no reader of an older
        version, and no other writer, may be at work)."""
        v = self.version()
        live = {p.piece for p in self.manifest(v)}
        used = {p.split("/")[0] for p in live}
        for kind in ("pieces", "filters"):
            for folder in commits.children(self.spark, f"{self.path}/{kind}"):
                if folder not in used:
                    commits.delete(self.spark, f"{self.path}/{kind}/{folder}")
                elif kind == "pieces":
                    for p in commits.children(self.spark, f"{self.path}/pieces/{folder}"):
                        if f"{folder}/{p}" not in live:
                            commits.delete(self.spark, f"{self.path}/pieces/{folder}/{p}")

    # ---- inside --------------------------------------------------------------

    def _distinct(self, batch: DataFrame, order: str | None, pick, stage: bool = True) -> DataFrame:
        if order is None:
            d = batch.dropDuplicates(self.keys)
        else:
            # the whole row decides between equal orders, so that reruns agree
            by = F.struct(F.col(order), F.xxhash64(*batch.columns))
            d = batch.groupBy(*self.keys).agg(pick(F.struct(*batch.columns), by).alias("__r")).select("__r.*")
        return _staged(d) if stage else d

    def _start(self, batch: DataFrame | None) -> tuple[int, list]:
        v = self.version()
        if v == 0:
            if batch is None:
                raise ValueError(f"no table at {self.path}")
            batch.limit(0).write.mode("overwrite").parquet(f"{self.path}/schema")
        elif batch is not None and sorted(batch.columns) != sorted(self._schema().names):
            raise ValueError(f"columns {sorted(batch.columns)} are not those of the table, {sorted(self._schema().names)}")
        return v, self.manifest(v)

    def _small(self, live: list, n: int, hit: set) -> set:
        return {p.piece for p in live if p.rows <= FOLD * n and p.rows < self.rows / 2}

    def _commit(self, v: int, live: list, gone: set, home: DataFrame | None, pool: DataFrame | None, pool_rows: int, n: int) -> Change:
        folder = f"v{v + 1}-{uuid.uuid4().hex[:12]}"
        names = {p: i for i, p in enumerate(sorted(gone))}
        cols = self._schema().names
        parts = max(1, -(-pool_rows // self.rows))
        out = []
        if home is not None:
            at = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
            out.append(home.select(*cols, F.element_at(at, F.col("__home")).alias("__piece")))
        if pool is not None:
            # equal ranges of the hash
            part = F.floor((F.shiftright(self.hash(), 32) + (1 << 31)) * parts / F.lit(float(1 << 32))).cast("int")
            out.append(pool.select(*cols, (F.lit(len(names)) + part).alias("__piece")))
        rows = out[0] if len(out) == 1 else out[0].unionByName(out[1])
        pieces = f"{self.path}/pieces/{folder}"
        rows.repartition("__piece").sortWithinPartitions("__piece", *self.keys).write.partitionBy("__piece").parquet(pieces)
        added = []
        if commits.children(self.spark, pieces):
            keys = self._rows([f"{folder}/{c}" for c in commits.children(self.spark, pieces)])
            keys = keys.select(_piece().alias("piece"), self.hash().alias("h"))
            segs = F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / BITS).cast("int").alias("segs")
            stats = _staged(keys.groupBy("piece").agg(F.count(F.lit(1)).alias("rows"), F.min("h").alias("lo"), F.max("h").alias("hi"), segs))
            seg, bits = self._probe(F.col("h"), F.col("segs"))
            marks = keys.join(F.broadcast(stats.select("piece", "segs")), "piece").select("piece", seg.alias("seg"), F.explode(F.array(*bits)).alias("bit"))
            (marks.groupBy("piece", "seg").agg(F.bitmap_construct_agg(F.col("bit").cast("bigint")).alias("bits"))
             .write.parquet(f"{self.path}/filters/{folder}"))
            added = stats.collect()
        now = [tuple(p) for p in live if p.piece not in gone] + [tuple(p) for p in added]
        self.spark.createDataFrame(now, MANIFEST).coalesce(1).write.parquet(f"{self.path}/manifests/{folder}")
        self._publish(v + 1, folder)
        old = [p for p in live if p.piece in gone]
        return Change(v + 1, n, sum(p.rows for p in old), len(old))

    def _publish(self, version: int, name: str) -> None:
        """Name the manifest of a version, unless that version is there."""
        sc = self.spark.sparkContext
        jvm, fs = sc._jvm, commits._fs(self.spark, self.path)
        fs.mkdirs(commits._path(self.spark, f"{self.path}/commits"))
        draft = commits._path(self.spark, f"{self.path}/manifests/{name}/_name-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(name.encode()))
        out.close()
        target = fs.makeQualified(commits._path(self.spark, f"{self.path}/commits/{version}"))
        fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
        none = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            fc.rename(fs.makeQualified(draft), target, none)
        except Exception as e:
            if fs.exists(target):
                raise Conflict(f"version {version} of {self.path} was committed by another writer") from e
            raise


def _piece() -> Column:
    """``folder/piece`` of a row read from a table's pieces."""
    return F.regexp_extract(F.col("_metadata.file_path"), "/pieces/([^/]+/[^/]+)/[^/]+$", 1)


def _staged(df: DataFrame) -> DataFrame:
    return df.checkpoint(eager=True)
