"""Shared helpers of the training-data operators: scratch tables in the
shared folder, exact distributed numbering and component labelling."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path, ship_code

# words of the corpus operators: runs of anything but ASCII white space
WORD_SPACE = "[\\x20\\x09-\\x0D]"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Make the shared folder and this package known to the executors."""
    ensure_checkpoint_dir(spark)
    ship_code(spark)


def n_words(text: str = "text") -> Column:
    """Number of words of a text column (null: 0), JVM side."""
    t = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"^{WORD_SPACE}+|{WORD_SPACE}+\\z", "")
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, f"{WORD_SPACE}+", -1))).cast("long")


class Scratch:
    """Tables written under the shared folder (lineage cuts that survive a
    lost executor).  ``drop`` deletes a table that is no longer read."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.base = scratch_path(spark, f"llm/{tag}-{uuid.uuid4().hex}")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write and read again.  Nothing reads the shuffle files of a write
        once it is done: Spark is told to delete them then, not when the
        driver happens to collect its garbage."""
        kept = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(self.path(name))
        finally:
            if kept is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, kept)
        return self.read(name, df.schema)

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def free(self) -> None:
        """Let go of the shuffle files of finished steps.  Spark deletes them
        once the driver has collected the plans that made them; the Python
        references to those are released by a thread that needs a moment."""
        gc.collect()
        time.sleep(0.5)
        self.spark._jvm.System.gc()

    def drop(self, *names: str) -> None:
        for n in names:
            delete(self.spark, self.path(n))


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def running_total(df: DataFrame, group: list[str], slot: Column, order: list[Column], value: Column,
                  name: str) -> DataFrame:
    """Add ``name`` = sum of ``value`` over the earlier rows of the group,
    the current one excluded, exactly and without a task per group.

    ``slot`` cuts a group into pieces and must not decrease along ``order``;
    rows are summed inside (group, slot) and the slot totals are summed over
    the slots before.  Groups compare null-safe.
    """
    d = df.withColumn("__slot", slot).withColumn("__val", value)
    tot = d.groupBy(*group, "__slot").agg(F.sum("__val").alias("__tot"))
    before = Window.partitionBy(*group).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__slot").alias("__s"),
                     F.coalesce(F.sum("__tot").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*group, "__slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__in", F.coalesce(F.sum("__val").over(inside), F.lit(0)))
    cond = F.col("__slot") == F.col("__s")
    for i, g in enumerate(group):
        cond = cond & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    d = d.join(tot, cond, "left").withColumn(name, F.coalesce(F.col("__before"), F.lit(0)) + F.col("__in"))
    return d.drop("__slot", "__val", "__in", "__s", "__before", *[f"__g{i}" for i in range(len(group))])


def slots_for(n_rows: int, per_slot: int = 5_000) -> int:
    """Number of pieces that keep a piece near ``per_slot`` rows."""
    return max(1, -(-int(n_rows) // per_slot))


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(node, root)`` with
    the smallest node of each component as root, for the nodes that have an
    edge.  Alternates the large-star and small-star steps (each node tells its
    neighbours the smallest node it knows of) until nothing changes; every
    step is a partially aggregated minimum and a join, written to scratch.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = scratch.write(e, f"{tag}-cc0")
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    last, k = f"{tag}-cc0", 0
    sig = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: greater neighbours move to the smallest node
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself move to it
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.col("v").alias("x"), "m", "u")
                 .select(F.explode(F.array(F.struct(F.col("x").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("s"))
                 .select("s.u", "s.v").where("u <> v").distinct())
        k += 1
        e = scratch.write(small, f"{tag}-cc{k}")
        scratch.drop(last)
        last = f"{tag}-cc{k}"
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == sig:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        sig = now
