"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets come from a table with one row per source: sources in code point
order (null last) weigh 5, 2, 1, repeating; together they get ``factor`` of
all words; a target stops at ``most`` times its source's size and the excess
is shared again by weight until none is above.

A target is met by complete epochs of the source first.  The fractional epoch
that is left is a weighted sample without replacement: a document with
quality weight w draws u and gets the key u^(1/w); keys are sorted within the
source, largest first, and prefix sums of the sizes decide which documents
fit the rest of the budget.  The document on the boundary gives only as many
of its first words as the budget has left.

Draws are hashes of (seed, doc_id, text), so reruns agree; equal rows share
their draw and follow each other in any order, which gives equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, n_words, prepare, running_total, slots_for

WEIGHTS = (5, 2, 1)


def quality_weight(text: str = "text") -> Column:
    """Share of letters in the text, from 0.05 to 1 (words of letters rank
    above symbols and tables)."""
    t = F.coalesce(F.col(text), F.lit(""))
    share = F.length(F.regexp_replace(t, "[^\\p{L}\\s]+", "")) / F.greatest(F.length(t), F.lit(1))
    return F.greatest(F.lit(0.05), F.least(F.lit(1.0), share))


def _rank(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """0-based rank of the sources by code point, null last.  Sorted over
    range partitions; only the partition counts are summed in one place."""
    by = F.col("source").asc_nulls_last()
    cut = scratch.write(sources.repartitionByRange(by).withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy(by)
    return (cut.join(starts, "part").withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
            .drop("part", "before"))


def targets(sizes: DataFrame, scratch: Scratch, factor: float = 1.5, most: float = 2.0,
            weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes(source, n, words)`` with ``weight`` and ``target``."""
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = scratch.write(_rank(sizes, scratch).withColumn("weight", pick).drop("rank"), "weights")
    total = s.agg(F.sum("words")).first()[0] or 0
    full = F.col("words") * most
    # share level: capped sources hold their cap, the others level * weight;
    # a source once capped stays so, as the level only grows
    level = 0.0
    while total:
        open_ = full > F.col("weight") * level
        capped, weight = s.agg(F.sum(F.when(~open_, full).otherwise(0.0)),
                               F.sum(F.when(open_, F.col("weight")).otherwise(0.0))).first()
        if not weight:
            break
        new = (factor * total - capped) / weight
        if new <= level:
            break
        level = new
    return s.withColumn("target", F.least(full, F.col("weight") * F.lit(level)).cast("double"))


def mix(docs: DataFrame, seed: int = 7, factor: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS,
        text: str = "text", doc_id: str = "doc_id", source: str = "source", size: Column | None = None,
        quality: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``source``, ``size`` (words),
    ``source_size``, ``target``, ``epochs`` (complete copies), ``part`` (words
    of the fractional epoch) and ``taken`` = epochs * size + part.

    A null text has size 0 and nothing is taken of it; a null source is a
    source of its own; a null doc_id draws like any other value.  Sources
    without words have target 0.  An empty table gives no rows."""
    spark = docs.sparkSession
    prepare(spark)
    s = Scratch(spark, "mix")
    draw = F.conv(F.substring(F.md5(F.concat_ws("\x01", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("\x02")),
                                                F.md5(F.coalesce(F.col(text), F.lit(""))))), 1, 13), 16, 10).cast("double")
    u = (draw + 1) / float(1 << 52)
    rows = s.write(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                               (size if size is not None else n_words(text)).alias("size"),
                               F.pow(u, 1 / (quality if quality is not None else quality_weight(text))).alias("key")), "rows")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    plan = s.write(targets(sizes, s, factor, most, weights)
                   .select(F.col("source").alias("src"), F.col("words").alias("source_size"), "target"), "targets")
    n_rows = rows.count()
    slots = slots_for(n_rows)
    # keys lie in (0, 1]; equal pieces of that range keep the order
    slot = F.least(F.floor((1 - F.col("key")) * slots), F.lit(slots - 1)).cast("int")
    ranked = running_total(rows, ["source"], slot, [F.col("key").desc(), F.col("doc_id").asc_nulls_last(), F.col("size")],
                           F.col("size"), "before")
    d = ranked.join(plan, F.col("source").eqNullSafe(F.col("src")), "left").drop("src")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint")
    d = d.withColumn("epochs", epochs).withColumn(
        "part", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), rest - F.col("before"))))
    return d.select("doc_id", "source", "size", "source_size", "target", "epochs", "part",
                    (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


def apply_mix(docs: DataFrame, seed: int = 7, **rules) -> DataFrame:
    """The documents of the mix with all their columns, one row per epoch
    that takes them.  The document on a source's boundary comes whole.

    Rows are matched to the mix by doc_id and a hash of their text and
    source; a row without words is in no epoch."""
    prepare(docs.sparkSession)
    cols = docs.columns
    name = F.xxhash64(F.col("doc_id"), F.col("text"), F.col("source"))
    plan = mix(docs.withColumn("__name", name), seed, doc_id="__name", **rules)
    copies = (plan.where("taken > 0").groupBy(F.col("doc_id").alias("__name"))
              .agg(F.max(F.col("epochs") + (F.col("part") > 0).cast("bigint")).alias("__copies")))
    return (docs.withColumn("__name", name).join(copies, "__name")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*cols))
