"""Structured Streaming sources and sinks (SO1, SO2, SO10-SO16, SO18).

Sinks are ``foreachBatch`` functions: each micro-batch is written with the
batch id in the output (or as its own folder), so a batch replayed after a
failure overwrites its own earlier attempt instead of appending twice.
Merges that read and rewrite the same table commit through
``tidemark.commits``: the new content is complete beside the table before
anything of the old one goes.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import commits
from ..keyed import KeyedTable
from ..session import ensure_checkpoint_dir


def read_events(spark: SparkSession, path: str | None, schema: StructType | str, event_time: str,
                lateness: str, fmt: str = "json", max_files_per_trigger: int | None = None,
                time_format: str | None = None, id_col: str | None = None,
                options: dict[str, str] | None = None) -> DataFrame:
    """SO1: message stream with an explicit schema (no inference), event time
    taken from the payload and a watermark of ``lateness`` on it; with
    ``id_col`` copies of a message within the watermark are dropped.

    A file format reads ``path``.  Without a path the format is a message
    source set up by ``options`` (a broker); its binary ``value`` is decoded
    (``decode_messages``)."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.schema(schema).load(path) if path else decode_messages(r.load(), schema)
    return with_event_time(df, event_time, lateness, time_format, id_col)


def decode_messages(messages: DataFrame, schema: StructType | str) -> DataFrame:
    """The JSON payload of a binary ``value`` column as columns of ``schema``,
    the source's own columns (key, offset, ...) beside it."""
    body = F.from_json(F.col("value").cast("string"), schema if isinstance(schema, str) else schema.simpleString())
    return messages.withColumn("_body", body).select("_body.*", *[c for c in messages.columns if c != "value"])


def with_event_time(df: DataFrame, event_time: str, lateness: str, time_format: str | None = None,
                    id_col: str | None = None) -> DataFrame:
    t = F.to_timestamp(F.col(event_time), time_format) if time_format else F.col(event_time).cast("timestamp")
    out = df.withColumn("event_ts", t).withWatermark("event_ts", lateness)
    return out.dropDuplicatesWithinWatermark([id_col]) if id_col else out


def read_new_objects(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SO2: each newly written object processed once (the checkpoint records
    which files were seen), with its size in bytes and newline count.  An
    object is one row with its content; ``watch_objects`` with
    ``count_objects`` takes objects of any size."""
    df = (spark.readStream.format("binaryFile").option("pathGlobFilter", glob)
          .schema("path string, modificationTime timestamp, length long, content binary").load(path))
    text = F.col("content").cast("string")
    return df.select("path", "modificationTime", F.col("length").alias("bytes"),
                     (F.length(text) - F.length(F.regexp_replace(text, "\n", ""))).alias("newlines"))


def watch_objects(spark: SparkSession, path: str, glob: str = "*", max_objects: int = 1000) -> DataFrame:
    """SO2: each newly written object once -- ``path``, ``modificationTime``,
    ``bytes`` and its URL -- without reading it; at most ``max_objects`` in a
    micro-batch.  Spark's file source leaves empty objects out."""
    df = (spark.readStream.format("binaryFile").option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_objects)
          .option("recursiveFileLookup", "true")
          .schema("path string, modificationTime timestamp, length long, content binary").load(path))
    return df.select("path", "modificationTime", F.col("length").alias("bytes"), F.col("_metadata.file_path").alias("url"))


def count_objects(target_path: str) -> Callable:
    """SO2 sink for ``watch_objects``: a row per object with its ``newlines``.

    Objects are read as lines, in byte ranges of ``spark.sql.files.maxPartitionBytes``
    that run in tasks of their own, so an object may be of any size; its row is
    written when all its ranges are counted.  The bytes of the lines tell
    whether the last one ended."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = _staged(batch)
        paths = [r.path for r in found.select("path").collect()]  # at most max_objects
        counts = found.select("url", F.lit(0).cast("bigint").alias("lines"), F.lit(0).cast("bigint").alias("spelt")).limit(0)
        if paths:
            lines = spark.read.option("lineSep", "\n").text([_literal(p) for p in paths])
            counts = (lines.groupBy(F.col("_metadata.file_path").alias("url"))
                      .agg(F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("value") + 1).alias("spelt")))
        done = found.join(counts, "url", "left").select(
            "path", "modificationTime", "bytes",
            F.coalesce(F.col("lines") - (F.col("spelt") - F.col("bytes")), F.lit(0)).cast("bigint").alias("newlines"))
        _put(done, target_path, batch_id)
    return write


def _literal(path: str) -> str:
    """A path whose special characters are no pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _staged(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _put(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a micro-batch under its batch id; a replay replaces it."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def upsert(target_path: str, keys: Sequence[str], order: str, partition_col: str | None = None) -> Callable:
    """SO10 / SS8: replace-by-key sink for update-mode (accumulating) firings.

    Per batch: the last value per key (by ``order``), merged over the
    existing rows of the affected partitions (anti-join + union) and
    committed as one replacement.  Re-running a batch gives the same table.
    Null keys are equal; a key that moves to another partition leaves its old
    one, which is rewritten too.  A batch whose columns differ from the
    table's is refused.  ``keyed_upsert`` does not rewrite the rest."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = batch.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), F.col(order)).alias("_r")).select("_r.*")
        cur = commits.read(spark, target_path)
        merged, emptied = last, ()
        if cur is not None:
            gone = last.select(*[F.col(k).alias(f"__{k}") for k in keys])
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
            if partition_col:
                # the partitions the batch goes to, and those its keys are in
                # (semi-joins: the rows stay in the cluster)
                left = cur.join(gone, same, "left_semi").select(partition_col).distinct()
                emptied = tuple(r[0] for r in left.collect())
                both = left.union(last.select(partition_col)).distinct().withColumnRenamed(partition_col, "__part")
                cur = cur.join(both, F.col(partition_col).eqNullSafe(F.col("__part")), "left_semi")
            merged = cur.join(gone, same, "left_anti").unionByName(last)
        if partition_col:
            commits.replace_partitions(merged, target_path, partition_col, emptied)
        else:
            commits.replace(merged, target_path)
    return write


TOMBSTONES = "_deleted"


def cdc_apply(target_path: str, key: str, version: str, op: str = "op") -> Callable:
    """SS20 (stream form): apply each micro-batch of change events in commit
    order: the latest change per key replaces the stored row unless that is
    newer.  A delete stays in the table as a tombstone with its version, so a
    late older change cannot bring the row back; ``read_changes`` hides them.
    A replayed batch gives the same table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        last = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), F.col(version)).alias("_r")).select("_r.*")
        last = last.withColumn(TOMBSTONES, F.col(op) == "D").drop(op)
        cur = commits.read(batch.sparkSession, target_path)
        if cur is not None:
            last = (cur.unionByName(last).groupBy(key)
                    .agg(F.max_by(F.struct(*cur.columns), F.col(version)).alias("_r")).select("_r.*"))
        commits.replace(last, target_path)
    return write


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """SS20 reader: the live rows of a ``cdc_apply`` table."""
    commits.recover(spark, path)
    return spark.read.parquet(path).where(~F.col(TOMBSTONES)).drop(TOMBSTONES)


def append_deltas(target_path: str) -> Callable:
    """SO11 / SS8: append each batch's (discarding) firings with the batch id;
    readers sum by key (``read_deltas``).  A replayed batch replaces its own
    partition (``batch_id``), so it is not counted twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _put(batch, target_path, batch_id)
    return write


def read_deltas(spark: SparkSession, path: str, keys: Sequence[str], value: str) -> DataFrame:
    """SO11 reader: the discarding firings summed per key."""
    return spark.read.parquet(path).groupBy(*keys).agg(F.sum(value).alias(value))


def keyed_upsert(target_path: str, keys: Sequence[str], order: str, keep_newer: bool = False,
                 rows_per_piece: int = 1_000_000) -> Callable:
    """SO10 / SS8: ``upsert`` into a ``KeyedTable``: a batch rewrites only the
    pieces that hold one of its keys.  With ``keep_newer`` a stored row with a
    greater ``order`` stays, so batches may come in any order.
    ``KeyedTable.read`` reads the table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        KeyedTable(batch.sparkSession, target_path, keys, rows_per_piece).upsert(batch, order, order if keep_newer else None)
    return write


def keyed_changes(target_path: str, key: str, version: str, op: str = "op", rows_per_piece: int = 1_000_000) -> Callable:
    """SS20: ``cdc_apply`` into a ``KeyedTable``: the latest change per key,
    deletes as tombstones; ``read_keyed_changes`` hides them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(TOMBSTONES, F.coalesce(F.col(op) == "D", F.lit(False))).drop(op)
        KeyedTable(batch.sparkSession, target_path, [key], rows_per_piece).upsert(rows, newer_by=version)
    return write


def read_keyed_changes(spark: SparkSession, path: str, key: str) -> DataFrame:
    """SS20 reader: the live rows of a ``keyed_changes`` table."""
    return KeyedTable(spark, path, [key]).read().where(~F.col(TOMBSTONES)).drop(TOMBSTONES)


def exactly_once_ever(target_path: str, id_col: str, rows_per_piece: int = 1_000_000) -> Callable:
    """SO12 / SS9: every id lands once, however late a copy comes and in
    whatever run: the landed table is its own index (key ranges and Bloom
    filters of its pieces, then an exact look-up), so rows and index are one
    commit.  The state grows with the table, on disk; an id without a value
    lands once too."""
    def write(batch: DataFrame, batch_id: int) -> None:
        KeyedTable(batch.sparkSession, target_path, [id_col], rows_per_piece).insert_new(batch)
    return write


def exactly_once(target_path: str, id_col: str) -> Callable:
    """SO12: every id lands once across restarts: duplicates inside the batch
    are dropped, the batch is written into its own ``batch_id`` partition
    (a replay overwrites it), and cross-batch duplicates are removed upstream
    by ``dropDuplicatesWithinWatermark`` (state in the checkpoint)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        _put(batch.dropDuplicates([id_col]), target_path, batch_id)
    return write


def parse_and_route(good_path: str, dead_path: str, parse: Callable[[DataFrame], DataFrame],
                    raw_col: str = "raw", extra: Callable[[DataFrame, int], None] | None = None) -> Callable:
    """SO13 (+SO12): parse a batch once, write good rows to the table and
    failures -- original bytes, reason, batch id, time -- to the dead-letter
    output, both keyed by batch id so a replay is idempotent.  ``extra`` adds
    more writers on the same parsed batch (e.g. windowed counts, SS21)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        p = _staged(parse(batch).withColumn("batch_id", F.lit(batch_id)))
        good = p.where(F.col("error").isNull()).drop(raw_col, "error")
        dead = p.where(F.col("error").isNotNull()).select(
            F.col(raw_col).alias("raw"), F.col("error").alias("reason"), "batch_id",
            F.current_timestamp().alias("failed_at"))
        _put(good, good_path, batch_id)
        _put(dead, dead_path, batch_id)
        if extra:
            extra(p, batch_id)
    return write


def route(routes: dict[str, tuple[Callable[[DataFrame], DataFrame], str]]) -> Callable:
    """SO14 / SO18: one read, several filtered writers per batch
    (``name -> (filter function, path)``), each idempotent by batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        b = _staged(batch) if len(routes) > 1 else batch
        for _, (f, path) in routes.items():
            _put(f(b), path, batch_id)
    return write


def merge_enrichment(spark: SparkSession, target_path: str, updates: DataFrame, key: str) -> None:
    """SO15: idempotent write-back of enrichment columns by key: rows of the
    target not updated are kept, updated rows replaced; a rerun with the
    same updates leaves the same table.  ``KeyedTable.merge_columns`` rewrites
    only the pieces that hold a key of the updates."""
    commits.recover(spark, target_path)
    cur = spark.read.parquet(target_path)
    upd = updates.dropDuplicates([key])
    cols = cur.columns
    merged = (cur.join(upd.select(key), key, "left_anti")
              .unionByName(cur.join(upd, key, "inner").select(
                  *[F.coalesce(upd[c], cur[c]).alias(c) if c in upd.columns and c != key else cur[c] for c in cols])))
    commits.replace(merged, target_path)


def late_side_output(sink: Callable[[DataFrame, int], None], late_path: str, clock_path: str, ts: str,
                     lateness_s: int, window_s: int = 0) -> Callable:
    """SS10: split off the rows that a windowed aggregate with ``lateness_s``
    would drop, and keep them.

    The watermark of a batch is the latest event time of the batches before
    it less the lateness, as the engine's own; it is kept per batch under
    ``clock_path``, so a replayed batch is split as it was the first time.  A
    row is late when its window (``window_s`` 0: its own time) has ended by
    then.  Late rows go to ``late_path`` with the watermark, the others to
    ``sink``; both by batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clock = commits.read(spark, clock_path)
        seen = clock.where(F.col("batch_id") < batch_id).agg(F.max("latest_us")).first()[0] if clock is not None else None
        us = F.unix_micros(F.col(ts).cast("timestamp"))
        size = window_s * 1_000_000
        end = (F.floor(us / size) + 1) * size if size else us + 1
        if seen is None:
            sink(batch, batch_id)
        else:
            mark = seen - lateness_s * 1_000_000
            late = F.coalesce(end <= mark, F.lit(False))
            _put(batch.where(late).withColumn("watermark_us", F.lit(mark)), late_path, batch_id)
            sink(batch.where(~late), batch_id)
        _put(batch.agg(F.max(us).alias("latest_us")), clock_path, batch_id)
    return write


def merge_into_table(source: DataFrame, table: str, keys: Sequence[str], op: str | None = None) -> None:
    """SO10 / SO15 / SS20 on a table format with row-level operations (a v2
    catalog table such as Delta or Iceberg): ``MERGE INTO`` by key --
    matched rows are updated (or deleted when ``op`` is ``'D'``), new rows
    inserted.  Needs such a table format on the cluster (none is in this
    image, so this path is not exercised by the tests); the parquet paths
    above (anti-join + overwrite) are the fallback used without one."""
    src = source.alias("s")
    tgt = table.split(".")[-1]
    cond = None
    for k in keys:
        e = F.col(f"{tgt}.{k}") == F.col(f"s.{k}")
        cond = e if cond is None else cond & e
    w = src.mergeInto(table, cond)
    if op is not None:
        w = w.whenMatched(F.col(f"s.{op}") == "D").delete()
        w = w.whenMatched().updateAll().whenNotMatched(F.col(f"s.{op}") != "D").insertAll()
    else:
        w = w.whenMatched().updateAll().whenNotMatched().insertAll()
    w.merge()


def replay(spark: SparkSession, path: str, ts: str, from_ts: str, transform: Callable[[DataFrame], DataFrame],
           sink: Callable[[DataFrame, int], None], batch_id: int, to_ts: str | None = None, fmt: str = "parquet") -> None:
    """SO16: re-read the time range ``[from_ts, to_ts)`` through a corrected
    transform into an idempotent sink (same keys replaced, no duplicates)."""
    src = spark.read.format(fmt).load(path).where(F.col(ts) >= F.to_timestamp_ntz(F.lit(from_ts)))
    if to_ts is not None:
        src = src.where(F.col(ts) < F.to_timestamp_ntz(F.lit(to_ts)))
    sink(transform(src), batch_id)


def expire_partitions(spark: SparkSession, path: str, partition_col: str, as_of: str, keep_days: int) -> list[str]:
    """SO9: delete day partitions older than ``keep_days`` before ``as_of``
    (folder deletes through the Hadoop FileSystem of the table path).
    Returns the deleted partition values."""
    cutoff = dt.date.fromisoformat(as_of) - dt.timedelta(days=keep_days)
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    deleted = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(partition_col + "="):
            v = name.split("=", 1)[1]
            try:
                d = dt.date.fromisoformat(v)
            except ValueError:
                continue
            if d < cutoff:
                fs.delete(st.getPath(), True)
                deleted.append(v)
    return sorted(deleted)


def fan_out(df: DataFrame, sinks: dict[str, Callable], checkpoint_root: str, trigger: dict | None = None) -> list:
    """SO18: N independent consumers, each with its own checkpoint, each
    seeing every message."""
    qs = []
    for name, fn in sinks.items():
        w = df.writeStream.foreachBatch(fn).option("checkpointLocation", f"{checkpoint_root}/{name}")
        w = w.trigger(**(trigger or {"availableNow": True}))
        qs.append(w.queryName(name).start())
    return qs
