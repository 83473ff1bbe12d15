"""Event-time windows, watermarks, late data, dedup and stream joins on
Structured Streaming (SS1-SS3, SS5-SS9, SS11, SS12, SS21, SS22, SS24, JO8,
JO14).

Allowed lateness: Spark has one watermark delay per stream.  With the
delay set to the allowed lateness and ``update`` output mode, a window
re-emits its corrected total for every late element until the watermark
passes ``window end + lateness``, then its state is dropped -- the same
final totals as an on-time firing plus late firings (hard part H1).  Late
rows are dropped only between micro-batches (the watermark advances after
each batch), so tests feed one file per arrival step.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .. import commits


def windowed_sum(stream: DataFrame, ts: str, value: Column | str, size: str, slide: str | None = None,
                 keys: Sequence[str] = (), lateness: str | None = None) -> DataFrame:
    """SS1/SS2 (+SS5/SS6): tumbling or sliding event-time windows with a
    watermark of ``lateness`` (the allowed lateness)."""
    s = stream.withWatermark(ts, lateness) if lateness else stream
    v = F.col(value) if isinstance(value, str) else value
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (s.groupBy(w.alias("window"), *keys)
            .agg(F.sum(v).alias("total"), F.count(F.lit(1)).alias("elements")))


def session_counts(stream: DataFrame, ts: str, key: str, gap: str, lateness: str) -> DataFrame:
    """SS3: per-key session windows on a stream."""
    return (stream.withWatermark(ts, lateness)
            .groupBy(key, F.session_window(ts, gap).alias("session"))
            .agg(F.count(F.lit(1)).alias("events")))


def dedup(stream: DataFrame, id_col: str, ts: str, lateness: str) -> DataFrame:
    """SS9: drop redelivered copies of an id seen within the watermark
    (state expires with the watermark, so it stays bounded)."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([id_col])


def enrich(stream: DataFrame, static: DataFrame, key: str, broadcast_rows: int = 100_000) -> DataFrame:
    """JO8: stream-static enrichment by key.  A dimension of more than
    ``broadcast_rows`` is met by shuffle, or every micro-batch would gather it
    in the driver; with fewer the engine picks the join."""
    small = static.select(key).limit(broadcast_rows + 1).count() <= broadcast_rows
    return stream.join(static if small else static.hint("merge"), key, "left")


def match_arrivals(source: DataFrame, target: DataFrame, key: str, written: str, arrived: str,
                   max_lag: str, lateness: str) -> DataFrame:
    """JO14 (stream form): match each source write to its arrival in the
    target within ``max_lag``; both sides watermarked so join state is
    purged.  Output: key, written, arrived, lag seconds."""
    s = source.withWatermark(written, lateness)
    t = target.withColumnRenamed(key, "_k").withWatermark(arrived, lateness)
    cond = ((F.col(key) == F.col("_k")) & (F.col(arrived) >= F.col(written))
            & (F.col(arrived) <= F.col(written) + F.expr(f"INTERVAL {max_lag}")))
    j = s.join(t, cond, "inner")
    return j.select(key, written, arrived,
                    (F.unix_micros(arrived) - F.unix_micros(written)).cast("double").alias("_us")).withColumn(
        "lag_s", F.col("_us") / 1e6).drop("_us")


def run_available(df: DataFrame, sink, checkpoint: str, mode: str = "update", name: str | None = None):
    """SS11: process everything available, then stop.  ``sink`` is a
    ``foreachBatch`` function; the checkpoint makes a restart continue where
    the previous run committed (SS12)."""
    w = (df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    return q


def run_caught_up(df: DataFrame, sink, checkpoint: str, mode: str = "append") -> None:
    """SS11: process batch after batch until the source has no more, then
    stop; for sources that hand out a limited batch at a time."""
    q = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def drain(make: Callable[[DataFrame], DataFrame], source: DataFrame, flush: Callable[[], None], sink,
          checkpoint: str) -> None:
    """SS11 (drain): consume what is there, then close the windows still
    open.  ``flush`` hands the source one last row far ahead of any event
    time (intake is stopped, so nothing follows it); the watermark passes all
    windows and append mode emits them.  The last row's own window stays
    open and is never emitted."""
    run_available(make(source), sink, checkpoint, mode="append")
    flush()
    run_available(make(source), sink, checkpoint, mode="append")


PROGRESS = "query_id string, run_id string, batch_id long, at string, input_rows long, watermark string"


class ProgressRecorder(StreamingQueryListener):
    """SS22: keep each micro-batch's progress (batch id, input rows,
    watermark) so stuck watermarks can be found with a DataFrame query.

    With a ``path`` every report is a small file there, named by query and
    batch, so it outlives the driver and a batch that ran again is told once;
    ``read_progress`` reads them.  Without one they are kept in memory."""

    def __init__(self, spark: SparkSession | None = None, path: str | None = None):
        self.rows: list[tuple] = []
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        wm = (p.eventTime or {}).get("watermark")
        row = (str(p.id), str(p.runId), int(p.batchId), p.timestamp, int(p.numInputRows), wm)
        if self.path is None:
            self.rows.append(row)
        else:
            commits.put_text(self.spark, f"{self.path}/{p.id}-{p.batchId}.json",
                             json.dumps(dict(zip((f.split()[0] for f in PROGRESS.split(", ")), row))))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def to_df(self, spark: SparkSession) -> DataFrame:
        return read_progress(spark, self.path) if self.path else spark.createDataFrame(self.rows, PROGRESS)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """SS22: the progress that ``ProgressRecorder`` wrote to ``path``."""
    return spark.read.schema(PROGRESS).json(path)


def stuck_watermarks(progress: DataFrame, min_batches: int = 3) -> DataFrame:
    """SS22: queries whose watermark did not move for ``min_batches``
    consecutive batches that all had input rows."""
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy("batch_id")
    p = progress.withColumn("_prev", F.lag("watermark").over(w))
    p = p.withColumn("_stuck", (F.col("watermark") == F.col("_prev")) & (F.col("input_rows") > 0))
    p = p.withColumn("_grp", F.sum(F.when(~F.col("_stuck"), 1).otherwise(0)).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    g = p.where("_stuck").groupBy("query_id", "_grp").agg(
        F.count(F.lit(1)).alias("batches"), F.min("batch_id").alias("from_batch"),
        F.max("batch_id").alias("to_batch"), F.first("watermark").alias("watermark"))
    return g.where(F.col("batches") >= min_batches).drop("_grp")
