"""JO8: enrichment from dimension versions that change while the stream runs.

The versions of a dimension lie in a keyed table by (key, valid from).  An
event takes the version valid at its own time.  A version that comes after the
events it was valid for corrects them: the landed rows of its key from that
time on are looked up again and replaced.  Either stream can be stopped and
started again; a batch that runs twice gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..keyed import KeyedTable
from ..operators.sequence import carry_within, time_bucket


def as_of(events: DataFrame, versions: DataFrame | None, key: str, ts: str, valid_from: str, cols: dict[str, str]) -> DataFrame:
    """JO8 of a batch: ``events`` with the ``cols`` (name to type) of the last
    version of their key that is valid from their time or before; null where
    there is none.  One key's rows are ordered in buckets of an hour, so a key of many
    events is many tasks."""
    own = [c for c in events.columns if c not in cols]
    if versions is None:
        return events.select(*own, *[F.lit(None).cast(t).alias(c) for c, t in cols.items()])
    event, version = F.struct(*own), F.struct(*cols)
    kinds = {"_event": events.select(event.alias("e")).schema[0].dataType, "_version": versions.select(version.alias("v")).schema[0].dataType}
    null = {n: F.lit(None).cast(t).alias(n) for n, t in kinds.items()}
    both = events.select(F.col(key).alias("_key"), F.col(ts).cast("timestamp").alias("_at"), F.lit(1).alias("_turn"), event.alias("_event"),
                         null["_version"])
    both = both.unionByName(versions.select(F.col(key).alias("_key"), F.col(valid_from).cast("timestamp").alias("_at"), F.lit(0).alias("_turn"),
                                            null["_event"], version.alias("_version")))
    found = carry_within(both, ["_key"], ["_at", "_turn"], F.col("_version"), time_bucket("_at"), "_now").where("_turn = 1")
    return found.select("_event.*", *[F.col(f"_now.{c}").alias(c) for c in cols])


def enrich_sink(target: str, versions: str, id_col: str, key: str, ts: str, valid_from: str, cols: dict[str, str],
                rows_per_piece: int = 1_000_000) -> Callable:
    """JO8 sink of the event stream: rows by ``id_col``, each with the version
    of its time."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = KeyedTable(spark, versions, [key, valid_from], rows_per_piece).read()
        KeyedTable(spark, target, [id_col], rows_per_piece).upsert(as_of(batch, known, key, ts, valid_from, cols))
    return write


def version_sink(versions: str, key: str, valid_from: str, cols: dict[str, str], target: str | None = None, id_col: str | None = None,
                 ts: str | None = None, rows_per_piece: int = 1_000_000) -> Callable:
    """JO8 sink of the dimension's changes ``(key, valid_from, *cols)``; with a
    ``target`` of ``enrich_sink``, its rows that a change concerns are
    corrected."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = KeyedTable(spark, versions, [key, valid_from], rows_per_piece)
        table.upsert(batch.select(key, valid_from, *cols))
        landed = KeyedTable(spark, target, [id_col], rows_per_piece) if target else None
        if landed is None or landed.version() == 0:
            return
        since = batch.groupBy(F.col(key).alias("_key")).agg(F.min(F.col(valid_from).cast("timestamp")).alias("_since"))
        rows = landed.read()
        rows = rows.join(since, rows[key].eqNullSafe(F.col("_key")) & (F.col(ts).cast("timestamp") >= F.col("_since"))).select(*rows.columns)
        again = as_of(rows, table.read().join(since, F.col(key).eqNullSafe(F.col("_key")), "left_semi"), key, ts, valid_from, cols)
        landed.upsert(again.select(*rows.columns))
    return write
