"""Per-key sequential rules cut into pieces that run in many tasks.

A rule that depends on what came before (a rate limit, a circuit breaker)
*regenerates* where its state is known whatever happened earlier, or is one of
a few states.  A key's rows are cut there; every piece is run from each state
it can be entered in, which gives the piece's decisions and its map from entry
to exit state; maps compose along the key, and each piece keeps the decisions
of the state it was really entered in.  One hot key is thus as many tasks as it
has pieces.

``versioned_upsert`` needs no pieces: accepted changes form a path, followed by
pointer doubling.

Rows of a key are ordered by time, then by an id that is unique in the key.
Rows without a time take no part and have no result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path
from ..streaming.stateful import CircuitBreaker, RateLimit, Rule
from .sequence import carry_within, prev_within, running_sum, time_bucket


def _same(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r{c}"))
    return cond


def cut_pieces(df: DataFrame, key: str, ts: str, tie: str, fresh: Callable[[Column, Column], Column], extra: Sequence[str] = ()) -> DataFrame:
    """Add ``_piece``, the number of regeneration points of the key up to the
    row: rows where ``fresh(seconds since the previous row, its struct)``."""
    bucket = time_bucket(ts)
    d = prev_within(df.where(F.col(ts).isNotNull()), [key], [ts, tie], [ts, *extra], bucket, "_p_")
    gap = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col(f"_p_{ts}").cast("timestamp"))) / 1e6
    d = d.withColumn("_fresh", F.coalesce(fresh(gap, F.struct(*[F.col(f"_p_{c}").alias(c) for c in extra]) if extra else F.lit(None)),
                                          F.lit(False)).cast("int"))
    d = running_sum(d, [key], [ts, tie], "_fresh", bucket, "_piece")
    return d.drop("_fresh", *[f"_p_{c}" for c in [ts, *extra]])


def _steps(rule: Rule, group: list[str], names: list[str], entries: dict):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for pdf in frames:
            out = []
            for g, rows in pdf.groupby((pdf[group].ne(pdf[group].shift()) & ~(pdf[group].isna() & pdf[group].shift().isna())).any(axis=1).cumsum(),
                                       sort=False):
                key = tuple(None if pd.isna(x) else x for x in rows[group].iloc[0])
                if key != now:
                    now, state = key, entries[key[-1]]() if entries else rule.initial()
                state, outs = rule.step(state, rows.reset_index(drop=True))
                out += [{**o, **dict(zip(group, key))} for o in outs]
            if out:
                yield pd.DataFrame(out, columns=names)
    return run


def run_pieces(df: DataFrame, group: Sequence[str], rule: Rule, entries: dict | None = None) -> DataFrame:
    """``rule`` over each group of rows, one Arrow batch at a time.  With
    ``entries`` the last group column names the state a group starts in."""
    kinds = dict(df.dtypes)
    head = ", ".join(f"`{c}` {kinds[c]}" for c in group)
    rows = df.repartition(*group).sortWithinPartitions(*group, *rule.order)
    schema = f"{head}, {rule.out_schema}"
    names = [*group, *[f.split()[0] for f in rule.out_schema.split(", ")]]
    return rows.mapInPandas(_steps(rule, list(group), names, entries or {}), schema)


def rate_limit(requests: DataFrame, key: str, rule: RateLimit) -> DataFrame:
    """SS15 of a batch: ``key``, the request's id, ``decision``, ``reason``.
    After a pause as long as the window and the ban nothing earlier counts, so
    pieces are independent."""
    pause = max(rule.window_us, rule.ban_us if rule.mode == "ban" else 0) / 1e6
    d = cut_pieces(requests.select(key, rule.ts, rule.tie), key, rule.ts, rule.tie, lambda gap, _: gap >= pause)
    return run_pieces(d, [key, "_piece"], rule).drop("_piece")


def circuit_breaker(calls: DataFrame, key: str, rule: CircuitBreaker) -> DataFrame:
    """SS16 of a batch: ``key``, the call's id, ``route``, ``state``,
    ``transition``.

    After a pause of the cool-down, behind a success (or a pause of the
    failure window, behind any call), a breaker is closed without failures,
    or open and due for a trial: the two states a piece is run from.  A call
    of unknown outcome is no failure."""
    cool, win = rule.cool / 1e6, rule.win / 1e6
    failed = F.coalesce(F.col(rule.failed), F.lit(False)).alias(rule.failed)
    d = cut_pieces(calls.select(key, rule.ts, rule.tie, failed), key, rule.ts, rule.tie,
                   lambda gap, prev: (gap >= cool) & (~prev[rule.failed] | (gap >= win)), [rule.failed])
    d = d.withColumn("_entry", F.explode(F.array(F.lit("closed"), F.lit("open"))))
    entries = {"closed": rule.initial, "open": _due}
    path = scratch_path(calls.sparkSession, f"pieces-{uuid.uuid4().hex}")
    at = d.where("_entry = 'closed'").select(key, "_piece", rule.tie, rule.ts)
    run_pieces(d, [key, "_piece", "_entry"], rule, entries).write.parquet(path)
    ran = calls.sparkSession.read.parquet(path)
    # exit state of a piece from the last row's state and transition
    after = F.coalesce(F.element_at(F.split("transition", "->"), -1), F.col("state"))
    ends = ran.join(at.select(*[F.col(c).alias(f"_r{c}") for c in (key, "_piece", rule.tie)], rule.ts), _same([key, "_piece", rule.tie]))
    ends = ends.groupBy(key, "_piece").agg(
        *[F.max_by(F.when(F.col("_entry") == e, (after == "open").cast("int")), F.when(F.col("_entry") == e, F.struct(rule.ts, rule.tie)))
          .alias(f"from_{e}") for e in entries], F.min(rule.ts).alias("began"))
    # a piece leaves the state, turns it, or sets it; the entry state is the
    # last one set, turned as often as pieces since then turn
    ends = ends.withColumn("turns", ((F.col("from_closed") == 1) & (F.col("from_open") == 0)).cast("int"))
    ends = running_sum(ends, [key], ["_piece"], "turns", time_bucket("began", "day"), "turned")
    fixed = F.when(F.col("from_closed") == F.col("from_open"), (F.col("from_closed") + F.col("turned")) % 2)
    ends = carry_within(ends, [key], ["_piece"], fixed, time_bucket("began", "day"), "fixed")
    enters = F.when((F.coalesce("fixed", F.lit(0)) + F.col("turned") - F.col("turns")) % 2 == 1, "open").otherwise("closed")
    ends = ends.select(F.col(key).alias(f"_r{key}"), F.col("_piece").alias("_r_piece"), enters.alias("_r_entry"))
    return ran.join(ends, _same([key, "_piece", "_entry"]), "left_semi").drop("_piece", "_entry")


def _due() -> dict:
    """An open breaker whose cool-down is over at any later call."""
    return {"mode": "open", "fails": [], "opened": -(1 << 62)}


def versioned_upsert(changes: DataFrame, key: str, expected: str = "expected_version", payload: str = "payload", ts: str = "ts",
                     tie: str = "change_id") -> DataFrame:
    """SS19 of a batch: ``key``, ``tie``, ``accepted``, and the key's
    ``version`` and ``payload`` after the change.

    A change is accepted if it expects the version the key has; that makes the
    next version.  After an accepted change of version v the next accepted one
    is the first later change that expects v + 1: these pointers are found by
    one windowed pass, and the path from the first change that expects 0 is
    marked by doubling them, in a number of rounds that is the logarithm of
    the versions.  A null ``expected`` fits no version; a null payload is
    stored as such."""
    spark = changes.sparkSession
    base = scratch_path(spark, f"versions-{uuid.uuid4().hex}")

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    rows = changes.where(F.col(ts).isNotNull()).select(key, F.col(expected).alias("_exp"), F.col(payload).alias("_pay"), ts, tie)
    rows = put(rows.withColumn("_id", F.monotonically_increasing_id()), "rows")
    # a change as seeker of the version after its own, and as the one sought
    able = rows.where("_exp >= 0")
    both = able.select(key, ts, tie, "_id", (F.col("_exp") + 1).alias("_want"), F.lit(None).cast("bigint").alias("_hit")).unionByName(
        able.select(key, ts, tie, F.lit(None).cast("bigint").alias("_id"), F.col("_exp").alias("_want"), F.col("_id").alias("_hit")))
    found = carry_within(both, [key, "_want"], [ts, tie], F.col("_hit"), time_bucket(ts), "_next", following=True)
    jump = put(found.where("_id IS NOT NULL AND _next IS NOT NULL").select("_id", "_next"), "jump0")
    path = put(able.where("_exp = 0").groupBy(key).agg(F.min_by("_id", F.struct(ts, tie)).alias("_id")).select("_id"), "path0")
    k = 0
    while not jump.isEmpty():
        k += 1
        path = put(path.unionByName(path.join(jump, "_id").select(F.col("_next").alias("_id"))), f"path{k}")
        far = jump.select(F.col("_id").alias("_next"), F.col("_next").alias("_far"))
        jump = put(jump.join(far, "_next").select("_id", F.col("_far").alias("_next")), f"jump{k}")
        delete_path(spark, f"{base}/path{k - 1}")
        delete_path(spark, f"{base}/jump{k - 1}")
    d = rows.join(path.withColumn("_ok", F.lit(1)), "_id", "left").withColumn("_ok", F.coalesce("_ok", F.lit(0)))
    d = running_sum(d, [key], [ts, tie], "_ok", time_bucket(ts), "version")
    stored = d.where("_ok = 1").select(F.col(key).alias(f"_r{key}"), F.col("version").alias("_rversion"), F.col("_pay").alias("payload"))
    return d.join(stored, _same([key, "version"]), "left").select(
        key, tie, (F.col("_ok") == 1).alias("accepted"), F.col("version").cast("bigint").alias("version"), "payload")
