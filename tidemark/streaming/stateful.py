"""Per-key stateful rules on ``transformWithStateInPandas`` (SS4, SS7, SS13,
SS15-SS17, SS19).

Each rule is a small object with a ``step(state, rows) -> (state, out)``
function over one key's rows in event order; ``RuleProcessor`` keeps the
state in a ``ValueState`` (JSON text, so any rule state fits one schema) and
runs the same rule in a streaming query (state in the checkpointed state
store, survives restarts and executor loss) or over a batch DataFrame.

Per-key order is the semantics of these rules (a rate limit per client, a
breaker per dependency), so one key is processed by one task per
micro-batch; the state per key is bounded (windows, counters, buffers with
limits).  Large backfills run through the streaming driver with a
per-trigger input limit so each micro-batch stays bounded.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import StructType, _parse_datatype_string

STATE_SCHEMA = "s string"


class Rule:
    """Base class: subclasses set ``order``, ``out_schema`` (without the key
    columns) and implement ``initial`` and ``step``."""

    order: Sequence[str] = ()
    out_schema: str = ""

    def initial(self) -> dict:
        return {}

    def step(self, state: dict, rows: pd.DataFrame) -> tuple[dict, list[dict]]:
        raise NotImplementedError

    def on_timer(self, state: dict, watermark_ms: int) -> tuple[dict | None, list[dict]]:
        return state, []


class RuleProcessor(StatefulProcessor):
    """Runs a ``Rule`` per key with its state in a ValueState (JSON)."""

    def __init__(self, rule: Rule, key_names: Sequence[str], timers: bool = False, presorted: bool = False):
        self.rule = rule
        self.key_names = list(key_names)
        self.timers = timers
        self.presorted = presorted
        self.out_cols = [f.name for f in _out_struct(rule, key_names).fields]

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rule_state", STATE_SCHEMA)

    def _load(self) -> dict:
        return json.loads(self.state.get()[0]) if self.state.exists() else self.rule.initial()

    def _emit(self, key, outs: list[dict]) -> Iterator[pd.DataFrame]:
        if outs:
            pdf = pd.DataFrame(outs)
            for i, k in enumerate(self.key_names):
                pdf[k] = key[i]
            yield pdf[self.out_cols]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        st = self._load()
        if self.presorted:
            # batch input arrives sorted by (key, order): step through the
            # Arrow batches one at a time, so a key with a huge share of the
            # rows never has to fit in memory at once
            for pdf in rows:
                st, outs = self.rule.step(st, pdf.reset_index(drop=True))
                yield from self._emit(key, outs)
            outs = []
        else:
            # a micro-batch of one key (bounded by the trigger): order it here
            pdf = pd.concat(list(rows), ignore_index=True)
            if self.rule.order:
                pdf = pdf.sort_values(list(self.rule.order), kind="mergesort").reset_index(drop=True)
            st, outs = self.rule.step(st, pdf)
        self.state.update((json.dumps(st),))
        if self.timers and st.get("_timer_ms") and not st.get("_timer_set"):
            self.handle.registerTimer(int(st["_timer_ms"]))
            st["_timer_set"] = True
            self.state.update((json.dumps(st),))
        yield from self._emit(key, outs)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        st = self._load()
        st, outs = self.rule.on_timer(st, timerValues.getCurrentWatermarkInMs())
        if st is None:
            self.state.clear()
        else:
            self.state.update((json.dumps(st),))
        yield from self._emit(key, outs)

    def close(self) -> None:
        pass


def _out_struct(rule: Rule, key_names: Sequence[str], key_types: dict[str, str] | None = None) -> StructType:
    kt = key_types or {}
    keys = ", ".join(f"{k} {kt.get(k, 'string')}" for k in key_names)
    return _parse_datatype_string(f"{keys}, {rule.out_schema}")


def apply_rule(df: DataFrame, keys: Sequence[str], rule: Rule, output_mode: str = "Append",
               time_mode: str = "None", key_types: dict[str, str] | None = None) -> DataFrame:
    """Run ``rule`` per key over ``df`` (streaming or batch).

    Batch input is hash-partitioned by the keys and sorted by (keys, rule
    order) before the stateful operator -- the partitioning and ordering it
    requires, so Spark adds no other exchange or sort -- and the processor
    then consumes each key's rows batch by batch in event order.  Streaming
    micro-batches are ordered inside the processor."""
    spark: SparkSession = df.sparkSession
    _ = spark.streams.active  # registers the state-store coordinator (batch use)
    kt = key_types or {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name in keys}
    schema = _out_struct(rule, keys, kt)
    presorted = (not df.isStreaming) and bool(rule.order) and time_mode == "None"
    if presorted:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(n, *keys).sortWithinPartitions(*keys, *rule.order)
    proc = RuleProcessor(rule, keys, timers=(time_mode == "EventTime"), presorted=presorted)
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=schema, outputMode=output_mode, timeMode=time_mode)


def _ms(v) -> int:
    return int(pd.Timestamp(v).value // 1_000_000)


def _us(v) -> int:
    return int(pd.Timestamp(v).value // 1_000)


def _ts(us: int) -> pd.Timestamp:
    return pd.Timestamp(us, unit="us")


def _whole(v) -> int | None:
    """An id or version; null stays null."""
    return None if pd.isna(v) else int(v)


# ---- SS4: global window with a count trigger ---------------------------------

class CountTrigger(Rule):
    """Emit (count, running total) every ``n`` elements, accumulating."""

    def __init__(self, n: int, value: str, order: Sequence[str]):
        self.n, self.value, self.order = n, value, list(order)
        self.out_schema = "fired_at_count long, running_total double"

    def initial(self):
        return {"count": 0, "total": 0.0}

    def step(self, st, rows):
        outs = []
        c, t = st["count"], st["total"]
        for v in rows[self.value].tolist():
            c += 1
            t += float(v)
            if c % self.n == 0:
                outs.append({"fired_at_count": c, "running_total": round(t, 6)})
        return {"count": c, "total": t}, outs


# ---- SS13: delivery attempts -> dead letter after N failures -----------------

class DeliveryAttempts(Rule):
    """SS13: count delivery attempts per message; after ``max_failures``
    failed attempts the message is dead-lettered, an ack delivers it."""

    def __init__(self, max_failures: int = 5, ts: str = "ts", ok: str = "acked", attempt: str = "attempt_id"):
        self.max, self.ts, self.ok, self.attempt = max_failures, ts, ok, attempt
        self.order = [ts, attempt]
        self.out_schema = "outcome string, attempts long, failures long, first_publish timestamp_ntz, decided_at timestamp_ntz"

    def initial(self):
        return {"attempts": 0, "failures": 0, "first_ms": None, "done": False}

    def step(self, st, rows):
        outs = []
        if st["done"]:
            return st, outs
        for r in rows.itertuples(index=False):
            ms = _us(getattr(r, self.ts))
            st["attempts"] += 1
            st["first_ms"] = ms if st["first_ms"] is None else min(st["first_ms"], ms)
            if bool(getattr(r, self.ok)):
                st["done"] = True
                outs.append({"outcome": "delivered", "attempts": st["attempts"], "failures": st["failures"],
                             "first_publish": _ts(st["first_ms"]), "decided_at": _ts(ms)})
                return {"done": True}, outs  # all that later attempts need
            else:
                st["failures"] += 1
                if st["failures"] >= self.max:
                    st["done"] = True
                    outs.append({"outcome": "dead_letter", "attempts": st["attempts"], "failures": st["failures"],
                                 "first_publish": _ts(st["first_ms"]), "decided_at": _ts(ms)})
                    return {"done": True}, outs
        return st, outs


# ---- SS15: rate limit with ban -----------------------------------------------

class RateLimit(Rule):
    """More than ``limit`` requests in ``window_s`` from one key: the request
    is denied and (mode ``ban``) the key is banned for ``ban_s``; mode
    ``throttle`` only denies over the limit.  Exact sliding window.  Requests
    without a time take no part; a null id stays null."""

    def __init__(self, limit: int = 100, window_s: int = 60, ban_s: int = 600, mode: str = "ban",
                 ts: str = "ts", tie: str = "request_id"):
        self.limit, self.window_us, self.ban_us, self.mode, self.ts, self.tie = (
            limit, window_s * 1_000_000, ban_s * 1_000_000, mode, ts, tie)
        self.order = [ts, tie]
        self.out_schema = f"{tie} long, decision string, reason string"

    def initial(self):
        return {"recent": [], "ban_until": None}

    def step(self, st, rows):
        outs = []
        recent = st["recent"]
        for r in rows[rows[self.ts].notna()].itertuples(index=False):
            us = _us(getattr(r, self.ts))
            rid = _whole(getattr(r, self.tie))
            if st["ban_until"] is not None and us < st["ban_until"]:
                outs.append({self.tie: rid, "decision": "deny", "reason": "banned"})
                continue
            recent = [t for t in recent if t > us - self.window_us]
            if len(recent) >= self.limit:
                if self.mode == "ban":
                    st["ban_until"] = us + self.ban_us
                outs.append({self.tie: rid, "decision": "deny", "reason": "rate_exceeded"})
                continue
            recent.append(us)
            outs.append({self.tie: rid, "decision": "allow", "reason": None})
        st["recent"] = recent
        return st, outs


# ---- SS16: circuit breaker timeline ------------------------------------------

class CircuitBreaker(Rule):
    """closed -> open after ``threshold`` failures within ``window_s``;
    open routes to the fallback; after ``cooldown_s`` one trial call goes to
    the primary (half-open): success closes, failure re-opens.  A slow
    success is not a failure.  A success in the closed state forgets the
    failures before it, so the threshold counts failures in a row.  Calls
    without a time take no part; one of unknown outcome is no failure."""

    def __init__(self, threshold: int = 5, window_s: int = 60, cooldown_s: int = 30,
                 ts: str = "ts", tie: str = "call_id", failed: str = "failed"):
        self.th, self.win, self.cool, self.ts, self.tie, self.failed = (
            threshold, window_s * 1_000_000, cooldown_s * 1_000_000, ts, tie, failed)
        self.order = [ts, tie]
        self.out_schema = f"{tie} long, route string, state string, transition string"

    def initial(self):
        return {"mode": "closed", "fails": [], "opened": None}

    def step(self, st, rows):
        outs = []
        for r in rows[rows[self.ts].notna()].itertuples(index=False):
            us = _us(getattr(r, self.ts))
            cid = _whole(getattr(r, self.tie))
            bad = getattr(r, self.failed)
            bad = False if pd.isna(bad) else bool(bad)
            trans = None
            if st["mode"] == "open" and us - st["opened"] >= self.cool:
                st["mode"] = "half_open"
                trans = "open->half_open"
            if st["mode"] == "open":
                outs.append({self.tie: cid, "route": "fallback", "state": "open", "transition": trans})
                continue
            if st["mode"] == "half_open":
                if bad:
                    st["mode"], st["opened"] = "open", us
                    trans = "half_open->open"
                else:
                    st["mode"], st["fails"] = "closed", []
                    trans = "half_open->closed"
                outs.append({self.tie: cid, "route": "primary", "state": "half_open", "transition": trans})
                continue
            fails = [t for t in st["fails"] if t > us - self.win] + [us] if bad else []
            if len(fails) >= self.th:
                st["mode"], st["opened"], fails = "open", us, []
                trans = "closed->open"
            st["fails"] = fails
            outs.append({self.tie: cid, "route": "primary", "state": "closed", "transition": trans})
        return st, outs


# ---- SS19: current state with versioned upserts ------------------------------

class VersionedUpsert(Rule):
    """Counters and versioned upserts: a change whose ``expected_version``
    differs from the stored version is rejected (optimistic concurrency), a
    null one always; changes without a time take no part."""

    def __init__(self, expected: str = "expected_version", payload: str = "payload", ts: str = "ts",
                 tie: str = "change_id"):
        self.expected, self.payload, self.ts, self.tie = expected, payload, ts, tie
        self.order = [ts, tie]
        self.out_schema = f"{tie} long, accepted boolean, version long, payload double"

    def initial(self):
        return {"version": 0, "payload": None}

    def step(self, st, rows):
        outs = []
        for r in rows[rows[self.ts].notna()].itertuples(index=False):
            exp = _whole(getattr(r, self.expected))
            cid = _whole(getattr(r, self.tie))
            if exp == st["version"]:
                st["version"] += 1
                new = getattr(r, self.payload)
                st["payload"] = None if pd.isna(new) else float(new)
                outs.append({self.tie: cid, "accepted": True, "version": st["version"], "payload": st["payload"]})
            else:
                outs.append({self.tie: cid, "accepted": False, "version": st["version"], "payload": st["payload"]})
        return st, outs


# ---- SS17: tail sampling with an event-time timer ----------------------------

class TailSamplingProcessor(StatefulProcessor):
    """Hold a trace's spans for ``wait_s`` of event time after its first
    span; then keep it if any span errored or was slower than ``slow_ms``,
    else keep ``keep_ratio`` of traces by a hash of the trace id.

    Spans wait in a list state, however many they are.  The decision stays
    for ``keep_s`` after it was made, so spans that come later follow it; a
    second timer then clears it."""

    def __init__(self, trace: str, wait_s: int = 10, slow_ms: float = 500.0, keep_ratio: float = 0.05,
                 ts: str = "start_time", span: str = "span_id", status: str = "status", duration: str = "duration_ms",
                 keep_s: int = 3600):
        self.trace, self.wait_ms, self.keep_ms, self.slow, self.ratio = trace, wait_s * 1000, keep_s * 1000, slow_ms, keep_ratio
        self.ts, self.span, self.status, self.duration = ts, span, status, duration

    def init(self, handle) -> None:
        self.handle = handle
        self.facts = handle.getValueState("facts", "error boolean, slowest double")
        self.verdict = handle.getValueState("verdict", "reason string, until long")
        self.spans = handle.getListState("spans", "span long")

    def _out(self, key, ids, reason):
        return pd.DataFrame({self.trace: [key[0]] * len(ids), self.span: ids, "reason": [reason] * len(ids)})

    def handleInputRows(self, key, rows, timerValues):
        if self.verdict.exists():
            reason = self.verdict.get()[0]
            for pdf in rows:
                if reason and len(pdf):
                    yield self._out(key, pdf[self.span].astype("int64").tolist(), reason)
            return
        error, slowest, first = False, 0.0, None
        new = not self.facts.exists()
        if not new:
            error, slowest = self.facts.get()
        for pdf in rows:
            if len(pdf):
                error = bool(error or (pdf[self.status] == "ERROR").any())
                slowest = max(slowest, float(pdf[self.duration].max()))
                at = _ms(pdf[self.ts].min())
                first = at if first is None else min(first, at)
                self.spans.appendList([(x,) for x in pdf[self.span].astype("int64").tolist()])
        self.facts.update((error, slowest))
        if new and first is not None:
            self.handle.registerTimer(first + self.wait_ms)

    def decide(self, trace_id, error: bool, slowest: float) -> str | None:
        if error:
            return "error"
        if slowest > self.slow:
            return "slow"
        bucket = int(hashlib.md5(str(trace_id).encode()).hexdigest()[:8], 16) % 10000
        return "sampled" if bucket < int(self.ratio * 10000) else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.verdict.exists():
            self.verdict.clear()
            return
        reason = self.decide(key[0], *self.facts.get())
        until = expiredTimerInfo.getExpiryTimeInMs() + self.keep_ms
        self.verdict.update((reason or "", until))
        self.handle.registerTimer(until)
        if reason:
            ids = []
            for (x,) in self.spans.get():
                ids.append(x)
                if len(ids) == 10_000:
                    yield self._out(key, ids, reason)
                    ids = []
            if ids:
                yield self._out(key, ids, reason)
        self.spans.clear()
        self.facts.clear()

    def close(self) -> None:
        pass


def tail_sampling(spans: DataFrame, trace: str = "trace_id", **kw) -> DataFrame:
    """SS17: tail sampling of a watermarked span stream (see
    ``TailSamplingProcessor``); the trace id may be of any type."""
    proc = TailSamplingProcessor(trace, **kw)
    _ = spans.sparkSession.streams.active
    kind = dict(spans.dtypes)[trace]
    return spans.groupBy(trace).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=f"{trace} {kind}, {proc.span} long, reason string",
        outputMode="Append", timeMode="EventTime")


# ---- SS7/SS8: early, on-time and late firings of an event-time window --------

class WindowFiringsProcessor(StatefulProcessor):
    """Per event-time window (the grouping key is the window start):

    * while the on-time watermark is before the window end, the running total
      is emitted as ``early`` once ``early_s`` seconds of processing time have
      passed since the first element that no firing has told yet (0: with every
      micro-batch that brings some); a micro-batch brings the check, so the
      trigger interval is its resolution;
    * when the on-time watermark passes the window end, the total is emitted
      as ``on_time`` (an event-time timer, or the first later element);
    * elements after that re-emit it as ``late``;
    * state is dropped when the window end is ``lateness`` behind, and so are
      elements that come later still.

    The input stream carries ``withWatermark(ts, lateness)``; the on-time
    watermark is that watermark plus the lateness.  ``accumulate=False`` emits
    each firing's own increment instead (discarding mode)."""

    def __init__(self, size_s: int, lateness_s: int, value: str = "value", accumulate: bool = True, early_s: float = 0):
        self.size_ms, self.late_ms, self.value, self.acc, self.early_ms = size_s * 1000, lateness_s * 1000, value, accumulate, early_s * 1000

    def init(self, handle) -> None:
        self.handle = handle
        # total so far, total told, firings, time of the first element not told
        # (-1: none), on-time firing done
        self.state = handle.getValueState("w", "total double, emitted double, firing long, opened long, closed boolean")

    def _fire(self, key, st, kind):
        total, emitted, firing, _, closed = st
        st[:] = [total, total, firing + 1, -1, closed]
        return pd.DataFrame({"window_start": [key[0]], "total": [total if self.acc else total - emitted], "kind": [kind],
                             "firing": [firing + 1]})

    def handleInputRows(self, key, rows, timerValues):
        add = sum(float(pdf[self.value].sum()) for pdf in rows)
        end_ms = _ms(key[0]) + self.size_ms
        watermark = timerValues.getCurrentWatermarkInMs()
        if watermark >= end_ms:
            return
        past = watermark + self.late_ms >= end_ms
        new = not self.state.exists()
        st = [0.0, 0.0, 0, -1, past] if new else list(self.state.get())
        if new:
            if not past:
                self.handle.registerTimer(end_ms - self.late_ms)   # on-time firing
            self.handle.registerTimer(end_ms)                      # lateness over: drop state
        if past and not st[4]:
            st[4] = True
            yield self._fire(key, st, "on_time")
        st[0] += add
        now = timerValues.getCurrentProcessingTimeInMs()
        if st[3] < 0:
            st[3] = now
        if past or now - st[3] >= self.early_ms:
            yield self._fire(key, st, "late" if past else "early")
        self.state.update(tuple(st))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.state.exists():
            return
        if expiredTimerInfo.getExpiryTimeInMs() >= _ms(key[0]) + self.size_ms:
            self.state.clear()
            return
        st = list(self.state.get())
        if not st[4]:
            st[4] = True
            yield self._fire(key, st, "on_time")
            self.state.update(tuple(st))

    def close(self) -> None:
        pass


def _partial_sums(value: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).group_by("window_start").aggregate([(value, "sum")])
            yield from pa.table({"window_start": t.column("window_start"), value: t.column(f"{value}_sum")}).cast(b.schema).to_batches()
    return run


def window_firings(stream: DataFrame, ts: str, value: str, size_s: int, lateness_s: int,
                   accumulate: bool = True, early_s: float = 0) -> DataFrame:
    """SS7 / SS8: early / on-time / late firings per tumbling window, accumulating or discarding (see
    ``WindowFiringsProcessor``).  ``stream`` must carry
    ``withWatermark(ts, f"{lateness_s} seconds")``.

    Tasks sum their rows per window and Arrow batch first, so a window's task
    reads a row per batch of the input, and its state is the running total."""
    from pyspark.sql import functions as F
    _ = stream.sparkSession.streams.active
    start = F.window(F.col(ts), f"{size_s} seconds").start.alias("window_start")
    keyed = stream.select(start, F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias(value))
    keyed = keyed.mapInArrow(_partial_sums(value), f"window_start timestamp, `{value}` double")
    return keyed.groupBy("window_start").transformWithStateInPandas(
        statefulProcessor=WindowFiringsProcessor(size_s, lateness_s, value, accumulate, early_s),
        outputStructType="window_start timestamp, total double, kind string, firing long",
        outputMode="Append", timeMode="EventTime")


def _pickle_by_value() -> None:
    """Stateful processors are also unpickled by a driver-side Python worker
    that does not see ``addPyFile`` code; pickle this module's classes by
    value so no import of this package is needed there."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_pickle_by_value()
