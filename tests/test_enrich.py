"""JO8: events take the dimension version of their time, whenever it is told."""

from __future__ import annotations

import datetime as dt
import random

from tidemark.keyed import KeyedTable
from tidemark.streaming import enrich

DAY = dt.datetime(2024, 1, 1)
EVENTS, CHANGES = "id long, k string, at timestamp_ntz", "k string, since timestamp_ntz, v string, w long"
COLS = {"v": "string", "w": "bigint"}


def expected(events, changes):
    out = []
    for i, k, at in events:
        known = [(since, v, w) for c, since, v, w in changes if c == k and since <= at]
        out.append((i, k, *(max(known)[1:] if known else (None, None))))
    return sorted(map(str, out))


def test_any_order_of_arrival(spark, tmp_path):
    """Events and changes in random order, batches delivered twice, null and
    hot keys: the table is that of all changes known from the start."""
    rng = random.Random(1)
    keys = ["hot"] * 6 + ["b", "c", None]
    events = [(i, rng.choice(keys), DAY + dt.timedelta(minutes=rng.randrange(5000))) for i in range(120)]
    changes = list({(k, s): (k, s, f"v{i}", i) for i in range(40)
                    for k, s in [(rng.choice(["hot", "b", None]), DAY + dt.timedelta(minutes=rng.randrange(5000)))]}.values())
    t, v = str(tmp_path / "t"), str(tmp_path / "v")
    land = enrich.enrich_sink(t, v, "id", "k", "at", "since", COLS)
    told = enrich.version_sink(v, "k", "since", COLS, t, "id", "at")
    told(spark.createDataFrame(changes[:5], CHANGES), 0)
    land(spark.createDataFrame(events[:60], EVENTS), 0)
    told(spark.createDataFrame(changes[5:25], CHANGES), 1)
    land(spark.createDataFrame(events[30:], EVENTS), 1)
    told(spark.createDataFrame(changes[20:], CHANGES), 2)
    got = KeyedTable(spark, t, ["id"]).read().select("id", "k", "v", "w").collect()
    assert sorted(str(tuple(r)) for r in got) == expected(events, changes)


def test_events_before_any_version(spark, tmp_path):
    e = spark.createDataFrame([(1, "a", DAY)], EVENTS)
    assert [tuple(r) for r in enrich.as_of(e, None, "k", "at", "since", {"v": "string"}).select("id", "v").collect()] == [(1, None)]
    c = spark.createDataFrame([("a", DAY, "at once", 1), ("a", DAY + dt.timedelta(days=1), "later", 2)], CHANGES)
    assert [tuple(r) for r in enrich.as_of(e, c, "k", "at", "since", COLS).select("v", "w").collect()] == [("at once", 1)]
