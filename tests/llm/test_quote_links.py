from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quote_links as ql

CHAT = "conv_id bigint, turn bigint, role string, text string"


def run(spark, rows):
    return ql.link_quotes(spark.createDataFrame(rows, CHAT)).orderBy(F.col("conv_id").asc_nulls_last(), "position").collect()


def test_levels_and_passages():
    own, hashes, quotes = ql.parse("Hello\n\nOn Monday X wrote:\n> first   Line\n> goes on\n>\n> second\n>> deep\nmy answer")
    assert own == "Hello\n\nmy answer"
    assert [(r, lv) for r, lv, _, _ in quotes] == [(0, 1), (0, 1), (0, 1), (1, 2)]
    assert ql.passage_hash("first line goes on") == quotes[0][2] and ql.passage_hash("deep") == quotes[3][2]
    assert set(hashes) == {ql.passage_hash(x) for x in ("hello", "my answer", "hello my answer")}
    assert ql.parse(None) == ("", [], []) and ql.parse("> > two") [2][0][1] == 2


def test_replies_follow_what_they_quote(spark):
    rows = [(1, 0, "user", "What is  the plan?\n\nAnd when?"), (1, 1, "user", "Another matter entirely"),
            (1, 2, "assistant", "> what is the plan?\nWe go north."), (1, 3, "assistant", "> Another matter\n> entirely\nYes."),
            (1, 4, "user", "> We go north.\n>> What is the plan?\nWhy north?"), (1, 5, "user", "plain end"),
            (2, 0, "user", "What is the plan?"), (2, 1, "user", "> never written here\nhm")]
    got = run(spark, rows)
    one = [r for r in got if r.conv_id == 1]
    assert [(r.turn, r.reply_to, r.thread, r.depth) for r in one] == [
        (0, None, 0, 0), (2, 0, 0, 1), (4, 2, 0, 2), (1, None, 1, 0), (3, 1, 1, 1), (5, None, 5, 0)]
    assert [r.position for r in one] == list(range(6))
    assert one[2].text == "Why north?" and one[2].n_linked == 2 and one[2].max_level == 2 and one[2].n_quotes == 2
    two = [r for r in got if r.conv_id == 2]
    assert [(r.turn, r.reply_to, r.n_quotes, r.n_linked) for r in two] == [(0, None, 0, 0), (1, None, 1, 0)]


def test_long_chain_and_slots(spark, monkeypatch):
    monkeypatch.setattr(ql, "SLOT", 3)
    rows = [(1, 0, "u", "line 0")] + [(1, i, "u", f"> line {i - 1}\nline {i}") for i in range(1, 20)]
    got = run(spark, rows)
    assert [(r.position, r.turn, r.depth, r.thread) for r in got] == [(i, i, i, 0) for i in range(20)]


def brute(rows):
    """Message by message, looking back through the conversation."""
    out = []
    for conv in {r[0] for r in rows}:
        mine = {t: (role, *ql.parse(text)) for c, t, role, text in rows if c == conv}
        parent, linked = {}, {}
        for t, (_, _, _, quotes) in mine.items():
            score, found = {}, set()
            for run_, level, h, chars in set(quotes):
                by = max((u for u in mine if u < t and h in mine[u][2]), default=None)
                if by is not None:
                    found.add((run_, h))
                    lv, n = score.get(by, (99, 0))
                    score[by] = (min(lv, level), n + chars)
            if score:
                parent[t] = max((-lv, n, by) for by, (lv, n) in score.items())[2]
            linked[t] = len(found)

        def chain(t):
            depth = 0
            while t in parent:
                t, depth = parent[t], depth + 1
            return t, depth
        for i, t in enumerate(sorted(mine, key=lambda t: (*chain(t), t))):
            out.append((conv, i, t, mine[t][1], linked[t], parent.get(t), *chain(t)))
    return sorted(map(str, out))


@pytest.mark.parametrize("slot", [1000, 3])
def test_against_brute_force(spark, monkeypatch, slot):
    monkeypatch.setattr(ql, "SLOT", slot)
    rng, rows = random.Random(13), []
    lines = [f"Line {i} of something said" for i in range(12)]
    for conv in (1, 2, 7):
        for turn in range(rng.choice([5, 40])):
            parts = []
            for _ in range(rng.randint(1, 4)):
                kind = rng.random()
                parts.append(rng.choice(lines) if kind < 0.5 else "> " + rng.choice(lines).upper() if kind < 0.8 else
                             "> " + rng.choice(lines) + "\n>> " + rng.choice(lines) if kind < 0.9 else "")
            rows.append((conv, turn * 2, "u", "\n".join(parts)))
    got = [(r.conv_id, r.position, r.turn, r.text, r.n_linked, r.reply_to, r.thread, r.depth) for r in run(spark, rows)]
    assert sorted(map(str, got)) == brute(rows)


def test_a_repeated_passage_makes_no_pairs(spark):
    """One passage quoted and written in every message: a link per message."""
    n = 1500
    rows = [(1, i, "u", "> the same words\n\nThe same  words") for i in range(n)]
    got = run(spark, rows)
    assert [(r.turn, r.reply_to, r.depth) for r in got] == [(i, i - 1 if i else None, i) for i in range(n)]


def test_odd_rows(spark):
    rows = [(None, 0, None, "a b"), (None, 1, "u", "> a b\nyes"), (3, None, "u", "x"), (3, 2, "u", "> x\ny"), (3, 2, "u", "> x\ny"),
            (4, 0, "u", None), (4, 1, "u", ""), (5, 0, "u", "w " * 200_000), (5, 1, "u", "same"), (5, 2, "u", "same"), (5, 3, "u", "> same\nz")]
    got = run(spark, rows)
    assert len(got) == len(rows)
    at = {(r.conv_id, r.turn): r for r in got}
    assert at[None, 1].reply_to == 0 and at[3, 2].reply_to is None and at[5, 3].reply_to == 2
    assert at[3, None].position == 2 and at[4, 0].text == ""
    assert run(spark, []) == []
    more = spark.createDataFrame(rows, CHAT).withColumn("thread", F.lit("x")).withColumn("own", F.lit(1))
    assert ql.link_quotes(more).count() == len(rows)
