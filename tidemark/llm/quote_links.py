"""Chat formatting by quotation linking.

Each message is parsed into its own text and quoted passages with their
nesting level (leading ``>`` marks).  Quoted passages and the own passages of
all messages are normalised and hashed; a quote joins the messages of its
conversation that wrote the passage before.  The message whose passages make
up most of the outermost quote is the one replied to.  Replies chain to
threads; a conversation is given in the order of its threads, each reply
after the message it answers, without quotes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import carry_within
from .common import Scratch, prepare, running_total

_MARK = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
# lines that announce a quote: up to 80 characters and a verb of saying in one
# of four languages, or "On ... wrote:"; longer lines are text of the message
_SAYS = re.compile(r"^\s*(on\b.*\bwrote:|.{0,80}\b(wrote|writes|said|schrieb|escribió|a écrit)\s*:)\s*$", re.I)
_SPACE = re.compile(r"\s+")
SLOT = 1000  # turns, or steps of a thread, that one task handles together


def levels(text: str) -> list[tuple[int, str]]:
    """(quote level, line without marks) of every line."""
    out = []
    for line in text.split("\n"):
        m = _MARK.match(line)
        out.append((m[1].count(">"), line[m.end():]) if m else (0, line))
    return out


def passages(lines: list[str]) -> list[str]:
    """Normalised paragraphs of a run of lines: lower case, single spaces."""
    out, cur = [], []
    for line in [*lines, ""]:
        if line.strip():
            cur.append(line)
        elif cur:
            out.append(_SPACE.sub(" ", " ".join(cur)).strip().lower())
            cur = []
    return out


def passage_hash(p: str) -> int:
    return int.from_bytes(hashlib.blake2b(p.encode(), digest_size=8).digest(), "big", signed=True)


def parse(text: str | None) -> tuple[str, list[int], list[tuple[int, int, int, int]]]:
    """Own text, hashes of own passages (paragraphs and the whole) and quotes
    as (run, level, hash, length); a run of equal level is hashed whole and
    by paragraph."""
    lines = levels(text or "")
    own: list[str] = []
    quotes: list[tuple[int, int, int, int]] = []
    i = run = 0
    while i < len(lines):
        level = lines[i][0]
        j = i
        while j < len(lines) and lines[j][0] == level:
            j += 1
        part = [x for _, x in lines[i:j]]
        if level == 0:
            if j < len(lines):  # a quote follows: the line that announces it goes
                while part and not part[-1].strip():
                    part.pop()
                if part and _SAYS.match(part[-1]):
                    part.pop()
            own += part
        else:
            found = passages(part)
            for p in dict.fromkeys([*found, " ".join(found)]):
                if p:
                    quotes.append((run, level, passage_hash(p), len(p)))
            run += 1
        i = j
    mine = passages(own)
    hashes = [passage_hash(p) for p in dict.fromkeys([*mine, " ".join(mine)]) if p]
    return "\n".join(own).strip(), hashes, quotes


_PARSED = ("own string, own_hashes array<bigint>, "
           "quotes array<struct<run:int,level:int,hash:bigint,chars:int>>, max_level int")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    quote = pa.list_(pa.struct([("run", pa.int32()), ("level", pa.int32()), ("hash", pa.int64()), ("chars", pa.int32())]))
    for b in batches:
        own, hashes, quotes, deep = [], [], [], []
        for x in b.column(3):
            o, h, q = parse(x.as_py())
            own.append(o)
            hashes.append(h)
            quotes.append([dict(zip(("run", "level", "hash", "chars"), v)) for v in q])
            deep.append(max((v[1] for v in q), default=0))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(own, pa.string()), pa.array(hashes, pa.list_(pa.int64())),
             pa.array(quotes, quote), pa.array(deep, pa.int32())],
            names=["conv_id", "turn", "role", "own", "own_hashes", "quotes", "max_level"])


def _threads(links: DataFrame, s: Scratch) -> DataFrame:
    """Root and depth of every message with a parent, by pointer doubling:
    after k rounds a pointer spans 2^k replies."""
    at = links.select("conv_id", "turn", F.col("parent").alias("thread"), F.lit(1).cast("bigint").alias("depth"))
    at, k = s.write(at, "hop0"), 0
    while True:
        up = at.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("thread").alias("far"), F.col("depth").alias("more"))
        new = (at.join(up, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("thread") == F.col("t")), "left")
               .select("conv_id", "turn", F.coalesce("far", "thread").alias("thread"),
                       (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("far").isNotNull().alias("moved")))
        k += 1
        new = s.write(new, f"hop{k}")
        if new.where("moved").isEmpty():
            return new.drop("moved")
        at = new.drop("moved")


def link_quotes(chats: DataFrame) -> DataFrame:
    """One row per row of ``chats(conv_id, turn, role, text)``: ``conv_id``,
    ``position`` (from 0, reply order), ``turn``, ``role``, ``text`` without
    quotes, ``n_quotes`` (quoted runs), ``max_level``, ``n_linked`` (quoted
    passages found in earlier messages), ``reply_to`` (turn, null if it
    quotes no known message), ``thread`` (turn of the first message of the
    chain) and ``depth`` in it.

    A null text is empty and quotes nothing.  A null turn sorts last, neither
    quotes nor is quoted; a null conv_id is a conversation.  Rows of one
    conversation and turn are one message to those who quote it."""
    prepare(chats.sparkSession)
    s = Scratch(chats.sparkSession, "quotes")
    rows = s.write(chats.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
                   .mapInArrow(_parse, f"conv_id bigint, turn bigint, role string, {_PARSED}"), "parsed")
    quoted = (rows.where("turn IS NOT NULL AND max_level > 0")
              .select("conv_id", "turn", F.explode("quotes").alias("q"))
              .select("conv_id", "turn", "q.run", "q.level", "q.hash", "q.chars").distinct())
    written = rows.where("turn IS NOT NULL").select(F.col("conv_id").alias("c"), F.col("turn").alias("from"),
                                                    F.explode("own_hashes").alias("h")).distinct()
    # the last one to write a passage before it was quoted, found along the
    # turns that quote or write it; a turn does not quote itself
    along = (quoted.withColumn("from", F.lit(None).cast("bigint")).withColumn("writes", F.lit(False))
             .unionByName(written.select(F.col("c").alias("conv_id"), F.col("from").alias("turn"), F.col("h").alias("hash"), "from",
                                         F.lit(True).alias("writes")), allowMissingColumns=True))
    last = carry_within(along, ["conv_id", "hash"], ["turn", "writes"], F.col("from"), F.floor(F.col("turn") / SLOT), "by")
    last = s.write(last.where("NOT writes AND by IS NOT NULL")
                   .select("conv_id", "turn", "run", "level", "hash", "chars", F.col("by").alias("from")), "hits")
    score = last.groupBy("conv_id", "turn", "from").agg(F.min("level").alias("level"), F.sum("chars").alias("chars"))
    best = (score.groupBy("conv_id", "turn")
            .agg(F.max(F.struct(-F.col("level"), "chars", "from"))["from"].alias("parent")))
    linked = last.groupBy("conv_id", "turn").agg(F.countDistinct("run", "hash").alias("n_linked"))
    links = s.write(best.join(linked.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "n_linked"),
                              F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t"))).drop("c", "t"), "links")
    chain = _threads(links, s).select(F.col("conv_id").alias("c1"), F.col("turn").alias("t1"), "thread", "depth")
    links = links.select(F.col("conv_id").alias("c2"), F.col("turn").alias("t2"), "parent", "n_linked")
    out = (rows.join(chain, F.col("conv_id").eqNullSafe(F.col("c1")) & (F.col("turn") == F.col("t1")), "left")
           .join(links, F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("turn") == F.col("t2")), "left")
           .withColumn("thread", F.coalesce("thread", "turn")).withColumn("depth", F.coalesce("depth", F.lit(0).cast("bigint")))
           .withColumn("n_linked", F.coalesce("n_linked", F.lit(0).cast("bigint")))
           .withColumn("n_quotes", F.size(F.array_distinct(F.transform("quotes", lambda q: q["run"]))).cast("bigint")))
    # messages are numbered inside their thread, threads inside the conversation
    order = [F.col("depth"), F.col("turn").asc_nulls_last(), F.col("role"), F.xxhash64("own"), F.col("own")]
    threads = out.groupBy("conv_id", "thread").agg(F.count(F.lit(1)).alias("n"))
    slot = F.coalesce(F.floor(F.col("thread") / SLOT), F.lit((1 << 63) - 1)).cast("bigint")
    threads = running_total(threads, ["conv_id"], slot, [F.col("thread").asc_nulls_last()], F.col("n"), "ahead").select(
        F.col("conv_id").alias("c3"), F.col("thread").alias("t3"), "ahead")
    out = running_total(out, ["conv_id", "thread"], F.floor(F.col("depth") / SLOT), order, F.lit(1), "inside")
    out = out.join(threads, F.col("conv_id").eqNullSafe(F.col("c3")) & F.col("thread").eqNullSafe(F.col("t3")), "left")
    out = out.withColumn("position", F.col("ahead") + F.col("inside"))
    return out.select("conv_id", F.col("position").cast("bigint").alias("position"), "turn", "role", F.col("own").alias("text"),
                      "n_quotes", "max_level", "n_linked", F.col("parent").alias("reply_to"), "thread", "depth")
