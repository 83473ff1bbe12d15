"""Secret scan with SQL expressions only.

Three base patterns (assignments, access keys, long hex) and a sliding-window
entropy test.  Candidates of the entropy test are runs of base64 and word
characters.  A window of ``WINDOW`` characters moves over a candidate; the
count of the entering and the leaving character change, and with them the sum
of c * log2(c) from which the Shannon entropy of the window follows, so a step
costs the same wherever it is.  The best window is held against the limit of
the candidate's character class.  Candidates that look like an allow-listed
form (words, paths of words, UUIDs, documented examples) are left alone.

Offsets count code points, ends are exclusive.  What depends on the matches
before (offsets, covered text) is a running value over blocks of matches, so a
text with many secrets costs in proportion to them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
# a run dropped for its length has no longer match inside it, so the least
# length can be part of these two patterns
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# limits in bits of the best window, by the characters of the candidate
LIMITS = (("^[0-9]+$", 3.1), ("^[0-9a-fA-F]+$", 3.0), ("^[a-z]+$", 3.6), ("^[A-Za-z]+$", 3.8), ("", 3.5))
# a word with an ending number, or a short number
_PART = "([A-Za-z]?[a-z]{1,17}[0-9]{0,4}|[A-Z]{1,12}|[0-9]{1,4})"
ALLOWED = (
    f"^[-_/=+]*{_PART}([-_/=+]+{_PART})*[-_/=+]*$",                             # hyphenated words, paths of words
    "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",                     # UUIDs
    "EXAMPLE(KEY)?$",                                                           # documented sample keys
    "^(.)\\1+$|^[-_=+/]+$",                                                      # rules and padding
)
BLOCK = 256  # matches whose running values are built in one array
SPAN = "array<struct<s:bigint,k:int,e:bigint>>"


def running(rows: Column, zero: Column, total, add, emit, kind: str) -> Column:
    """``emit(value before x, x)`` for each x of an array, ``value`` being
    ``zero`` moved on by ``add(value, x)``.

    Arrays that grow by a step are copied at every step; here only those of a
    block of rows are, and one of the blocks, whose ``total(block)`` is joined
    to a value by ``add(value, total)`` as a row is."""
    def build(r):
        n = F.size(r)
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
                             lambda i: F.slice(r, i * BLOCK + 1, F.lit(BLOCK)))
        return F.transform(F.array(blocks), inside)[0]

    def inside(blocks):
        begin = F.aggregate(F.transform(blocks, total), F.array(zero),
                            lambda acc, t: F.concat(acc, F.array(add(F.element_at(acc, -1), t))))
        start = lambda v: F.struct(v.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        step = lambda acc, x: F.struct(add(acc["at"], x).alias("at"),
                                       F.concat(acc["out"], F.array(emit(acc["at"], x))).alias("out"))
        return F.flatten(F.zip_with(blocks, F.slice(begin, F.lit(1), F.size(blocks)),
                                    lambda b, v: F.aggregate(b, start(v), step, lambda acc: acc["out"])))

    return F.when(F.size(rows) == 0, F.array().cast(f"array<{kind}>")).otherwise(F.transform(F.array(rows), build)[0])


def _located(text: Column, pattern: str, kind: int, keep, group: int = 0) -> Column:
    """Spans of the kept matches of a pattern.  Matches and the text between
    them alternate, so the offsets are running sums of their lengths."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    rows = F.transform(F.arrays_zip(gaps.alias("gap"), found.alias("hit"), inner.alias("inner")),
                       lambda x: F.struct(F.length(x["gap"]).cast("bigint").alias("gap"), F.length(x["hit"]).cast("bigint").alias("hit"),
                                          keep(x["inner"]).alias("keep")))
    nothing = F.lit(False).alias("keep")
    spans_ = running(
        rows, F.lit(0).cast("bigint"),
        lambda b: F.aggregate(b, F.struct(F.lit(0).cast("bigint").alias("gap"), F.lit(0).cast("bigint").alias("hit"), nothing),
                              lambda acc, x: F.struct((acc["gap"] + x["gap"]).alias("gap"), (acc["hit"] + x["hit"]).alias("hit"), nothing)),
        lambda v, x: v + x["gap"] + x["hit"],
        lambda v, x: F.struct((v + x["gap"]).alias("s"), F.lit(kind).alias("k"), (v + x["gap"] + x["hit"]).alias("e"), x["keep"].alias("keep")),
        "struct<s:bigint,k:int,e:bigint,keep:boolean>")
    kept = F.transform(F.filter(spans_, lambda x: x["keep"]), lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    return F.when(text.rlike(pattern), kept).otherwise(F.array().cast(SPAN))


def window_entropy(text: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits) of a window over an ASCII string of at
    least ``window`` characters of the alphabet; 0 for shorter strings."""
    clogc = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    slots = len(ALPHABET) + 1
    boxed = F.transform(F.array(text), lambda s: F.struct(F.split(s, "").alias("ch")))

    def best(x):
        start = F.struct(F.array_repeat(F.lit(0), slots).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

        def step(acc, i):
            new = F.instr(F.lit(ALPHABET), F.element_at(x["ch"], i))
            old = F.when(i > window, F.instr(F.lit(ALPHABET), F.element_at(x["ch"], F.greatest(i - window, F.lit(1)))))
            same = new.eqNullSafe(old)
            up = F.element_at(acc["n"], new + 1)
            down = F.element_at(acc["n"], F.coalesce(old, F.lit(0)) + 1)
            grow = F.element_at(clogc, up + 2) - F.element_at(clogc, up + 1)
            fall = F.when(old.isNull(), 0.0).otherwise(F.element_at(clogc, down) - F.element_at(clogc, down + 1))
            total = F.when(same, acc["sum"]).otherwise(acc["sum"] + grow + fall)
            counts = F.when(same, acc["n"]).otherwise(
                F.transform(acc["n"], lambda c, j: c + F.when(j == new, 1).otherwise(0)
                            - F.when(j.eqNullSafe(old), 1).otherwise(0)))
            bits = F.when(i >= window, F.lit(math.log2(window)) - total / window).otherwise(0.0)
            return F.struct(counts.alias("n"), total.alias("sum"), F.greatest(acc["best"], bits).alias("best"))

        return F.aggregate(F.sequence(F.lit(1), F.size(x["ch"])), start, step, lambda acc: acc["best"])

    return F.element_at(F.transform(boxed, best), 1)


def _random(text: Column) -> Column:
    limit = F.lit(LIMITS[-1][1])
    for pattern, bits in reversed(LIMITS[:-1]):
        limit = F.when(text.rlike(pattern), bits).otherwise(limit)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | text.rlike(pattern)
    return F.when(allowed, False).otherwise(window_entropy(text) >= limit)


def spans(text: Column) -> Column:
    """All spans (start, kind number, end) of a text, by start, then kind."""
    t = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(
        _located(t, ASSIGN, 0, lambda x: F.length(x) >= 6, group=2),
        _located(t, ACCESS, 1, lambda x: F.lit(True)),
        _located(t, HEX, 2, lambda x: F.lit(True)),
        _located(t, CANDIDATE, 3, _random)))


def _of_kind(kind: int) -> Column:
    return F.size(F.filter("secrets", lambda x: x["k"] == kind))


def _named(found: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``secrets`` (array of spans), the counts
    ``n_assign``, ``n_access``, ``n_hex``, ``n_entropy``, ``base_sha256`` and
    ``spans``.  Columns of ``docs`` with the name of a result give way to it.
    Null and empty texts have no spans; the digest is then that of the empty
    string.  Repeated rows give repeated results."""
    prepare(docs.sparkSession)
    d = docs.withColumn("secrets", spans(F.col(text)))
    for i, k in enumerate(KINDS):
        d = d.withColumn(f"n_{k}", _of_kind(i).cast("bigint"))
    base = F.filter("secrets", lambda x: x["k"] < 3)
    return d.withColumn("base_sha256", F.sha2(_named(base), 256)).withColumn("spans", _named(F.col("secrets")))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every secret span of ``text`` replaced by
    ``mark`` (overlapping spans by one) and ``n_chars`` following the text;
    texts without secrets, and nulls, stay as they are, and so do all other
    columns, whatever their names."""
    prepare(docs.sparkSession)
    cols = docs.columns
    name = "secrets"
    while name in cols:
        name = f"_{name}"
    text, found = F.col("text"), F.col(name)
    # code points of equal width, so that a place in the text is one step away
    wide = F.encode(text, "UTF-32")
    # the byte order mark in front is taken off again by the decoder, and only it
    piece = lambda b, lo, n: F.decode(F.concat(F.unhex(F.lit("0000FEFF")),
                                               F.substring(b, (4 * lo + 1).cast("int"), (4 * n).cast("int"))), "UTF-32")

    def rebuilt(b):
        ends = lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))
        gaps = running(
            found, F.lit(0).cast("bigint"),
            lambda block: F.aggregate(block, block[0], lambda acc, x: F.when(x["e"] > acc["e"], ends(x)).otherwise(ends(acc))),
            lambda v, x: F.greatest(v, x["e"]),
            lambda v, x: F.struct(v.alias("lo"), (x["s"] - v).alias("n")), "struct<lo:bigint,n:bigint>")
        kept = F.transform(F.filter(gaps, lambda g: g["n"] >= 0), lambda g: F.concat(piece(b, g["lo"], g["n"]), F.lit(mark)))
        last = F.array_max(F.transform(found, lambda x: x["e"]))
        return F.concat(F.array_join(kept, ""), piece(b, last, F.length(text) - last))

    clean = F.when(F.size(found) > 0, F.transform(F.array(wide), rebuilt)[0]).otherwise(text)
    out = docs.withColumn(name, spans(text)).withColumn("text", clean)
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(F.size(found) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return out.select(*cols)
