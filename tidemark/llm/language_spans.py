"""Language identification of mixed-language text.

Training counts, per language, hashed character n-grams (1 to 4 characters,
word edges included) and the scripts of the letters, in Spark over all the
labelled rows and all their labels, and keeps log probabilities in a table with
a fixed number of rows and a column per label.

Prediction scores every word of a text for every language.  The script of a
word narrows its candidates to languages that write it.  Viterbi decoding with
a penalty for changing the language between words labels spans; the language
with most letters in its spans is that of the text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .common import Scratch, prepare

BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
# fixed values: first code points of script ranges and the script's number
# (0: none of these); Latin 1, Greek 2, Cyrillic 3, Armenian 4, Hebrew 5, Arabic 6,
# Indic 7, Thai and Lao 8, Georgian 9, Hangul 10, Kana 11, Han 12, other 13
RANGES = [
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0), (0x00B5, 1), (0x00B6, 0),
    (0x00BA, 1), (0x00BB, 0), (0x00C0, 1), (0x00D7, 0), (0x00D8, 1), (0x00F7, 0), (0x00F8, 1), (0x02C2, 0), (0x0370, 2),
    (0x037E, 0), (0x037F, 2), (0x0400, 3), (0x0482, 0), (0x048A, 3), (0x0530, 4), (0x055A, 0), (0x0560, 4), (0x0589, 0),
    (0x05D0, 5), (0x05F3, 0), (0x0620, 6), (0x064B, 0), (0x066E, 6), (0x06D4, 0), (0x06D5, 6), (0x06D6, 0), (0x06FA, 6),
    (0x0700, 13), (0x0900, 7), (0x0E00, 8), (0x0F00, 13), (0x10A0, 9), (0x1100, 10), (0x1200, 13), (0x1C80, 3),
    (0x1C90, 9), (0x1CC0, 13), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C00, 13), (0x2C60, 1), (0x2C80, 13),
    (0x2DE0, 3), (0x2E00, 0), (0x3041, 11), (0x3100, 12), (0x3130, 10), (0x3190, 0), (0x31F0, 11), (0x3200, 0),
    (0x3400, 12), (0x4DC0, 0), (0x4E00, 12), (0xA000, 13), (0xA640, 3), (0xA6A0, 13), (0xA720, 1), (0xA800, 13),
    (0xAC00, 10), (0xD7FC, 0), (0xF900, 12), (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 0),
    (0xFF21, 1), (0xFF3B, 0), (0xFF41, 1), (0xFF5B, 0), (0xFF66, 11), (0xFFA0, 10), (0xFFE0, 0), (0x10000, 13),
    (0x1F000, 0), (0x20000, 12), (0xE0000, 0),
]
SCRIPTS = 14
SLICE = 64  # languages scored at a time
# letters are the code points of the Unicode categories L*, whatever their
# block; marks (M*) go on with a word and do not make one
_KIND = np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)], np.int8)
_SCRIPT = np.array([b for _, b in RANGES], np.int8)[np.searchsorted([a for a, _ in RANGES], np.arange(0x110000), "right") - 1]
_SCRIPT = np.where(_KIND > 0, np.where(_SCRIPT > 0, _SCRIPT, 13), 0).astype(np.int8)
_LOWER = np.array([ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(map(chr, range(0x10000)))
                   ], np.uint32)
U32 = np.uint32


def script_of(cp: np.ndarray) -> np.ndarray:
    """Script of letters and marks, 0 for everything else."""
    return _SCRIPT[cp]


@dataclass(frozen=True)
class Model:
    """Log probabilities (buckets x languages) and the scripts a language
    writes (scripts x languages)."""

    langs: tuple[str, ...]
    table: np.ndarray
    writes: np.ndarray


def words_of(text: str):
    """Code points in lower case, word bounds and grams of a text.

    Words are runs of letters and marks that hold a letter; grams are hashed
    with the characters before a position, the edge of a word counting as a
    blank."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), U32)
    low = cp < 0x10000
    cp = np.where(low, _LOWER[np.where(low, cp, 0)], cp).astype(U32)
    script = script_of(cp)
    solid = script > 0
    pad = np.concatenate([[False], solid, [False]])
    starts = np.flatnonzero(pad[1:-1] & ~pad[:-2])
    ends = np.flatnonzero(pad[1:-1] & ~pad[2:]) + 1
    letters = np.concatenate([[0], np.cumsum(_KIND[cp] == 2)])
    real = letters[ends] > letters[starts]
    if not real.all():  # marks alone
        bare = np.zeros(len(cp) + 1, np.int8)
        bare[starts[~real]] += 1
        bare[ends[~real]] -= 1
        solid &= np.cumsum(bare[:-1]) == 0
        script = np.where(solid, script, 0)
        starts, ends = starts[real], ends[real]
    return np.where(solid, cp, U32(32)).astype(U32), script, starts, ends


def grams(cp: np.ndarray) -> list[np.ndarray]:
    """Bucket of the n characters that end at each position, per order."""
    out, h = [], np.zeros(len(cp), U32)
    for k in ORDERS:
        shifted = cp if k == 1 else np.concatenate([np.full(k - 1, 32, U32), cp[:1 - k]]) if len(cp) >= k else np.full(len(cp), 32, U32)
        h = (h ^ (shifted * U32(0x9E3779B1))) * U32(0x85EBCA6B)
        h ^= h >> U32(15)
        out.append(((h * U32(0xC2B2AE35)) >> U32(17)).astype(np.int32))
    return out


def _texts(col: pa.Array, langs: int) -> Iterator[tuple[int, int, str, np.ndarray]]:
    """Chunks of rows as one string, rows apart by a blank, with the offset of
    each row in code points; many languages take smaller chunks."""
    for lo, hi, data, offs in tx.text_chunks(col, 8 * tx.CHUNK // max(4, langs)):
        rows = [data[offs[i]:offs[i + 1]].tobytes().decode("utf-8", "replace") for i in range(hi - lo)]
        yield lo, hi, " ".join(rows) + " ", np.concatenate([[0], np.cumsum([len(t) + 1 for t in rows])])


def _sparse_counts(langs: tuple[str, ...]):
    """``_counts`` for many labels: a chunk gives only the counts it holds."""
    at = {x: i for i, x in enumerate(langs)}
    width = BUCKETS + SCRIPTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang = b.column(1).to_pylist()
            for lo, hi, text, offs in _texts(b.column(0), SLICE):
                cp, script, starts, ends = words_of(text)
                inside = script > 0
                inside[ends] = True  # the blank after a word closes its grams
                own = np.repeat(np.array([at[x] for x in lang[lo:hi]], np.int64), np.diff(offs))
                use = np.flatnonzero(inside)
                base = own[use] * width
                keys = [base + g[use] for g in grams(cp)] + [base + BUCKETS + script[use]]
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key // width, pa.int32()), pa.array(key % width, pa.int32()), pa.array(n, pa.int64())],
                    names=["lang", "bucket", "n"])
    return run


def _counts(langs: tuple[str, ...]):
    at = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(langs), BUCKETS), np.int64)
        writes = np.zeros((len(langs), SCRIPTS), np.int64)
        for b in batches:
            lang = b.column(1).to_pylist()
            for lo, hi, text, offs in _texts(b.column(0), len(langs)):
                cp, script, starts, ends = words_of(text)
                inside = script > 0
                inside[ends] = True  # the blank after a word closes its grams
                own = np.array([at.get(lang[lo + i], -1) for i in range(hi - lo)], np.int64)
                own = np.repeat(own, np.diff(offs))
                use = np.flatnonzero(inside & (own >= 0))
                base = own[use] * BUCKETS
                for g in grams(cp):
                    table += np.bincount(base + g[use], minlength=table.size).reshape(table.shape)
                writes += np.bincount(own[use] * SCRIPTS + script[use], minlength=writes.size).reshape(writes.shape)
        i, j = np.nonzero(table)
        a, c = np.nonzero(writes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, a]), pa.int32()), pa.array(np.concatenate([j, c + BUCKETS]), pa.int32()),
             pa.array(np.concatenate([table[i, j], writes[a, c]]), pa.int64())], names=["lang", "bucket", "n"])
    return run


def train(docs: DataFrame, langs: int = 64, text: str = "text", lang: str = "lang", share: float = 0.001,
          smooth: float = 0.5) -> Model:
    """Model of all labels from all rows with a label and a text.  Up to
    ``langs`` labels are counted in one table per task, more as sparse counts;
    the driver takes the counts of ``langs`` labels at a time."""
    prepare(docs.sparkSession)
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    names = tuple(sorted(r[0] for r in rows.select("lang").distinct().collect()))
    if not names:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros((SCRIPTS, 0), bool))
    few = len(names) <= langs
    counted = rows.mapInArrow((_counts if few else _sparse_counts)(names), "lang int, bucket int, n bigint")
    sums = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    scratch = Scratch(docs.sparkSession, "languages")
    if not few:
        sums = scratch.write(sums, "counts")
    table = np.empty((len(names), BUCKETS), np.float32)
    writes = np.empty((len(names), SCRIPTS), bool)
    for lo in range(0, len(names), langs):
        hi = min(lo + langs, len(names))
        part = (sums if few else sums.where(F.col("lang").between(lo, hi - 1))).toPandas()  # at most langs * (BUCKETS + SCRIPTS) rows
        n = np.zeros((hi - lo, BUCKETS + SCRIPTS))
        n[part["lang"].to_numpy() - lo, part["bucket"].to_numpy()] = part["n"].to_numpy()
        t = n[:, :BUCKETS] + smooth
        table[lo:hi] = np.log(t / t.sum(axis=1, keepdims=True))
        seen = n[:, BUCKETS:]
        seen[:, 0] = 0
        writes[lo:hi] = seen > share * np.maximum(1, seen.sum(axis=1, keepdims=True))
    if not few:
        scratch.drop("counts")
    # scores relative to the mean of the languages keep sums small
    table -= table.mean(axis=0, dtype=np.float64).astype(table.dtype)
    return Model(names, np.ascontiguousarray(table.T, np.float32), writes.T)


def word_scores(model: Model, cp, script, starts, ends) -> np.ndarray:
    """Score of each word for each language (mean over the orders)."""
    if not len(starts):
        return np.zeros((0, len(model.langs)))
    inside = script > 0
    inside[ends] = True
    at = np.flatnonzero(inside)
    buckets, first = [g[at] for g in grams(cp)], np.searchsorted(at, starts)
    score = np.empty((len(starts), len(model.langs)))
    for lo in range(0, len(model.langs), SLICE):
        part = model.table[:, lo:lo + SLICE]
        total = np.zeros((len(at), part.shape[1]), np.float32)
        for g in buckets:
            total += np.take(part, g, axis=0)
        # the kept positions of a word run from its start to the blank after it
        score[:, lo:lo + SLICE] = np.add.reduceat(total, first, axis=0).astype(np.float64) / len(ORDERS)
    # languages that do not write the script of the word are out, if any does
    can = model.writes[script[starts]]
    some = can.any(axis=1)
    score[some] = np.where(can[some], score[some], score[some] - 1e4)
    return score


def viterbi(score: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best language per word for the rows whose words are
    ``first[i]:first[i + 1]``, all rows in step, longest first."""
    n, size = score.shape[1], np.diff(first)
    order = np.argsort(-size, kind="stable")
    start = first[:-1][order]
    active = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), "left")  # rows longer than the step
    back = np.zeros(score.shape, np.int8 if n < 128 else np.int16)
    best = np.zeros((len(order), n))
    lanes = np.arange(n)
    for t in range(len(active)):
        m = active[t]
        at = start[:m] + t
        if t == 0:
            best[:m] = score[at]
            continue
        b = best[:m]
        top = b.argmax(axis=1)
        jump = b[np.arange(m), top] - switch
        stay = b >= jump[:, None]
        back[at] = np.where(stay, lanes, top[:, None])
        best[:m] = np.where(stay, b, jump[:, None]) + score[at]
    out = np.zeros(len(score), np.int16)
    now = best.argmax(axis=1) if len(order) else np.zeros(0, int)
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        at = start[:m] + t
        out[at] = now[:m]
        now[:m] = back[at, now[:m]]
    return out


def decode(score: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """``viterbi``, but for rows where one language throughout is surely
    best.  Leaving language k for j over a run of words gains the sum of
    score_j - score_k there and costs a switch; if no run gains more than one
    switch, no path beats staying."""
    out = np.zeros(len(score), np.int16)
    rows = np.flatnonzero(np.diff(first) > 0)
    if not len(rows):
        return out
    a, size = first[rows], np.diff(first)[rows]
    best = np.add.reduceat(score, a, axis=0).argmax(axis=1)
    owner = np.repeat(np.arange(len(rows)), size)
    gain = np.maximum(score - score[np.arange(len(score)), best[owner]][:, None], -100.0)
    # prefix sums per row, each row lower than the one before, so that the
    # running minimum starts anew with every row
    prefix = np.zeros((len(score) + len(rows), score.shape[1]))
    place = np.arange(len(score)) + owner + 1
    prefix[place] = gain
    head = np.arange(len(rows)) + np.concatenate([[0], np.cumsum(size)[:-1]])
    np.cumsum(prefix, axis=0, out=prefix)
    low = (100.0 * (size.max() + 2) * 2) * np.repeat(np.arange(len(rows)), size + 1)
    prefix -= prefix[head][np.repeat(np.arange(len(rows)), size + 1)] + low[:, None]
    rise = np.maximum.reduceat(prefix - np.minimum.accumulate(prefix, axis=0), head, axis=0).max(axis=1)
    stays = rise <= switch
    out[:] = best[owner]
    for_viterbi = np.flatnonzero(~stays)
    if len(for_viterbi):
        words = np.flatnonzero(~stays[owner])
        bounds = np.concatenate([[0], np.cumsum(size[for_viterbi])])
        out[words] = viterbi(score[words], bounds, switch)
    return out


def _predict(model: Model, switch: float, spans: bool):
    names = np.array([*model.langs, "und"], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, found = [], [], []
            for lo, hi, text, offs in _texts(b.column(b.num_columns - 1), len(model.langs)):
                cp, script, starts, ends = words_of(text)
                first = np.searchsorted(starts, offs)
                size = ends - starts
                label = decode(word_scores(model, cp, script, starts, ends), first, switch) if model.langs else np.zeros(len(starts), int)
                for i in range(hi - lo):
                    a, e = first[i], first[i + 1]
                    if a == e or not model.langs:
                        lang.append("und")
                        score.append(0.0)
                        found.append([])
                        continue
                    letters = np.bincount(label[a:e], weights=size[a:e], minlength=len(model.langs))
                    k = int(letters.argmax())
                    lang.append(names[k])
                    score.append(float(letters[k] / letters.sum()))
                    if spans:
                        cut = np.concatenate([[a], a + 1 + np.flatnonzero(np.diff(label[a:e])), [e]])
                        found.append([{"s": int(starts[x] - offs[i]), "e": int(ends[y - 1] - offs[i]), "lang": names[label[x]]}
                                      for x, y in zip(cut[:-1], cut[1:])])
                    else:
                        found.append([])
            kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("lang", pa.string())]))
            keep = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(found, kind)],
                                             names=[*b.schema.names[:-1], "lang_pred", "score", "spans"])
    return run


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), switch: float = 4.0,
             spans: bool = True) -> DataFrame:
    """The ``keep`` columns of every row with ``lang_pred``, ``score`` (share
    of letters in spans of that language) and ``spans`` (start, end in code
    points, language).

    A text that is null or has no letter, or a model without languages, gives
    ``und``, 0 and no spans.  Ties go to the first language by name; repeated
    rows give equal results."""
    prepare(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("__text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_predict(model, switch, spans),
                           f"{head}, lang_pred string, score double, spans array<struct<s:bigint,e:bigint,lang:string>>")


def held_out(doc_id: str = "doc_id") -> Column:
    """Fold of a document: crc32 of its id as text mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def split_and_identify(docs: DataFrame) -> DataFrame:
    """Train on the rows outside the held-out fold, predict all rows."""
    d = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = train(d.where("NOT held_out"))
    return identify(d, model, keep=("doc_id", "held_out"))
