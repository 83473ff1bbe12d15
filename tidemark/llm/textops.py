"""Vectorised word work on the text buffer of an Arrow batch.

A batch is cut into chunks of whole rows of about ``CHUNK`` bytes; numpy then
finds words, hashes and shingles for all rows of a chunk at once.  A single
very long text forms a chunk of its own, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U(pow(int(_BASE), -1, 1 << 64))


def mix(x):
    """Finaliser that spreads every input bit over 64 bits."""
    x = np.asarray(x, U)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93))
_POW = {"n": 0, "up": None, "down": None}


def _powers(n: int):
    if _POW["n"] < n:
        m = max(n, CHUNK + 1)
        up, down = np.full(m, _BASE, U), np.full(m, _BASE_INV, U)
        up[0] = down[0] = 1
        _POW.update(n=m, up=np.cumprod(up), down=np.cumprod(down))
    return _POW["up"][:n], _POW["down"][:n]


def text_chunks(col: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of chunks of whole rows; a
    null text has no bytes."""
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, buf = col.buffers()
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def find_words(data: np.ndarray, offs: np.ndarray):
    """Starts and ends of the words of a chunk and, per row, the index of its
    first word (one more entry at the end)."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0] = after[-1] = True
        before[1:] = ~solid[:-1]
        after[:-1] = ~solid[1:]
    before |= edge[:-1]
    after |= edge[1:]
    starts = np.flatnonzero(solid & before)
    ends = np.flatnonzero(solid & after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    up, down = _powers(len(data) + 1)
    acc = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * up[:-1], out=acc[1:])
    return mix((acc[ends] - acc[starts]) * down[starts] + (ends - starts).astype(U) * U(0xA24BAED4963EE407))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


_POSITION = mix(np.arange(1, 65, dtype=U) * U(0x8EBC6AF09C88C6E3)) | U(1)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (shorter by n - 1)."""
    if len(words) < n:
        return np.zeros(0, U)
    out = np.zeros(len(words) - n + 1, U)
    for j in range(n):
        out += words[j:len(words) - n + 1 + j] * _POSITION[j]
    return mix(out)


def shingle_sets(col: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its n-word shingles, A-Z lower
    cased; a text of 1 to n - 1 words has its whole sequence as the one
    shingle; a text without words, or null, has none."""
    for lo, hi, data, offs in text_chunks(col):
        data = lower_ascii(data)
        starts, ends, first = find_words(data, offs)
        words = span_hashes(data, starts, ends)
        sh = shingle_hashes(words, n)
        for i in range(hi - lo):
            a, b = int(first[i]), int(first[i + 1])
            if b - a >= n:
                s = np.sort(sh[a:b - n + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s if keep.all() else s[keep]
            elif b > a:
                yield mix((words[a:b] * _POSITION[:b - a]).sum(dtype=U, keepdims=True) + U(b - a))
            else:
                yield np.zeros(0, U)


def cut_chunks(col: pa.Array, inside: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """``(first row, bytes, offsets, goes on)`` of chunks of whole rows; a row
    of over two chunks comes in pieces, cut at a byte that ``inside`` (a table
    of 256) does not mark, so no word is cut."""
    for lo, _, data, offs in text_chunks(col, limit):
        if len(offs) > 2 or len(data) <= 2 * limit:
            yield lo, data, offs, False
            continue
        at = 0
        while at < len(data):
            end = min(at + limit, len(data))
            while end < len(data) and inside[data[end]]:
                window = inside[data[end:end + limit]]
                end += len(window) if window.all() else int(window.argmin())
            yield lo, data[at:end], np.array([0, end - at]), at > 0
            at = end


def take_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """Spans of a buffer, which may overlap, as Arrow strings of bytes."""
    offs = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)])
    at = np.repeat(starts - offs[:-1], ends - starts) + np.arange(offs[-1])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offs), pa.py_buffer(data[at])])


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def crc_matrix(rows: np.ndarray, before: np.ndarray | int = 0) -> np.ndarray:
    """CRC-32 of each row of a matrix of bytes, all rows a column at a time;
    ``before`` is the CRC of what comes before the row."""
    crc = ~(np.zeros(len(rows), np.uint32) + np.asarray(before, np.uint32))
    for column in np.ascontiguousarray(rows.T):
        crc = _CRC[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
    return ~crc


def by_length(size: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(length, indices)`` of the items of each length."""
    order = np.argsort(size, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(order) else ():
        yield int(size[at[0]]), at
