"""Words and word windows of whole texts as numpy arrays, straight from Arrow buffers.

Separators are ASCII, so UTF-8 can be cut byte by byte. A word's hash is the value of its
bytes as a polynomial mod 2^64 (prefix sums make it one subtraction a word), then mixed.
Per-byte work runs over pieces of at most ``PIECE`` bytes (or one longer word), so memory
follows the words of the texts at hand, never eight times a very long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
SLICE = 2 << 20

_R = np.uint64(0x9E3779B97F4A7C55)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes that words are made of: everything but ASCII white space; or digits, ASCII letters and all non-ASCII bytes.
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, PIECE + 1)
        for k, r in enumerate((_R, _R_INV)):
            p = np.full(size, r, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each text's offset (one more than texts); nulls are empty."""
    col = pc.fill_null(col, "") if col.null_count else col
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32, len(col) + 1, col.offset * (8 if wide else 4)).astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold at most ``most`` bytes together (or a single row)."""
    _, off = text_bytes(batch.column(text))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield batch.slice(lo, min(hi, n) - lo)
        lo = min(hi, n)


@dataclass
class Words:
    start: np.ndarray  # byte offsets into ``data``
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray  # first word of each text; one entry more than texts
    data: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.doc)

    def ids(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.doc) - 1), self.counts())


def words(col: pa.Array, inside: np.ndarray, lower: bool) -> Words:
    """``inside`` gives each byte's kind, 0 for separators; a word is a run of one kind."""
    data, off = text_bytes(col)
    starts, ends, hashes = [], [], []
    lo, n = 0, len(data)
    while lo < n:
        hi = _cut(data, off, lo, min(lo + PIECE, n), inside)
        b = data[lo:hi]
        w = inside[b]
        edge = np.empty(len(b), bool)  # a word can't go on from the byte before
        edge[0] = True
        np.not_equal(w[:-1], w[1:], out=edge[1:])
        cuts = off[np.searchsorted(off, lo, "left"):np.searchsorted(off, hi, "left")] - lo
        edge[cuts] = True
        w = w != 0
        s = np.flatnonzero(w & edge)
        e = np.flatnonzero(w & np.append(edge[1:], True)) + 1
        p, inv = powers(len(b))
        c = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[b] if lower else b] * p[:len(b)], out=c[1:])
        h = (c[e] - c[s]) * inv[s]
        starts.append(s + lo)
        ends.append(e + lo)
        hashes.append(mix(h + (e - s).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)))
        lo = hi
    cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
    start = cat(starts, np.int64)
    return Words(start, cat(ends, np.int64), cat(hashes, np.uint64), np.searchsorted(start, off, "left"), data)


def _cut(data: np.ndarray, off: np.ndarray, lo: int, hi: int, inside: np.ndarray) -> int:
    """``hi`` or a place near it where no word is cut."""
    n = len(data)
    if hi >= n or not inside[data[hi]] or not inside[data[hi - 1]]:
        return hi
    gaps = np.flatnonzero(inside[data[lo:hi]] == 0)
    if len(gaps):
        return lo + int(gaps[-1]) + 1
    nxt = off[np.searchsorted(off, lo, "right"):]
    stop = int(nxt[nxt > lo][0]) if len(nxt[nxt > lo]) else n
    for a in range(hi, stop, PIECE):
        gaps = np.flatnonzero(inside[data[a:min(a + PIECE, stop)]] == 0)
        if len(gaps):
            return a + int(gaps[0]) + 1
    return stop


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Rolling hash of every ``size`` consecutive hashes (``len(h) - size + 1`` of them, over all texts alike)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    q = 0xA24BAED4963EE407
    out, have, run, span = None, 0, h, 1  # run: hashes of every ``span`` words
    while True:
        if size & span:
            part = run[have:have + n]
            out = part.copy() if out is None else out + part * np.uint64(pow(q, have, 1 << 64))
            have += span
        span *= 2
        if span > size:
            return mix(out)
        half = span // 2
        run = run[:len(run) - half] + run[half:] * np.uint64(pow(q, half, 1 << 64))


def whole_windows(w: Words, size: int) -> np.ndarray:
    """First words of the windows of ``size`` words that lie in one text."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    ok = np.ones(n + size, bool)
    for k in range(1, size):  # a window must not start within size - 1 words before a text's end
        at = w.doc[1:] - k
        ok[at[at >= 0]] = False
    first = np.flatnonzero(ok[:n])
    ids = np.searchsorted(w.doc, first, "right") - 1
    return first[first + size <= w.doc[ids + 1]]


def covered(n: int, first: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in the windows that start at ``first``."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, first, 1)
    np.add.at(d, first + size, -1)
    return np.cumsum(d[:-1]) > 0
