"""Document fingerprints by winnowing.

Every ``GRAM`` consecutive code points of a text have a rolling hash; of every ``WINDOW`` consecutive hashes the
smallest is kept, the rightmost where several are, with its position. Two texts that share ``GRAM + WINDOW - 1``
code points in a row (100) therefore keep the same hash at the same place of that passage, whatever stands
around it. A fingerprint is the list of kept (position, hash) as text: 6 bytes an entry (how far on, and
40 bits of hash; farther steps take more), in base64. Likeness is the share of common hashes among the distinct hashes of both.

Texts of fewer than ``WINDOW`` hashes are one window, those of fewer than ``GRAM`` code points one hash of the whole
text. A null text is empty; an empty text has the empty fingerprint, and two empty ones a likeness of 1.
Nothing is normalised: case, space and marks count.

``edited`` meets each document with the next one in descending doc_id (after the last: the first). Rows of one id
stand in the order in which the table is read, null ids last. Splitters drawn from the keys cut that
order into ranges of about ``RANGE`` rows, so an id that many rows share is cut as well. Each range gets the
first row of the range after it, so no window over the whole order is needed; texts are shuffled once and stream in order
through a task, which holds one Arrow batch. ``docs`` must read the same rows whenever it is evaluated (a table, not a random sample).
Very long texts are hashed piece by piece. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import mix, window_hashes

GRAM = 25
WINDOW = 76
PIECE = 1 << 19  # code points hashed at once
RANGE = 2000
MOST_RANGES = 1 << 18
DRAWS = 8
_LOW = (1 << 24) - 1


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _least(h: np.ndarray, window: int) -> np.ndarray:
    """For every window of ``window`` hashes (under 2^40): the place of its smallest one, the rightmost of several."""
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    key = (h << np.uint64(24)) | (np.uint64(_LOW) - np.arange(len(h), dtype=np.uint64))
    blocks = np.full(-(-len(h) // window) * window, np.iinfo(np.uint64).max, np.uint64)
    blocks[:len(h)] = key
    blocks = blocks.reshape(-1, window)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[:n], left[window - 1:window - 1 + n])
    return _LOW - (least & np.uint64(_LOW)).astype(np.int64)


def _hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """Rolling 40-bit hashes of every ``gram`` code points, over all texts alike."""
    return window_hashes(mix(points.astype(np.uint64) + np.uint64(1)), gram) >> np.uint64(24)


def winnow(texts: list[str], gram: int = GRAM, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, hashes) that each text keeps, in order of position."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    lo = 0
    while lo < len(texts):
        hi, size = lo + 1, len(texts[lo])
        while hi < len(texts) and size + len(texts[hi]) <= PIECE:
            size += len(texts[hi])
            hi += 1
        out += _together(texts[lo:hi], gram, window) if size <= PIECE else [_long(texts[lo], gram, window)]
        lo = hi
    return out


def _together(texts: list[str], gram: int, window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    size = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(size) - size
    h = _hashes(_points("".join(texts)), gram)
    at = _least(h, window)  # of windows over all texts; those that cross a text's end are left out
    out = []
    for t, s, n in zip(texts, start.tolist(), size.tolist()):
        grams = n - gram + 1
        if not n:
            out.append((np.zeros(0, np.int64), np.zeros(0, np.uint64)))
        elif grams < 1:
            out.append((np.zeros(1, np.int64), np.array([int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=5).digest(), "big")], np.uint64)))
        elif grams < window:
            k = grams - 1 - int(np.argmin(h[s:s + grams][::-1]))
            out.append((np.array([k]), h[s + k:s + k + 1]))
        else:
            p = at[s:s + grams - window + 1]
            p = p[np.append(True, p[1:] != p[:-1])]
            out.append((p - s, h[p]))
    return out


def _long(text: str, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for one text that is hashed in pieces which share a window."""
    at, hashes = [], []
    for lo in range(0, len(text) - gram - window + 2, PIECE):
        h = _hashes(_points(text[lo:lo + PIECE + gram + window - 2]), gram)
        p = np.unique(_least(h, window))
        at.append(p + lo)
        hashes.append(h[p])
    p, h = np.concatenate(at), np.concatenate(hashes)
    keep = np.append(True, p[1:] != p[:-1])
    return p[keep], h[keep]


def encode(at: np.ndarray, hashes: np.ndarray) -> str:
    """A fingerprint as text: for each entry, steps of 255 as bytes of 255, the rest of the step, five bytes of hash."""
    step = np.diff(at, prepend=0)
    if (step >= 255).any():
        raw = b"".join(b"\xff" * (s // 255) + bytes([s % 255]) + h.to_bytes(5, "big") for s, h in zip(step.tolist(), hashes.tolist()))
    else:
        rows = np.empty((len(at), 6), np.uint8)
        rows[:, 0] = step
        rows[:, 1:] = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
        raw = rows.tobytes()
    return base64.b64encode(raw).decode()


def decode(fingerprint: str) -> list[tuple[int, int]]:
    """The (position, hash) pairs of a fingerprint."""
    raw, out, i, at = base64.b64decode(fingerprint), [], 0, 0
    while i < len(raw):
        while raw[i] == 255:
            at, i = at + 255, i + 1
        at += raw[i]
        out.append((at, int.from_bytes(raw[i + 1:i + 6], "big")))
        i += 6
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Common among distinct hashes; 1 for two empty lists."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars and fingerprint of every row."""
    d = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            prints = [encode(*m) for m in winnow(texts, gram, window)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(prints, pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_chars bigint, fingerprint string")


def _keys(docs: DataFrame) -> DataFrame:
    """Rows in order: by k (descending ids, nulls last), then r (as the table is read)."""
    return docs.withColumns({"k": F.coalesce(F.bitwise_not(F.col("doc_id")), F.lit((1 << 63) - 1)), "r": F.monotonically_increasing_id()})


def _range_of(cuts: np.ndarray, k: np.ndarray, r: np.ndarray) -> np.ndarray:
    """How many of the sorted ``cuts`` (k, r) are at or before each row."""
    ks, rs = cuts["k"], cuts["r"]
    left, right = np.searchsorted(ks, k, "left"), np.searchsorted(ks, k, "right")
    tie = left < right
    for v in np.unique(k[tie]):
        own = tie & (k == v)
        a, b = np.searchsorted(ks, v, "left"), np.searchsorted(ks, v, "right")
        right[own] = a + np.searchsorted(rs[a:b], r[own], "right")
    return right


def in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id and text of every row by range (``rng``), in order, each range followed by the first row (``extra`` = 1) of the range after it."""
    spark = docs.sparkSession
    d = _keys(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    ids = _keys(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))).select("k", "r")  # the same scan, so the same r
    n = ids.count()
    ranges = max(1, min(MOST_RANGES, n // RANGE))
    u = F.pmod(F.xxhash64("k", "r", F.lit(17)), F.lit(1 << 30)) / (1 << 30)
    drawn = ids.filter(u < DRAWS * ranges / max(1, n)).toPandas().sort_values(["k", "r"])  # about DRAWS keys a range
    kind = np.dtype([("k", "<i8"), ("r", "<i8")])
    cuts = np.zeros(len(drawn[DRAWS::DRAWS]), kind)
    cuts["k"], cuts["r"] = drawn.k.to_numpy()[DRAWS::DRAWS], drawn.r.to_numpy()[DRAWS::DRAWS]
    sent = spark.sparkContext.broadcast(cuts)

    @F.pandas_udf("int")
    def range_of(k: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series(_range_of(sent.value, k.to_numpy(), r.to_numpy()).astype(np.int32))

    first = ids.withColumn("rng", range_of("k", "r")).groupBy("rng").agg(F.min(F.struct("k", "r")).alias("f")).select("rng", "f.*").toPandas().sort_values("rng")
    heads = np.zeros(len(first), kind)  # first row of each range that has rows, and the range before it
    heads["k"], heads["r"] = first.k, first.r
    before = np.roll(first.rng.to_numpy(np.int32), 1)
    shared = spark.sparkContext.broadcast((heads, before))

    @F.pandas_udf("array<int>")
    def ranges_of(k: pd.Series, r: pd.Series) -> pd.Series:
        """The row's own range, and the one that it follows if it is the first of its own."""
        heads, before = shared.value
        kk, rr = k.to_numpy(), r.to_numpy()
        out = [[x] for x in _range_of(sent.value, kk, rr).tolist()]
        at = np.maximum(_range_of(heads, kk, rr) - 1, 0)
        for i in np.flatnonzero((heads["k"][at] == kk) & (heads["r"][at] == rr)) if len(heads) else ():
            out[i].append(int(before[at[i]]))
        return pd.Series(out)

    dealt = d.select("doc_id", "text", "k", "r", F.posexplode(ranges_of("k", "r")).alias("extra", "rng"))
    return dealt.repartition("rng").sortWithinPartitions("rng", "extra", "k", "r")


def edited(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, fingerprint of every row; the same of its text with the last half replaced by as much of the next document.

    ``edited_sha256`` is that of the edited text in UTF-8; ``near_edited`` and ``near_next`` are the likeness of the row's fingerprint to that of the
    edited text and of the next document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row so far: range, id, text, marks

        def rows(b: pa.RecordBatch) -> Iterator[tuple]:
            nonlocal held
            texts = b.column("text").to_pylist()
            for row in zip(b.column("rng").to_pylist(), b.column("extra").to_pylist(), b.column("doc_id").to_pylist(), texts, winnow(texts, gram, window)):
                rng, extra, doc, text, marks = row
                if held is not None:
                    if held[0] != rng:
                        raise RuntimeError("a range lacks the row after it: the table was read differently the second time")
                    yield held[1], held[2], held[3], text, marks
                held = None if extra else (rng, doc, text, marks)

        for whole in batches:
            for b in _parts(whole):
                got = list(rows(b))
                if not got:
                    continue
                new = [t[:len(t) - len(t) // 2] + after[:len(t) // 2] for _, t, _, after, _ in got]
                own, other = [g[2] for g in got], winnow(new, gram, window)
                yield pa.RecordBatch.from_arrays([
                    pa.array([g[0] for g in got], pa.int64()), pa.array([len(g[1]) for g in got], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                    pa.array([encode(*m) for m in own], pa.string()), pa.array([encode(*m) for m in other], pa.string()),
                    pa.array([likeness(m[1], o[1]) for m, o in zip(own, other)], pa.float64()), pa.array([likeness(g[2][1], g[4][1]) for g in got], pa.float64()),
                ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
        if held is not None:
            raise RuntimeError("a range lacks the row after it: the table was read differently the second time")

    return in_ranges(docs).select("rng", "extra", "doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _parts(batch: pa.RecordBatch, most: int = 512) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, most):
        yield batch.slice(lo, most)
