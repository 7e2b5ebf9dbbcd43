"""Removal of passages that occur more than once (windows of consecutive words, same document included).

Each window's Rabin-Karp hash (64 bits) is counted over the corpus. Rows of hashes would be
several times the input, so texts are dealt once, by their row's place in the table, into batches of about ``BATCH`` bytes; a batch
sends its distinct hashes, sorted, as differences in as few bytes as they need, cut into buckets by
their first bits. A bucket gathers one array from each batch, counts in how many batches
each hash lies, and answers each array with one bit a hash. The batch joins its answers, adds the
hashes that it holds several times itself, and merges the marked windows into maximal intervals.

A hash is sent at most once by a batch, so a passage that a third of all documents share weighs
as much as any other, and equal rows are spread over batches. From ``WIDE`` bytes of input on, batches and buckets grow with its square root, so that the
number of arrays (batches x buckets) grows with the input and not with its square. A batch that
is not the one that asked (``docs`` was read differently the second time) fails the job. Two
different windows are taken for one with a chance of about (number of windows)^2 / 2^65 in all.

Nulls: a null text has no words; ids may be null. Rows equal in id and text count as two rows, so
their windows repeat. Texts without ``size`` words lose nothing. Empty tables give no rows.
Other columns are not read.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import SPACED, Words, covered, slices, text_bytes, whole_windows, window_hashes, words

BATCH = 16 << 20
BUCKET = 16 << 20
WIDE = 1 << 40


def _sliced(docs: pa.Table, size: int) -> list[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice of texts: its rows, first word of each text, first words of the windows, their hashes."""
    out = []
    for whole in docs.to_batches():
        for b in slices(whole, "text"):
            w: Words = words(b.column("text"), SPACED, False)
            first = whole_windows(w, size)
            out.append((b, w.doc, first, window_hashes(w.hash, size)[first] if len(first) else np.zeros(0, np.uint64)))
    return out


def _packed(h: np.ndarray) -> tuple[int, bytes]:
    """Sorted distinct hashes as differences of as many bytes as the largest needs."""
    d = np.diff(h, prepend=np.uint64(0))
    width = max(1, (int(d.max()).bit_length() + 7) // 8)
    return width, d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(width: int, data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, width)
    d = np.zeros((len(raw), 8), np.uint8)
    d[:, :width] = raw
    return np.cumsum(d.view("<u8").ravel(), dtype=np.uint64)


def _cuts(h: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket of sorted hashes starts."""
    if not bits:
        return np.array([0, len(h)])
    return np.append(np.searchsorted(h, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)), len(h))


def remove_repeats(docs: DataFrame, size: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, spans (start, length in words) and ``kept`` (words joined by one space) of every row.

    ``docs`` must read the same rows whenever it is evaluated (a table, not a random sample).
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    wide = max(1.0, (total / WIDE) ** 0.5)
    batches = max(1, -(-total // int(BATCH * wide)))
    bits = max(0, (total // int(BUCKET * wide))).bit_length()
    dealt = docs.select("doc_id", text.alias("text"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(batches)).alias("batch"))
    kind = dealt.schema["doc_id"].dataType.simpleString()

    def send(t: pa.Table) -> pa.Table:
        of = t.column("batch")[0].as_py()
        h = np.unique(np.concatenate([x[3] for x in _sliced(t, size)]))
        cut = _cuts(h, bits)
        low = np.uint64((1 << (64 - bits)) - 1)
        full = [k for k in range(len(cut) - 1) if cut[k] < cut[k + 1]]
        sent = [_packed(h[cut[k]:cut[k + 1]] & low) for k in full]
        return pa.table({"bucket": pa.array(full, pa.int32()), "batch": pa.array([of] * len(full), pa.int64()),
                         "width": pa.array([x[0] for x in sent], pa.int32()), "hashes": pa.array([x[1] for x in sent], pa.binary())})

    def count(t: pa.Table) -> pa.Table:
        got = [_unpacked(w, d) for w, d in zip(t.column("width").to_pylist(), t.column("hashes").to_pylist())]
        h = np.sort(np.concatenate(got))
        twice = np.unique(h[1:][h[1:] == h[:-1]])
        del h
        marks = []
        for x in got:
            at = np.minimum(np.searchsorted(twice, x), max(0, len(twice) - 1))
            marks.append(np.packbits(twice[at] == x).tobytes() if len(twice) else None)
        keep = [i for i, m in enumerate(marks) if m and any(m)]
        return pa.table({"bucket": t.column("bucket").take(pa.array(keep, pa.int64())), "batch": t.column("batch").take(pa.array(keep, pa.int64())),
                         "size": pa.array([len(got[i]) for i in keep], pa.int64()), "marks": pa.array([marks[i] for i in keep], pa.binary())})

    def mark(t: pa.Table, answers: pa.Table) -> pa.Table:
        parts = _sliced(t, size)
        all_h = np.concatenate([x[3] for x in parts]) if parts else np.zeros(0, np.uint64)
        h, back, n = np.unique(all_h, return_inverse=True, return_counts=True)
        again, cut = n > 1, _cuts(h, bits)
        del all_h
        for k, size_k, m in zip(answers.column("bucket").to_pylist(), answers.column("size").to_pylist(), answers.column("marks").to_pylist()):
            if size_k != cut[k + 1] - cut[k]:
                raise RuntimeError("a batch holds other rows than when it sent its hashes: the table was read differently the second time")
            again[cut[k]:cut[k + 1]] |= np.unpackbits(np.frombuffer(m, np.uint8), count=cut[k + 1] - cut[k]).astype(bool)
        hit, at = again[back], 0
        out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "spans": [], "kept": []}
        for b, doc, first, hs in parts:
            gone = covered(int(doc[-1]), first[hit[at:at + len(hs)]], size)
            at += len(hs)
            data, off = text_bytes(b.column("text"))
            out["doc_id"] += b.column("doc_id").to_pylist()
            for i in range(b.num_rows):
                g = gone[doc[i]:doc[i + 1]]
                kept = data[off[i]:off[i + 1]].tobytes().split()
                spans = []
                if g.any():
                    kept = list(compress(kept, (~g).tolist()))
                    e = np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0))
                    spans = [{"start": s, "length": z - s} for s, z in zip(e[::2].tolist(), e[1::2].tolist())]
                out["n_words"].append(len(g))
                out["n_removed"].append(int(g.sum()))
                out["spans"].append(spans)
                out["kept"].append(b" ".join(kept))
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        return pa.table({"doc_id": pa.array(out["doc_id"], t.schema.field("doc_id").type), "n_words": pa.array(out["n_words"], pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()),
                         "spans": pa.array(out["spans"], span), "kept": pa.array(out["kept"], pa.binary()).cast(pa.string())})

    sent = dealt.groupBy("batch").applyInArrow(send, "bucket int, batch bigint, width int, hashes binary")
    answers = sent.groupBy("bucket").applyInArrow(count, "bucket int, batch bigint, size bigint, marks binary")
    return dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        mark, f"doc_id {kind}, n_words bigint, n_removed bigint, spans array<struct<start:bigint,length:bigint>>, kept string")
