"""Benchmark decontamination by a prefix-filtered set join.

A window (``window`` consecutive words of an item, or all words of a shorter one) occurs in a
document only if all its shingles do. So only one is necessary to join on: shingles are ordered
by how rare they are in the corpus, and the rarest of each window is its prefix. A document's
shingles that are some prefix's meet the windows in an equi-join; the place of the shingle
in the window bounds where the window would start, the document's length where it may end, and
all its words are then compared.

Documents are read twice: to count the benchmark's shingles, and to look prefixes up. Both times a
bit map of fixed size (``1 << BITS`` bits) of the wanted shingles keeps all others from being
shuffled; what passes by chance is thrown out by the join. Nothing else is sent to all tasks.

Words are compared by 64-bit hashes, all of a window's words each.

Nulls: a null text has no words; an item without words occurs nowhere; a null item_id counts as
the empty string in the list. Repeated rows each get their row, repeated items count once by id.
An empty benchmark or table gives no hits or no rows. Very long texts are handled in slices of
words. Other columns are kept by ``clean`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import fresh, settled
from .words import ALNUM, slices, whole_windows, window_hashes, words

BITS = 22


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A bit for every hash's first bits: at most ``1 << BITS`` numbers come to the driver, however many hashes there are."""
    got = hashes.select(F.expr(f"CAST(shiftrightunsigned(sh, {64 - BITS}) AS INT)").alias("s")).distinct().toArrow()
    bits = np.zeros(1 << BITS, bool)
    bits[got.column("s").to_numpy()] = True
    return np.packbits(bits)


def windows_of(benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """item_id, len, words, and the shingles with their places in the window: one row per window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                w = words(b.column("text"), ALNUM, True)
                rows: list[tuple] = []
                for item, lo, hi in zip(b.column("item_id").to_pylist(), w.doc[:-1].tolist(), w.doc[1:].tolist()):
                    h, size = w.hash[lo:hi], min(window, hi - lo)
                    g = min(shingle, size)
                    sh = window_hashes(h, g) if size else h
                    for k in range(hi - lo - size + 1 if size else 0):
                        rows.append((item, size, h[k:k + size].view(np.int64).tolist(), sh[k:k + size - g + 1].view(np.int64).tolist()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())))], names=["item", "len", "words", "shingles"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(run, "item string, len int, words array<bigint>, shingles array<bigint>")


def _rarity(docs: DataFrame, wanted: DataFrame, sizes: list[int]) -> DataFrame:
    """How often each wanted shingle occurs in the corpus (``sh``, ``n``)."""
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.unpackbits(bits.value).astype(bool)
        for whole in batches:
            for b in slices(whole, "text"):
                w = words(b.column("text"), ALNUM, True)
                found = []
                for g in sizes:
                    first = whole_windows(w, g)
                    sh = window_hashes(w.hash, g)[first] if len(first) else np.zeros(0, np.uint64)
                    found.append(sh[on[_slot(sh)]])
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["sh", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "sh bigint, n bigint")
    return wanted.distinct().join(counted.groupBy("sh").agg(F.sum("n").alias("n")), "sh", "left").select("sh", F.coalesce("n", F.lit(0)).alias("n"))


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """Every column-free result per row of ``docs``: doc_id, n_words, n_hit, items (sorted ids), and ``row`` (its key)."""
    spark = docs.sparkSession
    wins = settled(windows_of(benchmark, window, shingle))
    texts = wins.groupBy("words", "len", "shingles").agg(F.min("item").alias("any")).withColumn("wid", F.xxhash64("words", "len")).drop("any")
    sizes = sorted({min(shingle, r.len) for r in wins.select("len").distinct().collect()})  # at most ``window`` lengths
    places = texts.select("wid", "len", "words", F.posexplode("shingles").alias("off", "sh"))
    rare = _rarity(docs, places.select("sh"), sizes)
    prefix = places.join(rare, "sh").groupBy("wid", "len", "words").agg(F.min(F.struct("n", "sh", "off")).alias("m"))
    prefix = settled(prefix.select("wid", "len", "words", F.col("m.sh").alias("sh"), F.col("m.off").alias("off")))
    bits = spark.sparkContext.broadcast(_bitmap(prefix))
    back, ahead = window - 1, window  # words kept around a place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.unpackbits(bits.value).astype(bool)
        for whole in batches:
            for b in slices(whole, "text"):
                w = words(b.column("text"), ALNUM, True)
                n = w.counts()
                at, sh = [], []
                for g in sizes:
                    first = whole_windows(w, g)
                    x = window_hashes(w.hash, g)[first] if len(first) else np.zeros(0, np.uint64)
                    keep = on[_slot(x)]
                    at.append(first[keep])
                    sh.append(x[keep])
                a, s = np.concatenate(at or [np.zeros(0, np.int64)]), np.concatenate(sh or [np.zeros(0, np.uint64)])
                order = np.argsort(a, kind="stable")
                a, s = a[order], s[order]
                ext = np.concatenate([np.zeros(back, np.uint64), w.hash, np.zeros(ahead, np.uint64)])
                near = ext[a[:, None] + np.arange(back + ahead)] if len(a) else np.zeros((0, back + ahead), np.uint64)
                doc = np.searchsorted(w.doc, a, "right") - 1
                cut = np.searchsorted(a, w.doc).astype(np.int32)
                flat = pa.ListArray.from_arrays(np.arange(len(a) + 1, dtype=np.int32) * (back + ahead), pa.array(near.ravel().view(np.int64)))
                cand = pa.StructArray.from_arrays([pa.array(s.view(np.int64)), pa.array((a - w.doc[doc]).astype(np.int32)), flat], ["sh", "pos", "near"])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(cut, cand)], names=["doc_id", "n_words", "cand"])

    seen = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    kind = seen.schema["doc_id"].dataType.simpleString()
    seen = seen.mapInArrow(run, f"doc_id {kind}, n_words bigint, cand array<struct<sh:bigint,pos:int,near:array<bigint>>>")
    seen = settled(seen.withColumn("row", F.monotonically_increasing_id()))
    cand = seen.select("row", "n_words", F.explode("cand").alias("c")).select("row", "n_words", "c.*")
    start = F.col("pos") - F.col("off")
    hits = cand.join(prefix, "sh").filter((start >= 0) & (start + F.col("len") <= F.col("n_words")) & (F.slice("near", back + 1 - F.col("off"), F.col("len")) == F.col("words")))
    hits = settled(hits.select("row", "wid", start.alias("start"), "len"))
    covered = hits.select("row", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("w")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    ids = wins.select(F.xxhash64("words", "len").alias("wid"), "item").distinct()
    items = hits.select("row", "wid").distinct().join(ids, "wid").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return (seen.drop("cand").join(covered, "row", "left").join(items, "row", "left")
            .select("row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, columns as they are.

    A row is known by its id and text; rows equal in both share the decision.
    """
    key, bad = fresh(docs, "key", "bad")
    ident = F.xxhash64(F.col("doc_id"), F.col("text"))
    named = docs.select(ident.alias("doc_id"), "text")
    hit = find(named, benchmark, window).filter("n_hit > 0").select(F.col("doc_id").alias(key), F.lit(True).alias(bad)).distinct()
    return docs.withColumn(key, ident).join(hit, key, "left").filter(F.col(bad).isNull()).select(*[F.col(f"`{c}`") for c in docs.columns])
