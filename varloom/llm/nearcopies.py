"""MinHash near-duplicates by a signature-coordinate inverted join.

A document is the set of its distinct shingles (64-bit hashes). Documents with equal sets are one class. A
signature has ``COORDS`` coordinates, each the hash of ``MINS`` minima, and a class is posted under every
(coordinate, value) of its prefix: pairs that agree in ``MATCH`` coordinates share one of the first
``COORDS - MATCH + 1``. A posting group counts, for its members, in how many coordinates they agree
and keeps those above the threshold, not as pairs but as a forest: what is joined already is skipped.
A group of over ``HOT`` members is not gathered: its members are posted again under each further
two coordinates, and whoever shares all three is joined to the least of them by an aggregate.

The forest's trees are families. Only their texts are read again: a family's full sets meet in
tiles of bounded size, where links (shared part of the union at least ``percent``) are
confirmed exactly. A tile counts overlaps with an inverted index, a row for each document but some members of one
component (the largest of a first pass), since pairs within one component change nothing. All confirmed links
together give the components.

A pair at exactly 80 % is missed by the signatures with a probability of 2e-7; every other step is exact.

Nulls, empty texts and texts without words have no shingles and are linked with nothing; their component
is their own id. Rows with a null id belong to the components of their set, and never name them unless
all are null. Rows equal in id and text share one answer, so ``keep`` leaves all or none of them; ``keep_one`` leaves one row of a
component. Empty tables give no rows. Both return all columns as they are; otherwise other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .tables import bitmap, fresh, settled
from .words import SPACED, slices, whole_windows, window_hashes, words

COORDS, MINS, MATCH = 30, 3, 3
HOT = 8192
TILE = 1 << 20  # shingles of a block; a tile holds two at most
BITS = 26

_rng = np.random.default_rng(17)
_MUL = _rng.integers(1, 1 << 63, COORDS * MINS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(0, 1 << 63, COORDS * MINS, dtype=np.uint64)


def shingle_sets(col: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` are one shingle."""
    w = words(col, SPACED, True)
    first = whole_windows(w, size)
    h = window_hashes(w.hash, size)[first] if len(first) else np.zeros(0, np.uint64)
    cut = np.searchsorted(first, w.doc)
    out = []
    for i in range(len(w.doc) - 1):
        s = h[cut[i]:cut[i + 1]]
        if not len(s) and w.doc[i] < w.doc[i + 1]:
            s = window_hashes(w.hash[w.doc[i]:w.doc[i + 1]], int(w.doc[i + 1] - w.doc[i]))
        out.append(np.unique(s))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """COORDS values for each set that is not empty."""
    full = [s for s in sets if len(s)]
    out = np.zeros((len(full), COORDS), np.uint64)
    if full:
        flat, at = np.concatenate(full), np.append(0, np.cumsum([len(s) for s in full]))[:-1]
        for k in range(COORDS):
            for j in range(k * MINS, (k + 1) * MINS):
                out[:, k] = out[:, k] * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat((flat ^ _XOR[j]) * _MUL[j], at)
    return out


def _digest(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, th (hash of the text), n (shingles), c (digest of the set; null if empty), coords."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                sets = shingle_sets(b.column("text"), size)
                sig = iter(signatures(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("th"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([next(sig) if len(s) else None for s in sets], pa.list_(pa.int64()))], names=["doc_id", "th", "n", "c", "coords"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(run, "doc_id bigint, th bigint, n bigint, c bigint, coords array<bigint>")


def _candidates(classes: DataFrame) -> DataFrame:
    """Edges (a, b) between classes, a forest of the pairs that agree in MATCH coordinates."""
    prefix = COORDS - MATCH + 1
    posts = classes.select("c", F.posexplode(F.slice("coords", 1, prefix)).alias("k", "v")).select("c", F.xxhash64("k", "v").alias("kv"), "k")
    groups = settled(posts.groupBy("kv").agg(F.count("*").alias("m")).filter("m > 1"))
    small = F.transform("coords", lambda x: F.shiftright(x, 48).cast("smallint"))  # enough to count agreements by
    usual = posts.join(groups.filter(F.col("m") <= HOT), "kv").join(classes.select("c", small.alias("sig")), "c")

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep: list[tuple[np.ndarray, ...]] = []

        def close(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch | None:
            kv, c, sig = (np.concatenate(x) for x in zip(*parts))
            at = np.append(np.flatnonzero(np.append(True, kv[1:] != kv[:-1])), len(kv))
            a, b = [], []
            two = at[:-1][np.diff(at) == 2]
            ok = (sig[two] == sig[two + 1]).sum(1) >= MATCH
            a.append(c[two[ok]])
            b.append(c[two[ok] + 1])
            for lo, hi in zip(at[:-1], at[1:]):
                if hi - lo > 2:
                    x, y = _forest(sig[lo:hi])
                    a.append(c[lo + x])
                    b.append(c[lo + y])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                e = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["a", "b"])
            return None

        for x in batches:
            kv, c = x.column("kv").to_numpy(), x.column("c").to_numpy()
            sig = x.column("sig").flatten().to_numpy().reshape(-1, COORDS)
            keep.append((kv, c, sig))
            end = len(kv) - 1
            while end >= 0 and kv[end] == kv[-1]:  # the last group may go on
                end -= 1
            if end >= 0:
                keep[-1] = (kv[:end + 1], c[:end + 1], sig[:end + 1])
                if (out := close(keep)) is not None:
                    yield out
                keep = [(kv[end + 1:], c[end + 1:], sig[end + 1:])]
        if keep and (out := close(keep)) is not None:
            yield out

    edges = usual.select("kv", "c", "sig").repartition("kv").sortWithinPartitions("kv").mapInArrow(forest, "a bigint, b bigint").distinct()
    often = groups.filter(F.col("m") > HOT)
    if often.isEmpty():
        return edges
    hot = posts.join(often, "kv").join(classes.select("c", "coords"), "c")
    later = F.expr(f"flatten(transform(sequence(k + 1, {COORDS - 2}), i -> transform(sequence(i + 1, {COORDS - 1}), j -> xxhash64(k, coords[k], i, coords[i], j, coords[j]))))")
    triples = hot.select("c", F.explode(later).alias("t"))
    least = settled(triples.groupBy("t").agg(F.min("c").alias("a"), F.count("*").alias("m")).filter("m > 1").drop("m"))
    return edges.union(triples.join(least, "t").filter("a <> c").select("a", F.col("c").alias("b"))).distinct()


def _forest(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join all members of a group that are linked by agreeing in MATCH coordinates, directly or through others."""
    left = np.arange(len(sig))
    a, b = [], []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            f = front.pop()
            hit = (sig[left] == sig[f]).sum(1) >= MATCH
            if hit.any():
                new, left = left[hit], left[~hit]
                a.append(np.full(len(new), f))
                b.append(new)
                front.extend(new.tolist())
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return cat(a), cat(b)


def _linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component root (a member's number) of each set, joined where the shared part of the union is large enough."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    _, ids = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(ids, kind="stable")
    lists, cut = owner[order], np.append(0, np.cumsum(np.bincount(ids)))
    start = np.append(0, np.cumsum(size))
    root = np.arange(n)
    weight = np.ones(n, np.int64)

    def meet(i: int) -> None:
        mine = ids[start[i]:start[i + 1]]
        lens = cut[mine + 1] - cut[mine]
        at = np.repeat(cut[mine] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
        both = np.bincount(lists[at], minlength=n)
        hit = np.flatnonzero(100 * both >= percent * (size[i] + size - both))
        roots = np.unique(root[hit])
        if len(roots) > 1:
            to = roots[0]
            total = weight[roots].sum()
            root[np.isin(root, roots)] = to
            weight[roots] = 0
            weight[to] = total

    later = []
    for i in np.argsort(-size, kind="stable"):
        if weight[root[i]] > 1 and weight[root[i]] == weight.max():
            later.append(i)
        else:
            meet(i)
    # Only members of one component, followed through its merges, are left out: their pairs with others are seen from the others' side.
    one = int(np.argmax(weight))
    for i in later:
        if root[i] != root[one]:
            meet(i)
    return root


def _named(c: str) -> Column:
    """An id that is never null."""
    return F.coalesce(F.col(c), F.lit(-(1 << 63)))


def _confirmed(docs: DataFrame, families: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (a, b) of a forest over the exact links within families. families: c, id (its first document), n, root."""
    bits = min(BITS, max(16, (8 * families.count()).bit_length()))  # one document in eight passes by chance, more from 2^23 families on
    slot = f"CAST(shiftrightunsigned(xxhash64(id), {64 - bits}) AS INT)"
    held = docs.sparkSession.sparkContext.broadcast(bitmap(families.select(F.expr(slot).alias("s")), "s", bits))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            s = whole.column("s").to_numpy()
            for b in slices(whole.filter(pa.array((held.value[s >> 3] >> (7 - (s & 7))) & 1 == 1)), "text"):
                sets = shingle_sets(b.column("text"), size)
                yield pa.RecordBatch.from_arrays([pa.array([_digest(x) if len(x) else None for x in sets], pa.int64()), b.column("id"), pa.array([x.tobytes() for x in sets], pa.binary())], names=["c", "id", "shingles"])

    asked = docs.select(_named("doc_id").alias("id"), "text").select("id", "text", F.expr(slot).alias("s"))
    sets = asked.mapInArrow(sets_of, "c bigint, id bigint, shingles binary").groupBy("c", "id").agg(F.first("shingles").alias("shingles"))
    load = families.groupBy("root").agg(F.sum("n").alias("load"))
    blocks = families.join(load, "root").withColumn("blocks", F.ceil(F.col("load") / TILE).cast("int")).withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    tiles = blocks.select("c", "id", "root", "block", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    tiles = tiles.select("c", "id", "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    met = sets.join(tiles, ["c", "id"]).select("c", "root", "i", "j", "shingles")

    def confirm(t: pa.Table) -> pa.Table:
        c, at = np.unique(t.column("c").to_numpy(), return_index=True)
        raw = t.column("shingles")
        sets = [np.frombuffer(raw[int(k)].as_py(), np.uint64) for k in at]
        root = _linked(sets, percent)
        e = np.flatnonzero(root != np.arange(len(c)))
        return pa.table({"a": pa.array(c[root[e]]), "b": pa.array(c[e])})

    return met.groupBy("root", "i", "j").applyInArrow(confirm, "a bigint, b bigint").distinct()


def near_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    return _decided(docs, size, percent).drop("th", "root")


def _decided(docs: DataFrame, size: int, percent: int) -> DataFrame:
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = settled(_signed(d, size))
    classes = settled(signed.filter("c IS NOT NULL").groupBy("c").agg(F.min("doc_id").alias("id"), F.max("n").alias("n"), F.max("coords").alias("coords")))
    trees = components(settled(_candidates(classes.select("c", "coords"))))
    families = settled(classes.select("c", _named("id").alias("id"), "n").join(trees.withColumnRenamed("node", "c"), "c"))
    links = components(settled(_confirmed(d, families, size, percent)))
    own = classes.select("c", "id").join(links.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    own = settled(own)
    least = own.groupBy("root").agg(F.min("id").alias("component_id"))
    named = settled(own.join(least, "root").select("c", "component_id", "root"))
    out = signed.select("doc_id", "th", "n", "c").join(named, "c", "left")  # root: null without shingles
    comp = F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"), "root")


def keep(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component (that with its least id), columns as they are; rows without shingles stay."""
    who, th = fresh(docs, "who", "th")
    gone = _decided(docs, size, percent).filter(~F.col("kept")).select(_named("doc_id").alias(who), F.col("th").alias(th)).distinct()
    named = docs.withColumns({who: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))), th: F.xxhash64(F.col("text").cast("string"))})
    return named.join(gone, [who, th], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, also where ids repeat or are all null: that with its least id, of several texts with this id the one
    with the least hash, of equal rows any. Columns as they are; rows without shingles stay."""
    who, th, lead = fresh(docs, "who", "th", "lead")
    rows = settled(_decided(docs, size, percent).filter("root IS NOT NULL").select(_named("doc_id").alias(who), F.col("th").alias(th), "kept", "root"))
    least = settled(rows.filter("kept").groupBy(who, th).agg(F.first("root").alias("root"), F.count("*").alias("n")))
    least = settled(least.join(least.groupBy("root").agg(F.min(th).alias(lead)), "root").select(who, th, "n", (F.col(th) == F.col(lead)).alias("stays")))
    gone = rows.filter("NOT kept").select(who, th).distinct().unionByName(least.filter("NOT stays").select(who, th))
    named = docs.withColumns({who: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))), th: F.xxhash64(F.col("text").cast("string"))})
    left = named.join(gone, [who, th], "left_anti")
    again = least.filter("stays AND n > 1").select(who, th)
    if not again.isEmpty():
        left = left.join(again, [who, th], "left_anti").unionByName(left.join(again, [who, th], "left_semi").dropDuplicates([who, th]))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
