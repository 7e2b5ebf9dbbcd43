"""Hard-negative mining by exact integer scores of a residue-number-system matrix product.

Vectors become integers floor(scale * component). For an inner product of two blocks, both are taken modulo several small
primes (residues within p / 2 of zero), multiplied as float32 matrices, ``DEPTH`` components at a time so that every
partial sum stays below 2^24 and is exact, and the signed score is put together by Chinese remaindering (mixed-radix
digits within p / 2 of zero). As many primes are used as the product of the blocks' largest lengths asks for.

Anchors are packed into blocks of about ``ANCHORS`` rows, which are sent to every slice of the table; a slice streams
its candidate blocks past the anchors, so a task holds one anchor block, one candidate block and each anchor's best so
far. A first round finds each anchor's positives (its best rows of the same label), a second finds, for each positive, the best
rows of other labels whose score lies in the positive's window: low * positive_score <= 100 * negative_score <= high * positive_score.
The table is shuffled once for every ``ANCHORS`` anchors and meets them all, so arithmetic outweighs the shuffle (DEPTH * ANCHORS
multiplications for each component sent). Candidates are dealt by their place in the input, so copies of a vector are spread over slices.

Which rows: rows without id or label, and vectors that are null, empty or hold null or non-finite components, take no part,
nor do those whose squared integer length is 2^56 or more. Scores exist between vectors of one length; others don't meet.
An anchor never meets rows of its own id. Repeated rows each count; equal scores of equal ids are equal rows or stand in any order.
A positive of negative score has an empty window. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .tables import reachable, settled

#: The largest primes whose residues keep a sum of DEPTH products below 2^24.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
DEPTH = 64
ANCHORS = 8192
BLOCK = 4096
STEP = 256
TASKS = 4096
LONGEST = float(1 << 56)


def _mod(x: np.ndarray, p: int) -> np.ndarray:
    """float32 integers below 2^24 in size, modulo p, within p / 2 of zero."""
    inv = np.float32(1 / p)
    x = x - np.float32(p) * np.rint(x * inv)
    return x - np.float32(p) * np.rint(x * inv)  # the first quotient may be one off; this one is not


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Integer rows modulo p as float32, within p / 2 of zero."""
    r = np.mod(x, p)
    return (r - p * (r > p // 2)).astype(np.float32)


def primes_for(bound: int) -> tuple[int, ...]:
    """So many primes that every integer of at most ``bound`` in size has residues of its own."""
    product = 1
    for k, p in enumerate(PRIMES):
        product *= p
        if product > 2 * bound:
            return PRIMES[:k + 1]
    raise ValueError("scores of this size need more primes")


def _bound(a: np.ndarray, b: np.ndarray) -> int:
    """A bound of the inner products of rows of ``a`` and ``b``: the product of their largest lengths."""
    longest = lambda x: np.sqrt((x.astype(np.float64) ** 2).sum(1).max(initial=0.0))
    return int(longest(a) * longest(b) * (1 + 1e-9)) + 1


class Residues:
    """A block's residues, made once a prime."""

    def __init__(self, x: np.ndarray):
        self.x, self.by = x, {}

    def of(self, p: int) -> np.ndarray:
        if p not in self.by:
            self.by[p] = residues(self.x, p)
        return self.by[p]


def _product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p in float32, exactly."""
    out = None
    for lo in range(0, max(1, a.shape[1]), DEPTH):
        part = _mod(a[:, lo:lo + DEPTH] @ b[:, lo:lo + DEPTH].T, p)
        out = part if out is None else _mod(out + part, p)
    return out


def gemm(a: Residues, b: Residues, rows: slice, bound: int) -> np.ndarray:
    """The exact inner products of ``a``'s ``rows`` with all of ``b`` as 64-bit integers."""
    used = primes_for(bound)
    digits: list[np.ndarray] = []
    for k, p in enumerate(used):
        v = _product(a.of(p)[rows], b.of(p), p)
        for q, d in zip(used[:k], digits):  # mixed radix: ((v - d0) / p0 - d1) / p1 ... modulo p
            inv = pow(q, -1, p)
            v = _mod((v - d) * np.float32(inv - p if inv > p // 2 else inv), p)
        digits.append(v)
    out = digits[-1].astype(np.int64)
    for q, d in zip(used[-2::-1], digits[-2::-1]):
        out *= q
        out += d.astype(np.int64)
    return out


def prepared(vectors: DataFrame, scale: int = 256, label: Column | None = None) -> DataFrame:
    """vec_id, label, v (array of long) of the rows that take part."""
    c = F.col("embedding").cast("array<double>")
    x = F.transform(c, lambda v: F.floor(v * scale).cast("double"))
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LONGEST))
    short = F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v) < LONGEST
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce((F.size(c) > 0) & finite, F.lit(False))
    return vectors.filter(ok).filter(short).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), (F.col("label") if label is None else label).cast("bigint").alias("label"), F.transform(x, lambda v: v.cast("bigint")).alias("v"))


PACKED = "d int, ids binary, labels binary, vecs binary"


def _pack(t: pa.Table | pa.RecordBatch) -> list[tuple[int, bytes, bytes, bytes]]:
    """(length of the vectors, ids, labels, vectors) of rows in order, one for each length."""
    v = t.column("v")
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    size = np.diff(v.offsets.to_numpy())
    ids, labels = (t.column(c).to_numpy() for c in ("vec_id", "label"))
    out = []
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        m = v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        small = np.abs(m).max(initial=0) < 1 << 15
        out.append((int(d), ids[at].tobytes(), labels[at].tobytes(), m.astype(np.int16 if small else np.int64).tobytes()))
    return out


def _vectors(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
    wide = len(row["vecs"]) == 8 * row["d"] * len(ids)
    return ids, labels, np.frombuffer(row["vecs"], np.int64 if wide else np.int16).reshape(len(ids), row["d"])


def _best(row: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's first k by (score falling, vec_id), in order."""
    o = np.lexsort((vec_id, -score, row))
    r = row[o]
    return o[np.arange(len(o)) - np.searchsorted(r, r, "left") < k]


class _Best:
    """Each slot's first k (score, vec_id) so far."""

    def __init__(self, slots: int, k: int):
        self.k, self.kth = k, np.full(slots, np.iinfo(np.int64).min)
        self.slot, self.score, self.vec_id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, vec_id = np.append(self.slot, slot), np.append(self.score, score), np.append(self.vec_id, vec_id)
        keep = _best(slot, score, vec_id, self.k)
        self.slot, self.score, self.vec_id = slot[keep], score[keep], vec_id[keep]
        full = np.arange(len(keep)) - np.searchsorted(self.slot, self.slot, "left") == self.k - 1
        self.kth[self.slot[full]] = self.score[full]


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, label: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    reachable(vectors.sparkSession)
    v = prepared(vectors, scale, label)
    n, anchors = v.agg(F.count("*"), F.count_if(is_anchor)).first()
    groups = max(1, -(-anchors // ANCHORS))
    slices = max(1, min(-(-n // BLOCK), TASKS // groups))

    def pack_anchors(t: pa.Table) -> pa.Table:
        got = _pack(t)
        return pa.table({"g": pa.array([t.column("g")[0].as_py()] * len(got), pa.int32()), **{c: pa.array([x[i] for x in got], pa.int32() if not i else pa.binary()) for i, c in enumerate(("d", "ids", "labels", "vecs"))}})

    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                got = _pack(b.slice(lo, BLOCK))
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in got], pa.int32() if not i else pa.binary()) for i in range(4)], names=["d", "ids", "labels", "vecs"])

    dealt = v.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int")).filter(is_anchor)
    first = settled(dealt.groupBy("g").applyInArrow(pack_anchors, f"g int, {PACKED}"))
    blocks = v.mapInArrow(pack_rows, PACKED).withColumn("r", F.monotonically_increasing_id())
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    blocks = blocks.withColumn("s", F.pmod(F.xxhash64("r"), F.lit(slices)).cast("int")).withColumn("g", each(groups)).select("g", "s", F.lit(1).alias("kind"), "r", "d", "ids", "labels", "vecs", F.lit(None).cast("binary").alias("marks"))

    def meet(anchor_blocks: DataFrame, search, schema: str) -> DataFrame:
        """``search`` over the streams of (anchor block, slice): the anchors first, then the slice's candidate blocks."""
        a = anchor_blocks.withColumn("s", each(slices)).select("g", "s", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("r"), "d", "ids", "labels", "vecs", "marks")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, state = None, {}
            for b in batches:
                for i in range(b.num_rows):  # a row is a block
                    row = {c: b.column(c)[i].as_py() for c in b.schema.names}
                    if (row["g"], row["s"]) != now:
                        for x in state.values():
                            yield from x.rows()
                        now, state = (row["g"], row["s"]), {}
                    if not row["kind"]:
                        state[row["d"]] = search(row)
                    elif row["d"] in state:
                        state[row["d"]].see(row)
            for x in state.values():
                yield from x.rows()

        rows = a.unionByName(blocks)
        return rows.repartition("g", "s").sortWithinPartitions("g", "s", "kind", "r").mapInArrow(run, schema)

    class Search:
        def __init__(self, row: dict):
            self.g, self.d = row["g"], row["d"]
            self.ids, self.labels, self.x = _vectors(row)
            self.res = Residues(self.x)

        def pieces(self, row: dict) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
            """Some anchors at a time: their scores with the candidate block, whether the labels agree, the candidates' ids."""
            ids, labels, x = _vectors(row)
            other, bound = Residues(x), _bound(self.x, x)
            for lo in range(0, len(self.ids), STEP):
                at = slice(lo, lo + STEP)
                score = gemm(self.res, other, at, bound)
                yield at, score, self.labels[at, None] == labels[None], ids

    class Positives(Search):
        def __init__(self, row: dict):
            super().__init__(row)
            self.best = _Best(len(self.ids), positives)

        def see(self, row: dict) -> None:
            for at, score, same, ids in self.pieces(row):
                i, j = np.nonzero(same & (score >= self.best.kth[at, None]))
                other = ids[j] != self.ids[at][i]
                i, j = i[other], j[other]
                self.best.add(i + at.start, score[i, j], ids[j])

        def rows(self) -> Iterator[pa.RecordBatch]:
            b = self.best
            if len(b.slot):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.slot), x, np.int32)) for x in (self.g, self.d)] + [pa.array(b.slot), pa.array(self.ids[b.slot]), pa.array(b.vec_id), pa.array(b.score)],
                                                 names=["g", "d", "a", "anchor_id", "positive_id", "positive_score"])

    class Negatives(Search):
        def __init__(self, row: dict):
            super().__init__(row)
            self.top = np.frombuffer(row["marks"], np.int64).reshape(len(self.ids), positives)  # scores of the positives; below zero there is no window
            self.bottom = np.array([-(-low * s // 100) for s in self.top.ravel().tolist()], np.int64).reshape(self.top.shape)
            self.most = np.array([high * s // 100 for s in self.top.ravel().tolist()], np.int64).reshape(self.top.shape)
            self.best = _Best(self.top.size, negatives)

        def see(self, row: dict) -> None:
            for at, score, same, ids in self.pieces(row):
                kth = self.best.kth.reshape(self.top.shape)[at]
                least = np.where(self.top[at] >= 0, np.maximum(self.bottom[at], kth), np.iinfo(np.int64).max)
                i, j = np.nonzero((score >= least.min(1)[:, None]) & (score <= self.most[at].max(1)[:, None]) & ~same)  # few are left
                other = ids[j] != self.ids[at][i]
                i, j = i[other], j[other]
                s = score[i, j]
                for k in range(positives):
                    ok = (s >= least[i, k]) & (s <= self.most[at][i, k])
                    self.best.add((i[ok] + at.start) * positives + k, s[ok], ids[j[ok]])

        def rows(self) -> Iterator[pa.RecordBatch]:
            b = self.best
            if len(b.slot):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.slot), x, np.int32)) for x in (self.g, self.d)] + [pa.array(b.slot // positives), pa.array((b.slot % positives + 1).astype(np.int32)), pa.array(b.vec_id), pa.array(b.score)],
                                                 names=["g", "d", "a", "p", "negative_id", "negative_score"])

    found = meet(first.withColumn("marks", F.lit(None).cast("binary")), Positives, "g int, d int, a bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    order = W.partitionBy("g", "d", "a").orderBy(F.desc("positive_score"), "positive_id")
    found = settled(found.withColumn("p", F.row_number().over(order)).filter(F.col("p") <= positives))

    def mark(block: pa.Table, scores: pa.Table) -> pa.Table:
        """A packed anchor block with the scores of its positives; -1 where there is no positive, or one below zero."""
        if not block.num_rows:
            return pa.table({"g": pa.array([], pa.int32()), "d": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in ("ids", "labels", "vecs", "marks")}})
        m = np.full((len(block.column("ids")[0].as_py()) // 8, positives), -1, np.int64)
        m[scores.column("a").to_numpy(), scores.column("p").to_numpy() - 1] = np.maximum(scores.column("positive_score").to_numpy(), -1)
        return block.append_column("marks", pa.array([m.tobytes()], pa.binary()))

    marked = first.groupBy("g", "d").cogroup(found.select("g", "d", "a", "p", "positive_score").groupBy("g", "d")).applyInArrow(mark, f"g int, {PACKED}, marks binary")
    hard = meet(marked, Negatives, "g int, d int, a bigint, p int, negative_id bigint, negative_score bigint")
    order = W.partitionBy("g", "d", "a", "p").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return hard.join(found, ["g", "d", "a", "p"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
