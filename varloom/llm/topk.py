"""Exact top-k inner products by pivot elimination.

Every vector's distances to ``PIVOTS`` pivots are computed once. For a query q and a candidate x the largest
difference of their distances to a pivot bounds the distance of q and x from below, and with the squared
lengths the inner product from above: (|q|^2 + |x|^2 - bound^2) / 2. Queries and candidates are dealt into blocks by
their nearest pivot. A first, small join of the blocks' extremes rules out the pairs of blocks whose bound is below every query's k-th best
score among a bounded sample (which all tasks get); only the others are shipped. A task streams its share of candidate blocks past one query block,
in the order of their bounds, and keeps each query's k best so far. Within a block candidates near the same pivot stand in runs of ``RUN``, each with the least
and largest of its distances to every pivot, so a run has one bound for a query. Runs are evaluated in the order of their bounds, a query drops those
below its k-th best score so far, and all ends when no bound is left that reaches it. Scores themselves are integers and
exact. A query's best of each share meet in one window.

Pivots are chosen farthest-first from a sample of about ``SAMPLE`` vectors. A block of candidates is shuffled once for each block of ``QUERY_BLOCK`` queries that
it can serve; nothing that grows is broadcast.

Vectors that are null or hold null or non-finite components take no part, nor do rows without an id. Rows equal in
id and vector count once; vectors meet only vectors of their own length. Fewer than k candidates give fewer
rows, an empty table none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .tables import settled

PIVOTS = 24
SAMPLE = 1024
QUERY_BLOCK = 2048
BLOCK = 16384
RUN = 64
AT_ONCE = 32
STEP = 512
TASKS = 4096
SLACK = 1e-4  # of single-precision distances, relative to lengths


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = col.combine_chunks().flatten() if isinstance(col, pa.ChunkedArray) else col.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(col), dim).astype(np.float64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; doubles where they are exact."""
    top = max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1) * max(a.shape[1], 1)
    return (a @ b.T).astype(np.int64) if top < 2.0 ** 53 else a.astype(np.int64) @ b.astype(np.int64).T


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * (x @ p.T)
    return np.sqrt(np.maximum(d, 0))


def _pivots(x: np.ndarray) -> np.ndarray:
    """Farthest-first from the sample."""
    if not len(x):
        return x
    got = [int(np.argmax((x * x).sum(1)))]
    near = _distances(x, x[got])[:, 0]
    while len(got) < min(PIVOTS, len(x)):
        got.append(int(near.argmax()))
        near = np.minimum(near, _distances(x, x[got[-1:]])[:, 0])
    return x[got]


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for every row that ``is_query`` (over vec_id) picks."""
    x = F.col("embedding").cast("array<double>")
    ok = x.isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    v = vectors.filter(ok).select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("bigint")).alias("v"))
    v = v.withColumns({"dim": F.size("v"), "key": F.xxhash64("vec_id", "v")}).dropDuplicates(["vec_id", "key", "v"])
    v = settled(v)
    sizes = v.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(is_query).alias("nq")).filter("nq > 0").orderBy("dim").collect()
    out = [_one_length(v.filter(F.col("dim") == r["dim"]), r["dim"], r["n"], r["nq"], is_query, k) for r in sizes]
    empty = vectors.sparkSession.createDataFrame([], "query_id bigint, key bigint, vec_id bigint, score bigint")
    for o in out:
        empty = empty.union(o) if empty is not None else o
    order = W.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return empty.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _one_length(v: DataFrame, dim: int, n: int, nq: int, is_query: Column, k: int) -> DataFrame:
    spark = v.sparkSession
    u = F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 30)) / (1 << 30)
    some = v.filter(u < SAMPLE / n).select("vec_id", "key", "v").toArrow().sort_by([("vec_id", "ascending"), ("key", "ascending")])
    sx = _matrix(some.column("v"), dim) if len(some) else np.zeros((0, dim))
    shared = spark.sparkContext.broadcast((some.column("key").to_numpy() if len(some) else np.zeros(0, np.int64), sx, _pivots(sx)))
    k_best = min(k, len(some))

    @F.arrow_udf("int")
    def nearest(col: pa.Array) -> pa.Array:
        piv = shared.value[2]
        return pa.array((_distances(_matrix(col, dim), piv).argmin(1) if len(piv) and len(col) else np.zeros(len(col))).astype(np.int32))

    v = v.withColumn("near", nearest("v"))

    def dealt(rows: DataFrame, size: int, fill: bool) -> DataFrame:
        """``b``: the nearest pivot and, where that has more than ``size`` rows, a hash; with ``fill`` pivots of few rows share a block."""
        cut, base, at, room = {}, {}, 0, 0  # by pivot: its number of blocks, and the first of them
        for r in sorted(rows.groupBy("near").count().collect()):  # a row a pivot
            cut[r["near"]] = -(-r["count"] // size)
            if fill and cut[r["near"]] == 1 and r["count"] <= room:
                base[r["near"]], room = at - 1, room - r["count"]
            else:
                base[r["near"]], at = at, at + cut[r["near"]]
                room = size - r["count"] if cut[r["near"]] == 1 else 0
        of = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])[F.col("near")] if m else F.lit(0)
        return rows.withColumn("b", (of(base) + F.pmod("key", of(cut))).cast("int")).select("b", "vec_id", "key", "v")

    def packed(t: pa.Table) -> pa.Table:
        m = _matrix(t.column("v"), dim)
        sk, sv, piv = shared.value
        d = _distances(m, piv) if len(piv) else np.zeros((len(m), 0))
        order = np.lexsort((d.min(1), d.argmin(1))) if d.shape[1] else np.arange(len(m))  # near ones lie in one run
        small = np.abs(m).max(initial=0) < 2 ** 31
        one = lambda a: pa.array([a.tobytes()], pa.binary())
        many = lambda a: pa.array([a.tolist()], pa.list_(pa.float64()))
        least = min((int(_floor(t.column("key").to_numpy()[a:a + STEP], m[a:a + STEP], sk, sv, k).min()) for a in range(0, len(m), STEP)), default=0) if k_best else np.iinfo(np.int64).min
        return pa.table({"b": t.column("b")[:1], "lo": many(d.min(0)), "hi": many(d.max(0)), "len2": pa.array([float((m * m).sum(1).max(initial=0))]), "floor": pa.array([least], pa.int64()),
                         "ids": one(t.column("vec_id").to_numpy()[order]), "keys": one(t.column("key").to_numpy()[order]),
                         "wide": pa.array([not small]), "vecs": one(m[order].astype(np.int32 if small else np.int64)), "dist": one(d[order].astype(np.float32))})

    kind = "b int, lo array<double>, hi array<double>, len2 double, floor bigint, ids binary, keys binary, wide boolean, vecs binary, dist binary"
    edge = ["lo", "hi", "len2", "floor"]  # of a block: least and largest distance to each pivot, largest squared length, least score that a k-th best can have
    c = settled(dealt(v, BLOCK, False).groupBy("b").applyInArrow(packed, kind))
    q = settled(dealt(v.filter(is_query), QUERY_BLOCK, True).groupBy("b").applyInArrow(packed, kind).withColumnRenamed("b", "q"))
    nblocks, nq_blocks = c.count(), (q.agg(F.max("q")).first()[0] or 0) + 1  # a number may be free where a hash leaves a block empty
    slices = max(1, min(nblocks, TASKS // max(1, nq_blocks)))

    alive = meetings(c.select("b", *edge), q.select("q", *edge), nq_blocks)

    blob = ["ids", "keys", "wide", "vecs", "dist"]
    cand = c.join(alive, "b").select("q", F.pmod(F.xxhash64("b"), F.lit(slices)).cast("int").alias("s"), F.lit(1).alias("kind"), "top", *blob)
    qs = q.select("q", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("s"), F.lit(0).alias("kind"), F.lit(float("inf")).alias("top"), *blob)

    def load(row: dict) -> tuple[np.ndarray, ...]:
        ids = np.frombuffer(row["ids"], np.int64)
        vec = np.frombuffer(row["vecs"], np.int64 if row["wide"] else np.int32).reshape(len(ids), -1 if dim else 0).astype(np.float64)
        return ids, np.frombuffer(row["keys"], np.int64), vec, np.frombuffer(row["dist"], np.float32).reshape(len(ids), -1).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sk, sv, _ = shared.value
        now, parts = None, []
        for batch in batches:
            for i in range(batch.num_rows):  # a row is a block
                row = {x: batch.column(x)[i].as_py() for x in batch.schema.names}
                if not row["kind"]:
                    yield from (p.rows() for p in parts)
                    now = (row["q"], row["s"])
                    ids, keys, vec, dist = load(row)
                    parts = [_Part(ids[a:a + STEP], keys[a:a + STEP], vec[a:a + STEP], dist[a:a + STEP], _floor(keys[a:a + STEP], vec[a:a + STEP], sk, sv, k), k) for a in range(0, len(ids), STEP)]
                elif (row["q"], row["s"]) == now and any(row["top"] >= p.kth.min() for p in parts):
                    block = load(row)
                    for p in parts:
                        if row["top"] >= p.kth.min():
                            p.see(*block)
        yield from (p.rows() for p in parts)

    rows = qs.unionByName(cand).repartition("q", "s").sortWithinPartitions("q", "s", "kind", F.desc("top"))
    return rows.mapInArrow(run, "query_id bigint, key bigint, vec_id bigint, score bigint")


def meetings(blocks: DataFrame, queries: DataFrame, n: int) -> DataFrame:
    """(q, b, top): the pairs of blocks whose bound reaches what some query of q still needs; a few numbers a pair, ``n`` query blocks."""
    ask = queries.select("q", *[F.col(x).alias("q_" + x) for x in ("lo", "hi", "len2", "floor")])
    met = blocks.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(max(0, n - 1))))).join(ask, "q")
    low = F.coalesce(F.array_max(F.transform("lo", lambda x, i: F.greatest(x - F.get("q_hi", i), F.get("q_lo", i) - F.get("hi", i)))), F.lit(0.0))
    low = F.greatest(low - SLACK * (1 + F.sqrt("len2") + F.sqrt("q_len2")), F.lit(0.0))
    top = (F.col("len2") + F.col("q_len2") - low * low) / 2 * (1 + 1e-12) + 1
    return met.withColumn("top", top).filter(F.col("top") >= F.col("q_floor")).select("q", "b", "top")


def _floor(keys: np.ndarray, vecs: np.ndarray, sample_keys: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """A score that each query's k-th best can't fall below: its k-th best among the sample."""
    if len(sample_keys) <= k:
        return np.full(len(vecs), np.iinfo(np.int64).min)
    s = _products(vecs, sample)
    s[keys[:, None] == sample_keys[None]] = np.iinfo(np.int64).min
    return np.partition(s, len(sample_keys) - k, axis=1)[:, len(sample_keys) - k]


class _Part:
    """Some queries and their k best so far."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, vecs: np.ndarray, dist: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.keys, self.vecs, self.dist, self.kth, self.k = ids, keys, vecs, dist, floor, k
        self.len2 = (vecs * vecs).sum(1)
        self.row, self.vec_id, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.row]), pa.array(self.keys[self.row]), pa.array(self.vec_id), pa.array(self.score)], names=["query_id", "key", "vec_id", "score"])

    def see(self, ci: np.ndarray, ck: np.ndarray, cv: np.ndarray, cd: np.ndarray) -> None:
        """Takes over what a block has among each query's k best."""
        qd, q2, c2, kth, nq = self.dist, self.len2, (cv * cv).sum(1), self.kth, len(self.ids)
        runs = np.arange(0, len(ci), RUN)
        slack = SLACK * (1 + np.sqrt(q2[:, None]) + np.sqrt(c2.max(initial=0)))
        low = np.zeros((nq, len(runs)))
        for p in range(cd.shape[1]):
            lo, hi = np.minimum.reduceat(cd[:, p], runs), np.maximum.reduceat(cd[:, p], runs)
            np.maximum(low, np.maximum(lo[None] - qd[:, p, None], qd[:, p, None] - hi[None]), out=low)
        top = (q2[:, None] + np.maximum.reduceat(c2, runs)[None] - np.maximum(low - slack, 0) ** 2) / 2 * (1 + 1e-12) + 1
        order = np.argsort(-top.max(0), kind="stable")
        top = top[:, order]
        rest = np.maximum.accumulate(top[:, ::-1], axis=1)[:, ::-1]  # best bound from here on
        width = np.diff(np.append(runs, len(ci)))
        for j in range(0, len(order), AT_ONCE):
            live = np.flatnonzero(rest[:, j] >= kth)
            if not len(live):
                break
            able = top[live, j:j + AT_ONCE] >= kth[live, None]
            live, use = live[able.any(1)], order[j:j + AT_ONCE][able.any(0)]
            if not len(live) or not len(use):
                continue
            cand = np.concatenate([np.arange(runs[u], runs[u] + width[u]) for u in use])
            s = _products(self.vecs[live], cv[cand])
            r, c = np.nonzero(s >= kth[live, None])
            own = ck[cand[c]] == self.keys[live[r]]
            r, c = r[~own], c[~own]
            row, vec_id, score = np.append(self.row, live[r]), np.append(self.vec_id, ci[cand[c]]), np.append(self.score, s[r, c])
            o = np.lexsort((vec_id, -score, row))
            row, vec_id, score = row[o], vec_id[o], score[o]
            place = np.arange(len(row)) - np.searchsorted(row, np.arange(nq))[row]
            last = place == self.k - 1
            kth[row[last]] = np.maximum(kth[row[last]], score[last])
            keep = place < self.k
            self.row, self.vec_id, self.score = row[keep], vec_id[keep], score[keep]
