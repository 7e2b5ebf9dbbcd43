"""Embedding whitening: leading principal components of the vectors, each scaled to unit variance.

Each component c becomes the integer floor(scale * c) + shift. One pass sums them exactly, a second sums the products of
centred components (each task one d x d matrix, rows of matrices summed in two levels of groups), and the d x d
covariance comes to the driver: d is at most ``MOST_DIM``, so that is at most 8 * MOST_DIM^2 bytes, whatever the table's size.
There it is brought to tridiagonal form by Householder reflections, its leading eigenvalues are found by bisection on
Sturm counts, their vectors by inverse iteration, orthogonalised anew within clusters of close eigenvalues. The
projection (d x components doubles) is broadcast, and a third pass measures the covariance of what comes out.

Which rows: vectors that are null, empty, or hold null or non-finite entries, or entries of ``HUGE`` or more in size, take no part.
Vectors of another length than the most frequent one (the longest of several) take no part either: they have no covariance with the others.
A row without id gives rows without id; repeated rows count each time. Directions without variance (an eigenvalue below
d * 2^-50 of the largest) can't be whitened: there are fewer components then, none if all vectors are equal. Empty tables give no rows.
Other columns are not read. ``deviation`` is exact, as a decimal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import reachable

MOST_DIM = 4096
HUGE = float(1 << 20)
FOLDS = 64
ROWS = 2048


@dataclass
class Model:
    n: int
    sums: np.ndarray  # exact, of the integers
    values: np.ndarray  # eigenvalues, falling
    trace: float
    components: np.ndarray  # d x k, unit columns
    error: float = 0.0  # largest entry of the whitened covariance minus the identity

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n of integer rows, by way of the exact n * x - S."""
        return _times(x, self.n, self.sums).astype(np.float64) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.components) / np.sqrt(self.values)


def _times(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S exactly: in 64 bits where they suffice."""
    most = max(int(np.abs(x).max(initial=0)), 1)
    if 2 * n * most < 1 << 62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums.astype(object)


def _deviations(x: np.ndarray, model: Model) -> list[int]:
    y = _times(x, model.n, model.sums)
    top = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    if y.dtype == np.int64 and top * top * max(1, y.shape[1]) < 1 << 62:
        return (y * y).sum(1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in y.tolist()]


def integers(vectors: DataFrame, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """vec_id and x (array of long) of the rows that take part."""
    c = F.col("embedding").cast("array<double>")
    ok = F.coalesce((F.size(c) > 0) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < HUGE)), F.lit(False))
    x = vectors.filter(ok).select("vec_id", F.transform(c, lambda v: F.floor(v * scale).cast("bigint") + shift).alias("x"))
    lengths = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return x.filter(F.size("x") == (lengths[0]["d"] if lengths else 0))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            yield _matrix(b.column("x").slice(lo, ROWS), dim)


def _summed(parts: DataFrame, dim: int) -> np.ndarray:
    """The sum of all tasks' matrices; ``parts`` has rows (i, v) for row i of a task's matrix. Two levels: FOLDS groups a row, then their sums."""

    def add(t: pa.Table) -> pa.Table:
        v = t.column("v").combine_chunks()
        total = _matrix(v, dim).sum(0)
        return pa.table({"i": t.column("i")[:1], "v": pa.array([total], pa.list_(pa.float64()))})

    once = parts.withColumn("fold", F.pmod(F.spark_partition_id(), F.lit(FOLDS))).groupBy("i", "fold").applyInArrow(add, "i int, v array<double>")
    rows = once.groupBy("i").applyInArrow(add, "i int, v array<double>").orderBy("i").collect()
    out = np.zeros((max([r["i"] for r in rows], default=-1) + 1, dim))
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def _rows(m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(m), dtype=np.int32)), pa.array(list(m), pa.list_(pa.float64()))], names=["i", "v"])


def fit(x: DataFrame, components: int = 8) -> Model | None:
    """The model of ``integers(...)``; None without rows."""
    reachable(x.sparkSession)
    first = x.select(F.size("x")).limit(1).collect()
    if not first:
        return None
    dim = first[0][0]
    if dim > MOST_DIM:
        raise ValueError(f"vectors of {dim} components: their covariance would exceed the driver's bound of {MOST_DIM}")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for m in _blocks(batches, dim):
            n += len(m)
            total = [a + b for a, b in zip(total, m.sum(0).tolist())]  # 2,048 rows below 2^41 fit; Python integers don't end
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array(total, pa.decimal128(38, 0))], names=["p", "n", "s"])

    got = x.select("x").mapInArrow(sums, "p int, n bigint, s decimal(38,0)").groupBy("p").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("p").collect()
    n, total = got[0]["n"], np.array([int(r["s"]) for r in got], object)
    base = Model(n, total, np.zeros(0), 0.0, np.zeros((dim, 0)))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((dim, dim))
        for m in _blocks(batches, dim):
            c = base.centred(m)
            out += c.T @ c
        yield _rows(out)

    cov = _summed(x.select("x").mapInArrow(products, "i int, v array<double>"), dim) / n
    cov = (cov + cov.T) / 2
    values, vectors = leading(cov, components)
    keep = values > max(values.max(initial=0.0), 0.0) * dim * 2.0 ** -50
    model = Model(n, total, values[keep], float(np.trace(cov)), vectors[:, keep])
    k = int(keep.sum())
    if not k:
        return model

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((k, k))  # the mean of what is whitened is zero: n * x - S sums to zero exactly
        for m in _blocks(batches, dim):
            w = model.whiten(m)
            out += w.T @ w
        yield _rows(out)

    again = _summed(x.select("x").mapInArrow(whitened, "i int, v array<double>"), k) / n
    model.error = float(np.abs(again - np.eye(k)).max())
    return model


def project(x: DataFrame, model: Model | None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every row of ``x`` and component."""
    kind = x.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return x.sparkSession.createDataFrame([], schema)
    sent = x.sparkSession.sparkContext.broadcast(model)
    share = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mod, k = sent.value, len(sent.value.values)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                m = _matrix(part.column("x"), len(mod.sums))
                at = np.repeat(np.arange(len(m)), k)
                dev = pa.array(_deviations(m, mod), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(m))), pa.array(np.full(len(at), mod.n, np.int64)), dev.take(pa.array(at)),
                    pa.array(mod.whiten(m).ravel()), pa.array(np.tile(share, len(m))), pa.array(np.full(len(at), mod.error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, schema)


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    x = integers(vectors, scale, shift)
    return project(x, fit(x, components))


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the Householder reflections that bring symmetric ``a`` to that form."""
    a = np.array(a, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        if size == 0 or not np.abs(v[1:]).any():
            reflections.append(np.zeros(0))
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        b = a[k + 1:, k + 1:]
        p = b @ v
        w = 2 * (p - (v @ p) * v)
        b -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each of ``at``."""
    least = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, np.abs(e).max(initial=0.0) ** 2)
    q = d[0] - at
    count = (q < 0).astype(int)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < least, -least, q)
        q = d[i] - at - e[i - 1] ** 2 / q
        count += q < 0
    return count


def bisected(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, to the last bits that bisection can part."""
    n = len(d)
    off = np.abs(np.append(e, 0.0)) + np.abs(np.append(0.0, e))
    width = max(float((np.abs(d) + off).max()), np.finfo(float).tiny)
    lo = np.full(k, float((d - off).min()) - 1e-12 * width)
    hi = np.full(k, float((d + off).max()) + 1e-12 * width)
    rank = n - np.arange(k)  # of the (n - j)-th smallest, so many lie below a point above it
    for _ in range(200):
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi) | (hi - lo < np.finfo(float).eps * 1e-3 * width)).all():
            break
        under = below(d, e, mid) >= rank
        hi, lo = np.where(under, mid, hi), np.where(under, lo, mid)
    return lo + (hi - lo) / 2


def _solver(d: np.ndarray, e: np.ndarray, shift: float, tiny: float):
    """Solves (T - shift) y = b by elimination with row exchanges; vanishing pivots become ``tiny``."""
    n = len(d)
    steps, upper = [], np.zeros((n, 3))
    row = [d[0] - shift, e[0] if n > 1 else 0.0, 0.0]
    for i in range(n - 1):
        after = [e[i], d[i + 1] - shift, e[i + 1] if i + 2 < n else 0.0]
        swap = abs(after[0]) > abs(row[0])
        if swap:
            row, after = after, row
        if abs(row[0]) < tiny:
            row[0] = tiny
        f = after[0] / row[0]
        steps.append((swap, f))
        upper[i] = row
        row = [after[1] - f * row[1], after[2] - f * row[2], 0.0]
    upper[n - 1] = [row[0] if abs(row[0]) >= tiny else tiny, 0.0, 0.0]

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.tolist() + [0.0, 0.0]
        for i, (swap, f) in enumerate(steps):
            if swap:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= f * y[i]
        for i in range(n - 1, -1, -1):
            y[i] = (y[i] - upper[i, 1] * y[i + 1] - upper[i, 2] * y[i + 2]) / upper[i, 0]
        return np.array(y[:n])

    return solve


def inverse_iterated(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix for falling ``values``; within a cluster each is made orthogonal to those before it."""
    n, eps = len(d), np.finfo(float).eps
    size = max(float(np.abs(d).max(initial=0)), float(np.abs(e).max(initial=0))) or 1.0
    rng = np.random.default_rng(7)
    out = np.zeros((n, len(values)))
    start, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * size:
            start = j  # of the cluster
        shift = value if j == start else min(value, shift - 10 * eps * size)  # equal values get shifts of their own
        solve = _solver(d, e, shift, eps * size)
        near = out[:, start:j]
        y = rng.normal(size=n)
        for _ in range(6):
            y = solve(y / np.abs(y).max())
            for _ in range(2):
                y -= near @ (near.T @ y)
            y /= np.linalg.norm(y)
        out[:, j] = y
    return out


def leading(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (all, if fewer), falling, and their unit vectors as columns, largest entry positive."""
    k = min(k, len(cov))
    d, e, reflections = tridiagonal(cov)
    values = bisected(d, e, k)
    y = inverse_iterated(d, e, values)
    for j in range(len(reflections) - 1, -1, -1):
        v = reflections[j]
        if len(v):
            y[j + 1:] -= 2 * np.outer(v, v @ y[j + 1:])
    y *= np.sign(y[np.abs(y).argmax(0), np.arange(k)])
    return values, y
