"""The eigenvalue solver and whitening against numpy and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.llm import whitening as W


def matrices():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    near = q @ np.diag([5] * 5 + [5 - 1e-9] * 3 + [1] * 32) @ q.T
    return {"random": np.cov(rng.normal(size=(64, 300))), "diagonal": np.diag(rng.normal(size=10) ** 2), "identity": np.eye(12), "zero": np.zeros((5, 5)), "single": np.array([[3.0]]),
            "pair": np.array([[2.0, 1], [1, 2]]), "rank one": np.outer(np.arange(9.0), np.arange(9.0)), "clusters": (near + near.T) / 2, "large": np.cov(rng.normal(size=(64, 3000))) * 1e9,
            "blocks": np.kron(np.eye(4), np.array([[2, 1.0, 0], [1, 2, 1], [0, 1, 2]]))}


@pytest.mark.parametrize("name", matrices())
def test_leading_eigenpairs(name):
    a = matrices()[name]
    w, v = W.leading(a, 8)
    k, top = len(w), np.abs(np.linalg.eigvalsh(a)).max() or 1.0
    assert k == min(8, len(a)) and np.abs(w - np.linalg.eigvalsh(a)[::-1][:k]).max() < 1e-13 * top
    assert np.abs(v.T @ v - np.eye(k)).max() < 1e-13 and np.abs(a @ v - v * w).max() < 1e-13 * top


def test_sturm_counts():
    rng = np.random.default_rng(1)
    d, e = rng.normal(size=30), rng.normal(size=29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-4, 4, 50)
    assert W.below(d, e, at).tolist() == [int((values < x).sum()) for x in at]


def brute(rows, scale=1024, shift=100_000, k=8):
    x = [(i, [math.floor(scale * c) + shift for c in v]) for i, v in rows]
    n, s = len(x), [sum(c) for c in zip(*[v for _, v in x])]
    c = np.array([[a - b / n for a, b in zip(v, s)] for _, v in x])
    w, v = np.linalg.eigh(c.T @ c / n)
    return {i: sum((n * a - b) ** 2 for a, b in zip(r, s)) for i, r in x}, dict(zip([i for i, _ in x], (c @ v[:, ::-1][:, :k]) / np.sqrt(w[::-1][:k]))), w[::-1][:k] / w.sum(), n


def rows_of(n, d, seed=2):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rng.normal(size=d) * np.linspace(1, 0.2, d)]) for i in range(n)]


def test_whitening(spark):
    rows = rows_of(500, 12)
    bad = [(1000, None), (1001, [1.0, None] + [0.0] * 10), (1002, [float("nan")] * 12), (1003, [float("inf")] * 12), (1004, []), (1005, [1.0, 2.0]), (1006, [1e30] * 12)]
    v = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>").repartition(5).withColumns({c: F.lit(3) for c in ("x", "n", "i", "v", "label")})
    got = W.whiten(v).collect()
    dev, white, share, n = brute(rows)
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {n} and all(int(r.deviation) == dev[r.vec_id] for r in got)
    mine = np.zeros((len(rows), 8))
    for r in got:
        mine[r.vec_id, r.component - 1] = r.whitened
    want = np.array([white[i] for i, _ in rows])
    want *= np.sign((want * mine).sum(0))
    assert np.abs(mine - want).max() < 1e-9
    assert all(abs(r.explained / share[r.component - 1] - 1) < 1e-10 for r in got) and {r.identity_error for r in got if r.identity_error > 1e-10} == set()


def test_odd_tables(spark):
    kind = "vec_id bigint, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], kind)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, kind)).count() == 0  # no variance
    two = W.whiten(spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (None, [3.0, 2.0, 0.0]), (1, [1.0, 2.0, 0.0])], kind)).collect()  # one direction only
    assert sorted((r.vec_id is None, r.component, r.n) for r in two) == [(False, 1, 3), (False, 1, 3), (True, 1, 3)] and all(abs(r.explained - 1) < 1e-12 for r in two)
    hot = rows_of(40, 5) + [(9, [0.5, 0.25, 0.0, 0.0, -1.0])] * 400
    dev, white, share, n = brute(hot, k=5)
    got = W.whiten(spark.createDataFrame(hot, kind).repartition(7)).collect()
    assert len(got) == 5 * len(hot) and all(int(r.deviation) == dev[r.vec_id] for r in got if r.vec_id != 9) and max(r.identity_error for r in got) < 1e-10
    with pytest.raises(ValueError):
        W.whiten(spark.createDataFrame([(1, [0.0] * (W.MOST_DIM + 1))], kind))


def test_deviation_beyond_64_bits():
    m = W.Model(1 << 45, np.array([3 << 45, 1], object), np.zeros(0), 0.0, np.zeros((2, 0)))
    x = np.array([[1 << 17, 5], [2, 7]], np.int64)
    assert W._deviations(x, m) == [sum((m.n * int(a) - int(b)) ** 2 for a, b in zip(r, m.sums)) for r in x.tolist()]
