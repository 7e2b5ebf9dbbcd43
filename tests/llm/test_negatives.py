"""Exact residue products, and mining against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.llm import negatives as N


@pytest.mark.parametrize("dim,size", [(1, 3), (64, 300), (64, 127), (65, 1 << 12), (200, 1 << 20), (3, 1 << 26)])
def test_residue_products_are_exact(dim, size):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-size, size + 1, (40, dim)), rng.integers(-size, size + 1, (50, dim))
    a[0], b[0], b[1] = size, size, -size  # the largest score of either sign
    got = N.gemm(N.Residues(a), N.Residues(b), slice(0, 40), N._bound(a, b))
    assert (got.astype(object) == a.astype(object) @ b.astype(object).T).all()


def test_residues_and_primes():
    x = np.arange(-5000, 5000)[None]
    for p in N.PRIMES:
        r = N.residues(x, p).astype(int)
        assert np.abs(r).max() <= p // 2 and ((r - x) % p == 0).all() and N.DEPTH * (p // 2) ** 2 < 1 << 24
        f = np.arange(-(1 << 24) + 1, 1 << 24, 977, dtype=np.float32)
        m = N._mod(f, p).astype(int)
        assert np.abs(m).max() <= p // 2 and ((m - f.astype(int)) % p == 0).all()
    assert N.primes_for(5) == N.PRIMES[:1] and N.primes_for(511) == N.PRIMES[:2]


def brute(rows, is_anchor, k=5):
    v = [(i, y, np.floor(256 * np.array(x, float)).astype(object)) for i, y, x in rows if i is not None and y is not None and x and all(c is not None and np.isfinite(c) for c in x)]
    out = []
    for i, y, x in v:
        if not is_anchor(i):
            continue
        s = sorted((-int(x @ z), j, w) for j, w, z in v if j != i and len(z) == len(x))
        for p, pid, _ in [t for t in s if t[2] == y][:k]:
            hard = [(n, j) for n, j, w in s if w != y and 80 * -p <= 100 * -n <= 100 * -p][:k]
            out += [(i, pid, r + 1, j, -p, -n) for r, (n, j) in enumerate(hard)]
    return sorted(out)


KIND = "vec_id bigint, label int, embedding array<double>"


def some(n, d, labels, seed):
    rng = random.Random(seed)
    mid = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(4)]
    return [(i, rng.randrange(labels), [m + rng.gauss(0, 0.3) for m in mid[rng.randrange(4)]]) for i in range(n)]


@pytest.mark.parametrize("block,anchors", [(4096, 8192), (16, 7)])
def test_mining(spark, monkeypatch, block, anchors):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "ANCHORS", anchors)
    rows = some(300, 6, 3, 1)
    rows += [(1000 + i, 1, rows[0][2]) for i in range(150)]  # one vector for a third of all rows: ties
    rows += [(2000, None, rows[1][2]), (None, 1, rows[1][2]), (2001, 1, None), (2002, 1, []), (2003, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2004, 1, [float("nan")] * 6), (2005, 1, [float("inf")] * 6),
             (2010, 2, [1e300] * 6), (2020, 1, [0.0] * 6), (2030, 2, [1.0, 2.0]), (2040, 1, [1.5, 2.5]), (2041, 2, [1.4, 2.5])]
    d = spark.createDataFrame(rows, KIND).repartition(3).withColumns({c: F.lit(1) for c in ("v", "g", "s", "r", "marks", "score")})
    got = sorted(map(tuple, N.mine(d, F.col("vec_id") % 10 == 0).collect()))
    assert got == brute([r for r in rows if r[0] != 2010], lambda i: i % 10 == 0) and len(got) > 500


def test_odd_tables(spark):
    empty = spark.createDataFrame([], KIND)
    every = F.lit(True)
    assert N.mine(empty, every).count() == 0
    assert N.mine(spark.createDataFrame([(1, 1, [1.0])], KIND), every).count() == 0
    one = [(1, 1, [1.0]), (2, 1, [1.0]), (3, 2, [0.9]), (4, 2, [0.7])]
    assert sorted(map(tuple, N.mine(spark.createDataFrame(one, KIND), every).collect())) == brute(one, lambda i: True)
    assert N.mine(spark.createDataFrame(one, KIND), F.lit(False)).count() == 0
    again = N.mine(spark.createDataFrame([*one, one[2]], KIND), F.col("vec_id") == 1).collect()  # the repeated negative counts twice
    assert sorted((r.negative_id, r["rank"]) for r in again) == [(3, 1), (3, 2)]
    below = [(1, 1, [1.0]), (2, 1, [-1.0]), (3, 2, [-1.0]), (4, 1, [0.0]), (5, 3, [0.0])]
    assert sorted(map(tuple, N.mine(spark.createDataFrame(below, KIND), every).collect())) == brute(below, lambda i: True)
