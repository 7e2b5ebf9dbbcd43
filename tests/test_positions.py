"""Interval primitives against brute force, on random and on skewed data."""

import random

import pytest
from pyspark.sql import functions as F

from varloom.operators import intervals as iv
from varloom.operators.phasing import rank_by_position
from varloom.operators.positions import number_rows, overlap_pairs, point_in_interval, stab_max

S = "id int, chrom string, start int, end int"


def random_intervals(seed, n, span=60000, hot=0.34):
    """About a third of the rows are copies of one interval."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        if r.random() < hot:
            s, e = 20000, 20040
        else:
            s = r.randrange(span)
            e = s + r.choice([0, 1, 2, 7, 64, 513, 5000])
        out.append((i, r.choice(["a", "b"]), s, e))
    return out


def naive(a, b):
    return {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < x[3] and y[2] < y[3] and x[2] < y[3] and y[2] < x[3]}


@pytest.fixture(scope="module")
def data(spark):
    a, b = random_intervals(1, 150), random_intervals(2, 130)
    return a, b, spark.createDataFrame(a, S), spark.createDataFrame(b, S)


def test_overlap_pairs_equal_naive_join_without_repeats(data):
    a, b, da, db = data
    got = [(r["id"], r["b_id"]) for r in overlap_pairs(da, db).select("id", "b_id").collect()]
    assert len(got) == len(set(got))
    assert set(got) == naive(a, b)


def test_overlap_count_semi_anti(data):
    a, b, da, db = data
    want = {}
    for x, _ in naive(a, b):
        want[x] = want.get(x, 0) + 1
    got = {r["id"]: r["n_overlaps"] for r in iv.overlap_count(da, db).collect()}
    assert got == {x[0]: want.get(x[0], 0) for x in a}
    assert {r["id"] for r in iv.interval_anti(da, db).collect()} == {x[0] for x in a if x[0] not in want}


def test_point_in_interval(spark, data):
    _, b, _, db = data
    pts = [(i, "a", i * 37) for i in range(400)]
    dp = spark.createDataFrame(pts, "pid int, chrom string, pos int")
    got = sorted((r["pid"], r["id"]) for r in point_in_interval(dp, db, "pos", "start", "end", ["chrom"]).collect())
    assert got == sorted((p[0], y[0]) for p in pts for y in b if y[1] == p[1] and y[2] <= p[2] < y[3])


def covered(ivs, chrom):
    return {p for x in ivs if x[1] == chrom for p in range(x[2], x[3])}


@pytest.mark.parametrize("touching", [True, False])
def test_islands(data, touching):
    _, b, _, db = data
    want = set()
    for ch in "ab":
        cur = None
        for s, e in sorted((x[2], x[3]) for x in b if x[1] == ch and x[2] < x[3]):
            if cur and (s <= cur[1] if touching else s < cur[1]):
                cur = (cur[0], max(cur[1], e))
            else:
                if cur:
                    want.add((ch, *cur))
                cur = (s, e)
        want.add((ch, *cur))
    assert {tuple(r) for r in iv.islands(db, touching=touching).select("chrom", "start", "end").collect()} == want


def test_coverage_and_stab_max(spark, data):
    a, b, da, db = data
    cov = {ch: covered(b, ch) for ch in "ab"}
    got = {r["id"]: r["fraction"] for r in iv.interval_coverage(da, db).collect()}
    for x in a:
        n = x[3] - x[2]
        want = len([p for p in range(x[2], x[3]) if p in cov[x[1]]]) / n if n else 0.0
        assert got[x[0]] == pytest.approx(want)
    top = {(r["chrom"], r["start"]): r["top"] for r in stab_max(da, db.withColumn("v", F.col("id")), "start", "start", "end", "v", ["chrom"]).collect()}
    for x in a:
        hits = [y[0] for y in b if y[1] == x[1] and y[2] <= x[2] < y[3]]
        assert top.get((x[1], x[2])) == (max(hits) if hits else None)


def test_nearest_keeps_all_ties(spark):
    a = spark.createDataFrame([(1, "a", 100, 110), (2, "a", 0, 1), (3, "z", 5, 6)], S)
    b = spark.createDataFrame([(10, "a", 80, 90), (11, "a", 120, 130), (12, "a", 85, 90), (13, "a", 500, 600)], S)
    got = sorted((r["id"], r["b_id"], r["distance"]) for r in iv.nearest(a, b).collect())
    assert got == [(1, 10, 11), (1, 11, 11), (1, 12, 11), (2, 10, 80)]


def test_dedup_overlapping_is_pairwise(spark):
    rows = [("A", 100, 10), ("B", 105, 20), ("C", 120, 30), ("D", 500, 5), ("E", 502, 5), ("F", 900, 4), ("AB", 500, 5)]
    d = spark.createDataFrame([(i, "c", p, "N" * n) for i, p, n in rows], "id string, chrom string, pos int, ref string")
    want = {i for i, p, n in rows if not any(j != i and p < q + m and q < p + n and (n < m or (n == m and i > j)) for j, q, m in rows)}
    assert {r["id"] for r in iv.dedup_overlapping(d).collect()} == want


def test_number_rows_spreads_a_hot_key(spark):
    d = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11)).alias("k"), F.col("id").alias("o"))
    got = number_rows(d, ["k"], "o", "n", count="c", chunk=64).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["o"]):
        by.setdefault(r["k"], []).append((r["n"], r["c"]))
    for v in by.values():
        assert v == [(i + 1, len(v)) for i in range(len(v))]


def test_rank_by_position(spark):
    r = random.Random(5)
    rows = [(r.choice("xy"), 77 if r.random() < 0.4 else r.randrange(50000), i) for i in range(600)]
    d = spark.createDataFrame(rows, "g string, pos int, o long")
    got = {(x["g"], x["pos"], x["o"]): x["idx"] for x in rank_by_position(d, ["g"], "pos", "o", "idx", chunk=50).collect()}
    for g in "xy":
        for i, row in enumerate(sorted(x for x in rows if x[0] == g), 1):
            assert got[row] == i


def test_empty_inputs(spark, data):
    _, _, da, _ = data
    none = da.filter("false")
    assert overlap_pairs(da, none).count() == 0
    assert iv.islands(none).count() == 0
    assert {r["n_overlaps"] for r in iv.overlap_count(da, none).collect()} == {0}
