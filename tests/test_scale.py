"""Steps that must not depend on a table being small."""

import numpy as np
from pyspark.sql import functions as F

from varloom.operators import depth, genotypes
from varloom.plans import register
from varloom.plans.fixtures import Tables


def cohort(spark):
    rng = np.random.default_rng(1)
    x = rng.poisson(30, (9, 40)) * (1 + np.arange(9)[:, None] % 3)
    x[8] = 5  # no variance
    rows = [(f"s{i}", "chr1" if j < 30 else "chrX", j, int(x[i, j])) for i in range(9) for j in range(40)]
    return x, spark.createDataFrame(rows, "sample string, chrom string, bin int, depth int")


def test_correlations_of_more_samples_than_the_driver_takes(spark, monkeypatch):
    x, d = cohort(spark)
    monkeypatch.setattr(depth, "MOST_SAMPLES", 3)
    monkeypatch.setattr(depth, "BLOCK", 4)
    want = np.corrcoef(x[:8, :30])
    for chunk in (4096, 7):
        monkeypatch.setattr(depth, "CHUNK", chunk)
        got = {(r.sample_a, r.sample_b): r.r for r in depth.sample_correlations(d, ["chr1"]).collect()}
        assert len(got) == 81 and got["s8", "s8"] == 1
        assert all(abs(got[f"s{i}", f"s{j}"] - want[i, j]) < 1e-9 for i in range(8) for j in range(8))
        assert not any(got[f"s{i}", "s8"] for i in range(8))


def test_components_of_more_samples_than_the_driver_takes(spark, monkeypatch):
    _, d = cohort(spark)
    one = {(r.component, r.sample): r for r in depth.dosage_components(d, 3, ["chr1"]).collect()}
    monkeypatch.setattr(depth, "MOST_SAMPLES", 3)
    many = {(r.component, r.sample): r for r in depth.dosage_components(d, 3, ["chr1"]).collect()}
    assert one.keys() == many.keys()
    assert all(abs(one[k].loading - many[k].loading) < 1e-6 and abs(one[k].explained - many[k].explained) < 1e-9 for k in one)
    assert len(depth.dosage_batches(d, 2, 3, least=1, most=8).collect()) == 9


def test_tables_are_judged_by_their_rows_not_their_files(spark, tmp_path):
    path = tmp_path / "part.parquet"
    spark.range(100_000).select(F.col("id").alias("p_partkey"), F.lit("x").alias("p_name")).coalesce(1).write.parquet(str(path))
    stored = sum(f.stat().st_size for f in path.glob("*.parquet"))
    part = Tables(spark, str(tmp_path)).part
    assert part._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 4 * stored


def test_frequencies_have_every_column_again(spark):
    sql = register.ORACLE["allele_frequencies"]
    assert all(c in sql.rsplit("SELECT z.vid", 1)[1] for c in ("s.id", "s.allele_type", "z.nhet", "z.nhomalt", "z.nhomref", "freq_het", "grpmax"))


def test_frequency_totals_are_dealt_by_site_once(spark):
    calls = spark.createDataFrame([(v, s, [0, s % 2], 1) for v in range(4) for s in range(3)], "vid long, sample long, gt array<int>, n_alts int")
    people = spark.createDataFrame([(0, "a", "male"), (1, "b", "female"), (2, "b", "male")], "sample long, population string, sex string")
    plan = genotypes.allele_frequencies(calls, people, ["vid"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.split("REPARTITION_BY_COL")[0].count("Exchange") <= 1


def test_depth_profile_deals_blocks_not_bases(spark):
    """Repeated, null, empty, negative and long runs against plain Python; no shuffle is dealt by base."""
    runs = [("chr1", 0, 70, "a", 3), ("chr1", 0, 70, "a", 3), ("chr1", 60, 66, "b", 5), ("chr1", 64, 64, "b", 9), ("chr1", 128, 5000, "b", None), ("chr1", -70, -60, "a", 2), ("chr2", 0, 10**6, "a", 1), ("chr1", 0, 200, "c", 8), (None, 0, 9, "a", 4), ("chr1", 0, 200, None, 8)]
    windows = [("chr1", 62, 67), ("chr1", 65, 68), ("chr1", -66, -62), ("chr1", 127, 130), ("chr2", 900_000, 900_003), ("chr3", 1, 2), (None, 1, 3), ("chr1", None, 4)]
    r = spark.createDataFrame(runs, "chrom string, start int, end int, sample string, depth int")
    w = spark.createDataFrame(windows, "chrom string, start int, end int")
    got = depth.depth_profile(r, w, spark.createDataFrame([("a",), ("b",), ("d",), ("a",), (None,)], "sample string"))
    want = []
    for c, p in {(c, p) for c, s, e in windows if s is not None for p in range(s, e)}:
        for who in "abd":
            hits = [d or 0 for rc, s, e, rs, d in runs if c is not None and (rc, rs) == (c, who) and s <= p < e]
            want += [(c, p, who, d) for d in hits or [0]]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert dict(got.dtypes)["pos"] == "int"
    exchanges = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in x]
    assert exchanges and not any("pos#" in x.split("hashpartitioning")[1] for x in exchanges)


def test_correlations_meet_blocks_once_and_lay_both_ways_together(spark, monkeypatch, tmp_path):
    """Rows of both orders equal numpy's, whatever the shares of the chunks, and a column file holds each value once (before, 8 bytes a row)."""
    rng = np.random.default_rng(2)
    x = rng.poisson(30, (300, 24))
    rows = [(i, "chr1", j, int(x[i, j])) for i in range(300) for j in range(24) if (i + j) % 9] + [(None, "chr1", 3, 4), (7, "chr1", 30, None)]
    d = spark.createDataFrame(rows, "sample int, chrom string, bin int, depth int")
    v = np.where((np.arange(300)[:, None] + np.arange(24)) % 9, x, 0)
    want = np.corrcoef(np.hstack([v, np.zeros((300, 1))]))
    monkeypatch.setattr(depth, "BLOCK", 30)
    for chunk, shares in ((1024, 64), (5, 64), (5, 200)):  # one chunk; chunks in one task; chunks in several
        monkeypatch.setattr(depth, "CHUNK", chunk)
        monkeypatch.setattr(depth, "SHARES", shares)
        out = depth.sample_correlations(d)
        got = {(r.sample_a, r.sample_b): r.r for r in out.collect()}
        assert len(got) == 301 ** 2 and got[None, None] == 1 and got[None, 5] == got[5, None] == 0
        assert all(abs(got[i, j] - want[i, j]) < 1e-9 for i in range(300) for j in range(300))
        if shares == 64 and chunk == 1024:
            out.withColumn("r", F.round("r", 6)).coalesce(1).write.parquet(str(tmp_path / "r"))
            assert sum(f.stat().st_size for f in (tmp_path / "r").glob("*.parquet")) < 6.5 * 301 ** 2
