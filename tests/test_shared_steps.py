"""Steps that several parts of a query need are done once, and calls that come grouped are not dealt again."""

import random

import pytest
from pyspark.sql import Window as W, functions as F

from varloom.operators import matching as m, phasing as ph, positions as po, transfer as tr, truth as tt
from varloom.plans import register  # noqa: F401


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ------------------------------------------------------------------ gene effects

def test_effects_look_all_features_up_at_once(spark, monkeypatch):
    calls = []
    real = m.overlap_pairs
    monkeypatch.setattr(m, "overlap_pairs", lambda a, b, **k: calls.append(1) or real(a, b, **k))
    svs = spark.createDataFrame([("dup", "c", 90, 300, "DUP"), ("del", "c", 145, 150, "DEL"), ("utr", "c", 105, 106, "DEL"), ("far", "c", 5000, 5001, "INS"), ("pro", "c", 60, 61, "INS"),
                                 ("dup", "c", 90, 300, "DUP"), (None, "c", 90, 300, "DUP"), ("none", "d", 5, 6, "DEL"), ("el", "e", 10, 30, "DEL"), ("bare", None, 1, 9, "DEL")],
                                "id string, chrom string, start int, end int, svtype string")
    part = lambda *r: spark.createDataFrame(list(r), "gene string, chrom string, start bigint, end bigint")
    genes = part(("G", "c", 100, 200), ("G", "c", 100, 200)).withColumn("tss", F.col("start"))
    out = m.predicted_effects(svs, genes, part(("G", "c", 140, 190)), part(("G", "c", 50, 100)), part(("G", "c", 100, 140)), part(("E", "e", 12, 20), (None, "c", 4000, 6000)))
    got = sorted((r.id or "-", r.effect.removeprefix("PREDICTED_"), tuple(r.genes)) for r in out.collect())
    assert got == sorted([("dup", "COPY_GAIN", ("G",)), ("-", "COPY_GAIN", ("G",)), ("-", "PROMOTER", ("G",)), ("-", "NEAREST_TSS", ("G",)), ("del", "LOF", ("G",)), ("utr", "UTR", ("G",)), ("-", "INTERGENIC", ()), ("far", "NEAREST_TSS", ("G",)),
                          ("far", "NONCODING_BREAKPOINT", ()), ("pro", "PROMOTER", ("G",)), ("none", "INTERGENIC", ()), ("el", "NONCODING_SPAN", ("E",)), ("bare", "INTERGENIC", ())])
    assert len(calls) == 1


# ------------------------------------------------------------------ haplotype overlaps

def haplotype_input(spark):
    kinds = ["del", "ins", "snv", "alu_ins", "trv"]
    data = [(i, s, 1 + (i * 37 + s) % 150 if i % 9 else 7, "A" * (700 if i % 11 == 0 else 0 if i % 13 == 0 else 1 + i % 40), kinds[i % 5], i % 4 * 10 - 10, i % 6, i % 3, [i % 2, s % 2], i % 7 > 0) for i in range(90) for s in (1, 2)]
    data += data[:9] + [(None, 1, 3, None, "del", 5, None, None, [1, 1], True), (200, 1, None, "AC", "del", 5, 1, 1, [1, None], True), (201, 2, -70, "A" * 200, "del", None, None, 1, [None, 1], True), (202, 2, -3, "AC", "snv", 0, None, 1, [1], True)]
    return spark.createDataFrame(data, "id int, sample int, pos int, ref string, allele_type string, allele_length int, qual int, gq int, gt array<int>, phased boolean").withColumns(
        {"chrom": F.lit("c"), "file_pos": F.col("id")})


def test_haplotype_overlaps_meet_in_one_join(spark):
    calls = haplotype_input(spark)
    h = ph.haplotype_calls(calls).collect()
    order = lambda p: tuple((v is not None, v or 0) for v in p)
    want = sorted(((a.sample, a.haplotype, a.id, a.kind, b.id, b.kind) for a in h for b in h if a.sample == b.sample and a.haplotype == b.haplotype and None not in (a.start, a.end, b.start, b.end)
                   and a.start < a.end and b.start < b.end and a.start < b.end and b.start < a.end and order(a.prio) > order(b.prio)), key=str)
    out = ph.haplotype_overlaps(calls)
    assert len(want) > 500 and rows(out) == want
    assert plan(out).count("Join ") == 1


def test_points_in_coarse_blocks_are_those_in_fine_ones(spark):
    p = spark.createDataFrame([("c", i * 13 - 400) for i in range(120)] + [("d", 5), (None, 5), ("c", None)], "chrom string, p int")
    iv = spark.createDataFrame([("c", i * 29 - 500, i * 29 - 500 + [0, 1, 63, 64, 65, 900, -4][i % 7]) for i in range(40)] + [("c", None, 4), ("c", 4, None), (None, 0, 9)], "chrom string, s int, e int")
    fine = rows(po.point_in_interval(p, iv, "p", "s", "e", ["chrom"]))
    assert len(fine) > 100 and rows(po.point_in_interval(p, iv, "p", "s", "e", ["chrom"], least_bits=6)) == fine


# ------------------------------------------------------------------ re-genotyped calls

def test_regenotypes_meet_grouped_calls_where_they_lie(spark):
    """With contigs from sites the calls are dealt twice after grouping, by site and by sample; before, three times."""
    lines = spark.createDataFrame([(v, s, (v + s) % 3, (v * s) % 2) for v in range(12) for s in range(5)], "vid int, sample int, a int, b int")
    a = F.when(F.col("a") < 2, F.col("a"))
    base = lines.groupBy("vid", "sample").agg(F.max("a").alias("a")).select("vid", "sample", F.array(a, F.lit(0)).alias("gt"), F.lit(True).alias("phased"), F.lit(9).alias("gq"), F.array(F.lit(3), F.lit(0)).alias("ad"),
                                                                            F.lit(3).alias("dp"), F.array(F.lit(0), F.lit(0), F.lit(0)).alias("pl"))
    regeno = lines.filter("vid % 4 <> 1").groupBy("vid", "sample").agg(F.max("b").alias("b")).select("vid", "sample", F.array(F.when(F.col("vid") % 5 > 0, F.col("b")), F.when(F.col("vid") % 5 > 0, 0)).alias("gt"),
                                                                                                F.array(F.lit(7), F.col("b")).alias("ad"), F.lit(7).alias("dp"))
    sites = spark.createDataFrame([(v, [None, "chr1", "chrX", "chrY"][v % 4]) for v in range(10)] + [(2, "chrX"), (None, "chr1")], "vid int, chrom string")
    sex = spark.createDataFrame([(0, "M"), (1, "F"), (2, "M"), (3, None), (3, "M")], "sample int, sex string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = tr.merge_regenotypes(base.join(sites, "vid"), regeno, sex, ["vid"])
        two = tr.merge_regenotypes(base, regeno, sex, ["vid"], sites=sites)
        dealt = lambda d: d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert dealt(two) == dealt(one) - 1
        assert set(one.columns) == set(two.columns)
        assert rows(one.select(two.columns)) == rows(two) and two.count() > 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ------------------------------------------------------------------ truth tables

@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    types = ["STANDARD", "ECONOMY", "MEDIUM", "PROMO", "SMALL", "LARGE"]
    part = [(i, f"part {i}", f"Brand#{11 + i % 40}", types[i % 6], i % 50 + 1, 900.0 + i) for i in range(1, 41)]
    spark.createDataFrame(part, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{at}/part.parquet")
    spark.createDataFrame([(s, s % 4, f"supplier {s}") for s in range(1, 10)], "s_suppkey bigint, s_nationkey bigint, s_name string").write.parquet(f"{at}/supplier.parquet")
    lines = [((o * 7 + n * 3) % 40 + 1 if o % 8 else None, (o + n) % 9 + 1, float(o * n % 50 + 1), (o * n) % 9 / 100, "ANR"[(o + n) % 3], "FO"[o % 2]) for o in range(1, 61) for n in range(1, 8)]
    spark.createDataFrame(lines, "l_partkey bigint, l_suppkey bigint, l_quantity double, l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{at}/lineitem.parquet")
    return at


def test_truth_tables_join_suppliers_once(spark, folder, monkeypatch):
    from varloom.plans import queries_counting as qc
    from varloom.plans.fixtures import Tables

    t, seen = Tables(spark, folder), []
    sites, calls, truth, truth_calls = qc.truth_inputs(t)
    assert "s_suppkey" not in plan(calls) and "s_suppkey" not in plan(truth_calls)
    assert rows(calls) == rows(qc.nat_calls(t).withColumnRenamed("vid", "id"))
    assert rows(truth_calls) == rows(t.sql(qc.TRUTH_CALLS).select("id", "sample", F.array("a0", "a1").alias("gt")))
    real = tt.matched_sites
    monkeypatch.setattr(tt, "matched_sites", lambda e, *a, **k: seen.append(plan(e)) or real(e, *a, **k))
    assert tt.truth_gq_table(sites, calls, truth, truth_calls).count() > 0
    assert len(seen) == 1 and "p_partkey" not in seen[0]


def test_cleared_calls_are_the_losers_of_all_overlaps(spark):
    """Against every pair in plain Python; calls are sent once, by haplotype, and none comes back to be joined."""
    rng = random.Random(5)
    given = [haplotype_input(spark).withColumn("sample", F.col("sample").cast("string"))]
    for n, span, most in ((60, 40, 1), (400, 4000, 25), (300, 90, 12)):
        rows = [(f"v{i % (n - 3)}", rng.choice("ab") if i else None, rng.choice(["c", "d"]) if i != 1 else None, rng.randrange(span) if i != 2 else None, "A" * rng.choice([0, 1, 1, rng.randint(1, most)]) if i % 20 else None,
                 rng.choice(["snv", "del", "alu_ins", "dup", "inv"]), rng.choice([0, -3, 3, 50]), rng.choice([None, 5, 9]), rng.choice([None, 1.0, float("nan")]), rng.choice([None, 1, 2]), [1, rng.choice([0, 1])], True) for i in range(n)]
        given.append(spark.createDataFrame(rows, "id string, sample string, chrom string, pos int, ref string, allele_type string, allele_length int, gq int, qual double, file_pos long, gt array<int>, phased boolean"))
    for calls in given:
        got = sorted(((r.id, r["sample"]) for r in ph.cleared_calls(calls).collect()), key=str)
        ranked = ph.haplotype_calls(calls).withColumn("k", F.dense_rank().over(W.orderBy("prio"))).collect()
        covers = lambda o, p: o.start <= p < o.end
        want = {(c.id, c["sample"]) for c in ranked for o in ranked if None not in (c.start, o.start, o.end, c["sample"], c.chrom) and (c.chrom, c["sample"], c.haplotype) == (o.chrom, o["sample"], o.haplotype) and o.k > c.k
                and (covers(o, c.start) if c.end is None else c.start < o.end and o.start < c.end if c.start < c.end else covers(o, c.start) or covers(o, c.start - 1))}
        assert got == sorted(want, key=str) and len(want) > 5
    sent = ph.cleared_calls(calls)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in sent and sent.count("Exchange hashpartitioning") <= 2
