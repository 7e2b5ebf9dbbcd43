"""Row, genotype and phasing operators at their edges."""

import math
import random

import pytest
from pyspark.sql import functions as F

from varloom.functions import genotype as g, stats
from varloom.functions.alleles import trim_alleles
from varloom.operators import genotypes as q, phasing as ph, rows as r, transfer as x


def trim(pos, ref, alt, keep=1, suffix_first=True):
    def suf(a, b):
        while len(a) > keep and len(b) > keep and a[-1] == b[-1]:
            a, b = a[:-1], b[:-1]
        return a, b
    def pre(p, a, b):
        while len(a) > keep and len(b) > keep and a[0] == b[0]:
            p, a, b = p + 1, a[1:], b[1:]
        return p, a, b
    if suffix_first:
        ref, alt = suf(ref, alt)
        return pre(pos, ref, alt)
    pos, ref, alt = pre(pos, ref, alt)
    return (pos, *suf(ref, alt))


@pytest.mark.parametrize("order,keep", [("suffix_first", 1), ("prefix_first", 1), ("prefix_first", 0)])
def test_trim_alleles(spark, order, keep):
    rnd = random.Random(3)
    rows = [(10, "".join(rnd.choice("AC") for _ in range(rnd.randint(1, 7))), "".join(rnd.choice("AC") for _ in range(rnd.randint(1, 7)))) for _ in range(200)]
    d = spark.createDataFrame(rows, "pos int, ref string, alt string").withColumn("t", trim_alleles("pos", "ref", "alt", order, keep))
    d = d.withColumn("u", trim_alleles("t.pos", "t.ref", "t.alt", order, keep))
    for row in d.collect():
        assert tuple(row["t"]) == trim(row["pos"], row["ref"], row["alt"], keep, order == "suffix_first")
        assert row["t"] == row["u"]


def test_ids_follow_file_order(spark):
    d = spark.createDataFrame([("c", 1, "A", "T", "snv", 0, 3), ("c", 1, "A", "T", "snv", 0, 1), ("c", 1, "A", "AT", "ins", 1, 2)],
                              "chrom string, pos int, ref string, alt string, allele_type string, allele_length int, file_pos long")
    got = {row["file_pos"]: row["id"] for row in r.assign_ids(d).collect()}
    assert got == {1: "c-1-A-T_1", 3: "c-1-A-T_2", 2: "c-1-INS-1"}


def test_unknown_symbolic_type_is_an_error(spark):
    d = spark.createDataFrame([("i", "c", 1, "A", "T", "odd", 5, None)], "id string, chrom string, pos int, ref string, alt string, allele_type string, allele_length int, origin string")
    with pytest.raises(Exception, match="unrecognised allele type"):
        r.convert_symbolic(d).collect()


def test_longest_origin_first_of_equals(spark):
    d = spark.createDataFrame([("chr1:5-9,chr2:1-5,x",)], "origin string").select(r.longest_origin("origin").alias("o"))
    assert tuple(d.first()["o"]) == ("chr1", 5, 9)


def test_exact_binomial_p(spark):
    rows = [(k, n) for n in (1, 2, 7, 40, 41, 1500) for k in {0, 1, n // 3, n // 2, n}]
    d = spark.createDataFrame(rows, "k int, n int").withColumn("p", stats.binom_half_p(F.col("k"), F.col("n")))
    for row in d.collect():
        k, n = row["k"], row["n"]
        pk = math.comb(n, k)
        want = sum(math.comb(n, i) for i in range(n + 1) if math.comb(n, i) <= pk) / 2**n
        assert row["p"] == pytest.approx(want, rel=1e-8, abs=1e-300)


def test_error_function(spark):
    import math

    xs = [0.0, 1e-9, 0.3, 1.0, 1.9999, 2.0, 2.5, 5.0, 9.0, -0.7, -3.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(stats.erfc(F.col("x"))).collect()]
    assert all(abs(g - math.erfc(x)) <= 1e-11 * max(math.erfc(x), 1e-3) for g, x in zip(got, xs))
    assert spark.sql("SELECT CAST(NULL AS DOUBLE) AS x").select(stats.erfc(F.col("x"))).first()[0] is None


def test_chi2_tail_uses_error_function(spark):
    d = spark.createDataFrame([(0.0,), (3.841458820694124,), (None,)], "x double").select(stats.chi2_sf_1df(F.col("x")).alias("p"))
    p = [row["p"] for row in d.collect()]
    assert p[0] == 1.0 and p[1] == pytest.approx(0.05) and p[2] is None


def test_pl_and_gq(spark):
    d = spark.createDataFrame([(0, 0), (10, 0), (5, 5)], "r int, a int").withColumn("pl", g.pl_from_ad("r", "a"))
    rows = d.withColumn("gq", g.gq_from_pl("pl")).collect()
    assert rows[0]["pl"] == [0, 0, 0] and rows[1]["pl"][0] == 0 and rows[2]["pl"][1] == 0
    for row in rows[1:]:
        ll = [row["a"] * math.log10(m) + row["r"] * math.log10(1.0 - m) for m in (0.05, 0.5, 0.95)]
        assert row["pl"] == [int(round(-10 * (v - max(ll)))) for v in ll]
        assert row["gq"] == min(sorted(row["pl"])[1], 99)


CALLS = "vid int, sample string, gt array<int>, phased boolean, gq int, ad array<int>, n_alts int"


def test_histograms_account_for_every_call(spark):
    rnd = random.Random(1)
    rows = [(v, str(s), [rnd.choice([0, 1, None]) for _ in range(2)], True, rnd.randrange(120), [1, 1], 1) for v in range(4) for s in range(50)]
    h = q.gq_histogram(spark.createDataFrame(rows, CALLS), ["vid"], "gq", (0, 30, 60, 100)).collect()
    for row in h:
        assert sum(map(int, row["gq_hist_all_bin_freq"].split("|"))) + row["gq_hist_all_n_larger"] == 50


def test_ploidy_rules(spark):
    rows = [("m", "chrX", [0, 1], False), ("m", "chrX", [1, 0], True), ("f", "chrY", [0, 1], True), ("f", "chrX", [1, None], False), ("m", "chr1", [1], False), ("m", "chrX", None, False)]
    d = spark.createDataFrame([(i, *v) for i, v in enumerate(rows)], "i int, sample string, chrom string, gt array<int>, phased boolean")
    sex = spark.createDataFrame([("m", "M"), ("f", "F")], "sample string, sex string")
    got = {row["i"]: row["gt"] for row in q.normalize_ploidy(d, sex).collect()}
    assert got == {0: [None, 1], 1: [1, None], 2: [None, None], 3: [None, 1], 4: [None, 1], 5: [None, None]}


def test_perfect_tandem_indel(spark):
    d = spark.createDataFrame([("A", "ACAGCAGCAG"), ("A", "ACAGCAG"), ("ATTTTTTTTT", "A"), ("A", "T")], "ref string, alt string")
    assert [row["tandem_indel"] for row in q.perfect_tandem_indel(d).collect()] == [True, False, True, False]


def greedy(states):
    """Statuses by a left-to-right scan that pairs neighbouring changes."""
    if sum(states) * 2 < len(states):
        states = [1 - s for s in states]
    out = ["XC" if s else "CN" for s in states]
    ch = [i for i in range(1, len(states)) if states[i] != states[i - 1]]
    i = 0
    while i < len(ch):
        if i + 1 < len(ch) and ch[i + 1] == ch[i] + 1:
            out[ch[i]] = out[ch[i + 1]] = "FL"
            i += 2
        else:
            out[ch[i]] = "SW"
            i += 1
    return out


def test_switch_and_flip_statuses(spark):
    rnd = random.Random(9)
    rows, want = [], {}
    for s in range(12):
        st = [rnd.randrange(2) for _ in range(rnd.randint(1, 60))]
        want.update({(str(s), i): v for i, v in enumerate(greedy(st))})
        rows += [("c", str(s), "x", 10 + i // 3, i, v) for i, v in enumerate(st)]
    d = spark.createDataFrame(rows, "contig string, sample string, collection string, pos int, file_pos long, state int")
    got = {(row["sample"], row["file_pos"]): row["status"] for row in ph.phase_statuses(d).collect()}
    assert got == want


def test_first_delta_wins(spark):
    c = spark.createDataFrame([("v", "s", [0, 1], True, 5)], "id string, sample string, gt array<int>, phased boolean, ps long")
    d = spark.createDataFrame([("v", "s", "1|0", "7", 0), ("v", "s", "0|1", ".", 1)], "id string, sample string, new_gt string, new_ps string, o int")
    row = ph.apply_phase_flips(c, d, order="o").first()
    assert row["gt"] == [1, 0] and row["ps"] == 7


def test_merge_annotation_tables_last_value_wins(spark):
    a = spark.createDataFrame([(1, "x", None)], "id int, p string, q string")
    b = spark.createDataFrame([(1, None, "y"), (2, "z", None)], "id int, p string, q string")
    got = {row["id"]: (row["p"], row["q"]) for row in x.merge_annotation_tables([a, b], ["id"]).collect()}
    assert got == {1: ("x", "y"), 2: ("z", None)}


def test_allele_translation(spark):
    d = spark.createDataFrame([([1, 2], ["T", "g"], ["G", "c"])], "gt array<int>, a array<string>, b array<string>")
    assert d.select(x.translate_alleles("gt", "a", "b").alias("t")).first()["t"] == [None, 1]


def test_row_operators_accept_streams(spark, tmp_path):
    spark.createDataFrame([("a", "A", "AT"), ("b", "AC", "A")], "id string, ref string, alt string").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("id string, ref string, alt string").parquet(str(tmp_path / "in"))
    run = r.variant_attributes(s).writeStream.format("memory").queryName("attrs").outputMode("append").start()
    run.processAllAvailable()
    run.stop()
    assert {(v["id"], v["allele_type"]) for v in spark.sql("select * from attrs").collect()} == {("a", "ins"), ("b", "del")}
