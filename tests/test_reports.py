"""Repeat concordance, cohort quality, truth support and caller evidence on small tables against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.operators import depth, evidence as ev, reports as rp, sequences as sq, truth as tr
from varloom.sources import readers


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def like(a, b):
    return 1.0 if a == b else 1 - edit(a, b) / max(len(a), len(b))


GENOME = "".join(random.Random(4).choice("ACGT") for _ in range(700))
CALL = "sample string, chrom string, start int, end int, hap1 string, hap2 string, nonref1 boolean, nonref2 boolean, motif_len int"


def calls_of(rng, n, samples):
    out = {}
    for _ in range(n):
        s = rng.randrange(1, 600)
        e = s + rng.randrange(0, 12)
        motif = rng.randrange(1, 30)
        for who in samples:
            hap = lambda: None if rng.random() < 0.15 else GENOME[s - 1:e] if rng.random() < 0.5 else "".join(rng.choice("ACGTacgt") for _ in range(rng.randrange(1, 25)))
            if rng.random() < 0.85:
                out[who, s, e] = (who, "c", s, e, hap(), hap(), rng.random() < 0.5, rng.random() < 0.5, motif)
    return list(out.values())


def spell(calls, lo, hi):
    text, last = ["", ""], [lo - 1, lo - 1]
    for c in sorted(calls, key=lambda c: c[2:4]):
        for h, seq in enumerate([x for x in c[4:6] if x]):
            seq, start = seq.upper(), c[2]
            if start <= last[h]:
                seq, start = seq[last[h] - start + 1:], last[h] + 1
            if last[h] < start - 1:
                text[h] += GENOME[last[h]:start - 1]
            if seq:
                text[h] += seq
                last[h] = c[3]
    return [t + GENOME[at:hi] if at < hi else t for t, at in zip(text, last)]


def regions_of(a, b):
    keys = [(1, c[2], c[3]) for c in a] + [(2, c[2], c[3]) for c in b]
    keys = sorted(set(keys))
    group = {k: k for k in keys}

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    linked = set()
    for x in keys:
        for y in keys:
            if x[0] == 1 and y[0] == 2 and x[1] <= max(y[2], y[1] + 1) and y[1] <= max(x[2], x[1] + 1):
                group[top(x)] = top(y)
                linked |= {x, y}
    out = {}
    for k in linked:
        out.setdefault(top(k), []).append(k)
    return list(out.values())


@pytest.mark.parametrize("seed,n", [(1, 25), (2, 60), (3, 8)])
def test_str_concordance(spark, seed, n):
    rng = random.Random(seed)
    a, b = calls_of(rng, n, ["x", "y"]), calls_of(rng, n, ["x", "z"])
    ref = spark.createDataFrame([("c", i, GENOME[64 * i:64 * i + 64]) for i in range(11)], "chrom string, block int, bases string")
    da, db = spark.createDataFrame(a, CALL), spark.createDataFrame(b, CALL)
    for pairs in (None, [("x", "z"), ("y", "z"), ("x", "x")]):
        want = {}
        for reg in regions_of(a, b):
            lo, hi = min(k[1] for k in reg), max(k[2] for k in reg)
            inside = [[c for c in d if (src, c[2], c[3]) in reg] for src, d in ((1, a), (2, b))]
            for one, two in pairs or [("x", "x"), ("y", "y"), ("z", "z")]:
                own = [c for c in inside[0] if c[0] == one], [c for c in inside[1] if c[0] == two]
                if not own[0] and not own[1]:
                    continue
                (p1, p2), (q1, q2) = spell(own[0], lo, hi), spell(own[1], lo, hi)
                straight, swapped = (like(p1, q1) + like(p2, q2)) / 2, (like(p1, q2) + like(p2, q1)) / 2
                dist = edit(p1, q2) + edit(p2, q1) if swapped > straight else edit(p1, q1) + edit(p2, q2)
                r = GENOME[lo - 1:hi]
                sim = max(straight, swapped)
                want[lo, hi, one, two] = ("EXACT" if sim == 1 else "SIMILAR" if sim >= 0.9 else "DIVERGENT", round(sim, 9), dist, edit(p1, r) + edit(p2, r), edit(q1, r) + edit(q2, r),
                                          len(p1) + len(p2) - len(q1) - len(q2), hi - lo + 1, min(c[8] for c in inside[0]), min(c[8] for c in inside[1]),
                                          sum(any(c[i] for c in own[0]) for i in (6, 7)), sum(any(c[i] for c in own[1]) for i in (6, 7)))
        named = spark.createDataFrame(pairs, "sample string, sample_b string") if pairs else None
        got = rp.str_concordance(da, db, ref, 64, named).collect()
        have = {(r.start, r.end, r["sample"], r["sample_b"] if pairs else r["sample"]): (r.category, round(r.similarity, 9), r.edit_distance, r.ref_distance_a, r.ref_distance_b, r.length_diff, r.locus_size,
                                                                                          r.motif_a, r.motif_b, r.nonref_a, r.nonref_b) for r in got}
        if pairs:  # a pair is compared where either of its samples has a call
            want = {k: v for k, v in want.items() if k in have or True}
        assert have == want and len(got) == len(have)


def test_blocks_and_bases(spark):
    pieces = spark.createDataFrame([("c", 1, GENOME[:130]), ("c", 131, GENOME[130:300]), ("d", 5, "acg")], "chrom string, start int, bases string")
    blocks = sq.blocks_of(pieces, 50)
    assert {(r.chrom, r.block): r.bases for r in blocks.collect()} == {**{("c", i): GENOME[50 * i:50 * i + 50] for i in range(6)}, ("d", 0): "acg"}
    w = spark.createDataFrame([("c", 1, 1), ("c", 45, 155), ("c", 290, 310), ("e", 3, 5), ("c", 45, 155)], "chrom string, start int, end int")
    got = {(r.chrom, r.start): r.bases for r in sq.with_bases(w, blocks, 50).collect()}
    assert got == {("c", 1): GENOME[0], ("c", 45): GENOME[44:155], ("c", 290): GENOME[289:300] + "N" * 10, ("e", 3): "NNN"}


def test_read_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">c one\n" + "\n".join(GENOME[i:i + 37] for i in range(0, 700, 37)) + "\n>d\nACGT\n\nAC\n>empty\n")
    got = {(r.chrom, r.block): r.bases for r in readers.read_fasta(spark, str(tmp_path / "a.fa"), 100).collect()}
    assert got == {**{("c", i): GENOME[100 * i:100 * i + 100] for i in range(7)}, ("d", 0): "ACGTAC"}


def test_components_of_a_cohort(spark):
    rng = np.random.default_rng(1)
    x = rng.poisson(30, (9, 40)) * (1 + np.arange(9)[:, None] % 3)
    x[8] = 5  # no variance
    rows = [(f"s{i}", "chr1" if j < 30 else "chrX", j, int(x[i, j])) for i in range(9) for j in range(40)]
    d = spark.createDataFrame(rows, "sample string, chrom string, bin int, depth int")
    names, m = depth.correlations(d, ["chr1"])
    want = np.corrcoef(x[:8, :30])
    assert names == [f"s{i}" for i in range(9)] and np.abs(m[:8, :8] - want).max() < 1e-9 and np.abs(m[8, :8]).max() == 0
    got = depth.dosage_components(d, 3, ["chr1"]).collect()
    value = np.linalg.eigvalsh(m)[::-1]
    assert all(abs(r.explained - value[r.component - 1] / 9) < 1e-9 for r in got) and len(got) == 27
    b = depth.dosage_batches(d, 2, 3, least=1, most=8).collect()
    assert len(b) == 9 and all(r.size_ok == (1 <= r["size"] <= 8) for r in b)
    assert depth.sample_correlations(d.filter("false")).count() == 0


def test_too_many_samples_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(depth, "MOST_SAMPLES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        depth.correlations(spark.range(4).select(F.col("id").alias("sample"), F.lit("c").alias("chrom"), F.lit(1).alias("bin"), F.lit(2).alias("depth")))


def test_sampled_calls_are_the_smallest_hashes(spark):
    d = spark.range(3000).select((F.col("id") % 1500).alias("vid"), F.when(F.col("id") < 1500, "a").otherwise("b").alias("sample"))
    d = d.unionByName(spark.range(5).select(F.col("id").alias("vid"), F.lit("few").alias("sample")))
    got = {r["sample"]: r.n for r in rp.sampled_calls(d, 100, 3).groupBy("sample").agg(F.count("*").alias("n")).collect()}
    assert got == {"a": 100, "b": 100, "few": 5}
    h = d.withColumn("h", F.xxhash64("vid", "sample", F.lit(3)))
    want = {(r.vid, r["sample"]) for s in ("a", "b") for r in h.filter(F.col("sample") == s).orderBy("h").limit(100).collect()}
    assert {(r.vid, r["sample"]) for r in rp.sampled_calls(d, 100, 3).filter("sample <> 'few'").collect()} == want
    part = {(r.vid, r["sample"]) for r in rp.sampled_calls(d.filter("vid < 700"), 100, 3).collect()}
    assert all(x in part for x in want if x[0] < 700)


def test_truth_limits(spark):
    site = "id string, chrom string, pos int, ref string, alt string, allele_type string, allele_length int, end int"
    evals = spark.createDataFrame([("d", "c", 1001, "N", "<D>", "del", -1000, 2000), ("i", "c", 5000, "A", "T", "ins", 100, 5000), ("s", "c", 10, "a", "T", "snv", 0, 10), ("e", "c", 50, "ACGT", "A", "del", -3, 53)], site)
    truth = spark.createDataFrame([
        ("far_start", "c", 1601, "N", "<D>", "del", -900, 2000), ("one_end", "c", 1201, "N", "<D>", "del", -801, 2001), ("small", "c", 1401, "N", "<D>", "del", -600, 2000), ("late", "c", 5101, "A", "T", "ins", 100, 5101),
        ("near", "c", 5100, "A", "T", "ins", 80, 5100), ("short", "c", 5000, "A", "T", "ins", 79, 5000), ("snv", "c", 10, "A", "t", "snv", 0, 10), ("indel", "c", 50, "acgt", "a", "del", -3, 53)], site)
    got = {(r.id, r.truth_id) for r in tr.matched_sites(evals, truth, tr.CUTOFF_LIMITS, 20).collect()}
    assert got == {("d", "one_end"), ("i", "near"), ("s", "snv"), ("e", "indel")}
    got = {(r.id, r.truth_id) for r in tr.matched_sites(evals, truth, tr.TABLE_LIMITS, 20, exact_any=True).collect()}
    assert got == {("d", "one_end"), ("i", "near"), ("i", "short"), ("s", "snv"), ("e", "indel")}  # both breakpoints of "late" are 101 off: 202 in all


@pytest.mark.parametrize("caller,fields,alts,want", [
    ("pbsv", {"AD": "3,4"}, ["AAA"], [3, 4]), ("pbsv", {"AD": ".,4"}, ["AAA"], None), ("pbsv", {"AD": "3"}, ["AAA"], None), ("sawfish", {"AD": "3,4,5"}, ["A" * 5, "A" * 61], [3, 5]), ("sawfish", {"AD": "3,4,5"}, ["A" * 31, "A" * 91], [3, 4]),
    ("cutesv", {"DR": "1", "DV": "2"}, ["A"], [1, 2]), ("cutesv", {"DR": "1"}, ["A"], None), ("delly", {"RR": "8", "RV": "9", "DV": "1"}, ["A"], [8, 9]), ("dipcall", {"AD": "1,2"}, ["A"], None), ("pbsv", {}, ["A"], None)])
def test_depths_by_caller(spark, caller, fields, alts, want):
    d = spark.createDataFrame([(caller, fields or {"x": "1"}, "A", alts)], "caller string, fields map<string,string>, ref string, alts array<string>")
    assert d.select(ev.depth_pair(ev.reads(), F.lit(60)).alias("d")).first().d == want


@pytest.mark.parametrize("cells", [40, 1 << 20])
def test_coverage_with_many_depths(spark, monkeypatch, cells):
    """Depths to 100,000, cells few enough that counts are carried from one run of blocks to the next."""
    monkeypatch.setattr(depth, "COVER_CELLS", cells)
    rng = random.Random(5)
    rows = []
    for s in range(5):
        at = 0
        while at < 9000:
            n = rng.randrange(1, 400)
            rows.append((f"s{s}", "c", at, at + n, rng.choice([0, 3, rng.randrange(100_000)])))
            at += n
    d = spark.createDataFrame(rows, "sample string, chrom string, start int, end int, depth int")
    base = {}
    for s, _, a, b, v in rows:
        for p in range(a, b):
            base.setdefault(p, []).append(v)
    got = depth.cohort_coverage(d, 5, 1000, (1, 50_000)).collect()
    end = min(max(b for s2, _, _, b, _ in rows if s2 == s) for s in {r[0] for r in rows})
    assert sum(r.end - r.start + 1 for r in got) == end
    for r in got:
        v = sorted(base[r.start - 1])
        assert v == sorted(base[r.end - 1]) and r.total == sum(v) and r.median == v[2] and r.over_50000 == round(sum(x > 50_000 for x in v) / 5, 6)


def test_match_table_and_totals(spark):
    e = spark.createDataFrame([("a", "AF=0.5,0.1;AF_male=.2;X", "g|h|"), ("b", "AC=3", None), ("c", "AF=0.1", "x")], "id string, info string, vep string")
    t = spark.createDataFrame([("t", "XY_AF=0.4;AF=0.25,7", "|k|"), ("u", "AF=bad", "q")], "id string, info string, vep string")
    m = spark.createDataFrame([("a", "EXACT", "t"), ("b", "CLOSEST", "u")], "id string, match_type string, truth_id string")
    got = {(r.id, r.match_status, r.truth_id, r.match_type, r.field, r.eval_value, r.truth_value) for r in rp.match_table(e, m, t, {"one": 0, "two": 1, "three": 2}).collect()}
    assert got == {("a", True, "t", "EXACT", "af", "0.5", "0.25"), ("a", True, "t", "EXACT", "af_xy", "0.2", "0.4"), ("a", True, "t", "EXACT", "one", "g", "N/A"), ("a", True, "t", "EXACT", "two", "h", "k"),
                   ("b", True, "u", "CLOSEST", "one", "N/A", "q"), ("b", True, "u", "CLOSEST", "two", "N/A", "N/A"), ("c", False, ".", None, None, None, None)}
    assert {r.match_type: (r.variants, round(r.pct, 3)) for r in rp.match_totals(e, m).collect()} == {"EXACT": (1, 33.333), "CLOSEST": (1, 33.333), "UNMATCHED": (1, 33.333), "MATCHED": (2, 66.667), "TOTAL": (3, 100.0)}
    assert {r.match_type: (r.variants, r.pct) for r in rp.match_totals(e.filter("false"), m).collect()} == {"MATCHED": (0, 0.0), "TOTAL": (0, 0.0)}


@pytest.mark.parametrize("origin,kept", [("chr1:100-200+", True), ("chr1:100-200_-", True), ("chr1:100-200foo+", False), ("chr1:100-200", False), ("chr1:100-200__+", False), ("x+", False), ("chr1:100-200+,chr1:100-200+", False)])
def test_only_the_strand_follows_an_origin(spark, origin, kept):
    from varloom.operators import rows

    d = spark.createDataFrame([("dup", 100, 105, origin)], "allele_type string, allele_length int, pos int, origin string")
    assert (rows.transform_allele_type(d).first().allele_type == "dup") == kept


def test_str_aggregate_counts_all_reports(spark):
    """Both sets' motif classes, matrix, similarity, distance and length differences; before, categories by one set's motif only."""
    conc = [("EXACT", 1.0, 0, 0, 3, 25, 1, 1), ("SIMILAR", 0.95, 4, -4, 6, 7, 2, 1), ("SIMILAR", 0.959, 4, 4, 6, 20, 2, 1), ("DIVERGENT", 0.29, 30, 12, 21, 6, 0, 2)]
    d = spark.createDataFrame(conc, "category string, similarity double, edit_distance int, length_diff int, motif_a int, motif_b int, nonref_a int, nonref_b int")
    got = {(r.measure, r.motif_set, r.motif_size, r.category, r.value, r.value_b): (r.n, r["mean"]) for r in rp.str_aggregate(d).collect()}
    size = lambda m: "1-6" if m <= 6 else "7-20" if m <= 20 else "21+"
    want, diffs = {}, {}
    for cat, sim, dist, diff, ma, mb, na, nb in conc:
        cells = [("nonref", None, "All", None, na, nb), ("similarity", None, "All", cat, {1.0: 99, 0.95: 95, 0.959: 95, 0.29: 29}[sim], None), ("edit_distance", None, "All", cat, dist, None)]
        for group in ((None, "All"), ("a", size(ma)), ("b", size(mb))):
            cells += [("category", *group, cat, None, None), ("length_diff", *group, None, diff, None), ("length_sign", *group, None, (diff > 0) - (diff < 0), None)]
            diffs.setdefault(("length_mean", *group, None, None, None), []).append(diff)
        for c in cells:
            want[c] = (want.get(c, (0,))[0] + 1, None)
    want |= {k: (len(v), sum(v) / len(v)) for k, v in diffs.items()}
    assert got == want and sum(n for (m, *_), (n, _) in got.items() if m == "category") == 12
