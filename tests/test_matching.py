"""Similarity matching and greedy collapse against brute force; depth and sources."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from varloom.operators import collapse as co, depth as d, matching as m
from varloom.sources import readers, writers

S = "id string, chrom string, start int, len int, kind string, seq string"


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def similar(a, b, seq, size, win):
    return (a[1] == b[1] and a[4] == b[4] and abs(a[2] - b[2]) <= win and min(a[3], b[3]) >= size * max(a[3], b[3]) - 1e-9
            and 1 - lev(a[5], b[5]) / max(len(a[5]), len(b[5])) >= seq)


def some_rows(seed, n, tag):
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = 12 + r.randrange(4)
        seq = "ACGTACGTACGTACGT"[:k] if r.random() < 0.5 else "".join(r.choice("AC") for _ in range(k))
        out.append((f"{tag}{i:03d}", "c", r.randrange(60), k, r.choice(["INS", "DEL"]), seq))
    # a third of the rows are one call
    return out + [(f"{tag}9{i:02d}", "c", 30, 14, "INS", "ACGTACGTACGTAC") for i in range(n // 2)]


@pytest.mark.parametrize("n", [10, 1000])
def test_a_long_chain_collapses_in_as_many_jobs_as_a_short_one(spark, n):
    """Neighbours are similar, others are too far: every second site of the chain is kept."""
    d = spark.createDataFrame([(f"v{i:05d}", "c", i * 8, 12, "INS", "ACGTACGTACGT") for i in range(n)], S)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"chain{n}", "chain")
    got = {r["id"]: r["kept_id"] for r in co.collapse_sites(d, co.Limits(10)).collect()}
    jobs = len(tracker.getJobIdsForGroup(f"chain{n}"))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert got == {f"v{i:05d}": f"v{i - i % 2:05d}" for i in range(n)}
    assert jobs < 60


@pytest.mark.parametrize("most", [5, 1 << 20])
def test_collapse_equals_greedy_scan(spark, most):
    rows = some_rows(4, 60, "v")
    firsts = {}
    for x in rows:
        firsts[x[1:]] = min(firsts.get(x[1:], x[0]), x[0])
    nodes = sorted(((i, *c) for c, i in firsts.items()), key=lambda x: (x[1], x[2], x[0]))
    kept, owner = [], {}
    for x in nodes:
        near = [k for k in kept if similar(x, k, 0.8, 0.8, 10)]
        owner[x[0]] = near[0][0] if near else x[0]
        if not near:
            kept.append(x)
    want = {x[0]: owner[firsts[x[1:]]] for x in rows}
    got = {r["id"]: r["kept_id"] for r in co.collapse_sites(spark.createDataFrame(rows, S), co.Limits(10, 0.0, 0.8, 0.8), most=most).collect()}
    assert got == want


def test_similarity_rounds(spark):
    a, b = some_rows(7, 30, "q"), some_rows(8, 30, "t")
    got = {r["id"]: (r["truth_id"], r["match_type"]) for r in m.similarity_match(spark.createDataFrame(a, S), spark.createDataFrame(b, S)).collect()}
    cq, cr = {}, {}
    for src, dst in ((a, cq), (b, cr)):
        for x in src:
            dst[x[1:]] = min(dst.get(x[1:], x[0]), x[0])
    qs, rs = {i: (i, *c) for c, i in cq.items()}, {i: (i, *c) for c, i in cr.items()}
    found = {}
    for t in (0.9, 0.7, 0.5):
        sc = {}
        for x in qs.values():
            for y in rs.values():
                if similar(x, y, t, 0.7, 500):
                    sc[x[0], y[0]] = (-(1 - lev(x[5], y[5]) / max(len(x[5]), len(y[5]))), abs(x[2] - y[2]))
        bq = {i: min((v, j) for (k, j), v in sc.items() if k == i)[1] for i in {k for k, _ in sc}}
        br = {j: min((v, i) for (i, k), v in sc.items() if k == j)[1] for j in {k for _, k in sc}}
        hit = {i: j for i, j in bq.items() if br[j] == i}
        found.update({i: (j, f"SIMILAR_{t}") for i, j in hit.items()})
        qs = {i: v for i, v in qs.items() if i not in hit}
        rs = {j: v for j, v in rs.items() if j not in hit.values()}
    assert got == {x[0]: found[cq[x[1:]]] for x in a if cq[x[1:]] in found}


def test_nearest_point_limits_come_after_the_choice(spark):
    sch = "id string, chrom string, start int, end int, len int"
    q = spark.createDataFrame([("a", "c", 100, 101, 50), ("b", "c", 1000, 1001, 50)], sch)
    r = spark.createDataFrame([("near_but_huge", "c", 101, 102, 5000), ("fits", "c", 110, 111, 50), ("left", "c", 990, 991, 60), ("right", "c", 1010, 1011, 40)], sch)
    assert {(x["id"], x["truth_id"]) for x in m.sv_closest_point(q, r).collect()} == {("b", "right")}


def test_missing_alleles_count_as_carriers_for_elements(spark):
    c = spark.createDataFrame([("v", "a", [0, None]), ("v", "b", [0, 0]), ("v", "c", [0, 1])], "id string, sample string, gt array<int>")
    assert {r["sample"] for r in m.transferable_carriers(c).collect()} == {"a", "c"}


@pytest.mark.parametrize("most", [5, 1 << 20])
def test_collapse_by_support_with_limits(spark, most):
    """The most common site first; sizes, overlap and kinds out of limits are left alone."""
    r = random.Random(9)
    rows = [(*x, r.randrange(4)) for x in some_rows(5, 70, "v")]
    lim = {"INS": co.Limits(12, 0.4, 0.7, 0.7, 3, 12)}
    nodes = {}
    for x in rows:
        k = (-x[6], x[0])
        nodes[x[1:6]] = min(nodes.get(x[1:6], k), k)
    order = sorted((s, c[1], i, c) for c, (s, i) in nodes.items())
    kept, owner = [], {}
    for s, st, i, c in order:
        fits = lambda c: c[3] == "INS" and 3 <= c[2] <= 12
        near = [k for _, _, k, o in kept if fits(c) and fits(o) and similar((i, *c), (k, *o), 0.7, 0.7, 12) and min(c[1] + c[2], o[1] + o[2]) - max(c[1], o[1]) >= 0.4 * max(c[2], o[2])]
        owner[i] = near[0] if near else i
        if not near:
            kept.append((s, st, i, c))
    want = {x[0]: owner[nodes[x[1:6]][1]] for x in rows}
    d = spark.createDataFrame(rows, S + ", support int")
    assert {x["id"]: x["kept_id"] for x in co.collapse_sites(d, lim, common=True, most=most).collect()} == want
    assert any(k != v for k, v in want.items())


def test_consolidation(spark):
    c = spark.createDataFrame([("k", "a", [0, 1]), ("k", "b", [0, 0]), ("r", "a", [0, 0]), ("r", "b", [1, 1]), ("z", "a", [0, 1]), ("z", "b", [0, 0]), ("z", "c", [0, 0]), ("r", "d", [0, 1])], "id string, sample string, gt array<int>")
    cl = spark.createDataFrame([("k", "k"), ("r", "k"), ("z", "k")], "id string, kept_id string")
    places = spark.createDataFrame([("k", 5), ("r", 3), ("z", 2)], "id string, start int")
    assert {(r["kept_id"], r["merge_count"], r["merge_type"]) for r in co.merge_info(co.alike_carriers(cl, c, 0.5)).collect()} == {("k", 2, "TRUVARI"), ("r", 1, "UNIQUE")}
    assert co.merge_info(co.alike_carriers(cl, c, 0.0)).first()["merge_count"] == 3
    got = {(r["id"], r["sample"], tuple(r["gt"]), r["source"]) for r in co.merged_calls(cl, c, places).collect()}
    assert got == {("k", "a", (0, 1), "k"), ("k", "b", (1, 1), "r"), ("k", "d", (0, 1), "r")}
    f = spark.createDataFrame([("k", "A", "1"), ("k", "B", None), ("r", "A", "2"), ("r", "B", "3"), ("z", "B", "4"), ("r", "C", "5")], "id string, key string, value string")
    assert {tuple(r) for r in co.merged_fields(cl, f, places).collect()} == {("k", "A", "1", "k"), ("k", "B", "4", "z"), ("k", "C", "5", "r")}


def test_bin_median_equals_per_base_median(spark):
    r = random.Random(2)
    rows, pos = [], 0
    while pos < 900:
        n = r.randrange(1, 90)
        rows.append(("s", "c", pos, pos + n, r.randrange(60)))
        pos += n
    base = [x[4] for x in rows for _ in range(x[3] - x[2])]
    got = {x["start"]: x["depth"] for x in d.bin_median_depth(spark.createDataFrame(rows, "sample string, chrom string, start int, end int, depth int"), 50).collect()}
    assert got == {b: int(median(base[b:b + 50])) for b in range(0, len(base) - 49, 50)}


def test_unequal_bins_are_an_error(spark):
    import pytest

    x = spark.createDataFrame([("a", "c", 0, 10, 1), ("b", "c", 10, 20, 1)], "sample string, chrom string, start int, end int, depth int")
    with pytest.raises(Exception, match="disagree"):
        d.to_wide_matrix(x, ["a", "b"]).collect()


VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2
chr2\t7\t.\tA\tC,G\t.\tPASS\tAC=1,2;FLAG\tGT:AD:PS\t0|2:3,0,4:11\t./.
chr1\t5\tv1\tAT\tA\t30\tq10;q20\t.\tGT\t0/1\t1
"""


def test_vcf_round_trip(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(VCF)
    v = readers.read_vcf(spark, str(tmp_path / "a.vcf"))
    site = {r["pos"]: r for r in v.collect()}
    assert site[7]["info"] == {"AC": "1,2", "FLAG": None} and site[7]["alts"] == ["C", "G"] and site[7]["id"] is None
    assert site[5]["filters"] == ["q10", "q20"] and site[7]["file_pos"] < site[5]["file_pos"]
    calls = {(r["pos"], r["sample"]): r for r in readers.calls_of(v).collect()}
    assert calls[7, "s1"]["gt"] == [0, 2] and calls[7, "s1"]["phased"] and calls[7, "s1"]["ad"] == [3, 0, 4] and calls[7, "s1"]["ps"] == 11
    assert calls[7, "s2"]["gt"] == [None, None] and calls[5, "s2"]["gt"] == [1]
    out = str(tmp_path / "out")
    writers.write_vcf_text(writers.vcf_body(v.withColumn("AC", F.col("info")["AC"]), ["AC"]), out, 1, "none")
    lines = [r["value"] for r in spark.read.text(out).collect()]
    assert lines == ["chr1\t5\tv1\tAT\tA\t30.0\tq10;q20\t.", "chr2\t7\t.\tA\tC,G\t.\tPASS\tAC=1,2"]


def test_vcf_files_keep_their_samples_and_order(spark, tmp_path):
    head = "\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split())
    (tmp_path / "a.vcf").write_text(f"{head}\ts1\nchr1\t1\tx\tA\tC\t.\t.\t.\tGT\t0/1\n")
    (tmp_path / "b.vcf").write_text(f"##long\n{head}\ts2\ts3\n" + "".join(f"chr1\t{i}\ty{i}\tA\tC\t.\t.\t.\tGT\t1/1\t0/0\n" for i in range(2, 400)))
    for path, first in ((str(tmp_path), ["x", "y2"]), ([str(tmp_path / "b.vcf"), str(tmp_path / "a.vcf")], ["y2", "y3"])):
        v = readers.read_vcf(spark, path)
        rows = v.orderBy("file_pos").select("id").collect()
        assert [r.id for r in rows[:2]] == first and len(rows) == 399
        calls = readers.calls_of(v)
        assert {(r.id[0], r.sample) for r in calls.collect()} == {("x", "s1"), ("y", "s2"), ("y", "s3")}
    (tmp_path / "c.vcf").write_text(f"{head}\ts4\nchr1\t1\tx\tA\tC\t.\t.\t.\tGT\t0/1\t1/1\n")
    with pytest.raises(Exception, match="do not match the header"):
        readers.read_vcf(spark, str(tmp_path)).collect()


def test_file_order_of_any_size_numbers_suffixes(spark):
    from varloom.operators import rows as r

    d = spark.createDataFrame([("chr1", 1, f"b_{s}", p) for s, p in ((3, 5), (1, 1 << 40), (2, 7), (1, 1 << 50))], "chrom string, pos int, id string, file_pos bigint")
    got = [x.id for x in r.reassign_suffixes(d.withColumn("was", F.col("id"))).orderBy("was", "file_pos").collect()]
    assert got == ["b_1", "b_2", "b_3", "b_4"]


def test_writers_of_shards(spark, tmp_path):
    d = spark.range(1000).select(F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("sample"), F.col("id").alias("pos"), F.lit("chr1").alias("chrom"))
    writers.write_per_sample(d, str(tmp_path / "per"))
    files = list((tmp_path / "per").glob("sample=*/*.parquet"))
    assert {f.parent.name for f in files} == {"sample=s0", "sample=s1", "sample=s2"} and len(files) <= 12
    hot = d.withColumn("pos", F.when(F.col("pos") % 3 == 0, 7).otherwise(F.col("pos"))).unionByName(d.withColumn("chrom", F.lit("chr10"))).withColumn("id", F.monotonically_increasing_id())
    m = writers.shard_by_records(hot.repartition(7), str(tmp_path / "rec"), 300).orderBy("shard").collect()
    assert [r["rows"] for r in m] == [300] * 6 + [200] and m[0].first_chrom == "chr1" and m[-1].last_chrom == "chr10" and m[-1].last_pos == 999
    assert all((a.last_chrom, a.last_pos) <= (b.first_chrom, b.first_pos) for a, b in zip(m, m[1:]))
    assert [spark.read.parquet(str(tmp_path / "rec" / f"shard={i}")).count() for i in range(7)] == [300] * 6 + [200]
    writers.write_site_table(d, str(tmp_path / "sites"), 400)
    assert spark.read.parquet(str(tmp_path / "sites")).filter("region_bin = 1").count() == 400
    writers.write_annotation_tsv(spark.createDataFrame([("chr1", None)], "a string, b string"), str(tmp_path / "tsv"))
    assert spark.read.text(str(tmp_path / "tsv")).first()[0] == "chr1\t."
    (tmp_path / "p.ped").write_text("#x\nf\tc\tp\tm\t1\t0\n")
    assert readers.read_ped(spark, str(tmp_path / "p.ped")).first()["mother"] == "m"
    (tmp_path / "a.tsv").write_text("s\tAFR\n")
    assert tuple(readers.read_ancestry(spark, str(tmp_path / "a.tsv")).first()) == ("s", "AFR")


def test_a_cluster_without_a_checkpoint_folder_is_an_error():
    from types import SimpleNamespace

    from varloom.session import checkpoint_folder

    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_folder(SimpleNamespace(sparkContext=sc, conf=conf))


def test_small_sources(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("chr1\t5\tA\tT\tx\t.\t3\n")
    assert tuple(readers.read_annotation_tsv(spark, str(tmp_path / "t.tsv"), ["p", "q"]).first()) == ("chr1", 5, "A", "T", "x", None, "3")
    (tmp_path / "c.json").write_text('[{"LocusId": "L", "MainReferenceRegion": "chr1:3-9", "RepeatUnit": "CAG"}, {"LocusId": "M"}]')
    assert [tuple(r) for r in readers.read_tr_catalog_json(spark, str(tmp_path / "c.json")).collect()] == [("L", "chr1", 3, 9, "CAG")]
    (tmp_path / "c.bed").write_text("chr1\t3\t9\tID=T1;MOTIFS=CAG\n")
    assert readers.read_tr_catalog_bed(spark, str(tmp_path / "c.bed")).first()["trid"] == "T1"
    (tmp_path / "d.bed").write_text("chr1\t0\t9\t12\n")
    assert readers.read_bed(spark, str(tmp_path / "d.bed"), {"depth": "int"}).first()["depth"] == 12
    empty = spark.range(0)
    assert writers.write_tsv_parquet(empty, str(tmp_path / "e")) is False
    assert writers.write_tsv_parquet(spark.range(2), str(tmp_path / "f")) is True
