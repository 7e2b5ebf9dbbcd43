"""Calls read several times are built once, and look-ups by content or place send little."""

import pytest
from pyspark.sql import functions as F

from varloom.operators import collapse as co, evidence as ev
from varloom.plans.fixtures import Tables


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Parts, orders and lines of a few customers."""
    at = str(tmp_path_factory.mktemp("tables"))
    types = ["STANDARD", "ECONOMY", "MEDIUM", "PROMO", "SMALL", "LARGE"]
    part = [(i, f"part {i}", f"Brand#{11 + i % 40}", types[i % 6], i % 50 + 1, 900.0 + i) for i in range(1, 41)]
    spark.createDataFrame(part, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{at}/part.parquet")
    spark.createDataFrame([(o, o % 5 + 1) for o in range(1, 61)], "o_orderkey bigint, o_custkey bigint").write.parquet(f"{at}/orders.parquet")
    lines = [(o, (o * 7 + n * 3) % 40 + 1, (o + n) % 9 + 1, n, float(o * n % 50 + 1), 1000.0 * n + o, (o + n) % 10 / 100, (o * n) % 9 / 100, "ANR"[(o + n) % 3], "FO"[o % 2]) for o in range(1, 61) for n in range(1, 8)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                          "l_returnflag string, l_linestatus string").write.parquet(f"{at}/lineitem.parquet")
    return at


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_kept_call_sets_are_the_views(spark, folder):
    t, k = Tables(spark, folder), Tables(spark, folder).keep_calls("genotypes", "genotypes2")
    for name in ("genotypes", "genotypes2", "multi"):
        a, b = getattr(t, name), getattr(k, name)
        assert a.dtypes == b.dtypes
        assert rows(a.select([F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in a.columns])) == rows(b.select([F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in b.columns]))
        assert "l_orderkey" in plan(a) and "l_orderkey" not in plan(b)


def test_only_named_call_sets_are_kept(spark, folder):
    k = Tables(spark, folder).keep_calls("genotypes")
    assert "l_orderkey" not in plan(k.genotypes) and "l_orderkey" in plan(k.genotypes2)


@pytest.mark.parametrize("name", ["clear_calls", "apply_phase_flips", "phase_statuses", "raw_caller_evidence"])
def test_queries_join_orders_once(spark, folder, name):
    """What a query returns reads kept calls; before, each use joined lineitem and orders again."""
    from varloom.plans import register

    assert "l_orderkey" not in plan(register.QUERIES[name](spark, folder))


def test_nearest_row_builds_no_pairs(spark):
    window = 5
    size = 32 * (window + 1)
    at = [0, 3, 4, size - 2, size, size + 3, 2 * size - 5, 2 * size + 5, 900, None]
    points = spark.createDataFrame([("k", p) for p in at for _ in range(2)] + [(None, 3), ("other", 3)], "k string, start int")
    spots = [(1, 1), (6, 2), (size - 1, 3), (size - 1, 0), (2 * size, 4), (-2, 5), (-2, 6)]
    calls = spark.createDataFrame([("k", s, o, f"r{o}") for s, o in spots] + [(None, 3, 9, "n")], "k string, start int, file_order int, name string")
    near = ev._nearest_row(points, calls, ["k"], window, ["name"])
    assert "Join" not in plan(near)
    want = {}
    for p in (x for x in at if x is not None):
        best = min(((abs(s - p), s, o) for s, o in spots if abs(s - p) <= window), default=None)
        if best:
            want[p] = f"r{best[2]}"
    got = {r.start: r._n.name for r in near.filter("k = 'k'").collect()}
    assert got == want and len(want) > 5


def test_signature_is_null_where_a_part_is(spark):
    d = spark.createDataFrame([("a", None), (None, "a"), ("a", "b"), ("b", "a"), ("a", "b")], "x string, y string")
    got = [tuple(r) for r in d.select(*ev.signature(["x", "y"])).collect()]
    assert got[0] == got[1] == (None, None) and got[2] == got[4] and got[2] != got[3] and got[2][0] != got[2][1]


def test_merged_calls_send_only_own_and_carried_calls(spark):
    clusters = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a"), ("d", "d")], "id string, kept_id string")
    places = spark.createDataFrame([("a", 5), ("b", 2), ("c", 1), ("d", 9)], "id string, start int")
    calls = spark.createDataFrame([("a", 1, [0, 0]), ("b", 1, [0, 1]), ("c", 1, [0, 0]), ("b", 2, [0, 0]), ("c", 3, [1, 1]), ("b", 3, [0, 1]), ("d", 1, [None, 0])], "id string, sample int, gt array<int>")
    out = co.merged_calls(clusters, calls, places)
    assert sorted((r.id, r.sample, r.gt, r.source) for r in out.collect()) == [("a", 1, [0, 1], "b"), ("a", 3, [1, 1], "c"), ("d", 1, [None, 0], "d")]
    assert "Filter" not in plan(out).split("Aggregate")[0]  # left out before the grouping, not after it


def test_carriers_may_be_given(spark):
    calls = spark.createDataFrame([("a", s, [0, 1]) for s in (1, 2, 2)] + [("b", s, [0, 1]) for s in (1, 3, 4, 5)] + [("b", 9, [0, 0])], "id string, sample int, gt array<int>")
    clusters = spark.createDataFrame([("a", "a"), ("b", "a")], "id string, kept_id string")
    assert rows(co.alike_carriers(clusters, calls)) == rows(co.alike_carriers(clusters, co.carriers(calls))) == [("a", "a"), ("b", "b")]


def test_kept_calls_lie_by_site(spark, folder):
    """Joins of kept calls with sites send the sites only; before, the calls were sent for every use."""
    k = Tables(spark, folder).keep_calls("genotypes", "genotypes2")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = k.genotypes.join(k.sites.select("vid", "id"), "vid")
        assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert joined.count() == k.genotypes.count() > 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not spark.catalog.listTables("default") or all(not x.name.startswith("calls_") for x in spark.catalog.listTables("default"))


CALL = "id string, sample int, chrom string, pos int, start int, end int, ref string, alts array<string>, gt array<int>, dp int, svtype string, svlen int, len int, kind string, seq string"


def evidence_input(spark):
    row = lambda i, s, alt, gt, ref="A": (i, s, "c", 5, 5, 6, ref, [alt], gt, 9, "INS", 60, 60, "INS", alt)
    long, other = "A" + "CG" * 30, "A" + "TA" * 30
    v = spark.createDataFrame([row("a", 1, long, [0, 1]), row("a", 2, long, [1, 1]), row("b", 1, other, [0, 1]), row("b", 3, other, [0, 0]), row("n", 1, None, [0, 1])], CALL)
    again = spark.createDataFrame([("a", 1, "c", 5, "a", [other], [1, 1], [1, 1], 2), ("a", 1, "c", 5, "a", [long.lower()], [0, 1], [7, 8], 15), ("a", 1, "c", 5, "A", [long], [0, 0], [9, 9], 18), ("b", 3, "c", 5, "A", [other], [0, 0], [4, 0], 4), ("n", 1, "c", 5, "A", None, [0, 1], [1, 1], 2)],
                                  "id string, sample int, chrom string, pos int, ref string, alts array<string>, gt array<int>, ad array<int>, dp int")
    call = lambda s, who, alt, order, gt, r, a: (s, who, "c", 5, "INS", 60, "A", [alt], gt, {"DR": r, "DV": a}, order, 60, "INS", alt)
    raw = spark.createDataFrame([call(1, "cutesv", long, 4, [1, 1], "1", "2"), call(1, "cutesv", long, 2, [0, 1], "3", "4"), call(1, "sniffles", long, 9, [1, 1], "5", "6"), call(2, "cutesv", other, 1, [0, 1], "1", "1"),
                                 call(3, "cutesv", other, 3, [0, 1], "1", "1"), call(1, "sniffles", None, 5, [0, 1], "1", "1")],
                                "sample int, caller string, chrom string, start int, svtype string, svlen int, ref string, alts array<string>, gt array<int>, fields map<string, string>, file_order long, len int, kind string, seq string")
    return v, again, raw


def test_evidence_by_alleles_content_and_sample(spark):
    got = {(r.id, r["sample"]): (r.gt, r.ad, r.ev, r.bev, r["count_match_site_kp"], r["count_match_gt_nonkp"]) for r in ev.raw_caller_evidence(*evidence_input(spark)).collect()}
    assert got == {("a", 1): ([0, 1], [7, 8], ["cutesv_(3_4)", "kanpig_(7_8)"], "kanpig", 1, 1), ("a", 2): ([1, 1], None, None, None, 0, 0), ("b", 1): ([0, 1], None, None, None, 0, 0), ("b", 3): ([0, 0], [4, 0], None, None, 0, 0),
                   ("n", 1): ([0, 1], None, None, None, 0, 0)}


def test_evidence_sends_calls_once(spark):
    """Raw calls go once, to the content and sample they are asked for, and every row meets its evidence by id and sample: before, 15 shuffles."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = ev.raw_caller_evidence(*evidence_input(spark))
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 7
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
