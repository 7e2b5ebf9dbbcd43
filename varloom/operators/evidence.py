"""Which callers support a call, from their raw calls.

Calls of raw callers: sample, caller, chrom, start, svtype, svlen, ref, alts, gt, ``fields`` (FORMAT values as map<string, string>), and ``file_order`` (ties
go to what stands first). A caller's read depths are read by ``DEPTHS``; assembly callers have none. ``stats`` lists the callers that
supported a variant when the call set was merged: id, chrom, start, end, svtype, svlen, callers (array), and sample where lists differ by sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import genotype as g
from ..functions.alleles import c, sequence_score, size_similarity
from ..session import cut_lineage
from .matching import SEQ, contents, near_pairs

# The FORMAT fields of each caller's reference and alternative depths (one field: a list by allele).
DEPTHS = {"cutesv": ("DR", "DV"), "sniffles": ("DR", "DV"), "delly": ("RR", "RV"), "pbsv": ("AD",), "sawfish": ("AD",)}
# Callers without depths, and those that don't count as support in a merge list.
ASSEMBLY = ["dipcall", "hapdiff"]
NOT_LISTED = ["pav", "kanpig"]
REGENOTYPER = "kanpig"
COUNTERS = ["count", "count_match_site", "count_match_gt", "count_match_gt_ad", "count_match_site_kp", "count_match_gt_kp", "count_match_gt_ad_kp",
            "count_match_site_nonkp", "count_match_gt_nonkp", "count_match_gt_ad_nonkp"]


def reads(caller="caller", fields="fields", ref="ref", alts="alts") -> Column:
    """struct(ad, sizes): depths by allele as the caller states them (NULL if any is missing), and how far each ALT's length is from REF's."""
    value = lambda k: F.try_element_at(c(fields), F.lit(k))
    ad = F.lit(None).cast("array<int>")
    for names in dict.fromkeys(DEPTHS.values()):
        who = [k for k, v in DEPTHS.items() if v == names]
        texts = F.split(value(names[0]), ",") if len(names) == 1 else F.array(*[value(k) for k in names])
        ad = F.when(c(caller).isin(who), F.transform(texts, lambda x: x.try_cast("int"))).otherwise(ad)
    whole = F.coalesce(F.forall(ad, lambda x: x.isNotNull()), F.lit(False))
    return F.struct(F.when(whole, ad).alias("ad"), F.transform(c(alts), lambda a: F.abs(F.length(a) - F.length(c(ref)))).alias("sizes"))


def depth_pair(read: Column, target: Column) -> Column:
    """array(ref, alt) of ``reads``: of several ALTs the one whose length is closest to ``target``, the first of several; NULL if it can't be told."""
    gaps = F.transform(read["sizes"], lambda n, i: F.struct(F.abs(n - F.abs(target)).alias("d"), i.alias("i")))
    alt = F.get(read["ad"], F.array_min(gaps)["i"] + 1)
    many = F.when(alt.isNotNull() & target.isNotNull(), F.array(F.get(read["ad"], F.lit(0)), alt))
    return F.when(F.size(read["ad"]) == 2, read["ad"]).when(F.size(read["ad"]) > 2, many)


SIGNED = ["_sig1", "_sig2"]


def signature(cols: list[str]) -> list[Column]:
    """128 bits of a hash of ``cols`` to join by instead of them (NULL if one is), so that calls are sent without their sequences."""
    whole = F.forall(F.array(*[F.col(x).isNotNull() for x in cols]), lambda b: b)
    return [F.when(whole, F.xxhash64(F.lit(i), *cols)).alias(name) for i, name in enumerate(SIGNED)]


def _nearest_row(points: DataFrame, rows: DataFrame, by: list[str], window: int, cols: list[str]) -> DataFrame:
    """Distinct points (``by``, start) with ``_n``: the ``cols`` of the nearest row within ``window``; ties go to the lower place, then to what stands first.

    Rows are folded to one a place and no pairs are built: in stretches of 32 windows a point takes the last row up to it or the first one from it on. A row
    also stands in a neighbouring stretch if its window reaches there.
    """
    at = lambda x: F.floor(x / F.lit(32 * (window + 1)))
    spots = rows.groupBy(*by, "start").agg(F.min_by(F.struct(*cols), "file_order").alias("_row"))
    reach = F.explode(F.array_distinct(F.array(at(F.col("start") - window), at(F.col("start") + window))))
    spots = spots.select(*by, "start", reach.alias("_at"), F.struct(F.col("start").alias("s"), "_row").alias("_e"))
    asked = points.select(*by, "start").distinct().select(*by, "start", at(F.col("start")).alias("_at"))
    both = spots.withColumn("_asked", F.lit(False)).unionByName(asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    place = W.partitionBy(*by, "_at")
    nearest = lambda order: F.last("_e", ignorenulls=True).over(place.orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow))
    x = both.withColumns({"_l": nearest(F.col("start")), "_r": nearest(F.col("start").desc())}).filter("_asked")
    left, right = F.col("start") - F.col("_l.s"), F.col("_r.s") - F.col("start")
    lower = F.coalesce(left <= right, F.col("_r").isNull())
    x = x.filter(F.least(left, right) <= window).select(*by, "start", F.when(lower, F.col("_l._row")).otherwise(F.col("_r._row")).alias("_n"))
    return x


def listed_nearest(variants: DataFrame, stats: DataFrame, window: int = 500) -> DataFrame:
    """Variants (id, sample, chrom, start, svtype) with the ``callers``, ``s_type`` and ``s_len`` of their list: that of their id, else the nearest of
    their type with callers within ``window``; without either, or with an empty list, a variant is left out."""
    who = ["sample"] if "sample" in stats.columns else []
    item = F.struct(F.col("callers"), F.col("svtype").alias("s_type"), F.col("svlen").alias("s_len"))
    own = stats.groupBy("id", *who).agg(F.max_by(item, F.struct("start", "svlen")).alias("_s"))
    x = variants.join(own, ["id", *who], "left")
    some = stats.filter(F.size("callers") > 0).withColumnRenamed("svlen", "s_len").withColumn("s_type", F.col("svtype"))
    near = _nearest_row(x.filter("_s IS NULL"), some, ["chrom", "svtype", *who], window, ["callers", "s_type", "s_len"])
    x = x.join(near, ["chrom", "svtype", *who, "start"], "left").withColumn("_s", F.coalesce("_s", "_n"))
    return x.filter(F.size("_s.callers") > 0).select(*variants.columns, "_s.*")


def caller_support(variants: DataFrame, stats: DataFrame, calls: DataFrame, window: int = 500, min_length: int = 50) -> DataFrame:
    """(id, sample, caller, ref_depth, alt_depth): for each carried variant and each caller of its list, that caller's nearest call of
    the listed type within ``window`` and of at least ``min_length``; calls whose depths can't be told are left out.

    Variants: id, sample, chrom, start, svtype, gt.
    """
    v = listed_nearest(variants.filter(g.is_carrier("gt")).select("id", "sample", "chrom", "start", "svtype"), stats, window)
    v = v.withColumn("caller", F.explode(F.array_distinct("callers"))).filter(~F.col("caller").isin(ASSEMBLY)).drop("svtype").withColumnRenamed("s_type", "svtype")
    r = calls.filter(F.abs("svlen") >= min_length).withColumn("read", reads())
    by = ["chrom", "svtype", "caller", "sample"]
    near = _nearest_row(v, r, by, window, ["read"])
    x = v.join(near, [*by, "start"]).withColumn("_d", depth_pair(F.col("_n.read"), F.col("s_len"))).filter("_d IS NOT NULL")
    return x.select("id", "sample", "caller", F.get("_d", F.lit(0)).alias("ref_depth"), F.get("_d", F.lit(1)).alias("alt_depth"))


def allowed_callers(variants: DataFrame, stats: DataFrame, window: int | None = None) -> DataFrame:
    """(id, sample, allowed): the callers of a variant's list, by id, else (with ``window``) of the list entry of its type whose size, span and place
    are most alike; NULL where there is none, which allows all."""
    who = ["sample"] if "sample" in stats.columns else []
    listed = stats.withColumn("callers", F.array_except("callers", F.array(*[F.lit(x) for x in NOT_LISTED])))
    own = listed.groupBy("id", *who).agg(F.max_by("callers", F.col("file_order")).alias("_own"))
    if window is None:
        return variants.join(own, ["id", *who], "left").select("id", "sample", F.col("_own").alias("allowed"))
    by = ["chrom", "svtype", *who]
    cols = [*by, "start", "end", "svlen"]
    # A list is sought once for all samples that share it.
    x = variants.select("id", *cols).distinct().join(own, ["id", *who], "left")
    p = near_pairs(x.filter("_own IS NULL").select(*cols).distinct(), listed.filter(F.size("callers") > 0).select(*cols, "callers", "file_order"), window, by)
    n, m = (F.greatest(F.lit(1), F.abs(F.col(k))) for k in ("svlen", "b_svlen"))
    span = lambda s, e: F.greatest(F.lit(1), F.col(e) - F.col(s))
    overlap = F.greatest(F.lit(0), F.least("end", "b_end") - F.greatest("start", "b_start"))
    score = F.least(n, m) / F.greatest(n, m) + overlap / F.greatest(span("start", "end"), span("b_start", "b_end")) + F.greatest(F.lit(0.0), 1.0 - F.abs(F.col("b_start") - F.col("start")) / window)
    best = p.groupBy(*cols).agg(F.min_by("b_callers", F.struct(-score, "b_start", "b_file_order")).alias("_near"))
    found = x.join(best, cols, "left").select("id", *who, F.xxhash64(*cols).alias("_at"), F.coalesce("_own", "_near").alias("allowed")).filter("allowed IS NOT NULL")
    return variants.select("id", "sample", F.xxhash64(*cols).alias("_at")).join(found, ["id", *who, "_at"], "left").select("id", "sample", "allowed")


def best_matches(variants: DataFrame, calls: DataFrame, window: int, reciprocal: float, seq_sim: float, size_sim: float) -> DataFrame:
    """(id, sample, matches): each caller's most similar call of the sample, by the mean of sequence, size and overlap similarity (ties: the first).

    Both sides carry the columns of ``SEQ``. Contents are paired once, whatever number of samples carries them; a list holds one entry a caller. Calls are sent
    once, by the signature of their content and the sample, and what matches once more, by id and sample.
    """
    q, r = contents(variants, SEQ), contents(calls, SEQ, "file_order")
    p = near_pairs(q, r, window, ("chrom", "kind"), size_sim=size_sim).withColumn("_s", sequence_score("seq", "b_seq", seq_sim)).filter("_s IS NOT NULL")
    shared = F.greatest(F.lit(0), F.least(F.col("start") + F.col("len"), F.col("b_start") + F.col("b_len")) - F.greatest("start", "b_start")) / F.greatest("len", "b_len")
    p = p.withColumn("_o", shared).filter(F.col("_o") >= reciprocal - 1e-9)
    theirs = [x if x in ("chrom", "kind") else f"b_{x}" for x in SEQ]
    asked = [f"_q{x}" for x in SIGNED]
    p = cut_lineage(p.select(*[x.alias(n) for x, n in zip(signature(SEQ), asked)], *signature(theirs), ((F.col("_s") + size_similarity("len", "b_len") + F.col("_o")) / 3).alias("score"), "b_start"))
    own = calls.select("sample", "caller", "file_order", g.n_alt("gt").alias("n"), g.is_carrier("gt").alias("called"), reads().alias("read"), *signature(SEQ))
    own = own.select("sample", "caller", "file_order", "n", "called", "read.ad", "read.sizes", *SIGNED)
    v = variants.select("id", "sample", *[x.alias(n) for x, n in zip(signature(SEQ), asked)]).join(p, asked).drop(*asked)
    m = F.struct("caller", "n", "called", F.struct("ad", "sizes").alias("read"))
    found = v.join(own, [*SIGNED, "sample"]).drop(*SIGNED).repartition("id", "sample")
    best = found.groupBy("id", "sample", "caller").agg(F.min_by(m, F.struct(-F.col("score"), "b_start", "file_order")).alias("m"))
    return best.groupBy("id", "sample").agg(F.array_sort(F.collect_list("m")).alias("matches"))


def raw_caller_evidence(variants: DataFrame, regenotyped: DataFrame, calls: DataFrame, stats: DataFrame | None = None, window: int = 500, reciprocal: float = 0.0, seq_sim: float = 0.7,
                        size_sim: float = 0.7, list_window: int | None = None, same_gt_regenotyper: bool = True, same_gt_callers: bool = True) -> DataFrame:
    """Evidence of every call: gt, dp, ad, pl, gq, ``ev`` (``caller_(ref_alt)``, without depths just the caller), ``bev`` and the ten counters (0 or 1).

    Variants: id, sample, chrom, pos, ref, alts, gt, dp, svtype, svlen, end and the columns of ``SEQ``. ``regenotyped``: id, sample, chrom, pos, ref, alts, gt,
    ad, dp; matched by alleles in upper case and id. A carried call is supported by the re-genotyper and by callers' most similar calls,
    which must agree in the number of ALT copies (or, without ``same_gt_*``, be carried). BEV is the re-genotyper if it is in EV, else
    the caller with depths whose GQ is highest (the first by name of several); it gives AD, PL and GQ, and without BEV these are cleared. A call that is not
    carried takes the re-genotyper's reference call, or is cleared if that is missing or carried.
    """
    up = lambda d: d.withColumns({"_ref": F.upper("ref"), "_alts": F.transform("alts", lambda a: F.upper(a))})
    spelled = F.when(F.forall(F.array(*[F.col(n).isNotNull() for n in ("chrom", "pos", "_ref", "_alts")]), lambda b: b), F.xxhash64("chrom", "pos", "_ref", "_alts"))
    signed = lambda d, *cols: up(d).select("id", "sample", *cols, spelled.alias("_sig"))
    # A call's rows of the re-genotyper meet it by id and sample, as all else does, and are told apart by their alleles there (64 bits of a hash).
    again = signed(regenotyped, "gt", "ad", "dp").filter("_sig IS NOT NULL").repartition("id", "sample").groupBy("id", "sample", "_sig").agg(F.max(F.struct("gt", "ad", "dp")).alias("k"))
    again = again.groupBy("id", "sample").agg(F.collect_list(F.struct("_sig", "k")).alias("_ks"))
    x = signed(variants, "gt", "dp", "svlen", F.size("alts").alias("_n_alts")).join(again, ["id", "sample"], "left")
    x = x.withColumn("_k", F.get(F.filter("_ks", lambda k: k["_sig"] == F.col("_sig")), F.lit(0))["k"]).drop("_ks", "_sig")
    x = x.join(best_matches(variants.filter(g.is_carrier("gt")), calls, window, reciprocal, seq_sim, size_sim), ["id", "sample"], "left")
    if stats is not None:
        x = x.join(allowed_callers(variants.select("id", "sample", "chrom", "svtype", "start", "end", "svlen"), stats, list_window), ["id", "sample"], "left")
    else:
        x = x.withColumn("allowed", F.lit(None).cast("array<string>"))
    copies = g.n_alt("gt")
    none = F.array().cast("array<struct<caller:string,ad:array<int>>>")
    kp_ad = F.slice(F.col("_k.ad"), 1, 2)
    kp_same = g.n_alt("_k.gt") == copies if same_gt_regenotyper else g.is_carrier("_k.gt")
    x = x.withColumns({
        "_carried": g.is_carrier("gt"), "_kp": F.coalesce(F.col("_k").isNotNull() & kp_same, F.lit(False)),
        "_m": F.filter(F.coalesce("matches", F.array().cast(dict(x.dtypes)["matches"])), lambda m: F.col("allowed").isNull() | F.array_contains("allowed", m["caller"]))})
    x = x.withColumn("_same", F.filter("_m", lambda m: (m["n"] == copies) if same_gt_callers else m["called"]))
    support = F.concat(F.when(F.col("_kp"), F.array(F.struct(F.lit(REGENOTYPER).alias("caller"), kp_ad.alias("ad")))).otherwise(none),
                       F.transform("_same", lambda m: F.struct(m["caller"].alias("caller"), F.when(~m["caller"].isin(ASSEMBLY), depth_pair(m["read"], F.col("svlen"))).alias("ad"))))
    x = x.withColumn("_sup", F.when(F.col("_carried"), F.array_sort(support)).otherwise(none))
    pl = lambda ad: g.pl_from_ad(F.get(ad, F.lit(0)), F.get(ad, F.lit(1)))
    scored = F.transform(F.filter("_sup", lambda s: s["ad"].isNotNull()), lambda s: F.struct((-g.gq_from_pl(pl(s["ad"]))).alias("q"), s["caller"].alias("caller"), s["ad"].alias("ad")))
    x = x.withColumn("_best", F.when(F.col("_kp") & F.col("_carried"), F.struct(F.lit(0).alias("q"), F.lit(REGENOTYPER).alias("caller"), kp_ad.alias("ad"))).otherwise(F.array_min(scored)))
    rested = ~g.is_carrier("_k.gt") & ~g.all_null("_k.gt")  # a reference call of the re-genotyper
    n_alleles = F.col("_n_alts") + 1
    same_length = lambda a: F.transform(F.sequence(F.lit(1), n_alleles), lambda i: F.lit(a).cast("int"))
    flat = F.when(F.col("_k").isNull(), F.col("gt")).when(rested, same_length(0)).otherwise(same_length(None))
    ad = F.when(F.col("_carried"), F.col("_best.ad")).when(rested, F.col("_k.ad"))
    x = x.withColumns({"_ad": ad, "_gt": F.when(F.col("_carried"), F.col("gt")).otherwise(g.sort_missing_last(flat))})
    kp_dp = F.when(F.col("_best.caller") == REGENOTYPER, F.coalesce("_k.dp", "dp")).when(F.col("_best").isNotNull(), F.col("dp"))
    one = lambda b: (F.col("_carried") & F.coalesce(b, F.lit(False))).cast("int")
    kp_site, kp = F.col("_k").isNotNull(), F.col("_kp")
    site, same = F.size("_m") > 0, F.size("_same") > 0
    deep = F.exists("_sup", lambda s: (s["caller"] != REGENOTYPER) & s["ad"].isNotNull())
    flags = [F.lit(True), kp_site | site, kp | same, kp | deep, kp_site, kp, kp, site, same, deep]
    text = F.transform("_sup", lambda s: F.when(s["ad"].isNull(), s["caller"]).otherwise(F.format_string("%s_(%d_%d)", s["caller"], F.get(s["ad"], F.lit(0)), F.get(s["ad"], F.lit(1)))))
    return x.select("id", "sample", F.col("_gt").alias("gt"), F.when(F.col("_carried"), kp_dp).when(rested, F.col("_k.dp")).alias("dp"), F.col("_ad").alias("ad"),
                    F.when(F.col("_ad").isNotNull(), pl(F.col("_ad"))).alias("pl"), F.when(F.col("_ad").isNotNull(), g.gq_from_pl(pl(F.col("_ad")))).alias("gq"),
                    F.when(F.size("_sup") > 0, text).alias("ev"), F.col("_best.caller").alias("bev"), *[one(b).alias(n) for n, b in zip(COUNTERS, flags)])


def match_counts(evidence: DataFrame) -> DataFrame:
    """The ten counters by sample."""
    return evidence.groupBy("sample").agg(*[F.sum(n).alias(n) for n in COUNTERS])
