"""Interval operators; intervals are half-open ``[start, end)`` unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.alleles import overlap_bases
from ..session import cut_lineage
from .positions import at_positions, next_pos, overlap_pairs, point_in_interval, running, stab_max

IV = ("start", "end")


def interval_overlap(a: DataFrame, b: DataFrame, a_iv=IV, b_iv=IV, by=("chrom",), min_fraction: float | None = None,
                     reciprocal: bool = False, prefix: str = "b_") -> DataFrame:
    """Overlapping pairs with ``overlap`` bases, optionally covering a fraction of A (and of B)."""
    p = overlap_pairs(a, b, a_iv, b_iv, by, prefix)
    p = p.withColumn("overlap", overlap_bases(a_iv[0], a_iv[1], prefix + b_iv[0], prefix + b_iv[1]))
    if min_fraction is not None:
        p = p.filter(F.col("overlap") >= min_fraction * (F.col(a_iv[1]) - F.col(a_iv[0])) - 1e-9)
        if reciprocal:
            p = p.filter(F.col("overlap") >= min_fraction * (F.col(prefix + b_iv[1]) - F.col(prefix + b_iv[0])) - 1e-9)
    return p


def _both_ends(df: DataFrame, lo: Column, hi: Column, by, extra=()) -> DataFrame:
    """One row per end: ``_p`` and whether it is the start (one pass over ``df``)."""
    ends = F.array(F.struct(lo.cast("bigint").alias("p"), F.lit(1).alias("s")), F.struct(hi.cast("bigint").alias("p"), F.lit(0).alias("s")))
    return df.select(*by, *extra, F.explode(ends).alias("_x")).select(*by, *extra, F.col("_x.p").alias("_p"), F.col("_x.s").alias("_s"))


def _events(b: DataFrame, b_iv, by) -> DataFrame:
    """Per position: how many intervals start (``_s``) and how many end (``_e``) there."""
    s, e = b_iv
    ends = _both_ends(b.filter(F.col(s) < F.col(e)), F.col(s), F.col(e), by)
    return ends.groupBy(*by, "_p").agg(F.sum("_s").alias("_s"), F.sum(1 - F.col("_s")).alias("_e"))


def overlap_count(a: DataFrame, b: DataFrame, a_iv=IV, b_iv=IV, by=("chrom",), out: str = "n_overlaps") -> DataFrame:
    """Number of B intervals each A overlaps, from prefix sums (no pairs are built).

    Overlapping = starting before A ends, minus ending at or before A's start.
    """
    by = list(by)
    s, e = a_iv
    pts = _both_ends(a, F.col(s), F.col(e) - 1, by)
    run = cut_lineage(at_positions(pts.drop("_s"), _events(b, b_iv, by), "_p", by, sums=["_s", "_e"]))
    began = run.select(*by, F.col("_p").alias("_pe"), F.col("run__s").alias("_began"))
    ended = run.select(*by, F.col("_p").alias("_ps"), F.col("run__e").alias("_ended"))
    x = a.withColumn("_pe", F.col(e).cast("bigint") - 1).withColumn("_ps", F.col(s).cast("bigint"))
    x = x.join(began, [*by, "_pe"], "left").join(ended, [*by, "_ps"], "left")
    n = F.coalesce("_began", F.lit(0)) - F.coalesce("_ended", F.lit(0))
    n = F.when(F.col(s) < F.col(e), n).otherwise(F.lit(0))
    return x.withColumn(out, n.cast("bigint")).drop("_pe", "_ps", "_began", "_ended")


def interval_semi(a, b, a_iv=IV, b_iv=IV, by=("chrom",)) -> DataFrame:
    return overlap_count(a, b, a_iv, b_iv, by, "_n").filter("_n > 0").drop("_n")


def interval_anti(a, b, a_iv=IV, b_iv=IV, by=("chrom",)) -> DataFrame:
    """A rows that share no base with any B row."""
    return overlap_count(a, b, a_iv, b_iv, by, "_n").filter("_n = 0").drop("_n")


def slop(df: DataFrame, by_bases: int, contig_lengths: DataFrame | None = None, iv=IV) -> DataFrame:
    """Widen both ends; clipped at 0 and, when given, at ``contig_lengths(chrom, length)``."""
    s, e = iv
    out = df.withColumn(s, F.greatest(F.col(s) - by_bases, F.lit(0))).withColumn(e, F.col(e) + by_bases)
    if contig_lengths is None:
        return out
    cl = contig_lengths.select("chrom", F.col("length").alias("_len"))
    return out.join(cl, "chrom", "left").withColumn(e, F.least(F.col(e), F.coalesce("_len", F.col(e)))).drop("_len")


def islands(df: DataFrame, iv=IV, by=("chrom",), gap: int = 0, touching: bool = True) -> DataFrame:
    """Maximal merged stretches ``(by, start, end)``.

    Touching intervals join unless ``touching`` is false; with ``gap`` stretches
    up to that many bases apart join too.
    """
    by = list(by)
    s, e = iv
    d = df.select(*by, F.col(s).alias("_s0"), (F.col(e) + gap).alias("_e0"))
    d = d.filter(F.col("_s0") < F.col("_e0"))
    if not touching:
        # Doubled coordinates keep "ends here" before "starts here".
        d = d.withColumn("_s0", F.col("_s0") * 2 + 1).withColumn("_e0", F.col("_e0") * 2)
    ev = _events(d, ("_s0", "_e0"), by).withColumn("_d", F.col("_s") - F.col("_e"))
    r = running(ev, "_p", by, sums=["_d"])
    edge = r.filter((F.col("run__d") == 0) | (F.col("run__d") == F.col("_d")))
    # A position may close one island and open the next only when touching is off,
    # and then the doubled coordinates keep the two apart.
    edge = cut_lineage(edge.filter(~((F.col("run__d") == 0) & (F.col("_d") == 0))))
    closed = next_pos(edge.select(*by, "_p", "run__d"), "_p", by, "_q").filter("run__d > 0")
    st, en = F.col("_p"), F.col("_q")
    if not touching:
        st, en = ((st - 1) / 2).cast("int"), (en / 2).cast("int")
    return closed.select(*by, st.cast("int").alias("start"), (en - gap).cast("int").alias("end"))


def assign_islands(df: DataFrame, isl: DataFrame, iv=IV, by=("chrom",)) -> DataFrame:
    """Add ``island_start``/``island_end`` of the stretch each interval lies in."""
    by = list(by)
    ev = isl.select(*by, F.col("start").alias("_p"), F.struct("start", "end").alias("_isl"))
    at = at_positions(df.select(*by, F.col(iv[0]).alias("_p")), ev, "_p", by, maxes=["_isl"])
    x = df.withColumn("_p", F.col(iv[0])).join(at, [*by, "_p"], "left")
    return (x.withColumn("island_start", F.col("run__isl.start")).withColumn("island_end", F.col("run__isl.end"))
            .drop("_p", "run__isl"))


def interval_merge(df: DataFrame, collapse: dict[str, str] | None = None, iv=IV, by=("chrom",), gap: int = 0,
                   order: str | None = None) -> DataFrame:
    """Merged stretches; ``collapse`` maps output name -> column joined by commas in interval order."""
    isl = cut_lineage(islands(df, iv, by, gap))
    if not collapse:
        return isl
    by = list(by)
    x = assign_islands(df.filter(F.col(iv[0]) < F.col(iv[1])), isl, iv, by)
    tie = F.col(order) if order else F.lit(0)
    aggs = []
    for out, col in collapse.items():
        items = F.array_sort(F.collect_list(F.struct(F.col(iv[0]), F.col(iv[1]), tie, F.col(col).cast("string").alias("v"))))
        aggs.append(F.array_join(F.transform(items, lambda z: z["v"]), ",").alias(out))
    return x.groupBy(*by, F.col("island_start").alias("start"), F.col("island_end").alias("end")).agg(*aggs)


def covered_before(points: DataFrame, b: DataFrame, b_iv=IV, by=("chrom",)) -> DataFrame:
    """For each distinct point ``_p``: bases below it covered by the union of B (``covered``)."""
    by = list(by)
    ev = _events(b, b_iv, by).select(*by, "_p", (F.col("_s") - F.col("_e")).alias("_d"), F.lit(False).alias("_ask"))
    p = points.select(*by, "_p", F.lit(0).cast("bigint").alias("_d"), F.lit(True).alias("_ask"))
    per = ev.unionByName(p).groupBy(*by, "_p").agg(F.sum("_d").alias("_d"), F.max("_ask").alias("_ask"))
    r = running(per, "_p", by, sums=["_d"], following="_q")
    r = r.withColumn("_len", F.when(F.col("run__d") > 0, F.coalesce(F.col("_q") - F.col("_p"), F.lit(0))).otherwise(0).cast("bigint"))
    r = running(cut_lineage(r.select(*by, "_p", "_len", "_ask")), "_p", by, sums=["_len"])
    return r.filter("_ask").select(*by, "_p", (F.col("run__len") - F.col("_len")).alias("covered"))


def interval_coverage(a: DataFrame, b: DataFrame, a_iv=IV, b_iv=IV, by=("chrom",), out: str = "fraction") -> DataFrame:
    """Share of each A interval covered by the union of B; 0 for empty A."""
    by = list(by)
    s, e = a_iv
    pts = _both_ends(a, F.col(s), F.col(e), by).drop("_s")
    cov = cut_lineage(covered_before(pts, b, b_iv, by))
    lo = cov.select(*by, F.col("_p").alias("_pa"), F.col("covered").alias("_lo"))
    hi = cov.select(*by, F.col("_p").alias("_pb"), F.col("covered").alias("_hi"))
    x = a.withColumn("_pa", F.col(s).cast("bigint")).withColumn("_pb", F.col(e).cast("bigint"))
    x = x.join(lo, [*by, "_pa"], "left").join(hi, [*by, "_pb"], "left")
    frac = F.when(F.col(e) > F.col(s), (F.col("_hi") - F.col("_lo")) / (F.col(e) - F.col(s))).otherwise(F.lit(0.0))
    return x.withColumn(out, frac.cast("double")).drop("_lo", "_hi", "_pa", "_pb")


def nearest(a: DataFrame, b: DataFrame, a_iv=IV, b_iv=IV, by=("chrom",), prefix: str = "b_") -> DataFrame:
    """Every B row at the smallest distance from each A row (``distance``; all ties kept).

    Overlap is 0 and touching is 1. A rows in a group without B rows are dropped.
    """
    by = list(by)
    s, e = a_iv
    bs, be = b_iv
    ends = b.select(*by, F.col(be).alias("_p")).distinct().withColumn("_end", F.col("_p"))
    starts = b.select(*by, F.col(bs).alias("_p")).distinct().withColumn("_start", F.col("_p"))
    left = at_positions(a.select(*by, F.col(s).alias("_p")), ends, "_p", by, maxes=["_end"])
    right = at_positions(a.select(*by, F.col(e).alias("_p")), starts, "_p", by, mins=["_start"], reverse=True)
    x = overlap_count(a, b, a_iv, b_iv, by, "_n")
    x = (x.withColumn("_p", F.col(s)).join(left, [*by, "_p"], "left").drop("_p")
         .withColumn("_p", F.col(e)).join(right, [*by, "_p"], "left").drop("_p"))
    dl = F.col(s) - F.col("run__end") + 1
    dr = F.col("run__start") - F.col(e) + 1
    x = x.withColumn("_dl", dl).withColumn("_dr", dr).withColumn("distance", F.when(F.col("_n") > 0, 0).otherwise(F.least("_dl", "_dr")))
    bp = b.select(*[F.col(k) for k in by], *[F.col(k).alias(prefix + k) for k in b.columns if k not in by])
    x = cut_lineage(x)
    tmp = ["_n", "_dl", "_dr", "run__end", "run__start"]
    hit = overlap_pairs(x.filter("distance = 0").drop(*tmp), b, a_iv, b_iv, by, prefix)
    lt = x.filter("distance > 0 and _dl = distance").withColumn(prefix + be, F.col("run__end")).drop(*tmp).join(bp, [*by, prefix + be])
    rt = x.filter("distance > 0 and _dr = distance").withColumn(prefix + bs, F.col("run__start")).drop(*tmp).join(bp, [*by, prefix + bs])
    cols = hit.columns
    return hit.unionByName(lt.select(*cols)).unionByName(rt.select(*cols))


def beaten_by_overlap(df: DataFrame, priority: Column, iv=IV, by=("chrom",)) -> DataFrame:
    """Add ``beaten``: does any overlapping row have a higher priority?

    ``priority`` must rank longer intervals first. Then whoever beats a row also
    covers one of the row's end bases, and two stabbing look-ups are enough.
    """
    by = list(by)
    s, e = iv
    d = df.withColumn("_prio", priority).withColumn("_first", F.col(s)).withColumn("_last", F.col(e) - 1)
    d = d.withColumn("_first", F.col("_first").cast("bigint")).withColumn("_last", F.col("_last").cast("bigint"))
    top = cut_lineage(stab_max(_both_ends(d, F.col("_first"), F.col("_last"), by), d, "_p", s, e, "_prio", by))
    at1 = top.select(*by, F.col("_p").alias("_first"), F.col("top").alias("_t1"))
    at2 = top.select(*by, F.col("_p").alias("_last"), F.col("top").alias("_t2"))
    x = d.join(at1, [*by, "_first"], "left").join(at2, [*by, "_last"], "left")
    beaten = F.coalesce(F.greatest("_t1", "_t2") > F.col("_prio"), F.lit(False))
    return x.withColumn("beaten", beaten).drop("_prio", "_first", "_last", "_t1", "_t2")


def dedup_overlapping(sites: DataFrame, pos: str = "pos", ref: str = "ref", vid: str = "id") -> DataFrame:
    """Drop a site when an overlapping one has a longer REF, or an equal one a smaller id.

    Spans are ``[pos, pos + len(ref))``; decided pairwise, so a dropped site still drops others.
    """
    d = sites.withColumn("_s", F.col(pos)).withColumn("_e", F.col(pos) + F.length(ref))
    # Smaller ids rank higher: compare ids through a rank-reversing map of their characters.
    prio = F.struct(F.length(ref).alias("len"), _descending(F.col(vid)).alias("id"))
    return beaten_by_overlap(d, prio, ("_s", "_e")).filter("not beaten").drop("beaten", "_s", "_e")


def _descending(text: Column) -> Column:
    """Array of negated code points (with an end mark) that sorts opposite to the text itself."""
    codes = F.transform(F.filter(F.split(text, ""), lambda x: x != ""), lambda x: -F.ascii(x))
    return F.concat(codes, F.array(F.lit(1)))


def priority_merge(sets: list[DataFrame], pos: str = "pos", ref: str = "ref") -> DataFrame:
    """Sets in order; a later set adds only sites sharing no base with anything kept so far.

    ``set_index`` (1-based) tells where a row came from.
    """
    def spans(d, i):
        return (d.withColumn("_s", F.col(pos)).withColumn("_e", F.col(pos) + F.length(ref))
                .withColumn("set_index", F.lit(i)))

    kept = spans(sets[0], 1)
    for i, nxt in enumerate(sets[1:], 2):
        fresh = interval_anti(spans(nxt, i), kept, ("_s", "_e"), ("_s", "_e"))
        kept = kept.unionByName(cut_lineage(fresh))
    return kept.drop("_s", "_e")


def flag_enveloped(sites: DataFrame, trs: DataFrame, pos="pos", ref="ref", tr_pos="pos", tr_ref="ref",
                   tr_id="id", tr_order="file_pos", key=("id",)) -> DataFrame:
    """Add ``tr_enveloped`` and ``trid``: the first repeat whose ``[pos, pos+len(ref)]`` contains the site's."""
    key = list(key)
    t = (trs.groupBy("chrom", F.col(tr_pos).alias("t_s"), (F.col(tr_pos) + F.length(tr_ref)).alias("t_e"))
         .agg(F.min(F.struct(F.col(tr_pos).alias("p"), F.col(tr_order).alias("o"), F.col(tr_id).alias("trid"))).alias("t_best"))
         .withColumn("t_stop", F.col("t_e") + 1))
    spans = sites.select("chrom", F.col(pos).alias("q_s"), (F.col(pos) + F.length(ref)).alias("q_e")).distinct()
    hit = point_in_interval(spans, t, "q_s", "t_s", "t_stop", ["chrom"]).filter("q_e <= t_e")
    best = hit.groupBy("chrom", "q_s", "q_e").agg(F.min("t_best").alias("_b"))
    x = sites.withColumn("q_s", F.col(pos)).withColumn("q_e", F.col(pos) + F.length(ref))
    x = x.join(best, ["chrom", "q_s", "q_e"], "left")
    return (x.withColumn("tr_enveloped", F.col("_b").isNotNull()).withColumn("trid", F.col("_b.trid"))
            .drop("q_s", "q_e", "_b"))


def match_tr_catalog(sites: DataFrame, catalog: DataFrame, min_reciprocal: float = 0.7, vid="id", iv=IV,
                     motifs="motifs") -> DataFrame:
    """Locus per repeat call: fully inside a locus, else reciprocal overlap with an equal motif.

    ``catalog(chrom, start, end, locus_id, motif)``; one locus per id (rule, then smallest locus id).
    """
    content = ["chrom", *iv, motifs]
    cat = catalog.groupBy("chrom", *IV, "motif").agg(F.min("locus_id").alias("locus_id"))
    m = interval_overlap(sites.select(*content).distinct(), cat, iv, IV, prefix="c_")
    alen, blen = F.col(iv[1]) - F.col(iv[0]), F.col("c_end") - F.col("c_start")
    inside = F.col("overlap") == alen
    near = (F.col("overlap") >= min_reciprocal * alen - 1e-9) & (F.col("overlap") >= min_reciprocal * blen - 1e-9)
    same = F.exists(F.split(motifs, ","), lambda x: F.upper(x) == F.upper(F.col("c_motif")))
    rule = F.when(inside, 1).when(near & same, 2)
    best = m.withColumn("_r", rule).filter("_r is not null").groupBy(*content).agg(
        F.min(F.struct("_r", F.col("c_locus_id").alias("locus_id"))).alias("_b"))
    hit = sites.select(*content, vid).join(best, content).groupBy(vid).agg(F.min("_b").alias("_b"))
    return hit.select(vid, F.col("_b.locus_id").alias("locus_id"), F.col("_b._r").alias("rule"))


def region_class(sites: DataFrame, features: DataFrame, iv=IV, kind="svtype", cnv_over: int = 5000,
                 priority=("SR", "SD", "RM"), otherwise: str = "US") -> DataFrame:
    """Genomic context of each site from ``features(chrom, start, end, cls)``.

    A breakpoint takes the first class of ``priority`` it lies in; the site takes
    the better of its two breakpoints. DEL/DUP longer than ``cnv_over`` are
    classed by the first class covering more than half of the body instead.
    """
    n = len(priority)
    f = features.filter(F.col("cls").isin(*priority)).withColumn(
        "_v", F.coalesce(*[F.when(F.col("cls") == k, F.lit(n - i)) for i, k in enumerate(priority)]))
    s, e = iv
    top = cut_lineage(stab_max(_both_ends(sites, F.col(s), F.col(e), ["chrom"]), f, "_p", "start", "end", "_v", ["chrom"]))
    lo = top.select("chrom", F.col("_p").alias("_pa"), F.col("top").alias("_l"))
    hi = top.select("chrom", F.col("_p").alias("_pb"), F.col("top").alias("_h"))
    # Body shares of all classes in one pass: each distinct large span is asked once per class.
    large = F.col(kind).isin("DEL", "DUP") & (F.col(e) - F.col(s) > cnv_over)
    bodies = sites.filter(large).select("chrom", s, e).distinct().withColumn("cls", F.explode(F.array(*[F.lit(k) for k in priority])))
    share = interval_coverage(bodies, f, iv, IV, ("chrom", "cls"), "_f").withColumn(
        "_v", F.coalesce(*[F.when(F.col("cls") == k, F.lit(n - i)) for i, k in enumerate(priority)]))
    share = share.groupBy("chrom", s, e).agg(F.max(F.when(F.col("_f") > 0.5, F.col("_v"))).alias("_body"))
    x = sites.withColumn("_pa", F.col(s).cast("bigint")).withColumn("_pb", F.col(e).cast("bigint"))
    x = x.join(lo, ["chrom", "_pa"], "left").join(hi, ["chrom", "_pb"], "left").join(share, ["chrom", s, e], "left")
    v = F.when(large, F.col("_body")).otherwise(F.greatest("_l", "_h"))
    label = F.coalesce(*[F.when(v == n - i, F.lit(k)) for i, k in enumerate(priority)], F.lit(otherwise))
    return x.withColumn("region", label).drop("_l", "_h", "_body", "_pa", "_pb")
