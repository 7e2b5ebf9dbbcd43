"""Matching call sets by place, size and sequence.

Copies are folded before anything is paired: each side is reduced to its distinct
contents, pairs are sought between contents, and results are handed back to the
rows by content. A third of all rows being one call therefore costs one content.
Nearest-call matches never build pairs at all; they look up the last call at or
before a position and the first one after it.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import genotype as g
from ..functions.alleles import c, overlap_bases, sequence_score, sequence_similar, size_similarity
from ..session import cut_lineage, kept
from .intervals import islands, overlap_count
from .positions import at_positions, overlap_pairs, point_in_interval, prefixed
from .transfer import append_truth_counts, exact_match, lookup, unify_annotation_tables


def contents(df: DataFrame, cols: list[str], vid: str = "id", largest: bool = False) -> DataFrame:
    """Distinct contents with the smallest (or largest) id of their copies."""
    return df.groupBy(*cols).agg((F.max if largest else F.min)(vid).alias(vid))


def _size_classes(q: DataFrame, r: DataFrame, q_len: str, r_len: str, sim: float):
    """Give both sides a length class; sizes within ``sim`` of each other differ by at most one class.

    The neighbours go on ``r``, whose rows are looked up, not on ``q``, whose windows are tiled.
    """
    step = math.log(1.0 / sim) + 1e-9

    def cls(x):
        return F.floor(F.log(F.abs(F.col(x)).cast("double")) / step).cast("int")

    qq = q.filter(F.abs(F.col(q_len)) > 0).withColumn("_cl", cls(q_len))
    near = F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: cls(r_len) + d)
    return qq, r.filter(F.abs(F.col(r_len)) > 0).withColumn("_cl", F.explode(near))


def near_pairs(q: DataFrame, r: DataFrame, window: Column | int, by=("chrom",), q_pos="start", r_pos="start",
               size_sim: float = 0.0, q_len="len", r_len="len", prefix="b_") -> DataFrame:
    """Pairs whose positions differ by at most ``window`` (``r`` columns get ``prefix``); with
    ``size_sim`` only lengths that similar are brought together."""
    by = list(by)
    if 0 < size_sim < 1:
        q, r = _size_classes(q, r, q_len, r_len, size_sim)
        by = [*by, "_cl"]
    rp = prefixed(r, prefix).withColumnsRenamed({prefix + x: x for x in by})
    if isinstance(window, Column):
        q = q.withColumns({"_lo": F.col(q_pos) - window, "_hi": F.col(q_pos) + window + 1})
        out = point_in_interval(rp, q, prefix + r_pos, "_lo", "_hi", by).drop("_lo", "_hi", "_cl")
    else:  # stretches as wide as the window: what is near lies in the same or a neighbouring one
        at = lambda x: F.floor(F.col(x) / F.lit(window + 1))
        q = q.withColumn("_at", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: at(q_pos) + d)))
        out = q.join(rp.withColumn("_at", at(prefix + r_pos)), [*by, "_at"]).filter(F.abs(F.col(q_pos) - F.col(prefix + r_pos)) <= window).drop("_at", "_cl")
    if size_sim > 0:
        out = out.filter(size_similarity(q_len, prefix + r_len) >= size_sim - 1e-9)
    return out


def sized_overlaps(a: DataFrame, b: DataFrame, sim: float, by=("chrom",), prefix: str = "b_") -> DataFrame:
    """``overlap_pairs`` of intervals whose lengths are within ``sim`` of each other, or a few more: the length class is part of
    the key, so a place full of long and short intervals doesn't pair them all."""
    if not 0 < sim < 0.99:
        return overlap_pairs(a, b, by=by, prefix=prefix)
    span = lambda d: d.withColumn("_span", F.col("end") - F.col("start"))
    q, r = _size_classes(span(a), span(b), "_span", "_span", sim)
    return overlap_pairs(q.drop("_span"), r.drop("_span"), by=[*by, "_cl"], prefix=prefix).drop("_cl")


def windowed_match(q: DataFrame, r: DataFrame, window: int, size_sim: float, carry=(), vid="id") -> DataFrame:
    """Nearest same-type call within ``window`` and ``size_sim`` per query (ties: smallest id).

    Types come from ``allele_type`` (DEL or INS), lengths from ``allele_length``.
    """
    def shape(d):
        t = F.lower("allele_type")
        kind = F.when(t.contains("del"), "DEL").when(t.contains("ins") | t.contains("dup"), "INS")
        return d.withColumns({"_k": kind, "_l": F.abs("allele_length"), "_p": F.col("pos")}).filter("_k is not null")

    cols = ["chrom", "_k", "_p", "_l"]
    qs = shape(q)
    rc = contents(shape(r), [*cols, *carry], vid)
    p = near_pairs(qs.select(*cols).distinct(), rc, window, ("chrom", "_k"), "_p", "_p", size_sim, "_l", "_l")
    best = p.groupBy(*cols).agg(F.min(F.struct(F.abs(F.col("b__p") - F.col("_p")).alias("d"), F.col("b_" + vid), *[F.col("b_" + x) for x in carry])).alias("_b"))
    out = qs.join(best, cols).withColumn("b_" + vid, F.col("_b.b_" + vid))
    for x in carry:
        out = out.withColumn("b_" + x, F.col("_b.b_" + x))
    return out.drop("_b", "_k", "_l", "_p")


# ------------------------------------------------------------------ catalog matches

def me_kind(designation) -> Column:
    d = c(designation)
    return (F.when(d.startswith("SINE") | d.startswith("Alu"), "ALU").when(d.startswith("LINE") | d.startswith("L1"), "LINE")
            .when(d.startswith("Retroposon") | d.startswith("SVA"), "SVA"))


def med_match(dels: DataFrame, catalog: DataFrame, window: int = 500, reciprocal: float = 0.0, seq_sim: float = 0.7,
              size_sim: float = 0.7) -> DataFrame:
    """Deletions (``id, chrom, start, end, ref``) against a mobile-element catalog
    (``chrom, start, end, seq, designation, sub_family``): the first passing element per id.

    Overlap is relative to the shorter span; the REF without its anchor base is compared with
    the element's sequence, symbolic REFs are not; breakpoint distances are summed.
    """
    cat = catalog.withColumn("kind", me_kind("designation")).filter("kind is not null").groupBy("chrom", "start", "end", "seq", "kind").agg(F.min("sub_family").alias("sub_family"))
    q = dels.select("chrom", "start", "end", "ref").distinct()
    p = sized_overlaps(q, cat, size_sim)
    ld, lm = F.col("end") - F.col("start"), F.col("b_end") - F.col("b_start")
    ov = overlap_bases("start", "end", "b_start", "b_end")
    seq = F.substr("ref", F.lit(2))
    p = p.filter((size_similarity(ld, lm) >= size_sim - 1e-9) & (ov >= reciprocal * F.greatest(ld, lm)) & (ov >= reciprocal * F.least(ld, lm))
                 & (F.abs(F.col("start") - F.col("b_start")) + F.abs(F.col("end") - F.col("b_end")) <= window))
    p = p.filter((F.length(seq) == 0) | (F.length("b_seq") == 0) | sequence_similar(seq, "b_seq", seq_sim))
    best = p.groupBy("chrom", "start", "end", "ref").agg(F.min(F.struct("b_start", "b_end", "b_kind", "b_sub_family")).alias("_b"))
    return dels.join(best, ["chrom", "start", "end", "ref"]).withColumns(
        {"me_type": F.col("_b.b_kind"), "sub_family": F.col("_b.b_sub_family")}).drop("_b")


def palmer_match(targets: DataFrame, target_carriers: DataFrame, meis: DataFrame, mei_carriers: DataFrame, repeats: DataFrame,
                 buffer: int = 50, window: int = 200, reciprocal: float = 0.9, seq_sim: float = 0.9, size_sim: float = 0.9,
                 min_shared: int = 0) -> DataFrame:
    """Insertions annotated from element calls of one type.

    ``repeats(chrom, pos, length)`` are the repeat-masked insertion sites; merged after widening,
    they select the element calls that may be used (``meis``: id, chrom, pos, length, alt). An
    insertion (id, chrom, pos, allele_length, ref, alt, sv_length) must be ``sv_length - 1`` long
    and match an element call in sequence, size, reciprocal overlap, distance and shared carriers.
    """
    near = repeats.select("chrom", F.greatest(F.col("pos") - 1 - buffer, F.lit(0)).alias("start"), (F.col("pos") + buffer).alias("end"))
    m = meis.withColumns({"start": F.col("pos") - 1, "end": F.col("pos"), "len": F.abs("length")})
    m = overlap_count(m, islands(near), out="_n").filter("_n > 0").select("chrom", F.col("pos").alias("start"), "len", F.upper("alt").alias("seq"), "id")
    t = targets.filter((F.col("allele_type") == "ins") & (F.abs("allele_length") == F.abs("sv_length") - 1)).withColumns({
        "start": F.col("pos"), "len": F.abs("sv_length"), "seq": F.upper("alt")})
    cols = ["chrom", "start", "len", "seq"]
    keep_ids = min_shared > 0
    qc = t.select(*cols, "id") if keep_ids else t.select(*cols).distinct()
    rc = m if keep_ids else contents(m, cols)
    p = near_pairs(qc, rc, window, size_sim=size_sim)
    ov = F.least(F.col("start") + F.col("len"), F.col("b_start") + F.col("b_len")) - F.greatest("start", "b_start")
    p = p.filter((ov >= reciprocal * F.greatest("len", "b_len") - 1e-9) & sequence_similar("seq", "b_seq", seq_sim))
    if not keep_ids:
        best = p.groupBy(*cols).agg(F.min("b_id").alias("mei_id"))
        return t.join(best, cols).select("id", "mei_id")
    a = target_carriers.select("id", "sample").distinct()
    b = mei_carriers.select(F.col("id").alias("b_id"), "sample").distinct()
    pairs = p.select("id", "b_id").distinct()
    shared = pairs.join(a, "id").join(b, ["b_id", "sample"]).groupBy("id", "b_id").agg(F.count("*").alias("_n"))
    return shared.filter(F.col("_n") >= min_shared).groupBy("id").agg(F.min("b_id").alias("mei_id"))


def transferable_carriers(calls: DataFrame, vid="id") -> DataFrame:
    """Carriers as the element matcher counts them: any allele other than 0, missing included."""
    odd = F.exists("gt", lambda a: F.coalesce(a != 0, F.lit(True)))
    return calls.filter(F.coalesce(odd, F.lit(False))).select(vid, "sample")


# Size similarity, overlap share of the shorter, summed breakpoint distance.
DBVAR_LIMITS = {"DEL": (0.7, 0.7, 500), "DUP": (0.7, 0.7, 500), "INS": (0.5, 0.0, 200)}


def _breakpoint_best(q: DataFrame, r: DataFrame, limits: tuple[float, float, int]) -> DataFrame:
    """Best r per query content by summed breakpoint distance, then start, then id."""
    sim, share, win = limits
    cols = ["chrom", "start", "end", "len"]
    p = near_pairs(q.select(*cols).distinct(), contents(r, cols), win, size_sim=sim)
    dist = F.abs(F.col("start") - F.col("b_start")) + F.abs(F.col("end") - F.col("b_end"))
    ov = overlap_bases("start", "end", "b_start", "b_end")
    p = p.withColumn("_d", dist).filter((F.col("_d") <= win) & (ov >= share * F.least("len", "b_len") - 1e-9))
    best = p.groupBy(*cols).agg(F.min(F.struct("_d", "b_start", "b_id")).alias("_b"))
    return q.join(best, cols).select("id", F.col("_b.b_id").alias("match_id"), F.col("_b._d").alias("distance"))


def dbvar_match(q: DataFrame, r: DataFrame, limits: dict = DBVAR_LIMITS) -> DataFrame:
    """Closest database SV per query (``id, chrom, start, end, len, svtype``), by type-wise limits.

    CNV entries serve DEL and DUP. A DUP without a match may match an INS at ``original_pos``.
    """
    parts = []
    for kind, allowed in (("DEL", ("DEL", "CNV")), ("DUP", ("DUP", "CNV")), ("INS", ("INS",))):
        ok = reduce(lambda a, b: a | b, [F.col("svtype").contains(x) for x in allowed])
        parts.append(_breakpoint_best(q.filter(F.col("svtype") == kind), r.filter(ok), limits[kind]))
    first = cut_lineage(reduce(DataFrame.unionByName, parts))
    if "original_pos" not in q.columns:
        return first
    rest = q.filter("svtype = 'DUP' and original_pos is not null").join(first.select("id"), "id", "left_anti")
    rest = rest.withColumns({"start": F.col("original_pos") - 1, "end": F.col("original_pos")})
    if "original_chrom" in q.columns:
        rest = rest.withColumn("chrom", F.coalesce("original_chrom", "chrom"))
    return first.unionByName(_breakpoint_best(rest, r.filter("svtype = 'INS'"), limits["INS"]))


# ------------------------------------------------------------------ nearest-call matches

def sv_closest_ranged(q: DataFrame, r: DataFrame, min_overlap: float = 0.5, by=("chrom",)) -> DataFrame:
    """Per query the truth row with the largest overlap / longer length, if above ``min_overlap``
    (ties: highest start, then id). Columns: id, start, end, len and those of ``by``."""
    cols = [*by, "start", "end", "len"]
    p = overlap_pairs(q.select(*cols).distinct(), contents(r, cols, largest=True), by=by)
    share = overlap_bases("start", "end", "b_start", "b_end") / F.greatest(F.abs("len"), F.abs("b_len"))
    best = p.withColumn("_o", share).filter(F.col("_o") > min_overlap).groupBy(*cols).agg(F.max(F.struct("_o", "b_start", "b_id")).alias("_b"))
    return q.join(best, cols).select("id", F.col("_b.b_id").alias("truth_id"))


def nearest_points(q: DataFrame, r: DataFrame, by: list[str], cols: list[str], vid="id", right_wins: bool = True) -> DataFrame:
    """For each distinct query position: the nearest truth position's row (``b_*``) and ``distance``.

    ``r`` keeps one row per position (largest id). No pairs are built.
    """
    item = F.max(F.struct(vid, *cols)).alias("_row")
    spots = r.groupBy(*by, "start").agg(item)
    ev = spots.select(*by, F.col("start").alias("_p"), F.struct(F.col("start").alias("s"), "_row").alias("_e"))
    pts = q.select(*by, F.col("start").alias("_p")).distinct()
    left = at_positions(pts, ev, "_p", by, maxes=["_e"]).withColumnRenamed("run__e", "_l")
    right = at_positions(pts, ev, "_p", by, mins=["_e"], reverse=True).withColumnRenamed("run__e", "_r")
    x = left.join(right, [*by, "_p"])
    dl, dr = F.col("_p") - F.col("_l.s"), F.col("_r.s") - F.col("_p")
    take_right = F.coalesce(dr <= dl if right_wins else dr < dl, F.col("_l").isNull())
    x = x.withColumns({"_c": F.when(take_right, F.col("_r")).otherwise(F.col("_l"))}).filter("_c is not null")
    return x.select(*by, F.col("_p").alias("start"), F.abs(F.col("_c.s") - F.col("_p")).alias("distance"),
                    F.col(f"_c._row.{vid}").alias(f"b_{vid}"), F.col("_c.s").alias("b_start"), *[F.col(f"_c._row.{x}").alias(f"b_{x}") for x in cols])


def sv_closest_point(q: DataFrame, r: DataFrame, max_distance: int = 100, ratio: float = 10.0, by=("chrom",)) -> DataFrame:
    """Nearest start per query, kept when closer than ``max_distance`` with a length ratio inside
    (1/ratio, ratio). The limits are tested after the nearest is chosen."""
    by = list(by)
    n = nearest_points(q, r, by, ["len"])
    x = q.join(n, [*by, "start"])
    k = F.abs("b_len") / F.abs("len")
    return x.filter((F.col("distance") < max_distance) & (k < ratio) & (k > 1.0 / ratio)).select("id", F.col("b_id").alias("truth_id"))


# Element types that count as insertions.
ELEMENTS = ["ALU", "LINE1", "SVA", "HERVK"]


def type_family(svtype="svtype") -> Column:
    """INS for ``INS`` with any subtype and for mobile elements, INV for INV/CPX, BND for BND/CTX, else the type itself."""
    t = c(svtype)
    return (F.when(t.startswith("INS") | t.isin(ELEMENTS), "INS").when(t.isin("INV", "CPX"), "INV").when(t.isin("BND", "CTX"), "BND").otherwise(t))


def sv_closest_match(q: DataFrame, r: DataFrame, extra_types=()) -> DataFrame:
    """Families of types (``type_family``): DEL and DUP by overlap, INS by place; then INS against DUP and DUP against INS as
    points for ids without a match. Carries the truth FILTER when ``r`` has one. ``extra_types`` (INV, BND)
    are matched by overlap or place on their own. All types of a kind are matched in one pass, the family being part of the key."""
    by = ("chrom", "_ty")
    cols = ["id", "chrom", "start", "end", "len"]
    # Both sides are read by several matchers.
    q, r0 = (cut_lineage(d.select(*cols, type_family().alias("_ty"))) for d in (q, r))
    ranged = ["DEL", "DUP", *[t for t in extra_types if t != "BND"]]
    points = ["INS", *[t for t in extra_types if t == "BND"]]
    of = lambda d, types: d.filter(F.col("_ty").isin(types))
    done = cut_lineage(sv_closest_ranged(of(q, ranged), of(r0, ranged), by=by).unionByName(sv_closest_point(of(q, points), of(r0, points), by=by)))
    left = of(q, ["INS", "DUP"]).join(done.select("id"), "id", "left_anti")
    other = left.withColumn("_ty", F.when(F.col("_ty") == "INS", "DUP").otherwise("INS"))
    out = done.unionByName(sv_closest_point(other, of(r0, ["INS", "DUP"]), by=by))
    if "filter" in r.columns:
        out = out.join(lookup(r.withColumnsRenamed({"id": "truth_id", "filter": "truth_filter"}), ["truth_id"], ["truth_filter"]), "truth_id", "left")
    return out


def external_af_match(q: DataFrame, truth_sets: dict[str, DataFrame], af_columns: list[str]) -> DataFrame:
    """For each truth set: closest match (DEL, DUP, INS, INV, BND) and its AF columns, prefixed by the set's name."""
    out = q.select("id")
    for name, r in truth_sets.items():
        m = sv_closest_match(q, r.drop("filter"), ("INV", "BND"))
        af = lookup(r.withColumnRenamed("id", "truth_id"), ["truth_id"], af_columns)
        m = m.join(af, "truth_id").select("id", F.col("truth_id").alias(f"{name}_id"), *[F.col(a).alias(f"{name}_{a}") for a in af_columns])
        out = out.join(m, "id", "left")
    return out


# ------------------------------------------------------------------ similarity matches

SEQ = ["chrom", "start", "len", "kind", "seq"]


def similar_pairs(q: DataFrame, r: DataFrame, seq_sim: float, size_sim: float, window: int, first: Column | None = None) -> DataFrame:
    """Pairs of contents of one kind with similar place, size and sequence; ``score`` is the
    sequence similarity. Only pairs that satisfy ``first`` are compared by sequence."""
    p = near_pairs(q, r, window, ("chrom", "kind"), size_sim=size_sim)
    if first is not None:
        p = p.filter(first)
    return p.withColumn("score", sequence_score("seq", "b_seq", seq_sim)).filter("score IS NOT NULL")


def similarity_match(q: DataFrame, r: DataFrame, rounds=(0.9, 0.7, 0.5), window: int = 500, size_sim: float = 0.7) -> DataFrame:
    """(id, truth_id, match_type): mutual best pairs of contents, at falling sequence thresholds on what is left.

    The size limit stays. Rows: id, chrom, start, len, kind, seq. Copies share their content's partner.
    """
    qc, rc = cut_lineage(contents(q, SEQ)), cut_lineage(contents(r, SEQ))
    found = None
    for t in rounds:
        p = cut_lineage(similar_pairs(qc, rc, t, size_sim, window).select("id", "b_id", "score", F.abs(F.col("start") - F.col("b_start")).alias("_d")))
        order = F.struct(-F.col("score"), "_d")
        bq = p.groupBy("id").agg(F.min(F.struct(order.alias("o"), "b_id")).alias("_x")).select("id", F.col("_x.b_id").alias("b_id"))
        br = p.groupBy("b_id").agg(F.min(F.struct(order.alias("o"), "id")).alias("_x")).select("b_id", F.col("_x.id").alias("id"))
        m = cut_lineage(bq.join(br, ["id", "b_id"]).withColumn("match_type", F.lit(f"SIMILAR_{t}")))
        found = m if found is None else found.unionByName(m)
        qc, rc = qc.join(m.select("id"), "id", "left_anti"), rc.join(m.select("b_id"), rc["id"] == F.col("b_id"), "left_anti")
    content_id = contents(q, SEQ).withColumnRenamed("id", "_cid")
    return (q.join(content_id, SEQ).join(found.withColumnRenamed("id", "_cid"), "_cid")
            .select("id", F.col("b_id").alias("truth_id"), "match_type"))


def callset_overlap(evals: DataFrame, truth: DataFrame, truth_sv: DataFrame, min_length: int = 10, sv_length: int = 50) -> DataFrame:
    """Exact, then similarity, then closest matching, each on the rest; unified output with truth counts.

    Sites: id, chrom, pos, ref, alt, allele_type, allele_length, filters; truth sets also carry
    AC/AF/AN columns and genotype counts.
    """
    k = ["chrom", "pos", "ref", "alt"]
    exact, rest = exact_match(evals, truth, "truth")
    rest = cut_lineage(rest)

    def shape(d):
        t = F.upper("allele_type")
        kind = F.when(t.contains("DEL"), "DEL").when(t.contains("DUP"), "DUP").otherwise("INS")
        seq = F.when(F.length("alt") >= F.length("ref"), F.col("alt")).otherwise(F.col("ref"))
        n = F.abs("allele_length")
        return d.withColumns({"svtype": kind, "kind": kind, "seq": seq, "start": F.col("pos"), "len": n,
                              "end": F.col("pos") + F.when(kind == "INS", F.lit(1)).otherwise(n)})

    long = shape(rest.filter(F.abs("allele_length") >= min_length))
    sim = cut_lineage(similarity_match(long.select("id", *SEQ), shape(truth.filter(F.abs("allele_length") >= min_length)).select("id", *SEQ)))
    left = long.filter(F.col("len") >= sv_length).join(sim.select("id"), "id", "left_anti")
    cols = ["id", "chrom", "start", "end", "len", "svtype"]
    closest = sv_closest_match(left.select(*cols), shape(truth_sv).select(*cols))
    base = evals.select("id", *k)
    parts = [append_truth_counts(exact.select("id", *k, "truth_id", "match_type"), truth),
             append_truth_counts(sim.join(base, "id"), truth),
             append_truth_counts(closest.withColumn("match_type", F.lit("CLOSEST")).join(base, "id"), truth_sv, sv=True)]
    return unify_annotation_tables(parts)


def agglomerate(callsets: list[DataFrame], min_overlap: float = 0.5, min_size: float = 0.5, max_offset: int | None = None,
                match_ref: bool = False, match_alt: bool = False) -> DataFrame:
    """Cumulative union: rows of the next set without a pairwise match to anything gathered so far.

    A match overlaps reciprocally by ``min_overlap``, has similar size and (optionally) a small
    start offset and equal alleles. Rows: id, chrom, start, end, len, kind, ref, alt.
    """
    cols = ["chrom", "kind", "start", "end", "len", "ref", "alt"]
    total = callsets[0].withColumn("set_index", F.lit(1))
    for i, nxt in enumerate(callsets[1:], 2):
        by = ["chrom", "kind", *(["ref"] if match_ref else []), *(["alt"] if match_alt else [])]
        keep = [x for x in cols if x in by or x in ("start", "end", "len")]
        p = sized_overlaps(nxt.select(*keep).distinct(), total.select(*keep).distinct(), min_overlap, by)  # the overlap bounds the ratio of lengths, too
        la, lb = F.col("end") - F.col("start"), F.col("b_end") - F.col("b_start")
        ok = (overlap_bases("start", "end", "b_start", "b_end") >= min_overlap * F.greatest(la, lb) - 1e-9) & (size_similarity("len", "b_len") >= min_size - 1e-9)
        if max_offset is not None:
            ok = ok & (F.abs(F.col("start") - F.col("b_start")) <= max_offset)
        hit = p.filter(ok).select(*keep).distinct()
        total = cut_lineage(total.unionByName(nxt.join(hit, keep, "left_anti").withColumn("set_index", F.lit(i))))
    return total


# ------------------------------------------------------------------ callers

def caller_counts(variants: DataFrame, edges=(50, 100, 500, 5000)) -> DataFrame:
    """Variants per type x length bucket x caller (``supp`` is a comma list)."""
    from .counting import size_bucket

    return (variants.withColumn("caller", F.explode(F.transform(F.split("supp", ","), lambda x: F.trim(x)))).withColumn("bucket", size_bucket("svlen", edges))
            .groupBy("svtype", "bucket", "caller").agg(F.count("*").alias("n")))


def best_caller(variants: DataFrame, support: DataFrame, edges=(50, 100, 500, 5000)) -> DataFrame:
    """AD, PL and GQ of each variant from its highest-ranked supporting caller with depths.

    Callers are ranked by how many variants of the same type and length bucket they support (ties by name).
    """
    from .counting import size_bucket

    counts = caller_counts(variants, edges)
    s = variants.withColumn("bucket", size_bucket("svlen", edges)).select("id", "svtype", "bucket").join(
        support.filter("ref_depth is not null and alt_depth is not null"), "id").join(counts, ["svtype", "bucket", "caller"], "left")
    order = F.struct((-F.coalesce("n", F.lit(0))).alias("n"), "caller")
    b = s.groupBy("id").agg(F.min_by(F.struct("caller", "ref_depth", "alt_depth"), order).alias("_b"), F.array_sort(F.collect_set("caller")).alias("ev"))
    pl = g.pl_from_ad(F.col("_b.ref_depth"), F.col("_b.alt_depth"), (0.03, 0.5, 0.97), (0.33, 0.34, 0.33))
    out = variants.select("id").join(b, "id", "left").withColumn("pl", F.when(F.col("_b").isNotNull(), pl))
    return out.select("id", F.col("_b.caller").alias("bev"), "ev", F.array("_b.ref_depth", "_b.alt_depth").alias("ad"), "pl",
                      g.gq_from_pl("pl").alias("gq"), F.when(F.col("_b").isNull(), "NO_AD").otherwise("FILLED").alias("status"))



# ------------------------------------------------------------------ gene effects

def predicted_effects(svs: DataFrame, genes: DataFrame, exons: DataFrame, promoters: DataFrame, utrs: DataFrame,
                      noncoding: DataFrame | None = None) -> DataFrame:
    """Gene (or element) lists per SV and effect (long: id, effect, genes) by the documented meanings.

    SVs: id, chrom, start, end, svtype (CNV: multi-allelic). Genes: gene, chrom, start, end, tss; parts and
    ``noncoding`` elements: gene, chrom, start, end. INS are taken as the base they follow. An SV that meets
    nothing is PREDICTED_INTERGENIC with an empty list.
    """
    s = svs.select("id", "chrom", "svtype", "start", F.greatest("end", F.col("start") + 1).alias("end"))
    # The SVs are dealt evenly first: a table of few row groups would be cut into blocks by as few tasks.
    s, genes = cut_lineage(s.hint("rebalance")), cut_lineage(genes)
    # All features are looked up in one pass, so an SV's blocks are made and dealt once, not once for each kind.
    no_tss = F.lit(None).cast(dict(genes.dtypes)["tss"])
    kinds = {"gene": genes, "exon": exons, "promoter": promoters, "utr": utrs} | ({} if noncoding is None else {"element": noncoding})
    features = [d.select("gene", "chrom", "start", "end", (F.col("tss") if k == "gene" else no_tss).alias("tss"), F.lit(k).alias("feature")) for k, d in kinds.items()]
    met = kept(overlap_pairs(s, reduce(DataFrame.unionByName, features)), "features")
    meets = lambda k: met.filter(F.col("b_feature") == k)
    gene = meets("gene")
    inside = (F.col("b_start") <= F.col("start")) & (F.col("end") <= F.col("b_end"))
    spans = (F.col("start") <= F.col("b_start")) & (F.col("b_end") <= F.col("end"))
    tss = (F.col("b_tss") >= F.col("start")) & (F.col("b_tss") < F.col("end"))
    ex = meets("exon")
    whole = (F.col("start") <= F.col("b_start")) & (F.col("b_end") <= F.col("end"))
    exon = ex.groupBy("id", F.col("b_gene").alias("gene")).agg(F.bool_or(whole).alias("exon_whole"), F.bool_or(inside).alias("in_exon"), F.lit(True).alias("exonic"))
    x = gene.select("id", "svtype", F.col("b_gene").alias("gene"), inside.alias("inside"), spans.alias("spans"), tss.alias("tss")).join(exon, ["id", "gene"], "left")
    t = F.col("svtype")
    hit = F.coalesce("exonic", F.lit(False))
    eff = (F.when((t == "CNV") & hit, "PREDICTED_MSV_EXON_OVR").when((t == "DUP") & F.col("spans"), "PREDICTED_COPY_GAIN").when((t == "INV") & F.col("spans"), "PREDICTED_INV_SPAN")
           .when((t == "DUP") & F.col("inside") & F.col("exon_whole"), "PREDICTED_INTRAGENIC_EXON_DUP")
           .when((t == "DUP") & F.col("inside") & F.col("in_exon"), "PREDICTED_PARTIAL_EXON_DUP")
           .when((t == "DUP") & ~F.col("inside") & F.col("tss"), "PREDICTED_TSS_DUP").when((t == "DUP") & ~F.col("inside"), "PREDICTED_DUP_PARTIAL")
           .when(t.isin("DEL", "INS", "INV") & hit, "PREDICTED_LOF"))
    u = meets("utr").select("id", F.col("b_gene").alias("gene")).distinct().withColumn("_u", F.lit(True))
    x = x.join(u, ["id", "gene"], "left").withColumn("effect", F.coalesce(eff, F.when(F.col("_u"), F.lit("PREDICTED_UTR")), F.lit("PREDICTED_INTRONIC")))
    x = cut_lineage(x.select("id", "gene", "effect"))
    pr = meets("promoter").select("id", F.col("b_gene").alias("gene"), F.lit("PREDICTED_PROMOTER").alias("effect")).distinct()
    pr = pr.join(x.select("id", "gene"), ["id", "gene"], "left_anti")
    found = cut_lineage(x.unionByName(pr))
    free = s.join(found.select("id").distinct(), "id", "left_anti")
    near = nearest_points(free, genes.select("chrom", F.col("tss").alias("start"), F.col("gene").alias("id")), ["chrom"], [])
    tail = free.join(near, ["chrom", "start"]).select("id", F.col("b_id").alias("gene"), F.lit("PREDICTED_NEAREST_TSS").alias("effect"))
    parts, alone = found.unionByName(tail), free.select("id")
    if noncoding is not None:
        el = meets("element")
        el = el.select("id", F.col("b_gene").alias("gene"), F.when(whole, "PREDICTED_NONCODING_SPAN").otherwise("PREDICTED_NONCODING_BREAKPOINT").alias("effect"))
        parts, alone = parts.unionByName(el), alone.join(el.select("id").distinct(), "id", "left_anti")
    parts = parts.unionByName(alone.select("id", F.lit(None).cast("string").alias("gene"), F.lit("PREDICTED_INTERGENIC").alias("effect")))
    return parts.groupBy("id", "effect").agg(F.array_sort(F.collect_set("gene")).alias("genes"))


def collapse_doubled_dups(svs: DataFrame, effects: list[str]) -> DataFrame:
    """Where INS and DUP rows share (chrom, pos, svlen): INS rows keep the union of both kinds' gene
    lists and the DUP rows go. Rows without such a partner stay as they are."""
    k = ["chrom", "pos", "svlen"]
    pair = svs.filter(F.col("svtype").isin("INS", "DUP"))
    agg = pair.groupBy(*k).agg(F.count_if(F.col("svtype") == "INS").alias("_i"), F.count_if(F.col("svtype") == "DUP").alias("_d"),
                               *[F.array_sort(F.array_distinct(F.flatten(F.collect_set(e)))).alias(f"_{e}") for e in effects])
    x = svs.join(agg.filter("_i > 0 and _d > 0"), k, "left")
    both = F.col("_i").isNotNull()
    x = x.filter(~(both & (F.col("svtype") == "DUP")))
    ins = both & (F.col("svtype") == "INS")
    return x.withColumns({e: F.when(ins, F.col(f"_{e}")).otherwise(F.col(e)) for e in effects}).drop("_i", "_d", *[f"_{e}" for e in effects])
