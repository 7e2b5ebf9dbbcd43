"""Calls supported by a truth set: sites matched by allele or by place, overlap and size, calls by sample.

Deletions and insertions from a least length on match a truth site of their kind by ``Limits``; everything else matches by
(chrom, pos, ref, alt) in upper case. Sites are matched once as contents, whatever number of samples carries them; candidate pairs
share a length class and a stretch of positions as wide as the breakpoint window. A call is supported if its own sample carries a matching truth site.

Sites: id, chrom, pos, ref, alt, allele_type, allele_length (one row an ALT), and ``end`` (last base) if it isn't that of REF. Calls: id, sample, gt, gq.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import genotype as g
from ..functions.alleles import overlap_bases
from ..session import cut_lineage, kept
from .counting import PLOT_EDGES, caller_gqs, size_column
from .matching import near_pairs


@dataclass(frozen=True)
class Limits:
    """Least size similarity, least overlap as a share of the shorter length, breakpoint window, and which breakpoints it bounds:
    ``any`` of the two, the ``start``, or their ``sum``."""

    size_sim: float
    share: float
    window: int
    bounds: str


# Limits of support for quality cutoffs, and of matches for quality tables.
CUTOFF_LIMITS = {"DEL": Limits(0.8, 0.8, 500, "any"), "INS": Limits(0.8, 0.0, 100, "start")}
TABLE_LIMITS = {"DEL": Limits(0.7, 0.7, 500, "sum"), "INS": Limits(0.5, 0.0, 200, "sum")}


def kind_of(allele_type="allele_type") -> Column:
    """INS, DEL, TRV or SNV by the words in an allele type; duplications are SNV here, as they match by allele."""
    t = F.lower(F.coalesce(F.col(allele_type), F.lit("")))
    return F.when(t.contains("ins"), "INS").when(t.contains("del"), "DEL").when(t.contains("trv"), "TRV").otherwise("SNV")


def shaped(sites: DataFrame, least: int) -> DataFrame:
    """With ``_kind``, ``_len``, ``_start`` and ``_end`` (half-open), and ``_long``: is it matched by place?"""
    n = F.abs(F.coalesce(F.col("allele_length"), F.lit(0)))
    start = F.col("pos") - 1
    end = start + F.length("ref") if "end" not in sites.columns else F.coalesce("end", start + F.length("ref"))
    return sites.withColumns({"_kind": kind_of(), "_len": n, "_start": start, "_end": end}).withColumn("_long", F.col("_kind").isin("DEL", "INS") & (F.col("_len") >= least))


def kept_sites(sites: DataFrame) -> DataFrame:
    """The columns used here, written once: the matches read their sites once for each kind and side."""
    return kept(sites.select(*[x for x in ("id", "chrom", "pos", "ref", "alt", "allele_type", "allele_length", "end", "tr_enveloped") if x in sites.columns]), "sites")


def matched_sites(evals: DataFrame, truth: DataFrame, limits: dict[str, Limits], least: int, exact_any: bool = False) -> DataFrame:
    """Distinct (id, truth_id). Long truth sites serve no exact match and short ones no match by place, unless ``exact_any``."""
    e, t = shaped(evals, least), shaped(truth, least)
    key = ["chrom", "pos", F.upper("ref").alias("ref"), F.upper("alt").alias("alt")]
    small = t if exact_any else t.filter(~F.col("_long"))
    exact = e.filter(~F.col("_long")).select("id", *key).join(small.select(F.col("id").alias("truth_id"), *key), ["chrom", "pos", "ref", "alt"]).select("id", "truth_id")
    cols = ["chrom", "_kind", "_start", "_end", "_len"]
    out = exact
    for kind, lim in limits.items():
        one, two = (d.filter((F.lit(True) if wide else F.col("_long")) & (F.col("_kind") == kind)) for d, wide in ((e, False), (t, exact_any)))
        one, two = one.filter("_len > 0"), two.filter("_len > 0")
        q, r = one.select(*cols).distinct(), two.select(*cols).distinct()
        near = lambda at: near_pairs(q, r, lim.window, ("chrom", "_kind"), at, at, lim.size_sim, "_len", "_len")
        p = near("_start")
        if lim.bounds == "any":
            p = p.unionByName(near("_end")).distinct()
        if lim.bounds == "sum":
            p = p.filter(F.abs(F.col("_start") - F.col("b__start")) + F.abs(F.col("_end") - F.col("b__end")) <= lim.window)
        if lim.share > 0:
            p = p.filter(overlap_bases("_start", "_end", "b__start", "b__end") / F.least("_len", "b__len") >= lim.share - 1e-9)
        back = r.select(*[F.col(x).alias(x if x in ("chrom", "_kind") else "b_" + x) for x in cols])
        ids = two.select("id", *cols).withColumnsRenamed({"id": "truth_id", **{x: "b_" + x for x in cols if x not in ("chrom", "_kind")}})
        out = out.unionByName(one.select("id", *cols).join(p, cols).join(ids, back.columns).select("id", "truth_id"))
    return out.distinct()


def carriers(calls: DataFrame) -> DataFrame:
    return calls.filter(g.is_carrier("gt")).select("id", "sample").distinct()


def supported(pairs: DataFrame, calls: DataFrame, truth_calls: DataFrame) -> DataFrame:
    """Distinct (id, sample) of carriers whose own sample carries a matching truth site."""
    t = carriers(truth_calls).withColumnRenamed("id", "truth_id")
    return carriers(calls).join(pairs, "id").join(t, ["truth_id", "sample"], "left_semi").select("id", "sample").distinct()


def truth_gq_table(sites: DataFrame, calls: DataFrame, truth: DataFrame, truth_calls: DataFrame, limits: dict[str, Limits] = TABLE_LIMITS, least: int = 20, edges=PLOT_EDGES,
                   skip_trv: bool = True, expand_regenotyper: bool = False) -> DataFrame:
    """Per bucket, caller, GQ and TR status: variants, matched variants, and the calls of matched variants, concordant (the
    sample carries a matching truth site) or not. Calls also have ``ev`` and ``bev`` (see ``caller_gqs``), sites ``tr_enveloped``.

    Only samples that both sets have count, and of them carriers. A variant matches if any sample could have carried it.
    """
    who = kept(calls.select("sample").distinct().join(truth_calls.select("sample").distinct(), "sample"), "samples")
    calls = calls.filter(g.is_carrier("gt")).join(who, "sample")
    s, truth = kept_sites(sites.filter(kind_of() != "TRV") if skip_trv else sites), kept_sites(truth)
    pairs = cut_lineage(matched_sites(s, truth, limits, least, exact_any=True))
    hit = pairs.select("id").distinct().withColumn("_m", F.lit(True))
    same = supported(pairs, calls, truth_calls).withColumn("_c", F.lit(True))
    site = s.select("id", size_column(edges).alias("bucket"), F.coalesce("tr_enveloped", F.lit(False)).alias("tr")).distinct()
    x = calls.withColumn("_g", F.explode(caller_gqs(expand_regenotyper=expand_regenotyper))).select("id", "sample", F.col("_g.caller").alias("caller"), F.col("_g.gq").alias("gq"))
    x = x.join(site, "id").join(hit, "id", "left").join(same, ["id", "sample"], "left")
    per = x.groupBy("bucket", "caller", "gq", "tr", "id").agg(F.max("_m").alias("_m"), F.count("*").alias("_n"), F.count("_c").alias("_k"))  # variants are told apart before they are counted
    m = F.col("_m").isNotNull()
    return per.groupBy("bucket", "caller", "gq", "tr").agg(
        F.count("*").alias("variants"), F.count_if(m).alias("matched"), F.sum(F.when(m, F.col("_n")).otherwise(0)).alias("calls_matched"),
        F.sum(F.when(m, F.col("_k")).otherwise(0)).alias("concordant"), F.sum(F.when(m, F.col("_n") - F.col("_k")).otherwise(0)).alias("discordant"))


def gq_cutoff_table(sites: DataFrame, calls: DataFrame, trios: DataFrame, truth: DataFrame, truth_calls: DataFrame, limits: dict[str, Limits] = CUTOFF_LIMITS, least: int = 20, edges=PLOT_EDGES,
                    skip_trv: bool = True) -> DataFrame:
    """Per kind, size and GQ of the children's carried calls: calls, truth-supported calls, de novo calls (both parents called reference), the
    number of children, and how often children carry the bucket's truth sites. ``trios``: sample, father, mother."""
    from .counting import size_bucket

    kids = trios.select("sample", "father", "mother").distinct()
    s, truth = kept_sites(sites.filter(kind_of() != "TRV") if skip_trv else sites), kept_sites(truth)
    own = calls.filter(g.is_carrier("gt") & F.col("gq").isNotNull()).join(kids, "sample")
    pairs = cut_lineage(matched_sites(s, truth, limits, least))
    yes = supported(pairs, own, truth_calls.join(kids.select("sample").distinct(), "sample", "left_semi")).withColumn("_t", F.lit(True))
    ref = calls.filter(F.coalesce(F.forall("gt", lambda a: F.coalesce(a == 0, F.lit(False))), F.lit(False))).select("id", "sample").distinct()
    site = s.select("id", kind_of().alias("kind"), size_bucket("allele_length", edges).alias("size")).distinct()
    x = (own.join(site, "id").join(yes, ["id", "sample"], "left")
         .join(ref.select("id", F.col("sample").alias("father"), F.lit(True).alias("_f")), ["id", "father"], "left")
         .join(ref.select("id", F.col("sample").alias("mother"), F.lit(True).alias("_m")), ["id", "mother"], "left"))
    out = x.groupBy("kind", "size", "gq").agg(F.count("*").alias("calls"), F.count("_t").alias("truth_supported"), F.count_if(F.col("_f") & F.col("_m")).alias("de_novo"))
    t_site = truth.select("id", F.when(kind_of().isin("DEL", "INS"), kind_of()).otherwise("SNV").alias("kind"), size_bucket("allele_length", edges).alias("size")).distinct()
    total = carriers(truth_calls).join(kids.select("sample").distinct(), "sample", "left_semi").join(t_site, "id").groupBy("kind", "size").agg(F.count("*").alias("truth_total"))
    n = kids.agg(F.count_distinct("sample").alias("children"))
    return out.join(total, ["kind", "size"], "left").withColumns({"truth_total": F.coalesce("truth_total", F.lit(0)), "children": n.scalar()})
