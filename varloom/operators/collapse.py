"""Similar sites of one call set collapsed into the one that is kept, and what the kept one takes over.

Sites: id, chrom, start, len, kind, seq (``SEQ``), and ``support`` where the most common site of a group is kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import genotype as g
from ..functions.alleles import sequence_score
from ..session import cut_lineage
from .intervals import assign_islands, islands
from .matching import SEQ, near_pairs

GROUP = 100_000


@dataclass(frozen=True)
class Limits:
    """Window of starts, least reciprocal overlap, least sequence and size similarity, and the sizes that take part."""

    window: int = 500
    share: float = 0.0
    seq_sim: float = 0.9
    size_sim: float = 0.9
    shortest: int = 0
    longest: int = 1 << 40


# Limits by kind for merging the sites of a cohort, and the least Jaccard index of carriers.
MERGE_LIMITS = {"DEL": Limits(500, 0.0, 0.5, 0.5, 0, 50_000), "INS": Limits(200, 0.0, 0.5, 0.5, 0, 50_000)}
MERGE_JACCARD = 0.5
# How a site came about: equal alleles, equal repeat alleles, similar sites, a single site.
EXACT, TRV_EXACT, SIMILAR, UNIQUE = "EXACT", "TRV_EXACT", "TRUVARI", "UNIQUE"


def _nodes(sites: DataFrame, common: bool) -> DataFrame:
    """Distinct contents under the id of one of their copies: the most supported (``sup`` is minus its support) or the first by id."""
    if not common:
        return sites.groupBy(*SEQ).agg(F.min("id").alias("id")).withColumn("sup", F.lit(0).cast("bigint"))
    first = F.min(F.struct((-F.coalesce("support", F.lit(0))).cast("bigint").alias("sup"), "id"))
    return sites.groupBy(*SEQ).agg(first.alias("_f")).select(*SEQ, "_f.id", "_f.sup")


def _pairs(nodes: DataFrame, lim: Limits) -> DataFrame:
    """Similar pairs within ``lim``, each with the one that comes first in order as ``b_``."""
    n = nodes.filter((F.col("len") >= lim.shortest) & (F.col("len") <= lim.longest))
    p = near_pairs(n, n, lim.window, ("chrom", "kind"), size_sim=lim.size_sim)
    order = lambda x: F.struct(*[F.col(x + k).alias(k) for k in ("sup", "start", "id")])
    p = p.filter(order("b_") < order(""))
    if lim.share > 0:
        end = lambda x: F.col(x + "start") + F.col(x + "len")
        p = p.filter(F.least(end(""), end("b_")) - F.greatest("start", "b_start") >= lim.share * F.greatest("len", "b_len") - 1e-9)
    return p.filter(sequence_score("seq", "b_seq", lim.seq_sim).isNotNull())


def collapse_sites(sites: DataFrame, limits: Limits | dict[str, Limits] = Limits(), common: bool = False, most: int = 1 << 20) -> DataFrame:
    """(id, kept_id): greedy collapse in order of position and id, or (``common``) of falling support first.

    A site is kept unless an earlier kept one is similar; it then joins the earliest such. With limits by kind other kinds are kept as they are. Sites more than
    a window apart never meet, so the similar pairs of each stretch without such a gap are scanned in order by one task; the number
    of jobs does not follow the data. A stretch of over ``most`` pairs is not gathered: it is decided in rounds.
    """
    nodes = cut_lineage(_nodes(sites, common))
    kinds = limits if isinstance(limits, dict) else {None: limits}
    pairs = reduce(DataFrame.unionByName, [_pairs(nodes if k is None else nodes.filter(F.col("kind") == k), lim) for k, lim in kinds.items()])
    edges = cut_lineage(pairs.select("chrom", "start", "sup", "id", F.col("b_id").alias("early"), F.col("b_start").alias("es"), F.col("b_sup").alias("esup")))
    reach = edges.select("chrom", F.least("es", "start").alias("start"), (F.greatest("es", "start") + 1).alias("end"))
    isl = islands(reach, by=["chrom"])
    edges = assign_islands(edges.withColumn("end", F.col("start") + 1), isl, by=["chrom"])
    edges = cut_lineage(edges.select("chrom", F.col("island_start").alias("island"), "start", "sup", "id", "early", "es", "esup"))
    size = edges.groupBy("chrom", "island").agg(F.count("*").alias("_n"))
    big = cut_lineage(size.filter(F.col("_n") > most).select("chrom", "island"))
    # Whole stretches are dealt to groups of about ``GROUP`` pairs; stretches share no site, so one scan may take several.
    groups = F.pmod(F.xxhash64("chrom", "island"), F.lit(edges.count() // GROUP + 1))
    decided = edges.join(big, ["chrom", "island"], "left_anti").groupBy(groups.alias("g")).applyInPandas(_scan, "id string, kept_id string")
    if not big.isEmpty():
        decided = decided.unionByName(_rounds(edges.join(big, ["chrom", "island"], "left_semi").select("id", "early", "es", "esup")))
    final = nodes.select(*SEQ, F.col("id").alias("_cid")).join(decided.withColumnRenamed("id", "_cid"), "_cid", "left").select(*SEQ, F.coalesce("kept_id", "_cid").alias("kept_id"))
    return sites.join(final, SEQ).select("id", "kept_id")


def _scan(pairs):
    """Sites with an earlier similar one, in order: each joins the earliest of those that are kept themselves."""
    import pandas as pd

    pairs = pairs.sort_values(["sup", "start", "id", "esup", "es", "early"])
    owner: dict[str, str] = {}
    for vid, early in zip(pairs["id"], pairs["early"]):
        if owner.get(vid, vid) == vid and owner.get(early, early) == early:
            owner[vid] = early
    return pd.DataFrame({"id": list(owner), "kept_id": list(owner.values())}, dtype="object")


def _rounds(edges: DataFrame) -> DataFrame:
    """(id, kept_id) of the sites with an earlier neighbour, decided in rounds: sites whose earlier neighbours are all removed
    are kept, sites next to a kept one are removed."""
    todo = cut_lineage(edges.select("id").union(edges.select("early")).distinct())
    decided, open_edges = None, edges
    order = F.struct("esup", "es", "early")
    while not todo.isEmpty():
        kept = cut_lineage(todo.join(open_edges.select("id").distinct(), "id", "left_anti"))
        hit = open_edges.join(kept.withColumnRenamed("id", "early"), "early", "left_semi")
        gone = hit.groupBy("id").agg(F.min_by("early", order).alias("kept_id"))
        step = cut_lineage(kept.withColumn("kept_id", F.col("id")).unionByName(gone))
        decided = step if decided is None else decided.unionByName(step)
        todo = cut_lineage(todo.join(step.select("id"), "id", "left_anti"))
        out_of_play = step.filter("id <> kept_id").select(F.col("id").alias("early"))
        open_edges = cut_lineage(open_edges.join(todo, "id", "left_semi").join(out_of_play, "early", "left_anti"))
    # A site belongs to the earliest kept neighbour over all rounds.
    kept = decided.filter("id = kept_id").select(F.col("id").alias("early"))
    claim = edges.join(kept, "early", "left_semi").groupBy("id").agg(F.min_by("early", order).alias("_k"))
    return decided.join(claim, "id", "left").filter("id <> kept_id").select("id", F.coalesce("_k", "kept_id").alias("kept_id"))


def carriers(calls: DataFrame) -> DataFrame:
    """Distinct (id, sample) that carry an ALT."""
    return calls.filter(g.is_carrier("gt")).select("id", "sample").distinct()


def alike_carriers(clusters: DataFrame, calls: DataFrame, least: float = MERGE_JACCARD) -> DataFrame:
    """``clusters`` (id, kept_id) in which removed sites whose carriers overlap those of the kept one too little stand on their own again.

    Two sites without carriers are equal; one without and one with have nothing in common. ``calls`` without ``gt`` are distinct carriers.
    """
    if least <= 0:
        return clusters
    car = carriers(calls) if "gt" in calls.columns else calls
    n = car.groupBy("id").agg(F.count("*").alias("n"))
    rem = clusters.filter("id <> kept_id")
    both = rem.join(car, "id").join(car.withColumnRenamed("id", "kept_id"), ["kept_id", "sample"]).groupBy("id", "kept_id").agg(F.count("*").alias("_i"))
    j = (rem.join(both, ["id", "kept_id"], "left").join(n.withColumnRenamed("n", "_a"), "id", "left")
         .join(n.select(F.col("id").alias("kept_id"), F.col("n").alias("_b")), "kept_id", "left"))
    inter = F.coalesce("_i", F.lit(0))
    union = F.coalesce("_a", F.lit(0)) + F.coalesce("_b", F.lit(0)) - inter
    low = j.filter(F.coalesce(F.try_divide(inter, union), F.lit(1.0)) < least).select("id", F.lit(True).alias("_low"))
    return clusters.join(low, "id", "left").withColumn("kept_id", F.when(F.col("_low"), F.col("id")).otherwise(F.col("kept_id"))).drop("_low")


def merge_info(clusters: DataFrame) -> DataFrame:
    """kept_id, merge_count and merge_type of each kept site."""
    n = clusters.groupBy("kept_id").agg(F.count("*").alias("merge_count"))
    return n.withColumn("merge_type", F.when(F.col("merge_count") > 1, SIMILAR).otherwise(UNIQUE))


def exact_merge_info(sites: DataFrame) -> DataFrame:
    """chrom, pos, ref, alt, merge_count and merge_type of sites that are merged by equal alleles; repeats (allele type ``trv``) have a type of their own."""
    n = sites.groupBy("chrom", "pos", "ref", "alt").agg(F.count("*").alias("merge_count"), F.bool_or(F.lower("allele_type") == "trv").alias("_trv"))
    kind = F.when(F.col("merge_count") == 1, UNIQUE).when(F.coalesce("_trv", F.lit(False)), TRV_EXACT).otherwise(EXACT)
    return n.withColumn("merge_type", kind).drop("_trv")


def _rank(place: str) -> Column:
    """The kept site first, then the removed ones in order."""
    return F.struct((F.col("id") != F.col("kept_id")).alias("r"), F.col(place).alias("p"), F.col("id").alias("id"))


def merged_calls(clusters: DataFrame, calls: DataFrame, places: DataFrame) -> DataFrame:
    """Calls of the kept sites; a call that isn't carried takes over that of the first removed site that carries one.

    ``places`` (id, start) gives the order of sites. Samples without a call of the kept site get one only from a carrier.
    """
    own, carried = F.col("id") == F.col("kept_id"), g.is_carrier("gt")
    x = calls.join(clusters.join(places.select("id", F.col("start").alias("_p")), "id"), "id").filter(own | carried)
    first = F.min(F.struct((~carried).alias("c"), _rank("_p").alias("r"), "gt"))
    out = x.groupBy("kept_id", "sample").agg(first.alias("_f"))
    return out.select(F.col("kept_id").alias("id"), "sample", "_f.gt", F.col("_f.r.id").alias("source"))


def merged_fields(clusters: DataFrame, fields: DataFrame, places: DataFrame) -> DataFrame:
    """id, key, value, source: each kept site's own annotation fields, and those it lacks from the first removed site that has them.

    ``fields``: id, key, value (NULL is no value).
    """
    x = fields.filter(F.col("value").isNotNull()).join(clusters, "id").join(places.select("id", F.col("start").alias("_p")), "id")
    pick = F.min_by(F.struct("value", F.col("id").alias("source")), _rank("_p"))
    return x.groupBy("kept_id", "key").agg(pick.alias("_v")).select(F.col("kept_id").alias("id"), "key", "_v.value", "_v.source")
