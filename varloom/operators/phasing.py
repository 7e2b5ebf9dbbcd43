"""Phase blocks, phase evaluation and haplotype overlaps over long call tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import genotype as g
from ..session import cut_lineage, kept
from .positions import number_rows, point_in_interval, prefixed, running
from .transfer import lookup

GT01, GT10 = "0|1", "1|0"


def _pair(gt: str = "gt") -> tuple[Column, Column]:
    return F.try_element_at(gt, F.lit(1)), F.try_element_at(gt, F.lit(2))


def full_het(gt: str = "gt") -> Column:
    a, b = _pair(gt)
    return F.coalesce(g.is_full_diploid(gt) & (a != b), F.lit(False))


# ------------------------------------------------------------------ flips against a backbone

def _truth_side(truth: DataFrame, key: list[str]) -> DataFrame:
    """Phased biallelic truth hets: haplotype (0 or 1) carrying the alt, one row per allele key and sample."""
    t = truth.filter(full_het() & F.col("phased")).withColumn("side", F.when(_pair()[0] == 1, 0).otherwise(1))
    return lookup(t, [*key, "sample"], ["side"])


def phase_block_flips(calls: DataFrame, truth: DataFrame, key=("chrom", "npos", "nref", "nalt"), vid="id",
                      phase_unphased: bool = False) -> DataFrame:
    """(id, sample, new_gt, new_ps): calls whose phase changes so blocks agree with the truth.

    ``calls`` carry per-ALT trimmed alleles as ``alleles`` array<struct<allele,npos,nref,nalt>>
    with ``chrom, id, sample, gt, phased, ps``. A block (sample, PS) flips when its phased SNV
    alleles disagree more often than they agree. With ``phase_unphased`` an unphased het takes
    its phase from the truth where the alleles' support is not contradictory.
    """
    key = list(key)
    side = _truth_side(truth, key)
    het = calls.filter(full_het())
    alle = het.select("chrom", vid, "sample", "gt", "phased", "ps", F.explode("alleles").alias("_a")).select(
        "chrom", vid, "sample", "gt", "phased", "ps", F.col("_a.allele").alias("allele"), *[F.col(f"_a.{k}").alias(k) for k in key if k != "chrom"])
    a, b = _pair()
    alle = alle.filter((a == F.col("allele")) | (b == F.col("allele")))
    sup = alle.join(side, [*key, "sample"])
    here = F.when(a == F.col("allele"), 0).otherwise(1)
    votes = sup.filter("phased and ps is not null and length(nref) = 1 and length(nalt) = 1").withColumn("_ok", here == F.col("side"))
    flips = (votes.groupBy("sample", "ps").agg(F.count_if("_ok").alias("_c"), F.count_if(~F.col("_ok")).alias("_d"))
             .filter("_d > _c").select("sample", "ps", F.lit(True).alias("_flip")))
    out = het.filter("phased and ps is not null").join(flips, ["sample", "ps"]).select(
        vid, "sample", F.concat_ws("|", b.cast("string"), a.cast("string")).alias("new_gt"), F.col("ps").cast("string").alias("new_ps"))
    if not phase_unphased:
        return out
    s = sup.filter("not phased").groupBy(vid, "sample", "gt").agg(
        F.max(F.when(F.col("allele") == a, F.col("side"))).alias("_sa"), F.max(F.when(F.col("allele") == b, F.col("side"))).alias("_sb"))
    ordered = F.when((a == 0) & F.col("_sb").isNotNull(), F.col("_sb") == 0).when(
        (b == 0) & F.col("_sa").isNotNull(), F.col("_sa") == 1).when(
        (a != 0) & (b != 0) & (F.col("_sa") != F.col("_sb")), F.col("_sa") == 1)
    s = s.withColumn("_swap", ordered).filter("_swap is not null")
    x, y = a.cast("string"), b.cast("string")
    new = s.select(vid, "sample", F.when(F.col("_swap"), F.concat_ws("|", y, x)).otherwise(F.concat_ws("|", x, y)).alias("new_gt"), F.lit(".").alias("new_ps"))
    return out.unionByName(new)


def apply_phase_flips(calls: DataFrame, deltas: DataFrame, vid="id", order: str | None = None) -> DataFrame:
    """Set GT, PS and phase from the first delta per (variant, sample)."""
    d = lookup(deltas, [vid, "sample"], ["new_gt", "new_ps"], order, first=True)
    x = calls.join(d, [vid, "sample"], "left")
    hit = F.col("new_gt").isNotNull()
    gt = F.transform(F.split("new_gt", r"\|"), lambda v: v.try_cast("int"))
    return x.withColumns({"gt": F.when(hit, gt).otherwise(F.col("gt")), "phased": F.col("phased") | hit,
                          "ps": F.when(hit, F.col("new_ps").try_cast("bigint")).otherwise(F.col("ps"))}).drop("new_gt", "new_ps")


def transfer_haplotypes(calls: DataFrame, truth: DataFrame, key=("chrom", "pos", "uref", "ualt")) -> DataFrame:
    """Each (sample, PS, GT) group votes over its SNVs and flips as a whole when mostly discordant."""
    key = list(key)
    t = truth.filter(full_het() & F.col("phased")).select(*key, "sample", F.array_join("gt", "|").alias("_t"))
    t = lookup(t, [*key, "sample"], ["_t"])
    text = F.array_join("gt", "|")
    ok = F.col("phased") & F.col("ps").isNotNull() & F.coalesce(text.isin(GT01, GT10), F.lit(False)) & g.is_full_diploid("gt")
    x = calls.withColumn("_g", F.when(ok, text))
    v = x.filter("_g is not null and lower(allele_type) = 'snv'").join(t, [*key, "sample"]).filter(F.col("_t").isin(GT01, GT10))
    flip = v.groupBy("sample", "ps", "_g").agg(F.count_if(F.col("_t") == F.col("_g")).alias("_c"), F.count_if(F.col("_t") != F.col("_g")).alias("_d"))
    flip = flip.filter("_d > _c").select("sample", "ps", "_g", F.lit(True).alias("_flip"))
    y = x.join(flip, ["sample", "ps", "_g"], "left")
    return y.withColumn("gt", F.when(F.col("_flip"), F.reverse("gt")).otherwise(F.col("gt"))).drop("_flip", "_g")


def phase_set_anchors(calls: DataFrame, min_af: float, vid="id", order="file_pos") -> DataFrame:
    """Sites kept as block anchors: in each (sample, PS) all with af >= min_af, or else the one
    with the highest af (the first of equals)."""
    c = calls.filter(~g.has_null("gt") & F.col("ps").isNotNull())
    common = c.filter(F.col("af") >= min_af).select(vid)
    block = c.groupBy("sample", "ps").agg(F.max("af").alias("_top"), F.min(F.struct((-F.col("af")).alias("f"), order, vid)).alias("_b"))
    single = block.filter(F.col("_top") < min_af).select(F.col(f"_b.{vid}").alias(vid))
    return common.unionByName(single).distinct()


# ------------------------------------------------------------------ switch and flip errors

def phase_states(calls: DataFrame, truth: DataFrame, key) -> DataFrame:
    """Phased hets present in both sets with ``state`` 1 (same) or 0 (swapped); others are dropped."""
    key = list(key)
    t = lookup(truth.filter(full_het() & F.col("phased")), [*key, "sample"], ["gt"]).withColumnRenamed("gt", "_t")
    x = calls.filter(full_het() & F.col("phased")).join(t, [*key, "sample"])
    state = F.when(F.col("gt") == F.col("_t"), 1).when(F.col("gt") == F.reverse("_t"), 0)
    return x.withColumn("state", state).filter("state is not null").drop("_t")


def rank_by_position(df: DataFrame, group: list[str], pos: str, order: str, out: str, chunk: int = 1 << 20) -> DataFrame:
    """Dense 1-based rank within ``group`` by (pos, order), without ever sorting a whole group.

    Counts per position are prefix-summed; rows sharing a position are ranked in chunks.
    """
    per = df.groupBy(*group, pos).agg(F.count("*").alias("_n"))
    before = running(per, pos, group, sums=["_n"]).select(*group, pos, (F.col("run__n") - F.col("_n")).alias("_before"))
    inside = number_rows(df, [*group, pos], order, "_k", chunk=chunk)
    return inside.join(before, [*group, pos]).withColumn(out, F.col("_k") + F.col("_before")).drop("_k", "_before")


def phase_statuses(points: DataFrame, group=("contig", "sample", "collection"), pos="pos", order="file_pos") -> DataFrame:
    """Status of each comparable call along a haplotype: CN, XC, FL or SW.

    States are oriented to the majority of the group. A run of n consecutive state changes is
    floor(n/2) flips and, when n is odd, one switch at its end.
    """
    group = list(group)
    points = cut_lineage(points)
    tot = points.groupBy(*group).agg(F.sum("state").alias("_s"), F.count("*").alias("_n"))
    tot = tot.select(*group, (F.col("_s") * 2 < F.col("_n")).alias("_inv"))
    x = points.join(tot, group).withColumn("state", F.when(F.col("_inv"), 1 - F.col("state")).otherwise(F.col("state"))).drop("_inv")
    x = cut_lineage(rank_by_position(x, group, pos, order, "idx"))
    prev = x.select(*group, (F.col("idx") + 1).alias("idx"), F.col("state").alias("_prev"))
    ch = x.join(prev, [*group, "idx"]).filter("state <> _prev").select(*group, "idx")
    ch = cut_lineage(number_rows(ch, group, "idx", "_k").withColumn("_run", F.col("idx") - F.col("_k")).drop("_k"))
    runs = ch.groupBy(*group, "_run").agg(F.min("idx").alias("_first"), F.count("*").alias("_len"))
    ch = ch.join(runs, [*group, "_run"])
    lone = (F.col("_len") % 2 == 1) & (F.col("idx") == F.col("_first") + F.col("_len") - 1)
    ch = ch.select(*group, "idx", F.when(lone, "SW").otherwise("FL").alias("_e"))
    plain = F.when(F.col("state") == 1, "XC").otherwise("CN")
    return x.join(ch, [*group, "idx"], "left").withColumn("status", F.coalesce("_e", plain)).drop("_e", "idx")


def switch_flip_errors(statuses: DataFrame, group=("contig", "sample", "collection")) -> DataFrame:
    """Matched calls, switch errors and flip errors (two FL calls make one) per group."""
    n = F.count_if(F.col("status") == "FL")
    return statuses.groupBy(*group).agg(F.count("*").alias("matched_count"), F.count_if(F.col("status") == "SW").alias("switch_error_count"),
                                        (n / 2).cast("bigint").alias("flip_error_count"))


def aggregate_phasing(parts: DataFrame) -> DataFrame:
    """Sums over shards per (contig, sample, collection)."""
    names = ["matched_count", "switch_error_count", "flip_error_count"]
    return parts.groupBy("contig", "sample", "collection").agg(*[F.sum(n).alias(n) for n in names])


# Severity of a comparable call's status.
STATUS_RANK = {"XC": 0, "CN": 1, "FL": 2, "SW": 3}


def phase_status_matrix(calls: DataFrame, statuses: DataFrame, missing: DataFrame, vid="id") -> DataFrame:
    """One status per call: NC no call, ``.`` hom ref, HA hom alt, UP unphased het, the worst
    comparable status, MS sample without truth, NF not found. Long form; pivot at the sink."""
    rank = F.create_map(*[F.lit(z) for kv in STATUS_RANK.items() for z in kv])[F.col("status")]
    worst = statuses.groupBy(vid, "sample").agg(F.max_by("status", rank).alias("_w"))
    m = missing.select("sample").distinct().withColumn("_m", F.lit(True))
    x = calls.join(worst, [vid, "sample"], "left").join(m, "sample", "left")
    a, b = _pair()
    st = (F.when(~F.coalesce(g.is_full_diploid("gt"), F.lit(False)), "NC").when((a == b) & (a == 0), ".").when(a == b, "HA")
          .when(~F.coalesce("phased", F.lit(False)), "UP").when(F.col("_w").isNotNull(), F.col("_w"))
          .when(F.col("_m"), "MS").otherwise("NF"))
    return x.withColumn("phase_status", st).drop("_w", "_m")


def pivot_status(matrix: DataFrame, samples: list[str], vid="id") -> DataFrame:
    """Wide form for writing; the sample list is named, so no discovery pass runs."""
    return matrix.groupBy(vid).pivot("sample", samples).agg(F.first("phase_status"))


# ------------------------------------------------------------------ haplotype overlaps

# Type order when overlapping calls compete.
TYPE_RANK = {"DEL": 2, "INS": 1, "SNV": 0, "OTHER": -1}


def haplotype_calls(calls: DataFrame) -> DataFrame:
    """Phased alt alleles as closed reference spans, one row per carrying haplotype.

    Repeat sites and sites inside repeats (``tr_enveloped``, where given) take no part.
    """
    calls = calls.filter("allele_type <> 'trv'")
    if "tr_enveloped" in calls.columns:
        calls = calls.filter("NOT coalesce(tr_enveloped, false)")
    t, n = F.lower("allele_type"), F.abs("allele_length")
    kind = F.when(n == 0, "SNV").when(t.contains("del"), "DEL").when(t.contains("ins") | t.contains("dup"), "INS").otherwise("OTHER")
    x = calls.filter("phased").withColumn("haplotype", F.explode(F.array(F.lit(1), F.lit(2)))).filter(F.get("gt", F.col("haplotype") - 1) > 0)
    x = x.withColumns({"kind": kind, "start": F.col("pos"), "end": F.col("pos") + F.length("ref")})
    rank = F.create_map(*[F.lit(z) for kv in TYPE_RANK.items() for z in kv])[F.col("kind")]
    prio = F.struct((F.col("end") - F.col("start")).alias("span"), F.coalesce("gq", F.lit(0)).alias("gq"), F.coalesce(n, F.lit(0)).alias("len"),
                    rank.alias("rank"), F.coalesce(F.col("qual").cast("double"), F.lit(0.0)).alias("qual"), (-F.col("file_pos")).alias("first"))
    return x.withColumn("prio", prio).select("chrom", "sample", "haplotype", "id", "kind", "start", "end", "prio")


def haplotype_overlaps(calls: DataFrame) -> DataFrame:
    """Log of overlapping calls per sample and haplotype: the retained and the cleared one.

    Longer reference span wins, then GQ, length, type, QUAL and file order.
    """
    by = ["chrom", "sample", "haplotype"]
    h = kept(haplotype_calls(calls).filter(F.col("start") < F.col("end")), "haplotypes")
    # Of two overlapping calls the later one starts inside the other; where both start at one place each meets the other.
    p = point_in_interval(h, prefixed(h, "b_").withColumnsRenamed({"b_" + x: x for x in by}), "start", "b_start", "b_end", by, least_bits=6)
    wins, loses = F.col("prio") > F.col("b_prio"), F.col("prio") < F.col("b_prio")
    p = p.filter(wins | (loses & (F.col("b_start") < F.col("start"))))
    return p.select("sample", "haplotype", F.when(wins, F.col("id")).otherwise(F.col("b_id")).alias("retained"), F.when(wins, F.col("kind")).otherwise(F.col("b_kind")).alias("type_retained"),
                    F.when(wins, F.col("b_id")).otherwise(F.col("id")).alias("cleared"), F.when(wins, F.col("b_kind")).otherwise(F.col("kind")).alias("type_cleared"))


def cleared_calls(calls: DataFrame) -> DataFrame:
    """(id, sample) losing to some overlapping call, found without building pairs.

    Calls are sent once, to where their haplotype is, and swept there by start. Longer calls rank higher, so a later call that outranks an open one also ends
    behind it and takes its place: the open calls are a stack of falling ranks, emptied where all have ended. A call of no length loses to what covers
    either base beside its place, one of unknown length to what covers its place; neither outranks any.
    """
    by = ["chrom", "sample", "haplotype"]
    h = haplotype_calls(calls).filter("chrom IS NOT NULL AND sample IS NOT NULL AND start IS NOT NULL")
    empty = F.coalesce(F.col("start") >= F.col("end"), F.lit(False))
    point = empty | F.col("end").isNull()
    h = h.select(*by, "id", "prio", point.alias("point"), (F.col("start") - empty.cast("int")).cast("bigint").alias("start"),
                 F.coalesce(F.col("end") + empty.cast("int"), F.col("start") + 1).cast("bigint").alias("end"))
    h = h.repartition(*by).withColumn("rank", F.dense_rank().over(W.partitionBy(*by).orderBy("prio"))).drop("prio").sortWithinPartitions(*by, "start")
    kind = {x: h.schema[x].dataType for x in ("id", "sample")}

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, stack = None, []  # of each open call: rank, end, id, last end of those up to it, and of those that outrank it
        for b in batches:
            new = np.zeros(b.num_rows, bool)
            for x in by:
                new[1:] |= pc.not_equal(b[x].slice(1), b[x].slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
            new[0] = [b[x][0].as_py() for x in by] != group
            group = [b[x][-1].as_py() for x in by]
            lost, of = [], []
            for i, (fresh, start, end, rank, at, vid) in enumerate(zip(new.tolist(), *(b[x].to_pylist() for x in ("start", "end", "rank", "point", "id")))):
                if fresh:
                    stack = []
                while stack and stack[-1][0] < rank and not at:
                    _, until, whose, _, _ = stack.pop()
                    if until > start:
                        lost.append(whose)
                        of.append(i)
                if stack and stack[-1][3] <= start and not at:
                    stack = []
                last = stack[-1][3] if stack else start
                above = stack[-1][4] if stack and stack[-1][0] <= rank and not at else last
                if above > start:
                    lost.append(vid)
                    of.append(i)
                stack.append((rank, end, vid, last if at else max(last, end), above))
            yield pa.RecordBatch.from_arrays([pa.array(lost, types["id"]), b["sample"].take(pa.array(of, pa.int64()))], names=["id", "sample"])

    types = {x: to_arrow_type(t) for x, t in kind.items()}
    return h.mapInArrow(swept, ", ".join(f"{x} {t.simpleString()}" for x, t in kind.items())).distinct()


def clear_calls(calls: DataFrame, cleared: DataFrame, vid="id") -> DataFrame:
    """Listed calls lose GT, phase and every other call field."""
    x = calls.join(cleared.select(vid, "sample").distinct().withColumn("_x", F.lit(True)), [vid, "sample"], "left")
    kinds = dict(calls.dtypes)
    null2 = F.array(F.lit(None).cast("int"), F.lit(None).cast("int"))
    cols = {"gt": F.when(F.col("_x"), null2).otherwise(F.col("gt"))}
    if "phased" in kinds:
        cols["phased"] = F.col("_x").isNull() & F.col("phased")
    for f in ("gq", "ad", "pl", "dp", "ev", "bev"):
        if f in kinds:
            cols[f] = F.when(F.col("_x").isNull(), F.col(f))
    return x.withColumns(cols).drop("_x")
