"""Caller tables to sites, sample sheets, and region shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import genotype as g
from ..functions.alleles import contig_sort
from .transfer import lookup


def calls_parquet_to_sites(calls: DataFrame, ref_bases: DataFrame, key=("chrom", "pos", "end", "ref", "alt")) -> DataFrame:
    """Caller rows (chrom, pos 0-based, end, id, ref, alt, seq, vartype, varlen, score) as sites.

    SNV keeps its bases; DEL is the anchor base plus the deleted sequence; INS the anchor, then
    the sequence; other types are symbolic. Per key the row with the best score stays (ties: id).
    ``ref_bases(chrom, pos, base)`` supplies the anchors.
    """
    x = calls.join(lookup(ref_bases, ["chrom", "pos"], ["base"]), ["chrom", "pos"], "left")
    t, base, seq = F.col("vartype"), F.upper("base"), F.upper(F.coalesce("seq", F.lit("")))
    ref = F.when(t == "SNV", F.upper("ref")).when(t == "DEL", F.concat(base, seq)).when(t == "INS", base).otherwise("N")
    alt = F.when(t == "SNV", F.upper("alt")).when(t == "DEL", base).when(t == "INS", F.concat(base, seq)).otherwise(F.concat(F.lit("<"), F.upper("vartype"), F.lit(">")))
    svlen = F.coalesce(F.abs("varlen"), F.abs(F.col("end") - F.col("pos")), F.lit(-1))
    x = x.withColumns({"ref": ref, "alt": alt, "svlen": svlen}).drop("base", "seq", "varlen")
    rest = [c for c in x.columns if c not in key]
    best = x.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct((-F.coalesce("score", F.lit(float("-inf")))).alias("s"), "id")).alias("_v"))
    return best.select(*key, *[F.col(f"_v.{c}").alias(c) for c in rest])


def sort_sites(df: DataFrame) -> DataFrame:
    return df.orderBy(*contig_sort("chrom"), "pos")


def _mid4(*cols: str):
    s = F.array_sort(F.array(*cols))
    return F.bround((F.get(s, F.lit(1)) + F.get(s, F.lit(2))) / 2, 0).cast("int")


def _mid2(a: str, b: str):
    return F.bround((F.col(a) + F.col(b)) / 2, 0).cast("int")


def palmer_calls_to_sites(calls: DataFrame, sequences: DataFrame, ref_bases: DataFrame, min_conf: int = 1) -> DataFrame:
    """Element caller rows as insertion sites.

    Rows: cluster_id, chrom, p1..p4, m1..m4, conf, ori, polya, tsd5, tsd3, transd, inv5, inv_end,
    inv_start, file_pos. Rows below ``min_conf`` go; of rows equal in (p1..m4, conf, polya) the
    first stays, and of a cluster the last. POS is the median of the four positions, the length spans
    the element medians plus transduction (and the inverted stretch); halves round to even.
    ``sequences(cluster_id, seq, file_pos)``: the first per cluster is inserted.
    """
    same = ["p1", "p2", "p3", "p4", "m1", "m2", "m3", "m4", "conf", "polya"]
    rest = [c for c in calls.columns if c not in same]
    d = calls.filter(F.col("conf") >= min_conf).groupBy(*same).agg(F.min_by(F.struct(*rest), "file_pos").alias("_v"))
    d = d.select(*same, *[F.col(f"_v.{c}").alias(c) for c in rest])
    cols = [c for c in d.columns if c != "cluster_id"]
    d = lookup(d, ["cluster_id"], cols, "file_pos")
    d = d.withColumns({"pos": _mid4("p1", "p2", "p3", "p4"), "_s": _mid2("m1", "m2"), "_e": _mid2("m3", "m4")})
    length = F.col("_e") - F.col("_s") + F.col("transd") + F.when(F.col("inv5") != 0, F.col("inv_end") - F.col("inv_start")).otherwise(0)
    seq = lookup(sequences, ["cluster_id"], ["seq"], "file_pos", first=True)
    d = d.withColumn("allele_length", length).join(seq, "cluster_id", "left").join(lookup(ref_bases, ["chrom", "pos"], ["base"]), ["chrom", "pos"], "left")
    return d.select("chrom", "pos", F.col("cluster_id").alias("id"), F.upper("base").alias("ref"), F.concat(F.upper("base"), F.upper(F.coalesce("seq", F.lit("")))).alias("alt"),
                    "allele_length", F.lit("ins").alias("allele_type"), "conf", "ori", "polya", "tsd5", "tsd3", "transd", (F.col("inv5") != 0).alias("inversion_5prime"))


def merge_call_shards(shards: dict[str, DataFrame], header_value: str = "cluster_id") -> DataFrame:
    """Union of per-type tables without repeated header rows, with ``me_type``."""
    return reduce(DataFrame.unionByName, [d.filter(F.col("cluster_id") != header_value).withColumn("me_type", F.lit(k)) for k, d in shards.items()])


def variants_to_bed(sites: DataFrame, info: list[str], copies: dict[str, str] | None = None, infer_type: bool = False, calls: DataFrame | None = None, filters: bool = False) -> DataFrame:
    """Sites as 0-based intervals with INFO columns; ``copies`` (source -> new name) and the type read
    from the id (INS, else DEL) are optional. With ``calls`` (id, sample, gt) a column ``samples`` lists who carries a site, by name; with ``filters`` a
    column of that name lists its filters."""
    d = sites
    if calls is not None:
        who = calls.filter(g.is_carrier("gt")).groupBy("id").agg(F.array_join(F.array_sort(F.collect_set(F.col("sample").cast("string"))), ",").alias("samples"))
        d = d.join(who, "id", "left").withColumn("samples", F.coalesce("samples", F.lit("")))
    if infer_type:
        was = F.col("svtype") if "svtype" in d.columns else F.lit(None).cast("string")
        d = d.withColumn("svtype", F.when(F.col("id").contains("INS"), "INS").when(F.col("id").contains("DEL"), "DEL").otherwise(was))
    for src, dst in (copies or {}).items():
        d = d.withColumn(dst, F.coalesce(F.col(src), F.col(dst)) if dst in d.columns else F.col(src))
    end = F.coalesce("end", F.col("pos") - 1 + F.length("ref")) if "end" in d.columns else F.col("pos") - 1 + F.length("ref")
    extra = [*info, *(copies or {}).values(), *(["svtype"] if infer_type and "svtype" not in info else []), *(["samples"] if calls is not None else [])]
    extra += [F.array_join("filters", ",").alias("filters")] if filters else []
    return d.select("chrom", (F.col("pos") - 1).alias("start"), end.alias("end"), "id", *extra)


# ------------------------------------------------------------------ sample sheets

def build_sample_metadata(ped: DataFrame, ancestry: DataFrame) -> DataFrame:
    """(sample, sex, population): sex code 1/2/else, missing population as ``unknown``."""
    sex = F.when(F.col("sex") == "1", "male").when(F.col("sex") == "2", "female").otherwise("unknown")
    return (ped.select("sample", sex.alias("sex")).distinct().join(lookup(ancestry, ["sample"], ["population"]), "sample", "left")
            .withColumn("population", F.coalesce("population", F.lit("unknown"))))


def make_ped(samples: DataFrame, swaps: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Six pedigree columns from (sample, sex M/F[, father, mother]); ids may be swapped, samples excluded."""
    d = samples
    if exclude is not None:
        d = d.join(exclude.select("sample").distinct(), "sample", "left_anti")
    if swaps is not None:
        m = lookup(swaps, ["sample"], ["new_sample"])
        for who in [c for c in ("sample", "father", "mother") if c in d.columns]:
            d = d.join(m.withColumnsRenamed({"sample": who, "new_sample": "_n"}), who, "left").withColumn(who, F.coalesce("_n", who)).drop("_n")
    sex = F.when(F.col("sex").isin("M", "male"), "1").when(F.col("sex").isin("F", "female"), "2").otherwise("0")
    par = lambda c: F.coalesce(F.col(c), F.lit("0")) if c in d.columns else F.lit("0")
    return d.select(F.col("sample").alias("family"), "sample", par("father").alias("father"), par("mother").alias("mother"), sex.alias("sex"), F.lit("0").alias("phenotype"))


def make_ancestry(samples: DataFrame, labels: DataFrame | None = None, superpopulation: dict[str, str] | None = None, default: str = "unknown") -> DataFrame:
    """(sample, population): a label table wins, then the sample's own population mapped to a wider
    group, then ``default``."""
    d = samples
    own = F.lit(None).cast("string")
    if superpopulation and "population" in samples.columns:
        own = F.create_map(*[F.lit(z) for kv in superpopulation.items() for z in kv])[F.col("population")]
    d = d.withColumn("_own", own)
    if labels is not None:
        d = d.join(lookup(labels.withColumnRenamed("population", "_lab"), ["sample"], ["_lab"]), "sample", "left")
    else:
        d = d.withColumn("_lab", F.lit(None).cast("string"))
    return d.select("sample", F.coalesce("_lab", "_own", F.lit(default)).alias("population"))


# ------------------------------------------------------------------ shards

def shard_windows(contigs: DataFrame, bin_size: int, pad: int = 0) -> DataFrame:
    """1-based inclusive windows over ``contigs(chrom, length)``, widened by ``pad`` inside the contig."""
    x = contigs.withColumn("_s", F.explode(F.sequence(F.lit(1), F.col("length"), F.lit(bin_size))))
    return x.select("chrom", F.greatest(F.col("_s") - pad, F.lit(1)).cast("int").alias("start"),
                    F.least(F.col("_s") + bin_size - 1 + pad, F.col("length")).cast("int").alias("end"))


def shard_by_region(sites: DataFrame, bin_size: int) -> DataFrame:
    """``shard_start`` of the window holding each site (the partition column of a sharded table)."""
    return sites.withColumn("shard_start", (F.floor((F.col("pos") - 1) / bin_size) * bin_size + 1).cast("int"))


def distinct_contigs(sites: DataFrame) -> DataFrame:
    return sites.select("chrom").distinct()


def samples_of(calls: DataFrame) -> DataFrame:
    return calls.select("sample").distinct()
