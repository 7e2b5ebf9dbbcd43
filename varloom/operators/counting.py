"""Category counts over annotated sites and calls.

Sites: ``id, allele_type, allele_subtype, allele_length, af, ac, tr_enveloped, region``
plus ``vep`` (``a|b|c`` text per transcript, comma separated) and PREDICTED_* columns
(arrays of gene names, or flags). Sharding and merging vanish: each table is one
grouped aggregation, totals come from exploding the few total labels of a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import genotype as g
from ..functions.alleles import trim_alleles

# Bucket edges.
SUMMARY_EDGES = (0, 1, 50, 500)
PLOT_EDGES = (0, 1, 50, 100, 500, 5000, 50000)
AF_EDGES = (0.0, 0.01, 0.05, 0.1, 0.5)

# Consequence terms by label, most severe label first.
CONSEQUENCES = {
    "LoF": ["transcript_ablation", "stop_gained", "frameshift_variant", "splice_donor_variant", "splice_acceptor_variant",
            "stop_lost", "start_lost", "transcript_amplification", "feature_elongation", "feature_truncation"],
    "Missense": ["missense_variant", "inframe_insertion", "inframe_deletion", "protein_altering_variant"],
    "Synonymous": ["synonymous_variant", "stop_retained_variant", "start_retained_variant",
                   "incomplete_terminal_codon_variant", "coding_sequence_variant"],
    "Intronic": ["intron_variant", "splice_region_variant", "splice_donor_region_variant", "splice_polypyrimidine_tract_variant",
                 "splice_donor_5th_base_variant", "NMD_transcript_variant", "non_coding_transcript_exon_variant",
                 "non_coding_transcript_variant"],
    "Intergenic": ["intergenic_variant", "upstream_gene_variant", "downstream_gene_variant", "regulatory_region_variant",
                   "regulatory_region_ablation", "regulatory_region_amplification", "TF_binding_site_variant", "TFBS_ablation",
                   "TFBS_amplification", "3_prime_UTR_variant", "5_prime_UTR_variant"],
}
# Structural effects by label, most severe first.
EFFECTS = {"LoF": "PREDICTED_LOF", "Copy Gain": "PREDICTED_COPY_GAIN", "IED": "PREDICTED_INTRAGENIC_EXON_DUP",
           "PED": "PREDICTED_PARTIAL_EXON_DUP", "TSSD": "PREDICTED_TSS_DUP", "DP": "PREDICTED_DUP_PARTIAL", "UTR": "PREDICTED_UTR"}
GENE_FIELDS = ["PREDICTED_LOF", "PREDICTED_COPY_GAIN", "PREDICTED_INTRAGENIC_EXON_DUP", "PREDICTED_PARTIAL_EXON_DUP",
               "PREDICTED_TSS_DUP", "PREDICTED_DUP_PARTIAL", "PREDICTED_INV_SPAN", "PREDICTED_UTR", "PREDICTED_INTRONIC",
               "PREDICTED_PROMOTER"]
REGIONS = ["US", "RM", "SD", "SR"]
ALL = "All"


def size_labels(edges) -> list[str]:
    return [f"{a}-{b - 1}" for a, b in zip(edges, edges[1:])] + [f"{edges[-1]}+"]


def size_bucket(length, edges) -> Column:
    n = F.abs(F.col(length))
    out = F.when(n.isNull(), F.lit(None))
    labels = size_labels(edges)
    for hi, lab in zip(edges[1:], labels):
        out = out.when(n < hi, lab)
    return out.otherwise(labels[-1])


def size_column(edges=SUMMARY_EDGES, kind="allele_type", length="allele_length") -> Column:
    """SNV, TRV, ``DEL a-b``, ``INS a-b`` (ins and dup) or Other."""
    t = F.lower(F.coalesce(F.col(kind), F.lit("")))
    b = size_bucket(length, edges)
    return (F.when(t == "snv", "SNV").when(t == "trv", "TRV").when(F.col(length).isNull(), "Other")
            .when(t.isin("ins", "dup"), F.concat(F.lit("INS "), b)).when(t == "del", F.concat(F.lit("DEL "), b)).otherwise("Other"))


def af_bucket(af="af", edges=AF_EDGES) -> Column:
    """``a-b`` (upper end inclusive) or ``>last``; NULL without a frequency."""
    v = F.col(af)
    out = F.when(v.isNull(), F.lit(None))
    for lo, hi in zip(edges, edges[1:]):
        out = out.when(v <= hi, f"{lo}-{hi}")
    return out.otherwise(f">{edges[-1]}")


def af_column(edges=AF_EDGES, kind="allele_type", af="af") -> Column:
    t = F.lower(F.coalesce(F.col(kind), F.lit("")))
    name = F.when(t == "snv", "SNV").when(t == "trv", "TRV").when(t.isin("ins", "dup"), "INS").when(t == "del", "DEL").otherwise("Other")
    return F.concat(name, F.lit(" ["), af_bucket(af, edges), F.lit("]"))


def vep_label(vep: str = "vep", consequence_index: int = 1) -> Column:
    """Most severe label among the ``&``-joined terms of every annotation; Other without one."""
    field = F.transform(F.split(vep, ","), lambda a: F.try_element_at(F.split(a, r"\|"), F.lit(consequence_index + 1)))
    terms = F.transform(F.split(F.array_join(field, "&"), "&"), lambda x: F.trim(x))
    out = None
    for label, words in CONSEQUENCES.items():
        hit = F.arrays_overlap(terms, F.array(*[F.lit(w) for w in words]))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.coalesce(out, F.lit("Other"))


def _present(df: DataFrame, name: str) -> Column:
    """Is the annotation set? Absent column, NULL, false and empty list all mean no."""
    if name not in df.columns:
        return F.lit(False)
    kind = dict(df.dtypes)[name]
    if kind == "boolean":
        return F.coalesce(F.col(name), F.lit(False))
    if kind.startswith("array"):
        return F.coalesce(F.size(name) > 0, F.lit(False))
    return F.col(name).isNotNull()


def effect_label(df: DataFrame) -> Column:
    return F.coalesce(*[F.when(_present(df, f), F.lit(lab)) for lab, f in EFFECTS.items()])


def classify_annotations(sites: DataFrame, concordance: dict[str, list[str]], vep: str = "vep") -> DataFrame:
    """Add ``rows``: array<struct<category, sub>> of the report rows a site belongs to.

    ``concordance`` maps a database name to the columns that show a match in it; rows are
    built for each database and for missing in all of them.
    """
    t, sub = F.lower(F.coalesce("allele_type", F.lit(""))), F.lower(F.coalesce("allele_subtype", F.lit("")))
    d = sites.withColumns({"_t": t, "_sub": sub, "_v": vep_label(vep) if vep in sites.columns else F.lit("Other"), "_e": effect_label(sites)})
    s, ty, e = F.col("_sub"), F.col("_t"), F.col("_e")

    def row(cat, subcat=ALL):
        return F.struct((cat if isinstance(cat, Column) else F.lit(cat)).alias("category"),
                        (subcat if isinstance(subcat, Column) else F.lit(subcat)).alias("sub"))

    me = {k: s.isin(f"{k.lower()}_ins", f"{k.lower()}_del") for k in ("ALU", "LINE", "SVA")}
    dup = {"Filtered Tandem": (s == "tandem_dup") & (ty == "dup"), "SVAN Tandem": (s == "tandem_dup") & (ty == "ins"),
           "Interspersed": s == "dup_interspersed", "Complex": s == "complex_dup", "Inverted": s == "inv_dup"}
    rules = [(F.lit(True), row(ALL)), (F.lit(True), row("VEP")), (F.lit(True), row("VEP", F.col("_v"))), (F.lit(True), row("Concordance")),
             (me["ALU"] | me["LINE"] | me["SVA"], row("ME")), *[(c, row("ME", k)) for k, c in me.items()],
             (s.isin("dup_interspersed", "complex_dup", "inv_dup") | dup["Filtered Tandem"] | dup["SVAN Tandem"], row("Duplication")),
             *[(c, row("Duplication", k)) for k, c in dup.items()], (s == "numt", row("NUMT")), (_present(sites, "tr_parsed"), row("TR Parsed")),
             (e.isNotNull(), row("SVAnnotate")), (e.isNotNull(), row("SVAnnotate", e))]
    hits = {db: _any([_present(sites, c) for c in cols]) for db, cols in concordance.items()}
    missing = {db: ~h for db, h in hits.items()}
    if len(hits) > 1:
        missing["/".join(hits)] = ~_any(list(hits.values()))
    for db, gone in missing.items():
        lab = f"{db} Missing"
        rules += [(gone, row("Concordance", lab)), (gone, row("Concordance", F.concat(F.lit(f"{lab} + "), "_v", F.lit(" (VEP)")))),
                  (gone & e.isNotNull(), row("Concordance", F.concat(F.lit(f"{lab} + "), "_e", F.lit(" (SVAnnotate)"))))]
    rows = F.filter(F.array(*[F.when(c, r) for c, r in rules]), lambda r: r.isNotNull())
    return d.withColumn("rows", rows).drop("_t", "_sub", "_v", "_e")


def _any(cols: list[Column]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | c
    return out


def carrier_weights(calls: DataFrame, key) -> DataFrame:
    """Carriers and alt alleles per site; sites without a carrier are left out."""
    n = g.n_alt("gt")
    w = calls.groupBy(*key).agg(F.count_if(n > 0).alias("carriers"), F.sum(F.greatest(n, F.lit(0))).cast("bigint").alias("alt_alleles"))
    return w.filter("carriers > 0")


def with_totals(df: DataFrame, regions: bool = True) -> DataFrame:
    """One row per status total: ``tr_status`` in All/TR/Not TR and ``region`` in All/known region."""
    tr = F.when(F.coalesce("tr_enveloped", F.lit(False)), "TR").otherwise("Not TR")
    out = df.withColumn("tr_status", F.explode(F.array(F.lit(ALL), tr)))
    if not regions:
        return out
    reg = F.when(F.col("region").isin(REGIONS), F.array(F.lit(ALL), F.col("region"))).otherwise(F.array(F.lit(ALL)))
    return out.withColumn("region", F.explode(reg))


def length_limits(df: DataFrame, minimum: int | None, maximum: int | None) -> DataFrame:
    """Signed allele length within the limits; an absent length fails any limit."""
    if maximum is not None:
        df = df.filter(F.col("allele_length") <= maximum)
    if minimum is not None:
        df = df.filter(F.col("allele_length") >= minimum)
    return df


def count_annotations(sites: DataFrame, weights: DataFrame, key, edges=SUMMARY_EDGES, regions: bool = True,
                      minimum: int | None = None, maximum: int | None = None) -> DataFrame:
    """Sites, carriers and alt alleles per category x sub category x TR status x region x bucket (long form).

    ``sites`` come from ``classify_annotations``, ``weights`` from ``carrier_weights``.
    """
    x = length_limits(sites, minimum, maximum).join(weights, list(key)).withColumn("bucket", size_column(edges))
    dims = ["category", "sub_category", "tr_status", *(["region"] if regions else []), "bucket"]
    # Sites with equal labels are summed first, so the explosions below run over label sets.
    labels = ["rows", "bucket", "tr_enveloped", *(["region"] if regions else [])]
    pre = x.groupBy(*labels).agg(F.count("*").alias("sites"), F.sum("carriers").alias("carriers"), F.sum("alt_alleles").alias("alt_alleles"))
    y = with_totals(pre, regions).withColumn("_r", F.explode("rows")).withColumns(
        {"category": F.col("_r.category"), "sub_category": F.col("_r.sub")})
    return y.groupBy(*dims).agg(*[F.sum(v).alias(v) for v in ("sites", "carriers", "alt_alleles")])


def pivot_buckets(counts: DataFrame, value: str, edges=SUMMARY_EDGES) -> DataFrame:
    """Wide report: one column per size bucket, zero where empty."""
    cols = ["SNV", *[f"DEL {x}" for x in size_labels(edges)], *[f"INS {x}" for x in size_labels(edges)], "TRV", "Other"]
    dims = [c for c in ("category", "sub_category", "tr_status", "region") if c in counts.columns]
    return counts.groupBy(*dims).pivot("bucket", cols).agg(F.sum(value)).fillna(0, cols)


def gene_buckets() -> Column:
    big = F.coalesce(F.col("allele_length") > 50000, F.lit(False))
    names = [("all", F.lit(True)), ("singleton", F.col("ac") == 1), ("ultra_rare", F.col("af") < 0.001), ("rare", F.col("af") < 0.01), ("common", F.col("af") > 0.05)]
    items = []
    for n, c in names:
        items += [F.when(c, F.lit(n)), F.when(c & big, F.lit(f"{n}_large"))]
    return F.filter(F.array(*items), lambda v: v.isNotNull())


def gene_counts(sites: DataFrame, weights: DataFrame, key) -> DataFrame:
    """Sites, carriers and alt alleles per gene and ``FIELD.bucket``."""
    fields = [f for f in GENE_FIELDS if f in sites.columns]
    genes = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("genes")) for f in fields])
    x = sites.join(weights, list(key)).withColumn("_b", gene_buckets()).withColumn("_f", F.explode(genes))
    x = x.withColumn("gene_name", F.explode("_f.genes")).withColumn("_b", F.explode("_b"))
    return x.groupBy("gene_name", F.concat_ws(".", "_f.f", "_b").alias("category")).agg(
        F.count("*").alias("sites"), F.sum("carriers").alias("carriers"), F.sum("alt_alleles").alias("alt_alleles"))


def merge_count_tables(tables: DataFrame, sample_counts: DataFrame, value="carriers") -> DataFrame:
    """Sum shard tables and divide by the (single) sample count; label sets that are zero everywhere go.

    ``sample_counts(shard, n)`` must agree between shards.
    """
    check = F.when(F.min("n") == F.max("n"), F.max("n")).otherwise(F.raise_error(F.lit("shards disagree on the number of samples")).cast("bigint"))
    n = sample_counts.agg(check.alias("n")).scalar()
    dims = [c for c in tables.columns if c not in ("shard", value)]
    out = tables.groupBy(*dims).agg(F.sum(value).alias(value)).filter(F.col(value) > 0)
    return out.withColumn(f"{value}_per_sample", F.col(value) / n)


def annotation_list(sites: DataFrame, weights: DataFrame, key, edges=SUMMARY_EDGES, vid="id") -> DataFrame:
    """Memberships per variant in long form: (id, classification, category, sub_category).

    A variant seen with two classifications is an error.
    """
    x = sites.join(weights, list(key), "left_semi").withColumn("_c", size_column(edges))
    agg = x.groupBy(vid).agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi"), F.array_distinct(F.flatten(F.collect_set("rows"))).alias("_rows"))
    bad = F.raise_error(F.concat(F.lit("two classifications for "), F.col(vid))).cast("string")
    agg = agg.withColumn("classification", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(bad))
    return agg.select(vid, "classification", F.explode("_rows").alias("_r")).select(
        vid, "classification", F.col("_r.category").alias("category"), F.col("_r.sub").alias("sub_category"))


def sample_counts(calls: DataFrame, sites: DataFrame, key, edges=PLOT_EDGES, af_edges=AF_EDGES, regions: bool = True) -> DataFrame:
    """Per sample: carried sites and alt alleles by size bucket or type x frequency bucket, TR status and region.

    ``matched`` sites have a database match. Calls are counted per label set before the
    totals are exploded; combinations nobody carries do not appear.
    """
    labels = sites.select(*key, size_column(edges).alias("_s"), af_column(af_edges).alias("_f"), F.coalesce("tr_enveloped", F.lit(False)).alias("tr_enveloped"),
                          *(["region"] if regions else []), F.coalesce("matched", F.lit(False)).alias("_m"))
    c = calls.withColumn("_n", g.n_alt("gt")).filter("_n > 0").select(*key, "sample", "_n").join(labels, list(key))
    dims = ["sample", "_s", "_f", "tr_enveloped", *(["region"] if regions else [])]
    pre = c.groupBy(*dims).agg(F.count("*").alias("sites"), F.sum("_n").alias("alleles"), F.count_if("_m").alias("matched"))
    y = with_totals(pre, regions).withColumn("bucket", F.explode(F.filter(F.array("_s", "_f"), lambda v: v.isNotNull())))
    return y.groupBy("sample", "bucket", "tr_status", *(["region"] if regions else [])).agg(
        *[F.sum(v).alias(v) for v in ("sites", "alleles", "matched")])


def variant_list(sites: DataFrame, calls: DataFrame, key) -> DataFrame:
    """Class, |length|, frequency and genotype numbers per site; repeats give one row per ALT with
    trimmed lengths. Only calls without any called allele are missing.

    ``af`` is a list by ALT or one number; of a list a repeat's ALT takes its own and other sites the first. One number
    says nothing about several ALTs: theirs come from the calls.
    """
    key = list(key)
    trv = F.lower("allele_type") == "trv"
    per_alt = F.when(trv, F.transform("alts", lambda a, i: F.struct((i + 1).alias("i"), a.alias("alt")))).otherwise(
        F.array(F.struct(F.lit(0).alias("i"), F.lit(None).cast("string").alias("alt"))))
    s = sites.withColumn("_p", F.explode(per_alt)).withColumns({"_i": F.col("_p.i"), "_alt": F.col("_p.alt")})
    s = s.withColumn("_t", F.when(F.col("_i") > 0, trim_alleles(F.lit(1), "ref", "_alt", "prefix_first", keep=0)))
    net = F.length("_t.alt") - F.length("_t.ref")
    cls = F.when(F.col("_i") == 0, F.col("allele_type")).when(net == 0, "TR_SNV").when(net > 0, "TR_INS").otherwise("TR_DEL")
    if dict(sites.dtypes)["af"].startswith("array"):
        own = F.get("af", F.greatest(F.col("_i") - 1, F.lit(0)))
    else:
        own = F.when((F.col("_i") == 0) | (F.size("alts") == 1), F.col("af"))
    s = s.select(*key, "_i", cls.alias("allele_class"), F.when(F.col("_i") == 0, F.coalesce("allele_length", F.lit(0))).otherwise(F.abs(net)).alias("svlen"), "region", own.alias("_af"))
    any_row = calls.join(s, key)
    none = g.all_null("gt")
    n = F.when(F.col("_i") == 0, g.n_alt("gt")).otherwise(F.size(F.filter("gt", lambda a: a == F.col("_i"))))
    agg = any_row.groupBy(*key, "_i", "allele_class", "svlen", "region", "_af").agg(
        F.count_if(~none & (n == 0)).alias("n_ref"), F.count_if(~none & (n == 1)).alias("n_het"), F.count_if(~none & (n > 1)).alias("n_hom"),
        F.count_if(none).alias("n_missing"), F.max(g.n_alt("gt")).alias("_any"))
    geno = F.col("n_ref") + F.col("n_het") + F.col("n_hom")
    af = F.coalesce("_af", F.when(F.col("_i") > 0, F.try_divide(F.col("n_het") + 2 * F.col("n_hom"), 2 * geno)))
    return agg.filter("_any > 0").select(*key, F.col("_i").alias("alt_index"), "allele_class", "svlen", af.alias("af"), "n_ref", "n_het", "n_hom", "n_missing", "region")


def trio_transmission(calls: DataFrame, sites: DataFrame, trios: DataFrame, key, edges=PLOT_EDGES, regions: bool = True) -> DataFrame:
    """Per child, bucket, TR status and region: carried, inherited and parental sites and alleles.

    Inherited alleles are shared between the parents in proportion to their copies. Calls are
    turned into one row per (site, trio) by tagging each call with the trios its sample is in,
    so no self join of the call table is needed.
    """
    key = list(key)
    roles = trios.select(F.col("sample").alias("child"), F.explode(F.array(
        F.struct(F.lit("c").alias("r"), F.col("sample").alias("s")), F.struct(F.lit("f").alias("r"), F.col("father").alias("s")),
        F.struct(F.lit("m").alias("r"), F.col("mother").alias("s")))).alias("_x")).select("child", F.col("_x.r").alias("role"), F.col("_x.s").alias("sample"))
    n = calls.withColumn("_n", g.n_alt("gt")).filter("_n > 0").select(*key, "sample", "_n").join(roles, "sample")
    t = n.groupBy(*key, "child").agg(*[F.coalesce(F.max(F.when(F.col("role") == r, F.col("_n"))), F.lit(0)).alias(r) for r in "cfm"])
    c, f, m = F.col("c"), F.col("f"), F.col("m")
    inh = c - F.greatest(F.lit(0), c - f - m)
    t = t.withColumns({
        "proband": (c > 0).cast("int"), "mendelian": ((c > 0) & (f + m > 0)).cast("int"), "paternal": ((c > 0) & (f > 0)).cast("int"),
        "maternal": ((c > 0) & (m > 0)).cast("int"), "paternal_total": (f > 0).cast("int"), "maternal_total": (m > 0).cast("int"),
        "proband_alleles": c, "mendelian_alleles": inh, "paternal_alleles": F.coalesce(F.try_divide(inh * f, f + m), F.lit(0.0)),
        "maternal_alleles": F.coalesce(F.try_divide(inh * m, f + m), F.lit(0.0)), "paternal_total_alleles": f, "maternal_total_alleles": m})
    vals = ["proband", "mendelian", "paternal", "maternal", "paternal_total", "maternal_total"]
    vals += [f"{v}_alleles" for v in vals]
    x = t.join(sites.select(*key, size_column(edges).alias("bucket"), "tr_enveloped", *(["region"] if regions else [])), key)
    pre = x.groupBy("child", "bucket", "tr_enveloped", *(["region"] if regions else [])).agg(*[F.sum(v).alias(v) for v in vals])
    return with_totals(pre, regions).groupBy("child", "bucket", "tr_status", *(["region"] if regions else [])).agg(*[F.sum(v).alias(v) for v in vals])


def evidence(entry: Column) -> Column:
    """struct(caller, ref_reads, alt_reads) of an evidence text ``caller_(ref_alt)``; NULL where it does not read so."""
    depths = r"_\(([0-9]+)_([0-9]+)\)$"
    n = lambda i: F.regexp_extract(entry, depths, i).cast("int")
    return F.when(entry.rlike("." + depths), F.struct(F.regexp_replace(entry, depths, "").alias("caller"), n(1).alias("ref_reads"), n(2).alias("alt_reads")))


def caller_gqs(regenotyper: str = "kanpig", expand_regenotyper: bool = False) -> Column:
    """array<struct<caller, gq>> of a call with ``gq``, ``bev`` and ``ev``: the call's own GQ without a best caller or with the
    re-genotyper as such; otherwise one for each evidence text, from that caller's own reads."""
    own = lambda name: F.when(F.col("gq").isNotNull(), F.array(F.struct(F.lit(name).alias("caller"), F.col("gq").cast("int").alias("gq"))))
    seen = F.filter(F.transform("ev", evidence), lambda e: e.isNotNull())
    each = F.transform(seen, lambda e: F.struct(e["caller"].alias("caller"), g.gq_from_pl(g.pl_from_ad(e["ref_reads"], e["alt_reads"])).alias("gq")))
    kept = F.col("bev") == regenotyper if not expand_regenotyper else F.lit(False)
    return F.when(F.col("bev").isNull(), own("no_caller")).when(kept, own(regenotyper)).otherwise(each)


def trio_gq_table(calls: DataFrame, sites: DataFrame, trios: DataFrame, key, edges=PLOT_EDGES, by_caller: bool = False) -> DataFrame:
    """Child het calls with both parents called, by bucket x GQ x TR (x caller): inherited and de novo.

    ``by_caller``: see ``caller_gqs`` (needs ``ev`` and ``bev``).
    """
    key = list(key)
    kid = calls.join(trios, "sample").filter(g.is_carrier("gt"))
    par = calls.filter(~g.has_null("gt")).select(*key, "sample", g.is_carrier("gt").alias("_p"))
    x = kid.join(par.withColumnsRenamed({"sample": "father", "_p": "_f"}), [*key, "father"]).join(
        par.withColumnsRenamed({"sample": "mother", "_p": "_m"}), [*key, "mother"])
    x = x.join(sites.select(*key, size_column(edges).alias("bucket"), F.coalesce("tr_enveloped", F.lit(False)).alias("tr")), key)
    dims = ["bucket", "gq", "tr"]
    if by_caller:
        x = x.withColumn("_c", F.explode(caller_gqs())).withColumns({"caller": F.col("_c.caller"), "gq": F.col("_c.gq")})
        dims.append("caller")
    inh = F.col("_f") | F.col("_m")
    return x.groupBy(*dims).agg(F.count_if(inh).alias("inherited"), F.count_if(~inh).alias("de_novo"))
