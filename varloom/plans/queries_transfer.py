"""Equi-join, annotation-transfer and genotype-transfer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import genotype as g
from ..operators import transfer as x
from .queries_rows import calls, filtered_sites
from .register import query


def gt_text(col="gt"):
    return F.array_join(F.transform(col, lambda a: F.coalesce(a.cast("string"), F.lit("."))), "/")


GT = "concat(coalesce(CAST({0} AS STRING), '.'), '/', coalesce(CAST({1} AS STRING), '.'))"
LONGER = "CASE WHEN brand_no % 4 = 3 AND length(ref) = 1 THEN concat(alt, 'A') ELSE alt END"
LOW = "CASE WHEN brand_no % 4 = 3 THEN concat(alt, 'A') ELSE alt END"


def truth_table(t):
    """Truth rows at the site's own place and id, so that 5-key joins meet."""
    return t.sql("SELECT s.chrom, s.pos, s.ref, t.alt, s.id, t.ac, t.an, t.brand_no, t.file_pos FROM truth t JOIN sites s USING (vid)")


@query("""
SELECT s.id, CASE WHEN t.alt = s.alt AND t.an > 230 AND s.allele_type <> 'snv' THEN t.ac * 10 WHEN t.alt = s.alt AND t.ac > 6 THEN t.ac END AS score
FROM sites s JOIN truth t USING (vid)
""")
def annotate_from_table(t):
    a = truth_table(t).withColumn("score", F.col("ac"))
    b = truth_table(t).withColumn("score", F.col("ac") * 10)
    s = t.sites.select("chrom", "pos", "ref", "alt", "id", "allele_type")
    return x.annotate_from_table(s, [a, b], [["score"], ["score"]], ["ac > 6", "an > 230"], [None, "allele_type <> 'snv'"]).select("id", "score")


@query("""
SELECT s.id, CASE WHEN t.alt = s.alt THEN t.ac END AS ac, s.alt FROM sites s JOIN truth t USING (vid) WHERE s.size <= 40
UNION ALL SELECT concat(id, 'r'), 0, 'R' FROM sites WHERE size > 40
""")
def clear_annotate_swap(t):
    s = t.sites.select("chrom", "pos", "ref", "alt", "id", F.col("qual").alias("ac"))
    rep = t.sites.filter("size > 40").select("chrom", "pos", "ref", F.lit("R").alias("alt"), F.concat("id", F.lit("r")).alias("id"),
                                             F.lit(0).alias("ac"), F.col("id").alias("original_id"))
    return x.clear_annotate_swap(s, ["ac"], truth_table(t), ["ac"], rep).select("id", "ac", "alt")


@query("""
SELECT id, CASE WHEN brand_no % 7 = 0 THEN 'line_del' WHEN brand_no % 3 = 0 THEN 'ALU_INS' WHEN brand_no % 2 = 0 THEN 'tandem_dup' ELSE allele_type END AS allele_type,
 CASE WHEN brand_no % 2 = 0 THEN CASE WHEN size > 25 THEN motif ELSE name END END AS origin,
 CASE WHEN brand_no % 7 = 0 THEN 'L1' WHEN brand_no % 3 = 0 THEN 'AluY' END AS sub_family FROM sites
""")
def annotate_allele_type(t):
    s = t.sites
    k = ["chrom", "pos", "ref", "alt", "id"]
    dups = s.filter("brand_no % 2 = 0").select(*k, F.lit("Tandem").alias("kind"), F.when(F.col("size") > 25, F.col("motif")).otherwise(".").alias("origin1"), F.col("name").alias("origin2"))
    meis = s.filter("brand_no % 3 = 0").select(*k, F.lit("ALU").alias("kind"), F.lit("AluY").alias("sub_family"))
    meds = s.filter("brand_no % 7 = 0").select(*k, F.lit("LINE").alias("kind"), F.lit("L1").alias("sub_family"))
    out = x.annotate_allele_type(s.select(*k, "allele_type"), dups, meis, meds, ("", "_dup", True), ("", "_INS", False), ("", "_del", True))
    return out.select("id", "allele_type", "origin", "sub_family")


@query("""
WITH m AS (SELECT s.id, max(t.id) AS truth_id, max(t.filter_text) AS f FROM sites s JOIN truth t USING (chrom, pos, ref, alt) GROUP BY s.id)
SELECT s.id, CASE WHEN m.id IS NOT NULL THEN 'EXACT' ELSE 'none' END AS match_type, m.truth_id, CASE WHEN m.f <> 'PASS' THEN m.f END AS truth_filter
FROM sites s LEFT JOIN m USING (id)
""")
def exact_match(t):
    truth = t.truth.withColumn("filters", F.split("filter_text", ";"))
    m, rest = x.exact_match(t.sites, truth)
    m = m.select("id", "match_type", "truth_id", "truth_filter")
    return m.unionByName(rest.select("id", F.lit("none").alias("match_type")), allowMissingColumns=True)


@query("""
SELECT id AS truth_id, ac AS "AC", an AS "AN", ac AS "AC_RMI", CAST(floor(trunc(an / 2.0 - size - (ac - 2 * size))) AS BIGINT) AS "N_HOMREF",
 CAST(ac - 2 * size AS BIGINT) AS "N_HET", CAST(size AS BIGINT) AS "N_HOMALT" FROM truth
""")
def append_truth_counts(t):
    tr = t.truth.select("id", F.col("ac").alias("AC"), F.col("ac").alias("AC_remaining"), F.col("an").alias("AN"), F.col("size").alias("nhomalt"))
    m = t.truth.select(F.col("id").alias("truth_id"))
    return x.append_truth_counts(m, tr).select("truth_id", "AC", "AN", "AC_RMI", "N_HOMREF", "N_HET", "N_HOMALT")


@query("""SELECT id, qual AS score, CAST(NULL AS INT) AS ac, CAST(NULL AS INT) AS an FROM sites
UNION ALL SELECT id, NULL, ac, an FROM truth""")
def unify_annotation_tables(t):
    return x.unify_annotation_tables([t.sites.select("id", F.col("qual").alias("score")), t.truth.select("id", "an", "ac")])


@query("""
SELECT coalesce(s.chrom, u.chrom) AS chrom, coalesce(s.pos, u.pos) AS pos, coalesce(s.ref, u.ref) AS ref, coalesce(s.alt, u.alt) AS alt,
 coalesce(u.score, s.score) AS score, s.a, u.b FROM
(SELECT chrom, pos, ref, alt, max(CASE WHEN size > 20 THEN qual END) AS score, max(brand_no) AS a FROM sites GROUP BY chrom, pos, ref, alt) s
FULL OUTER JOIN (SELECT chrom, pos, ref, alt, max(CASE WHEN size > 10 THEN ac END) AS score, max(an) AS b FROM truth GROUP BY chrom, pos, ref, alt) u
USING (chrom, pos, ref, alt)
""")
def merge_annotation_tables(t):
    k = ["chrom", "pos", "ref", "alt"]
    a = t.sites.groupBy(*k).agg(F.max(F.when(F.col("size") > 20, F.col("qual"))).alias("score"), F.max("brand_no").alias("a"))
    b = t.truth.groupBy(*k).agg(F.max(F.when(F.col("size") > 10, F.col("ac"))).alias("score"), F.max("an").alias("b"))
    return x.merge_annotation_tables([a, b], k)


@query("SELECT id, CAST(size > 10 AS INT) AS big, brand_no FROM sites")
def extract_new_annotations(t):
    new = t.sites.select("id", "qual", "brand_no", (F.col("size") > 10).alias("big"))
    return x.extract_new_annotations(new, t.sites.select("id", "qual"), ["id"])


@query("""
SELECT s.id, arg_max(d.id, d.file_pos) AS dbsnp_id FROM sites s JOIN (SELECT chrom, pos, ref, alt, id, file_pos FROM truth UNION ALL
 SELECT chrom, pos, ref, concat(alt, 'T'), id, file_pos FROM truth) d USING (chrom, pos, ref, alt) GROUP BY s.id
""")
def annotate_dbsnp(t):
    tr = t.truth.withColumn("alt", F.concat_ws(",", "alt", F.concat("alt", F.lit("T"))))
    return x.annotate_dbsnp(t.sites, tr).select("id", "dbsnp_id")


@query("""
WITH a AS (SELECT chrom, pos, ref, alt, max(ac) AS cadd FROM truth GROUP BY chrom, pos, ref, alt),
b AS (SELECT chrom, pos, max(an) AS phylop FROM truth GROUP BY chrom, pos)
SELECT s.id, a.cadd, b.phylop FROM sites s LEFT JOIN a USING (chrom, pos, ref, alt) LEFT JOIN b USING (chrom, pos) WHERE coalesce(a.cadd, b.phylop) IS NOT NULL
""")
def annotate_predictors(t):
    tr = t.truth
    out = x.annotate_predictors(t.sites, {"cadd": tr.withColumn("score", F.col("ac"))}, {"phylop": tr.withColumn("score", F.col("an"))})
    return out.select("id", "cadd", "phylop")


def half(t, view="genotypes2"):
    """The second call set without its calls below GQ 30."""
    return calls(t, view).filter("gq >= 30")


J = "FROM genotypes a LEFT JOIN (SELECT * FROM genotypes2 WHERE gq >= 30) b USING (vid, sample_id)"


@query(f"""
SELECT vid, sample_id AS sample, CASE WHEN (a.a0 IS NULL OR a.a1 IS NULL) AND coalesce(a.a0, 0) = 0 AND coalesce(a.a1, 0) = 0 AND b.gq IS NOT NULL THEN {GT.format('b.a0', 'b.a1')} ELSE {GT.format('a.a0', 'a.a1')} END AS gt,
 CASE WHEN b.gq IS NOT NULL THEN b.gq ELSE a.gq END AS gq, CASE WHEN b.gq IS NOT NULL THEN b.ad_alt ELSE a.ad_alt END AS ad_alt {J}
""")
def fill_phased_genotypes(t):
    out = x.fill_phased_genotypes(calls(t), half(t), ("ad", "gq"), ("vid", "sample"))
    return out.select("vid", "sample", gt_text().alias("gt"), "gq", F.element_at("ad", 2).alias("ad_alt"))


@query(f"""
SELECT vid, sample_id AS sample, CASE WHEN b.gq IS NOT NULL AND (a.a0 > 0 OR a.a1 > 0) THEN b.ad_ref ELSE a.ad_ref END AS ad_ref, false AS phased {J}
""")
def fill_format_fields(t):
    out = x.fill_format_fields(calls(t), half(t), ["vid", "sample"], ("ad",), only_alt=True, unphase=True)
    return out.select("vid", "sample", F.element_at("ad", 1).alias("ad_ref"), "phased")


@query(f"""
SELECT vid, sample_id AS sample, CASE WHEN b.gq IS NOT NULL AND a.a0 <> a.a1 THEN {GT.format('b.a0', 'b.a1')} ELSE {GT.format('a.a0', 'a.a1')} END AS gt,
 CASE WHEN v.vid IS NULL THEN false WHEN b.gq IS NOT NULL AND a.a0 <> a.a1 THEN b.phased ELSE a.phased END AS phased {J}
 LEFT JOIN (SELECT DISTINCT vid FROM genotypes2 WHERE gq >= 30) v USING (vid)
""")
def transfer_genotypes(t):
    return x.transfer_genotypes(calls(t), half(t), ["vid"]).select("vid", "sample", gt_text().alias("gt"), "phased")


def id_calls(t, view):
    """Calls with ids, types and a two-ALT list whose order differs between the sets."""
    c = half(t, view) if view == "genotypes2" else calls(t, view)
    alts = F.array(F.concat("alt", F.lit("T")), F.lower("alt")) if view == "genotypes2" else F.array("alt", F.concat("alt", F.lit("t")))
    c = c.join(t.sites.select("vid", "id", "allele_type", alts.alias("alts")), "vid")
    if view == "genotypes2":
        c = c.withColumn("gt", F.transform("gt", lambda a: F.when(a == 1, 2).otherwise(a)))
    return c.withColumn("pf", F.col("gq"))


@query(f"""
SELECT s.id, sample_id AS sample, CASE WHEN b.gq IS NOT NULL AND a.a0 <> a.a1 THEN {GT.format('b.a0', 'b.a1')}
  WHEN b.gq IS NULL AND s.allele_type = 'trv' AND NOT (coalesce(a.a0, 9) = 0 AND coalesce(a.a1, 9) = 0) THEN './.' ELSE {GT.format('a.a0', 'a.a1')} END AS gt,
 CASE WHEN b.gq IS NOT NULL THEN b.ps WHEN s.allele_type = 'trv' AND NOT (coalesce(a.a0, 9) = 0 AND coalesce(a.a1, 9) = 0) THEN NULL ELSE a.ps END AS ps
{J} JOIN sites s USING (vid)
""")
def replace_sample_calls(t):
    out = x.replace_sample_calls(id_calls(t, "genotypes"), id_calls(t, "genotypes2"))
    return out.select("id", "sample", gt_text().alias("gt"), "ps")


@query(f"""
WITH j AS (SELECT vid, sample_id, abs(s.allele_length) >= 300 AND coalesce(a.a0, 0) + coalesce(a.a1, 0) > 0 AS asked, b.gq IS NOT NULL AS hit,
  coalesce(a.a0, 0) + coalesce(a.a1, 0) = coalesce(b.a0, 0) + coalesce(b.a1, 0) AS same {J} JOIN sites s USING (vid))
SELECT sample_id AS sample, CAST(count(*) FILTER (asked) AS BIGINT) AS variant_count, CAST(count(*) FILTER (asked AND hit) AS BIGINT) AS variant_match_count,
 CAST(count(*) FILTER (asked AND hit AND same) AS BIGINT) AS variant_call_match_count FROM j GROUP BY sample_id
""")
def replace_caller_ad_counts(t):
    c = calls(t).join(t.sites.select("vid", "allele_length"), "vid").withColumn("pl", F.array().cast("array<int>"))
    return x.replace_caller_ad(c, half(t), 300, ("vid", "sample"))[1]


PLS = """(SELECT *, CASE WHEN r + a = 0 THEN 0 ELSE CAST(round_even(-10 * (l0 - best), 0) AS INT) END AS p0, CASE WHEN r + a = 0 THEN 0 ELSE CAST(round_even(-10 * (l1 - best), 0) AS INT) END AS p1,
 CASE WHEN r + a = 0 THEN 0 ELSE CAST(round_even(-10 * (l2 - best), 0) AS INT) END AS p2 FROM (SELECT *, greatest(l0, l1, l2) AS best FROM
 (SELECT vid, sample_id, ad_ref AS r, ad_alt AS a, ad_alt * log10(0.05) + ad_ref * log10(0.95) AS l0, ad_alt * log10(0.5) + ad_ref * log10(0.5) AS l1,
  ad_alt * log10(0.95) + ad_ref * log10(1.0 - 0.95) AS l2 FROM {0}) q) q2)"""


@query("WITH p AS " + PLS.format("genotypes") + """
SELECT vid, sample_id AS sample, concat(CAST(p0 AS STRING), ',', CAST(p1 AS STRING), ',', CAST(p2 AS STRING)) AS pl,
 least(p0 + p1 + p2 - least(p0, p1, p2) - greatest(p0, p1, p2), 99) AS gq FROM p
""")
def pl_from_ad(t):
    c = calls(t).withColumn("pl", g.pl_from_ad(F.element_at("ad", 1), F.element_at("ad", 2)))
    return c.select("vid", "sample", F.array_join(F.transform("pl", lambda v: v.cast("string")), ",").alias("pl"), g.gq_from_pl("pl").alias("gq"))


@query(f"""
WITH j AS (SELECT vid, sample_id, s.chrom, m.sex = 'male' AS male, a.a0, a.a1, coalesce(a.a0, 0) > 0 OR coalesce(a.a1, 0) > 0 AS called,
  coalesce(b.a0, 0) > 0 OR coalesce(b.a1, 0) > 0 AS oc, b.a0 IS NULL AND b.a1 IS NULL AS om, a.ad_ref AS ar, b.ad_ref AS br
  {J} JOIN sites s USING (vid) JOIN samples m USING (sample_id)),
k AS (SELECT *, NOT called AND (om OR oc OR (NOT male AND chrom = 'chrY')) AS wipe, NOT called AND NOT oc AND NOT om AND NOT (NOT male AND chrom = 'chrY') AS fill,
  male AND chrom IN ('chrX', 'chrY') AS hemi FROM j),
n AS (SELECT *, CASE WHEN wipe THEN NULL WHEN fill THEN 0 ELSE a0 END AS n0, CASE WHEN wipe THEN NULL WHEN fill AND hemi THEN NULL WHEN fill THEN 0 ELSE a1 END AS n1 FROM k)
SELECT vid, sample_id AS sample, CASE WHEN wipe THEN NULL WHEN fill THEN br ELSE ar END AS ad_ref, CASE WHEN n0 IS NULL THEN {GT.format('n1', 'n0')}
 WHEN n1 IS NULL OR n0 <= n1 THEN {GT.format('n0', 'n1')} ELSE {GT.format('n1', 'n0')} END AS gt FROM n
""")
def merge_regenotypes(t):
    k = t.sites.select("vid", "chrom")
    sex = t.samples.select(F.col("sample_id").alias("sample"), F.when(F.col("sex") == "male", "M").otherwise("F").alias("sex"))
    base = calls(t).withColumn("pl", F.array(F.lit(0), F.lit(0), F.lit(0)))
    out = x.merge_regenotypes(base, half(t), sex, ["vid"], sites=k)
    return out.select("vid", "sample", F.element_at("ad", 1).alias("ad_ref"), gt_text().alias("gt"))


@query(f"""
WITH j AS (SELECT sample_id, a.a0 <> a.a1 AS het, NOT a.phased AS un, b.phased AND b.gq IS NOT NULL AS ok {J})
SELECT sample_id AS sample, CAST(count(*) FILTER (het) AS BIGINT) AS n_het, CAST(count(*) FILTER (het AND un) AS BIGINT) AS n_het_unphased,
 CAST(count(*) FILTER (het AND un AND NOT coalesce(ok, false)) AS BIGINT) AS n_het_unphased_post_pull,
 round(coalesce(count(*) FILTER (het AND un) / nullif(count(*) FILTER (het), 0), 0), 6) AS prop_het_unphased,
 round(coalesce(count(*) FILTER (het AND un AND NOT coalesce(ok, false)) / nullif(count(*) FILTER (het), 0), 0), 6) AS prop_het_unphased_post_pull
FROM j GROUP BY sample_id
""")
def pull_phased_genotypes(t):
    c = x.pull_phased_genotypes(calls(t), half(t), ("vid", "sample"))[1]
    return c.withColumns({k: F.round(k, 6) for k in c.columns if k.startswith("prop_")})


@query("SELECT a.vid, a.sample_id AS sample, b.ps FROM genotypes a LEFT JOIN (SELECT * FROM genotypes2 WHERE gq >= 30) b USING (vid, sample_id)")
def attach_phase_sets(t):
    return x.attach_phase_sets(calls(t), half(t).select("vid", "sample", "ps"), ("vid", "sample")).select("vid", "sample", "ps")


@query("SELECT s.id, t.source AS tr_source FROM sites s LEFT JOIN (SELECT motif AS m, max(name) AS source FROM sites GROUP BY motif) t ON s.motif = t.m")
def tag_tr_source(t):
    s = t.sites.select("id", F.col("motif").alias("trid"))
    return x.tag_tr_source(s, t.sites.select(F.col("motif").alias("trid"), F.col("name").alias("tr_source"))).select("id", "tr_source")


@query("""
SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY motif, pos ORDER BY file_pos) AS n FROM sites s
 WHERE EXISTS (SELECT 1 FROM truth t WHERE t.motif = s.motif AND t.pos = s.pos)) q WHERE n = 1
""")
def subset_to_catalog(t):
    s = t.sites.withColumnRenamed("motif", "trid")
    return x.subset_to_catalog(s, t.truth.withColumnRenamed("motif", "trid")).select("id")


@query("""
SELECT id FROM sites WHERE allele_type = 'line_ins' OR (allele_type IN ('alu_ins', 'sva_ins') AND (brand_no % 2 = 0 OR size > 40))
""")
def consolidate_meis(t):
    k = ["chrom", "pos", "ref", "alt", "id"]
    s = t.sites.filter("allele_type IN ('alu_ins', 'sva_ins', 'line_ins')").withColumn("me_type", F.upper(F.regexp_replace("allele_type", "_ins", "")))
    pal = s.filter("brand_no % 2 = 0")
    svan = s.filter("size > 40").withColumn("me_type", F.lower("me_type"))
    return x.consolidate_meis(s.select(*k, "me_type"), pal, svan).select("id")


@query("""
SELECT s.id, CASE s.brand_no % 3 WHEN 0 THEN 'ALU' WHEN 1 THEN 'SVA' ELSE 'LINE' END AS me_type, s.name AS sub_family
FROM sites s WHERE s.size % 3 <> 2
""")
def classify_l1meaid(t):
    c = t.sites.select("chrom", "pos", "ref", "alt", F.col("name").alias("sub_family"),
                       F.when(F.col("brand_no") % 3 == 0, "SINE/Alu").when(F.col("brand_no") % 3 == 1, "Retroposon/SVA").otherwise("LINE/L1").alias("classification"),
                       F.when(F.col("size") % 3 == 0, "INTACT").when(F.col("size") % 3 == 1, "INTACT_3end").otherwise("PARTIAL").alias("structure"))
    return x.classify_l1meaid(c, t.sites).select("id", "me_type", "sub_family")


def ped(t):
    """A pedigree over all customers: parents are the next two keys; key 0 stands for none."""
    return t.customer.select(F.col("c_custkey").cast("string").alias("sample"), (F.col("c_custkey") + 1).cast("string").alias("father"),
                             F.when(F.col("c_nationkey") < 3, "0").otherwise((F.col("c_custkey") + 2).cast("string")).alias("mother"), "c_mktsegment")


@query("""
WITH k AS (SELECT DISTINCT o_custkey AS c FROM orders)
SELECT CAST(c_custkey AS STRING) AS sample, CAST(c_custkey + 1 AS STRING) AS father, CAST(c_custkey + 2 AS STRING) AS mother FROM customer
WHERE c_nationkey >= 3 AND c_custkey IN (SELECT c FROM k) AND c_custkey + 1 IN (SELECT c FROM k) AND c_custkey + 2 IN (SELECT c FROM k)
""")
def find_trios(t):
    return x.find_trios(ped(t), t.orders.select(F.col("o_custkey").cast("string").alias("sample")))


@query("""
WITH a AS (SELECT c_custkey AS s, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 0
  WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 1 ELSE -1 END AS truth_index FROM customer)
SELECT s AS sample, truth_index FROM a
""")
def assign_samples_to_truth(t):
    o = t.orders.withColumn("sample", F.col("o_custkey"))
    got, missing = x.assign_samples_to_truth(t.customer.select(F.col("c_custkey").alias("sample")),
                                             [o.filter("o_orderstatus = 'P'"), o.filter("o_orderpriority = '1-URGENT'")])
    return got.unionByName(missing.withColumn("truth_index", F.lit(-1)))


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS s FROM orders WHERE o_orderstatus = 'P'), b AS (SELECT DISTINCT o_custkey AS s FROM orders WHERE o_orderstatus = 'F')
SELECT coalesce(a.s, b.s) AS sample, CASE WHEN b.s IS NULL THEN 'only_a' WHEN a.s IS NULL THEN 'only_b' ELSE 'common' END AS side FROM a FULL OUTER JOIN b ON a.s = b.s
""")
def compare_sample_lists(t):
    o = t.orders.withColumn("sample", F.col("o_custkey"))
    return x.compare_sample_lists(o.filter("o_orderstatus = 'P'"), o.filter("o_orderstatus = 'F'"))


@query("SELECT c_custkey AS sample, 'only_a' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def check_sample_consistency(t):
    return x.check_sample_consistency(t.customer.select(F.col("c_custkey").alias("sample")), t.orders.select(F.col("o_custkey").alias("sample")))


@query("SELECT s.id, s.name AS vep, t.ac AS af FROM sites s JOIN truth t USING (vid)")
def merge_vep_af(t):
    af = t.truth.select(F.concat(F.lit("V"), F.col("vid").cast("string")).alias("id"), F.col("ac").alias("af"))
    return x.merge_vep_af(t.sites.select("id", F.col("name").alias("vep")), af, ["vep"], ["af"], ["id"])


@query("SELECT s.id, CASE WHEN abs(s.allele_length) >= 50 THEN t.ac ELSE s.qual END AS score FROM sites s JOIN truth t USING (vid)")
def merge_by_position(t):
    lng = t.truth.select(F.concat(F.lit("V"), F.col("vid").cast("string")).alias("id"), F.col("ac").alias("score"))
    return x.merge_by_position(t.sites.select("id", "allele_length", F.col("qual").alias("score")), lng, ["score"], ["id"]).select("id", "score")


@query("""
WITH m AS (SELECT chrom, ref, alt, arg_max(pos, file_pos) AS pos FROM truth GROUP BY chrom, ref, alt)
SELECT s.id, m.pos AS pos, s.pos - 1 AS st, s.pos - 1 + length(s.ref) AS en FROM sites s JOIN m ON s.chrom = m.chrom AND s.ref = m.ref AND s.alt = m.alt
""")
def liftover_by_table(t):
    bed = x.sites_to_liftover_bed(t.sites).select("id", F.col("start").alias("st"), F.col("end").alias("en"))
    return x.liftover_by_table(t.sites, t.truth.withColumn("new_pos", F.col("pos"))).select("id", "pos").join(bed, "id")


@query("SELECT id, CASE WHEN size > 20 AND brand_no > 10 THEN '1/1' WHEN size > 20 OR brand_no > 10 THEN '0/1' ELSE '0/0' END AS gt FROM sites")
def combine_haplotypes(t):
    s = t.sites.withColumns({"maternal": F.col("size") > 20, "paternal": F.col("brand_no") > 10})
    return x.combine_haplotypes(s).select("id", "gt")


# A small set of samples keeps sites x samples readable: nations stand in for samples.
NAT = "SELECT l_partkey AS vid, s_nationkey AS sample, max(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END) AS a0, max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS a1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_tax {0} GROUP BY l_partkey, s_nationkey"


@query(f"""
WITH a AS ({NAT.format('< 0.04')}), b AS ({NAT.format('>= 0.04')}),
v AS (SELECT vid, CAST(count(*) AS BIGINT) AS merge_count FROM (SELECT DISTINCT vid FROM a UNION ALL SELECT DISTINCT vid FROM b) q GROUP BY vid)
SELECT v.vid, n_nationkey AS sample, merge_count, CASE WHEN a.a0 IS NOT NULL THEN {GT.format('a.a0', 'a.a1')} WHEN b.a0 IS NOT NULL THEN {GT.format('b.a0', 'b.a1')} ELSE '0/0' END AS gt
FROM v CROSS JOIN nation LEFT JOIN a ON a.vid = v.vid AND a.sample = n_nationkey LEFT JOIN b ON b.vid = v.vid AND b.sample = n_nationkey
""")
def merge_cohort(t):
    a, b = (t.sql(NAT.format(w)).select("vid", "sample", F.array("a0", "a1").alias("gt")) for w in ("< 0.04", ">= 0.04"))
    return x.merge_cohort([a, b], t.nation.select(F.col("n_nationkey").alias("sample")), site_key=["vid"]).withColumn("gt", gt_text())


@query(f"""
WITH u AS (SELECT 0 AS st, g.sample, s.chrom, s.pos, s.ref, s.alt, s.file_pos, g.a0, g.a1 FROM ({NAT.format('< 0.04')}) g JOIN sites s USING (vid)
 UNION ALL SELECT 1, g.sample, s.chrom, s.pos, s.ref, {LOW}, s.file_pos, g.a0, g.a1 FROM ({NAT.format('>= 0.04')}) g JOIN sites s USING (vid)),
o AS (SELECT chrom, pos, ref, alt, min(st * 100000000 + file_pos) AS o FROM u GROUP BY chrom, pos, ref, alt),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY chrom, pos, ref ORDER BY o) AS INT) AS i FROM o),
l AS (SELECT chrom, pos, ref, string_agg(alt, ',' ORDER BY i) AS alts FROM n GROUP BY chrom, pos, ref)
SELECT u.chrom, u.pos, u.ref, l.alts, u.sample, concat(CAST(max(CASE WHEN a0 > 0 THEN i ELSE a0 END) AS STRING), '/', CAST(max(CASE WHEN a1 > 0 THEN i ELSE a1 END) AS STRING)) AS gt
FROM u JOIN n USING (chrom, pos, ref, alt) JOIN l ON l.chrom = u.chrom AND l.pos = u.pos AND l.ref = u.ref GROUP BY u.chrom, u.pos, u.ref, l.alts, u.sample
""")
def merge_cohort_multiallelic(t):
    k = ["chrom", "pos", "ref", "alt", "file_pos"]
    sets = []
    for w, alt in (("< 0.04", F.col("alt")), (">= 0.04", F.expr(LOW))):
        s = t.sites.withColumn("alt", alt).select("vid", *k)
        sets.append(t.sql(NAT.format(w)).join(s, "vid").select("sample", F.array("a0", "a1").alias("gt"), *k))
    return x.merge_cohort_multiallelic(sets).select("chrom", "pos", "ref", F.array_join("alts", ",").alias("alts"), "sample", gt_text().alias("gt"))


@query("SELECT chrom, pos, ref, alt FROM sites UNION SELECT chrom, pos, ref, alt FROM truth")
def concat_shards(t):
    k = ["chrom", "pos", "ref", "alt"]
    return x.concat_shards([t.sites.select(*k), t.truth.select(*k)], drop_exact_dups=True)


@query("SELECT chrom, pos, id, ac FROM truth UNION ALL SELECT chrom, pos, id, NULL FROM sites")
def concat_tsvs(t):
    return x.concat_tsvs([t.truth.select("chrom", "pos", "id", "ac"), t.sites.select("chrom", "pos", "id")])


@query(f"""
WITH a AS (SELECT vid, chrom, pos, ref, alt, file_pos, CASE WHEN length(alt) = length(ref) THEN 'snv' WHEN length(alt) > length(ref) THEN 'ins' ELSE 'del' END AS ty, length(alt) - length(ref) AS n FROM sites),
b AS (SELECT vid, chrom, pos, ref, {LONGER} AS alt, file_pos, CASE WHEN length({LONGER}) = length(ref) THEN 'snv' WHEN length({LONGER}) > length(ref) THEN 'ins' ELSE 'del' END AS ty, length({LONGER}) - length(ref) AS n FROM sites),
u AS (SELECT vid, chrom, pos, ref, alt, ty, n, 'small' AS source, CASE WHEN abs(n) >= 30 THEN 'LARGE_INDEL' ELSE 'PASS' END AS filters, file_pos * 2 AS o FROM a
   WHERE NOT (abs(n) >= 30 AND (chrom, pos, ref, alt) IN (SELECT (chrom, pos, ref, alt) FROM b))
  UNION ALL SELECT vid, chrom, pos, ref, alt, ty, n, 'sv', CASE WHEN abs(n) < 30 THEN 'SMALL_SV' ELSE 'PASS' END, file_pos * 2 + 1 FROM b),
i AS (SELECT *, CASE WHEN ty = 'snv' THEN concat(chrom, '-', CAST(pos AS STRING), '-', substr(ref, 1, 1), '-', substr(alt, 1, 1)) ELSE concat(chrom, '-', CAST(pos AS STRING), '-', upper(ty), '-', CAST(abs(n) AS STRING)) END AS base FROM u)
SELECT vid, source, filters, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN concat(base, '_', CAST(row_number() OVER (PARTITION BY base ORDER BY o) AS STRING)) ELSE base END AS id FROM i
""")
def integrate_callsets(t):
    a = filtered_sites(t).select("vid", "chrom", "pos", "ref", F.array("alt").alias("alts"), F.array(F.lit("PASS")).alias("filters"), "file_pos")
    b = filtered_sites(t).select("vid", "chrom", "pos", "ref", F.array(F.expr(LONGER)).alias("alts"), F.array(F.lit("PASS")).alias("filters"), "file_pos")
    return x.integrate_callsets(a, b, size=30).select("vid", "source", F.array_join("filters", ";").alias("filters"), "id")


@query("""
WITH a AS (SELECT doc_id, text FROM documents WHERE lang <> 'fr'), b AS (SELECT doc_id, CASE WHEN n_chars > 1000 THEN reverse(text) WHEN source = 'src0' THEN concat(text, 'x') ELSE text END AS text FROM documents WHERE source <> 'src1')
SELECT CAST(count(*) FILTER (a.text IS NOT NULL AND b.text IS NOT NULL) AS BIGINT) AS n_shared, CAST(count(*) FILTER (b.text IS NULL) AS BIGINT) AS n_only_a,
 CAST(count(*) FILTER (a.text IS NULL) AS BIGINT) AS n_only_b, CAST(count(*) FILTER (length(a.text) = length(b.text)) AS BIGINT) AS n_same_length,
 CAST(count(*) FILTER (md5(a.text) = md5(b.text)) AS BIGINT) AS n_same_sequence FROM a FULL OUTER JOIN b USING (doc_id)
""")
def compare_reads(t):
    a = t.documents.filter("lang <> 'fr'").select(F.col("doc_id").alias("read"), F.col("text").alias("seq"))
    alt = F.when(F.col("n_chars") > 1000, F.reverse("text")).when(F.col("source") == "src0", F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    b = t.documents.filter("source <> 'src1'").select(F.col("doc_id").alias("read"), alt.alias("seq"))
    return x.compare_reads(a, b)


@query("SELECT d.doc_id AS read, l.quality AS mm, l.toxic AS ml FROM documents d LEFT JOIN labels l USING (doc_id)")
def transfer_read_tags(t):
    src = t.labels.select(F.col("doc_id").alias("read"), F.col("quality").alias("mm"), F.col("toxic").alias("ml"))
    return x.transfer_read_tags(t.documents.select(F.col("doc_id").alias("read")), src)


@query("""SELECT s.id, t.id AS truth_id, concat('SIZE=', CAST(s.size AS STRING)) AS eval_info, concat('AC=', CAST(t.ac AS STRING)) AS truth_info
FROM sites s JOIN truth t USING (chrom, pos, ref, alt)""")
def matched_info_pairs(t):
    s = t.sites.withColumn("info", F.concat(F.lit("SIZE="), F.col("size").cast("string")))
    tr = t.truth.withColumn("info", F.concat(F.lit("AC="), F.col("ac").cast("string")))
    k = ["chrom", "pos", "ref", "alt"]
    m = t.sites.select("id", *k).join(t.truth.select(F.col("id").alias("truth_id"), *k), k)
    return x.matched_info_pairs(m, s, tr)
