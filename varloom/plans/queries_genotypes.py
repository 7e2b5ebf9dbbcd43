"""Per-site statistics, histograms, ploidy and phasing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import genotype as g
from ..operators import genotypes as q, phasing as ph
from .queries_rows import calls
from .queries_transfer import GT, PLS, gt_text, half
from .fixtures import ERFC
from .register import query


def rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def people(t):
    return t.samples.select(F.col("sample_id").alias("sample"), "population", "sex")


def site_calls(t, view="genotypes"):
    s = t.sites.select("vid", "id", "chrom", "pos", "ref", "alt", "allele_type", "allele_length", "qual", "file_pos")
    return calls(t, view).join(s, "vid")


def pl_calls(t):
    return calls(t).withColumns({"pl": g.pl_from_ad(F.element_at("ad", 1), F.element_at("ad", 2)), "n_alts": F.lit(1)})


BINOM = """CASE WHEN 2 * ad_ref = ad_ref + ad_alt THEN 1.0 ELSE least(1.0, 2 * list_sum(list_transform(generate_series(0, least(ad_ref, ad_alt)),
  lambda i: exp(lgamma(ad_ref + ad_alt + 1) - lgamma(i + 1) - lgamma(ad_ref + ad_alt - i + 1) - (ad_ref + ad_alt) * ln(2))))) END"""


@query("WITH p AS " + PLS.format("genotypes") + f""",
c AS (SELECT g.*, p.p0, g.a0 + g.a1 AS n, CASE WHEN g.a0 + g.a1 = 1 AND ad_ref + ad_alt > 0 THEN {BINOM} END AS pab
  FROM genotypes g JOIN p USING (vid, sample_id) WHERE g.a0 IS NOT NULL AND g.a1 IS NOT NULL),
s AS (SELECT vid, sum(CASE WHEN n > 0 THEN ad_ref + ad_alt END) AS as_vardp, sum(CASE WHEN n > 0 THEN p0 END) AS as_qualapprox,
 avg(CASE WHEN n > 0 AND ad_alt > 0 THEN p0 / ad_alt END) AS qd, max(pab) AS pab, count(*) FILTER (n = 0) AS r, count(*) FILTER (n = 1) AS h, count(*) FILTER (n = 2) AS a, count(*) AS t FROM c GROUP BY vid),
e AS (SELECT *, (2.0 * r + h) / (2.0 * t) AS f FROM s),
x AS (SELECT *, 2.0 * f * (1 - f) * t AS eh, f * f * t AS er, (1 - f) * (1 - f) * t AS ea FROM e)
SELECT vid, CAST(as_vardp AS BIGINT) AS as_vardp, CAST(as_qualapprox AS BIGINT) AS as_qualapprox, round_even(qd, 6) AS as_qd, round(round_even(pab, 6), 4) AS as_pab_max,
 CASE WHEN eh > 0 THEN round(round_even(1 - h / eh, 6), 4) ELSE 0.0 END AS inbreeding_coeff,
 round(CASE WHEN er > 0 THEN (r - er) * (r - er) / er ELSE 0 END + CASE WHEN eh > 0 THEN (h - eh) * (h - eh) / eh ELSE 0 END + CASE WHEN ea > 0 THEN (a - ea) * (a - ea) / ea ELSE 0 END, 3) AS hwe_chi2 FROM x
""")
def site_quality(t):
    s = q.site_quality(pl_calls(t), ["vid"])
    return s.select("vid", "as_vardp", "as_qualapprox", "as_qd", *[F.round(c, 4).alias(c) for c in ("as_pab_max", "inbreeding_coeff")], F.round("hwe_chi2", 3).alias("hwe_chi2"))


@query(f"""
WITH s AS (SELECT vid, count(*) FILTER (a0 + a1 = 0) AS r, count(*) FILTER (a0 + a1 = 1) AS h, count(*) FILTER (a0 + a1 = 2) AS a, count(*) AS t FROM genotypes WHERE a0 IS NOT NULL AND a1 IS NOT NULL GROUP BY vid),
e AS (SELECT *, (2.0 * r + h) / (2.0 * t) AS f FROM s), x AS (SELECT *, 2.0 * f * (1 - f) * t AS eh, f * f * t AS er, (1 - f) * (1 - f) * t AS ea FROM e),
c AS (SELECT vid, CASE WHEN er > 0 THEN (r - er) * (r - er) / er ELSE 0 END + CASE WHEN eh > 0 THEN (h - eh) * (h - eh) / eh ELSE 0 END + CASE WHEN ea > 0 THEN (a - ea) * (a - ea) / ea ELSE 0 END AS chi2 FROM x)
SELECT vid, 1 AS allele, round(round_even({ERFC.format(x='sqrt(chi2 / 2)')}, 6), 4) AS hwe FROM c
""")
def hwe(t):
    return q.hwe(q.site_quality(pl_calls(t), ["vid"])).select("vid", "allele", F.round("hwe", 4).alias("hwe"))


AF = """
c AS (SELECT g.*, m.population AS pop, m.sex, s.chrom IN ('chrX', 'chrY') AND m.sex = 'male' AS hap,
  CASE WHEN a0 > 0 THEN 1 ELSE 0 END + CASE WHEN a1 > 0 THEN 1 ELSE 0 END AS n, CASE WHEN a0 IS NULL THEN 0 ELSE 1 END + CASE WHEN a1 IS NULL THEN 0 ELSE 1 END AS k
  FROM multi g JOIN sites s USING (vid) JOIN samples m USING (sample_id) WHERE NOT (s.chrom = 'chrY' AND m.sex = 'female')),
f AS (SELECT vid, max(n_alts) AS n_alts, coalesce(pop, 'all') AS population, coalesce(sex, 'all') AS sex,
 CAST(sum(CASE WHEN hap THEN least(k, 1) ELSE k END) AS BIGINT) AS an, sum(CASE WHEN hap THEN 1 ELSE 2 END) AS slots,
 count(*) FILTER (k = 2 AND NOT hap AND n = 1) AS nhet, count(*) FILTER (k = 2 AND n >= CASE WHEN hap THEN 1 ELSE 2 END) AS nhomalt, count(*) FILTER (k = 2 AND n = 0) AS nhomref
 FROM c GROUP BY GROUPING SETS ((vid, pop, sex), (vid, pop), (vid, sex), (vid))),
d AS (SELECT vid, pop, sex, hap, a0 AS al FROM c WHERE a0 > 0 UNION ALL SELECT vid, pop, sex, hap, a1 FROM c WHERE a1 > 0 AND NOT (hap AND a0 IS NOT NULL AND a0 = a1)),
m AS (SELECT vid, coalesce(pop, 'all') AS population, coalesce(sex, 'all') AS sex, al, count(*) AS ac FROM d GROUP BY GROUPING SETS ((vid, al, pop, sex), (vid, al, pop), (vid, al, sex), (vid, al))),
z AS (SELECT f.vid, f.n_alts, f.population, f.sex, al.al AS allele, coalesce(ac, 0) AS ac, an, slots, nhet, nhomalt, nhomref
 FROM f JOIN (SELECT 1 AS al UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) al ON al.al <= f.n_alts
 LEFT JOIN m ON m.vid = f.vid AND m.population = f.population AND m.sex = f.sex AND m.al = al.al)"""


def frequencies(t):
    c = t.multi.select("vid", F.col("sample_id").alias("sample"), F.array("a0", "a1").alias("gt"), "n_alts")
    return q.allele_frequencies(c.join(t.sites.select("vid", "chrom"), "vid"), people(t), ["vid", "chrom"])


@query(f"""WITH {AF.replace(' AS (SELECT', ' AS MATERIALIZED (SELECT')}, gm AS (SELECT vid, population AS grpmax FROM (SELECT *, row_number() OVER (PARTITION BY vid ORDER BY ac / an DESC, population) AS n FROM z
  WHERE sex = 'all' AND population <> 'all' AND ac > 0 AND n_alts = 1) q WHERE n = 1)
SELECT z.vid, s.id, z.population, z.sex, z.allele, s.allele_type, z.ac, z.an, round(z.ac / nullif(z.an, 0), 6) AS af, round(1 - z.an / nullif(z.slots, 0), 6) AS ncr,
 CASE WHEN n_alts = 1 THEN z.nhet END AS nhet, CASE WHEN n_alts = 1 THEN z.nhomalt END AS nhomalt, CASE WHEN n_alts = 1 THEN z.nhomref END AS nhomref,
 CASE WHEN n_alts = 1 THEN round(z.nhet / nullif(z.nhet + z.nhomalt + z.nhomref, 0), 6) END AS freq_het, gm.grpmax FROM z JOIN sites s USING (vid) LEFT JOIN gm USING (vid)
""")
def allele_frequencies(t):
    out = frequencies(t).join(t.sites.select("vid", "chrom", "id", "allele_type"), ["vid", "chrom"])
    return rounded(out.select("vid", "id", "population", "sex", "allele", "allele_type", "ac", "an", "af", "ncr", "nhet", "nhomalt", "nhomref", "freq_het", "grpmax"), "af", "ncr", "freq_het")


@query(f"""WITH {AF.replace(' AS (SELECT', ' AS MATERIALIZED (SELECT')}, gm AS (SELECT vid, population AS grpmax FROM (SELECT *, row_number() OVER (PARTITION BY vid ORDER BY ac / an DESC, population) AS n FROM z
  WHERE sex = 'all' AND population <> 'all' AND ac > 0 AND n_alts = 1) q WHERE n = 1)
SELECT s.id, z.population, z.sex, s.allele_type, z.nhet, z.nhomalt, z.nhomref, round(z.nhet / nullif(z.nhet + z.nhomalt + z.nhomref, 0), 6) AS freq_het, gm.grpmax
FROM z JOIN sites s USING (vid) LEFT JOIN gm USING (vid) WHERE n_alts = 1""")
def genotype_frequencies(t):
    """What the operator gives for sites of one ALT only; joined to the site table."""
    one = frequencies(t).filter("nhet IS NOT NULL").join(t.sites.select("vid", "chrom", "id", "allele_type"), ["vid", "chrom"])
    return rounded(one.select("id", "population", "sex", "allele_type", "nhet", "nhomalt", "nhomref", "freq_het", "grpmax"), "freq_het")


TAGS = """k AS (SELECT vid, max(n_alts) AS n_alts, sum(CASE WHEN a0 IS NULL THEN 0 ELSE 1 END + CASE WHEN a1 IS NULL THEN 0 ELSE 1 END) AS an FROM multi GROUP BY vid),
d AS (SELECT vid, al, count(*) AS ac FROM (SELECT vid, a0 AS al FROM multi UNION ALL SELECT vid, a1 FROM multi) q WHERE al > 0 GROUP BY vid, al),
tags AS (SELECT k.vid, x.al AS allele, coalesce(ac, 0) AS ac, an FROM k JOIN (SELECT 1 AS al UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) x ON x.al <= k.n_alts
 LEFT JOIN d ON d.vid = k.vid AND d.al = x.al),
rates AS (SELECT vid, ac / nullif(an, 0) AS f FROM tags UNION ALL SELECT vid, 1 - sum(ac / nullif(an, 0)) FROM tags GROUP BY vid),
second AS (SELECT vid, f AS maf FROM (SELECT vid, f, row_number() OVER (PARTITION BY vid ORDER BY f DESC NULLS LAST) AS n FROM rates) r WHERE n = 2)"""


def tag_calls(t):
    return t.multi.select("vid", F.array("a0", "a1").alias("gt"), "n_alts")


@query(f"""WITH {TAGS} SELECT vid, allele, CAST(ac AS BIGINT) AS ac, CAST(an AS BIGINT) AS an, round(ac / nullif(an, 0), 6) AS af, round(maf, 6) AS maf FROM tags LEFT JOIN second USING (vid)""")
def fill_tags(t):
    return rounded(q.fill_tags(tag_calls(t), ["vid"]), "af", "maf")


@query("SELECT vid, sample_id AS sample, concat(CAST(coalesce(a0, 0) AS STRING), '/', CAST(coalesce(a1, 0) AS STRING)) AS gt FROM genotypes")
def set_missing_to_ref(t):
    return q.set_missing_to_ref(calls(t)).select("vid", "sample", gt_text().alias("gt"))


@query(f"WITH {TAGS} SELECT DISTINCT vid FROM tags WHERE ac / an >= 0.3 AND ac > 12")
def common_filter(t):
    return q.common_filter(tag_calls(t), ["vid"], "af >= 0.3 and ac > 12")


@query("""
WITH p AS (SELECT s.motif, s.allele_type, s.id, s.file_pos, round_even(count(*) FILTER (a0 IS NOT NULL AND a1 IS NOT NULL AND phased) / nullif(count(*) FILTER (a0 IS NOT NULL AND a1 IS NOT NULL), 0), 4) AS f
 FROM genotypes JOIN sites s USING (vid) GROUP BY s.motif, s.allele_type, s.id, s.file_pos)
SELECT motif, allele_type, id, coalesce(f, 0) AS phased_fraction FROM (SELECT *, row_number() OVER (PARTITION BY motif, allele_type ORDER BY coalesce(f, 0) DESC, file_pos) AS n FROM p) z WHERE n = 1
""")
def phased_fraction_dedup(t):
    c = calls(t).join(t.sites.select("vid", "id", "motif", "allele_type", "file_pos"), "vid")
    return q.phased_fraction_dedup(c, ["motif", "allele_type"])


def _hist_sql(value, keep, edges):
    return "concat_ws('|', " + ", ".join(
        f"CAST(count(*) FILTER ({keep} AND {value} >= {a} AND {value} < {b}) AS STRING)" for a, b in zip(edges, edges[1:])) + ")"


GQ_EDGES = (5, 10, 20, 30, 50, 80)


@query(f"""SELECT vid, {_hist_sql('gq', 'true', GQ_EDGES)} AS gq_hist_all_bin_freq, {_hist_sql('gq', '(a0 > 0 OR a1 > 0)', GQ_EDGES)} AS gq_hist_alt_bin_freq,
 CAST(count(*) FILTER (gq >= 80) AS BIGINT) AS gq_hist_all_n_larger, CAST(count(*) FILTER (gq >= 80 AND (a0 > 0 OR a1 > 0)) AS BIGINT) AS gq_hist_alt_n_larger FROM genotypes GROUP BY vid""")
def gq_histogram(t):
    return q.gq_histogram(calls(t), ["vid"], "gq", GQ_EDGES)


AB_EDGES = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)


@query(f"""SELECT vid, {_hist_sql('(ad_ref / nullif(ad_ref + ad_alt, 0))', 'a0 + a1 = 1', AB_EDGES)} AS ab_hist_alt_bin_freq FROM genotypes GROUP BY vid""")
def ab_histogram(t):
    return q.ab_histogram(calls(t), ["vid"], AB_EDGES)


AGE_EDGES = (79.0, 80.5, 82.0, 83.0)
AGE = "(date_diff('day', dob, DATE '2023-01-01') / 365.25)"


@query(f"""SELECT vid, {_hist_sql(AGE, 'a0 + a1 = 1', AGE_EDGES)} AS age_hist_het_bin_freq, CAST(count(*) FILTER (a0 + a1 = 1 AND {AGE} < 79.0) AS BIGINT) AS age_hist_het_n_smaller,
 CAST(count(*) FILTER (a0 + a1 = 1 AND {AGE} >= 83.0) AS BIGINT) AS age_hist_het_n_larger, {_hist_sql(AGE, 'a0 + a1 = 2', AGE_EDGES)} AS age_hist_hom_bin_freq,
 CAST(count(*) FILTER (a0 + a1 = 2 AND {AGE} < 79.0) AS BIGINT) AS age_hist_hom_n_smaller, CAST(count(*) FILTER (a0 + a1 = 2 AND {AGE} >= 83.0) AS BIGINT) AS age_hist_hom_n_larger
FROM genotypes JOIN ages USING (sample_id) WHERE a0 IS NOT NULL AND a1 IS NOT NULL GROUP BY vid""")
def age_histogram(t):
    c = calls(t).withColumn("n_alts", F.lit(1))
    return q.age_histogram(c, t.ages.withColumnRenamed("sample_id", "sample"), ["vid"], "2023-01-01", AGE_EDGES).drop("allele")


@query("""
WITH n AS (SELECT l_partkey AS vid, s_nationkey AS sample, CAST(sum(CASE WHEN l_quantity > 46 THEN 1 ELSE 0 END) AS INT) AS d, max(CASE WHEN l_tax = 0 THEN 4 ELSE 1 END) AS ac
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey, s_nationkey)
SELECT vid FROM n GROUP BY vid HAVING count(*) FILTER (d > 0) = 1 AND max(d) = 1 AND max(ac) <= 2
""")
def single_read_support(t):
    n = t.sql("""SELECT l_partkey AS vid, s_nationkey AS sample, CAST(sum(CASE WHEN l_quantity > 46 THEN 1 ELSE 0 END) AS INT) AS d, max(CASE WHEN l_tax = 0 THEN 4 ELSE 1 END) AS ac
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey, s_nationkey""")
    return q.single_read_support(n.withColumns({"ad": F.array(F.lit(9), F.col("d")), "n_alts": F.lit(1)}), ["vid"])


@query("SELECT vid, sample_id AS sample, phased AND sex <> 'male' AS phased FROM genotypes JOIN samples USING (sample_id)")
def unphase_samples(t):
    return q.unphase_samples(calls(t), people(t).filter("sex = 'male'")).select("vid", "sample", "phased")


@query(f"""
WITH c AS (SELECT g.vid, g.sample_id, g.a0, g.a1, g.phased, s.chrom, m.sex FROM genotypes g JOIN sites s USING (vid) JOIN samples m USING (sample_id)),
h AS (SELECT *, chrom IN ('chrX', 'chrY') AND sex = 'male' AND a0 IS NOT NULL AND a1 IS NOT NULL AS cut, CASE WHEN a1 > 0 THEN 1 WHEN a0 > 0 THEN 0 ELSE 1 END AS keep FROM c),
k AS (SELECT *, CASE WHEN NOT cut THEN a0 WHEN phased AND keep = 0 THEN a0 END AS b0,
  CASE WHEN NOT cut THEN a1 WHEN phased THEN CASE WHEN keep = 1 THEN a1 END ELSE CASE WHEN keep = 1 THEN a1 ELSE a0 END END AS b1 FROM h),
o AS (SELECT *, NOT phased AND b0 IS NOT NULL AND (b1 IS NULL OR b0 > b1) AS swap FROM k)
SELECT vid, sample_id AS sample, CASE WHEN chrom = 'chrY' AND sex = 'female' THEN './.' WHEN swap THEN {GT.format('b1', 'b0')} ELSE {GT.format('b0', 'b1')} END AS gt FROM o
""")
def normalize_ploidy(t):
    c = calls(t).join(t.sites.select("vid", "chrom"), "vid")
    sex = people(t).select("sample", F.when(F.col("sex") == "male", "M").otherwise("F").alias("sex"))
    return q.normalize_ploidy(c, sex).select("vid", "sample", gt_text().alias("gt"))


@query("""SELECT s.id AS locus, s.motif, m.population, m.sex, g.ad_alt AS allele, CAST(count(*) AS BIGINT) AS n FROM genotypes g JOIN sites s USING (vid) JOIN samples m USING (sample_id)
WHERE s.allele_type = 'trv' GROUP BY ALL""")
def tr_allele_histograms(t):
    lps = calls(t).join(t.sites.filter("allele_type = 'trv'"), "vid").select(F.col("id").alias("locus"), "motif", "sample", F.element_at("ad", 2).alias("allele"))
    return q.tr_allele_histograms(lps, people(t))


@query("""SELECT id, CAST(coalesce(list_max(list_transform(regexp_extract_all(concat('GG', ref, 'N', ref, ref, alt), concat('(?:', motif, ')+')), lambda x: length(x))), 0) / length(motif) AS INT) AS copies FROM sites""")
def longest_pure_run(t):
    s = t.sites.withColumn("seq", F.concat(F.lit("GG"), "ref", F.lit("N"), "ref", "ref", "alt"))
    return s.select("id", q.longest_pure_run("seq", "motif").alias("copies"))


@query("""
WITH s AS (SELECT id, ref, alt, CASE WHEN length(alt) > length(ref) THEN substr(alt, 2) ELSE substr(ref, 2) END AS q FROM sites)
SELECT id, length(ref) <> length(alt) AND length(q) >= 9 AND EXISTS (SELECT 1 FROM unnest(generate_series(1, length(q) // 3)) g(u) WHERE length(q) % u = 0 AND repeat(substr(q, 1, CAST(u AS INT)), CAST(length(q) // u AS INT)) = q) AS tandem_indel FROM s
""")
def perfect_tandem_indel(t):
    return q.perfect_tandem_indel(t.sites).select("id", "tandem_indel")


ALLELES = """SELECT vid, motif, 0 AS allele, ref AS seq FROM sites UNION ALL SELECT vid, motif, 1, alt FROM sites UNION ALL SELECT vid, motif, 2, concat(ref, motif, 'A') FROM sites UNION ALL SELECT vid, motif, 3, concat('T', alt, alt, ref) FROM sites
 UNION ALL SELECT vid, motif, 4, '<DEL>' FROM sites"""


@query(f"""SELECT vid, allele, CASE WHEN allele < 4 THEN CAST((length(seq) - length(replace(seq, motif, ''))) / length(motif) AS INT) END AS mc,
 CASE WHEN allele < 4 THEN CAST(coalesce(list_max(list_transform(regexp_extract_all(seq, concat('(?:', motif, ')+')), lambda x: length(x))), 0) / length(motif) AS INT) END AS lps,
 CASE WHEN allele < 4 THEN round(1 - levenshtein(seq, substr(repeat(motif, CAST(ceil(length(seq) / length(motif)) AS INT)), 1, length(seq))) / length(seq), 6) END AS ap FROM ({ALLELES}) a""")
def repeat_alleles(t):
    s = t.sites.select("vid", "motif", "ref", F.array("alt", F.concat("ref", "motif", F.lit("A")), F.concat(F.lit("T"), "alt", "alt", "ref"), F.lit("<DEL>")).alias("alts"))
    return q.repeat_alleles(s, ["vid"]).withColumn("ap", F.round("ap", 6))


# ------------------------------------------------------------------ phasing

def phase_inputs(t):
    """Calls and backbone truth; the part key stands in for the place so that alleles pair one to one."""
    t.keep_calls("genotypes", "genotypes2")
    c = site_calls(t).withColumn("alleles", F.array(F.struct(F.lit(1).alias("allele"), F.col("vid").alias("npos"), F.col("ref").alias("nref"), F.col("alt").alias("nalt"))))
    tr = site_calls(t, "genotypes2").select("chrom", F.col("vid").alias("npos"), F.col("ref").alias("nref"), F.col("alt").alias("nalt"), "sample", "gt", "phased")
    return c, tr


FLIPS = """j AS (SELECT a.vid, s.id, a.sample_id, a.a0, a.a1, a.phased, a.ps, s.allele_type, b.a0 AS t0, b.a1 AS t1 FROM genotypes a JOIN sites s USING (vid)
  LEFT JOIN (SELECT * FROM genotypes2 WHERE phased AND a0 <> a1) b USING (vid, sample_id)),
blocks AS (SELECT sample_id, ps FROM j WHERE phased AND a0 <> a1 AND allele_type = 'snv' AND t0 IS NOT NULL GROUP BY sample_id, ps
  HAVING count(*) FILTER (a0 <> t0) > count(*) FILTER (a0 = t0)),
d AS (SELECT id, vid, j.sample_id, concat(CAST(a1 AS STRING), '|', CAST(a0 AS STRING)) AS new_gt, CAST(j.ps AS STRING) AS new_ps FROM j JOIN blocks b ON j.sample_id = b.sample_id AND j.ps = b.ps
  WHERE phased AND a0 <> a1
 UNION ALL SELECT id, vid, sample_id, concat(CAST(t0 AS STRING), '|', CAST(t1 AS STRING)), '.' FROM j WHERE NOT phased AND a0 <> a1 AND t0 IS NOT NULL)"""


@query(f"WITH {FLIPS} SELECT id, sample_id AS sample, new_gt, new_ps FROM d")
def phase_block_flips(t):
    c, tr = phase_inputs(t)
    return ph.phase_block_flips(c, tr, phase_unphased=True)


@query(f"""WITH {FLIPS} SELECT g.vid, g.sample_id AS sample, CASE WHEN d.id IS NOT NULL THEN replace(new_gt, '|', '/') ELSE {GT.format('g.a0', 'g.a1')} END AS gt,
 g.phased OR d.id IS NOT NULL AS phased FROM genotypes g LEFT JOIN d ON g.vid = d.vid AND g.sample_id = d.sample_id""")
def apply_phase_flips(t):
    c, tr = phase_inputs(t)
    return ph.apply_phase_flips(c, ph.phase_block_flips(c, tr, phase_unphased=True)).select("vid", "sample", gt_text().alias("gt"), "phased")


@query(f"""
WITH j AS (SELECT a.vid, a.sample_id, a.a0, a.a1, a.phased, a.ps, s.allele_type, b.a0 AS t0 FROM genotypes a JOIN sites s USING (vid)
  LEFT JOIN (SELECT * FROM genotypes2 WHERE phased AND a0 <> a1) b USING (vid, sample_id)),
f AS (SELECT sample_id, ps, a0 AS g0 FROM j WHERE phased AND a0 <> a1 AND allele_type = 'snv' AND t0 IS NOT NULL GROUP BY sample_id, ps, a0 HAVING count(*) FILTER (a0 <> t0) > count(*) FILTER (a0 = t0))
SELECT j.vid, j.sample_id AS sample, CASE WHEN f.ps IS NOT NULL AND phased AND a0 <> a1 THEN {GT.format('a1', 'a0')} ELSE {GT.format('a0', 'a1')} END AS gt
FROM j LEFT JOIN f ON j.sample_id = f.sample_id AND j.ps = f.ps AND j.a0 = f.g0 AND a0 <> a1 AND phased
""")
def transfer_haplotypes(t):
    a = calls(t).join(t.sites.select("vid", "allele_type"), "vid")
    return ph.transfer_haplotypes(a, calls(t, "genotypes2"), ("vid",)).select("vid", "sample", gt_text().alias("gt"))


ONE_ALT = """tags AS (SELECT vid, sum(coalesce(a0, 0) + coalesce(a1, 0)) AS ac, sum(CASE WHEN a0 IS NULL THEN 0 ELSE 1 END + CASE WHEN a1 IS NULL THEN 0 ELSE 1 END) AS an FROM genotypes GROUP BY vid)"""


@query(f"""
WITH {ONE_ALT}, c AS (SELECT g.vid, g.sample_id, CAST(floor(g.ps / 10.0) AS BIGINT) AS ps, ac / an AS af FROM genotypes g JOIN tags USING (vid) WHERE a0 IS NOT NULL AND a1 IS NOT NULL),
r AS (SELECT *, max(af) OVER (PARTITION BY sample_id, ps) AS top, row_number() OVER (PARTITION BY sample_id, ps ORDER BY af DESC, vid) AS n FROM c)
SELECT DISTINCT vid FROM r WHERE af >= 0.7 OR (top < 0.7 AND n = 1)
""")
def phase_set_anchors(t):
    af = q.fill_tags(calls(t), ["vid"]).select("vid", "af")
    c = calls(t).withColumn("ps", F.floor(F.col("ps") / 10)).join(af, "vid").withColumn("file_pos", F.col("vid"))
    return ph.phase_set_anchors(c, 0.7, "vid")


STATES = """pts AS (SELECT s.chrom AS contig, a.sample_id AS sample, CASE WHEN s.allele_type = 'trv' THEN 'trv' ELSE 'outside_tr' END AS collection, s.id, s.pos, a.vid,
  CASE WHEN a.a0 = b.a0 THEN 1 ELSE 0 END AS st0 FROM genotypes a JOIN genotypes2 b USING (vid, sample_id) JOIN sites s USING (vid)
  WHERE a.a0 <> a.a1 AND a.phased AND b.a0 <> b.a1 AND b.phased),
m AS (SELECT *, CASE WHEN sum(st0) OVER g * 2 < count(*) OVER g THEN 1 - st0 ELSE st0 END AS st, row_number() OVER (PARTITION BY contig, sample, collection ORDER BY pos, vid) AS idx
  FROM pts WINDOW g AS (PARTITION BY contig, sample, collection)),
c AS (SELECT *, st <> lag(st) OVER w AS ch FROM m WINDOW w AS (PARTITION BY contig, sample, collection ORDER BY idx)),
k AS (SELECT contig, sample, collection, idx, idx - row_number() OVER (PARTITION BY contig, sample, collection ORDER BY idx) AS run FROM c WHERE ch),
e AS (SELECT *, row_number() OVER (PARTITION BY contig, sample, collection, run ORDER BY idx) AS i, count(*) OVER (PARTITION BY contig, sample, collection, run) AS n FROM k),
stt AS (SELECT m.*, CASE WHEN e.idx IS NOT NULL THEN CASE WHEN e.n % 2 = 1 AND e.i = e.n THEN 'SW' ELSE 'FL' END WHEN m.st = 1 THEN 'XC' ELSE 'CN' END AS status
  FROM m LEFT JOIN e USING (contig, sample, collection, idx))"""


def statuses(t):
    t.keep_calls("genotypes", "genotypes2")
    kind = F.when(F.col("allele_type") == "trv", "trv").otherwise("outside_tr")
    s = t.sites.select("vid", "id", F.col("chrom").alias("contig"), kind.alias("collection"), "pos", "file_pos")
    states = ph.phase_states(calls(t).select("vid", "sample", "gt", "phased"), calls(t, "genotypes2"), ["vid"])
    return ph.phase_statuses(states.select("vid", "sample", "state").join(s, "vid"))


@query(f"WITH {STATES} SELECT contig, sample, collection, id, status FROM stt")
def phase_statuses(t):
    return statuses(t).select("contig", "sample", "collection", "id", "status")


@query(f"""WITH {STATES} SELECT contig, sample, collection, CAST(count(*) AS BIGINT) AS matched_count, CAST(count(*) FILTER (status = 'SW') AS BIGINT) AS switch_error_count,
 CAST(count(*) FILTER (status = 'FL') / 2 AS BIGINT) AS flip_error_count FROM stt GROUP BY contig, sample, collection""")
def switch_flip_errors(t):
    return ph.aggregate_phasing(ph.switch_flip_errors(statuses(t)))


@query(f"""WITH {STATES}
SELECT s.id, g.sample_id AS sample, CASE WHEN a0 IS NULL OR a1 IS NULL THEN 'NC' WHEN a0 = 0 AND a1 = 0 THEN '.' WHEN a0 = a1 THEN 'HA' WHEN NOT phased THEN 'UP'
 WHEN stt.status IS NOT NULL THEN stt.status WHEN p.population = 'ASIA' THEN 'MS' ELSE 'NF' END AS phase_status
FROM genotypes g JOIN sites s USING (vid) JOIN samples p USING (sample_id) LEFT JOIN stt ON stt.id = s.id AND stt.sample = g.sample_id""")
def phase_status_matrix(t):
    st = statuses(t)
    m = ph.phase_status_matrix(calls(t).select("vid", "sample", "gt", "phased"), st, people(t).filter("population = 'ASIA'"), "vid")
    return m.join(t.sites.select("vid", "id"), "vid").select("id", "sample", "phase_status")


# Sites folded onto three short stretches, so that calls of a sample overlap often.
CROWD = "concat('chr', CAST(vid % 3 + 1 AS STRING)) AS chrom, pos % 400 AS pos"


def crowded_calls(t):
    s = t.sites.select("vid", "id", "ref", "allele_type", "allele_length", "qual", "file_pos", *[F.expr(x) for x in ("concat('chr', CAST(vid % 3 + 1 AS STRING)) AS chrom", "pos % 400 AS pos")])
    return calls(t).join(s, "vid")


HAPS = f"""s AS (SELECT vid, id, ref, allele_type, allele_length, qual, file_pos, {CROWD} FROM sites WHERE allele_type <> 'trv'),
w AS (SELECT vid, sample_id, gq, 1 AS hap FROM genotypes WHERE phased AND a0 > 0 UNION ALL SELECT vid, sample_id, gq, 2 FROM genotypes WHERE phased AND a1 > 0),
h AS (SELECT s.chrom, w.sample_id, w.hap, s.id, s.pos AS st, s.pos + length(s.ref) AS en, gq, s.qual, s.file_pos, abs(s.allele_length) AS n,
  CASE WHEN s.allele_length = 0 THEN 'SNV' WHEN s.allele_type LIKE '%del%' THEN 'DEL' WHEN s.allele_type LIKE '%ins%' OR s.allele_type LIKE '%dup%' THEN 'INS' ELSE 'OTHER' END AS kind
  FROM w JOIN s USING (vid)),
r AS (SELECT *, CASE kind WHEN 'DEL' THEN 2 WHEN 'INS' THEN 1 WHEN 'SNV' THEN 0 ELSE -1 END AS kr FROM h),
o AS (SELECT a.sample_id AS sample, a.hap AS haplotype, a.id AS retained, a.kind AS type_retained, b.id AS cleared, b.kind AS type_cleared FROM r a JOIN r b
  ON a.chrom = b.chrom AND a.sample_id = b.sample_id AND a.hap = b.hap AND a.id <> b.id AND a.st < b.en AND b.st < a.en
  AND (a.en - a.st, a.gq, a.n, a.kr, a.qual, -a.file_pos) > (b.en - b.st, b.gq, b.n, b.kr, b.qual, -b.file_pos))"""


@query(f"WITH {HAPS} SELECT * FROM o")
def haplotype_overlaps(t):
    return ph.haplotype_overlaps(crowded_calls(t))


@query(f"WITH {HAPS} SELECT DISTINCT cleared AS id, sample FROM o")
def cleared_calls(t):
    return ph.cleared_calls(crowded_calls(t))


@query(f"""WITH {HAPS}, x AS (SELECT DISTINCT cleared AS id, sample FROM o)
SELECT s.id, g.sample_id AS sample, CASE WHEN x.id IS NOT NULL THEN './.' ELSE {GT.format('a0', 'a1')} END AS gt, CASE WHEN x.id IS NULL THEN gq END AS gq,
 CASE WHEN x.id IS NULL THEN ad_ref + ad_alt END AS dp, phased AND x.id IS NULL AS phased
FROM genotypes g JOIN sites s USING (vid) LEFT JOIN x ON x.id = s.id AND x.sample = g.sample_id""")
def clear_calls(t):
    t.keep_calls("genotypes")
    lost = ph.cleared_calls(crowded_calls(t).withColumn("id", F.col("vid"))).withColumnRenamed("id", "vid")
    own = calls(t).select("vid", "sample", "gt", "gq", "dp", "phased").join(t.sites.select("vid", "id"), "vid")  # where the calls lie; then they are sent once
    c = ph.clear_calls(own, lost, "vid")
    return c.select("id", "sample", gt_text().alias("gt"), "gq", "dp", "phased")
