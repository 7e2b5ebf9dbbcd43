"""Category counts, trio and quality tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counting as k, truth as tr
from ..session import kept
from .queries_rows import calls
from .queries_transfer import find_trios
from .register import query

DB = {"dbSNP": ["dbsnp_id"], "catalog": ["catalog_id"]}


def annotated(t):
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(c))
    return t.annotated.withColumns({"PREDICTED_LOF": one("lof_gene"), "PREDICTED_UTR": one("utr_gene"),
                                    "matched": F.col("dbsnp_id").isNotNull() | F.col("catalog_id").isNotNull()})


def classified(t):
    return k.classify_annotations(annotated(t), DB)


ROWS = """a AS (SELECT *, CASE WHEN size4 = 0 THEN 'LoF' WHEN size4 = 1 THEN 'Missense' WHEN size4 = 2 THEN 'Intergenic' ELSE 'Other' END AS v,
  CASE WHEN lof_gene IS NOT NULL THEN 'LoF' WHEN utr_gene IS NOT NULL THEN 'UTR' END AS e FROM (SELECT *, CASE WHEN vep LIKE '%stop_gained%' THEN 0 WHEN vep LIKE '%missense%' THEN 1 WHEN vep LIKE '%UTR%' THEN 2 ELSE 3 END AS size4 FROM annotated) q),
miss AS (SELECT a.*, 'dbSNP Missing' AS m FROM a WHERE dbsnp_id IS NULL UNION ALL SELECT a.*, 'catalog Missing' FROM a WHERE catalog_id IS NULL
  UNION ALL SELECT a.*, 'dbSNP/catalog Missing' FROM a WHERE dbsnp_id IS NULL AND catalog_id IS NULL),
r AS (SELECT vid, 'All' AS category, 'All' AS sub_category FROM a UNION ALL SELECT vid, 'VEP', 'All' FROM a UNION ALL SELECT vid, 'VEP', v FROM a UNION ALL SELECT vid, 'Concordance', 'All' FROM a
 UNION ALL SELECT vid, 'ME', 'All' FROM a WHERE allele_subtype IN ('alu_ins', 'sva_ins', 'line_ins') UNION ALL SELECT vid, 'ME', upper(replace(allele_subtype, '_ins', '')) FROM a WHERE allele_subtype IN ('alu_ins', 'sva_ins', 'line_ins')
 UNION ALL SELECT vid, 'Duplication', 'All' FROM a WHERE allele_subtype IN ('tandem_dup', 'dup_interspersed')
 UNION ALL SELECT vid, 'Duplication', CASE WHEN allele_subtype = 'dup_interspersed' THEN 'Interspersed' WHEN allele_type = 'dup' THEN 'Filtered Tandem' ELSE 'SVAN Tandem' END FROM a WHERE allele_subtype IN ('tandem_dup', 'dup_interspersed')
 UNION ALL SELECT vid, 'NUMT', 'All' FROM a WHERE allele_subtype = 'numt' UNION ALL SELECT vid, 'SVAnnotate', 'All' FROM a WHERE e IS NOT NULL UNION ALL SELECT vid, 'SVAnnotate', e FROM a WHERE e IS NOT NULL
 UNION ALL SELECT vid, 'Concordance', m FROM miss UNION ALL SELECT vid, 'Concordance', concat(m, ' + ', v, ' (VEP)') FROM miss
 UNION ALL SELECT vid, 'Concordance', concat(m, ' + ', e, ' (SVAnnotate)') FROM miss WHERE e IS NOT NULL)"""

SIZE = """CASE WHEN allele_type = 'snv' THEN 'SNV' WHEN allele_type = 'trv' THEN 'TRV' ELSE concat(CASE WHEN allele_type = 'del' THEN 'DEL ' ELSE 'INS ' END, {0}) END"""
SUMMARY = SIZE.format("CASE WHEN abs(allele_length) < 1 THEN '0-0' WHEN abs(allele_length) < 50 THEN '1-49' WHEN abs(allele_length) < 500 THEN '50-499' ELSE '500+' END")
PLOT = SIZE.format("""CASE WHEN abs(allele_length) < 1 THEN '0-0' WHEN abs(allele_length) < 50 THEN '1-49' WHEN abs(allele_length) < 100 THEN '50-99' WHEN abs(allele_length) < 500 THEN '100-499'
  WHEN abs(allele_length) < 5000 THEN '500-4999' ELSE '5000-49999' END""")
W = """w AS (SELECT vid, count(*) FILTER (coalesce(a0, 0) + coalesce(a1, 0) > 0) AS carriers, sum(coalesce(a0, 0) + coalesce(a1, 0)) AS alt_alleles FROM genotypes GROUP BY vid
  HAVING count(*) FILTER (coalesce(a0, 0) + coalesce(a1, 0) > 0) > 0)"""
STATUS = "(SELECT vid, 'All' AS tr_status FROM annotated UNION ALL SELECT vid, CASE WHEN tr_enveloped THEN 'TR' ELSE 'Not TR' END FROM annotated)"
REGION = "(SELECT vid, 'All' AS region FROM annotated UNION ALL SELECT vid, region FROM annotated WHERE region <> 'other')"


@query(f"WITH {ROWS} SELECT vid, category, sub_category FROM r")
def classify_annotations(t):
    return classified(t).select("vid", F.explode("rows").alias("r")).select("vid", F.col("r.category").alias("category"), F.col("r.sub").alias("sub_category"))


@query(f"""SELECT id, {SUMMARY} AS size_column, concat(CASE allele_type WHEN 'snv' THEN 'SNV' WHEN 'trv' THEN 'TRV' WHEN 'del' THEN 'DEL' ELSE 'INS' END, ' [', CASE WHEN af <= 0.01 THEN '0.0-0.01' WHEN af <= 0.05 THEN '0.01-0.05'
 WHEN af <= 0.1 THEN '0.05-0.1' WHEN af <= 0.5 THEN '0.1-0.5' ELSE '>0.5' END, ']') AS af_column FROM annotated""")
def size_and_af_columns(t):
    return t.annotated.select("id", k.size_column().alias("size_column"), k.af_column().alias("af_column"))


@query(f"""WITH {ROWS}, {W} SELECT r.category, r.sub_category, ts.tr_status, rg.region, {SUMMARY} AS bucket, CAST(count(*) AS BIGINT) AS sites, CAST(sum(w.carriers) AS BIGINT) AS carriers, CAST(sum(w.alt_alleles) AS BIGINT) AS alt_alleles
FROM annotated n JOIN w USING (vid) JOIN r USING (vid) JOIN {STATUS} ts USING (vid) JOIN {REGION} rg USING (vid) WHERE n.allele_length <= 900 GROUP BY ALL""")
def count_annotations(t):
    return k.count_annotations(classified(t), k.carrier_weights(calls(t), ["vid"]), ["vid"], maximum=900)


@query(f"""WITH {W}, c AS (SELECT {SUMMARY} AS b, w.carriers AS n, tr_status FROM annotated JOIN w USING (vid) JOIN {STATUS} ts USING (vid))
SELECT tr_status, CAST(coalesce(sum(n) FILTER (b = 'SNV'), 0) AS BIGINT) AS snv, CAST(coalesce(sum(n) FILTER (b = 'DEL 50-499'), 0) AS BIGINT) AS del_50_499, CAST(coalesce(sum(n) FILTER (b = 'INS 500+'), 0) AS BIGINT) AS ins_500,
 CAST(coalesce(sum(n) FILTER (b = 'Other'), 0) AS BIGINT) AS other FROM c GROUP BY tr_status""")
def count_report_wide(t):
    c = k.count_annotations(classified(t), k.carrier_weights(calls(t), ["vid"]), ["vid"], regions=False).filter("category = 'All'")
    return k.pivot_buckets(c, "carriers").select("tr_status", F.col("SNV").alias("snv"), F.col("DEL 50-499").alias("del_50_499"), F.col("INS 500+").alias("ins_500"), F.col("Other").alias("other"))


@query(f"""WITH {W}, b AS (SELECT vid, 'all' AS b FROM annotated UNION ALL SELECT vid, 'singleton' FROM annotated WHERE ac = 1 UNION ALL SELECT vid, 'ultra_rare' FROM annotated WHERE af < 0.001
  UNION ALL SELECT vid, 'rare' FROM annotated WHERE af < 0.01 UNION ALL SELECT vid, 'common' FROM annotated WHERE af > 0.05),
g AS (SELECT vid, 'PREDICTED_LOF' AS f, lof_gene AS gene FROM annotated WHERE lof_gene IS NOT NULL UNION ALL SELECT vid, 'PREDICTED_UTR', utr_gene FROM annotated WHERE utr_gene IS NOT NULL)
SELECT gene AS gene_name, concat(f, '.', b) AS category, CAST(count(*) AS BIGINT) AS sites, CAST(sum(carriers) AS BIGINT) AS carriers, CAST(sum(alt_alleles) AS BIGINT) AS alt_alleles FROM g JOIN b USING (vid) JOIN w USING (vid) GROUP BY 1, 2""")
def gene_counts(t):
    return k.gene_counts(annotated(t), k.carrier_weights(calls(t), ["vid"]), ["vid"])


@query("""SELECT allele_type AS bucket, CAST(sum(size) AS BIGINT) AS carriers, round(sum(size) / max((SELECT count(*) FROM nation)), 6) AS carriers_per_sample FROM sites GROUP BY allele_type HAVING sum(size) > 0""")
def merge_count_tables(t):
    shards = t.sites.groupBy(F.col("chrom").alias("shard"), F.col("allele_type").alias("bucket")).agg(F.sum("size").alias("carriers"))
    n = t.sites.select(F.col("chrom").alias("shard"), t.nation.agg(F.count("*").alias("n")).scalar().alias("n")).distinct()
    return k.merge_count_tables(shards, n).withColumn("carriers_per_sample", F.round("carriers_per_sample", 6))


@query(f"WITH {ROWS}, {W} SELECT n.id, {SUMMARY} AS classification, r.category, r.sub_category FROM annotated n JOIN r USING (vid) JOIN w USING (vid)")
def annotation_list(t):
    return k.annotation_list(classified(t), k.carrier_weights(calls(t), ["vid"]), ["vid"])


@query(f"""WITH b AS (SELECT vid, {PLOT} AS bucket, allele_type FROM annotated UNION ALL
 SELECT vid, concat(CASE allele_type WHEN 'snv' THEN 'SNV' WHEN 'trv' THEN 'TRV' WHEN 'del' THEN 'DEL' ELSE 'INS' END, ' [', CASE WHEN af <= 0.01 THEN '0.0-0.01' WHEN af <= 0.05 THEN '0.01-0.05' WHEN af <= 0.1 THEN '0.05-0.1' WHEN af <= 0.5 THEN '0.1-0.5' ELSE '>0.5' END, ']'), allele_type FROM annotated)
SELECT sample_id AS sample, b.bucket, ts.tr_status, CAST(count(*) AS BIGINT) AS sites, CAST(sum(coalesce(a0, 0) + coalesce(a1, 0)) AS BIGINT) AS alleles,
 CAST(count(*) FILTER (n.dbsnp_id IS NOT NULL OR n.catalog_id IS NOT NULL) AS BIGINT) AS matched FROM genotypes g JOIN annotated n USING (vid) JOIN b USING (vid) JOIN {STATUS} ts USING (vid)
WHERE coalesce(a0, 0) + coalesce(a1, 0) > 0 GROUP BY ALL""")
def sample_counts(t):
    return k.sample_counts(calls(t), annotated(t), ["vid"], regions=False)


TRIMMED_NET = "abs(length(alt) - length(ref))"


@query("""
WITH x AS (SELECT n.*, k.n_alts FROM annotated n JOIN (SELECT vid, max(n_alts) AS n_alts FROM multi GROUP BY vid) k USING (vid)),
a AS (SELECT x.*, i, concat(alt, substr('ACG', 1, CAST(i AS INT) - 1)) AS own FROM x JOIN (SELECT 1 AS i UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) n ON i <= n_alts WHERE allele_type = 'trv'),
p AS (SELECT vid, 0 AS i, allele_type AS allele_class, allele_length AS svlen, af, region FROM x WHERE allele_type <> 'trv' UNION ALL
 SELECT vid, i, CASE WHEN length(own) = length(ref) THEN 'TR_SNV' WHEN length(own) > length(ref) THEN 'TR_INS' ELSE 'TR_DEL' END, abs(length(own) - length(ref)), CASE WHEN file_pos % 2 = 0 THEN i / 10.0 END, region FROM a),
c AS (SELECT p.*, coalesce(a0, 0) > 0 OR coalesce(a1, 0) > 0 AS carried, CASE WHEN a0 IS NULL AND a1 IS NULL THEN NULL WHEN i = 0 THEN CASE WHEN a0 > 0 THEN 1 ELSE 0 END + CASE WHEN a1 > 0 THEN 1 ELSE 0 END
  ELSE CASE WHEN a0 = i THEN 1 ELSE 0 END + CASE WHEN a1 = i THEN 1 ELSE 0 END END AS n FROM p JOIN multi USING (vid))
SELECT vid, CAST(i AS INT) AS alt_index, allele_class, svlen, round(coalesce(af, CASE WHEN i > 0 THEN (count(*) FILTER (n = 1) + 2 * count(*) FILTER (n = 2)) / nullif(2 * count(n), 0) END), 6) AS af, count(*) FILTER (n = 0) AS n_ref,
 count(*) FILTER (n = 1) AS n_het, count(*) FILTER (n = 2) AS n_hom, count(*) FILTER (n IS NULL) AS n_missing, region FROM c GROUP BY vid, i, allele_class, svlen, af, region HAVING bool_or(carried)""")
def variant_list(t):
    n = t.multi.groupBy("vid").agg(F.max("n_alts").alias("n_alts"))
    more = F.transform(F.sequence(F.lit(1), F.col("n_alts")), lambda i: F.concat("alt", F.substring(F.lit("ACG"), F.lit(1), i - 1)))
    by_alt = F.when(F.col("file_pos") % 2 == 0, F.transform(F.sequence(F.lit(1), F.col("n_alts")), lambda i: i / 10.0))
    trv = F.col("allele_type") == "trv"
    s = t.annotated.join(n, "vid").withColumns({"alts": F.when(trv, more).otherwise(F.array("alt")), "af": F.when(trv, by_alt).otherwise(F.array(F.col("af").cast("double")))})
    out = k.variant_list(s, t.multi.select("vid", F.col("sample_id").alias("sample"), F.array("a0", "a1").alias("gt")), ["vid"])
    return out.withColumn("af", F.round("af", 6))


@query(f"""
WITH tr AS (SELECT c_custkey AS c FROM customer WHERE c_nationkey >= 3 AND c_custkey IN (SELECT o_custkey FROM orders) AND c_custkey + 1 IN (SELECT o_custkey FROM orders) AND c_custkey + 2 IN (SELECT o_custkey FROM orders)),
n AS (SELECT vid, sample_id, coalesce(a0, 0) + coalesce(a1, 0) AS n FROM genotypes WHERE coalesce(a0, 0) + coalesce(a1, 0) > 0),
x AS (SELECT vid, c, max(CASE WHEN sample_id = c THEN n ELSE 0 END) AS kid, max(CASE WHEN sample_id = c + 1 THEN n ELSE 0 END) AS fa, max(CASE WHEN sample_id = c + 2 THEN n ELSE 0 END) AS mo
  FROM n JOIN tr ON sample_id = c OR sample_id = c + 1 OR sample_id = c + 2 GROUP BY vid, c),
y AS (SELECT *, kid - greatest(0, kid - fa - mo) AS inh FROM x)
SELECT CAST(c AS STRING) AS child, {PLOT} AS bucket, ts.tr_status, CAST(sum(CASE WHEN kid > 0 THEN 1 ELSE 0 END) AS BIGINT) AS proband, CAST(sum(CASE WHEN kid > 0 AND fa + mo > 0 THEN 1 ELSE 0 END) AS BIGINT) AS mendelian,
 CAST(sum(CASE WHEN kid > 0 AND fa > 0 THEN 1 ELSE 0 END) AS BIGINT) AS paternal, CAST(sum(CASE WHEN fa > 0 THEN 1 ELSE 0 END) AS BIGINT) AS paternal_total, CAST(sum(inh) AS BIGINT) AS mendelian_alleles,
 round(sum(CASE WHEN fa + mo > 0 THEN inh * fa / (fa + mo) ELSE 0 END), 6) AS paternal_alleles, CAST(sum(mo) AS BIGINT) AS maternal_total_alleles
FROM y JOIN annotated USING (vid) JOIN {STATUS} ts USING (vid) GROUP BY ALL""")
def trio_transmission(t):
    c = calls(t).withColumn("sample", F.col("sample").cast("string"))
    out = k.trio_transmission(c, t.annotated, find_trios(t), ["vid"], regions=False)
    return out.select("child", "bucket", "tr_status", "proband", "mendelian", "paternal", "paternal_total", "mendelian_alleles", F.round("paternal_alleles", 6).alias("paternal_alleles"), "maternal_total_alleles")


# Trio tables need parents called at the child's sites; nations stand in for samples.
NAT_COLUMNS = """max(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END) AS a0, max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS a1,
  CAST(max(l_quantity) AS INT) AS gq"""
NAT_CALLS = f"""nc AS (SELECT l_partkey AS vid, s_nationkey AS sample, {NAT_COLUMNS} FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey, s_nationkey)"""


READS = "(SELECT 'pbsv' AS caller, 7 AS m, 9 AS n UNION ALL SELECT 'delly_2', 5, 4)"
LIKELY = "list_sort([CAST(round_even(-10 * (l0 - best), 0) AS INT), CAST(round_even(-10 * (l1 - best), 0) AS INT), CAST(round_even(-10 * (l2 - best), 0) AS INT)])[2]"


EMIT = f"""{NAT_CALLS},
r AS (SELECT nc.*, caller, CAST(gq % m AS INT) AS r, CAST(vid % n AS INT) AS a FROM nc CROSS JOIN {READS} k),
l AS (SELECT *, a * log10(0.05) + r * log10(1.0 - 0.05) AS l0, a * log10(0.5) + r * log10(0.5) AS l1, a * log10(0.95) + r * log10(1.0 - 0.95) AS l2 FROM r),
b AS (SELECT *, greatest(l0, l1, l2) AS best FROM l),
e AS (SELECT vid, sample, a0, a1, 'no_caller' AS caller, gq FROM nc WHERE vid % 4 = 0 UNION ALL SELECT vid, sample, a0, a1, 'kanpig', gq FROM nc WHERE vid % 4 = 1
 UNION ALL SELECT vid, sample, a0, a1, caller, CASE WHEN r + a = 0 THEN 0 ELSE least(99, {LIKELY}) END FROM b WHERE vid % 4 > 1)"""


def nat_calls(t, n=None):
    n = t.sql(f"WITH {NAT_CALLS} SELECT * FROM nc") if n is None else n
    ev = [F.format_string("pbsv_(%d_%d)", F.col("gq") % 7, F.col("vid") % 9), F.format_string("delly_2_(%d_%d)", F.col("gq") % 5, F.col("vid") % 4), F.lit("broken")]
    bev = F.when(F.col("vid") % 4 == 1, "kanpig").when(F.col("vid") % 4 > 1, "pbsv")
    return n.select("vid", "sample", F.array("a0", "a1").alias("gt"), "gq", F.array(*ev).alias("ev"), bev.alias("bev"))


def nat_trios(t):
    return t.nation.select(F.col("n_nationkey").alias("sample"), (F.col("n_nationkey") + 1).alias("father"), (F.col("n_nationkey") + 2).alias("mother"))


@query(f"""WITH {EMIT}
SELECT {PLOT} AS bucket, c.gq, tr_enveloped AS tr, caller, CAST(count(*) FILTER (f.a0 + f.a1 > 0 OR m.a0 + m.a1 > 0) AS BIGINT) AS inherited, CAST(count(*) FILTER (NOT (f.a0 + f.a1 > 0 OR m.a0 + m.a1 > 0)) AS BIGINT) AS de_novo
FROM e c JOIN nc f ON f.vid = c.vid AND f.sample = c.sample + 1 JOIN nc m ON m.vid = c.vid AND m.sample = c.sample + 2 JOIN annotated n ON n.vid = c.vid
WHERE c.a0 + c.a1 > 0 GROUP BY ALL""")
def trio_gq_table(t):
    return k.trio_gq_table(nat_calls(t), t.annotated, nat_trios(t), ["vid"], by_caller=True)


EVAL_SITES = """SELECT s.vid AS id, s.chrom, s.pos, s.ref, s.alt, n.allele_type, n.allele_length, n.tr_enveloped, s.pos - 1 + CASE WHEN n.allele_type = 'del' THEN abs(n.allele_length) ELSE length(s.ref) END AS en
 FROM sites s JOIN annotated n ON n.vid = s.vid"""
TRUTH_SITES = """SELECT vid AS id, chrom, pos, lower(ref) AS ref, alt, CASE WHEN allele_type LIKE '%_ins' THEN 'ins' ELSE allele_type END AS allele_type, allele_length,
 pos - 1 + CASE WHEN allele_type = 'del' THEN abs(allele_length) ELSE length(ref) END AS en FROM truth"""
TRUTH_COLUMNS = "min(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS a0, max(CASE WHEN l_linestatus = 'F' AND l_tax < 0.04 THEN 1 ELSE 0 END) AS a1"
TRUTH_CALLS = f"""SELECT l_partkey AS id, s_nationkey AS sample, {TRUTH_COLUMNS}
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey, s_nationkey"""


def truth_inputs(t):
    """Sites and calls of both sets. The calls, read several times, come from one join and one grouping, written once."""
    ends = lambda d: d.withColumnRenamed("en", "end")
    both = kept(t.sql(TRUTH_CALLS.replace("AS id", "AS vid").replace(TRUTH_COLUMNS, f"struct({NAT_COLUMNS}) AS nc, struct({TRUTH_COLUMNS}) AS tc")), "calls")
    tc = both.select(F.col("vid").alias("id"), "sample", F.array("tc.a0", "tc.a1").alias("gt"))
    return ends(t.sql(EVAL_SITES)), nat_calls(t, both.select("vid", "sample", "nc.*")).withColumnRenamed("vid", "id"), ends(t.sql(TRUTH_SITES)), tc


def truth_pairs(exact: str, fuzzy: str) -> str:
    kind = "CASE WHEN allele_type = 'ins' THEN 'INS' WHEN allele_type = 'del' THEN 'DEL' WHEN allele_type = 'trv' THEN 'TRV' ELSE 'SNV' END"
    return f"""es AS (SELECT *, {kind} AS kind, abs(allele_length) AS len, pos - 1 AS st FROM ({EVAL_SITES}) q WHERE allele_type <> 'trv'),
ts AS (SELECT *, {kind} AS kind, abs(allele_length) AS len, pos - 1 AS st FROM ({TRUTH_SITES}) q), tc AS ({TRUTH_CALLS}),
pairs AS (SELECT e.id, t.id AS truth_id FROM es e JOIN ts t ON e.chrom = t.chrom AND e.pos = t.pos AND upper(e.ref) = upper(t.ref) AND upper(e.alt) = upper(t.alt) WHERE NOT (e.kind IN ('DEL', 'INS') AND e.len >= 20) AND {exact}
  UNION SELECT e.id, t.id FROM es e JOIN ts t ON e.chrom = t.chrom AND e.kind = t.kind WHERE e.len >= 20 AND t.len > 0 AND {fuzzy}),
own AS (SELECT DISTINCT p.id, tc.sample FROM pairs p JOIN tc ON tc.id = p.truth_id WHERE tc.a0 + tc.a1 > 0)"""


SHARE = "greatest(least(e.en, t.en) - greatest(e.st, t.st), 0) / least(e.len, t.len)"
ALIKE = "least(e.len, t.len) / greatest(e.len, t.len)"
FUZZY_TABLE = f"""abs(e.st - t.st) + abs(e.en - t.en) <= CASE WHEN e.kind = 'DEL' THEN 500 ELSE 200 END AND ((e.kind = 'DEL' AND {ALIKE} >= 0.7 - 1e-9 AND {SHARE} >= 0.7 - 1e-9) OR (e.kind = 'INS' AND {ALIKE} >= 0.5 - 1e-9))"""
FUZZY_CUTOFF = f"""t.len >= 20 AND {ALIKE} >= 0.8 - 1e-9 AND ((e.kind = 'DEL' AND {SHARE} >= 0.8 - 1e-9 AND (abs(e.st - t.st) <= 500 OR abs(e.en - t.en) <= 500)) OR (e.kind = 'INS' AND abs(e.st - t.st) <= 100))"""


@query(f"""
WITH {EMIT}, {truth_pairs('true', FUZZY_TABLE)},
x AS (SELECT {PLOT} AS bucket, caller, gq, tr_enveloped AS tr, es.id, m.id IS NOT NULL AS m, own.id IS NOT NULL AS c
  FROM e JOIN es ON es.id = e.vid LEFT JOIN (SELECT DISTINCT id FROM pairs) m ON m.id = es.id LEFT JOIN own ON own.id = es.id AND own.sample = e.sample WHERE e.a0 + e.a1 > 0)
SELECT bucket, caller, gq, tr, CAST(count(DISTINCT id) AS BIGINT) AS variants, CAST(count(DISTINCT CASE WHEN m THEN id END) AS BIGINT) AS matched, CAST(count(*) FILTER (m) AS BIGINT) AS calls_matched,
 CAST(count(*) FILTER (m AND c) AS BIGINT) AS concordant, CAST(count(*) FILTER (m AND NOT c) AS BIGINT) AS discordant FROM x GROUP BY ALL
""")
def truth_gq_table(t):
    return tr.truth_gq_table(*truth_inputs(t))


LENGTHS = "CASE WHEN abs(allele_length) < 1 THEN '0-0' WHEN abs(allele_length) < 50 THEN '1-49' WHEN abs(allele_length) < 100 THEN '50-99' WHEN abs(allele_length) < 500 THEN '100-499' WHEN abs(allele_length) < 5000 THEN '500-4999' ELSE '5000-49999' END"


@query(f"""
WITH {NAT_CALLS}, {truth_pairs("NOT (t.kind IN ('DEL', 'INS') AND t.len >= 20)", FUZZY_CUTOFF)},
x AS (SELECT kind, {LENGTHS} AS size, c.gq, own.id IS NOT NULL AS s, coalesce(f.a0 + f.a1 = 0 AND m.a0 + m.a1 = 0, false) AS d FROM nc c JOIN es ON es.id = c.vid
  LEFT JOIN nc f ON f.vid = c.vid AND f.sample = c.sample + 1 LEFT JOIN nc m ON m.vid = c.vid AND m.sample = c.sample + 2 LEFT JOIN own ON own.id = c.vid AND own.sample = c.sample WHERE c.a0 + c.a1 > 0),
tt AS (SELECT CASE WHEN kind = 'TRV' THEN 'SNV' ELSE kind END AS kind, {LENGTHS} AS size, CAST(count(*) AS BIGINT) AS truth_total FROM ts JOIN tc USING (id) WHERE a0 + a1 > 0 GROUP BY 1, 2)
SELECT kind, size, gq, calls, truth_supported, de_novo, coalesce(truth_total, 0) AS truth_total, (SELECT count(*) FROM nation) AS children FROM (
  SELECT kind, size, gq, CAST(count(*) AS BIGINT) AS calls, CAST(count(*) FILTER (s) AS BIGINT) AS truth_supported, CAST(count(*) FILTER (d) AS BIGINT) AS de_novo FROM x GROUP BY ALL) z LEFT JOIN tt USING (kind, size)
""")
def gq_cutoff_table(t):
    sites, calls, truth, truth_calls = truth_inputs(t)
    return tr.gq_cutoff_table(sites, calls, nat_trios(t), truth, truth_calls)
