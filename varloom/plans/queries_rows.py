"""Row edit, filter and id queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rows as r
from .register import query


def text_filters(df):
    """Filters back to text for comparison."""
    return df.withColumn("filters", F.array_join("filters", ";"))


def filtered_sites(t):
    return t.sites.withColumn("filters", F.split("filter_text", ";"))


@query("SELECT id, allele_type FROM sites WHERE allele_type <> 'snv' AND NOT (qual > 700)")
def subset_by_expr(t):
    return r.subset_by_expr(t.sites, "allele_type <> 'snv'", "qual > 700").select("id", "allele_type")


@query("SELECT id, allele_length FROM sites WHERE abs(allele_length) BETWEEN 100 AND 600")
def subset_by_length(t):
    return r.subset_by_length(t.sites, minimum=100, maximum=600).select("id", "allele_length")


@query("SELECT id FROM sites WHERE chrom IN ('chr3', 'chrX')")
def subset_to_contig(t):
    return r.subset_to_contig(t.sites, "chr3", "chrX").select("id")


@query("""SELECT id, 'span' AS how FROM sites WHERE chrom = 'chr7' AND pos <= 2000 AND pos + length(ref) - 1 >= 500
UNION ALL SELECT id, 'pos' FROM sites WHERE chrom = 'chr7' AND pos BETWEEN 500 AND 2000""")
def subset_to_region(t):
    a = r.subset_to_region(t.sites, "chr7", 500, 2000)
    b = r.subset_to_region(t.sites, "chr7", 500, 2000, by_span=False)
    return a.select("id", F.lit("span").alias("how")).unionByName(b.select("id", F.lit("pos").alias("how")))


def calls(t, view="genotypes"):
    """Long calls with array alleles."""
    g = getattr(t, view)
    return g.select("vid", F.col("sample_id").alias("sample"), F.array("a0", "a1").alias("gt"), "phased", "ps", "gq",
                    F.array("ad_ref", "ad_alt").alias("ad"), (F.col("ad_ref") + F.col("ad_alt")).alias("dp"))


@query("""
WITH k AS (SELECT g.* FROM genotypes g JOIN samples s USING (sample_id) WHERE s.population = 'ASIA'),
v AS (SELECT vid FROM k GROUP BY vid HAVING sum(coalesce(a0, 0) + coalesce(a1, 0)) >= 8)
SELECT vid, sample_id AS sample FROM k WHERE vid IN (SELECT vid FROM v)
""")
def subset_to_samples(t):
    keep = t.samples.filter("population = 'ASIA'").select(F.col("sample_id").alias("sample"))
    return r.subset_to_samples(calls(t), keep, ["vid"], min_ac=8).select("vid", "sample")


@query("""
SELECT vid, sample_id AS sample, CASE WHEN coalesce(a0, 0) + coalesce(a1, 0) > 0 THEN concat(
   coalesce(CAST(a0 AS STRING), '.'), '/', coalesce(CAST(a1 AS STRING), '.')) END AS gt, alt AS alts
FROM genotypes JOIN sites USING (vid) WHERE a0 > 0 OR a1 > 0
""")
def extract_sample(t):
    # The unused second ALT has to disappear from every call.
    c = calls(t).join(t.sites.select("vid", F.array("alt", F.concat("alt", F.lit("T"))).alias("alts")), "vid")
    x = r.extract_sample(c, trim_alts=True)
    gt = F.array_join(F.transform("gt", lambda a: F.coalesce(a.cast("string"), F.lit("."))), "/")
    return x.select("vid", "sample", gt.alias("gt"), F.array_join("alts", ",").alias("alts"))


@query("SELECT DISTINCT vid FROM genotypes")
def strip_genotypes(t):
    return r.strip_genotypes(calls(t)).distinct()


@query("SELECT id, chrom, pos FROM sites")
def drop_fields(t):
    return r.drop_fields(t.sites.select("id", "chrom", "pos", "qual", "motif"), "qual", "motif")


@query("SELECT id, qual AS score, motif AS unit FROM sites")
def rename_info_fields(t):
    return r.rename_info_fields(t.sites.select("id", "qual", "motif"), ["qual", "motif"], ["score", "unit"])


@query("""
WITH n AS (SELECT *, CASE chrom WHEN 'chrX' THEN 'chr23x' ELSE chrom END AS nc FROM sites)
SELECT vid, nc AS chrom, CASE WHEN length(ref) = 1 AND length(alt) = 1
  THEN concat(nc, '-', CAST(pos AS STRING), '-', ref, '-', alt) ELSE id END AS id FROM n
""")
def rename_contigs(t):
    bare = t.sites.withColumn("chrom", F.regexp_replace("chrom", "^chr", ""))
    return r.rename_contigs(bare, {"X": "chr23x"}).select("vid", "chrom", "id")


@query("""
SELECT vid, coalesce(m.new_sample, CAST(sample_id AS STRING)) AS sample FROM genotypes g LEFT JOIN
 (SELECT c_custkey, c_name AS new_sample FROM customer WHERE c_mktsegment = 'BUILDING') m ON m.c_custkey = g.sample_id
""")
def swap_sample_ids(t):
    m = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("sample"), F.col("c_name").alias("new_sample"))
    c = calls(t).withColumn("sample", F.col("sample").cast("string"))
    return r.swap_sample_ids(c, m).select("vid", "sample")


@query("""SELECT id, CASE WHEN qual > 500 AND filter_text = 'PASS' THEN 'HighQ' WHEN qual > 500 THEN concat(filter_text, ';HighQ')
 ELSE filter_text END AS filters FROM sites""")
def add_filter(t):
    return text_filters(r.add_filter(filtered_sites(t), "HighQ", "qual > 500")).select("id", "filters")


@query("SELECT id, 'PASS' AS filters FROM sites")
def reset_filters(t):
    return text_filters(r.reset_filters(filtered_sites(t))).select("id", "filters")


@query("SELECT id, CASE WHEN size < 10 THEN 'PASS' ELSE filter_text END AS filters FROM sites")
def missing_filter_to_pass(t):
    s = filtered_sites(t).withColumn("filters", F.when(F.col("size") < 5, F.lit(None)).when(F.col("size") < 10, F.array(F.lit("."))).otherwise(F.col("filters")))
    return text_filters(r.missing_filter_to_pass(s)).select("id", "filters")


@query("SELECT id, 'cohort' AS origin_tag, qual * 2 AS q2 FROM sites")
def add_info(t):
    return r.add_info(r.add_info(t.sites, "origin_tag", "cohort"), "q2", expr="qual * 2").select("id", "origin_tag", "q2")


@query("""
SELECT id, CASE WHEN brand_no < 10 THEN allele_length ELSE length(alt) - length(ref) END AS allele_length,
 CASE WHEN brand_no < 10 THEN allele_type WHEN length(alt) = length(ref) THEN 'snv' WHEN length(alt) > length(ref) THEN 'ins' ELSE 'del' END AS allele_type
FROM sites
""")
def variant_attributes(t):
    s = t.sites.withColumns({"allele_type": F.when(F.col("brand_no") < 10, F.col("allele_type")),
                             "allele_length": F.when(F.col("brand_no") < 10, F.col("allele_length"))})
    return r.variant_attributes(s).select("id", "allele_length", "allele_type")


# Common-prefix/suffix lengths counted position by position in SQL.
TRIM = """
t1 AS (SELECT id, pos, ref, alt, allele_type, least(length(ref), length(alt)) - 1 AS room FROM {src}),
t2 AS (SELECT *, coalesce((SELECT min(k) FROM unnest(generate_series(0, CAST(room AS BIGINT))) u(k)
   WHERE k = room OR substr(ref, length(ref) - CAST(k AS INT), 1) <> substr(alt, length(alt) - CAST(k AS INT), 1)), 0) AS sfx FROM t1),
t3 AS (SELECT *, substr(ref, 1, length(ref) - CAST(sfx AS INT)) AS r1, substr(alt, 1, length(alt) - CAST(sfx AS INT)) AS a1, room - sfx AS room2 FROM t2),
t4 AS (SELECT *, coalesce((SELECT min(k) FROM unnest(generate_series(0, CAST(room2 AS BIGINT))) u(k)
   WHERE k = room2 OR substr(r1, CAST(k AS INT) + 1, 1) <> substr(a1, CAST(k AS INT) + 1, 1)), 0) AS pfx FROM t3),
trimmed AS (SELECT id, allele_type, ref AS oref, alt AS oalt, CAST(pos + pfx AS INT) AS pos, substr(r1, CAST(pfx AS INT) + 1) AS ref, substr(a1, CAST(pfx AS INT) + 1) AS alt FROM t4)
"""


@query("WITH " + TRIM.format(src="sites") + "SELECT id, pos, ref, alt FROM trimmed")
def trim_alleles_suffix_first(t):
    return r.trim_sites(t.sites).select("id", "pos", "ref", "alt")


@query("WITH " + TRIM.format(src="""(SELECT concat(id, '/1') AS id, pos, ref, alt, allele_type FROM sites
  UNION ALL SELECT concat(id, '/2'), pos, ref, concat(alt, ref), allele_type FROM sites) m""") + "SELECT id, pos, ref, alt FROM trimmed")
def split_multiallelics(t):
    s = t.sites.withColumn("alts", F.array("alt", F.concat("alt", "ref"))).drop("alt")
    x = r.split_multiallelics(s)
    return x.select(F.concat("id", F.lit("/"), F.col("alt_index").cast("string")).alias("id"), "pos", "ref", "alt")


PADDED = """(SELECT id, pos, CASE WHEN size > 20 THEN concat('GA', ref) ELSE ref END AS ref,
  CASE WHEN size > 20 THEN concat('GA', alt) ELSE alt END AS alt, allele_type FROM sites) m"""


@query("WITH " + TRIM.format(src=PADDED) + """,
b AS (SELECT t.id AS original_id, t.pos, t.ref, t.alt, s.file_pos, CASE WHEN t.allele_type = 'snv'
  THEN concat(s.chrom, '-', CAST(t.pos AS STRING), '-', t.ref, '-', t.alt)
  ELSE concat(s.chrom, '-', CAST(t.pos AS STRING), '-', upper(t.allele_type), '-', CAST(abs(s.allele_length) AS STRING)) END AS base
  FROM trimmed t JOIN sites s USING (id) WHERE t.allele_type <> 'trv' AND (t.ref <> t.oref OR t.alt <> t.oalt))
SELECT original_id, pos, ref, alt, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN concat(base, '_',
  CAST(row_number() OVER (PARTITION BY base ORDER BY file_pos) AS STRING)) ELSE base END AS id FROM b
""")
def find_untrimmed(t):
    s = t.sites
    for x in ("ref", "alt"):
        s = s.withColumn(x, F.when(F.col("size") > 20, F.concat(F.lit("GA"), x)).otherwise(F.col(x)))
    return r.find_untrimmed(s).select("original_id", "pos", "ref", "alt", "id")


@query("SELECT id, pos + length(ref) - 1 AS en FROM sites WHERE allele_type = 'trv'")
def add_end_tr(t):
    return r.add_end_tr(t.sites.filter("allele_type = 'trv'")).select("id", F.col("end").alias("en"))


SV = """SELECT id, chrom, pos, ref, alt, file_pos, allele_length AS svlen, qual, size,
 CASE allele_type WHEN 'del' THEN 'DEL' WHEN 'dup' THEN 'DUP' WHEN 'trv' THEN 'BND' WHEN 'snv' THEN 'INV' ELSE 'INS' END AS svtype FROM sites"""


@query(f"""SELECT id, abs(svlen) AS svlen, CASE WHEN size > 25 THEN pos + 7 WHEN svtype IN ('INS', 'BND') THEN pos ELSE pos + abs(svlen) END AS en
 FROM ({SV}) x""")
def fix_end(t):
    s = t.sql(SV).withColumn("end", F.when(F.col("size") > 25, F.col("pos") + 7))
    return r.abs_svlen(r.fix_end(s)).select("id", "svlen", F.col("end").alias("en"))


IDS = """b AS (SELECT vid, file_pos, CASE WHEN allele_type = 'snv' THEN concat(chrom, '-', CAST(pos AS STRING), '-', ref, '-', alt)
  ELSE concat(chrom, '-', CAST(pos AS STRING), '-', upper(allele_type), '-', CAST(abs(allele_length) AS STRING)) END AS base FROM s)"""


@query(f"""
WITH s AS (SELECT vid, chrom, (pos % 1000) - (pos % 100) AS pos, ref, alt, allele_type, 100 AS allele_length, file_pos FROM sites), {IDS}
SELECT vid, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN concat(base, '_', CAST(row_number() OVER (PARTITION BY base ORDER BY file_pos) AS STRING))
 ELSE base END AS id FROM b
""")
def assign_ids(t):
    s = t.sites.withColumn("pos", F.col("pos") % 1000 - F.col("pos") % 100).withColumn("allele_length", F.lit(100))
    return r.assign_ids(s).select("vid", "id")


@query("""
WITH b AS (SELECT vid, file_pos, concat(chrom, '-', CAST(pos - pos % 400 AS STRING), '-TRV-', CAST(length(ref) - 1 AS STRING)) AS base FROM sites)
SELECT vid, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN concat(base, '_', CAST(row_number() OVER (PARTITION BY base ORDER BY file_pos) AS STRING))
 ELSE base END AS id FROM b
""")
def assign_tr_ids(t):
    return r.assign_tr_ids(t.sites.withColumn("pos", F.col("pos") - F.col("pos") % 400), less=1).select("vid", "id")


@query("SELECT vid, concat(substr(chrom, 4), ':', CAST(pos AS STRING), ':', ref, ':', alt) AS id FROM sites")
def set_id(t):
    return r.set_id(t.sites, ["chrom", "pos", "ref", "alt"], ":", strip_chr=True).select("vid", "id")


@query("""
SELECT vid, CASE WHEN allele_type = 'trv' THEN concat(chrom, '-TRV-', CAST(size - 1 AS STRING)) ELSE id END AS id,
 CASE WHEN allele_type = 'trv' THEN concat('keep-TRV-', CAST(size AS STRING)) ELSE concat('keep-TRV-', CAST(size - 1 AS STRING)) END AS trid FROM sites
""")
def decrement_tr_ids(t):
    s = t.sites.withColumn("trid", F.concat(F.lit("keep-TRV-"), F.col("size").cast("string")))
    s = s.withColumn("id", F.when(F.col("allele_type") == "trv", F.concat("chrom", F.lit("-TRV-"), F.col("size").cast("string"))).otherwise(F.col("id")))
    return r.decrement_tr_ids(s).select("vid", "id", "trid")


@query("""
WITH b AS (SELECT vid, chrom, pos - pos % 200 AS pos, concat(chrom, '-', allele_type) AS base, brand_no AS sfx, file_pos FROM sites)
SELECT vid, CASE WHEN count(*) OVER (PARTITION BY chrom, pos, base) > 1 THEN concat(base, '_',
  CAST(row_number() OVER (PARTITION BY chrom, pos, base ORDER BY sfx, file_pos) AS STRING)) ELSE base END AS id FROM b
""")
def reassign_suffixes(t):
    s = t.sites.withColumn("pos", F.col("pos") - F.col("pos") % 200).withColumn(
        "id", F.concat("chrom", F.lit("-"), "allele_type", F.lit("_"), F.col("brand_no").cast("string")))
    return r.reassign_suffixes(s).select("vid", "id")


ORIGIN = """SELECT vid, id, chrom, pos, ref, alt, allele_type, allele_length, motif, size, brand_no, file_pos,
 CASE WHEN brand_no % 5 = 0 THEN concat(chrom, ':', CAST(pos + 900 AS STRING), '-', CAST(pos + 900 + abs(allele_length) AS STRING), '_+,',
   'chr1:', CAST(pos AS STRING), '-', CAST(pos + size AS STRING), '_-')
 WHEN brand_no % 5 = 1 THEN concat(chrom, ':', CAST(pos + 8 AS STRING), '-', CAST(pos + 8 + abs(allele_length) AS STRING), '_+')
 WHEN brand_no % 5 = 2 THEN concat('chr2:', CAST(pos + 60 AS STRING), '-', CAST(pos + 60 + abs(allele_length) AS STRING), '_-')
 ELSE concat(chrom, ':', CAST(greatest(pos - 5, 0) AS STRING), '-', CAST(greatest(pos - 5, 0) + size * 19 AS STRING), '_+') END AS origin FROM sites"""


@query(f"""
WITH o AS ({ORIGIN}),
x AS (SELECT *, CASE WHEN allele_type IN ('dup') THEN 'DUP' WHEN allele_type = 'del' THEN 'DEL' ELSE 'INS' END AS svtype,
 CAST(regexp_extract(origin, ':([0-9]+)-', 1) AS INT) AS os, CAST(regexp_extract(origin, '-([0-9]+)', 1) AS INT) AS oe,
 regexp_extract(origin, '^(chr[^:]+)', 1) AS oc FROM o WHERE allele_type NOT IN ('snv', 'trv'))
SELECT id, svtype, concat('<', svtype, '>') AS alt, CASE WHEN svtype = 'DUP' THEN oc ELSE chrom END AS chrom,
 CASE WHEN svtype = 'DUP' THEN os ELSE pos END AS pos,
 CASE WHEN svtype = 'DUP' THEN oe WHEN svtype = 'INS' THEN pos + 1 ELSE pos + abs(allele_length) END AS en,
 CASE WHEN svtype = 'DUP' THEN oe - os ELSE abs(allele_length) END AS svlen, CASE WHEN svtype = 'DUP' THEN pos END AS original_pos FROM x
""")
def convert_symbolic(t):
    s = t.sql(ORIGIN).filter("allele_type NOT IN ('snv', 'trv')")
    return r.convert_symbolic(s).select("id", "svtype", "alt", "chrom", "pos", F.col("end").alias("en"), "svlen", "original_pos")


@query("SELECT id, chrom, pos, ref, alt FROM sites WHERE allele_type NOT IN ('snv', 'trv')")
def revert_symbolic(t):
    s = t.sql(ORIGIN).filter("allele_type NOT IN ('snv', 'trv')")
    return r.revert_symbolic(r.convert_symbolic(s), s).select("id", "chrom", "pos", "ref", "alt")


@query("SELECT t.id, s.ref, s.alt FROM truth t JOIN sites s ON t.vid = s.vid")
def restore_alleles(t):
    orig = t.sites.select(F.concat(F.lit("T"), F.col("vid").cast("string")).alias("id"), "ref", "alt")
    return r.restore_alleles(t.truth.select("id", "ref", "alt"), orig)


@query(f"""
WITH x AS ({SV}), a AS (SELECT id, pos, CASE WHEN svtype = 'DUP' THEN 'INS' ELSE svtype END AS svtype, abs(svlen) AS svlen,
  CASE WHEN svtype = 'DUP' THEN pos + 1 ELSE pos + abs(svlen) END AS en FROM x)
SELECT id, svtype, en FROM a UNION ALL SELECT id, 'DUP', pos + svlen FROM a WHERE svtype = 'INS'
""")
def dup_ins_recast(t):
    s = t.sql(SV).withColumns({"end": F.col("pos") + F.abs("svlen"), "alt": F.concat(F.lit("<"), "svtype", F.lit(">"))})
    return r.ins_to_dup(r.dup_to_ins(s)).select("id", "svtype", F.col("end").alias("en"))


@query(f"SELECT id, svtype, CASE WHEN svtype = 'DUP' THEN concat('<', svtype, '>') ELSE 'N' END AS alt FROM ({SV}) x")
def orig_dup_to_dup(t):
    return r.orig_dup_to_dup(r.dup_to_ins(
        t.sql(SV).withColumns({"end": F.col("pos"), "alt": F.when(F.col("svtype") == "DUP", "<DUP>").otherwise("N")}))).select("id", "svtype", "alt")


@query("""
SELECT id, concat('chr9:', CAST(greatest(1, pos - abs(length(ref) - length(alt)) - 100) + size AS STRING), '-',
 CAST(greatest(1, pos - abs(length(ref) - length(alt)) - 100) + size * 2 AS STRING), '_+,', chrom, ':5-9_-') AS origin FROM sites
""")
def absolute_origin(t):
    s = t.sites.withColumn("origin", F.concat(F.lit("flank_x_chr9:77:"), F.col("size").cast("string"), F.lit("-"), (F.col("size") * 2).cast("string"), F.lit("_+,"), "chrom", F.lit(":5-9_-")))
    return r.absolute_origin(s).select("id", "origin")


@query(f"""
WITH o AS ({ORIGIN}), x AS (SELECT *, CAST(regexp_extract(origin, ':([0-9]+)-', 1) AS INT) AS os, CAST(regexp_extract(origin, '-([0-9]+)_', 1) AS INT) AS oe FROM o),
y AS (SELECT *, allele_type = 'dup' AND abs(allele_length) >= 50 AND brand_no % 5 <> 0
  AND least(abs(allele_length), oe - os) * 1.0 / greatest(abs(allele_length), oe - os) >= 0.9
  AND (pos BETWEEN os AND oe OR abs(os - pos) <= 10 OR abs(oe - pos) <= 10) AS tandem FROM x)
SELECT id, CASE WHEN allele_type = 'dup' THEN 'tandem_dup' WHEN allele_type IN ('alu_ins', 'sva_ins', 'line_ins') THEN allele_type END AS allele_subtype,
 CASE WHEN allele_type = 'dup' AND NOT tandem THEN 'ins' WHEN allele_type IN ('alu_ins', 'sva_ins', 'line_ins') THEN 'ins' ELSE allele_type END AS allele_type FROM y
""")
def transform_allele_type(t):
    return r.transform_allele_type(t.sql(ORIGIN)).select("id", "allele_subtype", "allele_type")


@query("""
SELECT id, CASE WHEN cut THEN 'ins' ELSE allele_type END AS allele_type, CASE WHEN NOT cut THEN name END AS sub_family
FROM (SELECT *, (allele_type = 'alu_ins' AND abs(allele_length) NOT BETWEEN 250 AND 350) OR
 (allele_type = 'sva_ins' AND abs(allele_length) NOT BETWEEN 1000 AND 4000) AS cut FROM sites) x
""")
def prune_meis(t):
    return r.prune_meis(t.sites.withColumn("sub_family", F.col("name"))).select("id", "allele_type", "sub_family")


@query("SELECT id, allele_type = 'trv' AND length(motif) = 1 AS homopolymer_trv FROM sites")
def flag_homopolymer_tr(t):
    return r.flag_homopolymer_tr(t.sites.withColumn("motifs", F.concat("motif", F.lit(",.,"), "motif", F.lit("A")))).select("id", "homopolymer_trv")


@query("SELECT id FROM sites WHERE allele_type <> 'trv' OR (length(motif) >= 3 AND abs(length(alt) - length(ref)) >= 4 AND length(ref) <= 40)")
def filter_tr(t):
    s = t.sites.withColumns({"motifs": F.col("motif"), "alts": F.array("alt")})
    return r.filter_tr(s, 3, 4, 40).select("id")


@query("SELECT id FROM sites WHERE filter_text NOT LIKE '%Large%'")
def drop_by_filter(t):
    return r.drop_by_filter(filtered_sites(t), ["Large"]).select("id")


@query("SELECT id, qual FROM sites WHERE allele_type IN ('ins', 'del') AND chrom IN ('chr1', 'chr2', 'chr3')")
def select_columns(t):
    return r.select_columns(t.sites, ["id", "qual"], {"allele_type": ["ins", "del"], "chrom": ["chr1", "chr2", "chr3"]})


@query("""
SELECT chrom, motif AS id, string_agg(alt, ',' ORDER BY file_pos) AS alt, string_agg(CAST(qual AS STRING), ',' ORDER BY file_pos) AS value
FROM sites WHERE allele_type = 'trv' GROUP BY chrom, motif
UNION ALL SELECT chrom, motif, alt, CAST(qual AS STRING) FROM sites WHERE allele_type <> 'trv'
""")
def collapse_multiallelics(t):
    s = t.sites.withColumns({"id": F.col("motif"), "pos": F.lit(1), "value": F.col("qual"), "ref": F.when(F.col("allele_type") == "trv", F.lit("N")).otherwise(F.col("ref"))})
    return r.collapse_multiallelics(s).select("chrom", "id", "alt", "value")


@query("""SELECT id, CASE brand_no % 3 WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 100 END AS score_trgt_prio,
 CASE brand_no % 3 WHEN 0 THEN 10 WHEN 1 THEN 100 ELSE 1 END AS score_dvsv_prio FROM sites WHERE NOT (size > 30)""")
def priority_scores(t):
    src = F.when(F.col("brand_no") % 3 == 0, "DeepVariant").when(F.col("brand_no") % 3 == 1, "HPRC_SV_Integration").otherwise("TRGT")
    s = t.sites.withColumns({"tr_enveloped": F.col("size") > 30, "source": src})
    return r.priority_scores(r.remove_tr_enveloped(s)).select("id", "score_trgt_prio", "score_dvsv_prio")


@query("""
SELECT id, CASE WHEN allele_length = 0 THEN 'SNV' WHEN allele_type = 'del' THEN 'DEL' WHEN allele_type = 'trv' THEN 'OTHER' ELSE 'INS' END AS site_class,
 CASE WHEN allele_length = 0 THEN 'SNV' WHEN abs(allele_length) < 30 THEN '1-29' WHEN abs(allele_length) < 50 THEN '30-49' WHEN abs(allele_length) < 501 THEN '50-500'
 WHEN abs(allele_length) < 5001 THEN '501-5000' ELSE '5001-50000' END AS size_bin FROM sites
""")
def classify_sites(t):
    return r.classify_sites(t.sites).select("id", "site_class", "size_bin")


@query("""SELECT id, CAST(row_number() OVER (ORDER BY CASE chrom WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 ELSE CAST(substr(chrom, 4) AS INT) END,
  pos, abs(allele_length), regexp_replace(id, '_[0-9]+$', ''), file_pos) AS BIGINT) AS rank FROM (SELECT id, chrom, pos, allele_length, file_pos FROM sites) x""")
def sort_same_position(t):
    # The sort itself is the operator; a dense rank of the sorted stream makes the order checkable.
    s = r.sort_same_position(t.sites.select("id", "chrom", "pos", "allele_length"))
    ordered = s.withColumn("o", F.monotonically_increasing_id()).withColumn("all_rows", F.lit(1))
    from ..operators.positions import number_rows
    from ..session import cut_lineage
    return number_rows(cut_lineage(ordered), ["all_rows"], "o", "rank").select("id", "rank")
