"""Interval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as iv
from .register import query

SPAN = "SELECT vid, id, chrom, pos AS st, pos + length(ref) AS en, allele_type, ref FROM sites"


def spans(t):
    return t.sql(SPAN).withColumnsRenamed({"st": "start", "en": "end"})


def feats(t):
    return t.features.withColumnsRenamed({"st": "start", "en": "end"})


@query("""
SELECT s.vid, f.fid, least(s.pos + length(s.ref), f.en) - greatest(s.pos, f.st) AS overlap
FROM sites s JOIN features f ON s.chrom = f.chrom AND s.pos < f.en AND f.st < s.pos + length(s.ref)
""")
def interval_overlap(t):
    return iv.interval_overlap(spans(t).select("vid", "chrom", "start", "end"),
                               feats(t).select("fid", "chrom", "start", "end")).select("vid", F.col("b_fid").alias("fid"), "overlap")


@query("""
WITH p AS (SELECT s.vid, f.fid, least(s.pos + abs(s.allele_length), f.en) - greatest(s.pos, f.st) AS overlap,
  abs(s.allele_length) AS la, f.en - f.st AS lb
  FROM sites s JOIN features f ON s.chrom = f.chrom AND s.pos < f.en AND f.st < s.pos + abs(s.allele_length))
SELECT vid, fid, overlap FROM p WHERE overlap >= 0.5 * la AND overlap >= 0.5 * lb
""")
def interval_overlap_reciprocal(t):
    a = t.sites.select("vid", "chrom", F.col("pos").alias("start"), (F.col("pos") + F.abs("allele_length")).alias("end"))
    b = feats(t).select("fid", "chrom", "start", "end")
    return iv.interval_overlap(a, b, min_fraction=0.5, reciprocal=True).select("vid", F.col("b_fid").alias("fid"), "overlap")


@query("""
SELECT s.vid FROM sites s WHERE NOT EXISTS (SELECT 1 FROM features f
  WHERE s.chrom = f.chrom AND s.pos < f.en AND f.st < s.pos + length(s.ref))
""")
def interval_anti(t):
    return iv.interval_anti(spans(t), feats(t)).select("vid")


@query("""
SELECT s.vid, CAST(count(f.fid) AS BIGINT) AS n_overlaps FROM sites s LEFT JOIN features f
  ON s.chrom = f.chrom AND s.pos < f.en AND f.st < s.pos + length(s.ref) GROUP BY s.vid
""")
def interval_overlap_count(t):
    return iv.overlap_count(spans(t), feats(t)).select("vid", "n_overlaps")


@query("""
WITH o AS (SELECT chrom, st, en, fid, max(en) OVER (PARTITION BY chrom ORDER BY st, en, fid
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM features),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR st > pe THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY st, en, fid) AS isl FROM o)
SELECT chrom, min(st) AS st, max(en) AS en, string_agg(CAST(fid AS STRING), ',' ORDER BY st, en, fid) AS fids
FROM g GROUP BY chrom, isl
""")
def interval_merge(t):
    m = iv.interval_merge(feats(t).select("fid", "chrom", "start", "end"), {"fids": "fid"}, order="fid")
    return m.withColumnsRenamed({"start": "st", "end": "en"})


@query("""
SELECT fid, chrom, greatest(f.st - 100, 0) AS st, least(f.en + 100, l.length) AS en
FROM features f JOIN (SELECT chrom, max(en) + 50 AS length FROM features GROUP BY chrom) l USING (chrom)
""")
def slop(t):
    f = feats(t)
    lens = f.groupBy("chrom").agg((F.max("end") + 50).alias("length"))
    return iv.slop(f, 100, lens).select("fid", "chrom", F.col("start").alias("st"), F.col("end").alias("en"))


@query("""
WITH o AS (SELECT chrom, st, en, fid, max(en) OVER (PARTITION BY chrom ORDER BY st, en, fid
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM features),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR st > pe THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY st, en, fid) AS isl FROM o),
m AS (SELECT chrom, min(st) AS st, max(en) AS en FROM g GROUP BY chrom, isl)
SELECT s.vid, round(coalesce(sum(CASE WHEN m.st IS NOT NULL THEN least(s.pos + 300, m.en) - greatest(s.pos, m.st) END), 0) / 300.0, 6) AS fraction
FROM sites s LEFT JOIN m ON s.chrom = m.chrom AND s.pos < m.en AND m.st < s.pos + 300 GROUP BY s.vid
""")
def interval_coverage(t):
    a = t.sites.select("vid", "chrom", F.col("pos").alias("start"), (F.col("pos") + 300).alias("end"))
    return iv.interval_coverage(a, feats(t)).select("vid", F.round("fraction", 6).alias("fraction"))


@query("""
WITH d AS (SELECT s.vid, f.fid, CASE WHEN s.pos < f.en AND f.st < s.pos + length(s.ref) THEN 0
   WHEN f.st >= s.pos + length(s.ref) THEN f.st - s.pos - length(s.ref) + 1 ELSE s.pos - f.en + 1 END AS distance
  FROM sites s JOIN features f ON s.chrom = f.chrom)
SELECT vid, fid, distance FROM (SELECT *, min(distance) OVER (PARTITION BY vid) AS m FROM d) x WHERE distance = m
""")
def nearest(t):
    n = iv.nearest(spans(t).select("vid", "chrom", "start", "end"), feats(t).select("fid", "chrom", "start", "end"))
    return n.select("vid", F.col("b_fid").alias("fid"), "distance")


@query("""
SELECT a.id FROM sites a WHERE NOT EXISTS (SELECT 1 FROM sites b WHERE a.chrom = b.chrom AND a.vid <> b.vid
  AND a.pos < b.pos + length(b.ref) AND b.pos < a.pos + length(a.ref)
  AND (length(a.ref) < length(b.ref) OR (length(a.ref) = length(b.ref) AND a.id > b.id)))
""")
def dedup_overlapping(t):
    return iv.dedup_overlapping(t.sites).select("id")


@query("""
WITH a AS (SELECT * FROM sites WHERE allele_type = 'trv'), b AS (SELECT * FROM truth WHERE allele_type IN ('trv', 'del')),
c AS (SELECT * FROM sites WHERE allele_type = 'ins'),
k2 AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.chrom = b.chrom AND a.pos < b.pos + length(b.ref) AND b.pos < a.pos + length(a.ref))),
u AS (SELECT id, chrom, pos, ref, 1 AS set_index FROM a UNION ALL SELECT id, chrom, pos, ref, 2 FROM k2),
k3 AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.chrom = c.chrom AND u.pos < c.pos + length(c.ref) AND c.pos < u.pos + length(u.ref)))
SELECT id, chrom, pos, set_index FROM u UNION ALL SELECT id, chrom, pos, 3 FROM k3
""")
def priority_merge(t):
    cols = ["id", "chrom", "pos", "ref"]
    s, tr = t.sites, t.truth
    sets = [s.filter("allele_type = 'trv'"), tr.filter("allele_type IN ('trv', 'del')"), s.filter("allele_type = 'ins'")]
    return iv.priority_merge([x.select(*cols) for x in sets]).select("id", "chrom", "pos", "set_index")


@query("""
WITH tr AS (SELECT * FROM truth WHERE allele_type IN ('trv', 'del'))
SELECT s.id, count(tr.id) > 0 AS tr_enveloped, arg_min(tr.id, CAST(tr.pos AS BIGINT) * 1000000 + tr.file_pos) AS trid FROM sites s LEFT JOIN tr
  ON s.chrom = tr.chrom AND s.pos >= tr.pos AND s.pos + length(s.ref) <= tr.pos + length(tr.ref) GROUP BY s.id
""")
def flag_enveloped(t):
    trs = t.truth.filter("allele_type IN ('trv', 'del')").select("chrom", "pos", "ref", "id", "file_pos")
    return iv.flag_enveloped(t.sites, trs).select("id", "tr_enveloped", "trid")


@query("""
WITH v AS (SELECT id, chrom, pos, pos + length(ref) AS en, motif FROM sites WHERE allele_type = 'trv'),
k AS (SELECT id AS locus_id, chrom, pos - 2 AS st, pos - 2 + length(ref) AS en, lower(motif) AS motif FROM truth WHERE allele_type = 'trv'),
p AS (SELECT v.*, k.locus_id, k.motif AS km, k.st, k.en AS ke, least(v.en, k.en) - greatest(v.pos, k.st) AS ov
  FROM v JOIN k ON v.chrom = k.chrom AND v.pos < k.en AND k.st < v.en),
r AS (SELECT id, locus_id, CASE WHEN ov = en - pos THEN 1 WHEN ov >= 0.7 * (en - pos) AND ov >= 0.7 * (ke - st)
   AND (upper(km) = upper(motif) OR upper(km) = upper(concat(motif, 'X'))) THEN 2 END AS rule FROM p)
SELECT id, rule, locus_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rule, locus_id) AS n FROM r WHERE rule IS NOT NULL) z WHERE n = 1
""")
def match_tr_catalog(t):
    v = t.sites.filter("allele_type = 'trv'").select(
        "id", "chrom", F.col("pos").alias("start"), (F.col("pos") + F.length("ref")).alias("end"),
        F.concat("motif", F.lit(","), "motif", F.lit("X")).alias("motifs"))
    k = t.truth.filter("allele_type = 'trv'").select(
        F.col("id").alias("locus_id"), "chrom", (F.col("pos") - 2).alias("start"),
        (F.col("pos") - 2 + F.length("ref")).alias("end"), F.lower("motif").alias("motif"))
    return iv.match_tr_catalog(v, k)


@query("""
WITH s AS (SELECT vid, chrom, pos AS st, pos + abs(allele_length) AS en, CASE allele_type WHEN 'del' THEN 'DEL' WHEN 'dup' THEN 'DUP' ELSE 'OTHER' END AS svtype FROM sites),
b AS (SELECT s.vid, max(CASE cls WHEN 'SR' THEN 3 WHEN 'SD' THEN 2 ELSE 1 END) AS v FROM s JOIN features f
  ON s.chrom = f.chrom AND ((s.st >= f.st AND s.st < f.en) OR (s.en >= f.st AND s.en < f.en)) GROUP BY s.vid),
o AS (SELECT chrom, cls, st, en, fid, max(en) OVER (PARTITION BY chrom, cls ORDER BY st, en, fid
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM features),
g AS (SELECT *, sum(CASE WHEN pe IS NULL OR st > pe THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, cls ORDER BY st, en, fid) AS isl FROM o),
m AS (SELECT chrom, cls, min(st) AS st, max(en) AS en FROM g GROUP BY chrom, cls, isl),
c AS (SELECT s.vid, m.cls, sum(least(s.en, m.en) - greatest(s.st, m.st)) / (s.en - s.st) AS f FROM s JOIN m
  ON s.chrom = m.chrom AND s.st < m.en AND m.st < s.en GROUP BY s.vid, m.cls, s.en, s.st),
l AS (SELECT vid, max(CASE WHEN f > 0.5 THEN CASE cls WHEN 'SR' THEN 3 WHEN 'SD' THEN 2 ELSE 1 END END) AS v FROM c GROUP BY vid)
SELECT s.vid, CASE CASE WHEN s.svtype IN ('DEL', 'DUP') AND s.en - s.st > 300 THEN l.v ELSE b.v END
  WHEN 3 THEN 'SR' WHEN 2 THEN 'SD' WHEN 1 THEN 'RM' ELSE 'US' END AS region
FROM s LEFT JOIN b USING (vid) LEFT JOIN l USING (vid)
""")
def region_class(t):
    s = t.sites.select("vid", "chrom", F.col("pos").alias("start"), (F.col("pos") + F.abs("allele_length")).alias("end"),
                       F.when(F.col("allele_type") == "del", "DEL").when(F.col("allele_type") == "dup", "DUP").otherwise("OTHER").alias("svtype"))
    return iv.region_class(s, feats(t).select("chrom", "start", "end", "cls"), cnv_over=300).select("vid", "region")
