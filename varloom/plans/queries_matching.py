"""Matching and evidence queries."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import genotype as g
from ..operators import collapse as co, evidence as ev, matching as m
from ..session import cut_lineage, kept
from .queries_rows import calls
from .register import query

SVQ = """SELECT id, chrom, pos AS st, pos + CASE WHEN ty IN ('DEL', 'DUP') THEN n ELSE 1 END AS en, n AS len, ty AS svtype, ref, alt, vid, filter_text
FROM (SELECT *, abs(allele_length) AS n, CASE WHEN allele_type = 'del' THEN 'DEL' WHEN allele_type = 'dup' THEN 'DUP' WHEN allele_type = 'snv' THEN 'SNV' WHEN allele_type = 'trv' THEN 'INV' ELSE 'INS' END AS ty FROM {0}) z WHERE ty <> 'SNV'"""


def svs(t, view="sites"):
    return t.sql(SVQ.format(view)).withColumnsRenamed({"st": "start", "en": "end"})


def subtypes(d):
    """Insertions under several of their names."""
    n = F.col("vid") % 4
    name = F.when(n == 1, "INS:ME").when(n == 2, "INS:ME:ALU").when(n == 3, "SVA").otherwise("INS")
    inv = F.when(n == 1, "CPX").otherwise("INV")
    return d.withColumn("svtype", F.when(F.col("svtype") == "INS", name).when(F.col("svtype") == "INV", inv).otherwise(F.col("svtype")))


Q = f"q AS ({SVQ.format('sites')}), r AS ({SVQ.format('truth')})"

CAT = """SELECT chrom, pos AS st, pos + length(ref) AS en, substr(ref, 2) AS seq, CASE brand_no % 4 WHEN 0 THEN 'SINE/Alu' WHEN 1 THEN 'L1HS' WHEN 2 THEN 'SVA_E' ELSE 'LTR' END AS designation,
 CAST(brand_no AS STRING) AS sub_family FROM truth WHERE allele_type = 'del'"""


@query(f"""
WITH d AS (SELECT id, chrom, pos AS st, pos + length(ref) AS en, ref FROM sites WHERE allele_type = 'del'),
k AS (SELECT *, CASE WHEN designation LIKE 'SINE%' THEN 'ALU' WHEN designation LIKE 'L1%' THEN 'LINE' WHEN designation LIKE 'SVA%' THEN 'SVA' END AS kind FROM ({CAT}) c),
p AS (SELECT d.id, k.st, k.en, kind, sub_family, d.st AS dst, d.en AS den, least(d.en, k.en) - greatest(d.st, k.st) AS ov, levenshtein(substr(d.ref, 2), k.seq) AS ed, greatest(length(d.ref) - 1, length(k.seq)) AS ml
  FROM d JOIN k ON d.chrom = k.chrom AND d.st < k.en AND k.st < d.en WHERE kind IS NOT NULL)
SELECT id, kind AS me_type, sub_family FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY st, en, kind, sub_family) AS n FROM p
 WHERE least(den - dst, en - st) / greatest(den - dst, en - st) >= 0.7 AND abs(st - dst) + abs(en - den) <= 500 AND 1 - ed / ml >= 0.7) z WHERE n = 1
""")
def med_match(t):
    d = t.sites.filter("allele_type = 'del'").select("id", "chrom", F.col("pos").alias("start"), (F.col("pos") + F.length("ref")).alias("end"), "ref")
    return m.med_match(d, t.sql(CAT).withColumnsRenamed({"st": "start", "en": "end"})).select("id", "me_type", "sub_family")


MEIC = "SELECT id, chrom, pos, size + 1 AS length, alt FROM truth WHERE allele_type IN ('ins', 'alu_ins', 'sva_ins', 'line_ins')"
PT = "SELECT id, chrom, pos, 'ins' AS allele_type, size AS allele_length, size + 1 AS sv_length, ref, alt FROM sites WHERE allele_type IN ('ins', 'alu_ins')"
RM = "SELECT chrom, st AS pos, 300 AS length FROM features WHERE cls <> 'SD'"


@query(f"""
WITH t0 AS ({PT}), e AS ({MEIC}), rm AS ({RM}), ok AS (SELECT DISTINCT e.* FROM e JOIN rm ON e.chrom = rm.chrom AND e.pos - 1 < rm.pos + 200 AND greatest(rm.pos - 1 - 200, 0) < e.pos)
SELECT t0.id, min(ok.id) AS mei_id FROM t0 JOIN ok ON t0.chrom = ok.chrom AND abs(t0.pos - ok.pos) <= 200 AND least(sv_length, length) / greatest(sv_length, length) >= 0.6
 AND 1 - levenshtein(t0.alt, ok.alt) / greatest(length(t0.alt), length(ok.alt)) >= 0.5
 AND least(t0.pos + sv_length, ok.pos + length) - greatest(t0.pos, ok.pos) >= 0.3 * greatest(sv_length, length) GROUP BY t0.id
""")
def palmer_match(t):
    return m.palmer_match(t.sql(PT), None, t.sql(MEIC), None, t.sql(RM), buffer=200, reciprocal=0.3, seq_sim=0.5, size_sim=0.6)


@query(f"""
WITH t0 AS ({PT}), e AS ({MEIC}), rm AS ({RM}), ok AS (SELECT DISTINCT e.* FROM e JOIN rm ON e.chrom = rm.chrom AND e.pos - 1 < rm.pos + 200 AND greatest(rm.pos - 1 - 200, 0) < e.pos),
a AS (SELECT s.id, sample_id FROM genotypes JOIN sites s USING (vid) WHERE coalesce(a0, 1) <> 0 OR coalesce(a1, 1) <> 0), b AS (SELECT s.id, sample_id FROM genotypes2 JOIN truth s USING (vid) WHERE coalesce(a0, 1) <> 0 OR coalesce(a1, 1) <> 0),
p AS (SELECT t0.id, ok.id AS mid FROM t0 JOIN ok ON t0.chrom = ok.chrom AND abs(t0.pos - ok.pos) <= 200 AND least(sv_length, length) / greatest(sv_length, length) >= 0.6
 AND 1 - levenshtein(t0.alt, ok.alt) / greatest(length(t0.alt), length(ok.alt)) >= 0.5 AND least(t0.pos + sv_length, ok.pos + length) - greatest(t0.pos, ok.pos) >= 0.3 * greatest(sv_length, length)),
n AS (SELECT p.id, p.mid FROM p JOIN a ON a.id = p.id JOIN b ON b.id = p.mid AND b.sample_id = a.sample_id GROUP BY p.id, p.mid HAVING count(*) >= 2)
SELECT id, min(mid) AS mei_id FROM n GROUP BY id
""")
def palmer_match_shared_carriers(t):
    c = calls(t).join(t.sites.select("vid", "id"), "vid")
    tc = m.transferable_carriers(c)
    mc = m.transferable_carriers(calls(t, "genotypes2").join(t.truth.select("vid", "id"), "vid"))
    return m.palmer_match(t.sql(PT), tc, t.sql(MEIC), mc, t.sql(RM), buffer=200, reciprocal=0.3, seq_sim=0.5, size_sim=0.6, min_shared=2)


@query(f"""
WITH {Q}, p AS (SELECT q.id, r.id AS rid, abs(q.st - r.st) + abs(q.en - r.en) AS d, r.st AS rst FROM q JOIN r ON q.chrom = r.chrom AND q.svtype = r.svtype WHERE q.len > 0 AND r.len > 0
  AND least(q.len, r.len) / greatest(q.len, r.len) >= CASE WHEN q.svtype = 'INS' THEN 0.5 ELSE 0.7 END AND q.svtype IN ('DEL', 'DUP', 'INS')
  AND abs(q.st - r.st) + abs(q.en - r.en) <= CASE WHEN q.svtype = 'INS' THEN 200 ELSE 500 END
  AND greatest(0, least(q.en, r.en) - greatest(q.st, r.st)) >= CASE WHEN q.svtype = 'INS' THEN 0.0 ELSE 0.7 END * least(q.len, r.len)),
a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, rst, rid) AS n FROM p) z WHERE n = 1),
f AS (SELECT q.id, r.id AS rid, abs(q.st + 4 - r.st) + abs(q.st + 5 - r.en) AS d, r.st AS rst FROM q JOIN r ON q.chrom = r.chrom AND r.svtype = 'INS' WHERE q.svtype = 'DUP' AND q.id NOT IN (SELECT id FROM a)
  AND least(q.len, r.len) / greatest(q.len, r.len) >= 0.5 AND abs(q.st + 4 - r.st) + abs(q.st + 5 - r.en) <= 200)
SELECT id, rid AS match_id, d AS distance FROM a UNION ALL SELECT id, rid, d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, rst, rid) AS n FROM f) z WHERE n = 1
""")
def dbvar_match(t):
    return m.dbvar_match(svs(t).withColumn("original_pos", F.col("start") + 5), svs(t, "truth"))


RANGED = """SELECT id, rid FROM (SELECT q.id, r.id AS rid, row_number() OVER (PARTITION BY q.id ORDER BY (least(q.en, r.en) - greatest(q.st, r.st)) / greatest(q.len, r.len) DESC, r.st DESC, r.id DESC) AS n
 FROM q JOIN r ON q.chrom = r.chrom AND q.st < r.en AND r.st < q.en WHERE q.svtype = '{0}' AND r.svtype = '{0}' AND (least(q.en, r.en) - greatest(q.st, r.st)) / greatest(q.len, r.len) > 0.5) z WHERE n = 1"""
POINT = """SELECT id, rid FROM (SELECT q.id, r.id AS rid, abs(q.st - r.st) AS d, r.len / q.len AS k, row_number() OVER (PARTITION BY q.id ORDER BY abs(q.st - r.st), r.st DESC, r.id DESC) AS n
 FROM q JOIN r ON q.chrom = r.chrom WHERE q.svtype = '{0}' AND r.svtype = '{1}') z WHERE n = 1 AND d < 100 AND k < 10 AND k > 0.1"""


@query(f"WITH {Q} SELECT id, rid AS truth_id FROM ({RANGED.format('DEL')}) x")
def sv_closest_ranged(t):
    return m.sv_closest_ranged(svs(t).filter("svtype = 'DEL'"), svs(t, "truth").filter("svtype = 'DEL'"))


@query(f"WITH {Q} SELECT id, rid AS truth_id FROM ({POINT.format('INS', 'INS')}) x")
def sv_closest_point(t):
    return m.sv_closest_point(svs(t).filter("svtype = 'INS'"), svs(t, "truth").filter("svtype = 'INS'"))


CLOSEST = f"""one AS ({RANGED.format('DEL')} UNION ALL {RANGED.format('DUP')} UNION ALL {POINT.format('INS', 'INS')}{{0}}),
two AS (SELECT * FROM ({POINT.format('INS', 'DUP')}) a WHERE id NOT IN (SELECT id FROM one) UNION ALL SELECT * FROM ({POINT.format('DUP', 'INS')}) b WHERE id NOT IN (SELECT id FROM one)),
both_steps AS (SELECT * FROM one UNION ALL SELECT * FROM two)"""


@query(f"WITH {Q}, {CLOSEST.format('')} SELECT b.id, b.rid AS truth_id, r.filter_text AS truth_filter FROM both_steps b JOIN r ON r.id = b.rid")
def sv_closest_match(t):
    r = subtypes(svs(t, "truth")).withColumnRenamed("filter_text", "filter")
    return m.sv_closest_match(subtypes(svs(t)), r).select("id", "truth_id", "truth_filter")


@query(f"""WITH {Q}, {CLOSEST.format(' UNION ALL ' + RANGED.format('INV'))} SELECT q.id, b.rid AS x_id, u.ac AS x_ac FROM q LEFT JOIN both_steps b USING (id) LEFT JOIN truth u ON u.id = b.rid""")
def external_af_match(t):
    r = svs(t, "truth").join(t.truth.select("id", "ac"), "id")
    return m.external_af_match(svs(t), {"x": r}, ["ac"])


def sim_cols(t, view):
    return svs(t, view).withColumns({"kind": F.col("svtype"), "seq": F.when(F.length("alt") > F.length("ref"), F.col("alt")).otherwise(F.col("ref"))}).select("id", *m.SEQ)


def sim_sql(view):
    return f"SELECT id, chrom, st, len, svtype AS kind, CASE WHEN length(alt) > length(ref) THEN alt ELSE ref END AS seq FROM ({SVQ.format(view)}) v"


SCORE = """CASE WHEN upper(q.seq) = upper(r.seq) THEN 1.0 WHEN length(q.seq) = 0 OR length(r.seq) = 0 THEN 0.0
 ELSE 1.0 - levenshtein(upper(q.seq), upper(r.seq)) / greatest(length(q.seq), length(r.seq)) END"""
NEAR = "q.chrom = r.chrom AND q.kind = r.kind AND abs(q.st - r.st) <= 500 AND q.len > 0 AND r.len > 0 AND least(q.len, r.len) / greatest(q.len, r.len) >= {0} - 1e-9"


def round_sql(t, before):
    n = str(t).replace(".", "")
    out = " AND ".join(["TRUE"] + [f"id NOT IN (SELECT id FROM m{x}) AND b_id NOT IN (SELECT b_id FROM m{x})" for x in before])
    return f"""p{n} AS (SELECT * FROM p WHERE score >= {t} AND {out}),
m{n} AS (SELECT a.id, a.b_id, 'SIMILAR_{t}' AS match_type FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, d, b_id) AS n FROM p{n}) a
 JOIN (SELECT *, row_number() OVER (PARTITION BY b_id ORDER BY score DESC, d, id) AS n FROM p{n}) b ON a.id = b.id AND a.b_id = b.b_id AND a.n = 1 AND b.n = 1)"""


@query(f"""WITH qa AS ({sim_sql('sites')}), ra AS ({sim_sql('truth')}),
q AS (SELECT chrom, st, len, kind, seq, min(id) AS id FROM qa GROUP BY ALL), r AS (SELECT chrom, st, len, kind, seq, min(id) AS id FROM ra GROUP BY ALL),
p AS (SELECT q.id, r.id AS b_id, {SCORE} AS score, abs(q.st - r.st) AS d FROM q JOIN r ON {NEAR.format(0.7)}),
{round_sql(0.9, [])}, {round_sql(0.7, ['09'])}, {round_sql(0.5, ['09', '07'])},
m AS (SELECT * FROM m09 UNION ALL SELECT * FROM m07 UNION ALL SELECT * FROM m05)
SELECT qa.id, m.b_id AS truth_id, m.match_type FROM qa JOIN q ON q.chrom = qa.chrom AND q.st = qa.st AND q.len = qa.len AND q.kind = qa.kind AND q.seq = qa.seq JOIN m ON m.id = q.id""")
def similarity_match(t):
    return m.similarity_match(sim_cols(t, "sites"), sim_cols(t, "truth"))


OVERLAP_SHAPE = """SELECT id, chrom, pos AS st, pos + CASE WHEN ty = 'INS' THEN 1 ELSE abs(allele_length) END AS en, abs(allele_length) AS len, ty AS svtype, ty AS kind, CASE WHEN length(alt) >= length(ref) THEN alt ELSE ref END AS seq
 FROM (SELECT *, CASE WHEN upper(allele_type) LIKE '%DEL%' THEN 'DEL' WHEN upper(allele_type) LIKE '%DUP%' THEN 'DUP' ELSE 'INS' END AS ty FROM {0}) z"""


@query(f"""WITH ex AS (SELECT s.id, max(t.id) AS truth_id FROM sites s JOIN truth t USING (chrom, pos, ref, alt) GROUP BY s.id),
qa AS (SELECT * FROM ({OVERLAP_SHAPE.format('sites')}) x WHERE len >= 10 AND id NOT IN (SELECT id FROM ex)), ra AS (SELECT * FROM ({OVERLAP_SHAPE.format('truth')}) x WHERE len >= 10),
qc AS (SELECT chrom, st, len, kind, seq, min(id) AS id FROM qa GROUP BY ALL), rc AS (SELECT chrom, st, len, kind, seq, min(id) AS id FROM ra GROUP BY ALL),
p AS (SELECT q.id, r.id AS b_id, {SCORE} AS score, abs(q.st - r.st) AS d FROM qc q JOIN rc r ON {NEAR.format(0.7)}),
{round_sql(0.9, [])}, {round_sql(0.7, ['09'])}, {round_sql(0.5, ['09', '07'])},
m AS (SELECT * FROM m09 UNION ALL SELECT * FROM m07 UNION ALL SELECT * FROM m05),
sim AS (SELECT qa.id, m.b_id AS truth_id, m.match_type FROM qa JOIN qc ON qc.chrom = qa.chrom AND qc.st = qa.st AND qc.len = qa.len AND qc.kind = qa.kind AND qc.seq = qa.seq JOIN m ON m.id = qc.id),
q AS (SELECT * FROM qa WHERE len >= 50 AND id NOT IN (SELECT id FROM sim)), r AS ({OVERLAP_SHAPE.format('truth')}),
{CLOSEST.format('')},
y AS (SELECT id, truth_id, 'EXACT' AS match_type, false AS sv FROM ex UNION ALL SELECT id, truth_id, match_type, false FROM sim UNION ALL SELECT id, rid, 'CLOSEST', true FROM both_steps)
SELECT y.id, y.match_type, y.truth_id, t.ac AS "AC", t.an AS "AN", CASE WHEN sv THEN t.size ELSE CAST(trunc(t.an / 2.0 - t.size - (t.ac - 2 * t.size)) AS BIGINT) END AS "N_HOMREF",
 CASE WHEN sv THEN t.brand_no ELSE t.ac - 2 * t.size END AS "N_HET", CASE WHEN sv THEN 0 ELSE t.size END AS "N_HOMALT" FROM y JOIN truth t ON t.id = y.truth_id""")
def callset_overlap(t):
    s = t.sites.withColumn("filters", F.split("filter_text", ";"))
    tr = t.truth.withColumn("filters", F.split("filter_text", ";")).withColumnsRenamed({"ac": "AC", "an": "AN"}).withColumn("nhomalt", F.col("size"))
    sv = tr.withColumns({"N_HOMREF": F.col("size"), "N_HET": F.col("brand_no"), "N_HOMALT": F.lit(0)})
    return m.callset_overlap(s, tr, sv).select("id", "match_type", "truth_id", "AC", "AN", "N_HOMREF", "N_HET", "N_HOMALT")


def collapse_input(t):
    """Both call sets in one: near copies sit a few bases apart."""
    return sim_cols(t, "sites").unionByName(sim_cols(t, "truth"))


@query(f"""WITH RECURSIVE u AS ({sim_sql('sites')} UNION ALL {sim_sql('truth')}), q AS (SELECT chrom, st, len, kind, seq, min(id) AS id FROM u GROUP BY ALL),
e AS (SELECT q.id, list(r.id ORDER BY r.st, r.id) AS early FROM q JOIN q r ON {NEAR.format(0.9)} AND (r.st < q.st OR (r.st = q.st AND r.id < q.id)) AND {SCORE} >= 0.9 GROUP BY q.id),
o AS (SELECT q.chrom, q.id, early, row_number() OVER (PARTITION BY q.chrom ORDER BY q.st, q.id) AS n FROM q LEFT JOIN e USING (id)),
g AS (SELECT DISTINCT chrom, CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS kept, CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS kept_id FROM o UNION ALL
 SELECT chrom, n, CASE WHEN k IS NULL THEN list_append(kept, id) ELSE kept END, id, coalesce(k, id)
 FROM (SELECT o.chrom, o.n, g.kept, o.id, list_filter(o.early, lambda x: list_contains(g.kept, x))[1] AS k FROM g JOIN o ON o.chrom = g.chrom AND o.n = g.n + 1) s)
SELECT u.id, g.kept_id FROM u JOIN q ON q.chrom = u.chrom AND q.st = u.st AND q.len = u.len AND q.kind = u.kind AND q.seq = u.seq JOIN g ON g.id = q.id""")
def collapse_sites(t):
    return co.collapse_sites(collapse_input(t))


# Both call sets merged as one cohort: the most common site of similar ones stays, by limits of its kind.
KINDS = "CASE WHEN svtype = 'DEL' THEN 'DEL' WHEN svtype IN ('INS', 'DUP') THEN 'INS' ELSE 'OTHER' END"
BOTH_CALLS = "SELECT concat('V', CAST(vid AS VARCHAR)) AS id, sample_id AS sample, a0, a1 FROM genotypes UNION ALL SELECT concat('T', CAST(vid AS VARCHAR)), sample_id, a0, a1 FROM genotypes2"
MERGED = f"""bc AS ({BOTH_CALLS}), car AS (SELECT DISTINCT id, sample FROM bc WHERE coalesce(a0, 0) > 0 OR coalesce(a1, 0) > 0), sup AS (SELECT id, count(*) AS n FROM car GROUP BY id),
u AS (SELECT z.id, z.chrom, z.st, z.len, {KINDS} AS kind, CASE WHEN length(alt) > length(ref) THEN alt ELSE ref END AS seq, coalesce(sup.n, 0) AS sup FROM ({SVQ.format('sites')} UNION ALL {SVQ.format('truth')}) z LEFT JOIN sup USING (id)),
q AS (SELECT chrom, st, len, kind, seq, max(sup) AS sup, arg_min(id, (-sup, id)) AS id FROM u GROUP BY chrom, st, len, kind, seq),
e AS (SELECT q.id, list(r.id ORDER BY r.sup DESC, r.st, r.id) AS early FROM q JOIN q r ON q.kind <> 'OTHER' AND {NEAR.format(0.5)} AND q.len <= 50000 AND r.len <= 50000 AND abs(q.st - r.st) <= CASE WHEN q.kind = 'DEL' THEN 500 ELSE 200 END
  AND (r.sup > q.sup OR (r.sup = q.sup AND (r.st < q.st OR (r.st = q.st AND r.id < q.id)))) AND {SCORE} >= 0.5 GROUP BY q.id),
o AS (SELECT q.chrom, q.id, early, row_number() OVER (PARTITION BY q.chrom ORDER BY q.sup DESC, q.st, q.id) AS n FROM q LEFT JOIN e USING (id)),
g AS (SELECT DISTINCT chrom, CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS kept, CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS kept_id FROM o UNION ALL
 SELECT chrom, n, CASE WHEN k IS NULL THEN list_append(kept, id) ELSE kept END, id, coalesce(k, id)
 FROM (SELECT o.chrom, o.n, g.kept, o.id, list_filter(o.early, lambda x: list_contains(g.kept, x))[1] AS k FROM g JOIN o ON o.chrom = g.chrom AND o.n = g.n + 1) s),
cl AS (SELECT u.id, u.st, g.kept_id FROM u JOIN q ON q.chrom = u.chrom AND q.st = u.st AND q.len = u.len AND q.kind = u.kind AND q.seq = u.seq JOIN g ON g.id = q.id),
jc AS (SELECT cl.id, count(a.sample) AS na, count(b.sample) AS nb, count(*) FILTER (a.sample IS NOT NULL AND b.sample IS NOT NULL) AS i FROM cl LEFT JOIN (SELECT cl.id, s.sample FROM cl JOIN car s ON s.id = cl.id OR s.id = cl.kept_id GROUP BY ALL) w ON w.id = cl.id
  LEFT JOIN car a ON a.id = cl.id AND a.sample = w.sample LEFT JOIN car b ON b.id = cl.kept_id AND b.sample = w.sample WHERE cl.id <> cl.kept_id GROUP BY cl.id),
fin AS (SELECT cl.id, cl.st, CASE WHEN jc.id IS NOT NULL AND na + nb > 0 AND i / (na + nb - i) < 0.5 THEN cl.id ELSE kept_id END AS kept_id FROM cl LEFT JOIN jc USING (id))"""


def merged(t):
    t.keep_calls("genotypes", "genotypes2")
    kinds = F.when(F.col("svtype") == "DEL", "DEL").when(F.col("svtype").isin("INS", "DUP"), "INS").otherwise("OTHER")
    seq = F.when(F.length("alt") > F.length("ref"), F.col("alt")).otherwise(F.col("ref"))
    own = lambda view, mark: calls(t, view).select(F.concat(F.lit(mark), F.col("vid").cast("string")).alias("id"), "sample", "gt")
    both = own("genotypes", "V").unionByName(own("genotypes2", "T"))
    carriers = kept(co.carriers(both), "carriers")
    support = carriers.groupBy("id").agg(F.count("sample").alias("support"))
    sites = svs(t).unionByName(svs(t, "truth")).withColumns({"kind": kinds, "seq": seq}).join(support, "id", "left")
    clusters = cut_lineage(co.alike_carriers(co.collapse_sites(sites, co.MERGE_LIMITS, common=True), carriers))
    return sites, both, clusters


@query(f"""WITH RECURSIVE {MERGED}, c AS (SELECT fin.kept_id, bc.*, fin.st FROM bc JOIN fin USING (id)),
f AS (SELECT *, row_number() OVER (PARTITION BY kept_id, sample ORDER BY CASE WHEN coalesce(a0, 0) > 0 OR coalesce(a1, 0) > 0 THEN 0 ELSE 1 END, CASE WHEN id = kept_id THEN 0 ELSE 1 END, st, id) AS n FROM c WHERE id = kept_id OR coalesce(a0, 0) > 0 OR coalesce(a1, 0) > 0),
k AS (SELECT kept_id, count(*) AS calls, count(*) FILTER (coalesce(a0, 0) > 0 OR coalesce(a1, 0) > 0) AS carriers, count(*) FILTER (id <> kept_id) AS filled FROM f WHERE n = 1 GROUP BY kept_id)
SELECT kept_id, CAST(count(*) AS BIGINT) AS merge_count, CASE WHEN count(*) > 1 THEN 'TRUVARI' ELSE 'UNIQUE' END AS merge_type, coalesce(max(calls), 0) AS calls, coalesce(max(carriers), 0) AS carriers, coalesce(max(filled), 0) AS filled
FROM fin LEFT JOIN k USING (kept_id) GROUP BY kept_id""")
def consolidate_collapsed(t):
    sites, both, clusters = merged(t)
    c = co.merged_calls(clusters, both, sites)
    n = c.groupBy(F.col("id").alias("kept_id")).agg(F.count("*").alias("calls"), F.count_if(g.is_carrier("gt")).alias("carriers"), F.count_if(F.col("source") != F.col("id")).alias("filled"))
    return co.merge_info(clusters).join(n, "kept_id", "left").fillna(0, ["calls", "carriers", "filled"])


NOTES = "SELECT id, 'NAME' AS key, name AS value FROM sites WHERE size % 3 = 0 UNION ALL SELECT id, 'MOTIF', motif FROM sites WHERE size % 2 = 0 UNION ALL SELECT id, 'AC', CAST(ac AS VARCHAR) FROM truth UNION ALL SELECT id, 'MOTIF', CASE WHEN size % 5 > 0 THEN motif END FROM truth"


@query(f"""WITH RECURSIVE {MERGED} SELECT kept_id AS id, key, value, id AS source FROM (
  SELECT fin.kept_id, x.key, x.value, fin.id, row_number() OVER (PARTITION BY fin.kept_id, x.key ORDER BY CASE WHEN fin.id = fin.kept_id THEN 0 ELSE 1 END, fin.st, fin.id) AS n FROM fin JOIN ({NOTES}) x ON x.id = fin.id WHERE value IS NOT NULL) z WHERE n = 1""")
def merged_fields(t):
    sites, _, clusters = merged(t)
    return co.merged_fields(clusters, t.sql(NOTES.replace("VARCHAR", "STRING")), sites)


@query("""SELECT chrom, pos, ref, alt, CAST(count(*) AS BIGINT) AS merge_count, CASE WHEN count(*) = 1 THEN 'UNIQUE' WHEN bool_or(allele_type = 'trv') THEN 'TRV_EXACT' ELSE 'EXACT' END AS merge_type
 FROM (SELECT chrom, pos, ref, alt, allele_type FROM sites UNION ALL SELECT chrom, pos, ref, alt, allele_type FROM truth) u GROUP BY chrom, pos, ref, alt""")
def exact_merge_info(t):
    cols = ["chrom", "pos", "ref", "alt", "allele_type"]
    return co.exact_merge_info(t.sites.select(*cols).unionByName(t.truth.select(*cols)))


@query(f"""
WITH {Q}, f AS (SELECT concat('F', CAST(fid AS STRING)) AS id, chrom, st, en, en - st AS len, 'DEL' AS svtype FROM features),
a AS (SELECT id, chrom, st, en, len FROM q WHERE svtype = 'DEL'),
b AS (SELECT r.id, r.chrom, r.st, r.en, r.len FROM r WHERE svtype = 'DEL' AND NOT EXISTS (SELECT 1 FROM a WHERE a.chrom = r.chrom AND least(a.en, r.en) - greatest(a.st, r.st) >= 0.5 * greatest(a.en - a.st, r.en - r.st)
  AND least(a.en, r.en) > greatest(a.st, r.st) AND least(a.len, r.len) / greatest(a.len, r.len) >= 0.6 AND abs(a.st - r.st) <= 30)),
u AS (SELECT *, 1 AS set_index FROM a UNION ALL SELECT *, 2 FROM b),
c AS (SELECT f.id FROM f WHERE NOT EXISTS (SELECT 1 FROM u a WHERE a.chrom = f.chrom AND least(a.en, f.en) - greatest(a.st, f.st) >= 0.5 * greatest(a.en - a.st, f.en - f.st)
  AND least(a.en, f.en) > greatest(a.st, f.st) AND least(a.len, f.len) / greatest(a.len, f.len) >= 0.6 AND abs(a.st - f.st) <= 30))
SELECT id, set_index FROM u UNION ALL SELECT id, 3 FROM c
""")
def agglomerate(t):
    def dels(d):
        return d.filter("svtype = 'DEL'").select("id", "chrom", "start", "end", "len", F.col("svtype").alias("kind"), "ref", "alt")
    f = t.features.select(F.concat(F.lit("F"), F.col("fid").cast("string")).alias("id"), "chrom", F.col("st").alias("start"), F.col("en").alias("end"), (F.col("en") - F.col("st")).alias("len"),
                          F.lit("DEL").alias("kind"), F.lit("N").alias("ref"), F.lit("<DEL>").alias("alt"))
    return m.agglomerate([dels(svs(t)), dels(svs(t, "truth")), f], 0.5, 0.6, 30).select("id", "set_index")


CALLER = "CASE brand_no % 3 WHEN 0 THEN 'pbsv' WHEN 1 THEN 'delly' ELSE 'sniffles' END"
CALLS = f"c AS (SELECT r.*, {CALLER} AS caller, an AS ref_depth, u.ac AS alt_depth FROM r JOIN truth u USING (id) WHERE r.len >= 50)"
SUPPORT = f"""sup AS (SELECT * FROM (SELECT q.id, c.caller, c.ref_depth, c.alt_depth, abs(q.st - c.st) AS d, row_number() OVER (PARTITION BY q.id, c.caller ORDER BY abs(q.st - c.st), c.st, c.id DESC) AS n FROM q JOIN c
  ON q.chrom = c.chrom AND q.svtype = c.svtype AND c.caller <> 'sniffles') z WHERE n = 1 AND d <= 500)"""

# Raw calls of six callers, each with its own depth fields; one of them of two ALTs, one with a field missing, one without any.
WHICH = "CASE vid % 6 WHEN 0 THEN 'pbsv' WHEN 1 THEN 'delly' WHEN 2 THEN 'sniffles' WHEN 3 THEN 'sawfish' WHEN 4 THEN 'cutesv' ELSE 'dipcall' END"


def raw_calls(d):
    """``vid, sample, r, a`` (depths) with the caller's own fields."""
    text = lambda k: F.col(k).cast("string")
    ad = F.concat_ws(",", F.when(F.col("vid") % 5 == 0, F.lit(".")).otherwise(text("r")), text("a"))
    fields = (F.when(F.col("caller") == "pbsv", F.create_map(F.lit("AD"), ad)).when(F.col("caller") == "delly", F.create_map(F.lit("RR"), text("r"), F.lit("RV"), text("a")))
              .when(F.col("caller") == "sniffles", F.create_map(F.lit("DR"), text("r"), F.lit("DV"), text("a"))).when(F.col("caller") == "sawfish", F.create_map(F.lit("AD"), F.concat_ws(",", "r", "a", F.lit("7"))))
              .when(F.col("caller") == "cutesv", F.create_map(F.lit("DR"), text("r"))).otherwise(F.create_map(F.lit("GT"), F.lit("0/1"))))
    alts = F.when(F.col("caller") == "sawfish", F.array("alt", F.lit("A" * 60))).otherwise(F.array("alt"))
    return d.withColumn("caller", F.expr(WHICH)).withColumns({"fields": fields, "alts": alts, "svlen": F.col("len")})


READ = """CASE WHEN caller = 'pbsv' AND vid % 5 = 0 OR caller IN ('cutesv', 'dipcall') THEN NULL ELSE r END AS r,
 CASE WHEN caller = 'pbsv' AND vid % 5 = 0 OR caller IN ('cutesv', 'dipcall') THEN NULL WHEN caller = 'sawfish' AND abs(abs(60 - length(ref)) - want) < abs(abs(length(alt) - length(ref)) - want) THEN 7 ELSE a END AS a"""
LISTED = "CASE vid % 3 WHEN 1 THEN ['pbsv', 'delly', 'hapdiff', 'dipcall'] ELSE CASE WHEN vid % 4 = 2 THEN [] ELSE ['sniffles', 'sawfish', 'cutesv'] END END"


@query(f"""WITH {Q}, v AS (SELECT q.*, sample_id AS sample FROM q JOIN genotypes g ON g.vid = q.vid WHERE coalesce(a0, 0) + coalesce(a1, 0) > 0),
s AS (SELECT id, chrom, st, len, svtype, vid, {LISTED} AS callers FROM q WHERE vid % 3 > 0),
n AS (SELECT * FROM (SELECT q.id, s.callers, s.svtype, s.len, row_number() OVER (PARTITION BY q.id ORDER BY abs(q.st - s.st), s.st, s.vid) AS k FROM q JOIN s ON s.chrom = q.chrom AND s.svtype = q.svtype AND len(s.callers) > 0 AND abs(q.st - s.st) <= 500 WHERE q.vid % 3 = 0) z WHERE k = 1),
l AS (SELECT id, callers, svtype, len FROM s UNION ALL SELECT id, callers, svtype, len FROM n),
w AS (SELECT v.id, v.sample, v.chrom, v.st, l.svtype, l.len AS want, unnest(l.callers) AS caller FROM v JOIN l ON l.id = v.id),
c AS (SELECT r.*, {WHICH.replace('vid', 'r.vid')} AS caller, g.sample_id AS sample, g.ad_ref AS r, g.ad_alt AS a FROM r JOIN genotypes2 g ON g.vid = r.vid WHERE r.len >= 50),
m AS (SELECT w.id, w.sample, w.caller, w.want, c.r, c.a, c.vid, c.ref, c.alt, row_number() OVER (PARTITION BY w.id, w.sample, w.caller ORDER BY abs(w.st - c.st), c.st, c.vid) AS k
  FROM w JOIN c ON c.sample = w.sample AND c.chrom = w.chrom AND c.svtype = w.svtype AND c.caller = w.caller AND abs(w.st - c.st) <= 500 WHERE w.caller NOT IN ('dipcall', 'hapdiff'))
SELECT id, sample, caller, r AS ref_depth, a AS alt_depth FROM (SELECT id, sample, caller, {READ} FROM m WHERE k = 1) z WHERE r IS NOT NULL""")
def caller_support(t):
    q, r = svs(t), svs(t, "truth")
    v = calls(t).join(q.select("id", "vid", "chrom", "start", "svtype"), "vid")
    text = lambda *names: F.array(*[F.lit(x) for x in names])
    listed = F.when(F.col("vid") % 3 == 1, text("pbsv", "delly", "hapdiff", "dipcall")).when(F.col("vid") % 4 == 2, F.array().cast("array<string>")).otherwise(text("sniffles", "sawfish", "cutesv"))
    stats = q.filter("vid % 3 > 0").select("id", "chrom", "start", "svtype", F.col("len").alias("svlen"), listed.alias("callers"), F.col("vid").alias("file_order"))
    g2 = t.genotypes2.select("vid", F.col("sample_id").alias("sample"), F.col("ad_ref").alias("r"), F.col("ad_alt").alias("a"))
    return ev.caller_support(v, stats, raw_calls(g2.join(r, "vid")).withColumn("file_order", F.col("vid")))


@query(f"""WITH {Q} SELECT svtype, CASE WHEN len < 100 THEN '50-99' WHEN len < 500 THEN '100-499' WHEN len < 5000 THEN '500-4999' ELSE '5000+' END AS bucket, caller, CAST(count(*) AS BIGINT) AS n
FROM q JOIN (SELECT id, {CALLER} AS caller FROM sites UNION ALL SELECT id, 'pav' FROM sites) k USING (id) GROUP BY ALL""")
def caller_counts(t):
    v = svs(t).withColumn("svlen", F.col("len")).join(t.sites.select("id", F.concat(F.expr(CALLER), F.lit(", pav")).alias("supp")), "id")
    return m.caller_counts(v)


@query(f"""WITH {Q}, {CALLS}, {SUPPORT}, n AS (SELECT svtype, CASE WHEN len < 100 THEN 0 WHEN len < 500 THEN 1 WHEN len < 5000 THEN 2 ELSE 3 END AS b, caller, count(*) AS n FROM q JOIN (SELECT id, {CALLER} AS caller FROM sites) k USING (id) GROUP BY ALL),
s AS (SELECT q.id, sup.caller, sup.ref_depth, sup.alt_depth, coalesce(n.n, 0) AS n FROM q JOIN sup USING (id) LEFT JOIN n ON n.svtype = q.svtype AND n.caller = sup.caller AND n.b = CASE WHEN len < 100 THEN 0 WHEN len < 500 THEN 1 WHEN len < 5000 THEN 2 ELSE 3 END),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, caller) AS k FROM s) z WHERE k = 1), e AS (SELECT id, string_agg(caller, ',' ORDER BY caller) AS ev FROM s GROUP BY id)
SELECT q.id, b.caller AS bev, e.ev, b.alt_depth, CASE WHEN b.id IS NULL THEN 'NO_AD' ELSE 'FILLED' END AS status FROM q LEFT JOIN b USING (id) LEFT JOIN e USING (id)""")
def best_caller(t):
    q, r = svs(t).withColumns({"svlen": F.col("len"), "sample": F.lit("s"), "gt": F.array(F.lit(1))}), svs(t, "truth")
    lists = q.select("id", "chrom", "start", "svtype", "svlen", F.array(F.lit("pbsv"), F.lit("delly")).alias("callers"), F.col("vid").alias("file_order"))
    text = lambda k: F.col(k).cast("string")
    fields = F.when(F.col("caller") == "pbsv", F.create_map(F.lit("AD"), F.concat_ws(",", text("an"), text("ac")))).otherwise(F.create_map(F.lit("RR"), text("an"), F.lit("RV"), text("ac")))
    raw = r.join(t.truth.select("id", "ac", "an", F.expr(CALLER).alias("caller")), "id").withColumns({"sample": F.lit("s"), "svlen": F.col("len"), "alts": F.array("alt"), "fields": fields, "file_order": -F.dense_rank().over(W.partitionBy("chrom", "start").orderBy("id"))})
    c = ev.caller_support(q, lists, raw)
    v2 = q.join(t.sites.select("id", F.expr(CALLER).alias("supp")), "id")
    out = m.best_caller(v2, c)
    return out.select("id", "bev", F.array_join("ev", ",").alias("ev"), F.element_at("ad", 2).alias("alt_depth"), "status")


LIKELY = "list_sort([CAST(round_even(-10 * (l0 - greatest(l0, l1, l2)), 0) AS INT), CAST(round_even(-10 * (l1 - greatest(l0, l1, l2)), 0) AS INT), CAST(round_even(-10 * (l2 - greatest(l0, l1, l2)), 0) AS INT)])[2]"
SAW = f"""WITH {Q}, v AS (SELECT q.*, svtype AS kind, CASE WHEN length(alt) > length(ref) THEN alt ELSE ref END AS seq, sample_id AS sample, a0, a1, ad_ref + ad_alt AS dp,
  CASE WHEN coalesce(a0, 0) > 0 THEN 1 ELSE 0 END + CASE WHEN coalesce(a1, 0) > 0 THEN 1 ELSE 0 END AS n FROM q JOIN genotypes g ON g.vid = q.vid),
kp AS (SELECT vid, sample_id AS sample, a0 AS k0, a1 AS k1, ad_ref AS r, ad_alt AS a, CASE WHEN coalesce(a0, 0) > 0 THEN 1 ELSE 0 END + CASE WHEN coalesce(a1, 0) > 0 THEN 1 ELSE 0 END AS kn FROM genotypes2 WHERE vid % 3 = 0),
ls AS (SELECT *, CASE WHEN vid % 4 = 0 THEN ['pbsv', 'sniffles'] ELSE ['delly', 'sawfish', 'dipcall'] END AS callers FROM q WHERE vid % 4 < 2),
fz AS (SELECT id, callers, row_number() OVER (PARTITION BY id ORDER BY score DESC, st, vid) AS k FROM (SELECT x.id, l.callers, l.st, l.vid,
  least(x.len, l.len) / greatest(x.len, l.len) + greatest(0, least(x.en, l.en) - greatest(x.st, l.st)) / greatest(greatest(1, x.en - x.st), greatest(1, l.en - l.st)) + greatest(0.0, 1.0 - abs(l.st - x.st) / 50) AS score
  FROM q x JOIN ls l ON l.chrom = x.chrom AND l.svtype = x.svtype AND abs(l.st - x.st) <= 50 WHERE x.vid % 4 >= 2) z),
al AS (SELECT id, callers FROM ls UNION ALL SELECT id, callers FROM fz WHERE k = 1),
c AS (SELECT r.*, svtype AS kind, CASE WHEN length(alt) > length(ref) THEN alt ELSE ref END AS seq, {WHICH.replace('vid', 'r.vid')} AS caller, g.sample_id AS sample, g.ad_ref AS r, g.ad_alt AS a,
  CASE WHEN coalesce(a0, 0) > 0 THEN 1 ELSE 0 END + CASE WHEN coalesce(a1, 0) > 0 THEN 1 ELSE 0 END AS cn FROM r JOIN genotypes2 g ON g.vid = r.vid),
pr AS (SELECT q.id, q.sample, q.n, q.len AS want, r.caller, r.cn, r.r, r.a, r.vid, r.ref, r.alt, r.st, {SCORE} AS sim, least(q.len, r.len) / greatest(q.len, r.len) AS size_sim,
  greatest(0, least(q.st + q.len, r.st + r.len) - greatest(q.st, r.st)) / greatest(q.len, r.len) AS ovl FROM v q JOIN c r ON q.sample = r.sample AND {NEAR.format(0.7)} WHERE q.n > 0),
bm AS (SELECT *, row_number() OVER (PARTITION BY id, sample, caller ORDER BY (sim + size_sim + ovl) / 3 DESC, st, vid) AS k FROM pr WHERE sim >= 0.7),
mt AS (SELECT bm.id, bm.sample, caller, n = cn AS same, {READ} FROM bm LEFT JOIN al USING (id) WHERE k = 1 AND (al.id IS NULL OR list_contains(al.callers, caller))),
su AS (SELECT id, sample, caller, r, a FROM mt WHERE same UNION ALL SELECT v.id, v.sample, 'kanpig', kp.r, kp.a FROM v JOIN kp USING (vid, sample) WHERE v.n > 0 AND v.n = kp.kn),
sl AS (SELECT *, a * log10(0.05) + r * log10(1.0 - 0.05) AS l0, a * log10(0.5) + r * log10(0.5) AS l1, a * log10(0.95) + r * log10(1.0 - 0.95) AS l2 FROM su),
sg AS (SELECT *, CASE WHEN r + a = 0 THEN 0 ELSE least(99, {LIKELY}) END AS gq FROM sl),
bv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY CASE WHEN caller = 'kanpig' THEN 0 ELSE 1 END, gq DESC, caller) AS k FROM sg WHERE r IS NOT NULL) z WHERE k = 1),
ev AS (SELECT id, sample, string_agg(CASE WHEN r IS NULL THEN caller ELSE concat(caller, '_(', r, '_', a, ')') END, ';' ORDER BY caller) AS ev FROM su GROUP BY id, sample),
kq AS (SELECT vid, sample, k0, k1, kn, r, a, CASE WHEN r + a = 0 THEN 0 ELSE least(99, {LIKELY}) END AS gq, kn = 0 AND NOT (k0 IS NULL AND k1 IS NULL) AS rested FROM (
  SELECT *, a * log10(0.05) + r * log10(1.0 - 0.05) AS l0, a * log10(0.5) + r * log10(0.5) AS l1, a * log10(0.95) + r * log10(1.0 - 0.95) AS l2 FROM kp) z)"""


def evidence(t):
    t.keep_calls("genotypes", "genotypes2", columns=("a0", "a1", "ad_ref", "ad_alt"))
    calls = lambda view: getattr(t, view).select("vid", F.col("sample_id").alias("sample"), F.array("a0", "a1").alias("gt"), F.array("ad_ref", "ad_alt").alias("ad"), (F.col("ad_ref") + F.col("ad_alt")).alias("dp"))
    q, r = svs(t), svs(t, "truth")
    seq = F.when(F.length("alt") > F.length("ref"), F.col("alt")).otherwise(F.col("ref"))
    v = calls("genotypes").drop("ad").join(q, "vid").withColumns({"kind": F.col("svtype"), "seq": seq, "pos": F.col("start"), "alts": F.array("alt"), "svlen": F.col("len")})
    g2 = calls("genotypes2")
    again = g2.filter("vid % 3 = 0").join(q.select("vid", "id", "chrom", F.col("start").alias("pos"), F.lower("ref").alias("ref"), F.array("alt").alias("alts")), "vid")
    raw = raw_calls(g2.withColumns({"r": F.get("ad", F.lit(0)), "a": F.get("ad", F.lit(1))}).join(r, "vid")).withColumns({"kind": F.col("svtype"), "seq": seq, "file_order": F.col("vid") * 1_000_000 + F.col("sample")})
    text = lambda *names: F.array(*[F.lit(x) for x in names])
    lists = q.filter("vid % 4 < 2").withColumns({"svlen": F.col("len"), "file_order": F.col("vid"), "callers": F.when(F.col("vid") % 4 == 0, text("pbsv", "pav", "sniffles")).otherwise(text("delly", "sawfish", "kanpig", "dipcall"))})
    return ev.raw_caller_evidence(v, again, raw, lists, list_window=50)


@query(f"""{SAW}
SELECT v.id, v.sample, CASE WHEN v.n > 0 THEN concat(coalesce(CAST(a0 AS VARCHAR), '.'), ',', coalesce(CAST(a1 AS VARCHAR), '.')) WHEN kq.vid IS NULL THEN concat(coalesce(CAST(coalesce(a0, a1) AS VARCHAR), '.'), ',', CASE WHEN a0 IS NULL OR a1 IS NULL THEN '.' ELSE '0' END)
  WHEN kq.rested THEN '0,0' ELSE '.,.' END AS gt,
 CASE WHEN v.n > 0 THEN CASE WHEN bv.caller = 'kanpig' THEN kq.r + kq.a WHEN bv.caller IS NOT NULL THEN v.dp END WHEN kq.rested THEN kq.r + kq.a END AS dp,
 CASE WHEN v.n > 0 THEN bv.r WHEN kq.rested THEN kq.r END AS ref_depth, CASE WHEN v.n > 0 THEN bv.a WHEN kq.rested THEN kq.a END AS alt_depth, CASE WHEN v.n > 0 THEN bv.gq WHEN kq.rested THEN kq.gq END AS gq, ev.ev, bv.caller AS bev
FROM v LEFT JOIN kq ON kq.vid = v.vid AND kq.sample = v.sample LEFT JOIN bv ON bv.id = v.id AND bv.sample = v.sample LEFT JOIN ev ON ev.id = v.id AND ev.sample = v.sample""")
def raw_caller_evidence(t):
    x = evidence(t)
    gt = F.array_join(F.transform("gt", lambda a: F.coalesce(a.cast("string"), F.lit("."))), ",")
    return x.select("id", "sample", gt.alias("gt"), "dp", F.get("ad", F.lit(0)).alias("ref_depth"), F.get("ad", F.lit(1)).alias("alt_depth"), "gq", F.array_join("ev", ";").alias("ev"), "bev")


@query(f"""{SAW}, f AS (SELECT v.id, v.sample, v.n > 0 AS c, v.n > 0 AND kq.vid IS NOT NULL AS ks, v.n > 0 AND coalesce(v.n = kq.kn, false) AS kg, coalesce(x.site, false) AS ns, coalesce(x.same, false) AS ng, coalesce(x.deep, false) AS nd
  FROM v LEFT JOIN kq ON kq.vid = v.vid AND kq.sample = v.sample LEFT JOIN (SELECT id, sample, true AS site, bool_or(same) AS same, bool_or(same AND r IS NOT NULL) AS deep FROM mt GROUP BY id, sample) x ON x.id = v.id AND x.sample = v.sample)
SELECT sample, CAST(count(*) FILTER (c) AS BIGINT) AS count, CAST(count(*) FILTER (ks OR ns) AS BIGINT) AS count_match_site, CAST(count(*) FILTER (kg OR ng) AS BIGINT) AS count_match_gt, CAST(count(*) FILTER (kg OR nd) AS BIGINT) AS count_match_gt_ad,
 CAST(count(*) FILTER (ks) AS BIGINT) AS count_match_site_kp, CAST(count(*) FILTER (kg) AS BIGINT) AS count_match_gt_kp, CAST(count(*) FILTER (kg) AS BIGINT) AS count_match_gt_ad_kp, CAST(count(*) FILTER (ns) AS BIGINT) AS count_match_site_nonkp,
 CAST(count(*) FILTER (ng) AS BIGINT) AS count_match_gt_nonkp, CAST(count(*) FILTER (nd) AS BIGINT) AS count_match_gt_ad_nonkp FROM f GROUP BY sample""")
def caller_match_counts(t):
    return ev.match_counts(evidence(t))


MEET = "s.chrom = x.chrom AND s.st < x.en AND x.st < s.en"


@query(f"""WITH {Q}, s AS (SELECT id, chrom, CASE WHEN svtype = 'DUP' AND vid % 5 = 0 THEN 'CNV' ELSE svtype END AS t, st, greatest(en, st + 1) AS en FROM q),
f AS (SELECT name AS gene, chrom, st, en FROM features), ex AS (SELECT gene, chrom, st + 40 AS st, st + 90 AS en FROM f), pr AS (SELECT gene, chrom, st - 200 AS st, st AS en FROM f),
ut AS (SELECT gene, chrom, st, st + 40 AS en FROM f), nc AS (SELECT concat('E', gene) AS gene, chrom, st + 260 AS st, st + 280 AS en FROM f),
g AS (SELECT s.id, s.t, x.gene, x.st <= s.st AND s.en <= x.en AS inside, s.st <= x.st AND x.en <= s.en AS spans, x.st >= s.st AND x.st < s.en AS tss FROM s JOIN f x ON {MEET}),
e AS (SELECT s.id, x.gene, bool_or(s.st <= x.st AND x.en <= s.en) AS exon_whole, bool_or(x.st <= s.st AND s.en <= x.en) AS in_exon FROM s JOIN ex x ON {MEET} GROUP BY s.id, x.gene),
u AS (SELECT DISTINCT s.id, x.gene FROM s JOIN ut x ON {MEET}),
c AS (SELECT g.id, g.gene, CASE WHEN t = 'CNV' AND e.id IS NOT NULL THEN 'MSV_EXON_OVR' WHEN t = 'DUP' AND spans THEN 'COPY_GAIN' WHEN t = 'INV' AND spans THEN 'INV_SPAN' WHEN t = 'DUP' AND inside AND exon_whole THEN 'INTRAGENIC_EXON_DUP'
  WHEN t = 'DUP' AND inside AND in_exon THEN 'PARTIAL_EXON_DUP' WHEN t = 'DUP' AND NOT inside AND tss THEN 'TSS_DUP' WHEN t = 'DUP' AND NOT inside THEN 'DUP_PARTIAL' WHEN t IN ('DEL', 'INS', 'INV') AND e.id IS NOT NULL THEN 'LOF'
  WHEN u.id IS NOT NULL THEN 'UTR' ELSE 'INTRONIC' END AS effect FROM g LEFT JOIN e USING (id, gene) LEFT JOIN u USING (id, gene)),
p AS (SELECT DISTINCT s.id, x.gene, 'PROMOTER' AS effect FROM s JOIN pr x ON {MEET} WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.id = s.id AND c.gene = x.gene)),
o AS (SELECT * FROM c UNION ALL SELECT * FROM p), free AS (SELECT * FROM s WHERE id NOT IN (SELECT id FROM o)),
n AS (SELECT id, gene, 'NEAREST_TSS' AS effect FROM (SELECT free.id, f.gene, row_number() OVER (PARTITION BY free.id ORDER BY abs(f.st - free.st), f.st DESC, f.gene DESC) AS k FROM free JOIN f ON f.chrom = free.chrom) z WHERE k = 1),
d AS (SELECT s.id, x.gene, CASE WHEN s.st <= x.st AND x.en <= s.en THEN 'NONCODING_SPAN' ELSE 'NONCODING_BREAKPOINT' END AS effect FROM s JOIN nc x ON {MEET}),
y AS (SELECT * FROM o UNION ALL SELECT * FROM n UNION ALL SELECT * FROM d UNION ALL SELECT id, NULL, 'INTERGENIC' FROM free WHERE id NOT IN (SELECT id FROM d))
SELECT id, concat('PREDICTED_', effect) AS effect, coalesce(string_agg(DISTINCT gene, ',' ORDER BY gene), '') AS genes FROM y GROUP BY id, effect""")
def predicted_effects(t):
    f = t.features.select(F.col("name").alias("gene"), "chrom", F.col("st").alias("start"), F.col("en").alias("end"), F.col("st").alias("tss"))
    part = lambda lo, hi: f.select("gene", "chrom", (F.col("start") + lo).alias("start"), (F.col("start") + hi).alias("end"))
    s = svs(t).withColumn("svtype", F.when((F.col("svtype") == "DUP") & (F.col("vid") % 5 == 0), "CNV").otherwise(F.col("svtype")))
    elements = part(260, 280).withColumn("gene", F.concat(F.lit("E"), "gene"))
    return m.predicted_effects(s, f, part(40, 90), part(-200, 0), part(0, 40), elements).withColumn("genes", F.array_join("genes", ","))


@query(f"""
WITH x AS (SELECT id, chrom, st - st % 200 AS pos, len - len % 200 AS svlen, svtype, substr(id, 1, 3) AS g FROM ({SVQ.format('sites')}) z),
a AS (SELECT chrom, pos, svlen, string_agg(DISTINCT g, ',' ORDER BY g) AS u FROM x WHERE svtype IN ('INS', 'DUP') GROUP BY chrom, pos, svlen HAVING count(*) FILTER (svtype = 'INS') > 0 AND count(*) FILTER (svtype = 'DUP') > 0)
SELECT x.id, CASE WHEN a.u IS NOT NULL AND svtype = 'INS' THEN a.u ELSE x.g END AS "PREDICTED_LOF" FROM x LEFT JOIN a USING (chrom, pos, svlen) WHERE NOT (a.u IS NOT NULL AND svtype = 'DUP')
""")
def collapse_doubled_dups(t):
    x = svs(t).select("id", "chrom", (F.col("start") - F.col("start") % 200).alias("pos"), (F.col("len") - F.col("len") % 200).alias("svlen"), "svtype", F.array(F.substring("id", 1, 3)).alias("PREDICTED_LOF"))
    return m.collapse_doubled_dups(x, ["PREDICTED_LOF"]).select("id", F.array_join("PREDICTED_LOF", ",").alias("PREDICTED_LOF"))
