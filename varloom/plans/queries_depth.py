"""Depth, matrix, report and source-shaping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import callers as ca, depth as d, reports as rp
from ..session import scratch
from ..sources import readers, writers
from .fixtures import ERFC
from .queries_rows import calls
from .register import query


def runs(t):
    return t.depth_runs.withColumnsRenamed({"sample_id": "sample", "st": "start", "en": "end"})


READS = "SELECT s_nationkey AS sample_id, chrom, st, en FROM features JOIN supplier ON fid = s_suppkey UNION ALL SELECT CAST(brand_no AS INT), chrom, pos, pos + size * 3 FROM sites"


@query(f"""
WITH e AS (SELECT sample_id, chrom, p, sum(d) AS d FROM (SELECT sample_id, chrom, st AS p, 1 AS d FROM ({READS}) a UNION ALL SELECT sample_id, chrom, en, -1 FROM ({READS}) b) x GROUP BY ALL HAVING sum(d) <> 0)
SELECT sample_id AS sample, chrom, p AS st, en, CAST(depth AS BIGINT) AS depth FROM (SELECT *, lead(p) OVER w AS en, sum(d) OVER w AS depth FROM e WINDOW w AS (PARTITION BY sample_id, chrom ORDER BY p)) y WHERE en IS NOT NULL
""")
def depth_runs(t):
    r = t.sql(READS).withColumnsRenamed({"sample_id": "sample", "st": "start", "en": "end"})
    return d.depth_runs(r).withColumnsRenamed({"start": "st", "end": "en"})


@query("""
WITH b AS (SELECT sample_id, chrom, unnest(generate_series(CAST(st AS BIGINT), CAST(en AS BIGINT) - 1)) AS p, depth FROM depth_runs),
m AS (SELECT sample_id, chrom, p // 130 AS k, count(*) AS n, median(depth) AS md FROM b GROUP BY ALL)
SELECT sample_id AS sample, CAST(k * 130 + 1 AS INT) AS st, CAST(k * 130 + 130 AS INT) AS en, CAST(trunc(md) AS INT) AS depth FROM m WHERE n = 130
""")
def bin_median_depth(t):
    return d.bin_median_depth(runs(t), 130, one_based=True).select("sample", F.col("start").alias("st"), F.col("end").alias("en"), "depth")


@query("""
WITH lim AS (SELECT min(e) AS e FROM (SELECT sample_id, max(en) AS e FROM depth_runs GROUP BY sample_id) z), n AS (SELECT count(DISTINCT sample_id) AS n FROM depth_runs),
c AS (SELECT DISTINCT p FROM (SELECT st AS p FROM depth_runs UNION ALL SELECT en FROM depth_runs UNION ALL SELECT CAST(unnest(generate_series(0, CAST((SELECT e FROM lim) AS BIGINT), 80)) AS INT)) q WHERE p <= (SELECT e FROM lim)),
b AS (SELECT p AS st, lead(p) OVER (ORDER BY p) AS en FROM c)
SELECT CAST(b.st + 1 AS INT) AS st, b.en, round(sum(depth) / max(n.n), 4) AS mean, CAST(list_sort(list(depth))[CAST(max(n.n) // 2 + 1 AS BIGINT)] AS INT) AS median, CAST(sum(depth) AS BIGINT) AS total, round(count(*) FILTER (depth > 20) / max(n.n), 4) AS over_20
FROM b JOIN depth_runs r ON r.st <= b.st AND b.st < r.en CROSS JOIN n WHERE b.en IS NOT NULL GROUP BY b.st, b.en
""")
def cohort_coverage(t):
    n = t.depth_runs.agg(F.count_distinct("sample_id").alias("n")).scalar()
    c = d.cohort_coverage(runs(t), n, 80, (5, 20))
    return c.select(F.col("start").alias("st"), F.col("end").alias("en"), F.round("mean", 4).alias("mean"), "median", "total", F.round("over_20", 4).alias("over_20"))


@query("SELECT sample_id AS sample, CAST(floor(st / 700.0) * 700 AS INT) AS st, CAST(sum(depth) AS BIGINT) AS depth FROM depth_runs GROUP BY 1, 2")
def ploidy_matrix(t):
    return d.ploidy_matrix(runs(t), 700).select("sample", F.col("start").alias("st"), "depth")


@query("""SELECT CAST(floor(sample_id / 3.0) AS BIGINT) AS third, st, max(CASE WHEN sample_id % 3 = 0 THEN depth END) AS s0, max(CASE WHEN sample_id % 3 = 1 THEN depth END) AS s1, max(CASE WHEN sample_id % 3 = 2 THEN depth END) AS s2
 FROM depth_runs GROUP BY 1, 2""")
def to_wide_matrix(t):
    """Samples side by side, three at a time; their bin lists differ, so the check stays off."""
    x = t.depth_runs.select(F.floor(F.col("sample_id") / 3).alias("third"), F.concat(F.lit("s"), (F.col("sample_id") % 3).cast("string")).alias("sample"), "st", "depth")
    return d.to_wide_matrix(x, ["s0", "s1", "s2"], keys=("third", "st"), check=False)


METH = "SELECT chrom, st, en, concat('s', CAST(fid % 3 AS STRING)) AS sample, CAST(fid AS INT) AS score FROM features UNION ALL SELECT chrom, st, en, concat('s', CAST((fid + 1) % 3 AS STRING)), CAST(fid + 5 AS INT) FROM features"


@query(f"""SELECT chrom, st, en, coalesce(max(CASE WHEN sample = 's0' THEN CAST(score AS STRING) END), '.') AS s0, coalesce(max(CASE WHEN sample = 's1' THEN CAST(score AS STRING) END), '.') AS s1,
 coalesce(max(CASE WHEN sample = 's2' THEN CAST(score AS STRING) END), '.') AS s2 FROM ({METH}) m GROUP BY chrom, st, en""")
def methylation_matrix(t):
    m = t.sql(METH).withColumnsRenamed({"st": "start", "en": "end"})
    return d.methylation_matrix(m, ["s0", "s1", "s2"]).withColumnsRenamed({"start": "st", "end": "en"})


@query("""
WITH m AS (SELECT sample_id, quantile_cont(depth, 0.5) AS a, quantile_cont(CASE WHEN depth > 0 THEN depth END, 0.5) AS z FROM depth_runs GROUP BY sample_id)
SELECT sample_id AS sample, max(a) AS median_all, max(z) AS median_nonzero, round(1.4826 * quantile_cont(CASE WHEN depth > 0 THEN abs(depth - z) END, 0.5), 6) AS mad_nonzero FROM depth_runs JOIN m USING (sample_id) GROUP BY sample_id
""")
def median_coverage(t):
    return d.median_coverage(runs(t)).withColumn("mad_nonzero", F.round("mad_nonzero", 6))


@query("SELECT chrom, st, quantile_cont(depth, 0.5) AS median FROM depth_runs GROUP BY chrom, st")
def median_by_bin(t):
    return d.median_by_bin(runs(t)).withColumnRenamed("start", "st")


@query("""
WITH x AS (SELECT s.chrom, g.ps AS sample_id, CAST(floor(s.pos / 500.0) AS INT) * 500 AS st, sum(ad_ref + ad_alt) AS depth FROM genotypes g JOIN sites s USING (vid) GROUP BY ALL),
m AS (SELECT sample_id, quantile_cont(depth, 0.5) AS m FROM x WHERE chrom NOT IN ('chrX', 'chrY') GROUP BY sample_id), c AS (SELECT x.*, 2.0 * depth / m AS cn FROM x JOIN m USING (sample_id)),
k AS (SELECT chrom, st FROM c GROUP BY chrom, st HAVING count(*) FILTER (cn <= 0.2) / count(*) > 0.8)
SELECT sample_id AS sample, chrom, round(quantile_cont(cn, 0.5), 6) AS cn FROM c WHERE (chrom, st) NOT IN (SELECT (chrom, st) FROM k) GROUP BY sample_id, chrom
""")
def copy_numbers(t):
    return d.copy_numbers(genotype_bins(t)).withColumn("cn", F.round("cn", 6))


def genotype_bins(t):
    return t.sql("""SELECT s.chrom, g.ps AS sample, CAST(floor(s.pos / 500.0) AS INT) * 500 AS start, sum(ad_ref + ad_alt) AS depth
      FROM genotypes g JOIN sites s USING (vid) GROUP BY ALL""")


@query(f"""
WITH gb AS (SELECT s.chrom, g.ps AS sample, CAST(floor(s.pos / 500.0) AS INT) * 500 AS start, sum(ad_ref + ad_alt) AS depth FROM genotypes g JOIN sites s USING (vid) GROUP BY ALL),
m AS (SELECT sample, quantile_cont(depth, 0.5) AS m FROM gb WHERE chrom NOT IN ('chrX', 'chrY') GROUP BY sample),
x AS (SELECT gb.*, 2.0 * depth / nullif(m, 0) AS cn FROM gb JOIN m USING (sample)),
bad AS (SELECT chrom, start FROM x GROUP BY chrom, start HAVING count(*) FILTER (cn <= 0.2) / count(*) > 0.8),
c AS (SELECT sample, chrom, quantile_cont(cn, 0.5) AS cn FROM x ANTI JOIN bad USING (chrom, start) GROUP BY sample, chrom),
z AS (SELECT *, (cn - avg(cn) OVER (PARTITION BY chrom)) / nullif(stddev_samp(cn) OVER (PARTITION BY chrom), 0) AS z FROM c),
p AS (SELECT *, {ERFC.format(x='(abs(z) / sqrt(2))')} AS p FROM z),
r AS (SELECT *, p * count(p) OVER (PARTITION BY chrom) / count(p) OVER (PARTITION BY chrom ORDER BY p RANGE UNBOUNDED PRECEDING) AS r FROM p),
q AS (SELECT *, least(1.0, min(r) OVER (PARTITION BY chrom ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) AS q FROM r),
xy AS (SELECT sample, CAST(round_even(max(cn) FILTER (chrom = 'chrX'), 0) AS INT) AS x, CAST(round_even(max(cn) FILTER (chrom = 'chrY'), 0) AS INT) AS y FROM c GROUP BY sample)
SELECT sample, chrom, round(cn, 4) AS cn, round(z, 4) AS z, round(p, 4) AS p, round(q, 4) AS q, x AS x_copies, y AS y_copies,
 CASE WHEN x = 1 AND y = 1 THEN 'MALE' WHEN x = 2 AND y = 0 THEN 'FEMALE' WHEN x = 1 AND y = 0 THEN 'TURNER' WHEN x = 2 AND y = 1 THEN 'KLINEFELTER'
  WHEN x = 3 AND y = 0 THEN 'TRIPLE X' WHEN x = 1 AND y = 2 THEN 'JACOBS' ELSE 'OTHER' END AS sex FROM q JOIN xy USING (sample)
""")
def ploidy_scores(t):
    out = d.ploidy_scores(d.copy_numbers(genotype_bins(t)))
    return out.select("sample", "chrom", *[F.round(c, 4).alias(c) for c in ("cn", "z", "p", "q")], "x_copies", "y_copies", "sex")


def dosage_bins(t):
    return runs(t).withColumn("bin", F.floor(F.col("start") / 200))


@query("""WITH d AS (SELECT sample_id, CAST(floor(st / 200.0) AS INT) AS bin, sum(depth) AS v FROM depth_runs GROUP BY 1, 2),
g AS (SELECT s.sample_id, b.bin, coalesce(d.v, 0) AS v FROM (SELECT DISTINCT sample_id FROM d) s CROSS JOIN (SELECT DISTINCT bin FROM d) b LEFT JOIN d ON d.sample_id = s.sample_id AND d.bin = b.bin)
SELECT a.sample_id AS sample_a, b.sample_id AS sample_b, round(corr(a.v, b.v), 6) AS r FROM g a JOIN g b USING (bin) GROUP BY 1, 2""")
def sample_correlations(t):
    return d.sample_correlations(dosage_bins(t)).withColumn("r", F.round("r", 6))


@query()
def dosage_batches(t):
    return d.dosage_batches(dosage_bins(t), 4, components=5)


@query("""
WITH l AS (SELECT sample_id, quantile_cont(depth, 0.01) AS lo, quantile_cont(depth, 0.99) AS hi FROM depth_runs GROUP BY sample_id)
SELECT chrom, st FROM depth_runs JOIN l USING (sample_id) GROUP BY chrom, st HAVING count(*) FILTER (depth < 5) / count(*) < 0.3 AND count(*) FILTER (depth < lo OR depth > hi) / count(*) < 0.05
""")
def filter_bins(t):
    return d.filter_bins(runs(t), 5, 0.3, extreme_share=0.05).withColumnRenamed("start", "st")


@query("SELECT user_id AS sample, CAST(count(*) AS BIGINT) AS n_events, CASE WHEN count(*) < 67 THEN 'PASS' ELSE 'EXCESSIVE_NUMBER_OF_EVENTS' END AS qc FROM events GROUP BY user_id")
def sample_event_qc(t):
    return d.sample_event_qc(t.events.withColumn("sample", F.col("user_id")), 67)


PROFILE = "SELECT DISTINCT CAST(floor(value * 40) AS INT) AS st FROM events WHERE event_type = 'error'"


@query(f"""
WITH g AS (SELECT DISTINCT p, sample_id FROM (SELECT st + k AS p FROM ({PROFILE}) w CROSS JOIN (SELECT unnest(generate_series(0, 2)) AS k) o) q CROSS JOIN (SELECT DISTINCT user_id AS sample_id FROM events) s)
SELECT g.sample_id AS sample, CAST(g.p AS INT) AS pos, coalesce(r.depth, 0) AS depth FROM g LEFT JOIN depth_runs r ON r.sample_id = g.sample_id AND r.st <= g.p AND g.p < r.en
""")
def depth_profile(t):
    w = t.sql(PROFILE).select(F.lit("chr1").alias("chrom"), F.col("st").alias("start"), (F.col("st") + 3).alias("end"))
    return d.depth_profile(runs(t), w, runs(t).select("sample").distinct()).select("sample", "pos", "depth")


@query("SELECT sample_id AS sample, st, depth FROM depth_runs UNION ALL SELECT sample_id, st, depth + 1 FROM depth_runs")
def concat_depth(t):
    return d.concat_depth([runs(t), runs(t).withColumn("depth", F.col("depth") + 1)]).select("sample", F.col("start").alias("st"), "depth")


# ------------------------------------------------------------------ reports

PAIRS = """SELECT s.id, concat('AF=', CAST(s.size AS STRING), ';AF_male=', CAST(s.brand_no AS STRING), ';FLAG') AS eval_info,
 concat('AF=', CAST(t.ac AS STRING), ';XY_AF=', CAST(t.an - 200 AS STRING), ',9;AN=3') AS truth_info, s.name AS eval_name, t.motif AS truth_name, s.size, s.brand_no, t.ac, t.an FROM sites s JOIN truth t USING (vid)"""


@query(f"""WITH p AS ({PAIRS}), k AS (SELECT 'af' AS af_key, size AS e, ac AS t FROM p UNION ALL SELECT 'af_xy', brand_no, an - 200 FROM p)
SELECT af_key, CAST(count(*) AS BIGINT) AS n, round(corr(e, t) * corr(e, t), 6) AS r2 FROM k WHERE e > 0 AND t > 0 GROUP BY af_key""")
def af_concordance(t):
    return rp.af_concordance(t.sql(PAIRS)).withColumn("r2", F.round("r2", 6))


@query(f"""WITH p AS ({PAIRS}), c AS (SELECT 'name' AS category, eval_name AS e, truth_name AS tr FROM p UNION ALL SELECT 'brand', CAST(brand_no AS STRING), CAST(ac / 2 % 17 AS INT)::STRING FROM p),
tot AS (SELECT category, e, row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, e) AS r FROM c GROUP BY category, e), k AS (SELECT category, e AS v FROM tot WHERE r <= 10),
m AS (SELECT c.category, CASE WHEN a.v IS NULL THEN 'Other' ELSE c.e END AS eval, CASE WHEN b.v IS NULL THEN 'Other' ELSE c.tr END AS truth FROM c LEFT JOIN k a ON a.category = c.category AND a.v = c.e LEFT JOIN k b ON b.category = c.category AND b.v = c.tr)
SELECT category, eval, truth, CAST(count(*) AS BIGINT) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY category, truth), 6) AS pct FROM m GROUP BY category, eval, truth""")
def vep_confusion(t):
    p = t.sql(PAIRS).select(F.concat_ws("|", "eval_name", F.col("brand_no").cast("string")).alias("eval_vep"), F.concat_ws("|", "truth_name", (F.col("ac") / 2 % 17).cast("int").cast("string")).alias("truth_vep"))
    return rp.vep_confusion(rp.vep_pairs(p, {"name": 0, "brand": 1})).withColumn("pct", F.round("pct", 6))


@query("""WITH m AS (SELECT DISTINCT s.id, 'EXACT' AS match_type FROM sites s JOIN truth t USING (chrom, pos, ref, alt))
SELECT allele_type, coalesce(match_type, 'NONE') AS match_type, CAST(count(*) AS BIGINT) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY allele_type), 6) AS pct FROM sites LEFT JOIN m USING (id) GROUP BY 1, 2""")
def match_summary(t):
    m = t.sites.join(t.truth.select("chrom", "pos", "ref", "alt").distinct(), ["chrom", "pos", "ref", "alt"], "left_semi").select("id", F.lit("EXACT").alias("match_type"))
    return rp.match_summary(t.sites, m).withColumn("pct", F.round("pct", 6))


MATCHES = "SELECT DISTINCT s.id, 'EXACT' AS match_type, max(t.id) OVER (PARTITION BY s.id) AS truth_id FROM sites s JOIN truth t USING (chrom, pos, ref, alt)"


def matches(t):
    return t.sql("SELECT s.id, 'EXACT' AS match_type, max(t.id) AS truth_id FROM sites s JOIN truth t USING (chrom, pos, ref, alt) GROUP BY s.id")


@query(f"""WITH m AS ({MATCHES}), n AS (SELECT count(*) AS n FROM sites)
SELECT match_type, variants, round(100.0 * variants / n.n, 6) AS pct FROM (SELECT coalesce(match_type, 'UNMATCHED') AS match_type, CAST(count(*) AS BIGINT) AS variants FROM sites LEFT JOIN m USING (id) GROUP BY 1
 UNION ALL SELECT 'TOTAL', count(*) FROM sites UNION ALL SELECT 'MATCHED', count(m.id) FROM sites LEFT JOIN m USING (id)) x, n""")
def match_totals(t):
    return rp.match_totals(t.sites, matches(t)).withColumn("pct", F.round("pct", 6))


EVAL_INFO = "SELECT id, concat('AF=', CAST(size AS STRING), ';AF_male=', CAST(brand_no AS STRING), ';FLAG') AS info, concat_ws('|', name, CAST(brand_no AS STRING), '') AS vep FROM sites"
TRUTH_INFO = "SELECT id, concat('AF=', CAST(ac AS STRING), ';XY_AF=', CAST(an - 200 AS STRING), ',9;AN=3;DP=7') AS info, concat_ws('|', motif, '', '') AS vep FROM truth"


@query(f"""WITH m AS ({MATCHES}), s AS (SELECT s.*, m.match_type, m.truth_id, t.motif AS tm, t.ac, t.an FROM sites s LEFT JOIN m USING (id) LEFT JOIN truth t ON t.id = m.truth_id),
f AS (SELECT id, 'af' AS field, CAST(CAST(size AS DOUBLE) AS VARCHAR) AS e, CAST(CAST(ac AS DOUBLE) AS VARCHAR) AS t FROM s WHERE truth_id IS NOT NULL UNION ALL SELECT id, 'af_xy', CAST(CAST(brand_no AS DOUBLE) AS VARCHAR), CAST(CAST(an - 200 AS DOUBLE) AS VARCHAR) FROM s WHERE truth_id IS NOT NULL
 UNION ALL SELECT id, 'name', name, tm FROM s WHERE truth_id IS NOT NULL UNION ALL SELECT id, 'brand', CAST(brand_no AS VARCHAR), 'N/A' FROM s WHERE truth_id IS NOT NULL)
SELECT s.id, s.truth_id IS NOT NULL AS match_status, coalesce(s.truth_id, '.') AS truth_id, s.match_type, f.field, f.e AS eval_value, f.t AS truth_value FROM s LEFT JOIN f USING (id)""")
def match_table(t):
    """Of three VEP fields the one that is empty on both sides goes."""
    return rp.match_table(t.sql(EVAL_INFO), matches(t), t.sql(TRUTH_INFO), {"name": 0, "brand": 1, "none": 2})


@query(f"SELECT id, eval_name, truth_name, CAST(size AS STRING) AS size_eval, NULLIF('', '') AS size_truth FROM ({PAIRS}) p")
def informative_columns(t):
    """Of three column pairs the one that is empty everywhere goes; the other two stay, though one is half empty."""
    none = F.lit(None).cast("string")
    p = t.sql(PAIRS).select("id", "eval_name", "truth_name", F.col("size").cast("string").alias("size_eval"), none.alias("size_truth"), F.lit(".").alias("x_eval"), F.lit("").alias("x_truth"))
    return rp.informative_columns(p, [("eval_name", "truth_name"), ("size_eval", "size_truth"), ("x_eval", "x_truth")])


TRS = """SELECT chrom, pos AS st, pos + length(ref) - 1 AS en, CASE WHEN brand_no = 12 THEN NULL ELSE ref END AS h1, CASE WHEN brand_no = 13 THEN NULL ELSE alt END AS h2,
 ref <> alt AS nr2, motif, vid FROM {0} WHERE allele_type = 'trv'"""


def tr_calls(t, view):
    return t.sql(TRS.format(view)).select("chrom", F.col("st").alias("start"), F.col("en").alias("end"), F.lit("s").alias("sample"), F.col("h1").alias("hap1"), F.col("h2").alias("hap2"),
                                          F.lit(False).alias("nonref1"), F.col("nr2").alias("nonref2"), F.length("motif").alias("motif_len"), "vid")


def concordance(t):
    return rp.str_concordance(tr_calls(t, "sites"), tr_calls(t, "truth"), t.reference, 64, order="vid")


# Sites of both sets, components of overlaps across the sets by reachability, then each haplotype call by call.
TR_LINKS = f"""calls AS (SELECT *, concat(src, chrom, ':', st, ':', en) AS k FROM (
  SELECT *, row_number() OVER (PARTITION BY src, chrom, st, en ORDER BY vid DESC) AS last FROM (SELECT 1 AS src, * FROM ({TRS.format('sites')}) a UNION ALL SELECT 2, * FROM ({TRS.format('truth')}) b) u) z WHERE last = 1),
links AS (SELECT a.k AS a, b.k AS b FROM calls a JOIN calls b ON a.src <> b.src AND a.chrom = b.chrom AND a.st <= greatest(b.en, b.st + 1) AND b.st <= greatest(a.en, a.st + 1)),
reach AS (SELECT a, a AS b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS k, min(b) AS c FROM reach GROUP BY a)"""
CONC = f"""{TR_LINKS},
m AS (SELECT comp.c, calls.* FROM calls JOIN comp USING (k)),
win AS (SELECT c, min(chrom) AS chrom, min(st) AS ws, max(en) AS we, min(CASE WHEN src = 1 THEN length(motif) END) AS ma, min(CASE WHEN src = 2 THEN length(motif) END) AS mb,
  max(CASE WHEN src = 1 AND nr2 THEN 1 ELSE 0 END) AS na, max(CASE WHEN src = 2 AND nr2 THEN 1 ELSE 0 END) AS nb FROM m GROUP BY c),
rf AS (SELECT c, substr(string_agg(r.bases, '' ORDER BY r.block), ws - min(r.block) * 64, we - ws + 1) AS ref FROM win JOIN reference r ON r.chrom = win.chrom AND r.block BETWEEN (ws - 1) // 64 AND (we - 1) // 64 GROUP BY c, ws, we),
haps AS (SELECT c, src, st, en, coalesce(h1, h2) AS x1, CASE WHEN h1 IS NOT NULL THEN h2 END AS x2 FROM m),
hc AS (SELECT c, src, h, st, en, seq, row_number() OVER (PARTITION BY c, src, h ORDER BY st, en) AS n FROM (SELECT c, src, 1 AS h, st, en, x1 AS seq FROM haps UNION ALL SELECT c, src, 2, st, en, x2 FROM haps) y WHERE seq <> ''),
fold AS (
  SELECT win.c, s.src, h.h, 0 AS n, CAST(ws - 1 AS INT) AS last, CAST('' AS VARCHAR) AS txt FROM win, (VALUES (1), (2)) s(src), (VALUES (1), (2)) h(h)
  UNION ALL
  SELECT f.c, f.src, f.h, f.n + 1, CASE WHEN length(hc.seq) > greatest(f.last - hc.st + 1, 0) THEN hc.en ELSE f.last END,
    CASE WHEN length(hc.seq) > greatest(f.last - hc.st + 1, 0) THEN concat(f.txt, substr(rf.ref, f.last - win.ws + 2, greatest(hc.st - 1 - f.last, 0)), substr(hc.seq, CAST(greatest(f.last - hc.st + 1, 0) + 1 AS INT))) ELSE f.txt END
  FROM fold f JOIN hc ON hc.c = f.c AND hc.src = f.src AND hc.h = f.h AND hc.n = f.n + 1 JOIN rf ON rf.c = f.c JOIN win ON win.c = f.c),
txt AS (SELECT c, max(CASE WHEN src = 1 AND h = 1 THEN t END) AS a1, max(CASE WHEN src = 1 AND h = 2 THEN t END) AS a2, max(CASE WHEN src = 2 AND h = 1 THEN t END) AS b1, max(CASE WHEN src = 2 AND h = 2 THEN t END) AS b2
  FROM (SELECT f.c, f.src, f.h, concat(arg_max(f.txt, f.n), substr(rf.ref, max_by(f.last, f.n) - ws + 2, greatest(we - max_by(f.last, f.n), 0))) AS t FROM fold f JOIN win USING (c) JOIN rf USING (c) GROUP BY f.c, f.src, f.h, rf.ref, ws, we) z GROUP BY c),
q AS (SELECT *, (2 - levenshtein(a1, b1) / greatest(length(a1), length(b1)) - levenshtein(a2, b2) / greatest(length(a2), length(b2))) / 2 AS s,
  (2 - levenshtein(a1, b2) / greatest(length(a1), length(b2)) - levenshtein(a2, b1) / greatest(length(a2), length(b1))) / 2 AS w FROM txt JOIN win USING (c) JOIN rf USING (c)),
conc AS (SELECT chrom, ws AS st, we AS en, CASE WHEN greatest(s, w) = 1 THEN 'EXACT' WHEN greatest(s, w) >= 0.9 THEN 'SIMILAR' ELSE 'DIVERGENT' END AS category, round(greatest(s, w), 6) AS similarity,
  CASE WHEN w > s THEN levenshtein(a1, b2) + levenshtein(a2, b1) ELSE levenshtein(a1, b1) + levenshtein(a2, b2) END AS edit_distance,
  levenshtein(a1, ref) + levenshtein(a2, ref) AS ref_distance_a, levenshtein(b1, ref) + levenshtein(b2, ref) AS ref_distance_b,
  length(a1) + length(a2) - length(b1) - length(b2) AS length_diff, we - ws + 1 AS locus_size, ma, mb, na, nb FROM q)"""


@query(f"WITH RECURSIVE {CONC} SELECT chrom, st, en, category, similarity, edit_distance, ref_distance_a, ref_distance_b, length_diff, locus_size, ma AS motif_a FROM conc")
def str_concordance(t):
    c = concordance(t).withColumnsRenamed({"start": "st", "end": "en"}).withColumn("similarity", F.round("similarity", 6))
    return c.select("chrom", "st", "en", "category", "similarity", "edit_distance", "ref_distance_a", "ref_distance_b", "length_diff", "locus_size", "motif_a")


@query(f"""WITH RECURSIVE {TR_LINKS}
SELECT src, CAST(count(*) AS BIGINT) AS sites, CAST(count(c) AS BIGINT) AS overlapped, CAST(count(*) - count(c) AS BIGINT) AS exclusive, round(100.0 * count(c) / count(*), 6) AS pct_overlapped FROM calls LEFT JOIN comp USING (k) GROUP BY src""")
def str_site_summary(t):
    return rp.str_site_summary(tr_calls(t, "sites"), tr_calls(t, "truth")).withColumn("pct_overlapped", F.round("pct_overlapped", 6))


MOTIF_SIZE = "CASE WHEN {0} <= 6 THEN '1-6' WHEN {0} <= 20 THEN '7-20' ELSE '21+' END"


@query(f"""WITH RECURSIVE {CONC},
sized AS (SELECT CAST(NULL AS VARCHAR) AS motif_set, 'All' AS motif_size, * FROM conc UNION ALL SELECT 'a', {MOTIF_SIZE.format('ma')}, * FROM conc UNION ALL SELECT 'b', {MOTIF_SIZE.format('mb')}, * FROM conc),
cells AS (SELECT 'category' AS measure, motif_set, motif_size, category, CAST(NULL AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS value_b, CAST(NULL AS DOUBLE) AS x FROM sized UNION ALL SELECT 'nonref', NULL, 'All', NULL, na, nb, NULL FROM conc
  UNION ALL SELECT 'similarity', NULL, 'All', category, least(99, floor(round(similarity * 100, 6))), NULL, NULL FROM conc UNION ALL SELECT 'edit_distance', NULL, 'All', category, edit_distance, NULL, NULL FROM conc
  UNION ALL SELECT 'length_diff', motif_set, motif_size, NULL, length_diff, NULL, NULL FROM sized UNION ALL SELECT 'length_sign', motif_set, motif_size, NULL, sign(length_diff), NULL, NULL FROM sized
  UNION ALL SELECT 'length_mean', motif_set, motif_size, NULL, NULL, NULL, length_diff FROM sized)
SELECT measure, motif_set, motif_size, category, CAST(value AS INT) AS value, CAST(value_b AS INT) AS value_b, CAST(count(*) AS BIGINT) AS n, round(avg(x), 6) AS mean FROM cells GROUP BY ALL""")
def str_aggregate(t):
    return rp.str_aggregate(concordance(t).withColumn("similarity", F.round("similarity", 6))).withColumn("mean", F.round("mean", 6))


@query(f"WITH RECURSIVE {CONC} SELECT na AS nonref_a, nb AS nonref_b, CAST(count(*) AS BIGINT) AS n FROM conc GROUP BY 1, 2")
def str_nonref_matrix(t):
    return rp.str_nonref_matrix(concordance(t))


@query("""SELECT n.allele_type, CASE WHEN abs(n.allele_length) < 1 THEN '0-0' WHEN abs(n.allele_length) < 50 THEN '1-49' WHEN abs(n.allele_length) < 500 THEN '50-499' WHEN abs(n.allele_length) < 5000 THEN '500-4999' ELSE '5000+' END AS size_bucket,
 CASE WHEN af <= 0.01 THEN '0.0-0.01' WHEN af <= 0.05 THEN '0.01-0.05' WHEN af <= 0.1 THEN '0.05-0.1' WHEN af <= 0.5 THEN '0.1-0.5' ELSE '>0.5' END AS af_bucket, s.filter_text = 'PASS' AS passing,
 CAST(count(*) AS BIGINT) AS sites, CAST(count(m.id) AS BIGINT) AS matched FROM annotated n JOIN sites s USING (vid) LEFT JOIN (SELECT DISTINCT s.id FROM sites s JOIN truth t USING (chrom, pos, ref, alt)) m ON m.id = n.id GROUP BY ALL""")
def callset_qc(t):
    m = t.sites.join(t.truth.select("chrom", "pos", "ref", "alt").distinct(), ["chrom", "pos", "ref", "alt"], "left_semi")
    s = t.annotated.join(t.sites.select("vid", F.split("filter_text", ";").alias("filters")), "vid")
    return rp.callset_qc(s, m)


SIZES = "CASE WHEN abs(allele_length) < 1 THEN '0-0' WHEN abs(allele_length) < 50 THEN '1-49' WHEN abs(allele_length) < 500 THEN '50-499' WHEN abs(allele_length) < 5000 THEN '500-4999' ELSE '5000+' END"
CARRIED = "SELECT vid, sample_id AS sample, a0, a1, gq FROM genotypes WHERE coalesce(a0, 0) > 0 OR coalesce(a1, 0) > 0"


@query(f"""WITH c AS ({CARRIED}), k AS (SELECT vid FROM c GROUP BY vid HAVING count(DISTINCT sample) = 1)
SELECT sample, allele_type, {SIZES} AS size_bucket, CAST(floor(least(gq, 99) / 10.0) * 10 AS INT) AS gq_bin, CAST(count(*) AS BIGINT) AS calls, CAST(count(*) FILTER (a0 <> a1) AS BIGINT) AS het, CAST(count(*) FILTER (a0 > 0 AND a1 > 0) AS BIGINT) AS hom,
 CAST(count(k.vid) AS BIGINT) AS singletons FROM c JOIN annotated USING (vid) LEFT JOIN k USING (vid) GROUP BY ALL""")
def sample_qc(t):
    return rp.sample_qc(calls(t), t.annotated)


NAT = "SELECT l_partkey AS vid, s_nationkey AS sample, max(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END) AS a0, CASE WHEN min(l_linenumber) = 7 THEN NULL ELSE max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) END AS a1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_partkey, s_nationkey"


@query(f"""WITH n AS (SELECT *, a0 + a1 AS n, a0 <> a1 AS het FROM ({NAT}) q WHERE a0 IS NOT NULL AND a1 IS NOT NULL),
x AS (SELECT c.sample AS family, allele_type, {SIZES} AS size_bucket, c.n > 0 AS kid, f.n > 0 AS dad, m.n > 0 AS mum, (f.het AND m.n = 0) OR (m.het AND f.n = 0) AS one
  FROM n c JOIN n f ON f.vid = c.vid AND f.sample = c.sample + 1 JOIN n m ON m.vid = c.vid AND m.sample = c.sample + 2 JOIN annotated a ON a.vid = c.vid)
SELECT family, allele_type, size_bucket, CAST(count(*) FILTER (kid) AS BIGINT) AS child_variants, CAST(count(*) FILTER (kid AND dad AND NOT mum) AS BIGINT) AS paternal, CAST(count(*) FILTER (kid AND NOT dad AND mum) AS BIGINT) AS maternal,
 CAST(count(*) FILTER (kid AND dad AND mum) AS BIGINT) AS both, CAST(count(*) FILTER (kid AND NOT dad AND NOT mum) AS BIGINT) AS de_novo, CAST(count(*) FILTER (one) AS BIGINT) AS parent_het, CAST(count(*) FILTER (one AND kid) AS BIGINT) AS transmitted,
 round(count(*) FILTER (kid AND (dad OR mum)) / nullif(count(*) FILTER (kid), 0), 6) AS inherited_share, round(count(*) FILTER (one AND kid) / nullif(count(*) FILTER (one), 0), 6) AS transmitted_share FROM x GROUP BY ALL""")
def family_qc(t):
    c = t.sql(NAT).select("vid", "sample", F.array("a0", "a1").alias("gt"))
    k = F.col("n_nationkey")
    out = rp.family_qc(c, t.annotated, t.nation.select(k.alias("family"), k.alias("child"), (k + 1).alias("father"), (k + 2).alias("mother")))
    return out.withColumns({x: F.round(x, 6) for x in ("inherited_share", "transmitted_share")})


@query("""SELECT sample, CAST(least(count(*), 20) AS BIGINT) AS calls FROM (SELECT DISTINCT vid, sample_id AS sample FROM genotypes) g GROUP BY sample""")
def sampled_calls(t):
    """Which calls are drawn is a matter of the hash; how many is not."""
    return rp.sampled_calls(calls(t), 20).groupBy("sample").agg(F.count("*").alias("calls"))


@query("""SELECT chrom, 'a' AS sample, 'x' AS run, CAST(count(*) AS BIGINT) AS n FROM sites GROUP BY chrom UNION ALL SELECT chrom, 'b', 'y', CAST(count(*) AS BIGINT) FROM features GROUP BY chrom""")
def aggregate_eval_tables(t):
    a, b = (x.groupBy("chrom").agg(F.count("*").alias("n")) for x in (t.sites, t.features))
    return rp.aggregate_eval_tables([a, b], [{"sample": "a", "run": "x"}, {"sample": "b", "run": "y"}])


@query("""SELECT c_name AS workflow_label, round(coalesce(sum(o_totalprice), 0), 2) AS cost, CASE WHEN count(o_orderkey) > 0 THEN 'USD' END AS currency FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_name""")
def workflow_cost(t):
    lab = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    b = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_totalprice").alias("cost"), F.lit("USD").alias("currency"), F.array(lab("task", F.col("o_orderstatus")), lab("workflow-id", F.col("c_name"))).alias("labels"))
    return rp.workflow_cost(b, t.customer.select(F.col("c_name").alias("workflow_label"))).withColumn("cost", F.round("cost", 2))


# ------------------------------------------------------------------ caller tables, sheets, shards

CALLS = """SELECT s.chrom, s.pos, s.pos + s.size AS en, s.id, s.ref AS oref, s.alt AS oalt, substr(concat(s.ref, s.alt), 2) AS seq, CASE allele_type WHEN 'snv' THEN 'SNV' WHEN 'del' THEN 'DEL' WHEN 'dup' THEN 'DUP' WHEN 'trv' THEN 'INV' ELSE 'INS' END AS vartype,
 CASE WHEN size > 25 THEN -size END AS varlen, CASE WHEN brand_no > 4 THEN brand_no * 1.0 END AS score FROM sites s"""


@query(f"""
WITH b AS (SELECT chrom, pos, max(substr(seq, 3, 1)) AS base FROM bases GROUP BY chrom, pos),
x AS (SELECT c.chrom, c.pos, en, id, vartype, CASE vartype WHEN 'SNV' THEN oref WHEN 'DEL' THEN concat(base, seq) WHEN 'INS' THEN base ELSE 'N' END AS ref,
 CASE vartype WHEN 'SNV' THEN oalt WHEN 'DEL' THEN base WHEN 'INS' THEN concat(base, seq) ELSE concat('<', vartype, '>') END AS alt, coalesce(abs(varlen), en - c.pos) AS svlen, score FROM (SELECT * FROM ({CALLS}) a UNION ALL SELECT chrom, pos, en, concat(id, 'b'), oref, oalt, seq, vartype, varlen, 7.0 FROM ({CALLS}) a2) c JOIN b USING (chrom, pos))
SELECT chrom, pos, ref, alt, id, svlen FROM (SELECT *, row_number() OVER (PARTITION BY chrom, pos, en, ref, alt ORDER BY score DESC NULLS LAST, id) AS n FROM x) z WHERE n = 1
""")
def calls_parquet_to_sites(t):
    c = t.sql(CALLS).withColumnsRenamed({"en": "end", "oref": "ref", "oalt": "alt"}).withColumn("score", F.col("score").cast("double"))
    c = c.unionByName(c.withColumns({"id": F.concat("id", F.lit("b")), "score": F.lit(7.0)}))
    bases = t.sql("SELECT chrom, pos, substr(seq, 3, 1) AS base FROM bases")
    return ca.calls_parquet_to_sites(c, bases).select("chrom", "pos", "ref", "alt", "id", "svlen")


PALM = """SELECT concat('c', CAST(vid % 900 AS STRING)) AS cluster_id, chrom, pos AS p1, pos + brand_no % 4 AS p2, pos + size % 9 AS p3, pos + 3 AS p4, size AS m1, size + brand_no % 3 AS m2, size * 5 AS m3, size * 5 + 1 AS m4, brand_no % 5 AS conf,
 '+' AS ori, size % 3 AS polya, 1 AS tsd5, 2 AS tsd3, brand_no AS transd, CASE WHEN size % 4 = 0 THEN 1 ELSE 0 END AS inv5, size * 2 AS inv_end, size AS inv_start, file_pos FROM sites"""


@query(f"""
WITH a AS ({PALM}), d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p1, p2, p3, p4, m1, m2, m3, m4, conf, polya ORDER BY file_pos) AS n FROM a WHERE conf >= 1) z WHERE n = 1),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY file_pos DESC) AS k FROM d) z WHERE k = 1)
SELECT cluster_id AS id, chrom, CAST(round_even((list_sort([p1, p2, p3, p4])[2] + list_sort([p1, p2, p3, p4])[3]) / 2, 0) AS INT) AS pos,
 CAST(round_even((m3 + m4) / 2, 0) - round_even((m1 + m2) / 2, 0) + transd + CASE WHEN inv5 <> 0 THEN inv_end - inv_start ELSE 0 END AS INT) AS allele_length FROM l
""")
def palmer_calls_to_sites(t):
    bases = t.sql("SELECT chrom, pos, substr(seq, 1, 1) AS base FROM bases")
    seqs = t.sql("SELECT concat('c', CAST(vid % 900 AS STRING)) AS cluster_id, seq, vid AS file_pos FROM bases")
    return ca.palmer_calls_to_sites(t.sql(PALM), seqs, bases).select("id", "chrom", "pos", "allele_length")


@query("SELECT concat('c', CAST(vid AS STRING)) AS cluster_id, 'LINE' AS me_type FROM sites WHERE size > 5 UNION ALL SELECT id, 'ALU' FROM truth")
def merge_call_shards(t):
    a = t.sites.select(F.when(F.col("size") > 5, F.concat(F.lit("c"), F.col("vid").cast("string"))).otherwise("cluster_id").alias("cluster_id"))
    return ca.merge_call_shards({"LINE": a, "ALU": t.truth.select(F.col("id").alias("cluster_id"))})


@query("""SELECT x.id, chrom, pos - 1 AS st, pos - 1 + length(ref) AS en, qual AS score, CASE WHEN allele_type LIKE '%ins' THEN 'INS' WHEN allele_type = 'del' THEN 'DEL' END AS svtype, coalesce(c.samples, '') AS samples, replace(filter_text, ';', ',') AS filters FROM
 (SELECT concat(upper(allele_type), '-', id) AS id, vid, chrom, pos, ref, qual, allele_type, filter_text FROM sites) x
 LEFT JOIN (SELECT vid, string_agg(CAST(sample_id AS VARCHAR), ',' ORDER BY CAST(sample_id AS VARCHAR)) AS samples FROM genotypes WHERE coalesce(a0, 0) > 0 OR coalesce(a1, 0) > 0 GROUP BY vid) c USING (vid)""")
def variants_to_bed(t):
    s = t.sites.withColumns({"id": F.concat_ws("-", F.upper("allele_type"), "id"), "filters": F.split("filter_text", ";")})
    b = ca.variants_to_bed(s, [], {"qual": "score"}, infer_type=True, calls=calls(t).join(s.select("vid", "id"), "vid"), filters=True)
    return b.select("id", "chrom", F.col("start").alias("st"), F.col("end").alias("en"), "score", "svtype", "samples", "filters")


@query("""SELECT CAST(c_custkey AS STRING) AS sample, CASE c_nationkey % 3 WHEN 1 THEN 'male' WHEN 2 THEN 'female' ELSE 'unknown' END AS sex, CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE 'unknown' END AS population FROM customer""")
def build_sample_metadata(t):
    ped = t.customer.select(F.col("c_custkey").cast("string").alias("sample"), (F.col("c_nationkey") % 3).cast("string").alias("sex"))
    anc = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("sample"), F.col("c_mktsegment").alias("population"))
    return ca.build_sample_metadata(ped, anc)


@query("""SELECT n AS family, n AS sample, '0' AS father, coalesce(m, '0') AS mother, sex, '0' AS phenotype FROM (SELECT CASE WHEN c_nationkey = 7 THEN c_name ELSE CAST(c_custkey AS STRING) END AS n,
 CASE WHEN c_acctbal > 5000 THEN 'M1' END AS m, CASE c_nationkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '0' END AS sex FROM customer WHERE c_mktsegment <> 'BUILDING') x""")
def make_ped(t):
    s = t.customer.select(F.col("c_custkey").cast("string").alias("sample"), F.when(F.col("c_nationkey") % 3 == 0, "M").when(F.col("c_nationkey") % 3 == 1, "F").otherwise("?").alias("sex"),
                          F.when(F.col("c_acctbal") > 5000, "M1").alias("mother"))
    swaps = t.customer.filter("c_nationkey = 7").select(F.col("c_custkey").cast("string").alias("sample"), F.col("c_name").alias("new_sample"))
    gone = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("sample"))
    return ca.make_ped(s, swaps, gone)


@query("""SELECT c_custkey AS sample, CASE WHEN c_acctbal > 5000 THEN c_mktsegment WHEN n_name = 'NATION_1' THEN 'eur' WHEN n_name = 'NATION_2' THEN 'afr' ELSE 'unknown' END AS population FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def make_ancestry(t):
    s = t.samples.select(F.col("sample_id").alias("sample"), F.col("cohort").alias("population"))
    lab = t.customer.filter("c_acctbal > 5000").select(F.col("c_custkey").alias("sample"), F.col("c_mktsegment").alias("population"))
    return ca.make_ancestry(s, lab, {"NATION_1": "eur", "NATION_2": "afr"})


@query("""WITH l AS (SELECT chrom, max(en) AS length FROM features GROUP BY chrom), s AS (SELECT chrom, length, unnest(generate_series(1, CAST(length AS BIGINT), 500)) AS s FROM l)
SELECT chrom, CAST(greatest(s - 50, 1) AS INT) AS st, CAST(least(s + 549, length) AS INT) AS en FROM s""")
def shard_windows(t):
    w = ca.shard_windows(t.features.groupBy("chrom").agg(F.max("en").alias("length")), 500, 50)
    return w.withColumnsRenamed({"start": "st", "end": "en"})


@query("SELECT chrom, CAST(floor((pos - 1) / 500.0) AS INT) * 500 + 1 AS shard_start, CAST(count(*) AS BIGINT) AS n FROM sites GROUP BY 1, 2")
def shard_by_region(t):
    return ca.shard_by_region(t.sites, 500).groupBy("chrom", "shard_start").agg(F.count("*").alias("n"))


@query("SELECT 'contig' AS kind, chrom AS v FROM sites GROUP BY chrom UNION ALL SELECT DISTINCT 'sample', CAST(sample_id AS STRING) FROM genotypes")
def distinct_contigs_and_samples(t):
    c = ca.distinct_contigs(t.sites).select(F.lit("contig").alias("kind"), F.col("chrom").alias("v"))
    s = ca.samples_of(t.genotypes.withColumn("sample", F.col("sample_id").cast("string"))).select(F.lit("sample").alias("kind"), F.col("sample").alias("v"))
    return c.unionByName(s)


# ------------------------------------------------------------------ text forms

@query("""SELECT vid, concat('s', CAST(sample_id % 5 AS STRING)) AS sample, a0, a1, phased, ad_alt, gq,
 row_number() OVER (ORDER BY floor(vid / 2000.0), sample_id % 5, vid, sample_id) - 1 + dense_rank() OVER (ORDER BY floor(vid / 2000.0), sample_id % 5) AS file_pos FROM genotypes""")
def read_vcf_calls(t):
    """Calls written as VCF files, each with a header that names its own sample, and read back in file order."""
    t.keep_calls("genotypes")
    al = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    text = F.concat_ws(":", F.concat(al("a0"), F.when(F.col("phased"), "|").otherwise("/"), al("a1")), F.concat_ws(",", "ad_ref", "ad_alt"), F.col("gq").cast("string"))
    shard = F.format_string("%06d-%d", F.floor(F.col("vid") / 2000).cast("int"), (F.col("sample_id") % 5).cast("int"))
    g = t.genotypes.withColumns({"text": text, "shard": shard, "label": F.concat(F.lit("s"), (F.col("sample_id") % 5).cast("string"))}).join(t.sites, "vid")
    s = g.select("chrom", "pos", F.concat_ws("/", F.col("vid").cast("string"), F.col("sample_id").cast("string")).alias("id"), "ref",
                 F.array("alt").alias("alts"), "qual", F.split("filter_text", ";").alias("filters"), F.array("text").alias("calls"), "vid", "shard", "label", "sample_id")
    body = writers.vcf_lines_of(s, ["vid"], ["GT", "AD", "GQ"], "calls", ["shard", "vid", "sample_id"])
    head = s.select("shard", "label").distinct().select("shard", F.lit(-1).cast("bigint").alias("vid"), F.lit(-1).cast("bigint").alias("sample_id"), writers.vcf_header(F.array("label")).alias("value"))
    path = scratch(t.spark, "vcf")
    lines = body.select("shard", "vid", "sample_id", "value").unionByName(head).repartition("shard").sortWithinPartitions("shard", "vid", "sample_id")
    lines.select("shard", "value").write.partitionBy("shard").text(path, compression="gzip")
    c = readers.calls_of(readers.read_vcf(t.spark, path))
    return c.select(F.split("id", "/")[0].cast("bigint").alias("vid"), "sample", F.get("gt", F.lit(0)).alias("a0"), F.get("gt", F.lit(1)).alias("a1"), "phased", F.get("ad", F.lit(1)).alias("ad_alt"), "gq", "file_pos")


@query("SELECT id, chrom, pos, ref, alt, CAST(qual AS DOUBLE) AS qual, filter_text AS filters, CAST(size AS STRING) AS size FROM sites")
def write_vcf_text(t):
    s = t.sites.select("chrom", "pos", "id", "ref", F.array("alt").alias("alts"), "qual", F.split("filter_text", ";").alias("filters"), F.col("size").alias("SIZE"))
    path = scratch(t.spark, "sites")
    writers.write_vcf_text(writers.vcf_body(s, ["SIZE"]), path)
    v = readers.read_vcf(t.spark, path)
    return v.select("id", "chrom", "pos", "ref", F.array_join("alts", ",").alias("alt"), "qual", F.array_join("filters", ";").alias("filters"), F.col("info")["SIZE"].alias("size"))


@query("SELECT id AS locus_id, chrom, pos AS st, pos + length(ref) AS en, motif FROM sites WHERE size > 3")
def read_tr_catalog_json(t):
    e = t.sites.select(F.col("id").alias("LocusId"), F.when(F.col("size") > 3, F.concat("chrom", F.lit(":"), F.col("pos").cast("string"), F.lit("-"), (F.col("pos") + F.length("ref")).cast("string"))).otherwise("n/a").alias("MainReferenceRegion"), F.col("motif").alias("RepeatUnit"))
    path = scratch(t.spark, "catalog")
    e.write.json(path)
    return readers.read_tr_catalog_json(t.spark, path, multiline=False).withColumnsRenamed({"start": "st", "end": "en"})


@query("SELECT id AS trid, chrom, pos AS st, motif FROM sites")
def read_tr_catalog_bed(t):
    b = t.sites.select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), F.concat(F.lit("ID="), "id", F.lit(";MOTIFS="), "motif").alias("attributes"))
    path = scratch(t.spark, "catalog")
    b.write.csv(path, sep="\t")
    return readers.read_tr_catalog_bed(t.spark, path).select("trid", "chrom", F.col("start").alias("st"), F.col("attrs")["MOTIFS"].alias("motif"))


# ------------------------------------------------------------------ round trips through files

@query("""WITH o AS (SELECT chrom, pos, vid, row_number() OVER (ORDER BY CASE WHEN chrom = 'chrX' THEN 23 WHEN chrom = 'chrY' THEN 24 ELSE CAST(substr(chrom, 4) AS INT) END, pos, vid) - 1 AS n FROM sites)
SELECT CAST(n // 70 AS BIGINT) AS shard, CAST(count(*) AS BIGINT) AS n_rows, arg_min(chrom, n) AS first_chrom, arg_min(pos, n) AS first_pos, arg_max(chrom, n) AS last_chrom, arg_max(pos, n) AS last_pos FROM o GROUP BY 1""")
def shard_by_records(t):
    out = writers.shard_by_records(t.sites, scratch(t.spark, "shards"), 70, ties=("vid",))
    return out.withColumn("shard", F.col("shard").cast("bigint")).withColumnRenamed("rows", "n_rows")


@query("SELECT chrom, CAST(b AS BIGINT) AS block, substr(s, CAST(b * 100 + 1 AS BIGINT), 100) AS bases FROM (SELECT chrom, s, unnest(range((length(s) - 1) // 100 + 1)) AS b FROM (SELECT chrom, string_agg(bases, '' ORDER BY block) AS s FROM reference GROUP BY chrom) c) d")
def read_fasta(t):
    """A FASTA file of the reference, in lines of 64 bases, read back in blocks of 100."""
    path = scratch(t.spark, "fasta")
    head = t.reference.select("chrom").distinct().select("chrom", F.lit(-1).alias("block"), F.concat(F.lit(">"), "chrom", F.lit(" of the test")).alias("value"))
    body = t.reference.select("chrom", "block", F.col("bases").alias("value"))
    head.unionByName(body).repartitionByRange(4, "chrom", "block").sortWithinPartitions("chrom", "block").select("value").write.text(path)
    return readers.read_fasta(t.spark, path, 100)


@query("SELECT chrom, pos, ref, alt, CASE WHEN id = 'V7' THEN NULL ELSE id END AS id, name, CASE WHEN size % 3 > 0 THEN motif END AS motif FROM sites")
def read_annotation_tsv(t):
    path = scratch(t.spark, "annotations")
    writers.write_annotation_tsv(t.sites.select("chrom", "pos", "ref", "alt", F.when(F.col("id") != "V7", F.col("id")).alias("id"), "name", F.when(F.col("size") % 3 > 0, F.col("motif")).alias("motif")), path)
    return readers.read_annotation_tsv(t.spark, path, ["name", "motif"])


@query("SELECT chrom, st, en, CAST(fid AS INT) AS depth, name FROM features")
def read_bed(t):
    path = scratch(t.spark, "bed")
    writers.write_annotation_tsv(t.features.select("chrom", "st", "en", "fid", "name"), path)
    return readers.read_bed(t.spark, path, {"depth": "int", "name": "string"}).withColumnsRenamed({"start": "st", "end": "en"})


@query("SELECT chrom, pos, id, ref, alt FROM sites UNION ALL SELECT 'wrote', 0, CAST(count(*) > 0 AS VARCHAR), CAST(false AS VARCHAR), NULL FROM sites")
def write_tsv_parquet(t):
    """The table as read back; in one row more, whether it was written and whether an empty one was."""
    path, none = scratch(t.spark, "table"), scratch(t.spark, "table")
    s = t.sites.select("chrom", "pos", "id", "ref", "alt")
    wrote, empty = writers.write_tsv_parquet(s, path), writers.write_tsv_parquet(s.filter("false"), none)
    said = t.spark.range(1).select(F.lit("wrote").alias("chrom"), F.lit(0).alias("pos"), F.lit(str(wrote).lower()).alias("id"), F.lit(str(empty).lower()).alias("ref"), F.lit(None).cast("string").alias("alt"))
    return t.spark.read.parquet(path).unionByName(said)
