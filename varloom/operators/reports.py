"""Concordance and quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import genotype as g
from ..functions.alleles import contig_sort
from ..session import cut_lineage
from .intervals import assign_islands, islands
from .positions import overlap_pairs
from .sequences import distance, spelled, with_bases
from .transfer import lookup

# ------------------------------------------------------------------ benchmark of matched pairs

# Spellings that mean the same population key.
SAME_WORD = {"remaining": "rmi", "male": "xy", "female": "xx"}


def info_map(info) -> Column:
    """INFO text as a map; flags map to NULL."""
    return F.str_to_map(info, F.lit(";"), F.lit("="))


def af_key(name: Column, same: dict[str, str] = SAME_WORD) -> Column:
    """Order-free key of an AF field: lower-cased words, synonyms unified, sorted, joined by ``_``."""
    words = F.split(F.lower(name), "_")
    table = F.create_map(*[F.lit(z) for kv in same.items() for z in kv])
    return F.array_join(F.array_sort(F.array_distinct(F.transform(words, lambda w: F.coalesce(table[w], w)))), "_")


def _af_rows(pairs: DataFrame, col: str, out: str) -> DataFrame:
    e = pairs.select("id", F.explode(info_map(col)).alias("k", "v")).filter(F.lower("k").rlike("(^|_)af(_|$)"))
    return e.select("id", af_key(F.col("k")).alias("af_key"), F.element_at(F.split("v", ","), 1).try_cast("double").alias(out)).filter(F.col(out) > 0)


def af_pairs(pairs: DataFrame) -> DataFrame:
    """(id, af_key, eval_af, truth_af): positive frequencies both sides carry. ``pairs``: id, eval_info, truth_info."""
    e = _af_rows(pairs, "eval_info", "eval_af").groupBy("id", "af_key").agg(F.max("eval_af").alias("eval_af"))
    t = _af_rows(pairs, "truth_info", "truth_af").groupBy("id", "af_key").agg(F.max("truth_af").alias("truth_af"))
    return e.join(t, ["id", "af_key"])


def af_concordance(pairs: DataFrame) -> DataFrame:
    """Number of pairs and squared correlation per key."""
    return af_pairs(pairs).groupBy("af_key").agg(F.count("*").alias("n"), F.pow(F.corr("eval_af", "truth_af"), 2).alias("r2"))


def vep_pairs(pairs: DataFrame, categories: dict[str, int]) -> DataFrame:
    """Counts of (category, eval, truth) values. ``pairs``: eval_vep, truth_vep; N/A where absent."""
    def val(col, i):
        v = F.try_element_at(F.split(F.element_at(F.split(col, ","), 1), r"\|"), F.lit(i + 1))
        return F.coalesce(F.nullif(v, F.lit("")), F.lit("N/A"))
    cats = F.array(*[F.struct(F.lit(n).alias("c"), val("eval_vep", i).alias("e"), val("truth_vep", i).alias("t")) for n, i in categories.items()])
    return pairs.select(F.explode(cats).alias("_x")).groupBy(F.col("_x.c").alias("category"), F.col("_x.e").alias("eval"), F.col("_x.t").alias("truth")).agg(F.count("*").alias("n"))


def vep_confusion(counts: DataFrame, top: int = 10) -> DataFrame:
    """Eval x truth counts with the ``top`` eval values (the rest Other) and each cell's share of its
    truth column. The windows run over distinct values, after counting."""
    tot = counts.groupBy("category", "eval").agg(F.sum("n").alias("_n"))
    keep = tot.withColumn("_r", F.row_number().over(W.partitionBy("category").orderBy(F.col("_n").desc(), "eval"))).filter(F.col("_r") <= top)
    k = keep.select("category", F.col("eval").alias("_v"))
    x = (counts.join(k.withColumnsRenamed({"_v": "eval"}).withColumn("_e", F.lit(True)), ["category", "eval"], "left")
         .join(k.withColumnsRenamed({"_v": "truth"}).withColumn("_t", F.lit(True)), ["category", "truth"], "left"))
    x = x.withColumns({"eval": F.when(F.col("_e"), F.col("eval")).otherwise("Other"), "truth": F.when(F.col("_t"), F.col("truth")).otherwise("Other")})
    g = x.groupBy("category", "eval", "truth").agg(F.sum("n").alias("n"))
    return g.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(W.partitionBy("category", "truth")))


def match_summary(evals: DataFrame, matches: DataFrame) -> DataFrame:
    """Per allele type and match type: variants and their share of the type; unmatched as NONE."""
    x = evals.select("id", "allele_type").join(matches.select("id", "match_type"), "id", "left")
    g = x.groupBy("allele_type", F.coalesce("match_type", F.lit("NONE")).alias("match_type")).agg(F.count("*").alias("n"))
    return g.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(W.partitionBy("allele_type")))


def match_totals(evals: DataFrame, matches: DataFrame) -> DataFrame:
    """Variants and their share of all, by match type, and in total, matched and unmatched."""
    x = evals.select("id").join(lookup(matches, ["id"], ["match_type"]), "id", "left")
    kinds = F.array(F.coalesce("match_type", F.lit("UNMATCHED")), F.lit("TOTAL"), F.when(F.col("match_type").isNotNull(), F.lit("MATCHED")))
    zero = evals.sparkSession.createDataFrame([("TOTAL",), ("MATCHED",)], "match_type string").withColumn("n", F.lit(0).cast("bigint"))
    n = x.select(F.explode(kinds).alias("match_type")).filter("match_type IS NOT NULL").groupBy("match_type").agg(F.count("*").alias("n")).unionByName(zero)
    n = n.groupBy("match_type").agg(F.sum("n").alias("variants"))
    return n.withColumn("pct", F.coalesce(F.try_divide(100.0 * F.col("variants"), F.max(F.when(F.col("match_type") == "TOTAL", F.col("variants"))).over(W.partitionBy())), F.lit(0.0)))  # a row a match type


def match_table(evals: DataFrame, matches: DataFrame, truth: DataFrame, categories: dict[str, int]) -> DataFrame:
    """One row per variant and compared field: id, match_status, truth_id (``.`` without one), match_type, field, eval_value, truth_value.

    Fields are the frequencies both sides carry and the VEP ``categories`` (name -> place) of the first annotation, N/A where absent; a category that is empty
    in every row on both sides is left out. Variants without a match, or without a field, have one row without a field.
    Both sides: id, info (text), vep (text).
    """
    m = evals.select("id", "info", "vep").join(lookup(matches, ["id"], ["match_type", "truth_id"]), "id", "left")
    t = lookup(truth, ["id"], ["info", "vep"]).withColumnsRenamed({"id": "truth_id", "info": "_ti", "vep": "_tv"})
    x = m.join(t, "truth_id", "left")

    def af(col):
        e = F.transform(F.map_entries(info_map(col)), lambda kv: F.struct(af_key(kv["key"]).alias("k"), F.element_at(F.split(kv["value"], ","), 1).try_cast("double").alias("v"), F.lower(kv["key"]).rlike("(^|_)af(_|$)").alias("is")))
        return F.filter(e, lambda f: f["is"] & f["v"].isNotNull())

    def named(col, i):
        v = F.try_element_at(F.split(F.element_at(F.split(col, ","), 1), r"\|"), F.lit(i + 1))
        return F.coalesce(F.nullif(v, F.lit("")), F.lit("N/A"))

    found = x.filter("_ti IS NOT NULL").withColumns({"_e": af("info"), "_t": af("_ti")})
    pairs = F.filter(F.transform("_e", lambda e: F.struct(e["k"].alias("field"), e["v"].cast("string").alias("e"), F.get(F.filter("_t", lambda t: t["k"] == e["k"]), F.lit(0))["v"].cast("string").alias("t"))), lambda p: p["t"].isNotNull())
    cats = F.array(*[F.struct(F.lit(n).alias("field"), named("vep", i).alias("e"), named("_tv", i).alias("t")) for n, i in categories.items()])
    rows = found.select("id", F.explode(F.concat(pairs, cats) if categories else pairs).alias("_f")).select("id", "_f.*")
    full = rows.groupBy("field").agg(F.max((F.col("e") != "N/A") | (F.col("t") != "N/A")).alias("_k")).filter("_k").select("field")
    rows = rows.join(full, "field")
    return x.select("id", F.col("truth_id").isNotNull().alias("match_status"), F.coalesce("truth_id", F.lit(".")).alias("truth_id"), "match_type").join(
        rows.select("id", "field", F.col("e").alias("eval_value"), F.col("t").alias("truth_value")), "id", "left")


def informative_columns(table: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Without the column pairs that are empty in every row; one row of flags decides.

    A table's columns must be known before it is read, so this looks at the data once when it is called.
    """
    blank = lambda x: F.col(x).isNull() | F.col(x).cast("string").isin("", ".")
    if not pairs:
        return table
    seen = table.agg(*[F.max(~(blank(a) & blank(b))).alias(f"_{i}") for i, (a, b) in enumerate(pairs)]).first()
    return table.drop(*[x for i, p in enumerate(pairs) if not seen[i] for x in p])


# ------------------------------------------------------------------ repeat call concordance

def _sites(calls: DataFrame) -> DataFrame:
    """Distinct places of calls; ``_to`` is the open end that overlaps are judged by (two bases at least)."""
    return calls.select("chrom", "start", "end").distinct().withColumn("_to", F.greatest(F.col("end"), F.col("start") + 1) + 1)


def _shared(sites: DataFrame, other: DataFrame) -> DataFrame:
    """Sites that overlap a site of ``other``, with the first and last place (``_lo``, open ``_hi``) that both cover."""
    cover = islands(other, ("start", "_to"))
    p = overlap_pairs(sites, cover, ("start", "_to"), ("start", "end"))
    return p.groupBy("chrom", "start", "end").agg(F.min(F.greatest("start", "b_start")).alias("_lo"), F.max(F.least("_to", "b_end")).alias("_hi"))


def str_regions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sites of two call sets (``chrom, start, end``, both ends in) with the region they belong to; ``src`` is 1 or 2.

    Sites of different sets that overlap share a region, and so on along the chain; sites of one set don't link each other.
    Two sites are linked just when the stretches that both sets cover within them overlap, so regions are the islands
    of those stretches and no graph search is needed. ``window_start`` and ``window_end`` bound the region's sites.
    """
    one, two = _sites(a), _sites(b)
    x = cut_lineage(_shared(one, two).withColumn("src", F.lit(1)).unionByName(_shared(two, one).withColumn("src", F.lit(2))))
    iv = ("_lo", "_hi")
    x = assign_islands(x, islands(x, iv, touching=False), iv)
    ends = x.groupBy("chrom", "island_start").agg(F.min("start").alias("window_start"), F.max("end").alias("window_end"))
    return x.join(ends, ["chrom", "island_start"]).select("chrom", "start", "end", "src", "window_start", "window_end", F.col("island_start").alias("region"))


def str_site_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per set (``src``): its sites, those that overlap the other set, those that don't, and the share of the former."""
    n = _sites(a).withColumn("src", F.lit(1)).unionByName(_sites(b).withColumn("src", F.lit(2))).groupBy("src").agg(F.count("*").alias("sites"))
    x = n.join(str_regions(a, b).groupBy("src").agg(F.count("*").alias("_o")), "src", "left").withColumn("overlapped", F.coalesce("_o", F.lit(0)))
    return x.select("src", "sites", "overlapped", (F.col("sites") - F.col("overlapped")).alias("exclusive"), (100.0 * F.col("overlapped") / F.col("sites")).alias("pct_overlapped"))


def str_concordance(a: DataFrame, b: DataFrame, reference: DataFrame, block: int, pairs: DataFrame | None = None, similar: float = 0.9, order: str | None = None) -> DataFrame:
    """Per region and sample: both sets' haplotypes spelled out over the region, compared straight and swapped by edit distance.

    Calls: sample, chrom, start, end (1-based, both ends in), hap1, hap2 (sequences; NULL or empty where not called, the one that is left then
    counts as the first), nonref1, nonref2, motif_len. A haplotype takes the calls by position, cut where they overlap the last one, and the bases of
    ``reference`` (see ``sequences``) between them and out to the region's ends, so a sample without calls there is the reference.
    ``pairs`` (sample, sample_b) names the samples to compare, else those of one name. Of several calls of a sample at one place the last by ``order`` counts.
    EXACT at 1, SIMILAR from ``similar``, else DIVERGENT. A region's text is as long as the region.
    """
    reg = cut_lineage(str_regions(a, b))
    region = ["chrom", "region", "window_start", "window_end"]
    key = ["chrom", "start", "end"]
    who = "sample" if pairs is None else "sample_b"

    def spelled_calls(calls: DataFrame, src: int, name: str) -> DataFrame:
        last = F.col(order) if order else F.struct("hap1", "hap2")
        c = calls.groupBy("sample", *key).agg(F.max_by(F.struct("hap1", "hap2", "nonref1", "nonref2"), last).alias("_c"), F.min("motif_len").alias("motif_len")).select("sample", *key, "_c.*", "motif_len")
        haps = F.filter(F.transform(F.array("hap1", "hap2"), lambda h: F.upper(h)), lambda h: h.isNotNull() & (h != ""))
        c = c.join(reg.filter(F.col("src") == src), key).withColumn("_h", haps)
        item = lambda i: F.when(F.size("_h") > i, F.struct("start", "end", F.get("_h", F.lit(i)).alias("seq")))
        g = c.groupBy(*region, "sample").agg(
            F.array_sort(F.collect_list(item(0))).alias("_i1"), F.array_sort(F.collect_list(item(1))).alias("_i2"),
            (F.coalesce(F.bool_or("nonref1"), F.lit(False)).cast("int") + F.coalesce(F.bool_or("nonref2"), F.lit(False)).cast("int")).alias(f"nonref_{name}"))
        return g.withColumnsRenamed({"_i1": f"_{name}1", "_i2": f"_{name}2"})

    def motifs(calls: DataFrame, src: int, name: str) -> DataFrame:
        return calls.join(reg.filter(F.col("src") == src), key).groupBy(*region).agg(F.min("motif_len").alias(f"motif_{name}"))

    one, two = spelled_calls(a, 1, "a"), spelled_calls(b, 2, "b").withColumnRenamed("sample", who)
    if pairs is not None:
        one, two = one.join(pairs.select("sample", "sample_b"), "sample"), two.join(pairs.select("sample", "sample_b"), "sample_b")
    x = one.join(two, [*region, *dict.fromkeys(["sample", who])], "full")
    windows = reg.select("chrom", F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    text = with_bases(windows, reference, block, "_ref").withColumnsRenamed({"start": "window_start", "end": "window_end"})
    x = x.join(text, ["chrom", "window_start", "window_end"]).join(motifs(a, 1, "a"), region).join(motifs(b, 2, "b"), region)
    none = F.array().cast("array<struct<start:int,end:int,seq:string>>")
    haps = ["a1", "a2", "b1", "b2"]
    x = x.withColumns({f"_{h}": F.coalesce(f"_{h}", none) for h in haps})
    x = x.withColumns({h: spelled(f"_{h}", "_ref", "window_start", "window_end") for h in haps})
    x = x.withColumns({f"_{p}{q}": distance(F.col(p), F.col(q)) for p in ("a1", "a2") for q in ("b1", "b2")} | {f"_{h}r": distance(F.col(h), F.col("_ref")) for h in haps})

    def like(p: str, q: str) -> Column:
        longer = F.greatest(F.length(p), F.length(q))
        return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.col(f"_{p}{q}") / longer)

    x = x.withColumns({"_s": (like("a1", "b1") + like("a2", "b2")) / 2, "_w": (like("a1", "b2") + like("a2", "b1")) / 2})
    sim = F.greatest("_s", "_w")
    return x.select(
        "chrom", F.col("window_start").alias("start"), F.col("window_end").alias("end"), *dict.fromkeys(["sample", who]),
        F.when(sim == 1.0, "EXACT").when(sim >= similar, "SIMILAR").otherwise("DIVERGENT").alias("category"), sim.alias("similarity"),
        F.when(F.col("_w") > F.col("_s"), F.col("_a1b2") + F.col("_a2b1")).otherwise(F.col("_a1b1") + F.col("_a2b2")).alias("edit_distance"),
        (F.col("_a1r") + F.col("_a2r")).alias("ref_distance_a"), (F.col("_b1r") + F.col("_b2r")).alias("ref_distance_b"),
        (F.length("a1") + F.length("a2") - F.length("b1") - F.length("b2")).alias("length_diff"), (F.col("window_end") - F.col("window_start") + 1).alias("locus_size"),
        "motif_a", "motif_b", F.coalesce("nonref_a", F.lit(0)).alias("nonref_a"), F.coalesce("nonref_b", F.lit(0)).alias("nonref_b"))


def str_nonref_matrix(conc: DataFrame) -> DataFrame:
    """Regions by number of non-reference haplotypes in either set (3 x 3, long form)."""
    return conc.groupBy("nonref_a", "nonref_b").agg(F.count("*").alias("n"))


def str_aggregate(conc: DataFrame) -> DataFrame:
    """The counts behind the reports on ``str_concordance``, in one pass, a row a cell that occurs (``n`` regions).

    ``motif_size`` is the class (1-6, 7-20, 21 and more) of the motif of ``motif_set`` (a or b); it is ``All``, without a set, where regions aren't parted by it.
    By ``measure``: ``category`` (all, and by either set's class); ``nonref`` (``value`` and ``value_b`` non-reference haplotypes); ``similarity`` by category
    in percent rounded down (100 stands with 99); ``edit_distance`` by category; and, all and by either set's class, ``length_diff`` (a less b),
    ``length_sign`` (a shorter, same, longer: -1, 0, 1) and ``length_mean`` with the ``mean`` difference.
    """
    none = F.lit(None)

    def cell(measure: str, group=(none, F.lit("All")), category=none, value=none, value_b=none, x=none) -> Column:
        cols = {"motif_set": group[0], "motif_size": group[1], "category": category, "value": value, "value_b": value_b, "x": x}
        kinds = ["string"] * 3 + ["int"] * 2 + ["double"]
        return F.struct(F.lit(measure).alias("measure"), *[v.cast(t).alias(k) for (k, v), t in zip(cols.items(), kinds)])

    def sized(name: str) -> Column:
        m = F.col(f"motif_{name}")
        return F.when(m <= 6, "1-6").when(m <= 20, "7-20").otherwise("21+")

    category, diff = F.col("category"), F.col("length_diff")
    percent = F.least(F.floor(F.round(F.col("similarity") * 100, 6)), F.lit(99))
    cells = [cell("nonref", value=F.col("nonref_a"), value_b=F.col("nonref_b")), cell("similarity", category=category, value=percent), cell("edit_distance", category=category, value=F.col("edit_distance"))]
    for group in ((none, F.lit("All")), *((F.lit(k), sized(k)) for k in "ab")):
        cells += [cell("category", group, category), cell("length_diff", group, value=diff), cell("length_sign", group, value=F.signum(diff)), cell("length_mean", group, x=diff)]
    rows = conc.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")
    return rows.groupBy("measure", "motif_set", "motif_size", "category", "value", "value_b").agg(F.count("*").alias("n"), F.avg("x").alias("mean"))


# ------------------------------------------------------------------ cohort reports

def callset_qc(sites: DataFrame, matches: DataFrame) -> DataFrame:
    """Site-level quality: counts by type, size bucket, frequency bucket and filter, with the
    number matched in a comparison set."""
    from .counting import af_bucket, size_bucket

    x = sites.join(matches.select("id").distinct().withColumn("_m", F.lit(True)), "id", "left")
    return x.groupBy("allele_type", size_bucket("allele_length", (0, 1, 50, 500, 5000)).alias("size_bucket"), af_bucket("af").alias("af_bucket"),
                     F.array_contains("filters", "PASS").alias("passing")).agg(F.count("*").alias("sites"), F.count("_m").alias("matched"))


def sampled_calls(calls: DataFrame, most: int, seed: int = 0, vid: str = "vid") -> DataFrame:
    """At most ``most`` calls of each sample, those of the smallest seeded hashes: the same calls whatever the order, and a sample of a union is found in
    the samples of its parts. Calls are counted by ranges of the hash first, so only the range in which a sample's limit falls is ranked."""
    x = calls.withColumn("_h", F.xxhash64(vid, "sample", F.lit(seed))).withColumn("_b", F.shiftright("_h", 54))
    per = x.groupBy("sample", "_b").agg(F.count("*").alias("_n"))
    upto = per.withColumn("_c", F.sum("_n").over(W.partitionBy("sample").orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)))  # 1,024 ranges
    x = x.join(upto.filter(F.col("_c") - F.col("_n") < most), ["sample", "_b"])
    cut = x.filter(F.col("_c") > most).withColumn("_r", F.row_number().over(W.partitionBy("sample", "_b").orderBy("_h", vid)) + F.col("_c") - F.col("_n")).filter(F.col("_r") <= most)
    return x.filter(F.col("_c") <= most).select(*calls.columns).unionByName(cut.select(*calls.columns))


def sample_qc(calls: DataFrame, sites: DataFrame, edges=(0, 1, 50, 500, 5000), max_gq: int = 99, gq_step: int = 10, vid: str = "vid") -> DataFrame:
    """Per sample, allele type, size bucket and GQ bin of the carried calls: calls, het and hom ones, and those of variants that only this sample carries.

    ``calls``: vid, sample, gt, gq; GQ is cut at ``max_gq`` and binned by ``gq_step`` (NULL stays NULL).
    """
    from .counting import size_bucket

    c = calls.filter(g.is_carrier("gt"))
    alone = c.groupBy(vid).agg(F.count_distinct("sample").alias("_k")).filter("_k = 1").select(vid, F.lit(True).alias("_a"))
    x = c.join(sites.select(vid, "allele_type", size_bucket("allele_length", edges).alias("size_bucket")), vid).join(alone, vid, "left")
    hom = F.size("gt") == g.n_alt("gt")
    gq = (F.floor(F.least(F.col("gq"), F.lit(max_gq)) / gq_step) * gq_step).cast("int")
    return x.groupBy("sample", "allele_type", "size_bucket", gq.alias("gq_bin")).agg(
        F.count("*").alias("calls"), F.count_if(g.is_het("gt")).alias("het"), F.count_if(hom).alias("hom"), F.count("_a").alias("singletons"))


def family_qc(calls: DataFrame, sites: DataFrame, trios: DataFrame, edges=(0, 1, 50, 500, 5000), vid: str = "vid") -> DataFrame:
    """Per trio, allele type and size bucket of the child's carried variants that are fully called in all three: carried by the father only, the mother only,
    both or none, the inherited share, and how many of the parents' heterozygous variants (one parent het, the other without) reach the child.

    ``trios``: family, child, father, mother. One pass: the three calls of a site meet in one group.
    """
    from .counting import size_bucket

    roles = trios.select("family", F.explode(F.array(*[F.struct(F.col(r).alias("sample"), F.lit(r).alias("role")) for r in ("child", "father", "mother")])).alias("_r")).select("family", "_r.*").distinct()
    known = calls.filter(~g.has_null("gt")).select(vid, "sample", g.n_alt("gt").alias("_n"), g.is_het("gt").alias("_het"))
    of = lambda r, v: F.max(F.when(F.col("role") == r, F.col(v)))
    t = known.join(roles, "sample").groupBy("family", vid).agg(*[of(r, "_n").alias(r) for r in ("child", "father", "mother")], *[of(r, "_het").alias(f"{r}_het") for r in ("father", "mother")])
    t = t.filter("child IS NOT NULL AND father IS NOT NULL AND mother IS NOT NULL")
    kid, dad, mum = (F.col(r) > 0 for r in ("child", "father", "mother"))
    one_het = (F.col("father_het") & ~mum) | (F.col("mother_het") & ~dad)
    x = t.join(sites.select(vid, "allele_type", size_bucket("allele_length", edges).alias("size_bucket")), vid)
    out = x.groupBy("family", "allele_type", "size_bucket").agg(
        F.count_if(kid).alias("child_variants"), F.count_if(kid & dad & ~mum).alias("paternal"), F.count_if(kid & ~dad & mum).alias("maternal"), F.count_if(kid & dad & mum).alias("both"),
        F.count_if(kid & ~dad & ~mum).alias("de_novo"), F.count_if(one_het).alias("parent_het"), F.count_if(one_het & kid).alias("transmitted"))
    return out.withColumns({"inherited_share": F.try_divide(F.col("child_variants") - F.col("de_novo"), F.col("child_variants")), "transmitted_share": F.try_divide("transmitted", "parent_het")})


def aggregate_eval_tables(tables: list[DataFrame], labels: list[dict[str, str]]) -> DataFrame:
    """Per-sample evaluation tables with their labels as columns, in contig order."""
    tagged = [reduce(lambda d, kv: d.withColumn(kv[0], F.lit(kv[1])), lab.items(), t) for t, lab in zip(tables, labels)]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return out.orderBy(*contig_sort("chrom"), *[c for c in ("sample", "pos") if c in out.columns])


def workflow_cost(billing: DataFrame, runs: DataFrame, key: str = "workflow-id") -> DataFrame:
    """Cost per run: billing rows (cost, currency, labels array<struct<key,value>>) summed by the
    label naming the run; runs without billing cost 0."""
    b = (billing.select("cost", "currency", F.explode("labels").alias("_l")).filter(F.col("_l.key") == key)
         .groupBy(F.col("_l.value").alias("workflow_label")).agg(F.sum("cost").alias("cost"), F.max("currency").alias("currency")))
    return runs.join(b, "workflow_label", "left").withColumn("cost", F.coalesce("cost", F.lit(0.0)))
