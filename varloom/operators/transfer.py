"""Equi-joins that move annotations and genotypes between tables.

Look-up sides are reduced to one row per key by aggregation (map-side combined)
before they are joined, so a hot key can only be hot on the probing side, which
adaptive execution splits. No broadcast hints: Spark picks by measured size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import genotype as g
from ..functions.alleles import c, contig_sort

KEY5 = ["chrom", "pos", "ref", "alt", "id"]


def lookup(df: DataFrame, key: list[str], cols: list[str], order: str | None = None, first: bool = False) -> DataFrame:
    """One row per key: the last (or first) by ``order``, else the largest value tuple."""
    item = F.struct(*cols)
    if order:
        pick = (F.min_by if first else F.max_by)(item, order)
    else:
        pick = F.max(item)
    return df.groupBy(*key).agg(pick.alias("_v")).select(*key, *[F.col(f"_v.{x}").alias(x) for x in cols])


def annotate_from_table(sites: DataFrame, tables: list[DataFrame], cols: list[list[str]], row_filters=None,
                        site_filters=None, key=tuple(KEY5), order: str | None = None) -> DataFrame:
    """Left joins in sequence; a later table overwrites earlier values where it has one.

    ``row_filters`` restrict table rows, ``site_filters`` the sites that may be annotated.
    """
    key = list(key)
    out = sites
    for i, (tab, names) in enumerate(zip(tables, cols)):
        if row_filters and row_filters[i]:
            tab = tab.filter(row_filters[i])
        t = lookup(tab, key, names, order).withColumnsRenamed({n: f"_new_{n}" for n in names})
        out = out.join(t, key, "left")
        allow = F.expr(site_filters[i]) if site_filters and site_filters[i] else F.lit(True)
        for n in names:
            new = F.when(allow, F.col(f"_new_{n}"))
            out = out.withColumn(n, F.coalesce(new, n) if n in out.columns else new).drop(f"_new_{n}")
    return out


def clear_annotate_swap(sites: DataFrame, cleared: list[str], table: DataFrame, cols: list[str],
                        replacements: DataFrame | None = None, key=tuple(KEY5)) -> DataFrame:
    """Null the named fields, annotate, then let ``replacements`` take the place of the sites
    their ``original_id`` names."""
    types = dict(sites.dtypes)
    blank = sites.withColumns({x: F.lit(None).cast(types[x]) for x in cleared})
    out = annotate_from_table(blank, [table], [cols], key=key)
    if replacements is None:
        return out
    gone = replacements.select(F.col("original_id").alias("id")).distinct()
    return out.join(gone, "id", "left_anti").unionByName(replacements.drop("original_id"), allowMissingColumns=True)


def affixed(value, prefix="", suffix="", lowercase=False) -> Column:
    v = F.concat(F.lit(prefix), c(value), F.lit(suffix))
    return F.lower(v) if lowercase else v


def annotate_allele_type(sites: DataFrame, dups: DataFrame, meis: DataFrame, meds: DataFrame, dup=(), mei=(), med=(),
                         key=tuple(KEY5)) -> DataFrame:
    """DUP, then MEI, then MED tables set ``allele_type`` (with prefix, suffix, lower case);
    DUP also sets ORIGIN (first of two columns unless empty or ``.``), the others SUB_FAMILY."""
    first = F.when(F.col("origin1").isNotNull() & ~F.col("origin1").isin("", "."), F.col("origin1")).otherwise(F.col("origin2"))
    d = dups.withColumns({"allele_type": affixed("kind", *dup), "origin": first})
    steps = [(d, ["allele_type", "origin"])]
    for tab, how in ((meis, mei), (meds, med)):
        steps.append((tab.withColumn("allele_type", affixed("kind", *how)), ["allele_type", "sub_family"]))
    return annotate_from_table(sites, [x for x, _ in steps], [y for _, y in steps], key=key)


def exact_match(evals: DataFrame, truth: DataFrame, source_tag: str = "truth", key=("chrom", "pos", "ref", "alt")):
    """(matched, rest): matched rows carry match type, truth id, source tag and the truth
    FILTER without PASS and ``.``; rest are the unmatched eval rows."""
    key = list(key)
    t = truth.withColumn("_f", F.array_except("filters", F.array(F.lit("PASS"), F.lit("."))))
    t = lookup(t.withColumn("truth_id", F.col("id")), key, ["truth_id", "_f"])
    m = evals.join(t, key).withColumns({
        "match_type": F.lit("EXACT"), "source_tag": F.lit(source_tag),
        "truth_filter": F.when(F.size("_f") > 0, F.array_join("_f", ";"))}).drop("_f")
    return m, evals.join(t.select(*key), key, "left_anti")


def truth_count_columns(columns: list[str]) -> dict[str, str]:
    """Column -> normalised name for AC/AF/AN fields (upper case, ``_REMAINING`` as ``_RMI``), by group and name."""
    found = {}
    for p in ("AC", "AF", "AN"):
        hits = {x.upper().replace("_REMAINING", "_RMI"): x for x in columns}
        for norm in sorted(hits):
            if norm == p or norm.startswith(p + "_"):
                found[hits[norm]] = norm
    return found


def append_truth_counts(matches: DataFrame, truth: DataFrame, sv: bool = False) -> DataFrame:
    """Truth AC/AF/AN columns and genotype counts joined by truth id.

    Small-variant truth derives het = AC - 2 hom and homref = AN/2 - hom - het;
    SV truth carries the three counts itself.
    """
    names = truth_count_columns(truth.columns)
    cols = [F.col("id").alias("truth_id")] + [F.col(k).alias(v) for k, v in names.items()]
    if sv:
        cols += [F.col(x) for x in ("N_HOMREF", "N_HET", "N_HOMALT")]
    else:
        hom = F.coalesce(F.col("nhomalt").cast("double"), F.lit(0.0))
        het = F.coalesce(F.col("AC").cast("double"), F.lit(0.0)) - 2 * hom
        ref = F.coalesce(F.col("AN").cast("double"), F.lit(0.0)) / 2 - hom - het
        cols += [ref.cast("bigint").alias("N_HOMREF"), het.cast("bigint").alias("N_HET"), F.col("nhomalt").cast("bigint").alias("N_HOMALT")]
    t = truth.select(*cols)
    return matches.join(lookup(t, ["truth_id"], [x for x in t.columns if x != "truth_id"]), "truth_id", "left")


def unify_annotation_tables(tables: list[DataFrame]) -> DataFrame:
    """Column union: fixed columns first, then AC, AF and AN columns in order; absent values NULL."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    counts = truth_count_columns(out.columns)
    return out.select(*[x for x in out.columns if x not in counts], *counts)


def merge_annotation_tables(tables: list[DataFrame], key=tuple(KEY5)) -> DataFrame:
    """One row per key over all tables; per column the last table holding a value wins.

    A union and one aggregation replace the chain of full outer joins.
    """
    key = list(key)
    cols: list[str] = []
    for t in tables:
        cols += [x for x in t.columns if x not in key and x not in cols]
    tagged = [t.withColumn("_file", F.lit(i)) for i, t in enumerate(tables)]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return u.groupBy(*key).agg(*[
        F.max_by(x, F.when(F.col(x).isNotNull(), F.col("_file"))).alias(x) for x in cols])


def extract_new_annotations(new: DataFrame, original: DataFrame, key=tuple(KEY5)) -> DataFrame:
    """Keys and the columns ``original`` lacks; flags as 1/0."""
    key = list(key)
    fresh = [x for x in new.columns if x not in original.columns and x not in key]
    kinds = dict(new.dtypes)
    return new.select(*key, *[F.coalesce(F.col(x), F.lit(False)).cast("int").alias(x) if kinds[x] == "boolean" else F.col(x) for x in fresh])


def annotate_dbsnp(sites: DataFrame, truth: DataFrame, order: str = "file_pos") -> DataFrame:
    """Truth ALT lists are split; the site's whole ALT text must equal one allele. The last truth id wins."""
    t = truth.select("chrom", "pos", "ref", F.explode(F.split("alt", ",")).alias("alt"), F.col("id").alias("dbsnp_id"), order)
    return sites.join(lookup(t, ["chrom", "pos", "ref", "alt"], ["dbsnp_id"], order), ["chrom", "pos", "ref", "alt"])


def annotate_predictors(sites: DataFrame, by_allele: dict[str, DataFrame], by_locus: dict[str, DataFrame]) -> DataFrame:
    """Scores joined by allele or by locus; sites without any score are dropped."""
    out = sites
    for name, t in by_allele.items():
        k = ["chrom", "pos", "ref", "alt"]
        out = out.join(lookup(t.withColumn(name, F.col("score")), k, [name]), k, "left")
    for name, t in by_locus.items():
        out = out.join(lookup(t.withColumn(name, F.col("score")), ["chrom", "pos"], [name]), ["chrom", "pos"], "left")
    return out.filter(F.coalesce(*[F.col(n) for n in [*by_allele, *by_locus]]).isNotNull())


# ------------------------------------------------------------------ genotypes

def _other(df: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Look-up side of a call join: one row per key, columns prefixed ``o_``, plus ``o_hit``."""
    return lookup(df, key, cols).withColumnsRenamed({x: f"o_{x}" for x in cols}).withColumn("o_hit", F.lit(True))


def _drop_other(df: DataFrame) -> DataFrame:
    return df.drop(*[x for x in df.columns if x.startswith("o_")])


def allele_key(df: DataFrame) -> DataFrame:
    """Upper-cased alleles used to pair call sets."""
    return df.withColumns({"uref": F.upper("ref"), "ualt": F.upper("alt")})


def fill_phased_genotypes(phased: DataFrame, unphased: DataFrame, fields=("ad", "dp", "gq"),
                          key=("chrom", "pos", "uref", "ualt", "sample")) -> DataFrame:
    """On sites both sets hold, GTs without an alt and not fully called come from the unphased set and its other fields win.

    Such are calls with no allele, half-missing ones whose called side is the reference, and a lone reference allele.
    """
    key = list(key)
    x = phased.join(_other(unphased, key, ["gt", *fields]), key, "left")
    empty = g.all_null("gt") | (~g.is_carrier("gt") & (g.has_null("gt") | (F.size("gt") == 1)))
    x = x.withColumn("gt", F.when(empty & F.col("o_gt").isNotNull(), F.col("o_gt")).otherwise(F.col("gt")))
    for f in fields:
        x = x.withColumn(f, F.when(F.coalesce("o_hit", F.lit(False)), F.col(f"o_{f}")).otherwise(F.col(f)))
    return _drop_other(x)


def fill_format_fields(calls: DataFrame, source: DataFrame, key, fields=("ad", "dp"), only_alt: bool = False,
                       only_ref: bool = False, unphase: bool = False, add_pl: bool = False, means=(0.05, 0.5, 0.95),
                       priors=None) -> DataFrame:
    """Take FORMAT fields from ``source`` on matching calls, optionally only for alt or for ref
    calls; may recompute PL/GQ from AD and clear phase."""
    key = list(key)
    x = calls.join(_other(source, key, list(fields)), key, "left")
    take = F.coalesce("o_hit", F.lit(False))
    if only_alt:
        take = take & g.is_carrier("gt")
    if only_ref:
        take = take & ~g.is_carrier("gt") & ~g.all_null("gt")
    x = x.withColumn("o_take", take)
    for f in fields:
        x = x.withColumn(f, F.when(F.col("o_take"), F.col(f"o_{f}")).otherwise(F.col(f)))
    if add_pl:
        pl = g.pl_from_ad(F.element_at("ad", 1), F.element_at("ad", 2), means, priors)
        x = x.withColumn("pl", F.when(F.col("o_take"), pl).otherwise(F.col("pl")))
        x = x.withColumn("gq", F.when(F.col("o_take"), g.gq_from_pl("pl")).otherwise(F.col("gq")))
    if unphase:
        x = x.withColumn("phased", F.lit(False))
    return _drop_other(x)


def transfer_genotypes(base: DataFrame, donor: DataFrame, site_key) -> DataFrame:
    """Matched sites: het calls take the donor's GT and phase. Unmatched sites lose phase."""
    site_key = list(site_key)
    key = [*site_key, "sample"]
    known = donor.select(*site_key).distinct().withColumn("o_site", F.lit(True))
    x = base.join(known, site_key, "left").join(_other(donor, key, ["gt", "phased"]), key, "left")
    take = F.coalesce("o_hit", F.lit(False)) & g.is_het("gt")
    x = x.withColumns({"gt": F.when(take, F.col("o_gt")).otherwise(F.col("gt")),
                       "phased": F.when(F.col("o_site").isNull(), F.lit(False)).when(take, F.col("o_phased")).otherwise(F.col("phased"))})
    return _drop_other(x)


def translate_alleles(gt, from_alts, to_alts) -> Column:
    """GT renumbered from one ALT list to another by sequence; unknown alleles become missing."""
    to_up = F.transform(c(to_alts), F.upper)

    def one(a):
        seq = F.upper(F.try_element_at(c(from_alts), a))
        at = F.array_position(to_up, seq).cast("int")
        return F.when(a == 0, a).when(at > 0, at)

    return F.transform(c(gt), one)


def replace_sample_calls(cohort: DataFrame, samples: DataFrame) -> DataFrame:
    """By id and sample: het calls get the sample's GT (alleles matched by sequence), PS and PF are
    copied; unmatched repeat calls that are not hom-ref are cleared."""
    x = cohort.join(_other(samples, ["id", "sample"], ["gt", "phased", "alts", "ps", "pf"]), ["id", "sample"], "left")
    hit = F.coalesce("o_hit", F.lit(False))
    swap = hit & g.is_het("gt") & (F.size("o_gt") == 2)
    homref = F.coalesce((F.size("gt") > 0) & F.forall("gt", lambda a: F.coalesce(a == 0, F.lit(False))), F.lit(False))
    wipe = ~hit & (F.col("allele_type") == "trv") & ~homref
    blank = F.when(F.size("gt") > 0, F.transform("gt", lambda a: F.lit(None).cast("int"))).otherwise(F.array(F.lit(None).cast("int"), F.lit(None).cast("int")))
    new_gt = F.when(swap, translate_alleles("o_gt", "o_alts", "alts")).when(wipe, blank).otherwise(F.col("gt"))
    x = x.withColumns({"_gt": new_gt, "phased": F.when(swap, F.col("o_phased")).otherwise(F.col("phased")),
                       "ps": F.when(hit, F.col("o_ps")).when(wipe, F.lit(None)).otherwise(F.col("ps")),
                       "pf": F.when(hit, F.col("o_pf")).when(wipe, F.lit(None)).otherwise(F.col("pf"))})
    return _drop_other(x.withColumn("gt", F.col("_gt")).drop("_gt"))


def replace_caller_ad(cohort: DataFrame, samples: DataFrame, min_length: int = 50,
                      key=("chrom", "pos", "uref", "ualt", "sample")):
    """(calls, counts): for long variants carried by a sample, equal alleles and equal ALT copies
    take the sample's AD with PL/GQ from it; counts per sample of carried, site and call matches."""
    key = list(key)
    x = cohort.join(_other(samples, key, ["gt", "ad"]), key, "left")
    asked = (F.abs("allele_length") >= min_length) & (g.n_alt("gt") > 0)
    x = x.withColumn("o_asked", F.coalesce(asked, F.lit(False)))
    x = x.withColumn("o_site", F.col("o_asked") & F.coalesce("o_hit", F.lit(False)))
    x = x.withColumn("o_call", F.col("o_site") & (g.n_alt("gt") == g.n_alt("o_gt")))
    counts = x.groupBy("sample").agg(F.count_if("o_asked").alias("variant_count"), F.count_if("o_site").alias("variant_match_count"),
                                     F.count_if("o_call").alias("variant_call_match_count"))
    pl = g.pl_from_ad(F.element_at("o_ad", 1), F.element_at("o_ad", 2), (0.03, 0.5, 0.97), (0.33, 0.34, 0.33))
    x = x.withColumns({"ad": F.when(F.col("o_call"), F.col("o_ad")).otherwise(F.col("ad")),
                       "pl": F.when(F.col("o_call"), pl).otherwise(F.col("pl"))})
    x = x.withColumn("gq", F.when(F.col("o_call"), g.gq_from_pl("pl")).otherwise(F.col("gq")))
    return _drop_other(x), counts


def merge_regenotypes(base: DataFrame, regeno: DataFrame, sex: DataFrame, site_key=("chrom", "pos", "ref", "alt", "id"),
                      sites: DataFrame | None = None) -> DataFrame:
    """Fill ref/missing base calls from a re-genotyper.

    Re-genotyped ref: depth, AD, PL and GQ are taken and GT becomes hom-ref (``0/.`` for a
    male on chrX/Y; a female's chrY call is cleared). Re-genotyped missing or alt: cleared.
    Every call ends unphased with missing alleles last. Where ``base`` has no ``chrom``, it comes from ``sites``
    (the columns of ``site_key``, chrom), and calls without a site go: calls grouped by their key then meet where they lie.
    """
    key = [*site_key, "sample"]
    x = base.join(_other(regeno, key, ["gt", "ad", "dp"]), key, "left")
    called = g.is_carrier("gt")
    o_called, o_missing = g.is_carrier("o_gt"), g.all_null("o_gt")
    # Only what is still needed goes on to sites and samples.
    x = x.withColumns({"o_clear": ~called & (o_missing | o_called), "o_ref": ~called & ~o_called & ~o_missing}).drop("o_gt", "o_hit")
    x = x.withColumns({n: F.when(F.col("o_ref"), F.col(n)) for n in ("o_ad", "o_dp")})
    if sites is not None:
        x = x.join(sites, list(site_key))
    x = x.join(sex.select("sample", F.col("sex").alias("o_sex")), "sample", "left")
    male = F.coalesce(F.col("o_sex") == "M", F.lit(False))
    to_ref = F.col("o_ref")
    y_female = ~male & (F.col("chrom") == "chrY")
    hemi = male & F.col("chrom").isin("chrX", "chrY")
    wipe = F.col("o_clear") | (to_ref & y_female)
    fill = to_ref & ~y_female
    has_ad = fill & (F.size("o_ad") == 2)
    null = F.lit(None).cast("int")
    two_null = F.array(null, null)
    gt = F.when(wipe, two_null).when(fill & hemi, F.array(F.lit(0), null)).when(fill, F.array(F.lit(0), F.lit(0))).otherwise(F.col("gt"))
    pl = g.pl_from_ad(F.element_at("o_ad", 1), F.element_at("o_ad", 2))
    x = x.withColumns({"o_wipe": wipe, "o_fill": fill, "o_has": has_ad, "o_new": gt, "o_pl": pl})
    x = x.withColumns({
        "gt": g.sort_missing_last("o_new"), "phased": F.lit(False),
        "dp": F.when(F.col("o_wipe"), null).when(F.col("o_fill"), F.col("o_dp")).otherwise(F.col("dp")),
        "ad": F.when(F.col("o_wipe"), two_null).when(F.col("o_has"), F.col("o_ad")).otherwise(F.col("ad")),
        "gq": F.when(F.col("o_wipe"), null).when(F.col("o_has"), g.gq_from_pl("o_pl")).otherwise(F.col("gq")),
        "pl": F.when(F.col("o_wipe"), F.array(null, null, null)).when(F.col("o_has"), F.col("o_pl")).otherwise(F.col("pl"))})
    return _drop_other(x)


def pull_phased_genotypes(backbone: DataFrame, other: DataFrame, key=("chrom", "pos", "uref", "ualt", "sample")):
    """(calls, counts): unphased full hets take a phased call of the other set with its PS;
    per sample numbers of hets, unphased hets before and after, and their shares."""
    key = list(key)
    x = backbone.join(_other(other, key, ["gt", "phased", "ps"]), key, "left")
    het = g.is_full_diploid("gt") & (F.element_at("gt", 1) != F.element_at("gt", 2))
    x = x.withColumn("o_het", F.coalesce(het, F.lit(False)))
    x = x.withColumn("o_un", F.col("o_het") & ~F.coalesce("phased", F.lit(False)))
    x = x.withColumn("o_take", F.col("o_un") & F.coalesce(F.col("o_phased") & F.col("o_gt").isNotNull(), F.lit(False)))
    counts = x.groupBy("sample").agg(F.count_if("o_het").alias("n_het"), F.count_if("o_un").alias("n_het_unphased"),
                                     F.count_if(F.col("o_un") & ~F.col("o_take")).alias("n_het_unphased_post_pull"))
    for part in ("n_het_unphased", "n_het_unphased_post_pull"):
        counts = counts.withColumn(part.replace("n_", "prop_", 1), F.coalesce(F.try_divide(part, "n_het"), F.lit(0.0)))
    x = x.withColumns({"gt": F.when(F.col("o_take"), F.col("o_gt")).otherwise(F.col("gt")),
                       "ps": F.when(F.col("o_take"), F.coalesce("o_ps", "ps")).otherwise(F.col("ps")),
                       "phased": F.col("phased") | F.col("o_take")})
    return _drop_other(x), counts


def attach_phase_sets(calls: DataFrame, phase_sets: DataFrame, key=("sample", "chrom", "pos")) -> DataFrame:
    """Sparse (sample, position, PS) rows joined onto calls."""
    key = list(key)
    return calls.drop("ps").join(lookup(phase_sets, key, ["ps"]), key, "left")


# ------------------------------------------------------------------ repeats and mobile elements

def tag_tr_source(sites: DataFrame, catalog: DataFrame | None = None, constant: str | None = None) -> DataFrame:
    """Catalog id by ``trid``, or one constant tag."""
    if constant is not None:
        return sites.withColumn("tr_source", F.lit(constant))
    return sites.join(lookup(catalog, ["trid"], ["tr_source"]), "trid", "left")


def subset_to_catalog(sites: DataFrame, catalog: DataFrame, order: str = "file_pos") -> DataFrame:
    """First row per (TRID, POS) whose pair is in the catalog."""
    cat = catalog.select("trid", "pos").distinct()
    kept = sites.join(cat, ["trid", "pos"], "left_semi")
    rest = [x for x in sites.columns if x not in ("trid", "pos")]
    return kept.groupBy("trid", "pos").agg(F.min_by(F.struct(*rest), order).alias("_v")).select(
        *[F.col(x) if x in ("trid", "pos") else F.col(f"_v.{x}").alias(x) for x in sites.columns])


def consolidate_meis(primary: DataFrame, palmer: DataFrame, svan: DataFrame) -> DataFrame:
    """LINE rows pass; others need the same key and type in one of two sets (the second upper-cased)."""
    k = [*KEY5, "me_type"]
    support = palmer.select(*k).unionByName(svan.withColumn("me_type", F.upper("me_type")).select(*k)).distinct()
    line = F.col("me_type") == "LINE"
    return primary.filter(line).unionByName(primary.filter(~line).join(support, k, "left_semi"))


# Repeat class -> element, and the structures that count as intact.
ME_CLASS = {"SINE/Alu": "ALU", "Retroposon/SVA": "SVA", "LINE/L1": "LINE"}
INTACT = ["INTACT", "INTACT_3end"]


def classify_l1meaid(calls: DataFrame, sites: DataFrame) -> DataFrame:
    """Intact calls become ALU/SVA/LINE with the id of the site at (chrom, pos, ref, alt)."""
    kind = F.create_map(*[F.lit(z) for kv in ME_CLASS.items() for z in kv])[F.col("classification")]
    m = calls.filter(F.col("structure").isin(INTACT)).withColumn("me_type", kind).filter("me_type is not null")
    k = ["chrom", "pos", "ref", "alt"]
    return m.join(lookup(sites, k, ["id"]), k).select(*k, "id", "me_type", "sub_family")


# ------------------------------------------------------------------ samples

def find_trios(ped: DataFrame, samples: DataFrame) -> DataFrame:
    """(sample, father, mother) with both parents named and all three present."""
    t = ped.filter((F.col("father") != "0") & (F.col("mother") != "0")).select("sample", "father", "mother")
    have = samples.select("sample").distinct()
    for who in ("sample", "father", "mother"):
        t = t.join(have.withColumnRenamed("sample", who), who, "left_semi")
    return t.select("sample", "father", "mother")


def assign_samples_to_truth(samples: DataFrame, truth_sets: list[DataFrame]):
    """(assigned, missing): index of the first truth set holding each sample, and samples in none."""
    tagged = [t.select("sample").distinct().withColumn("idx", F.lit(i)) for i, t in enumerate(truth_sets)]
    first = reduce(DataFrame.unionByName, tagged).groupBy("sample").agg(F.min("idx").alias("truth_index"))
    s = samples.select("sample").distinct()
    return s.join(first, "sample"), s.join(first, "sample", "left_anti")


def compare_sample_lists(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each sample of either list as ``common``, ``only_a`` or ``only_b``."""
    u = a.select("sample", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select("sample", F.lit(0).alias("a"), F.lit(1).alias("b")))
    u = u.groupBy("sample").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return u.select("sample", F.when(F.col("a") + F.col("b") == 2, "common").when(F.col("a") == 1, "only_a").otherwise("only_b").alias("side"))


def check_sample_consistency(a: DataFrame, b: DataFrame) -> DataFrame:
    """Differences only; empty when the two lists agree."""
    return compare_sample_lists(a, b).filter("side <> 'common'")


# ------------------------------------------------------------------ merging call sets

def merge_vep_af(vep: DataFrame, af: DataFrame, vep_cols: list[str], af_cols: list[str], key=tuple(KEY5)) -> DataFrame:
    """Two annotation passes over the same sites put side by side."""
    key = list(key)
    return lookup(vep, key, vep_cols).join(lookup(af, key, af_cols), key, "left")


def merge_by_position(short: DataFrame, long: DataFrame, cols: list[str], key=tuple(KEY5), limit: int = 50) -> DataFrame:
    """Same sites in both: values from ``long`` at |length| >= limit, else from ``short``."""
    key = list(key)
    o = lookup(long, key, cols).withColumnsRenamed({x: f"_l_{x}" for x in cols})
    x = short.join(o, key)
    big = F.abs("allele_length") >= limit
    return x.withColumns({n: F.when(big, F.col(f"_l_{n}")).otherwise(F.col(n)) for n in cols}).drop(*[f"_l_{n}" for n in cols])


def liftover_by_table(sites: DataFrame, moves: DataFrame, order: str = "file_pos") -> DataFrame:
    """(chrom, ref, alt) -> new start; the last row wins, unmatched sites are dropped."""
    m = lookup(moves, ["chrom", "ref", "alt"], ["new_pos"], order)
    return sites.join(m, ["chrom", "ref", "alt"]).withColumn("pos", F.col("new_pos")).drop("new_pos")


def sites_to_liftover_bed(sites: DataFrame) -> DataFrame:
    return sites.select("chrom", (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + F.length("ref")).alias("end"), "ref", "alt", "id")


def combine_haplotypes(df: DataFrame, maternal="maternal", paternal="paternal") -> DataFrame:
    """Presence on two haplotypes as 1/1, 0/1 or 0/0."""
    n = F.coalesce(F.col(maternal).cast("int"), F.lit(0)) + F.coalesce(F.col(paternal).cast("int"), F.lit(0))
    return df.withColumn("gt", F.when(n == 2, "1/1").when(n == 1, "0/1").otherwise("0/0"))


def merge_cohort(sets: list[DataFrame], samples: DataFrame, missing_to_ref: bool = True,
                 site_key=("chrom", "pos", "ref", "alt")) -> DataFrame:
    """Outer union by exact site; every site gets a call for every sample.

    ``merge_count`` is the number of input sets holding the site. The result is sites x
    samples by definition: the sample list is attached to each site as one array value
    and exploded in place, so nothing is shuffled to build it.
    """
    site_key = list(site_key)
    u = reduce(DataFrame.unionByName, [s.withColumn("_set", F.lit(i)) for i, s in enumerate(sets)])
    calls = u.groupBy(*site_key, "sample").agg(F.min_by("gt", "_set").alias("gt"))
    per_site = u.groupBy(*site_key).agg(F.count_distinct("_set").alias("merge_count"))
    everyone = samples.agg(F.collect_set("sample").alias("_all")).scalar()  # cohort size, not data size
    grid = per_site.withColumn("sample", F.explode(everyone))
    none = F.array(F.lit(0), F.lit(0)) if missing_to_ref else F.array(F.lit(None).cast("int"), F.lit(None).cast("int"))
    return grid.join(calls, [*site_key, "sample"], "left").withColumn("gt", F.coalesce("gt", none))


def merge_cohort_multiallelic(sets: list[DataFrame]) -> DataFrame:
    """Sites at one (chrom, pos, ref) become one record with all distinct ALTs in first-seen order;
    calls are renumbered to them. Inputs are biallelic rows with ``file_pos``."""
    u = reduce(DataFrame.unionByName, [s.withColumn("_set", F.lit(i)) for i, s in enumerate(sets)])
    alts = u.groupBy("chrom", "pos", "ref", "alt").agg(F.min(F.struct("_set", "file_pos")).alias("_o"))
    site = alts.groupBy("chrom", "pos", "ref").agg(F.array_sort(F.collect_list(F.struct("_o", "alt"))).alias("_a"))
    site = site.select("chrom", "pos", "ref", F.transform("_a", lambda x: x["alt"]).alias("alts"))
    x = u.join(site, ["chrom", "pos", "ref"])
    at = F.array_position("alts", F.col("alt")).cast("int")
    gt = F.transform("gt", lambda a: F.when(a > 0, at).otherwise(a))
    x = x.withColumn("_g", gt)
    # Several biallelic rows of one sample fold into one call: the largest allele per side.
    side = [F.max(F.element_at("_g", i)).alias(f"_{i}") for i in (1, 2)]
    y = x.groupBy("chrom", "pos", "ref", "alts", "sample").agg(*side)
    return y.select("chrom", "pos", "ref", "alts", "sample", F.array("_1", "_2").alias("gt"))


def concat_shards(shards: list[DataFrame], drop_exact_dups: bool = False, key=("chrom", "pos", "ref", "alt")) -> DataFrame:
    out = reduce(lambda a, b: a.unionByName(b), shards)
    if not drop_exact_dups:
        return out
    rest = [x for x in out.columns if x not in key]
    return lookup(out, list(key), rest).select(*out.columns) if rest else out.distinct()


def concat_tsvs(tables: list[DataFrame], sort: bool = True) -> DataFrame:
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return out.orderBy(*contig_sort("chrom"), "pos") if sort else out


def integrate_callsets(small: DataFrame, large: DataFrame, size: int = 50, tags=("small", "sv"),
                       flags=("LARGE_INDEL", "SMALL_SV")) -> DataFrame:
    """Two sources into one id'd site list.

    Rows get attributes and a SOURCE tag; small-variant rows of at least ``size`` and SV
    rows below it are filter-flagged. A flagged small-variant row equal to an SV row is dropped.
    """
    from .rows import add_filter, assign_ids, split_multiallelics, variant_attributes

    def prepare(df, tag, flag, cond):
        d = variant_attributes(split_multiallelics(df)).withColumn("source", F.lit(tag))
        return add_filter(d, flag, cond)

    a = prepare(small, tags[0], flags[0], f"abs(allele_length) >= {size}")
    b = prepare(large, tags[1], flags[1], f"abs(allele_length) < {size}")
    k = ["chrom", "pos", "ref", "alt"]
    flagged = F.array_contains("filters", flags[0])
    kept = a.filter(~flagged).unionByName(a.filter(flagged).join(b.select(*k).distinct(), k, "left_anti"))
    u = kept.withColumn("_src", F.lit(0)).unionByName(b.withColumn("_src", F.lit(1)))
    return assign_ids(u, ["file_pos", "alt_index", "_src"]).drop("_src")


# ------------------------------------------------------------------ reads and pairs

def compare_reads(a: DataFrame, b: DataFrame) -> DataFrame:
    """Read-set agreement by name: shared, one-sided, equal length, equal sequence (md5)."""
    x = a.select("read", F.length("seq").alias("_la"), F.md5("seq").alias("_ma"))
    y = b.select("read", F.length("seq").alias("_lb"), F.md5("seq").alias("_mb"))
    j = x.join(y, "read", "full_outer")
    both = F.col("_ma").isNotNull() & F.col("_mb").isNotNull()
    return j.agg(F.count_if(both).alias("n_shared"), F.count_if(F.col("_mb").isNull()).alias("n_only_a"),
                 F.count_if(F.col("_ma").isNull()).alias("n_only_b"), F.count_if(F.col("_la") == F.col("_lb")).alias("n_same_length"),
                 F.count_if(F.col("_ma") == F.col("_mb")).alias("n_same_sequence"))


def transfer_read_tags(target: DataFrame, source: DataFrame, tags=("mm", "ml")) -> DataFrame:
    """Modification tags by read name; reads without a partner keep NULL."""
    return target.drop(*tags).join(lookup(source, ["read"], list(tags)), "read", "left")


def matched_info_pairs(matches: DataFrame, evals: DataFrame, truth: DataFrame) -> DataFrame:
    """(id, truth_id, eval info, truth info) for matched pairs."""
    e = evals.select("id", F.col("info").alias("eval_info"))
    t = truth.select(F.col("id").alias("truth_id"), F.col("info").alias("truth_info"))
    return matches.select("id", "truth_id").join(e, "id").join(t, "truth_id").select("id", "truth_id", "eval_info", "truth_info")
