"""Per-site and per-allele statistics over long call tables.

A call table has the site key, ``sample`` and ``gt``/``ad``/``pl``/``dp``/``gq``
columns. Everything is a grouped aggregation with map-side partials, so a site
carrying most of the calls costs no more than its share of scan work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import genotype as g, stats
from .intervals import interval_semi
from .sequences import distance

# ------------------------------------------------------------------ quality


def allele_calls(calls: DataFrame) -> DataFrame:
    """One row per fully called genotype and ALT (``allele`` from 1; needs ``n_alts``)."""
    full = calls.filter(~g.has_null("gt") & (F.size("gt") > 0))
    return full.withColumn("allele", F.explode(F.sequence(F.lit(1), F.col("n_alts"))))


def site_quality(calls: DataFrame, key) -> DataFrame:
    """Per site and allele: carrier depth, carrier PL[0] sum, mean PL[0]/AD, inbreeding
    coefficient, largest allele-balance p, and the site's Hardy-Weinberg chi-square.

    Calls with a missing allele are skipped. Values are rounded half-even to 6 places.
    """
    key = list(key)
    x = allele_calls(calls)
    i = F.col("allele")
    copies = F.size(F.filter("gt", lambda a: a == i))
    refs = F.size(F.filter("gt", lambda a: a == 0))
    x = x.withColumns({"_c": copies, "_r": refs, "_nn": g.n_alt("gt"), "_pl0": F.try_element_at("pl", F.lit(1)),
                       "_ad0": F.try_element_at("ad", F.lit(1)), "_adi": F.try_element_at("ad", i + 1)})
    carrier = F.col("_c") > 0
    qd = F.when(carrier & (F.col("_adi") > 0), F.col("_pl0") / F.col("_adi"))
    depth = F.col("_ad0") + F.col("_adi")
    p = F.when((F.col("_c") == 1) & (F.col("_r") == 1) & (depth > 0), F.bround(stats.binom_half_p(F.col("_ad0"), depth), 6))
    agg = x.groupBy(*key, "allele").agg(
        F.sum(F.when(carrier, F.col("dp"))).alias("as_vardp"), F.sum(F.when(carrier, F.col("_pl0"))).alias("as_qualapprox"),
        F.bround(F.avg(qd), 6).alias("as_qd"), F.max(p).alias("as_pab_max"),
        F.count_if(F.expr("_c = 0")).alias("n_ref"), F.count_if(F.expr("_c = 1")).alias("n_het"), F.count_if(F.expr("_c > 1")).alias("n_hom"),
        F.count_if(F.expr("_nn = 0")).alias("site_ref"), F.count_if(F.expr("_nn = 1")).alias("site_het"), F.count_if(F.expr("_nn > 1")).alias("site_alt"))
    n = (F.col("n_ref") + F.col("n_het") + F.col("n_hom")).cast("double")
    pr = (2.0 * F.col("n_ref") + F.col("n_het")) / (2.0 * n)
    e_het = 2.0 * pr * (1.0 - pr) * n
    inb = F.when(e_het > 0, F.bround(1.0 - F.col("n_het") / e_het, 6)).otherwise(F.lit(0.0))
    return (agg.withColumn("inbreeding_coeff", inb)
            .withColumn("hwe_chi2", hwe_chi2("site_ref", "site_het", "site_alt")).drop("site_ref", "site_het", "site_alt"))


def hwe_chi2(ref, het, alt) -> Column:
    r, h, a = (F.col(v).cast("double") for v in (ref, het, alt))
    n = r + h + a
    p = (2.0 * r + h) / (2.0 * n)
    q = 1.0 - p
    terms = [(r, p * p * n), (h, 2.0 * p * q * n), (a, q * q * n)]
    return reduce(lambda x, y: x + y, [F.when(e > 0, (o - e) * (o - e) / e).otherwise(F.lit(0.0)) for o, e in terms])


def hwe(quality: DataFrame) -> DataFrame:
    """Hardy-Weinberg p (chi-square, 1 df) for the output of ``site_quality``."""
    return quality.withColumn("hwe", F.bround(stats.chi2_sf_1df(F.col("hwe_chi2")), 6))


# ------------------------------------------------------------------ frequencies

FREQ = ["ac", "an", "af", "ncr", "nhet", "nhomalt", "nhomref", "n_bi_genos", "freq_het", "freq_homalt", "freq_homref"]


def _per_allele(calls: DataFrame, by: list[str], hap: Column, site: dict[str, Column], deal: list[str] | None = None) -> DataFrame:
    """``by``, the summed ``site`` values, ``n_alts`` and a map ``_ac`` of copies by ALT number.

    A call gives one row for the site values and one for each ALT it carries, summed before they meet again, so a
    site of many ALTs costs no more than the copies seen. ``hap`` calls count an ALT once. With ``deal``, equal calls are
    counted first and their counts dealt by those columns, which serves every later step that groups by them and more.
    """
    alts = F.coalesce(F.filter("gt", lambda a: a > 0), F.array().cast("array<int>"))
    seen = F.concat(F.array(F.lit(0)), F.when(hap, F.array_distinct(alts)).otherwise(alts))
    n_alts = F.col("n_alts") if "n_alts" in calls.columns else F.lit(1)
    x = calls.select(*by, n_alts.alias("n_alts"), *[v.cast("bigint").alias(k) for k, v in site.items()], seen.alias("_seen"))
    x = x.groupBy(*x.columns).agg(F.count("*").alias("_k")).repartition(*deal) if deal else x.withColumn("_k", F.lit(1).cast("bigint"))
    x = x.withColumn("_al", F.explode("_seen"))
    own = F.col("_al") == 0
    sums = x.groupBy(*by, "_al").agg(F.sum("_k").alias("_ac"), F.max("n_alts").alias("n_alts"), *[F.sum(F.when(own, F.col(k) * F.col("_k"))).alias(k) for k in site])
    return sums


def _met(sums: DataFrame, by: list[str], site) -> DataFrame:
    """One row per ALT with its ``ac`` beside the site values."""
    copies = F.map_from_entries(F.collect_list(F.when(F.col("_al") > 0, F.struct("_al", "_ac"))))
    one = sums.groupBy(*by).agg(F.max("n_alts").alias("n_alts"), copies.alias("_m"), *[F.sum(k).alias(k) for k in site])
    out = one.withColumn("allele", F.explode(F.sequence(F.lit(1), F.col("n_alts"))))
    return out.withColumn("ac", F.coalesce(F.try_element_at("_m", "allele"), F.lit(0)).cast("bigint")).drop("_m")


def allele_frequencies(calls: DataFrame, samples: DataFrame, key, par: DataFrame | None = None) -> DataFrame:
    """Counts and frequencies per site and ALT for all samples, each population, each sex, and both.

    ``samples(sample, population, sex)``; ``calls`` may hold ``n_alts`` (else 1). With a ``chrom`` column in the key and
    ``par`` intervals (or none), male calls on chrX/chrY outside them count as one allele and
    female chrY calls are left out. ``population``/``sex`` are ``all`` in the totals. Genotype counts and
    ``grpmax`` (the population with the highest frequency, first name on ties) are for sites of one ALT; NULL otherwise.
    """
    key = list(key)
    x = calls.join(samples.select("sample", "population", "sex"), "sample")
    hap = F.lit(False)
    if "chrom" in key:
        hap = F.col("chrom").isin("chrX", "chrY") & (F.col("sex") == "male")
        if par is not None:
            spots = calls.select("chrom", F.col("pos").alias("start")).distinct().withColumn("end", F.col("start") + 1)
            inside = interval_semi(spots, par).select("chrom", F.col("start").alias("pos"), F.lit(True).alias("_par"))
            x = x.join(inside, ["chrom", "pos"], "left")
            hap = hap & F.col("_par").isNull()
        x = x.filter(~((F.col("chrom") == "chrY") & (F.col("sex") == "female")))
    called = F.size(F.filter("gt", lambda a: a.isNotNull()))
    alts = g.n_alt("gt")
    full = ~g.has_null("gt")
    site = {"an": F.when(hap, F.least(called, F.lit(1))).otherwise(called), "_slots": F.when(hap, 1).otherwise(F.greatest(F.size("gt"), F.lit(0))),
            "nhet": full & ~hap & (alts == 1), "nhomalt": full & (alts >= F.when(hap, 1).otherwise(2)), "nhomref": full & (alts == 0)}
    # The cube runs over site x population x sex x ALT totals, not over calls.
    parts = _per_allele(x, [*key, "population", "sex"], hap, site, deal=key)
    dims = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")) for p in (False, True) for s in (False, True)])
    cube = (parts.withColumn("_g", F.explode(dims))
            .withColumn("population", F.when(F.col("_g.p"), F.col("population")).otherwise("all"))
            .withColumn("sex", F.when(F.col("_g.s"), F.col("sex")).otherwise("all"))
            .groupBy(*key, "population", "sex", "_al").agg(F.sum("_ac").alias("_ac"), F.max("n_alts").alias("n_alts"), *[F.sum(v).alias(v) for v in site]))
    out = _met(cube, [*key, "population", "sex"], site)
    one = F.col("n_alts") == 1
    out = out.withColumns({v: F.when(one, F.col(v)) for v in ("nhet", "nhomalt", "nhomref")})
    out = out.withColumns({"af": F.try_divide("ac", "an"), "ncr": 1 - F.try_divide("an", "_slots"),
                           "n_bi_genos": F.col("nhet") + F.col("nhomalt") + F.col("nhomref")})
    for v in ("het", "homalt", "homref"):
        out = out.withColumn(f"freq_{v}", F.try_divide(f"n{v}", "n_bi_genos"))
    carried = one & (F.col("sex") == "all") & (F.col("population") != "all") & (F.col("ac") > 0)
    best = F.min(F.when(carried, F.struct((-F.col("af")).alias("a"), "population"))).over(W.partitionBy(*key))
    return out.withColumn("grpmax", best["population"]).drop("_slots", "n_alts")


def grpmax(freqs: DataFrame, key) -> DataFrame:
    """Population with the highest frequency among those carrying the allele (ties: first name)."""
    pops = freqs.filter("sex = 'all' and population <> 'all' and ac > 0")
    best = F.min(F.struct((-F.col("af")).alias("a"), "population"))
    return pops.groupBy(*key).agg(best.alias("_b")).select(*key, F.col("_b.population").alias("grpmax"), (-F.col("_b.a")).alias("grpmax_af"))


def fill_tags(calls: DataFrame, key) -> DataFrame:
    """AC, AN and AF per site and ALT (``allele`` from 1; ``n_alts`` or 1 ALT), and the site's MAF: the second largest
    frequency among the reference and all ALTs."""
    key = list(key)
    site = {"an": F.size(F.filter("gt", lambda a: a.isNotNull()))}
    sums = _per_allele(calls, key, F.lit(False), site)
    t = _met(sums, key, site).withColumn("af", F.try_divide("ac", "an")).drop("n_alts")
    w = W.partitionBy(*key)
    rates = F.array_sort(F.array_append(F.collect_list("af").over(w), 1 - F.sum("af").over(w)))
    return t.withColumn("maf", F.try_element_at(rates, F.lit(-2)))


def set_missing_to_ref(calls: DataFrame) -> DataFrame:
    return calls.withColumn("gt", F.transform("gt", lambda a: F.coalesce(a, F.lit(0))))


def common_filter(calls: DataFrame, key, expr: str = "af >= 0.01 and ac > 1") -> DataFrame:
    """Sites of which some ALT's tags satisfy ``expr`` (over ac, an, af, maf)."""
    return fill_tags(calls, key).filter(expr).select(*key).distinct()


def phased_fraction_dedup(calls: DataFrame, allele_key, vid="id", order="file_pos") -> DataFrame:
    """Per identical alleles keep the id with the largest phased share (4 places), the first on ties."""
    full = ~g.has_null("gt")
    per = calls.groupBy(*allele_key, vid, order).agg(F.count_if(full & F.col("phased")).alias("_p"), F.count_if(full).alias("_n"))
    frac = F.bround(F.coalesce(F.try_divide("_p", "_n"), F.lit(0.0)), 4)
    per = per.withColumn("phased_fraction", frac)
    best = per.groupBy(*allele_key).agg(F.min(F.struct((-F.col("phased_fraction")).alias("f"), order, vid)).alias("_b"))
    return best.select(*allele_key, F.col(f"_b.{vid}").alias(vid), (-F.col("_b.f")).alias("phased_fraction"))


# ------------------------------------------------------------------ histograms

def _bins(value: Column, edges, keep: Column, stem: str) -> list[Column]:
    out = []
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        out.append(F.count_if(keep & (value >= lo) & (value < hi)).alias(f"{stem}{i}"))
    return out


def _freq_text(stem: str, n: int) -> Column:
    return F.concat_ws("|", *[F.col(f"{stem}{i}").cast("string") for i in range(n)])


def gq_histogram(calls: DataFrame, key, field="gq", edges=(0, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70, 75, 80, 85, 90, 95, 100),
                 larger: bool = True) -> DataFrame:
    """Histograms of ``field`` (first element of a list) over all calls and over alt carriers.

    Values below the first edge are dropped, values from the last edge on are ``n_larger``.
    """
    first = F.try_element_at(field, F.lit(1)) if dict(calls.dtypes)[field].startswith("array") else F.col(field)
    v = first.cast("double")
    alt = g.is_carrier("gt")
    n = len(edges) - 1
    agg = calls.groupBy(*key).agg(
        *_bins(v, edges, F.lit(True), "_a"), *_bins(v, edges, alt, "_c"),
        F.count_if(v >= edges[-1]).alias(f"{field}_hist_all_n_larger"), F.count_if(alt & (v >= edges[-1])).alias(f"{field}_hist_alt_n_larger"))
    out = [*[F.col(k) for k in key], _freq_text("_a", n).alias(f"{field}_hist_all_bin_freq"), _freq_text("_c", n).alias(f"{field}_hist_alt_bin_freq")]
    if larger:
        out += [f"{field}_hist_all_n_larger", f"{field}_hist_alt_n_larger"]
    return agg.select(*out)


def ab_histogram(calls: DataFrame, key, edges=tuple(i / 20 for i in range(21))) -> DataFrame:
    """Histogram of AD[0]/(AD[0]+AD[1]) (the reference share) over diploid 0/1 calls; 1.0 is outside."""
    het = (F.size("gt") == 2) & ~g.has_null("gt") & (F.array_sort("gt") == F.array(F.lit(0), F.lit(1)))
    r, a = F.try_element_at("ad", F.lit(1)), F.try_element_at("ad", F.lit(2))
    ab = F.when(r + a > 0, r / (r + a).cast("double"))
    agg = calls.groupBy(*key).agg(*_bins(ab, edges, het, "_h"))
    return agg.select(*key, _freq_text("_h", len(edges) - 1).alias("ab_hist_alt_bin_freq"))


def age_histogram(calls: DataFrame, ages: DataFrame, key, reference_date: str,
                  edges=(30, 35, 40, 45, 50, 55, 60, 65, 70, 75, 80)) -> DataFrame:
    """Per site and ALT: ages (days / 365.25 at the reference date) of het and hom carriers.

    Het = one copy with the rest reference; calls with a missing allele are skipped.
    """
    a = ages.select("sample", (F.datediff(F.lit(reference_date).cast("date"), "dob") / 365.25).alias("_age"))
    x = allele_calls(calls).join(a.filter("_age is not null"), "sample")
    i = F.col("allele")
    n = F.size(F.filter("gt", lambda v: v == i))
    refs = F.size(F.filter("gt", lambda v: v == 0))
    het = (n == 1) & (refs == F.size("gt") - 1)
    hom = n == F.size("gt")
    age = F.col("_age")
    cols, m = [], len(edges) - 1
    for stem, keep in (("het", het), ("hom", hom)):
        cols += _bins(age, edges, keep, f"_{stem}")
        cols += [F.count_if(keep & (age < edges[0])).alias(f"age_hist_{stem}_n_smaller"), F.count_if(keep & (age >= edges[-1])).alias(f"age_hist_{stem}_n_larger")]
    agg = x.groupBy(*key, "allele").agg(*cols)
    out = [*key, "allele"]
    for stem in ("het", "hom"):
        out += [_freq_text(f"_{stem}", m).alias(f"age_hist_{stem}_bin_freq"), f"age_hist_{stem}_n_smaller", f"age_hist_{stem}_n_larger"]
    return agg.select(*out)


def single_read_support(calls: DataFrame, key, biallelic: str = "n_alts = 1", max_ac: int = 2) -> DataFrame:
    """Sites where exactly one sample has alt reads and has exactly one; biallelic sites with a
    larger ``ac`` are exempt. Needs ``n_alts`` and ``ac`` beside the calls."""
    alt = F.slice("ad", 2, F.greatest(F.size("ad") - 1, F.lit(1)))
    depth = F.aggregate(alt, F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0)))
    d = F.when(F.size("ad") >= 2, depth)
    agg = calls.groupBy(*key).agg(F.count_if(d > 0).alias("_n"), F.max(d).alias("_m"),
                                  F.bool_or(F.expr(biallelic) & (F.col("ac") > max_ac)).alias("_ex"))
    return agg.filter("_n = 1 and _m = 1 and not coalesce(_ex, false)").select(*key)


# ------------------------------------------------------------------ ploidy

def unphase_samples(calls: DataFrame, samples: DataFrame) -> DataFrame:
    listed = samples.select("sample").distinct().withColumn("_u", F.lit(True))
    x = calls.join(listed, "sample", "left")
    return x.withColumn("phased", F.col("phased") & F.col("_u").isNull()).drop("_u")


def male_hemizygous(gt, phased) -> Column:
    """One allele kept: the last alt (else the last called one); in place when phased, else rightmost."""
    v = F.col(gt)
    idx = F.transform(v, lambda a, i: F.struct(i.alias("i"), a.alias("a")))
    called = F.filter(idx, lambda s: s["a"].isNotNull())
    alts = F.filter(called, lambda s: s["a"] > 0)
    keep = F.when(F.size(alts) > 0, F.element_at(alts, -1)).otherwise(F.try_element_at(called, F.lit(-1)))
    last = F.size(v) - 1
    placed = F.transform(v, lambda a, i: F.when(F.when(F.col(phased), i == keep["i"]).otherwise(i == last), keep["a"]))
    return F.when(F.size(called) <= 1, v).otherwise(placed)


def normalize_ploidy(calls: DataFrame, sex: DataFrame) -> DataFrame:
    """Sex-aware ploidy: female chrY cleared, male chrX/Y hemizygous, haploid padded on the left,
    unphased calls with missing alleles first. ``sex(sample, sex)`` uses M/F."""
    x = calls.join(sex.select("sample", F.col("sex").alias("_sex")), "sample", "left")
    null2 = F.array(F.lit(None).cast("int"), F.lit(None).cast("int"))
    y_female = F.coalesce((F.col("chrom") == "chrY") & (F.col("_sex") == "F"), F.lit(False))
    male = F.coalesce(F.col("chrom").isin("chrX", "chrY") & (F.col("_sex") == "M"), F.lit(False))
    x = x.withColumns({"_clear": y_female, "gt": F.when(male, male_hemizygous("gt", "phased")).otherwise(F.col("gt"))})
    x = x.withColumn("gt", F.when(F.col("gt").isNull(), null2).when(F.size("gt") == 1, F.concat(F.array(F.lit(None).cast("int")), "gt")).otherwise(F.col("gt")))
    x = x.withColumn("gt", F.when(F.col("phased"), F.col("gt")).otherwise(g.sort_missing_first("gt")))
    return x.withColumns({"gt": F.when(F.col("_clear"), null2).otherwise(F.col("gt")),
                          "phased": F.col("phased") & ~F.col("_clear")}).drop("_clear", "_sex")


# ------------------------------------------------------------------ repeats

def longest_pure_run(seq, motif) -> Column:
    """Copies in the longest unbroken run of ``motif`` (documented meaning, 0 without a copy)."""
    s, m = F.upper(F.col(seq)), F.upper(F.col(motif))
    # Mark copies, then measure the longest stretch of marks.
    marked = F.regexp_extract_all(s, F.concat(F.lit("((?:"), m, F.lit(")+)")), F.lit(1))
    return F.coalesce((F.array_max(F.transform(marked, F.length)) / F.length(m)).cast("int"), F.lit(0))


def motif_count(seq, motif) -> Column:
    """Copies of ``motif`` found from left to right, not overlapping; NULL without a motif."""
    s, m = F.upper(F.col(seq)), F.upper(F.col(motif))
    return F.when(F.length(m) > 0, ((F.length(s) - F.length(F.replace(s, m, F.lit("")))) / F.length(m)).cast("int"))


def allele_purity(seq, motif) -> Column:
    """1 - edit distance to the pure repeat of the same length / length; NULL for an empty sequence or motif."""
    s, m = F.upper(F.col(seq)), F.upper(F.col(motif))
    n = F.length(s)
    pure = F.substring(F.repeat(m, F.ceil(n / F.length(m)).cast("int")), F.lit(1), n)
    return F.when((n > 0) & (F.length(m) > 0), 1 - distance(s, pure) / n)


def repeat_alleles(sites: DataFrame, key) -> DataFrame:
    """Per ALT (``allele``, from 1; 0 is REF) of repeat sites (``ref, alts, motif``): motif count, longest pure run and purity.

    These stand beside the allele counts of sites with several ALTs; symbolic alleles have none.
    """
    key = list(key)
    x = sites.select(*key, "motif", F.posexplode(F.concat(F.array("ref"), "alts")).alias("allele", "_seq"))
    plain = lambda v: F.when(~F.col("_seq").startswith("<"), v)
    return x.select(*key, "allele", plain(motif_count("_seq", "motif")).alias("mc"), plain(longest_pure_run("_seq", "motif")).alias("lps"), plain(allele_purity("_seq", "motif")).alias("ap"))


def perfect_tandem_indel(df: DataFrame, min_copies: int = 3, min_total: int = 9, ref="ref", alt="alt") -> DataFrame:
    """Flag indels whose inserted or deleted sequence is a perfect repeat of one unit."""
    longer = F.when(F.length(alt) > F.length(ref), F.substr(alt, F.lit(2))).otherwise(F.substr(ref, F.lit(2)))
    hit = longer.rlike(r"^(.+?)\1{%d,}$" % (min_copies - 1)) & (F.length(longer) >= min_total)
    return df.withColumn("tandem_indel", F.coalesce((F.length(ref) != F.length(alt)) & hit, F.lit(False)))


def tr_allele_histograms(lps: DataFrame, samples: DataFrame) -> DataFrame:
    """Counts of allele values per locus x motif x population x sex from (locus, motif, sample, allele)."""
    return (lps.join(samples.select("sample", "population", "sex"), "sample")
            .groupBy("locus", "motif", "population", "sex", "allele").agg(F.count("*").alias("n")))
