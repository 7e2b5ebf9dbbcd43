"""Expressions over one call: ``gt`` is array<int> with NULL for a missing allele."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .alleles import c


def n_alt(gt) -> Column:
    return F.size(F.filter(c(gt), lambda a: a > 0))


def n_copies(gt, allele) -> Column:
    return F.size(F.filter(c(gt), lambda a: a == c(allele) if isinstance(allele, Column) else a == allele))


def has_null(gt) -> Column:
    return F.coalesce(F.exists(c(gt), lambda a: a.isNull()), F.lit(True))


def all_null(gt) -> Column:
    """True for a call without any called allele."""
    return F.coalesce(F.forall(c(gt), lambda a: a.isNull()), F.lit(True))


def is_carrier(gt) -> Column:
    return F.coalesce(F.exists(c(gt), lambda a: F.coalesce(a > 0, F.lit(False))), F.lit(False))


def is_het(gt) -> Column:
    """At least two called alleles that differ."""
    called = F.filter(c(gt), lambda a: a.isNotNull())
    return F.coalesce((F.size(called) >= 2) & (F.size(F.array_distinct(called)) > 1), F.lit(False))


def is_full_diploid(gt) -> Column:
    return (F.size(c(gt)) == 2) & ~has_null(gt)


def sort_missing_first(gt) -> Column:
    """Missing alleles to the left, then ascending; used for unphased calls."""
    return F.array_sort(
        c(gt),
        lambda x, y: F.when(x.isNull() & y.isNull(), 0).when(x.isNull(), -1).when(y.isNull(), 1)
        .when(x < y, -1).when(x > y, 1).otherwise(0),
    )


def sort_missing_last(gt) -> Column:
    return F.array_sort(c(gt))


def gt_text(gt, phased) -> Column:
    alleles = F.transform(c(gt), lambda a: F.coalesce(a.cast("string"), F.lit(".")))
    return F.when(c(phased), F.array_join(alleles, "|")).otherwise(F.array_join(alleles, "/"))


def pl_from_ad(ref_reads, alt_reads, means=(0.05, 0.5, 0.95), priors=None) -> Column:
    """Phred-scaled binomial likelihoods of 0/1/2 alt copies, best scaled to 0.

    With two ``means`` this is the haploid form. ``priors`` multiply the
    likelihoods. No reads give all zeros.
    """
    r, a = c(ref_reads).cast("double"), c(alt_reads).cast("double")
    ll = []
    for i, m in enumerate(means):
        x = a * F.log10(F.lit(m)) + r * F.log10(F.lit(1.0 - m))
        ll.append(x + F.log10(F.lit(priors[i])) if priors else x)
    best = F.greatest(*ll)
    pls = F.array(*[F.bround(-10 * (x - best), 0).cast("int") for x in ll])
    return F.when(r + a == 0, F.array(*[F.lit(0)] * len(means))).otherwise(pls)


def gq_from_pl(pl, cap: int = 99) -> Column:
    """Second smallest likelihood, at most ``cap``."""
    return F.least(F.element_at(F.array_sort(c(pl)), 2), F.lit(cap))
