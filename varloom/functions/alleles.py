"""Expressions over REF/ALT text, contig names and variant ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def shared_prefix_len(a: Column, b: Column) -> Column:
    """Number of leading characters two strings share."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y)
    first_diff = F.array_position(same, F.lit(False)).cast("int")
    shorter = F.least(F.length(a), F.length(b))
    return F.when(shorter == 0, 0).when((first_diff == 0) | (first_diff > shorter), shorter).otherwise(first_diff - 1)


def shared_suffix_len(a: Column, b: Column) -> Column:
    return shared_prefix_len(F.reverse(a), F.reverse(b))


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` mentions it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def trim_alleles(pos, ref, alt, order: str = "suffix_first", keep: int = 1) -> Column:
    """Struct(pos, ref, alt) with the shared ends removed; each allele keeps ``keep`` bases.

    ``order`` is ``suffix_first`` or ``prefix_first``; ``keep=0`` trims to empty.
    Only the removed prefix moves ``pos``.
    """
    if order not in ("suffix_first", "prefix_first"):
        raise ValueError(f"unknown trim order {order!r}")

    def removable(t, shared):
        room = F.least(F.length(t["ref"]), F.length(t["alt"])) - keep
        return F.greatest(F.least(shared(t["ref"], t["alt"]), room), F.lit(0))

    def part(t, n, front):
        def cut(x):
            return F.substr(x, n + 1) if front else F.substr(x, F.lit(1), F.length(x) - n)
        return F.struct((t["pos"] + (n if front else 0)).cast("int").alias("pos"), cut(t["ref"]).alias("ref"), cut(t["alt"]).alias("alt"))

    def step(t, front):
        return let(removable(t, shared_prefix_len if front else shared_suffix_len), lambda n: part(t, n, front))

    t0 = F.struct(c(pos).cast("int").alias("pos"), c(ref).alias("ref"), c(alt).alias("alt"))
    first = order == "prefix_first"
    return let(let(t0, lambda t: step(t, first)), lambda t: step(t, not first))


def contig_rank(chrom) -> Column:
    """1..22 then X, Y, M; other contigs after those (sort by name within the rank)."""
    bare = F.regexp_replace(c(chrom), "^chr", "")
    num = bare.try_cast("int")
    return (
        F.when(num.isNotNull(), num)
        .when(bare == "X", 23).when(bare == "Y", 24).when(bare.isin("M", "MT"), 25)
        .otherwise(1000).cast("int")
    )


def contig_sort(chrom) -> list[Column]:
    """Sort columns for contig order: rank, then embedded number, then name."""
    digits = F.regexp_extract(c(chrom), r"(\d+)", 1).try_cast("bigint")
    return [contig_rank(chrom), F.coalesce(digits, F.lit(0)), c(chrom)]


def size_similarity(a, b) -> Column:
    """min/max of two absolute lengths; NULL-safe 0 when either is 0."""
    x, y = F.abs(c(a)), F.abs(c(b))
    return F.when((x > 0) & (y > 0), F.least(x, y) / F.greatest(x, y)).otherwise(F.lit(0.0))


def overlap_bases(s1, e1, s2, e2) -> Column:
    return F.greatest(F.least(c(e1), c(e2)) - F.greatest(c(s1), c(s2)), F.lit(0))


def sequence_similarity(a, b) -> Column:
    """1 - edit distance / longer length, case-insensitive; one empty side is 0, both empty 1."""
    x, y = F.upper(c(a)), F.upper(c(b))
    lx, ly = F.length(x), F.length(y)
    return (
        F.when(x == y, F.lit(1.0))
        .when((lx == 0) | (ly == 0), F.lit(0.0))
        .otherwise(1.0 - F.levenshtein(x, y) / F.greatest(lx, ly))
    )


def sequence_score(a, b, at_least: float) -> Column:
    """``sequence_similarity`` where it is at least ``at_least``, else NULL: one edit distance, which stops at the largest
    that still suffices, and none where lengths alone rule it out."""
    x, y = F.upper(c(a)), F.upper(c(b))
    lx, ly = F.length(x), F.length(y)
    longer = F.greatest(lx, ly)
    most = F.floor(longer * (1.0 - at_least) + 1e-9).cast("int")
    far = F.call_function("levenshtein", x, y, most)
    return (
        F.when(x == y, F.lit(1.0))
        .when((lx == 0) | (ly == 0), F.lit(0.0) if at_least <= 0 else F.lit(None).cast("double"))
        .when(F.least(lx, ly) < longer * at_least - 1e-9, F.lit(None).cast("double"))
        .otherwise(F.when(far >= 0, 1.0 - far / longer))
    )


def sequence_similar(a, b, at_least: float) -> Column:
    """``sequence_similarity >= at_least``."""
    return sequence_score(a, b, at_least).isNotNull()


def id_base(vid) -> Column:
    """Id without a trailing ``_<digits>``."""
    return F.regexp_replace(c(vid), r"_\d+$", "")


def id_suffix(vid) -> Column:
    """Number after the last underscore, 0 when there is none."""
    return F.coalesce(F.regexp_extract(c(vid), r"_(\d+)$", 1).try_cast("int"), F.lit(0))


def region_parts(text) -> Column:
    """Struct(chrom, start, end) of ``chrom:start-end``; NULL fields where it does not parse."""
    t = c(text)
    pat = r"^([^:]+):(\d+)-(\d+)"

    def part(i):
        return F.nullif(F.regexp_extract(t, pat, i), F.lit(""))

    return F.struct(part(1).alias("chrom"), part(2).try_cast("int").alias("start"), part(3).try_cast("int").alias("end"))
