"""Bases of a reference by window, and haplotypes spelled out over it.

A reference is a table of blocks: ``chrom``, ``block``, ``bases``, where block b holds the 1-based positions
``b * size + 1`` to ``(b + 1) * size``. A window meets only the blocks it spans, by equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 1 << 14


def blocks_of(pieces: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks from pieces of sequence (``chrom``, ``start`` 1-based, ``bases``) that don't overlap."""
    at = F.expr(f"explode(sequence((start - 1) div {size}, (start + length(bases) - 2) div {size}))")
    p = pieces.filter(F.length("bases") > 0).select("chrom", F.col("start").cast("bigint").alias("start"), "bases").select("*", at.alias("block"))
    lo = F.greatest(F.col("start"), F.col("block") * size + 1)
    hi = F.least(F.col("start") + F.length("bases") - 1, (F.col("block") + 1) * size)
    cut = p.select("chrom", "block", F.struct(lo.alias("at"), F.substring("bases", (lo - F.col("start") + 1).cast("int"), (hi - lo + 1).cast("int")).alias("part")).alias("_p"))
    return cut.groupBy("chrom", "block").agg(F.array_join(F.array_sort(F.collect_list("_p")).getField("part"), "").alias("bases"))  # at most ``size`` bases


def with_bases(windows: DataFrame, reference: DataFrame, size: int = BLOCK, out: str = "bases") -> DataFrame:
    """Distinct windows (``chrom``, ``start``, ``end``: 1-based, both ends in) with their bases in upper case; N where the reference has none."""
    w = windows.select("chrom", "start", "end").distinct()
    spans = w.filter(F.col("start") <= F.col("end")).select("*", F.expr(f"explode(sequence((CAST(start AS BIGINT) - 1) div {size}, (CAST(end AS BIGINT) - 1) div {size}))").alias("block"))
    got = spans.join(reference.select("chrom", F.col("block").cast("bigint").alias("block"), "bases"), ["chrom", "block"], "left")
    lo = F.greatest(F.col("start"), F.col("block") * size + 1)
    n = (F.least(F.col("end"), (F.col("block") + 1) * size) - lo + 1).cast("int")
    part = F.rpad(F.substring(F.upper(F.coalesce("bases", F.lit(""))), (lo - F.col("block") * size).cast("int"), n), n, F.lit("N"))
    text = got.groupBy("chrom", "start", "end").agg(F.array_join(F.array_sort(F.collect_list(F.struct("block", part.alias("part")))).getField("part"), "").alias(out))
    return w.join(text, ["chrom", "start", "end"], "left").withColumn(out, F.coalesce(out, F.lit("")))


def spelled(calls: str, window: str, start: str, end: str) -> Column:
    """One haplotype over a window: calls in order with the reference between them, before and after.

    ``calls`` is an array of struct<start, end, seq> in order (1-based, both ends in), ``window`` the bases from ``start``
    to ``end``. A call that begins before the end of the last one loses as many bases from its front;
    one that has none left is passed over.
    """
    cut = "CAST(greatest(acc.last - c.start + 1, 0) AS INT)"
    gap = f"substring({window}, CAST(acc.last - {start} + 2 AS INT), CAST(c.start + {cut} - 1 - acc.last AS INT))"
    step = (f"named_struct('last', IF(length(c.seq) > {cut}, CAST(c.end AS BIGINT), acc.last), "
            f"'text', IF(length(c.seq) > {cut}, concat(acc.text, {gap}, substring(c.seq, {cut} + 1)), acc.text))")
    rest = f"concat(acc.text, substring({window}, CAST(acc.last - {start} + 2 AS INT), CAST(greatest({end} - acc.last, 0) AS INT)))"
    return F.expr(f"aggregate({calls}, named_struct('last', CAST({start} - 1 AS BIGINT), 'text', ''), (acc, c) -> {step}, acc -> {rest})")


def distance(a: Column, b: Column) -> Column:
    """Exact edit distance; the cheap banded form decides where texts are close, which is nearly always."""
    near = lambda k: F.nullif(F.levenshtein(a, b, k), F.lit(-1))
    return F.when(a == b, F.lit(0)).otherwise(F.coalesce(near(16), near(256), F.levenshtein(a, b)))
