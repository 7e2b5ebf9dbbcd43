"""Running values along a coordinate and point-in-interval joins.

Everything interval-like in this package rests on two shapes that stay flat
under skew, because rows are summed per position *before* they are ordered:

* ``running`` - prefix sums/maxima along a contig. Input has one row per
  position, so a window over one ``BIN``-sized stretch holds at most ``BIN``
  rows however many variants share a position; stretches are chained by a
  second window over one row per stretch.
* ``cover nodes`` - an interval is written as a few aligned blocks of size
  4^k that tile it exactly, and a point looks up the one block it falls in at
  each block size in use. Every match is a true containment: no candidate pair
  is built and thrown away, and no pair occurs twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BIN = 1 << 14
RADIX_BITS = 2
MAX_LEVEL = 15  # 4^15 > 10^9 bases


def _bin(pos: str, size: int) -> Column:
    return F.floor(F.col(pos) / F.lit(size))


def running(df: DataFrame, pos: str, by: list[str], sums=(), maxes=(), mins=(), reverse: bool = False,
            following: str | None = None, bin_size: int = BIN) -> DataFrame:
    """Add ``run_<c>`` for each column: inclusive sum/max/min over positions up to this one.

    ``df`` has one row per ``(by, pos)``. ``reverse`` runs from the far end.
    ``following`` names a column for the next position (forward runs only).
    """
    fns = {**{x: F.sum for x in sums}, **{x: F.max for x in maxes}, **{x: F.min for x in mins}}
    d = df.withColumn("_bin", _bin(pos, bin_size))
    per_bin = d.groupBy(*by, "_bin").agg(F.min(pos).alias("_first"), *[fn(x).alias(f"_b_{x}") for x, fn in fns.items()])
    order = F.col("_bin").desc() if reverse else F.col("_bin")
    chain = W.partitionBy(*by).orderBy(order)
    before = chain.rowsBetween(W.unboundedPreceding, -1)
    carried = [fn(f"_b_{x}").over(before).alias(f"_c_{x}") for x, fn in fns.items()]
    if following:
        carried.append(F.lead("_first").over(chain).alias("_next_bin"))
    carry = per_bin.select(*by, "_bin", *carried)
    within = (W.partitionBy(*by, "_bin").orderBy(F.col(pos).desc() if reverse else F.col(pos))
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    out = d.join(carry, [*by, "_bin"])
    for x in sums:
        out = out.withColumn(f"run_{x}", F.coalesce(F.sum(x).over(within), F.lit(0)) + F.coalesce(f"_c_{x}", F.lit(0)))
    for x in maxes:
        out = out.withColumn(f"run_{x}", F.greatest(F.max(x).over(within), f"_c_{x}"))
    for x in mins:
        out = out.withColumn(f"run_{x}", F.least(F.min(x).over(within), f"_c_{x}"))
    if following:
        here = F.lead(pos).over(W.partitionBy(*by, "_bin").orderBy(pos))
        out = out.withColumn(following, F.coalesce(here, "_next_bin"))
    return out.drop("_bin", "_next_bin", *[f"_c_{x}" for x in fns])


def next_pos(df: DataFrame, pos: str, by: list[str], out: str = "next_pos", bin_size: int = BIN) -> DataFrame:
    """Add the following position of the same ``by`` group (one row per position in)."""
    d = df.withColumn("_bin", _bin(pos, bin_size))
    firsts = d.groupBy(*by, "_bin").agg(F.min(pos).alias("_first"))
    nxt = firsts.select(*by, "_bin", F.lead("_first").over(W.partitionBy(*by).orderBy("_bin")).alias("_next_bin"))
    here = F.lead(pos).over(W.partitionBy(*by, "_bin").orderBy(pos))
    return d.join(nxt, [*by, "_bin"]).withColumn(out, F.coalesce(here, "_next_bin")).drop("_bin", "_next_bin")


def at_positions(points: DataFrame, events: DataFrame, pos: str, by: list[str], sums=(), maxes=(), mins=(),
                 reverse: bool = False) -> DataFrame:
    """Running event values at every distinct point position (inclusive).

    Returns one row per ``(by, pos)`` of ``points`` with ``run_*`` columns.
    """
    vals = [*sums, *maxes, *mins]
    types = dict(events.dtypes)
    p = points.select(*by, pos).distinct().select(
        *by, pos, *[F.lit(None).cast(types[v]).alias(v) for v in vals], F.lit(True).alias("_asked"))
    e = events.select(*by, pos, *vals, F.lit(False).alias("_asked"))
    agg = [F.sum(v).alias(v) for v in sums] + [F.max(v).alias(v) for v in maxes] + [F.min(v).alias(v) for v in mins]
    per_pos = p.unionByName(e).groupBy(*by, pos).agg(*agg, F.max("_asked").alias("_asked"))
    out = running(per_pos, pos, by, sums, maxes, mins, reverse)
    return out.filter("_asked").select(*by, pos, *[f"run_{v}" for v in vals])


# ---------------------------------------------------------------- cover nodes

def cover_nodes(start: str, end: str) -> Column:
    """array<struct<lv,nd>> of aligned blocks tiling ``[start, end)`` exactly.

    At each level the blocks left over by the next wider level are taken; shifts divide
    by the block size, rounding the start up and the end down.
    """
    k = RADIX_BITS
    s, e = f"CAST(`{start}` AS BIGINT)", f"CAST(`{end}` AS BIGINT)"
    lo, hi = f"shiftright({s} + shiftleft(1L, lv * {k}) - 1, lv * {k})", f"shiftright({e}, lv * {k})"
    up = f"(lv + 1) * {k}"
    wide_lo, wide_hi = f"shiftright({s} + shiftleft(1L, {up}) - 1, {up})", f"shiftright({e}, {up})"

    def run(a, b):
        return f"IF({a} < {b}, sequence({a}, {b} - 1), CAST(array() AS ARRAY<BIGINT>))"

    nodes = (f"IF({wide_lo} < {wide_hi}, concat({run(lo, f'shiftleft({wide_lo}, {k})')}, {run(f'shiftleft({wide_hi}, {k})', hi)}), {run(lo, hi)})")
    top = f"least((length(bin({e} - {s})) - 1) div {k}, {MAX_LEVEL})"  # bit length: exact at powers of the radix
    levels = f"IF({e} > {s}, sequence(0, CAST({top} AS INT)), CAST(array() AS ARRAY<INT>))"
    return F.expr(f"flatten(transform({levels}, lv -> transform({nodes}, nd -> named_struct('lv', lv, 'nd', nd))))")


def with_nodes(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("_n", F.explode(cover_nodes(start, end))).selectExpr("* except (_n)", "_n.lv AS _lv", "_n.nd AS _nd")


def with_lookups(points: DataFrame, pos: str, nodes: DataFrame, by: list[str]) -> DataFrame:
    """One row per point and block size that occurs in ``nodes``."""
    # A scalar: one array of at most MAX_LEVEL + 1 numbers for the whole table.
    levels = nodes.agg(F.collect_set("_lv").alias("_lvs")).scalar()
    p = points.select("*", F.explode(levels).alias("_lv"))
    return p.selectExpr("*", f"shiftright(CAST(`{pos}` AS BIGINT), _lv * {RADIX_BITS}) AS _nd")


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(x).alias(prefix + x) for x in df.columns])


def point_in_interval(points: DataFrame, intervals: DataFrame, pos: str, start: str, end: str,
                      by: list[str], least_bits: int = 0) -> DataFrame:
    """Pairs with ``start <= pos < end`` in the same ``by`` group.

    ``points`` and ``intervals`` share only the ``by`` columns. ``least_bits`` makes 2^bits positions the smallest block: an
    interval inside one is one row and a point of short intervals one look-up, but the block's points are compared with it. For
    groups that hold few rows at a place, such as the calls of one haplotype.
    """
    if not least_bits:
        nodes = with_nodes(intervals, start, end)
        asked = with_lookups(points, pos, nodes, by)
        return asked.join(nodes, [*by, "_lv", "_nd"]).drop("_lv", "_nd")
    nodes = intervals.withColumns({"_lo": F.shiftright(F.col(start).cast("bigint"), least_bits), "_hi": F.shiftright(F.col(end).cast("bigint") - 1, least_bits) + 1})
    one = F.array(F.struct(F.lit(0).alias("lv"), F.col("_lo").alias("nd")))
    nodes = nodes.withColumn("_n", F.explode(F.when(F.col("_hi") - F.col("_lo") == 1, one).otherwise(cover_nodes("_lo", "_hi"))))
    nodes = nodes.selectExpr("* except (_n, _lo, _hi)", "_n.lv AS _lv", "_n.nd AS _nd")
    asked = with_lookups(points.withColumn("_at", F.shiftright(F.col(pos).cast("bigint"), least_bits)), "_at", nodes, by)
    return asked.join(nodes, [*by, "_lv", "_nd"]).filter((F.col(start) <= F.col(pos)) & (F.col(pos) < F.col(end))).drop("_at", "_lv", "_nd")


def overlap_pairs(a: DataFrame, b: DataFrame, a_iv=("start", "end"), b_iv=("start", "end"),
                  by=("chrom",), prefix: str = "b_") -> DataFrame:
    """All pairs of half-open intervals sharing a base; ``b`` columns get ``prefix``.

    Each pair is found once: either ``a`` starts inside ``b``, or ``b`` starts
    strictly inside ``a``.
    """
    by = list(by)
    bp = prefixed(b, prefix)
    for x in by:
        bp = bp.withColumnRenamed(prefix + x, x)
    bs, be = prefix + b_iv[0], prefix + b_iv[1]
    a_in_b = point_in_interval(a, bp, a_iv[0], bs, be, by).filter(F.col(a_iv[0]) < F.col(a_iv[1]))
    inner = a.withColumn("_after", F.col(a_iv[0]) + 1)
    b_in_a = point_in_interval(bp.filter(F.col(bs) < F.col(be)), inner, bs, "_after", a_iv[1], by).drop("_after")
    return a_in_b.unionByName(b_in_a)


def stab_max(points: DataFrame, intervals: DataFrame, pos: str, start: str, end: str, value: str,
             by: list[str]) -> DataFrame:
    """For each distinct point: the largest ``value`` among intervals covering it (``top``).

    Values are maximised per block before the look-up, so copies and hot
    regions never multiply.
    """
    nodes = with_nodes(intervals.select(*by, start, end, value), start, end)
    best = nodes.groupBy(*by, "_lv", "_nd").agg(F.max(value).alias("_best"))
    asked = with_lookups(points.select(*by, pos).distinct(), pos, best, by)
    return (asked.join(best, [*by, "_lv", "_nd"]).groupBy(*by, pos).agg(F.max("_best").alias("top")))


def number_rows(df: DataFrame, key: list[str], order: str | list[str], out: str, count: str | None = None,
                chunk: int = 1 << 20) -> DataFrame:
    """1-based rank of each row within ``key`` by the unique integer ``order`` (or columns that start with an integer).

    Rows are ranked inside ``(key, order div chunk)``, which can hold at most
    ``chunk`` values of the integer, and shifted by the counts of earlier chunks; a key owning
    most of the table is therefore spread over many tasks.
    """
    order = [order] if isinstance(order, str) else list(order)
    d = df.withColumn("_ch", F.expr(f"CAST(`{order[0]}` AS BIGINT) DIV {chunk}"))
    per = d.groupBy(*key, "_ch").agg(F.count("*").alias("_n"))
    w = W.partitionBy(*key).orderBy("_ch")
    shift = per.select(*key, "_ch",
                       F.coalesce(F.sum("_n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_s"),
                       F.sum("_n").over(W.partitionBy(*key)).alias("_t"))
    nul = [F.col("d." + k).eqNullSafe(F.col("s." + k)) for k in [*key, "_ch"]]
    rank = F.row_number().over(W.partitionBy(*key, "_ch").orderBy(*order))
    cond = reduce(lambda x, y: x & y, nul)
    ranked = d.withColumn("_r", rank).alias("d").join(shift.alias("s"), cond)
    cols = [F.col("d." + x) for x in df.columns] + [(F.col("_r") + F.col("_s")).cast("bigint").alias(out)]
    if count:
        cols.append(F.col("_t").cast("bigint").alias(count))
    return ranked.select(*cols)
