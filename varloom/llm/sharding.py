"""Sharding by sampled splitters.

Records are ordered by (hash of the text, doc_id, row). A size-weighted sample of keys gives
quantile boundaries, the boundaries give many narrow ranges, and ranges that turn out overfull
get boundaries from a sample of their own. Ranges are then measured exactly, so that every
record's place in the total order of bytes is known, and the shard is that place times the
number of shards: sizes are equal to within one record (or one small group).

Equal texts stand next to each other. A group of at most ``1 / WHOLE`` of a shard stays in one
shard; a larger one is cut at shard boundaries, however much of the table it holds.

What reaches the driver is bounded: ``DRAWS`` keys a range and at most ``MOST_RANGES`` ranges.
Only keys and sizes are shuffled (whole records too with ``carry``).

Nulls: a null text has no bytes and the checksum of none; null ids sort first. Repeated rows are
told apart by their place in the input. Empty tables give no rows. Other columns are not read,
but for ``carry``, where they are kept inside one struct and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from .tables import settled

OVERHEAD = 16
ROWS_A_RANGE = 50_000
RANGES_A_SHARD = 16
MOST_RANGES = 1 << 16
DRAWS = 8
WHOLE = 200
KEY = np.dtype([("h", "<i8"), ("d", "<i8"), ("t", "<i8")])


def assign(docs: DataFrame, shards: int = 40, carry: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row (and ``record`` with ``carry``)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("d"), F.monotonically_increasing_id().alias("t"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")] if carry else []),
    )
    keyed = settled(keyed)
    n, total = keyed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(1, min(MOST_RANGES, n // 4, max(RANGES_A_SHARD * shards, n // ROWS_A_RANGE)))
    share = max(1, total // ranges)
    splitters = _boundaries(keyed, share, np.zeros(0, KEY))
    for _ in range(3):
        ranged = _in_ranges(keyed, splitters)
        sizes = ranged.groupBy("rng").agg(F.sum("size").alias("b"), F.count("*").alias("n")).toPandas().sort_values("rng")
        over = sizes[(sizes.b > 4 * share) & (sizes.n > 16)].rng.tolist()
        more = _boundaries(ranged.filter(F.col("rng").isin(over)), share // 2, splitters) if over else splitters
        if len(more) == len(splitters):
            break
        splitters = more
    b, c = sizes.b.to_numpy(np.int64), sizes.n.to_numpy(np.int64)
    before = docs.sparkSession.createDataFrame(
        list(zip(sizes.rng.astype(int).tolist(), (np.cumsum(b) - b).tolist(), (np.cumsum(c) - c).tolist())), "rng int, bytes0 bigint, rows0 bigint")
    order = W.partitionBy("rng").orderBy("h", "d", "t")
    group = W.partitionBy("rng", "h")
    placed = (
        ranged.withColumns({"b0": F.sum("size").over(order) - F.col("size"), "r0": F.row_number().over(order) - 1})
        .withColumns({"gb": F.sum("size").over(group), "g0": F.min("b0").over(group)})
        .join(before, "rng")
    )
    whole = F.col("gb") * (shards * WHOLE) <= total
    twice = 2 * (F.col("bytes0") + F.when(whole, F.col("g0")).otherwise(F.col("b0"))) + F.when(whole, F.col("gb")).otherwise(F.col("size"))
    placed = placed.withColumns({
        "shard": F.least(F.lit(shards - 1), F.floor(twice * shards / (2 * max(1, total)))).cast("int"), "rank": F.col("rows0") + F.col("r0"),
    })
    placed = settled(placed.select("doc_id", "size", "text_crc32", "shard", "rank", *(["record"] if carry else [])))
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("first")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *(["record"] if carry else []))


def write_shards(docs: DataFrame, path: str, shards: int = 40) -> None:
    """Whole records, one folder a shard, in slot order."""
    out = assign(docs, shards, carry=True).select("shard", "slot", "record.*")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("errorifexists").parquet(path)


def _boundaries(keyed: DataFrame, share: int, old: np.ndarray) -> np.ndarray:
    """``old`` and the weighted quantiles of a size-weighted sample of ``keyed``, one for each ``share`` bytes.

    A key whose text was drawn twice may cut through its group; else the cut is before the group.
    """
    p = F.col("size") * (DRAWS / max(1, share))
    u = F.pmod(F.xxhash64("h", "d", "t", F.lit(len(old))), F.lit(1 << 30)) / (1 << 30)
    got = keyed.filter(u < p).select("h", "d", "t", F.greatest(p, F.lit(1.0)).alias("w")).toPandas().sort_values(["h", "d", "t"])
    if not len(got):
        return old
    at = np.floor(np.cumsum(got.w.to_numpy()) / DRAWS)
    cut = got[np.append(False, at[1:] != at[:-1])]
    twice = cut.h.isin(got.h[got.h.duplicated()].unique()).to_numpy()
    low = -(1 << 63)
    new = np.zeros(len(cut), KEY)
    new["h"], new["d"], new["t"] = cut.h, np.where(twice, cut.d, low), np.where(twice, cut.t, low)
    return np.unique(np.concatenate([old, new]))


def _in_ranges(keyed: DataFrame, splitters: np.ndarray) -> DataFrame:
    hs = np.ascontiguousarray(splitters["h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column("h").to_numpy()
            left, right = np.searchsorted(hs, h, "left"), np.searchsorted(hs, h, "right")
            tie = np.flatnonzero(left != right)
            if len(tie):
                k = np.zeros(len(tie), KEY)
                k["h"], k["d"], k["t"] = h[tie], b.column("d").to_numpy()[tie], b.column("t").to_numpy()[tie]
                left[tie] = np.searchsorted(splitters, k, "right")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(left.astype(np.int32))], names=[*b.schema.names, "rng"])

    return keyed.mapInArrow(run, T.StructType([*keyed.schema.fields, T.StructField("rng", T.IntegerType())]))
