"""Read depth, coverage bins and sample x bin matrices (long form; pivot at the sink)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import stats
from ..functions.alleles import contig_sort
from ..session import cut_lineage
from .positions import number_rows, point_in_interval, running

RUN = ["sample", "chrom"]


def depth_runs(reads: DataFrame) -> DataFrame:
    """Run-length depth per sample from alignment intervals (sample, chrom, start, end).

    One run per change of depth, zero-depth gaps between reads included.
    """
    ends = F.array(F.struct(F.col("start").alias("p"), F.lit(1).alias("d")), F.struct(F.col("end").alias("p"), F.lit(-1).alias("d")))
    ev = (reads.filter(F.col("start") < F.col("end")).select(*RUN, F.explode(ends).alias("_x"))
          .groupBy(*RUN, F.col("_x.p").alias("start")).agg(F.sum("_x.d").alias("_d")).filter("_d <> 0"))
    r = running(ev, "start", RUN, sums=["_d"], following="end")
    return r.filter("end is not null").select(*RUN, "start", "end", F.col("run__d").alias("depth"))


def runs_by_bin(runs: DataFrame, bin_size: int) -> DataFrame:
    """Runs cut at bin boundaries: ``bin_start`` and ``overlap``."""
    first = F.floor(F.col("start") / bin_size)
    last = F.floor((F.col("end") - 1) / bin_size)
    x = runs.filter(F.col("start") < F.col("end")).withColumn("_b", F.explode(F.sequence(first, last)))
    x = x.withColumn("bin_start", (F.col("_b") * bin_size).cast("int"))
    ov = F.least("end", F.col("bin_start") + bin_size) - F.greatest("start", "bin_start")
    return x.withColumn("overlap", ov).drop("_b")


def bin_median_depth(runs: DataFrame, bin_size: int, one_based: bool = False) -> DataFrame:
    """Median per-base depth of each fully covered bin, truncated to an integer.

    Bases are never listed: depths of a bin are weighted by their lengths. An even bin averages
    its two middle bases. The ranking window holds at most ``bin_size`` rows.
    """
    x = runs_by_bin(runs.withColumn("depth", F.col("depth").cast("int")), bin_size)
    w = x.groupBy(*RUN, "bin_start", "depth").agg(F.sum("overlap").alias("n"))
    win = W.partitionBy(*RUN, "bin_start").orderBy("depth")
    w = w.withColumns({"cum": F.sum("n").over(win.rowsBetween(W.unboundedPreceding, 0)), "tot": F.sum("n").over(W.partitionBy(*RUN, "bin_start"))})
    lo_at, hi_at = (bin_size + 1) // 2, bin_size // 2 + 1
    m = w.filter(F.col("tot") == bin_size).groupBy(*RUN, "bin_start").agg(
        F.min(F.when(F.col("cum") >= lo_at, F.col("depth"))).alias("_lo"), F.min(F.when(F.col("cum") >= hi_at, F.col("depth"))).alias("_hi"))
    shift = 1 if one_based else 0
    return m.select(*RUN, (F.col("bin_start") + shift).alias("start"), (F.col("bin_start") + bin_size).alias("end"),
                    ((F.col("_lo") + F.col("_hi")) / 2).cast("int").alias("depth"))


COVER_BIN = 4096  # bases of a stretch
COVER_CELLS = 1 << 20  # blocks times depths that a task holds at once


def cohort_coverage(runs: DataFrame, n_samples: int | Column, bin_size: int, thresholds=(1, 5, 10, 15, 20, 25, 30)) -> DataFrame:
    """Coverage over blocks on which no sample's depth changes, also cut at bin boundaries.

    Per block (1-based start): mean, upper median ``sorted[n // 2]``, total and the share of
    samples strictly above each threshold. Blocks stop where the first sample ends.

    No run meets a block: counts by depth change at runs' ends, and are summed along the contig, by stretches of ``COVER_BIN`` bases.
    """
    ends = runs.groupBy("chrom", "sample").agg(F.min("start").alias("s"), F.max("end").alias("e")).groupBy("chrom").agg(
        (F.floor(F.min("s") / bin_size) * bin_size).cast("int").alias("_from"), F.min("e").alias("_to"))
    cuts = runs.select("chrom", F.explode(F.array("start", "end")).alias("start")).distinct()
    grid = ends.select("chrom", F.explode(F.sequence(F.col("_from"), F.col("_to") - 1, F.lit(bin_size))).alias("start"))
    last = ends.select("chrom", F.col("_to").alias("start"))
    pos = cuts.unionByName(grid).unionByName(last).distinct().join(ends, "chrom").filter("start >= _from and start <= _to").select("chrom", "start")
    blocks = running(pos.withColumn("_z", F.lit(0)), "start", ["chrom"], sums=["_z"], following="end").filter("end is not null")
    at = lambda x: F.floor(F.col(x) / COVER_BIN).cast("bigint")
    # How many samples gain or lose a depth at a position: one row per position and depth, however many samples.
    change = runs.select("chrom", "depth", F.explode(F.array(F.struct(F.col("start").alias("p"), F.lit(1).alias("d")), F.struct(F.col("end").alias("p"), F.lit(-1).alias("d")))).alias("_x"))
    change = change.groupBy("chrom", F.col("_x.p").alias("start"), "depth").agg(F.sum("_x.d").alias("d")).filter("d <> 0").withColumn("bin", at("start"))
    per = change.groupBy("chrom", "depth", "bin").agg(F.sum("d").alias("d"))
    w = W.partitionBy("chrom", "depth").orderBy("bin")
    held = per.select("chrom", "depth", "bin", F.sum("d").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("d"), F.lead("bin").over(w).alias("_next"))
    held = held.filter("d <> 0 AND _next IS NOT NULL").select("chrom", F.explode(F.expr("sequence(bin + 1, _next)")).alias("bin"), "depth", "d")
    none = F.lit(None).cast("int")
    rows = held.select("chrom", "bin", none.alias("start"), none.alias("end"), F.col("depth").cast("int").alias("depth"), "d", none.alias("all")).unionByName(
        change.select("chrom", "bin", "start", none.alias("end"), F.col("depth").cast("int").alias("depth"), "d", none.alias("all"))).unionByName(
        blocks.select("chrom", at("start").alias("bin"), "start", "end", none.alias("depth"), F.lit(None).cast("bigint").alias("d"), F.lit(n_samples).cast("int").alias("all")))
    names = [f"_t{t}" for t in thresholds]

    def stretch(key, x):
        """Counts by depth at each block's start, for the blocks of one stretch."""
        b = x[x["end"].notna()].sort_values("start")
        e = x[x["d"].notna()]
        starts = b["start"].to_numpy(np.int64)
        values, col = np.unique(e["depth"].to_numpy(np.int64), return_inverse=True)
        if not len(values):
            values, col = np.zeros(1, np.int64), np.zeros(0, np.int64)
        row = np.where(e["start"].isna(), 0, np.searchsorted(starts, e["start"].fillna(0).to_numpy(np.int64), "left"))
        change, samples = e["d"].to_numpy(np.int64), b["all"].to_numpy(np.int64)
        order = np.argsort(row, kind="stable")
        row, col, change = row[order], col[order], change[order]
        out: dict = {k: np.zeros(len(starts), np.int64) for k in ("total", "_n", *names, "median")}
        held = np.zeros(len(values), np.int64)  # counts by depth, carried from one run of blocks to the next
        step = max(1, COVER_CELLS // len(values))
        for lo in range(0, len(starts), step):
            hi = min(lo + step, len(starts))
            at = slice(*np.searchsorted(row, [lo, hi]))
            n = np.zeros((hi - lo, len(values)), np.int64)
            np.add.at(n, (row[at] - lo, col[at]), change[at])
            n[0] += held
            n = np.cumsum(n, axis=0)
            held = n[-1]
            out["total"][lo:hi], out["_n"][lo:hi] = n @ values, n.sum(1)
            for name, t in zip(names, thresholds):
                out[name][lo:hi] = n[:, values > t].sum(1)
            s = samples[lo:hi]
            need = s // 2 - (s - n.sum(1)) + 1  # the middle one's place among the samples with a depth; the others count as 0
            out["median"][lo:hi] = np.where(need <= 0, 0, values[np.minimum((np.cumsum(n, axis=1) < need[:, None]).sum(1), len(values) - 1)])
        out |= {"chrom": key[0], "start": starts, "end": b["end"].to_numpy(np.int64), "all": samples}
        return pd.DataFrame(out)[["chrom", "start", "end", "total", "_n", *names, "median", "all"]]

    schema = "chrom string, start int, end int, total bigint, _n bigint, " + "".join(f"{x} bigint, " for x in names) + "median int, all int"
    agg = rows.groupBy("chrom", "bin").applyInPandas(stretch, schema).filter("_n > 0")
    share = lambda x: F.bround(F.col(x) / F.col("all"), 6)
    return agg.select("chrom", (F.col("start") + 1).alias("start"), "end", share("total").alias("mean"), "median", "total",
                      *[share(f"_t{t}").alias(f"over_{t}") for t in thresholds])


def ploidy_matrix(bins: DataFrame, size: int = 1_000_000) -> DataFrame:
    """Sums of small bins per large bin; large bins count from each contig's first row."""
    first = bins.groupBy("chrom").agg(F.min("start").alias("_first"))
    x = bins.join(first, "chrom")
    k = F.floor((F.col("start") - F.col("_first")) / size)
    return x.withColumn("start", (F.col("_first") + k * size).cast("int")).groupBy(*RUN, "start").agg(F.sum("depth").alias("depth"))


def to_wide_matrix(long: DataFrame, samples: list[str], keys=("chrom", "start", "end"), value: str = "depth", check: bool = True) -> DataFrame:
    """One column per named sample; unequal bin lists are an error when ``check`` is on."""
    wide = long.groupBy(*keys).pivot("sample", samples).agg(F.first(value))
    if check:
        gap = reduce(lambda a, b: a | b, [F.col(f"`{s}`").isNull() for s in samples])
        ok = F.when(gap, F.raise_error(F.lit("samples disagree on the bin list")).cast("boolean")).otherwise(F.lit(True))
        wide = wide.filter(ok)
    return wide


def full_bins(bins: DataFrame, bin_size: int) -> DataFrame:
    return bins.filter(F.col("end") - F.col("start") == bin_size)


def methylation_matrix(sites: DataFrame, samples: list[str]) -> DataFrame:
    """Scores of all samples side by side per (chrom, start, end); ``.`` where absent."""
    wide = sites.groupBy("chrom", "start", "end").pivot("sample", samples).agg(F.first("score"))
    return wide.select("chrom", "start", "end", *[F.coalesce(F.col(f"`{s}`").cast("string"), F.lit(".")).alias(s) for s in samples])


def median_coverage(bins: DataFrame) -> DataFrame:
    """Per sample: median over bins, median over non-zero bins, and 1.4826 x MAD of the latter."""
    med = bins.groupBy("sample").agg(F.percentile("depth", F.lit(0.5)).alias("median_all"),
                                     F.percentile(F.when(F.col("depth") > 0, F.col("depth")), F.lit(0.5)).alias("median_nonzero"))
    dev = bins.filter("depth > 0").join(med, "sample").groupBy("sample").agg(
        (1.4826 * F.percentile(F.abs(F.col("depth") - F.col("median_nonzero")), F.lit(0.5))).alias("mad_nonzero"))
    return med.join(dev, "sample", "left")


def median_by_bin(bins: DataFrame) -> DataFrame:
    return bins.groupBy("chrom", "start").agg(F.percentile("depth", F.lit(0.5)).alias("median"))


AUTOSOMES = [f"chr{i}" for i in range(1, 23)]


def copy_numbers(bins: DataFrame, low: float = 0.2, share: float = 0.8) -> DataFrame:
    """Contig copy numbers: bins scaled so a sample's autosomal median is 2, bins that are low in
    most samples dropped, then the median per contig."""
    auto = bins.filter(F.col("chrom").isin(AUTOSOMES)).groupBy("sample").agg(F.percentile("depth", F.lit(0.5)).alias("_m"))
    x = bins.join(auto, "sample").withColumn("cn", F.try_divide(2.0 * F.col("depth"), F.col("_m")))
    bad = x.groupBy("chrom", "start").agg((F.count_if(F.col("cn") <= low) / F.count("*")).alias("_low")).filter(F.col("_low") > share)
    x = x.join(bad.select("chrom", "start"), ["chrom", "start"], "left_anti")
    return x.groupBy("sample", "chrom").agg(F.percentile("cn", F.lit(0.5)).alias("cn"))


def ploidy_scores(cn: DataFrame) -> DataFrame:
    """Per sample and contig: z of the copy number over samples, tail p, Benjamini-Hochberg q, and the
    sex label from rounded X and Y copies. The windows hold one row per sample of a contig."""
    over = W.partitionBy("chrom")
    z = F.try_divide(F.col("cn") - F.avg("cn").over(over), F.stddev("cn").over(over))
    x = cn.withColumn("z", z).withColumn("p", stats.normal_sf(F.abs("z")) * 2)
    n = F.count("p").over(over)
    up = W.partitionBy("chrom").orderBy("p").rangeBetween(W.unboundedPreceding, W.currentRow)  # ties rank alike
    x = x.withColumn("_q", F.col("p") * n / F.count("p").over(up))
    x = x.withColumn("q", F.least(F.lit(1.0), F.min("_q").over(W.partitionBy("chrom").orderBy(F.col("p").desc()).rangeBetween(W.unboundedPreceding, W.currentRow))))
    return x.drop("_q").join(sex_labels(cn), "sample", "left")


def sex_labels(cn: DataFrame) -> DataFrame:
    xy = cn.groupBy("sample").agg(F.bround(F.max(F.when(F.col("chrom") == "chrX", F.col("cn")))).cast("int").alias("x"),
                                  F.bround(F.max(F.when(F.col("chrom") == "chrY", F.col("cn")))).cast("int").alias("y"))
    lab = (F.when((F.col("x") == 1) & (F.col("y") == 1), "MALE").when((F.col("x") == 2) & (F.col("y") == 0), "FEMALE")
           .when((F.col("x") == 1) & (F.col("y") == 0), "TURNER").when((F.col("x") == 2) & (F.col("y") == 1), "KLINEFELTER")
           .when((F.col("x") == 3) & (F.col("y") == 0), "TRIPLE X").when((F.col("x") == 1) & (F.col("y") == 2), "JACOBS").otherwise("OTHER"))
    return xy.select("sample", F.col("x").alias("x_copies"), F.col("y").alias("y_copies"), lab.alias("sex"))


BLOCK = 512  # samples compared with as many others in one task
CHUNK = 1024  # bins multiplied at once, about
RUN_OF = 64  # rows of a sample that stand together
SHARES = 64  # tasks at least, where there are as many chunks: few pairs of blocks are multiplied in several shares of the chunks
MOST_SAMPLES = 4096  # a samples x samples matrix on the driver: 128 MB of doubles


def _cells(bins: DataFrame, contigs=None) -> DataFrame:
    x = bins.filter(F.col("chrom").isin(list(contigs))) if contigs is not None else bins
    return x.groupBy("chrom", "bin", "sample").agg(F.sum("depth").cast("double").alias("v"))


def _moments(cells: DataFrame, samples: DataFrame, n: int) -> DataFrame:
    """``samples`` with mean and spread of each one's depths over all ``n`` bins (absent ones are 0)."""
    m = samples.join(cells.groupBy("sample").agg(F.sum("v").alias("_s"), F.sum(F.col("v") * F.col("v")).alias("_q")), "sample", "left").fillna(0.0, ["_s", "_q"])
    spread = F.sqrt(F.greatest((F.col("_q") - F.col("_s") * F.col("_s") / max(1, n)) / max(1, n - 1), F.lit(0.0)))
    return m.select(*samples.columns, (F.col("_s") / max(1, n)).alias("_m"), F.when(spread > 1e-12, spread).otherwise(0.0).alias("_d"))


def sample_correlations(bins: DataFrame, contigs=None) -> DataFrame:
    """(sample_a, sample_b, r) of every pair of samples: the correlation of their depths over all bins (``sample, chrom, bin, depth``; absent bins are 0).

    Samples are dealt into blocks and bins into chunks; a task multiplies two blocks chunk by chunk, so its memory is bounded however many samples and bins
    there are. Two blocks meet once and their rows are given both ways round, in runs of ``RUN_OF`` rows of a sample, first as ``sample_a``, then as
    ``sample_b``, so that a compressed column file holds each ``r`` once. The result itself has a row for each pair. ``contigs`` names those that count (all). A sample without variance
    correlates with none.
    """
    cells = cut_lineage(_cells(bins, contigs))
    samples = bins.select("sample").distinct()
    dealt = cut_lineage(samples.withColumn("_h", F.xxhash64("sample")))
    n = cells.select("chrom", "bin").distinct().count()
    blocks, chunks = max(1, -(-dealt.count() // BLOCK)), max(1, -(-n // CHUNK))
    shares = max(1, min(chunks, SHARES // (blocks * (blocks + 1) // 2)))
    dealt = dealt.withColumn("_o", F.pmod("_h", F.lit(blocks)))
    dealt = dealt.withColumn("_r", F.row_number().over(W.partitionBy("_o").orderBy("_h", "sample")) - 1)  # of a block
    places = cells.select("chrom", "bin").distinct().withColumn("_k", F.pmod(F.xxhash64("chrom", "bin"), F.lit(chunks)))
    places = places.withColumn("_at", F.row_number().over(W.partitionBy("_k").orderBy("chrom", "bin")) - 1)  # of a chunk
    own = cells.filter("v IS NOT NULL").join(places, ["chrom", "bin"]).groupBy("sample", "_k").agg(F.collect_list("_at").alias("_at"), F.collect_list("v").alias("_v"))
    rows = _moments(cells, dealt.select("sample", "_o", "_r"), n).withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))
    rows = rows.join(own, ["sample", "_k"], "left").withColumn("_s", F.pmod("_k", F.lit(shares)))
    a = rows.withColumns({"_i": F.col("_o"), "_j": F.explode(F.sequence(F.col("_o"), F.lit(blocks - 1).cast("bigint"))), "_left": F.lit(True)})
    b = rows.withColumns({"_i": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_o"))), "_j": F.col("_o"), "_left": F.lit(False)})
    by = ["_i", "_j", "_s"]
    kind = bins.schema["sample"].dataType.simpleString()

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bool, list] = {True: [], False: []}  # of each side: (sample, mean, spread), in the order of its rows
        top, chunk, parts, first, same = None, None, [], None, None

        def matrix(left: bool, width: int) -> np.ndarray:
            m = np.zeros((len(found[left]), width))
            for which, r, size, at, v in parts:
                use = which == left
                cell = np.repeat(use, size)
                m[np.repeat(r[use], size[use]), at[cell]] = v[cell]
            return m

        def multiplied() -> np.ndarray:
            width = max((int(p[3].max()) + 1 for p in parts if len(p[3])), default=1)
            more = matrix(True, width) @ matrix(False, width).T
            return more if top is None else top + more

        for b in batches:
            same = b["_i"][0].as_py() == b["_j"][0].as_py() if same is None else same
            k = b["_k"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(k)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                if chunk is not None and k[lo] != chunk:
                    top, parts = multiplied(), []
                chunk = int(k[lo])
                first = chunk if first is None else first
                x = b.slice(lo, hi - lo)
                left, r = x["_left"].to_numpy(zero_copy_only=False), x["_r"].to_numpy()
                if chunk == first:  # every sample has a row in every chunk, in the same order
                    for side, *of in zip(left, *(x[c].to_pylist() for c in ("sample", "_m", "_d"))):
                        found[side].append(of)
                size = pc.fill_null(pc.list_value_length(x["_at"]), 0).to_numpy(zero_copy_only=False)
                parts.append((left, r, size, *(x[c].flatten().to_numpy(zero_copy_only=False) for c in ("_at", "_v"))))
        top = multiplied()
        (an, am, ad), (bn, bm, bd) = (list(zip(*found[side])) for side in (True, False))
        if first == 0:
            top -= n * np.outer(am, bm)
        low = (n - 1) * np.outer(ad, bd)
        top = np.divide(top, low, out=np.zeros_like(top), where=low > 0)
        names = pa.array([*an, *bn], sample_type)
        for lo in range(0, len(bn), RUN_OF):
            r = top[:, lo:lo + RUN_OF]
            one = np.repeat(np.arange(len(an)), r.shape[1]).reshape(r.shape)
            two = np.broadcast_to(len(an) + np.arange(lo, lo + r.shape[1]), r.shape)
            if not same:
                one, two, r = np.hstack([one, two]), np.hstack([two, one]), np.hstack([r, r])
            yield pa.RecordBatch.from_arrays([names.take(pa.array(one.ravel())), names.take(pa.array(two.ravel())), pa.array(r.ravel())], names=["sample_a", "sample_b", "r"])

    sample_type = to_arrow_type(bins.schema["sample"].dataType)
    part = a.unionByName(b).drop("_o").repartition(*by).sortWithinPartitions(*by, "_k", "_left", "_r").groupBy(*by).applyInArrow(product, f"sample_a {kind}, sample_b {kind}, r double")
    if shares > 1:
        part = part.groupBy("sample_a", "sample_b").agg(F.sum("r").alias("r"))
    return part.withColumn("r", F.when(F.col("sample_a").eqNullSafe(F.col("sample_b")), 1.0).otherwise(F.col("r")))


def _cohort(bins: DataFrame) -> list:
    names = [r["sample"] for r in bins.select("sample").distinct().orderBy("sample").limit(MOST_SAMPLES + 1).collect()]
    if len(names) > MOST_SAMPLES:
        raise ValueError(f"more than {MOST_SAMPLES} samples: their correlations would exceed the driver's bound")
    return names


def correlations(bins: DataFrame, contigs=None) -> tuple[list, np.ndarray]:
    """Samples in order, and the correlation matrix of their depths over all bins, for up to ``MOST_SAMPLES`` samples; see ``sample_correlations`` for more.

    Each bin is one vector of the cohort's length; Spark sums the samples x samples products of bins, so what the driver
    gets is bounded by samples, however many bins there are. ``contigs`` names those that count (all). A sample without variance correlates with none.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation

    names = _cohort(bins)
    if not names:
        return [], np.zeros((0, 0))
    cells = _cells(bins, contigs).groupBy("chrom", "bin").agg(F.map_from_entries(F.collect_list(F.struct("sample", "v"))).alias("_m"))
    row = F.transform(F.array(*[F.lit(n) for n in names]), lambda n: F.coalesce(F.try_element_at("_m", n), F.lit(0.0)))
    vectors = cells.select(array_to_vector(row).alias("v"))
    if vectors.limit(2).count() < 2:
        return names, np.eye(len(names))
    m = Correlation.corr(vectors, "v").first()[0].toArray()
    m = np.where(np.isfinite(m), m, 0.0)
    np.fill_diagonal(m, 1.0)
    return names, m


def dosage_components(bins: DataFrame, components: int = 10, contigs=None) -> DataFrame:
    """(component, explained, sample, loading): leading principal components of the samples over centred and scaled bins.

    They are the eigenvectors of the samples' correlation matrix, largest entry positive; ``explained`` is the share of variance. Of more than
    ``MOST_SAMPLES`` samples that matrix is never made: the same vectors are the left ones of the singular value decomposition of the samples' scaled depths,
    a row a sample, which Spark keeps distributed; the driver gets ``components`` vectors as long as the number of bins.
    """
    if bins.select("sample").distinct().count() > MOST_SAMPLES:
        return _many_components(bins, components, contigs)
    names, m = correlations(bins, contigs)
    kind = bins.schema["sample"].dataType.simpleString()
    value, vector = np.linalg.eigh(m)
    rows = []
    for k in range(min(components, len(names))):
        v = vector[:, -1 - k]
        v = v * np.sign(v[np.abs(v).argmax()])
        rows += [(k + 1, float(value[-1 - k] / len(names)), n, float(x)) for n, x in zip(names, v)]
    return bins.sparkSession.createDataFrame(rows, f"component int, explained double, sample {kind}, loading double")


def _many_components(bins: DataFrame, components: int, contigs=None) -> DataFrame:
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.linalg.distributed import RowMatrix

    cells = cut_lineage(_cells(bins, contigs))
    samples = cut_lineage(bins.select("sample").distinct())
    places = cut_lineage(number_rows(cells.select("chrom", "bin").distinct(), ["chrom"], "bin", "_r"))
    before = places.groupBy("chrom").agg(F.count("*").alias("_n"))
    before = before.withColumn("_f", F.coalesce(F.sum("_n").over(W.orderBy("chrom").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # a row a contig
    n, total = places.count(), samples.count()
    places = places.join(before, "chrom").select("chrom", "bin", (F.col("_f") + F.col("_r") - 1).cast("int").alias("_at"))
    own = cells.join(places, ["chrom", "bin"]).groupBy("sample").agg(F.collect_list(F.struct("_at", "v")).alias("_c"))
    full = _moments(cells, samples, n).join(own, "sample").filter("_d > 0")

    def scaled(r):
        x = np.full(n, -r["_m"])
        for c in r["_c"]:
            x[c["_at"]] += c["v"]
        return x / r["_d"]

    found = RowMatrix(full.rdd.map(lambda r: Vectors.dense(scaled(r))), numCols=n).computeSVD(min(components, n))
    s, v = found.s.toArray(), found.V.toArray()
    kind = bins.schema["sample"].dataType.simpleString()
    places_of = [(k + 1, float(s[k] ** 2 / ((n - 1) * total))) for k in range(len(s))]
    loads = full.rdd.map(lambda r: (r["sample"], [float(x) for x in scaled(r) @ v / s])).toDF(f"sample {kind}, _l array<double>")
    x = samples.join(loads, "sample", "left").select("sample", F.posexplode(F.coalesce("_l", F.array(*[F.lit(0.0)] * len(s)))).alias("_k", "loading")).withColumn("component", F.col("_k") + 1)
    x = cut_lineage(x)
    sign = x.groupBy("component").agg(F.signum(F.max_by("loading", F.struct(F.abs("loading"), "sample"))).alias("_s"))
    shares = bins.sparkSession.createDataFrame(places_of, "component int, explained double")
    return x.join(sign, "component").join(shares, "component").select("component", "explained", "sample", (F.col("loading") * F.col("_s")).alias("loading"))


def dosage_batches(bins: DataFrame, batches: int, components: int = 10, seed: int = 1, least: int = 60, most: int = 150, contigs=None) -> DataFrame:
    """Sample batches by k-means over the leading components: sample, batch, its size, and whether that lies between ``least`` and ``most``."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    pcs = dosage_components(bins, components, contigs).groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("component", "loading"))).getField("loading").alias("_l"))
    pcs = pcs.select("sample", array_to_vector("_l").alias("pcs"))
    found = KMeans(k=batches, featuresCol="pcs", predictionCol="batch", seed=seed).fit(pcs).transform(pcs).select("sample", "batch")
    size = F.count("*").over(W.partitionBy("batch"))  # a cohort's samples
    return found.withColumn("size", size).withColumn("size_ok", F.col("size").between(least, most))


def filter_bins(bins: DataFrame, min_count: int = 5, low_share: float = 0.9, percentiles=(0.01, 0.99), extreme_share: float = 0.9) -> DataFrame:
    """Bins kept after dropping those low in most samples or extreme within most samples."""
    lim = bins.groupBy("sample").agg(F.percentile("depth", F.lit(percentiles[0])).alias("_lo"), F.percentile("depth", F.lit(percentiles[1])).alias("_hi"))
    x = bins.join(lim, "sample")
    agg = x.groupBy("chrom", "start").agg((F.count_if(F.col("depth") < min_count) / F.count("*")).alias("_l"),
                                          (F.count_if((F.col("depth") < F.col("_lo")) | (F.col("depth") > F.col("_hi"))) / F.count("*")).alias("_x"))
    return agg.filter((F.col("_l") < low_share) & (F.col("_x") < extreme_share)).select("chrom", "start")


def sample_event_qc(events: DataFrame, limit: int) -> DataFrame:
    return events.groupBy("sample").agg(F.count("*").alias("n_events")).withColumn(
        "qc", F.when(F.col("n_events") < limit, "PASS").otherwise("EXCESSIVE_NUMBER_OF_EVENTS"))


def depth_profile(runs: DataFrame, windows: DataFrame, samples: DataFrame) -> DataFrame:
    """One row per base and sample of each requested window (chrom, start, end); 0 where no run covers.

    Bases asked for, and bases that a run covers, are the bits of one number per block of 64 bases, so blocks are dealt and joined, not bases.
    """
    everyone = samples.agg(F.collect_set("sample")).scalar()  # cohort size
    spots = windows.select("chrom", F.explode(F.sequence("start", F.col("end") - 1)).alias("pos"))
    blocks = spots.groupBy("chrom", F.shiftright(F.col("pos").cast("bigint"), 6).alias("_b")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(pos & 63 AS INT))")).alias("_bits"))
    r = runs.select("chrom", F.col("start").cast("bigint").alias("_s"), F.col("end").cast("bigint").alias("_e"), "sample", "depth").filter("_s < _e")
    r = r.withColumns({"_first": F.shiftright("_s", 6), "_last": F.shiftright(F.col("_e") - 1, 6) + 1})
    lo, hi = "greatest(_s - _b * 64, 0L)", "least(_e - _b * 64, 64L)"
    own = f"_bits & shiftleft(shiftrightunsigned(-1L, CAST(64 - ({hi} - {lo}) AS INT)), CAST({lo} AS INT))"
    hit = point_in_interval(blocks, r, "_b", "_first", "_last", ["chrom"]).select("chrom", "_b", "sample", "depth", F.expr(own).alias("_own")).filter("_own <> 0")
    hit = hit.join(samples.select("sample").distinct(), "sample", "left_semi")
    covered = hit.groupBy("chrom", "_b", "sample").agg(F.bit_or("_own").alias("_c"))
    bare = blocks.withColumn("sample", F.explode(everyone)).join(covered, ["chrom", "_b", "sample"], "left").withColumn("_own", F.expr("_bits & ~coalesce(_c, 0L)"))
    bare = bare.filter("_own <> 0").select("chrom", "_b", "sample", F.lit(None).cast(r.schema["depth"].dataType).alias("depth"), "_own")
    bases = F.explode(F.expr("filter(sequence(0, 63), i -> shiftright(_own, i) & 1 = 1)"))
    out = hit.select(*bare.columns).unionByName(bare).withColumn("_i", bases)
    return out.select("chrom", (F.col("_b") * 64 + F.col("_i")).cast(spots.schema["pos"].dataType).alias("pos"), "sample", F.coalesce("depth", F.lit(0)).alias("depth"))


def concat_depth(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy(*contig_sort("chrom"), "start")
