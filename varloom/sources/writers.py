"""Sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.alleles import contig_sort
from ..operators.positions import number_rows


def _dot(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("."))


def vcf_header(samples: Column) -> Column:
    """The column-header line for an array of sample names."""
    fixed = "#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split()
    return F.concat_ws("\t", F.lit("\t".join(fixed)), F.array_join(samples, "\t"))


def vcf_body(sites: DataFrame, info: list[str], format_keys: list[str] | None = None, genotypes: str | None = None) -> DataFrame:
    """One text line per site with its place, for ``write_vcf_text``; see ``vcf_lines_of``."""
    return vcf_lines_of(sites, info, format_keys, genotypes, ["chrom", "pos"])


def vcf_lines_of(sites: DataFrame, info: list[str], format_keys: list[str] | None, genotypes: str | None, beside: list[str]) -> DataFrame:
    """The columns ``beside`` and a text line per site. ``info`` columns become ``KEY=value`` (true flags just ``KEY``);
    ``genotypes`` is an array of already formatted call strings."""
    kinds = dict(sites.dtypes)
    parts = [F.when(F.col(k), F.lit(k)) if kinds[k] == "boolean" else F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in info]
    text = F.concat_ws(";", *parts) if parts else F.lit("")
    cols = [F.col("chrom"), F.col("pos").cast("string"), _dot(F.col("id")), F.col("ref"), F.coalesce(F.nullif(F.array_join("alts", ","), F.lit("")), F.lit(".")),
            _dot(F.col("qual")), F.coalesce(F.nullif(F.array_join("filters", ";"), F.lit("")), F.lit(".")), F.coalesce(F.nullif(text, F.lit("")), F.lit("."))]
    if genotypes:
        cols += [F.lit(":".join(format_keys or ["GT"])), F.array_join(genotypes, "\t")]
    return sites.select(*beside, F.concat_ws("\t", *cols).alias("value"))


def write_vcf_text(body: DataFrame, path: str, partitions: int | None = None, compression: str = "gzip") -> None:
    """Sorted body lines as text shards: the range partitioning makes shard order the file order.
    The header is a separate small file the caller owns."""
    keys = [*contig_sort("chrom"), F.col("pos")]
    d = body.repartitionByRange(partitions, *keys) if partitions else body.repartitionByRange(*keys)
    d.sortWithinPartitions(*keys).select("value").write.mode("overwrite").option("compression", compression).text(path)


def write_annotation_tsv(df: DataFrame, path: str) -> None:
    """NULL is written as ``.``."""
    df.write.mode("overwrite").csv(path, sep="\t", nullValue=".", emptyValue="")


def write_tsv_parquet(df: DataFrame, path: str) -> bool:
    """Parquet copy of a table; an empty table is skipped. Says whether it wrote."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_site_table(df: DataFrame, path: str, bin_size: int = 10_000_000) -> None:
    """Parquet laid out by contig and position range, so region reads prune folders and row groups."""
    d = df.withColumn("region_bin", F.floor(F.col("pos") / bin_size).cast("int"))
    d.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos").write.mode("overwrite").partitionBy("chrom", "region_bin").parquet(path)


def write_per_sample(calls: DataFrame, path: str, salts: int = 4) -> None:
    """One folder a sample, of at most ``salts`` files: a sample's rows are dealt to that many tasks."""
    salt = F.pmod(F.xxhash64(*calls.columns), F.lit(salts))
    calls.repartition("sample", salt).write.mode("overwrite").partitionBy("sample").parquet(path)


def in_shards(df: DataFrame, records: int, ties: tuple[str, ...] = ("id",)) -> DataFrame:
    """Rows with ``shard``: runs of exactly ``records`` rows (the last may be shorter) in order of contig, ``pos`` and ``ties``.

    Rows are numbered within a contig stretch by stretch; contigs are shifted by the counts of those before, one row a contig.
    """
    numbered = number_rows(df, ["chrom"], ["pos", *ties], "_rank", "_of", chunk=1 << 14)
    sizes = df.groupBy("chrom").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy(*contig_sort("chrom"), "chrom").rowsBetween(W.unboundedPreceding, -1))
    x = numbered.join(sizes.select("chrom", F.coalesce(before, F.lit(0)).alias("_before")), "chrom")
    return x.withColumn("_place", F.col("_before") + F.col("_rank") - 1).withColumn("shard", F.floor(F.col("_place") / records)).drop("_rank", "_of", "_before")


def shard_manifest(sharded: DataFrame) -> DataFrame:
    """One row a shard: its number of rows, first and last place."""
    at = lambda f: f(F.struct("chrom", "pos"), F.col("_place"))
    m = sharded.groupBy("shard").agg(F.count("*").alias("rows"), at(F.min_by).alias("f"), at(F.max_by).alias("l"))
    return m.select("shard", "rows", F.col("f.chrom").alias("first_chrom"), F.col("f.pos").alias("first_pos"), F.col("l.chrom").alias("last_chrom"), F.col("l.pos").alias("last_pos"))


def shard_by_records(df: DataFrame, path: str, records: int, ties: tuple[str, ...] = ("id",)) -> DataFrame:
    """One folder a shard of exactly ``records`` rows in order; the manifest, read from what was written."""
    x = in_shards(df, records, ties)
    x.repartition("shard").sortWithinPartitions("shard", "_place").write.mode("overwrite").partitionBy("shard").parquet(path)
    return shard_manifest(df.sparkSession.read.parquet(path))
