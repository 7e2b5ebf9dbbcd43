"""Text and JSON sources as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions.alleles import region_parts
from ..operators.positions import running
from ..operators.sequences import BLOCK, blocks_of


def _null_dot(c: Column) -> Column:
    return F.when(c != ".", c)


def _plain(uri: Column) -> Column:
    """One spelling of a file's address (``file:///x`` and ``file:/x`` are the same)."""
    return F.regexp_replace(uri, "^([A-Za-z0-9]+):/+", "$1:/")


def _files(spark: SparkSession, path) -> list[tuple[str, int]]:
    """The files behind ``path`` with their rank: as listed, and by name within a folder or pattern."""
    out: dict[str, int] = {}
    for p in [path] if isinstance(path, str) else path:
        for f in sorted(spark.read.text(p).inputFiles()):
            out.setdefault(f, len(out))
    return list(out.items())


def vcf_lines(spark: SparkSession, path) -> DataFrame:
    """Raw lines with ``file_no`` and ``file_pos``: line numbers that run through the files in order, without gaps.

    ``path`` is a path, a pattern or a list of them. Tasks read files in any order and cut plain text into blocks
    (a gzip file is one block), so lines are numbered inside their block and shifted by the lines of earlier
    blocks: one row per block is ordered, however many lines there are.
    """
    at = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    raw = spark.read.text(path).select("value", _plain(at[0]).alias("_file"), at[1].alias("_block"), F.monotonically_increasing_id().alias("_row"))
    ranks = spark.createDataFrame(_files(spark, path), "_file string, file_no int").withColumn("_file", _plain(F.col("_file")))
    blocks = raw.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n")).join(ranks, "_file")
    before = F.sum("_n").over(W.orderBy("file_no", "_block").rowsBetween(W.unboundedPreceding, -1))
    blocks = blocks.select("_file", "_block", "file_no", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return raw.join(blocks, ["_file", "_block"]).select("value", "file_no", (F.col("_before") + F.col("_row") - F.col("_first")).alias("file_pos"))


def vcf_samples(lines: DataFrame) -> DataFrame:
    """(file_no, samples) from each file's own column-header line."""
    head = lines.filter(F.col("value").startswith("#CHROM")).groupBy("file_no").agg(F.min_by("value", "file_pos").alias("_h"))
    names = F.split("_h", "\t")
    return head.select("file_no", F.slice(names, 10, F.greatest(F.size(names) - 9, F.lit(1))).alias("samples"))


def read_vcf(spark: SparkSession, path, samples: list[str] | None = None) -> DataFrame:
    """Sites with genotypes, each file's calls named by its own header unless ``samples`` is given.

    Columns: chrom, pos, id, ref, alts, qual, filters, info (map, flags map to NULL), format,
    genotypes (array<struct<sample, fields map>>), file_pos. Use ``calls_of`` for typed calls.
    A line with another number of calls than its header names fails the job.
    """
    lines = vcf_lines(spark, path)
    if samples is not None:
        return parse_vcf(lines, samples)
    return parse_vcf(lines.join(vcf_samples(lines), "file_no", "left"))


def parse_vcf(lines: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Sites with genotypes from text lines (``value``, ``file_pos``, and ``samples`` unless named); see ``read_vcf``."""
    who = F.coalesce(F.col("samples"), F.array().cast("array<string>")) if names is None else F.array(*[F.lit(s) for s in names]).cast("array<string>")
    v = lines.filter(~F.col("value").startswith("#")).withColumns({"_f": F.split("value", "\t"), "_who": who})
    f = lambda i: F.get("_f", F.lit(i))
    odd = F.raise_error(F.concat(F.lit("calls do not match the header at "), f(0), F.lit(":"), f(1))).cast("array<string>")
    calls = F.slice("_f", 10, F.greatest(F.size("_f") - 9, F.lit(1)))
    d = v.select(
        f(0).alias("chrom"), f(1).cast("int").alias("pos"), _null_dot(f(2)).alias("id"), f(3).alias("ref"),
        F.when(f(4) == ".", F.array().cast("array<string>")).otherwise(F.split(f(4), ",")).alias("alts"),
        f(5).try_cast("double").alias("qual"), F.when(f(6) == ".", F.array().cast("array<string>")).otherwise(F.split(f(6), ";")).alias("filters"),
        F.when(f(7) != ".", F.str_to_map(f(7), F.lit(";"), F.lit("="))).alias("info"), F.split(f(8), ":").alias("format"),
        F.when(F.size("_f") <= 9, F.array().cast("array<string>")).when(F.size("_f") - 9 == F.size("_who"), calls).otherwise(odd).alias("_g"), "_who", "file_pos")
    geno = F.zip_with("_who", "_g", lambda s, g: F.struct(s.alias("sample"), F.map_from_arrays(
        F.slice(F.col("format"), 1, F.size(F.split(g, ":"))), F.split(g, ":")).alias("fields")))
    none = F.array().cast("array<struct<sample:string,fields:map<string,string>>>")
    return d.withColumn("genotypes", F.when(F.size("_g") > 0, geno).otherwise(none)).drop("_g", "_who")


def _ints(c: Column) -> Column:
    return F.transform(F.split(c, ","), lambda v: v.try_cast("int"))


def calls_of(vcf: DataFrame) -> DataFrame:
    """Long typed calls: gt (array with NULL for a missing allele), phased, ad, pl, dp, gq, ps."""
    x = vcf.withColumn("_g", F.explode("genotypes")).withColumn("_m", F.col("_g.fields"))
    m = lambda k: F.try_element_at("_m", F.lit(k))
    alleles = F.transform(F.split(m("GT"), r"[/|]"), lambda a: a.try_cast("int"))
    return x.select("chrom", "pos", "id", "ref", "alts", "file_pos", F.col("_g.sample").alias("sample"), alleles.alias("gt"),
                    F.coalesce(m("GT").contains("|"), F.lit(False)).alias("phased"), _ints(m("AD")).alias("ad"), _ints(m("PL")).alias("pl"),
                    m("DP").try_cast("int").alias("dp"), m("GQ").try_cast("int").alias("gq"), m("PS").try_cast("bigint").alias("ps"))


def read_fasta(spark: SparkSession, path, block: int = BLOCK) -> DataFrame:
    """A reference as blocks (chrom, block, bases; see ``operators.sequences``). Contigs are named by the first word of their header.

    Lines are numbered as by ``vcf_lines``; a running sum of their lengths gives each line its place in its contig, so a contig of any length is read by many tasks,
    and may go on in the next file.
    """
    lines = vcf_lines(spark, path)
    lines = lines.select(F.lit(0).alias("_all"), "file_pos", F.trim("value").alias("v")).withColumn("_head", F.col("v").startswith(">"))
    lines = lines.select("*", F.when(F.col("_head"), 0).otherwise(F.length("v")).cast("bigint").alias("n"),
                         F.when(F.col("_head"), F.struct("file_pos", F.element_at(F.split(F.expr("substring(v, 2)"), r"\s"), 1).alias("chrom"))).alias("contig"))
    run = running(lines, "file_pos", ["_all"], sums=["n"], maxes=["contig"])
    first = run.filter("_head").select(F.col("file_pos").alias("_at"), F.col("run_n").alias("_before"))
    p = run.filter("NOT _head AND n > 0").withColumn("_at", F.col("run_contig.file_pos")).join(first, "_at")
    return blocks_of(p.select(F.col("run_contig.chrom").alias("chrom"), (F.col("run_n") - F.col("n") - F.col("_before") + 1).alias("start"), F.col("v").alias("bases")), block)


KEY5 = ["chrom", "pos", "ref", "alt", "id"]


def read_annotation_tsv(spark: SparkSession, paths, columns: list[str]) -> DataFrame:
    """Five key columns plus the named ones; ``.`` is NULL (also in ids)."""
    names = [*KEY5, *columns]
    d = spark.read.csv(paths, sep="\t", nullValue=".", comment="#", schema=", ".join(f"`{n}` string" for n in names))
    return d.withColumn("pos", F.col("pos").cast("int"))


def read_bed(spark: SparkSession, paths, extra: dict[str, str] | None = None) -> DataFrame:
    """chrom, start, end and further typed columns, e.g. ``{"depth": "int"}`` for depth runs."""
    schema = "chrom string, start int, end int" + "".join(f", `{k}` {v}" for k, v in (extra or {}).items())
    return spark.read.csv(paths, sep="\t", comment="#", schema=schema)


def read_tr_catalog_json(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """(locus_id, chrom, start, end, motif); entries without an id or a readable region are skipped.

    ``multiline`` files hold one array (a task each); with it false, files of an entry a line are split between tasks.
    """
    schema = "LocusId string, MainReferenceRegion string, RepeatUnit string"
    return tr_loci(spark.read.json(path, schema=schema, multiLine=multiline))


def tr_loci(entries: DataFrame) -> DataFrame:
    """Catalog entries (LocusId, MainReferenceRegion, RepeatUnit) as intervals."""
    j = entries.withColumn("_r", region_parts("MainReferenceRegion"))
    return j.filter("LocusId is not null and _r.start is not null").select(
        F.col("LocusId").alias("locus_id"), F.col("_r.chrom").alias("chrom"), F.col("_r.start").alias("start"), F.col("_r.end").alias("end"), F.col("RepeatUnit").alias("motif"))


def read_tr_catalog_bed(spark: SparkSession, path) -> DataFrame:
    """(trid, chrom, start, end, attrs) from ``KEY=value;`` attributes."""
    return tr_attributes(read_bed(spark, path, {"attributes": "string"}))


def tr_attributes(bed: DataFrame) -> DataFrame:
    d = bed.withColumn("attrs", F.str_to_map("attributes", F.lit(";"), F.lit("=")))
    return d.select(F.col("attrs")["ID"].alias("trid"), "chrom", "start", "end", "attrs")


def read_ped(spark: SparkSession, path) -> DataFrame:
    return spark.read.csv(path, sep="\t", comment="#", schema="family string, sample string, father string, mother string, sex string, phenotype string")


def read_ancestry(spark: SparkSession, path) -> DataFrame:
    return spark.read.csv(path, sep="\t", comment="#", schema="sample string, population string")
