"""Variant-shaped views over the given tables.

Each view is one SQL text that Spark and the checking database both run, so the
two sides start from the same rows. Every view covers its whole base tables.
"""

from __future__ import annotations

import re
from collections.abc import Container

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch, whole_sizes

BASE = ("region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations").split()

VIEWS: dict[str, str] = {}

VIEWS["bases"] = """
SELECT p_partkey AS vid,
  CASE WHEN p_partkey % 24 = 22 THEN 'chrX' WHEN p_partkey % 24 = 23 THEN 'chrY'
       ELSE concat('chr', CAST(p_partkey % 24 + 1 AS STRING)) END AS chrom,
  CAST(floor(p_partkey / 24.0) AS INT) * 40 + p_size AS pos,
  p_size, p_name, p_brand, p_type, p_retailprice,
  CAST(substr(p_brand, 7) AS INT) AS brand_no,
  translate(md5(concat(p_name, CAST(p_partkey AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq
FROM part
"""

VIEWS["sites"] = """
SELECT vid, concat('V', CAST(vid AS STRING)) AS id, chrom, pos, vid AS file_pos, p_size AS size,
  CASE p_type WHEN 'STANDARD' THEN substr(seq, 1, 1) WHEN 'ECONOMY' THEN substr(concat(seq, seq), 1, p_size + 1)
    WHEN 'SMALL' THEN repeat(substr(seq, 2, brand_no % 6 + 1), p_size % 10 + 2) ELSE substr(seq, 1, 1) END AS ref,
  CASE p_type WHEN 'STANDARD' THEN translate(substr(seq, 1, 1), 'ACGT', 'CGTA') WHEN 'ECONOMY' THEN substr(seq, 1, 1)
    WHEN 'SMALL' THEN repeat(substr(seq, 2, brand_no % 6 + 1), p_size % 7 + 1) ELSE substr(concat(seq, seq), 1, p_size + 1) END AS alt,
  CASE p_type WHEN 'STANDARD' THEN 'snv' WHEN 'ECONOMY' THEN 'del' WHEN 'MEDIUM' THEN 'ins' WHEN 'PROMO' THEN 'dup'
    WHEN 'SMALL' THEN 'trv' ELSE CASE brand_no % 3 WHEN 0 THEN 'alu_ins' WHEN 1 THEN 'sva_ins' ELSE 'line_ins' END END AS allele_type,
  CASE p_type WHEN 'STANDARD' THEN 0 WHEN 'ECONOMY' THEN -(p_size * 20) ELSE p_size * 20 END AS allele_length,
  substr(seq, 2, brand_no % 6 + 1) AS motif,
  p_brand AS source, brand_no, p_name AS name, CAST(round(p_retailprice * 10) AS INT) - 9000 AS qual,
  CASE WHEN p_size < 5 THEN 'LowQual' WHEN p_size > 45 THEN 'LowQual;Large' ELSE 'PASS' END AS filter_text
FROM bases
"""

# Two call sets of the same lines: what each makes of the lines of a part and a customer.
CALL_SETS = {"genotypes": """CASE WHEN min(l_linenumber) = 7 THEN NULL ELSE max(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END) END AS a0,
  CASE WHEN min(l_linenumber) >= 6 AND max(l_quantity) > 40 THEN NULL
       ELSE max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) END AS a1,
  CAST(round(max(l_quantity)) AS INT) AS ad_ref, CAST(round(min(l_extendedprice) / 2500) AS INT) AS ad_alt,
  CAST(round(max(l_discount) * 1000) AS INT) AS gq, max(l_suppkey) AS ps, bool_or(l_tax >= 0.04) AS phased""",
             "genotypes2": """CASE WHEN max(l_linenumber) = 1 THEN NULL ELSE max(CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END) END AS a0,
  max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS a1,
  CAST(round(min(l_quantity)) AS INT) AS ad_ref, CAST(round(max(l_extendedprice) / 3000) AS INT) AS ad_alt,
  CAST(round(min(l_discount) * 1000) AS INT) AS gq, min(l_suppkey) AS ps, bool_or(l_tax < 0.06) AS phased"""}
LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
CALLS_OF = f"SELECT l_partkey AS vid, o_custkey AS sample_id,\n  {{0}}\nFROM {LINES} GROUP BY l_partkey, o_custkey\n"

for _name, _columns in CALL_SETS.items():
    VIEWS[_name] = "\n" + CALLS_OF.format(_columns)

# Sites of one to four ALTs: which ALT a call carries follows from the sample.
VIEWS["multi"] = """
SELECT vid, sample_id, CAST(vid % 4 AS INT) + 1 AS n_alts, a0 * (1 + CAST(sample_id % (vid % 4 + 1) AS INT)) AS a0,
  a1 * (1 + CAST(floor(sample_id / 3.0) AS INT) % (CAST(vid % 4 AS INT) + 1)) AS a1, ad_ref, ad_alt, gq, ps, phased
FROM genotypes
"""

VIEWS["samples"] = """
SELECT c_custkey AS sample_id, r_name AS population,
  CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex, n_name AS cohort, c_mktsegment AS family
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

# Reference sequence in blocks of 64 bases: block b of a contig holds positions 64 b + 1 to 64 b + 64.
VIEWS["reference"] = """
SELECT chrom, CAST(floor(vid / 24.0) AS INT) AS block, concat(seq, reverse(seq)) AS bases FROM bases
"""

# A second call set over all parts: same places, shifted by brand, some alleles changed.
VIEWS["truth"] = """
SELECT vid, concat('T', CAST(vid AS STRING)) AS id, chrom, pos + (brand_no % 5) AS pos, vid AS file_pos, size, ref,
  CASE WHEN brand_no % 4 = 3 THEN concat(alt, 'A') ELSE alt END AS alt, allele_type,
  CASE WHEN brand_no % 7 = 6 THEN allele_length * 3 ELSE allele_length + CAST(sign(allele_length) AS INT) * (brand_no % 3) END AS allele_length,
  motif, brand_no, filter_text, brand_no * 2 AS ac, 200 + size AS an
FROM sites
"""

VIEWS["annotated"] = """
SELECT vid, id, CASE WHEN allele_type LIKE '%_ins' THEN 'ins' WHEN allele_type = 'dup' AND brand_no % 2 = 0 THEN 'ins' ELSE allele_type END AS allele_type,
  CASE WHEN allele_type LIKE '%_ins' THEN allele_type WHEN allele_type = 'dup' THEN 'tandem_dup'
       WHEN allele_type = 'ins' AND brand_no % 4 = 1 THEN 'dup_interspersed' WHEN allele_type = 'ins' AND brand_no % 4 = 2 THEN 'numt' END AS allele_subtype,
  allele_length, ref, alt, qual / 1000.0 AS af, qual % 7 AS ac, size < 12 AS tr_enveloped,
  CASE brand_no % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'RM' WHEN 2 THEN 'SD' WHEN 3 THEN 'SR' ELSE 'other' END AS region,
  CASE WHEN size % 4 = 0 THEN 'A|stop_gained&intron_variant|g' WHEN size % 4 = 1 THEN 'A|intron_variant|g,A|missense_variant|h'
       WHEN size % 4 = 2 THEN 'A|3_prime_UTR_variant|' END AS vep,
  CASE WHEN brand_no % 3 = 0 THEN name END AS dbsnp_id, CASE WHEN size % 2 = 0 THEN name END AS catalog_id,
  CASE WHEN brand_no % 6 = 1 THEN name END AS lof_gene, CASE WHEN size % 5 = 3 THEN motif END AS utr_gene, file_pos
FROM sites
"""

VIEWS["features"] = """
SELECT s_suppkey AS fid, CASE WHEN s_suppkey % 24 = 22 THEN 'chrX' WHEN s_suppkey % 24 = 23 THEN 'chrY'
    ELSE concat('chr', CAST(s_suppkey % 24 + 1 AS STRING)) END AS chrom,
  CAST(floor(s_suppkey / 24.0) AS INT) * 400 + s_nationkey * 8 AS st,
  CAST(floor(s_suppkey / 24.0) AS INT) * 400 + s_nationkey * 8 + 150 + s_nationkey * 10 AS en,
  CASE s_nationkey % 3 WHEN 0 THEN 'SR' WHEN 1 THEN 'SD' ELSE 'RM' END AS cls, s_name AS name
FROM supplier
"""

VIEWS["depth_runs"] = """
SELECT user_id AS sample_id, 'chr1' AS chrom, CAST(en - 50 - event_len AS INT) AS st, CAST(en - event_len AS INT) AS en, depth
FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) * 50 AS en, 0 AS event_len,
        CAST(floor(value) AS INT) AS depth FROM events) r
"""

VIEWS["ages"] = """
SELECT c_custkey AS sample_id, CAST(DATE '1940-01-01' + CAST(c_custkey % 22000 AS INT) AS DATE) AS dob FROM customer
"""


# Complementary error function of a value >= 0 on the checking side: the series of erf by logarithms of its terms.
ERFC = ("CASE WHEN {x} > 6 THEN 0.0 WHEN {x} <= 0 THEN 1.0 ELSE 1 - 2 / sqrt(pi()) * list_sum(list_transform(generate_series(0, 160), "
        "lambda i: exp((2 * i + 1) * ln({x}) + i * ln(2) - {x} * {x} - lgamma(2 * i + 2) + i * ln(2) + lgamma(i + 1)))) END")


def requires(name: str, kept: Container[str] = ()) -> list[str]:
    """Views ``name`` needs, in order, itself last; those ``kept`` need none."""
    out: list[str] = []
    for word in re.findall(r"\b\w+\b", "" if name in kept else VIEWS[name]):
        if word in VIEWS and word != name:
            for r in requires(word, kept):
                if r not in out:
                    out.append(r)
    return out + [name]


def with_views(body: str, kept: dict[str, str] | None = None) -> str:
    """``body`` preceded by the views it mentions, as defined or by the text in ``kept``."""
    names, kept = [], kept or {}
    for word in re.findall(r"\b\w+\b", body):
        if word in VIEWS:
            for r in requires(word, kept):
                if r not in names:
                    names.append(r)
    ctes = [f"{n} AS ({kept.get(n, VIEWS[n]).strip()})" for n in names]
    body = body.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ",\n".join(ctes) + ("," if ctes else "") + body[14:]
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ("," if ctes else "") + body[4:]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


class Tables:
    """Lazy access to base tables and views for one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.kept: dict[str, str] = {}
        whole_sizes(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in VIEWS:
            return self.sql(f"SELECT * FROM {name}")
        raise AttributeError(name)

    def sql(self, body: str) -> DataFrame:
        """Run SQL over base tables and views (parquet paths inlined, so nothing is registered)."""
        return self.spark.sql(self._inlined(with_views(body, self.kept)))

    def _inlined(self, text: str) -> str:
        for b in BASE:
            text = re.sub(rf"\b(FROM|JOIN)\s+{b}\b", rf"\1 parquet.`{self.folder}/{b}.parquet`", text)
        return text

    def keep_calls(self, *names: str, columns: tuple[str, ...] = ()) -> Tables:
        """Write these call sets to one table, made by one join and one grouping; from here on the views read that table.

        For queries that read calls more than once. Every call is written, with ``columns`` only where a query names those that it reads. Lines are dealt
        by site, grouped where they lie and written in buckets by site, so that joins with sites send no calls again.
        """
        path = scratch(self.spark, "calls")
        table, buckets = f"calls_{path[-32:]}", int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        sets = CALLS_OF.format(",\n  ".join(CALL_SETS[n] for n in names)).replace(LINES, f"(SELECT /*+ REPARTITION({buckets}, l_partkey) */ * FROM {LINES})")
        made = self.spark.sql(self._inlined(sets))
        own = made.columns[2:2 + (len(made.columns) - 2) // len(names)]  # of a call set; all have the same
        made = made.toDF("vid", "sample_id", *[f"{n}_{x}" for n in names for x in own])
        made = made.select("vid", "sample_id", *[F.struct(*[F.col(f"{n}_{x}").alias(x) for x in columns or own]).alias(n) for n in names])
        made.write.format("parquet").option("path", path).bucketBy(buckets, "vid").sortBy("vid").saveAsTable(table)
        self.spark.table(table).createTempView(f"kept_{table}")
        self.spark.sql(f"DROP TABLE {table}")  # the catalog's entry; files and view stay
        self.kept |= {n: f"SELECT vid, sample_id, {n}.* FROM kept_{table}" for n in names}
        return self
