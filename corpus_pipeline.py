"""From raw documents to packed training sequences: language ID, line dedup, near copies, benchmark passages, packing.

Each stage takes the rows that the one before kept. The first four return the columns of ``documents``: rows that
language ID rejects go, later occurrences of repeated lines go, one document of each group of near copies stays, and documents
that hold a benchmark passage go. The last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varloom.llm import decontamination, language, lines, nearcopies, packing
from varloom.llm.tables import reachable, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return language.keep(docs, language.fit(docs.filter(language.fold() != 2)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reachable(spark)
    return nearcopies.keep_one(docs, size=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    reachable(spark)
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: A trained model takes part, so SQL cannot express the whole; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
