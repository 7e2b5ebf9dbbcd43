"""Small helpers that several operators of this folder share."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage


def reachable(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it, whatever folder the driver runs in."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, so that later uses don't compute it again."""
    return cut_lineage(df)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, as a URI."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        settled(spark.range(0))
    at = sc.getCheckpointDir()
    return f"{at if ':/' in at else 'file://' + at}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder."""
    at = shared_folder(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


def bitmap(slots: DataFrame, slot: str, bits: int) -> np.ndarray:
    """The slots (below 2^bits) that occur, as packed bits. They are joined to words of 64 in Spark, so at most 2^(bits - 6) rows reach the driver."""
    words = slots.groupBy(F.expr(f"CAST({slot} AS INT) >> 6").alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST({slot} AS INT) & 63)")).alias("v")).toArrow()
    out = np.zeros(max(1, 1 << (bits - 6)), np.uint64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy().view(np.uint64)
    return np.packbits(np.unpackbits(out.astype("<u8").view(np.uint8), bitorder="little"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out
