"""Session settings and lineage cuts shared by the jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Parquet files of keys and short texts hold about an eighth of what their rows take once read and widened by derived columns.
COMPRESSION = "8.0"


def whole_sizes(spark: SparkSession) -> None:
    """Let Spark judge tables by what their rows take, not by their compressed files, unless the user has said how.

    Otherwise a million rows in a file of 10 MB pass for small, and joins send them whole through the driver.
    """
    name = "spark.sql.sources.fileCompressionFactor"
    if spark.conf.get(name) == "1.0":
        spark.conf.set(name, COMPRESSION)


def get_spark(app: str = "varloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; on a cluster the master comes from spark-submit."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, as Spark uses it.

    Where it is unset, a single machine gets a temporary one; on a cluster executors would each write to their
    own disks and later reads fail, so that is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not named and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="varloom-ckpt-"))
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path beside the checkpoints, in the same shared storage."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a Parquet table in the shared storage and read from there: for rows read more than once that are smaller as columns than as a checkpoint."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
