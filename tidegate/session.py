"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Spark settings the jobs rely on; anything a cluster sets itself wins.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", *, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidegate")
    settings = {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                "spark.driver.memory": "12g", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder: the session's own, or a fresh one in local mode.

    On a cluster the folder must be shared storage that outlives executors, so
    nothing is invented there: an unset folder is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="spark-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage so later rounds restart from it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def share(df: DataFrame) -> DataFrame:
    """Keep a frame several branches of one job read; spills to disk, recomputes if lost."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder on the storage all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared folder: unlike a checkpoint it carries no constraints into later plans.

    For loops whose rounds derive each column from the round before, where the
    constraints the optimiser infers would grow with every round. Names and ids
    of digits halve under zstd.
    """
    folder = scratch_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
