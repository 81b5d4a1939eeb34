"""Session defaults and the shared folder used by sinks and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_DEFAULTS = {
    # Overflows and bad casts are errors; the typed load and exact sums rely on it.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even when the step after the join could have
    # reused the join's partitioning; one extra shuffle beats one endless task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators are designed around."""
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = "file:" + tempfile.mkdtemp(prefix="cohortry-")
    context.setCheckpointDir(root)
    return root


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared root; nothing is ever overwritten in it."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from what was written.

    A Parquet table survives lost executors like a reliable checkpoint does; it
    is also compressed, read column by column, and of known size to the planner.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "checkpoint")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def session_context(spark: SparkSession) -> DataFrame:
    """Who runs the session and where; Spark knows no roles or warehouses."""
    return spark.sql(
        "SELECT current_user() AS whoami, current_catalog() AS catalog, "
        "current_schema() AS working_in, version() AS engine"
    )
