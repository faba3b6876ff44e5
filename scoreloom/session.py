"""Session construction and checkpoint placement."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "scoreloom", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the plans rely on.

    Cluster sizing (executors, memory, shuffle partitions) is left to the submitter; only semantics
    (UTC) and adaptive execution are fixed here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per expression
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the one the cluster names, or, on a local master alone, a temporary one."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="scoreloom-ckpt-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def fresh_checkpoint_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder."""
    token = os.urandom(6).hex()
    return f"{checkpoint_root(spark)}/{name}-{token}"


def reliable(df):
    """Cut the lineage of a frame that several later jobs read, in the shared checkpoint folder."""
    spark = df.sparkSession
    root = checkpoint_root(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def stored(df, name):
    """Write a frame that several later jobs read below the checkpoint folder, and read it again."""
    spark = df.sparkSession
    path = fresh_checkpoint_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
