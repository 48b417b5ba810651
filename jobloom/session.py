"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", memory: str = "12g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks.  On a cluster, use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("jobloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names.

    A temporary folder stands in only on a local master, where driver and executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current and (not named or named.rstrip("/") in current):
        return named or current
    if not named and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    named = named or tempfile.mkdtemp(prefix="jobloom-checkpoint-")
    spark.sparkContext.setCheckpointDir(named)
    return named


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through the checkpoint folder, so that a lost executor replays from files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
