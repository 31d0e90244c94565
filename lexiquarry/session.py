"""Session helpers shared by queries, bench and command line."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when it is run from a checkout."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset a local folder is made if all runs in one process; a cluster needs one that is set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexiquarry-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again, so that it is computed once."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, if its files make fewer splits than that: for what costs far more than to move its rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.isStreaming or df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def local_session(app: str, cpus: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config(map=conf)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
