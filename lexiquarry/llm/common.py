"""Shared folders, staging and Arrow helpers of the operators in this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.session import shared_root, ship, table

__all__ = ["drop", "fresh", "kept", "keyed", "prepare", "release", "shared_path", "slim_rows", "small", "stage", "table"]


#: Rows and bytes of an Arrow batch, where the session has Spark's own values: a worker holds a batch of texts at a time.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "500"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864", "2097152")}


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, so that a batch of long texts stays within a worker's memory. What the session sets stays."""
    ship(spark)
    for name, (default, value) in BATCH.items():
        if spark.conf.get(name).removesuffix("b") == default:
            spark.conf.set(name, value)


@contextmanager
def slim_rows(spark: SparkSession) -> Iterator[None]:
    """Larger Arrow batches for what is planned and run within: rows of a few numbers each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "20000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: a cut in lineage that outlives executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a few numbers or a digest each that a broadcast may hold.
BROADCAST_ROWS = 500_000


def small(df: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `most` rows; larger, its joins shuffle both sides."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= most else df


def drop(*frames: DataFrame) -> None:
    """Delete the files behind staged frames that nothing reads any more."""
    for df in frames:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)


#: What kept() keeps, one object at most.
_kept: dict[tuple[Any, ...], Any] = {}


def kept(build: Callable[..., Any], *args: Any) -> Any:
    """build(*args), kept in this Python process until something else is.

    Workers outlive stages: what the stages before needed would stand in memory beside what this one needs. Stages that run
    at the same time and keep different things build theirs anew for each task.
    """
    key = (build, args)
    if key not in _kept:
        release()
        made = build(*args)
        _kept.clear()
        _kept[key] = made
    return _kept[key]


def release() -> None:
    """Let go of what kept() keeps, and give its memory back to the system where that can be asked for."""
    if _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """docs and a column that tells its rows apart and sorts as the id does, nulls last: the id itself where it does, else
    one of a written copy."""
    ids = docs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(id_col).alias("ids")).first()
    if ids["rows"] == ids["ids"]:
        return docs, id_col
    key = fresh(docs, "row_key")
    parts = [F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row")]
    return stage(docs.withColumn(key, F.struct(*parts)), "keyed"), key
