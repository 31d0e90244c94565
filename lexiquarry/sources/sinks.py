"""Sinks: pairs as JSON datasets, texts, errors, and one file per source for small sets."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIRS = T.StructType([T.StructField("prompt", T.StringType()), T.StructField("response", T.StringType()), T.StructField("source_file", T.StringType())])


def blanked_sibling(path: str) -> str:
    """<parent>/<name>_blanked; without a name it is jsonl, without a parent '.'."""
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head or ('' if path.startswith('/') else '.')}/{name or 'jsonl'}_blanked"


def json_line(prompt, response):
    """A pair as one JSON object, prompt first."""
    return F.to_json(F.struct(prompt.alias("prompt"), response.alias("response")))


def write_pairs(pairs: DataFrame, path: str) -> None:
    """K1, K2: append (prompt, response, source_file) to a JSON dataset."""
    pairs.select("prompt", "response", "source_file").write.mode("append").json(path)


def write_errors(errors: DataFrame, path: str) -> None:
    """K3: append (stage, source_file, error)."""
    errors.select("stage", "source_file", "error").write.mode("append").json(path)


def write_texts(sources: DataFrame, path: str) -> None:
    """Replace a text dataset, a folder per source file."""
    sources.select("source_file", F.col("src").alias("value")).write.mode("overwrite").partitionBy("source_file").text(path)


def _exists(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, hadoop, system.exists(hadoop)


def done(spark: SparkSession, *paths: str) -> DataFrame:
    """(source_file) of all pairs already in these datasets."""
    found = spark.createDataFrame([], "source_file string")
    for path in paths:
        if _exists(spark, path)[2]:
            found = found.unionByName(spark.read.schema(PAIRS).json(path).select("source_file"))
    return found.distinct()


class Ledger:
    """the names of the sources whose pairs are in a target and its sibling, as a Parquet dataset beside the target.

    A mark stands beside it while pairs are being written. Where it is found, or no ledger is, the pairs themselves are
    read once, so a run that broke off is neither repeated nor forgotten.
    """

    def __init__(self, spark: SparkSession, target: str, *others: str):
        self.spark, self.sets = spark, (target, *others)
        self.path, self.mark = f"{target.rstrip('/')}_done", f"{target.rstrip('/')}_done_open"

    def done(self) -> DataFrame:
        """(source_file), each once."""
        if not _exists(self.spark, self.path)[2] or _exists(self.spark, self.mark)[2]:
            done(self.spark, *self.sets).write.mode("overwrite").parquet(self.path)
            self._unmark()
        return self.spark.read.schema("source_file string").parquet(self.path).distinct()

    def open(self) -> None:
        system, mark, _ = _exists(self.spark, self.mark)
        system.create(mark, True).close()

    def close(self, written: DataFrame) -> None:
        written.select("source_file").write.mode("append").parquet(self.path)
        self._unmark()

    def _unmark(self) -> None:
        system, mark, there = _exists(self.spark, self.mark)
        if there:
            system.delete(mark, False)


def export_files(rows: DataFrame, path: str, suffix: str = "") -> None:
    """One file per row of (source_file, text) in a flat directory, written by the executors.

    A file is written under another name and then renamed, so a task that is run again leaves whole files only. Folders
    that Python has no file system for are written by the driver, a row at a time.
    """
    base = f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path
    named = rows.select(F.concat("source_file", F.lit(suffix)).alias("name"), "text")
    try:
        fs.FileSystem.from_uri(base)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        _export_by_driver(named, path)
        return

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(base)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                passing = f"{root}/.{uuid.uuid4().hex}"
                with system.open_output_stream(passing) as out:
                    out.write(text.encode())
                system.move(passing, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    named.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _export_by_driver(named: DataFrame, path: str) -> None:
    for r in named.toLocalIterator():
        system, hadoop, _ = _exists(named.sparkSession, f"{path}/{r['name']}")
        out = system.create(hadoop, True)
        out.write(bytearray(r["text"].encode()))
        out.close()


def export_pairs(pairs: DataFrame, path: str, suffix: str = ".jsonl") -> None:
    """Each pair as one JSON line in a file of its own, source_file and suffix; the suffix is looked at first."""
    if not suffix.endswith(".jsonl"):
        raise ValueError("Output file must have a .jsonl extension")
    line = F.concat(json_line(F.col("prompt"), F.col("response")), F.lit("\n"))
    export_files(pairs.select("source_file", line.alias("text")), path, suffix)
