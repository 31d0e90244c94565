"""Sources of program text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.functions.repair import repair, strip

#: Shares of a corpus by size letter.
SIZES = {"s": 0.1, "m": 0.5, "l": 1.0}

#: What the binary file source gives.
FILES = "path string, modificationTime timestamp, length long, content binary"


def java_files(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """(source_file, path, content) of the files of a flat directory that end in .java, in any case.

    Content is only read when it is used. Spark hides files whose names begin with '_' or '.'.
    """
    reader = spark.readStream.schema(FILES) if stream else spark.read
    files = reader.format("binaryFile").option("pathGlobFilter", "?*.[jJ][aA][vV][aA]").option("recursiveFileLookup", "false").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "path", "content")


def texts(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source_file, src) of the files that are UTF-8, and error rows of those that are not."""
    raw = files.select("source_file", F.col("content").cast("string").alias("src"))
    bad = raw.filter(~F.is_valid_utf8("src")).select(F.lit("read").alias("stage"), "source_file", F.lit("stream did not contain valid UTF-8").alias("error"))
    return raw.filter(F.is_valid_utf8("src")), bad


def pairs_of_files(spark: SparkSession, originals: str, renamed: str) -> DataFrame:
    """S3: (source_file, original, renamed) of files with the same name in two directories, both repaired."""
    left, _ = texts(java_files(spark, originals))
    right, _ = texts(java_files(spark, renamed))
    side = lambda df, name: df.select("source_file", repair(F.col("src")).alias(name))
    return side(left, "original").join(side(right, "renamed"), "source_file")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, line) of a text file, counted from 0 over its lines.

    Counts per partition come to the driver, lines do not: one pass numbers the lines within each partition, whose
    order is the file's.
    """
    text = spark.read.text(path)
    numbered = text.select(F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    part = F.shiftright("id", 33)
    sizes = sorted((r["p"], r["n"]) for r in numbered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    starts = spark.createDataFrame(rows, "p long, start long")
    return numbered.withColumn("p", part.cast("long")).join(F.broadcast(starts), "p").select(
        (F.col("start") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).alias("ordinal"), "line"
    )


def prefix(numbered: DataFrame, share: float, rows: int | None = None) -> DataFrame:
    """The first lines: those whose ordinal is at most floor(share * rows) + 1."""
    n = numbered.count() if rows is None else rows
    return numbered.filter(F.col("ordinal") <= F.floor(F.lit(float(share)) * F.lit(float(n))) + 1)


def classes(numbered: DataFrame) -> DataFrame:
    """Each line k as the body of TestClass{k}: (source_file, src)."""
    k = F.col("ordinal").cast("string")
    src = F.concat(F.lit("public class TestClass"), k, F.lit(" {\n"), strip(F.col("line")), F.lit("\n}"))
    return numbered.select(F.concat(F.lit("TestClass"), k, F.lit(".java")).alias("source_file"), src.alias("src"))


def classes_of(spark: SparkSession, path: str, size: str = "l") -> DataFrame:
    """The classes of a text file's first lines."""
    numbered = lines(spark, path)
    return classes(numbered if SIZES[size] >= 1 else prefix(numbered, SIZES[size]))
