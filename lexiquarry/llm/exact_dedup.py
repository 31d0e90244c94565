"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after each run of ASCII white space became one space. One pass writes
(id, digest); Misra-Gries summaries of the partitions name the digests that may be frequent; an exact count confirms
them. At most `counters` confirmed digests are broadcast, so the rows of large groups are settled on the map side and
never shuffled. All other digests are counted with partial aggregation and joined back.

Nulls: a null text counts as empty. A null id sorts after every other id, so such a row stays only if its whole group
has none. Ties: of repeated ids in a group exactly one row stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.common import fresh, keyed, release, small, stage

#: Frequent digests kept in a summary, and the most that are ever broadcast.
COUNTERS = 1024


def normalised(text: Column) -> Column:
    """The text that decides equality."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _trim(counts: dict[str, int], counters: int) -> dict[str, int]:
    """Misra-Gries step for a summary with too many counters: subtract the largest that must go."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {k: v - cut for k, v in counts.items() if v > cut}


def misra_gries(df: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """(column, at_least): a mergeable Misra-Gries summary of each partition.

    A value with more than n / (counters + 1) of n rows is in at least one summary; the sum of its counts falls short
    of the truth by no more than that.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        counts: dict[str, int] = {}
        for batch in batches:
            for x in batch.column(0).value_counts().to_pylist():
                counts[x["values"]] = counts.get(x["values"], 0) + x["counts"]
            if len(counts) > 8 * counters:
                counts = _trim(counts, counters)
        counts = _trim(counts, counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], [column, "at_least"]
        )

    return df.select(column).mapInArrow(summarise, f"{column} string, at_least long")


def frequent(df: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """The at most `counters` values that the merged summaries count highest, those seen once left out."""
    merged = misra_gries(df, column, counters).groupBy(column).agg(F.sum("at_least").alias("at_least"))
    return merged.filter("at_least > 1").orderBy(F.desc("at_least"), column).limit(counters).select(column)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = stage(
        docs.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"))
        .withColumn("seq", F.monotonically_increasing_id()),
        "digests",
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "seq")
    groups = [F.count(F.lit(1)).alias("group_size"), F.min(order).alias("first")]
    # The limit bounds what is broadcast: `counters` digests of 64 characters.
    candidates = F.broadcast(frequent(digests, "text_sha256", counters))
    winners = stage(digests.join(candidates, "text_sha256", "left_semi").groupBy("text_sha256").agg(*groups), "heavy")
    marked = digests.join(F.broadcast(winners), "text_sha256", "left")
    light = digests.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    heavy_rows = marked.filter(F.col("group_size").isNotNull())
    light_rows = light.join(light.groupBy("text_sha256").agg(*groups), "text_sha256")
    return heavy_rows.unionByName(light_rows).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("seq") == F.col("first.seq")).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of docs that stay, with docs' own columns."""
    docs, key = keyed(docs, id_col)
    found = stage(exact_dedup(docs, key, text_col, counters), "exact")
    gone = fresh(docs, "gone")
    dropped = found.filter(~F.col("kept")).select(F.col("doc_id").alias(gone))
    kept = docs.join(small(dropped), F.col(key) == F.col(gone), "left_anti")
    return kept if key == id_col else kept.drop(key)
