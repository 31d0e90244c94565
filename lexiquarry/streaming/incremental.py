"""New files as they come: a file stream whose batches go through the pair pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lexiquarry.plans.training_pairs import append
from lexiquarry.sources.files import java_files


def start(spark: SparkSession, source_dir: str, target: str, checkpoint: str, blanked: bool = False, available_now: bool = True) -> StreamingQuery:
    """Stream of a directory's .java files into pair datasets.

    The checkpoint remembers files; the join against existing output makes a batch that is run again a no-op for what
    it had already written.
    """

    def batch(found: DataFrame, _: int) -> None:
        append(found.sparkSession, found, target, blanked)

    writer = java_files(spark, source_dir, stream=True).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
