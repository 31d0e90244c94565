"""The parser as SQL functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lexiquarry.operators import kernel

#: Function names in SQL.
FUNCTIONS = {
    "java_has_errors": kernel.has_errors,
    "java_rename": kernel.rename,
    "java_rename_or_recover": kernel.rename_or_recover,
    "java_name_methods": kernel.name_methods,
    "java_name_variables": kernel.name_variables,
    "java_facts": kernel._facts,
}


def register(spark: SparkSession) -> None:
    """Make the parser's functions known to a session's SQL."""
    for name, function in FUNCTIONS.items():
        spark.udf.register(name, function)
