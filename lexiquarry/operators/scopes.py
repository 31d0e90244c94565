"""Scope resolution and numbering as relational operators over identifier facts.

The kernel does all of this in one pass; these operators make the facts a table, so that lookups are joins, counters
are window functions, and edits with the same place are settled by an aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiquarry.operators.kernel import facts
from lexiquarry.session import staged


def identifier_facts(sources: DataFrame, text: str = "src") -> DataFrame:
    """(source_file, method, seq, name, role, pos, scope_start, scope_end, depth), written once: plans read facts often."""
    rows = sources.select("source_file", F.explode(facts(F.col(text))).alias("f"))
    return staged(rows.select("source_file", "f.*"), "facts")


def numbered_methods(found: DataFrame) -> DataFrame:
    """(source_file, seq, pos, name, new_name) of methods, numbered in source order."""
    w = Window.partitionBy("source_file").orderBy("seq")
    methods = found.filter("role = 'method'")
    return methods.select("source_file", "seq", "pos", "name", F.concat(F.lit("func_"), F.row_number().over(w).cast("string")).alias("new_name"))


def numbered_variables(found: DataFrame) -> DataFrame:
    """(source_file, method, seq, pos, name, scope_start, scope_end, depth, new_name): fields, then locals.

    Facts of a method within a method stand once for each, as both number their locals.
    """
    declared = found.filter("role in ('field', 'declare')")
    w = Window.partitionBy("source_file").orderBy(F.when(F.col("role") == "field", 0).otherwise(1), "method", "seq")
    numbered = declared.withColumn("k", F.row_number().over(w))
    last = F.max("k").over(Window.partitionBy("source_file", "role", "name"))
    k = F.when(F.col("role") == "field", last).otherwise(F.col("k"))  # a field's last number counts everywhere
    return numbered.select("source_file", "method", "seq", "pos", "name", "role", "scope_start", "scope_end", "depth", F.concat(F.lit("var_"), k.cast("string")).alias("new_name"))


def resolved_uses(found: DataFrame, variables: DataFrame) -> DataFrame:
    """(source_file, method, seq, pos, new_name) of uses, from the innermost scope that has the name."""
    uses = found.filter("role = 'use'").select("source_file", "method", "seq", "pos", "name")
    d = variables.select("source_file", "name", F.col("method").alias("d_method"), F.col("seq").alias("d_seq"), "role", "scope_start", "scope_end", "depth", "new_name")
    local = (F.col("d_method") == F.col("method")) & (F.col("d_seq") < F.col("seq")) & F.col("seq").between(F.col("scope_start"), F.col("scope_end"))
    hits = uses.join(d, ["source_file", "name"]).filter((F.col("role") == "field") | local)
    rank = F.struct(F.when(F.col("role") == "field", 0).otherwise(F.col("depth")), F.col("d_seq"))
    return hits.groupBy("source_file", "method", "seq", "pos").agg(F.max_by("new_name", rank).alias("new_name"))


def edits(variables: DataFrame, uses: DataFrame, methods: DataFrame) -> DataFrame:
    """(source_file, pos, new_name), the last edit of each place."""
    rows = [
        variables.filter("role = 'field'").select("source_file", "pos", F.lit(-1).alias("pass"), "seq", "new_name"),
        variables.filter("role = 'declare'").select("source_file", "pos", F.col("method").alias("pass"), "seq", "new_name"),
        uses.select("source_file", "pos", F.col("method").alias("pass"), "seq", "new_name"),
        methods.select("source_file", "pos", F.lit(-2).alias("pass"), "seq", "new_name"),
    ]
    everything = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])
    return everything.groupBy("source_file", "pos").agg(F.max_by("new_name", F.struct("pass", "seq")).alias("new_name"))
