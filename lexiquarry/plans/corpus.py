"""A Java corpus made from the part table, with damage of six kinds, and what must become of it.

Both engines build it from the same SQL expressions over part; expectations are closed forms of the same template, not
results of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.session import spread, table

LF, CRLF, BS, Q, A = "chr(10)", "chr(13) || chr(10)", "chr(92)", "chr(34)", "chr(39)"
METHOD = "'check' || k"


def quoted(body: str) -> str:
    return f"{Q} || {body} || {Q}"


def template(newline: str, literal: str, extra: str = "''", method: str = METHOD, name: str = "'name'", size: str = "'size'") -> str:
    """SQL for a source file."""
    return (
        f"'public class TestClass' || k || ' {{' || {newline} || '@Test public void ' || {method} || '() {{ String ' || {name} || ' = ' || {literal}"
        f" || '; int ' || {size} || ' = ' || z || '; ' || {extra} || 'assertEquals(' || {size} || ', helper(' || {name} || ')); }}' || {newline} || '}}'"
    )


def by_variant(default: str, **others: str) -> str:
    """SQL that chooses by variant: v1='...', v2='...'."""
    cases = " ".join(f"WHEN {key[1:]} THEN {sql}" for key, sql in others.items())
    return f"(CASE v {cases} ELSE {default} END)"


CORRUPT = f"n || ' ' || {BS} || {BS} || {Q} || ' b ' || {BS} || {BS} || {Q} || ' c'"
PLAIN = quoted("n")
#: The literal as it comes and after repair.
RAW = by_variant(PLAIN, v2=f"{BS} || 'u0022' || n || {BS} || 'u0022'", v4=quoted(f"n || {LF}"), v5=quoted(CORRUPT))
FIXED = by_variant(PLAIN, v4=quoted(f"n || {BS} || 'n'"), v5=quoted(CORRUPT))
NEWLINE = by_variant(LF, v1=CRLF)


def extra(char: str = f"{A} || 'Q' || {A}", name: str = "'c'") -> str:
    return by_variant("''", v3=f"'char ' || {name} || ' = ' || {char} || '; '")


ESCAPED = f"{BS} || {A} || 'Q' || {BS} || {A}"
SOURCE = template(NEWLINE, RAW, extra(ESCAPED))
REPAIRED = template(LF, FIXED, extra())
VAR = {"method": "'func_1'", "name": "'var_1'", "size": "'var_2'"}
BLANK = f"{Q} || '_' || {Q}"
#: A broken text keeps what stands between its two strings until doubled backslashes go.
TORN = f" || ' b ' || {BS} || {BS} || "
BLANKED = template(LF, by_variant(BLANK, v5=BLANK + TORN + BLANK), extra(f"{A} || 'X' || {A}"))
MASKED = template(LF, by_variant(f"{Q} || 'STR_0' || {Q}", v5=f"{Q} || 'STR_0' || {Q}{TORN}{Q} || 'STR_1' || {Q}"), extra(f"{A} || 'X' || {A}"))
COLLAPSED = template(LF, by_variant(FIXED, v5=quoted(f"n || ' ' || {BS} || {Q} || ' b ' || {BS} || {Q} || ' c'")), extra())
RECOVERED = template(LF, BLANK, extra(f"{A} || 'X' || {A}"))
RENAMED = template(LF, by_variant(FIXED, v5=BLANK), extra(name="'var_3'"), **VAR)
RENAMED_BLANK = template(LF, BLANK, extra(f"{A} || 'X' || {A}", "'var_3'"), **VAR)

PARTS = "SELECT p_partkey AS k, p_name AS n, p_size AS z, p_partkey % 6 AS v FROM part"


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spread(table(spark, sf_dir, "part"))
    return part.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("n"), F.col("p_size").alias("z"), F.expr("p_partkey % 6").alias("v"))


def sources(spark: SparkSession, sf_dir: str, sql: str = SOURCE) -> DataFrame:
    """(source_file, src, v) of each part."""
    return parts(spark, sf_dir).select(F.expr("'TestClass' || k || '.java'").alias("source_file"), F.expr(sql).alias("src"), "v")


def oracle(columns: str, where: str = "true") -> str:
    """DuckDB SQL for columns over the parts."""
    return f"WITH p AS ({PARTS}) SELECT 'TestClass' || k || '.java' AS source_file, {columns} FROM p WHERE {where}"
