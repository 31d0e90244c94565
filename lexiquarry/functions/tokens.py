"""Token counting on text columns, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A token is a maximal run of name characters or non-ASCII, or any other character but blanks.
TOKEN = r"[A-Za-z0-9_$\x{80}-\x{10FFFF}]++|[^ \t\n\f\r]"


def count_tokens(text: Column) -> Column:
    """Number of lexical tokens; null for null."""
    return F.regexp_count(text, F.lit(TOKEN))
