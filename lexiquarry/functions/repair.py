"""Repair of damaged escapes and line breaks in source text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiquarry.functions import patterns as P


def split(text: Column, pattern: str) -> Column:
    """All pieces that the first group of pattern takes from left to right."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def drop_nul_and_cr(text: Column) -> Column:
    """CR LF becomes LF, NUL goes; a CR that only NUL parts from its LF stays."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\0"), F.lit(""))


def unescape_unicode(text: Column) -> Column:
    """T2: \\uXXXX or \\UXXXX of a printable ASCII character becomes that character; the result is not read again."""
    pieces = split(text, rf"(?s)({P.UNICODE_ESCAPE}|[^\\]++|\\)")
    char = lambda x: F.when(
        (F.length(x) == 6) & F.startswith(x, F.lit("\\")), F.char(F.conv(F.substr(x, F.lit(3), F.lit(4)), 16, 10).cast("int"))
    ).otherwise(x)
    return F.array_join(F.transform(pieces, char), "")


def unescape_apostrophes(text: Column) -> Column:
    """An odd run of backslashes before an apostrophe loses one."""
    return F.regexp_replace(text, r"(?<!\\)((?:\\\\)*+)\\'", "$1'")


def escape_line_breaks(text: Column) -> Column:
    """T4: line breaks inside string literals become \\n and \\r. Comments and char literals are not looked at."""
    inside = lambda x: F.replace(F.replace(x, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    fixed = F.transform(split(text, rf'(?s)({P.STRING}|[^"]++)'), lambda x: F.when(F.startswith(x, F.lit('"')), inside(x)).otherwise(x))
    return F.when(F.contains(text, F.lit('"')), F.array_join(fixed, "")).otherwise(text)


def repair(text: Column) -> Column:
    """All structural repairs in their order."""
    return escape_line_breaks(unescape_apostrophes(unescape_unicode(drop_nul_and_cr(text))))


def collapse_backslashes(text: Column) -> Column:
    """T5: a run of two or more backslashes before a quote becomes one."""
    return F.regexp_replace(text, r'\\{2,}+"', r'\\"')


def repair_all(text: Column) -> Column:
    """Repair, then collapse_backslashes."""
    return collapse_backslashes(repair(text))


def strip(text: Column) -> Column:
    """Unicode white space and the separators U+001C to U+001F go from both ends."""
    return F.regexp_replace(text, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def is_blank(text: Column) -> Column:
    """Whether nothing but white space is in the text."""
    return F.length(F.regexp_replace(text, r"(?U)\s", "")) == 0
