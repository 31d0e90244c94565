"""Masking, restoring and comparing of string and char literals, as column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lexiquarry.functions import patterns as P
from lexiquarry.functions.repair import split

STORE = "array<struct<placeholder:string,original:string>>"


def lexemes(text: Column) -> Column:
    """A text as comments, string literals, char literals and the rest, in order."""
    return split(text, P.LEXEMES)


def _is_string(piece: Column) -> Column:
    return F.startswith(piece, F.lit('"'))


def _is_char(piece: Column) -> Column:
    return (F.length(piece) > 2) & F.rlike(piece, F.lit(rf"\A{P.CHAR}\z"))


def blank_for_good(text: Column) -> Column:
    """Every string becomes "_" and every char 'X'; comments stay."""
    blank = lambda x: F.when(_is_string(x), F.lit('"_"')).when(_is_char(x), F.lit("'X'")).otherwise(x)
    return F.array_join(F.transform(lexemes(text), blank), "")


def _zip(**arrays: Column) -> Column:
    """Arrays side by side. A lambda computes what it names anew for each element, so it gets elements, not arrays."""
    return F.arrays_zip(*(array.alias(name) for name, array in arrays.items()))


def _taken(text: Column, gap: str, literal: str, replace, others: Column | None = None) -> Column:
    """text with its k-th literal replaced by replace(literal, k, k-th of others). Every character is copied a fixed
    number of times.

    Matches are pinned to each other's ends, so none begins within a gap.
    """
    pattern = F.lit(rf"(?s)\G({gap})({literal})")
    gaps, found = (F.regexp_extract_all(text, pattern, F.lit(k)) for k in (1, 2))
    sides = _zip(gap=gaps, literal=found, other=found if others is None else others)
    pieces = F.transform(sides, lambda x, k: F.concat(x["gap"], replace(x["literal"], k, x["other"])))
    length = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + F.length(x))
    return F.concat(F.array_join(pieces, ""), F.substr(text, length(gaps) + length(found) + 1))


#: What is neither a string nor a char literal.
_OTHER = rf"""(?:{P.LINE_COMMENT}|{P.BLOCK_COMMENT}|[^/"']++|/|(?!{P.CHAR})')*+"""


def blank(text: Column) -> Column:
    """struct(out, store). Strings become "STR_i" by their place in the store, which holds chars too."""
    mark = lambda x, k, _=None: F.when(_is_string(x), F.concat(F.lit('"STR_'), k.cast("string"), F.lit('"'))).otherwise(F.lit("'X'"))
    held = F.regexp_extract_all(text, F.lit(rf"(?s)\G{_OTHER}({P.STRING}|{P.CHAR})"), F.lit(1))
    store = F.transform(held, lambda x, k: F.struct(mark(x, k).alias("placeholder"), x.alias("original"))).cast(STORE)
    return F.when(text.isNotNull(), F.struct(_taken(text, _OTHER, f"{P.STRING}|{P.CHAR}", mark).alias("out"), store.alias("store")))


_PLACEHOLDER = "\"STR_[0-9]++\"|'X'"


def restore(text: Column, store: Column) -> Column:
    """Originals back in place of placeholders, from left to right; a missing placeholder is passed over.

    As a rule the text's placeholders are those of the store, in order, and all are put back at once. Where comments or
    edits have brought others in, entries are looked for one after the other.
    """
    gaps = F.split(text, _PLACEHOLDER, -1)
    plain = F.array_join(F.transform(_zip(gap=gaps, entry=store), lambda x: F.concat(x["gap"], F.coalesce(x["entry"]["original"], F.lit("")))), "")
    in_order = F.regexp_extract_all(text, F.lit(_PLACEHOLDER), F.lit(0)) == F.transform(store, lambda e: e["placeholder"])
    return F.when(in_order, plain).otherwise(_restore_one_by_one(text, store))


def _restore_one_by_one(text: Column, store: Column) -> Column:
    start = F.struct(F.lit("").alias("done"), text.alias("rest"))

    def step(acc: Column, entry: Column) -> Column:
        at = F.position(entry["placeholder"], acc["rest"])
        done = F.concat(acc["done"], F.substr(acc["rest"], F.lit(1), at - 1), entry["original"])
        rest = F.substr(acc["rest"], at + F.length(entry["placeholder"]))
        return F.when(at > 0, F.struct(done.alias("done"), rest.alias("rest"))).otherwise(acc)

    return F.aggregate(store, start, step, lambda acc: F.concat(acc["done"], acc["rest"]))


def closed_literals(text: Column) -> Column:
    """Texts of the closed string literals. Comments and char literals are not looked at."""
    return F.filter(split(text, rf'(?s)({P.CLOSED}|[^"]++|".*)'), lambda x: F.rlike(x, F.lit(rf"(?s)\A{P.CLOSED}\z")))


@F.pandas_udf(ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])))
def _spans(lengths: pd.Series) -> pd.Series:
    """Spans of every second of pieces of these lengths."""

    def one(x: np.ndarray | None) -> list[dict[str, int]] | None:
        if x is None:
            return None
        ends = np.cumsum(x).tolist()
        return [{"start": a, "end": b} for a, b in zip(ends[::2], ends[1::2], strict=True)]

    return lengths.map(one)


def literal_spans(text: Column) -> Column:
    """Character spans [start, end) of the closed string literals, quotes included."""
    pattern = F.lit(rf'(?s)\G([^"]*+)({P.CLOSED})')
    gaps, found = (F.regexp_extract_all(text, pattern, F.lit(k)) for k in (1, 2))
    return _spans(F.flatten(F.transform(_zip(gap=gaps, literal=found), lambda x: F.array(F.length(x["gap"]), F.length(x["literal"])))))


def take_literals(prompt: Column, response: Column) -> Column:
    """Response with its closed literals replaced by those of prompt; null if their numbers differ."""
    ours = closed_literals(prompt)
    taken = _taken(response, '[^"]*+', P.CLOSED, lambda _, k, x: x, ours)
    return F.when(F.size(ours) == F.size(closed_literals(response)), taken)


def identifier(text: Column) -> Column:
    """The first run of ASCII name characters; null without one."""
    found = F.regexp_extract(text, "[A-Za-z0-9_$]+", 0)
    return F.when(found != "", found)
