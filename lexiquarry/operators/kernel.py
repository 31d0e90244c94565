"""The parser as Arrow-batched column functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from lexiquarry.operators import rename as R

_FACT = {"method": IntegerType(), "seq": IntegerType(), "name": StringType(), "role": StringType(), "pos": IntegerType(), "scope_start": IntegerType(), "scope_end": IntegerType(), "depth": IntegerType()}
FACTS = ArrayType(StructType([StructField(k, t) for k, t in _FACT.items()]))
BROKEN = StructType([StructField("broken", BooleanType()), StructField("renamed", StringType())])
FALLBACK = StructType([StructField("fallback", BooleanType()), StructField("renamed", StringType())])


@F.pandas_udf(BooleanType())
def has_errors(source: pd.Series) -> pd.Series:
    """F4; null for null."""
    return source.map(lambda s: None if s is None else R.has_errors(s)).astype("object")


@F.pandas_udf(BROKEN)
def rename(source: pd.Series) -> pd.DataFrame:
    """A2 and A14 of one text."""
    return pd.DataFrame([(None, None) if s is None else R.rename(s) for s in source], columns=["broken", "renamed"])


@F.pandas_udf(FALLBACK)
def rename_or_recover(masked: pd.Series, recovered: pd.Series) -> pd.DataFrame:
    """Rename the masked text if it is sound, else the recovered one. Each text is parsed once."""
    out = []
    for m, r in zip(masked, recovered, strict=True):
        if m is None:
            out.append((None, None))
            continue
        broken, renamed = R.rename(m)
        out.append((broken, R.rename(r)[1] if broken else renamed))
    return pd.DataFrame(out, columns=["fallback", "renamed"])


@F.pandas_udf(StringType())
def name_methods(source: pd.Series) -> pd.Series:
    """A2 alone."""

    def one(text: str) -> str:
        parser, _ = R.jp.parse(text)
        edits = R._Edits(parser)
        R.name_methods(parser, edits)
        return edits.apply(text)

    return source.map(lambda s: None if s is None else one(s))


@F.pandas_udf(StringType())
def name_variables(source: pd.Series) -> pd.Series:
    """A14 alone."""

    def one(text: str) -> str:
        parser, _ = R.jp.parse(text)
        edits = R._Edits(parser)
        R.name_variables(parser, edits)
        return edits.apply(text)

    return source.map(lambda s: None if s is None else one(s))


@F.pandas_udf(FACTS)
def _facts(source: pd.Series) -> pd.Series:
    return source.map(lambda s: [dict(zip(_FACT, f, strict=True)) for f in R.identifier_facts(s or "")])


def facts(source: Column) -> Column:
    """Declarations and uses as an array of structs."""
    return _facts(source)
