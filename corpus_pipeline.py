"""From raw documents to clean, decontaminated and tokenised ones.

Five stages, each over all that the one before kept: documents without a language that can be told go; of exact copies
the one with the smallest id stays; of each group of near-duplicates one stays; documents that hold a window of a
benchmark item go; what is left is encoded, decoded and checked. Every stage but the last returns the columns of
documents.

Nulls and empties: a null or wordless text has no language, so it goes first. Null and repeated ids are rows of their own;
of copies the row with the smallest id stays, one without an id last. Repeated rows are copies. Columns besides those of
documents are carried along to the last stage, which keeps doc_id, lang and source. An empty table gives empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.llm import bpe, decontaminate, exact_dedup, language_id, minhash
from lexiquarry.llm.common import prepare, stage, table

TOKENIZER = "byte_bpe_50k.json"
#: Of the encoder's memo: workers and executors keep memory that earlier stages have taken.
MEMO = 300_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_known(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.encoded(docs, public_tokenizers.path(TOKENIZER), keep=("lang", "source"), memo=MEMO)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: BPE cannot be expressed in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
