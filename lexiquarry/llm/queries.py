"""The registered queries of this subpackage, with production parameters, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.llm import language_id, warc, wavelet
from lexiquarry.llm.bpe import bpe_digests
from lexiquarry.llm.chat import format_chats
from lexiquarry.llm.common import prepare, shared_path, table
from lexiquarry.llm.decontaminate import decontaminate, digests
from lexiquarry.llm.exact_dedup import exact_dedup
from lexiquarry.llm.minhash import near_duplicates
from lexiquarry.llm.substring_dedup import repeated_strings
from lexiquarry.llm.token_count import count_tokens

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = shared_path(spark, "shards")
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID)
    return wavelet.read_shards(spark, path)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = repeated_strings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = shared_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).drop("url", "payload")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return format_chats(table(spark, sf_dir, "conversations"))


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents")).drop("first")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return digests(decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = language_id.identify(docs, model)
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {f.__name__: f for f in (op1_wavelet, op2_substring_dedup, op3_bpe, op4_warc, op5_chat_format, op6_token_count, op7_exact_dedup, op8_near_dedup, op9_decontaminate, op10_language_id)}

ORACLES = {
    "op4_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM r
""",
    "op7_exact_dedup": r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
""",
    "op8_near_dedup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS s
  FROM w, LATERAL (SELECT unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 75 * (p.n + q.n - i)),
way AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, way.y FROM reach JOIN way ON r = way.x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN n USING (doc_id)
""",
    "op9_decontaminate": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
places AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) WHERE len(w) >= n),
hit AS (SELECT doc_id, item_id, i, n FROM places JOIN win USING (n, s)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
""",
}
