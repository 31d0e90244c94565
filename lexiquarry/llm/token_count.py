"""Token counts, with overlap resynchronisation for huge documents.

A document of up to `chunk` characters is counted whole. A longer one is encoded in chunks that overlap by `overlap`
characters, each with the library's offsets. Two neighbours are spliced at a place where both have a token boundary
and which is provably stable: white space that follows a character that is no white space. The byte-level pattern has
no look-behind, and none of its alternatives goes on from such a character into white space, so whatever precedes the
place cannot change the tokens after it, and the chunk's end cannot change the tokens before it. If an overlap has no
such place, the right chunk starts earlier and the left one ends later, twice as far each time, until they meet one or
the rest of the document is a single chunk. Memory is bounded by the text in hand, a chunk's encoding, and the memo.

Byte-level .json files are resynchronised; other .json files and sentencepiece .model files have no such proof and are
encoded whole by their library. Begin, end and added special tokens are never put in; their strings in a text count as
the library has them by default.

Nulls: a null text has 0 bytes and 0 tokens, as an empty one. Repeated rows are counted each. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.bpe import encoder

CHUNK, OVERLAP, LIMIT = 65_536, 1_024, 1_024

#: Places that split for certain, see above.
STABLE = re.compile(r"(?<=\S)(?=[ \t\n\r\x0b\x0c])")


def spans(library, text: str) -> list[tuple[int, int]]:
    return library.encode(text, add_special_tokens=False).offsets


def count_in_chunks(library, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of text by a byte-level library tokenizer, never encoding more than the widened chunks at once."""
    total, start = 0, 0  # tokens before `start`, which is a stable boundary
    end = min(len(text), chunk)
    left = spans(library, text[:end])
    while end < len(text):
        wide = overlap
        while True:
            a, b = max(start, end - wide), min(len(text), end + chunk + wide)
            right = spans(library, text[a:b])
            begins = {a + x for x, _ in right}
            ends = {start + y for _, y in left}
            # The last character may be torn by the chunk's end, the first by its start: neither is spliced at.
            at = next((m.start() for m in STABLE.finditer(text, a + 1, end - 1) if m.start() in begins and m.start() in ends), None)
            if at is not None or end == len(text):
                break
            wide *= 2
            end = min(len(text), end + wide)
            left = spans(library, text[start:end])
        if at is None:  # the left chunk has grown to the end of the text
            break
        total += sum(start + y <= at for _, y in left)
        left = [(a + x - at, a + y - at) for x, y in right if a + x >= at]
        start, end = at, b
    return total + len(left)


class Counter:
    """Counts tokens as the library of a tokenizer file does."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.chunk, self.overlap, self.bpe = chunk, overlap, None
        if path.endswith(".model"):
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda text: len(self.library.encode(text))
            return
        try:
            self.bpe = encoder(path)
            self.library = self.bpe.library
            self.whole = lambda text: int(self.bpe.counts([text])[0])
        except ValueError:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)
            self.library.no_padding()
            self.library.no_truncation()
            self.whole = lambda text: len(self.library.encode(text, add_special_tokens=False))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.bpe is None or len(text) <= self.chunk:
            return self.whole(text)
        return count_in_chunks(self.library, text, self.chunk, self.overlap)

    def count_all(self, texts: list[str | None]) -> list[int]:
        if self.bpe is None:
            return [self.count(t) for t in texts]
        short = self.bpe.counts([t if t and len(t) <= self.chunk else None for t in texts]).tolist()
        return [n if not t or len(t) <= self.chunk else self.count(t) for n, t in zip(short, texts, strict=True)]


@cache
def counter(path: str, chunk: int, overlap: int) -> Counter:
    """One counter per Python process and file."""
    return Counter(path, chunk, overlap)


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path, chunk, overlap)
        for batch in batches:
            n = tokens.count_all(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    n_bytes = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    counted = docs.select(F.col(id_col).alias("doc_id"), n_bytes.alias("n_bytes"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
