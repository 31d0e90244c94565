"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to their words (ASCII letters in lower case, digits and all non-ASCII characters; the rest
separates). A benchmark item's windows are its runs of `window` consecutive words, or the whole item when it has fewer.
All windows of all items stand in one automaton. It reads words by short names, two or three characters for a dictionary
of all the benchmark's words: the first character is of an alphabet of its own, so no match begins within a word, and no
node has many ways on. Every text is scanned once; matches are word numbers, which map back to character offsets of the
original text. An automaton has up to thirty nodes of 40 bytes for each word of the benchmark.

The benchmark's size is looked at first. Up to `block_bytes` of text all of it is broadcast, and documents are scanned
in one pass without an exchange. A larger benchmark is dealt by a hash of its items into blocks of about that size,
which are scanned one after the other, so no broadcast grows with the data; the hit words of all blocks are merged
before anything is derived from them, so the rows are the same for any size of block.

Nulls: a null text or item has no words; an item without words has no windows. A row with a null id is scanned like
any other. Repeated item ids count once each per document; a null item id counts as the string "null". Ties and
repeated rows need no rule, each row is judged alone. An empty benchmark contaminates nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import accumulate, chain, repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.common import kept, stage

WINDOW = 10

#: Item text in one automaton: it takes some 200 times that in a worker.
BLOCK_BYTES = 1_000_000

#: What is no word character, as bytes: ASCII other than letters and digits. Letters A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """The normalised words."""
    return (text or "").encode().translate(_FOLD).split()


def windows(text: str | None, window: int = WINDOW) -> set[tuple[bytes, ...]]:
    """The distinct windows of an item."""
    w = words(text)
    n = min(window, len(w))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()


Items = tuple[tuple[str, str | None], ...]


def automaton(items: Items, window: int = WINDOW):
    """Short names of the benchmark's words, and one automaton over the windows of items; None without any."""
    import ahocorasick

    found: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        for x in windows(text, window):
            found.setdefault(x, set()).add(item)
    if not found:
        return None
    names: dict[bytes, str] = dict.fromkeys((w for x in found for w in x), "")
    width = next(k for k in range(1, 11) if 64**k >= len(names))
    names = {w: _name(k, width) for k, w in enumerate(names)}
    machine = ahocorasick.Automaton()
    for x, owners in found.items():
        machine.add_word("".join([names[w] for w in x]), (len(x), tuple(sorted(owners))))
    machine.make_automaton()
    return names, machine


#: Every word that the benchmark does not have.
_OTHER = "\0"


def _name(k: int, width: int) -> str:
    """The k-th word in `width` characters, the first of one alphabet of 64, the others of another."""
    return "".join(chr((0x80 if i else 0x40) + (k >> 6 * i & 63)) for i in range(width))


Runs = list[tuple[int, int]]


def merged(runs: Iterable[tuple[int, int]]) -> Runs:
    """Runs [from, to) in order and apart."""
    out: Runs = []
    for a, b in sorted(runs):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def scan(built, text: str | None) -> tuple[int, Runs, set[str]]:
    """Number of words, hit runs of words [from, to) in order and apart, and the items with windows that occur."""
    w = words(text)
    runs: Runs = []
    items: set[str] = set()
    if built is None or not w:
        return len(w), runs, items
    names, machine = built
    named = list(map(names.get, w, repeat(_OTHER)))
    ends: dict[int, int] = {}  # places in the line where words end, and how many have ended there
    for last, (n, owners) in machine.iter("".join(named)):
        if not ends:
            ends = dict(zip(accumulate(map(len, named)), range(1, len(named) + 1), strict=True))
        b = ends[last + 1]
        a = b - n
        items.update(owners)
        while runs and runs[-1][1] >= a:  # ends never fall
            a = min(a, runs.pop()[0])
        runs.append((a, b))
    return len(w), runs, items


def offsets(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of runs of words."""
    spans = [m.span() for m in _WORD.finditer(text)] if runs else []
    return [(spans[a][0], spans[b - 1][1]) for a, b in runs]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[Items]:
    """The items by blocks of about block_bytes."""
    item = F.coalesce(F.col(item_col).cast("string"), F.lit("null"))
    rows = benchmark.select(item.alias("item"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    for k in range(count):
        block = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).collect()
        if block or not k:
            yield tuple((r["item"], r["text"]) for r in block)


_PAIRS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _hits(rows: DataFrame, items: Items, window: int) -> DataFrame:
    """rows (doc_id, seq, text) as (doc_id, seq, n_words, runs, spans, items), with the hits of one automaton."""
    sent = rows.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = kept(automaton, sent.value, window)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = [scan(built, t) for t in texts]
            yield _found(batch.column(0), batch.column(1), texts, found)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {_FOUND}")


_FOUND = "seq long, n_words long, runs array<struct<a:long,b:long>>, spans array<struct<start:long,end:long>>, items array<string>"


def _found(ids: pa.Array, seqs: pa.Array, texts: list[str | None], found: list[tuple[int, Runs, set[str]]]) -> pa.RecordBatch:
    columns = [
        pa.array([n for n, _, _ in found], pa.int64()),
        pa.array([[{"a": a, "b": b} for a, b in runs] for _, runs, _ in found], _PAIRS),
        pa.array([[{"start": a, "end": b} for a, b in offsets(t, runs)] if runs else [] for t, (_, runs, _) in zip(texts, found, strict=True)], _SPANS),
        pa.array([sorted(hit) for _, _, hit in found], pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays([ids, seqs, *columns], ["doc_id", "seq", "n_words", "runs", "spans", "items"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hits of all blocks in each text as one."""
    for batch in batches:
        texts, found = batch.column(2).to_pylist(), []
        for text, runs, items in zip(texts, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            found.append((len(words(text)), merged((r["a"], r["b"]) for block in runs or [] for r in block), {x for block in items or [] for x in block}))
        yield _found(batch.column(0), batch.column(1), texts, found)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of docs: doc_id, n_words, runs (hit words), spans (characters), items (sorted strings)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lit(0).cast("long").alias("seq"), F.col(text_col).alias("text"))
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _hits(rows, first, window).drop("seq")
    rows = stage(rows.withColumn("seq", F.monotonically_increasing_id()), "numbered")
    parts = [stage(_hits(rows, items, window).filter(F.size("runs") > 0).select("seq", "runs", "items"), "hits") for items in chain((first, second), blocks)]
    hits = reduce(DataFrame.unionByName, parts).groupBy("seq").agg(F.collect_list("runs").alias("runs"), F.collect_list("items").alias("items"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    whole = rows.join(hits, "seq", "left").select("doc_id", "seq", "text", "runs", "items")
    return whole.mapInArrow(_gathered, f"doc_id {kind}, {_FOUND}").drop("seq")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of decontaminate()'s rows."""
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + r["b"] - r["a"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of docs, with their own columns, in which no window of the benchmark occurs."""
    at = docs.columns.index(text_col)

    def filtering(items: Items):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            built = kept(automaton, sent.value, window)
            for batch in batches:
                yield batch.filter(pa.array([not scan(built, t)[1] for t in batch.column(at).to_pylist()], pa.bool_()))

        return run

    for k, items in enumerate(_blocks(benchmark, item_col, item_text_col, block_bytes)):
        docs = (stage(docs, "kept") if k else docs).mapInArrow(filtering(items), docs.schema)
    return docs
