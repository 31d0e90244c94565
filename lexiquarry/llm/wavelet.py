"""Token ids as wavelet matrices, one compressed file per shard.

A wavelet matrix keeps a sequence as one bit-plane per bit of its ids, most significant first; after each plane the
zeros move stably before the ones. With counts of ones before each block of a plane, it answers access (the id at a
place), rank and count (how often an id occurs before a place) and select (where it occurs) in one step per plane,
without the sequence itself.

A plane is kept in frames of `FRAME` bits, each compressed by itself, with the ones before each frame in a directory and
those before each block of `BLOCK` bits in front of the frame's bits. A query reads the directories and inflates one
frame per plane and step (select: two), however large the shard is; the last frames used are remembered.

A shard holds whole documents in ascending id order, about `shard_tokens` ids of them. Its file, all integers little-
endian but the count at byte 8: magic, version and bits (8 bytes), ids (8 bytes, big-endian, so that Spark reads it
with hex and conv), documents (8 bytes); then for the document ids, their nulls and the documents' lengths a length and
a zstandard frame; for each plane the number of its frames, the ones before each and in all, and the frames' lengths;
then all frames, plane by plane, and a closing mark. Files are rows of Spark's text writer: they are committed by Spark
to any of its file systems. Documents are put in order by a range exchange on the id, whose partitions stay in order.

Nulls: a null text is empty (it still has its end id); null ids come first. Repeated rows are repeated documents; rows
with equal ids stand in the order of a hash of their texts, and are spread over files like any others. A document that is longer than a shard has one of its own. An empty
table gives no file and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiquarry.llm.bpe import encoder
from lexiquarry.llm.common import small

#: Fixed values of the format: the mark that begins a file and the one that closes it.
MAGIC, CLOSE = b"LQWM\x02", "LQWMEND\n"

SHARD_TOKENS = 4_000_000
#: Bits in a block of a plane's rank directory, and in a frame; frames of a plane that a reader remembers.
BLOCK, FRAME, REMEMBERED = 512, 1 << 18, 4
#: Tasks that wrote shards whose sizes are added up by Spark; sums of so many tasks each come to the driver.
TASKS = 1024


@dataclass
class Plane:
    """A bit-plane of n bits, first bit of a byte first, in compressed frames; ones: before each frame, and in all."""

    n: int
    ones: np.ndarray
    frames: list[bytes | memoryview]
    inflated: int = 0
    held: OrderedDict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=OrderedDict)

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        coder, frames, ones = zstandard.ZstdCompressor(level=1), [], [0]
        for at in range(0, len(bits), FRAME):
            packed = np.packbits(bits[at : at + FRAME])
            padded = np.zeros(-(-len(packed) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
            padded[: len(packed)] = packed
            before = np.cumsum(np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32), dtype="<u4")
            frames.append(coder.compress(before.tobytes() + packed.tobytes()))
            ones.append(ones[-1] + int(before[-1]))
        return cls(len(bits), np.array(ones, "<u8"), frames)

    def frame(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ones up to the end of each block of a frame, and its packed bits."""
        found = self.held.get(k)
        if found is None:
            raw = zstandard.ZstdDecompressor().decompress(self.frames[k])
            blocks = -(-min(FRAME, self.n - k * FRAME) // BLOCK)
            found = np.frombuffer(raw, "<u4", blocks), np.frombuffer(raw, np.uint8, offset=4 * blocks)
            self.inflated += 1
            self.held[k] = found
            if len(self.held) > REMEMBERED:
                self.held.popitem(last=False)
        else:
            self.held.move_to_end(k)
        return found

    @property
    def zeros(self) -> int:
        return self.n - int(self.ones[-1])

    def bits(self) -> np.ndarray:
        """All of the plane as booleans."""
        packed = [np.frombuffer(zstandard.ZstdDecompressor().decompress(f), np.uint8)[4 * -(-min(FRAME, self.n - k * FRAME) // BLOCK) :] for k, f in enumerate(self.frames)]
        return np.unpackbits(np.concatenate([*packed, np.empty(0, np.uint8)]), count=self.n).view(bool)

    def rank1(self, at: int) -> tuple[int, int]:
        """Ones before `at`, and the bit there (0 at the end)."""
        if at >= self.n:
            return int(self.ones[-1]), 0
        k, at = divmod(at, FRAME)
        before, packed = self.frame(k)
        block, byte = at // BLOCK, at >> 3
        ones = int(self.ones[k]) + (int(before[block - 1]) if block else 0) + int(np.bitwise_count(packed[block * (BLOCK // 8) : byte]).sum())
        here = int(packed[byte])
        return ones + (here >> (8 - (at & 7))).bit_count(), here >> (7 - (at & 7)) & 1

    def select(self, one: int, k: int) -> int:
        """Place of the k-th (from 0) bit with this value, by the directory of frames, that of blocks, and the block."""
        ends = self.ones[1:] if one else np.minimum(np.arange(1, len(self.ones)) * FRAME, self.n) - self.ones[1:].astype(np.int64)
        frame = int(np.searchsorted(ends, k, side="right"))
        k -= int(ends[frame - 1]) if frame else 0
        before, packed = self.frame(frame)
        ends = before if one else np.minimum(np.arange(1, len(before) + 1) * BLOCK, self.n - frame * FRAME) - before.astype(np.int64)
        block = int(np.searchsorted(ends, k, side="right"))
        k -= int(ends[block - 1]) if block else 0
        here = np.unpackbits(packed[block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)])
        return frame * FRAME + block * BLOCK + int(np.flatnonzero(here == one)[k])


class WaveletMatrix:
    """A sequence of ids below 2**bits."""

    def __init__(self, n: int, planes: list[Plane]):
        self.n, self.bits, self.planes = n, len(planes), planes
        self.zeros = [p.zeros for p in planes]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes = []
        for level in range(bits - 1, -1, -1):
            one = (now & now.dtype.type(1 << level)).astype(bool)
            planes.append(Plane.of(one))
            now = np.concatenate([np.compress(~one, now), np.compress(one, now)])
        return cls(len(ids), planes)

    def tokens(self) -> np.ndarray:
        """The whole sequence, by undoing the planes from the last to the first."""
        kind = np.dtype(np.uint16 if self.bits <= 16 else np.uint32)
        now = np.zeros(self.n, kind)
        for level, plane in enumerate(reversed(self.planes)):
            one = plane.bits()
            zeros = self.zeros[self.bits - 1 - level]
            before = np.empty(self.n, kind)
            before[np.flatnonzero(~one)] = now[:zeros]
            before[np.flatnonzero(one)] = now[zeros:] | kind.type(1 << level)
            now = before
        return now.astype(np.uint32)

    def access(self, at: int) -> int:
        value = 0
        for level in range(self.bits):
            ones, one = self.planes[level].rank1(at)
            at = self.zeros[level] + ones if one else at - ones
            value = value << 1 | one
        return value

    def _range(self, value: int, at: int) -> tuple[int, int]:
        """After the last plane, where the occurrences of value before `at` stand."""
        a, b = 0, at
        if value >> self.bits:
            return 0, 0
        for level in range(self.bits):
            x, y = self.planes[level].rank1(a)[0], self.planes[level].rank1(b)[0]
            a, b = (self.zeros[level] + x, self.zeros[level] + y) if value >> (self.bits - 1 - level) & 1 else (a - x, b - y)
        return a, b

    def rank(self, value: int, at: int) -> int:
        """Occurrences of value before `at`."""
        a, b = self._range(value, at)
        return b - a

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of value."""
        a, b = self._range(value, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for level in range(self.bits - 1, -1, -1):
            one = value >> (self.bits - 1 - level) & 1
            at = self.planes[level].select(one, at - self.zeros[level] if one else at)
        return at

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A shard's file, but for the closing mark."""
    matrix = WaveletMatrix.of(ids)
    parts = [np.array([x or 0 for x in doc_ids], "<i8"), np.array([x is None for x in doc_ids], np.uint8), np.array(lengths, "<u8")]
    coder = zstandard.ZstdCompressor(level=1)
    out = [MAGIC + struct.pack("<BH", matrix.bits, 0) + struct.pack(">Q", len(ids)) + struct.pack("<Q", len(doc_ids))]
    for frame in (coder.compress(x.tobytes()) for x in parts):
        out += [struct.pack("<Q", len(frame)), frame]
    for plane in matrix.planes:
        out += [struct.pack("<Q", len(plane.frames)), plane.ones.astype("<u8").tobytes(), np.array([len(f) for f in plane.frames], "<u4").tobytes()]
    return b"".join([*out, *(f for plane in matrix.planes for f in plane.frames)])


def unpack(raw: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their lengths and the matrix of a shard's file; its planes are inflated only where they are read."""
    if raw[:5] != MAGIC or not raw.endswith(CLOSE.encode()):
        raise ValueError("not a shard of token ids, or cut off")
    (n,), (docs,) = struct.unpack_from(">Q", raw, 8), struct.unpack_from("<Q", raw, 16)
    at, parts, decoder = 24, [], zstandard.ZstdDecompressor()
    for _ in range(3):
        (size,) = struct.unpack_from("<Q", raw, at)
        parts.append(decoder.decompress(raw[at + 8 : at + 8 + size]))
        at += 8 + size
    null = np.frombuffer(parts[1], np.uint8)
    ids = [None if z else x for x, z in zip(np.frombuffer(parts[0], "<i8").tolist(), null.tolist(), strict=True)]
    lengths = np.frombuffer(parts[2], "<u8").astype(np.int64)
    directories = []
    for _ in range(raw[5]):
        (count,) = struct.unpack_from("<Q", raw, at)
        directories.append((np.frombuffer(raw, "<u8", count + 1, at + 8), np.frombuffer(raw, "<u4", count, at + 16 + 8 * count).tolist()))
        at += 16 + 12 * count
    view, planes = memoryview(raw), []
    for ones, sizes in directories:
        ends = np.cumsum([at, *sizes]).tolist()
        planes.append(Plane(n, ones, [view[a:b] for a, b in pairwise(ends)]))
        at = ends[-1]
    if len(ids) != docs or lengths.sum() != n or at + len(CLOSE) != len(raw):
        raise ValueError("a shard's directory does not match its ids")
    return ids, lengths, WaveletMatrix(n, planes)


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode docs and write their ids, end_id after each document, as shards under path."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, task, end = encoder(tokenizer), TaskContext.get().partitionId(), np.array([end_id], "<u4")
        number, held, doc_ids, lengths, runs = 0, 0, [], [], []

        def shard() -> pa.RecordBatch:
            blob = pack(doc_ids, lengths, np.concatenate(runs))
            return pa.RecordBatch.from_arrays([pa.array([f"s{task:06d}-{number:06d}"]), pa.array([blob], pa.binary())], ["shard", "blob"])

        for batch in batches:
            ids, ends = bpe.encode_all(batch.column(1).to_pylist())
            for doc_id, (a, b) in zip(batch.column(0).to_pylist(), pairwise(ends.tolist()), strict=True):
                n = b - a + 1
                if held and held + n > shard_tokens:
                    yield shard()
                    number, held, doc_ids, lengths, runs = number + 1, 0, [], [], []
                doc_ids.append(doc_id)
                lengths.append(n)
                runs += [ids[a:b].copy(), end]
                held += n
        if held:
            yield shard()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keys = [F.col("doc_id"), F.xxhash64("text"), F.col("at")]  # a repeated id is spread, too
    rows = rows.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("at")
    blobs = rows.mapInArrow(encode, "shard string, blob binary")
    blobs.select("shard", F.col("blob").cast("string").alias("value")).write.partitionBy("shard").option("lineSep", CLOSE).text(path)


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """(shard, content) of the files under path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"shard=(s\d+-\d+)/", 1).alias("shard"), "content")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """A row per document: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers).

    Starts add up the counts in the files' headers, within `TASKS` writing tasks by a window; the sums of so many tasks
    each come to the driver.
    """
    files = shard_files(spark, path)
    n = F.conv(F.hex(F.substring("content", 9, 8)), 16, 10).cast("long")
    part = lambda k: F.regexp_extract("shard", r"s(\d+)-(\d+)", k).cast("long")
    sizes = files.select("shard", part(1).alias("task"), part(2).alias("number"), n.alias("n")).withColumn("tasks", F.floor(F.col("task") / TASKS))
    sums = sorted(sizes.groupBy("tasks").agg(F.sum("n").alias("n")).collect())
    bases = np.cumsum([0, *(k for _, k in sums)]).tolist()
    base = spark.createDataFrame([(t, b) for (t, _), b in zip(sums, bases, strict=False)], "tasks long, base long")
    before = F.sum("n").over(Window.partitionBy("tasks").orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.withColumn("before", F.coalesce(before, F.lit(0))).join(small(base, len(sums)), "tasks")
    starts = starts.select("shard", (F.col("base") + F.col("before")).alias("shard_start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0), batch.column(1), strict=True):
                doc_ids, lengths, matrix = unpack(content.as_py())
                ids, ends = matrix.tokens(), np.cumsum(lengths)
                crc = [zlib.crc32(ids[b - n : b].astype("<u4", copy=False)) for n, b in zip(lengths.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.as_py()] * len(crc)), pa.array(doc_ids, pa.int64()), pa.array(ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                    ["shard", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    found = files.mapInArrow(decode, "shard string, doc_id long, local long, n_tokens long, ids_crc32 long")
    return found.join(starts, "shard").select("doc_id", (F.col("shard_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
