"""Zstandard WARC archives: writer and reader.

An archive begins with a skippable frame that holds a dictionary, trained on a bounded sample of the payloads; then
each record is one frame of its own. Between records stands an empty skippable frame, which is what Spark's text
writer puts after each row: so archives are written and committed by Spark to any of its file systems, and a lost task
leaves nothing behind. Reading loads whole archives, whose size is bounded by `archive_bytes`, walks the frames by
their headers, decodes one frame per record, and checks the version line, the header fields, the block's and the
payload's length, the closing line feeds and a SHA-256 payload digest. A broken archive raises ValueError. Archives of
other writers may hold records that are neither responses nor revisits, which are checked and passed over, digests of
other kinds, which are handed on as they stand, and revisits that do not name a page id, which refer to none.

Of records with equal payloads of at least `least_bytes`, the one with the smallest page id is a response and the
others revisit it; they hold no payload, only its length and digest. Smaller payloads are always responses.

Nulls: a null payload counts as empty. A null url gives no target. A null page id is no smallest id: it revisits a
page that has one, and is a response where its payload's pages have none. Repeated page ids with equal payloads tie:
all rows with the smallest id are responses. An empty table gives no archive and an empty result.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.llm.common import small, stage

#: Magic numbers of a frame, of the dictionary's skippable frame, and an empty skippable frame as text.
FRAME_MAGIC, DICT_MAGIC, SEPARATOR = 0xFD2FB528, 0x184D2A5D, "P*M\x18\0\0\0\0"

LEAST_BYTES, ARCHIVE_BYTES = 100, 16_000_000
#: The dictionary's size, and the sample it is trained on: so many pages, so many characters of each.
DICT_BYTES, DICT_PAGES, DICT_CHARS = 65_536, 400, 20_000
DATE = "1970-01-01T00:00:00Z"

_SCHEMA = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"


def train(pages: DataFrame, id_col: str, payload_col: str) -> bytes:
    """A dictionary from the beginnings of the pages whose ids hash lowest; b"" without pages.

    A threshold on the hash lets about four times as many pages through as are wanted, whatever their number, so that
    few rows are sorted and sent to the driver.
    """
    rank = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.substring(payload_col, 1, 64)), F.lit(1 << 30))
    texts = pages.filter(F.length(payload_col) > 0).select(rank.alias("rank"), F.substring(payload_col, 1, DICT_CHARS).alias("text"))
    below = (4 * DICT_PAGES << 30) // max(1, pages.count())
    sample = texts.filter(F.col("rank") < below).orderBy("rank", "text").limit(DICT_PAGES)
    texts = [r["text"].encode() for r in sample.collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, texts).as_bytes()
    except zstandard.ZstdError:  # too few samples: their text itself is the dictionary
        return b"".join(texts)[:DICT_BYTES]


def _record_id(page_id: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _field(text: str) -> str:
    """text as the value of a header field: control characters and blanks are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id: str | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record; refers_to makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}"]
    head += [f"WARC-Target-URI: {_field(url)}"] if url is not None else []
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response"]
    head += [f"X-Page-Id: {_field(page_id)}"] if page_id is not None else []
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page-Id: {_field(refers_to)}"]
    head += [f"Content-Length: {len(block)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple | None:
    """The row of _SCHEMA of one record, checked; None for records of other types."""

    def need(ok: object, what: str) -> None:
        if not ok:
            raise ValueError(f"WARC record: {what}")

    head, found, rest = raw.partition(b"\r\n\r\n")
    need(found, "no end of the header")
    version, *lines = head.decode().split("\r\n")
    need(version in ("WARC/1.0", "WARC/1.1"), "unknown version")
    pairs = [x.partition(":") for x in lines]
    need(all(colon and name == name.strip() for name, colon, _ in pairs), "malformed field")
    fields = {name.lower(): value.strip() for name, _, value in pairs}
    need(len(fields) == len(pairs), "repeated field")
    need({"warc-type", "warc-record-id", "warc-date", "content-length"} <= fields.keys(), "missing field")
    need(fields["content-length"].isdecimal() and len(rest) == int(fields["content-length"]) + 4, "wrong length")
    need(rest.endswith(b"\r\n\r\n"), "no end of the block")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
    if kind not in ("response", "revisit"):
        return None
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    length = re.search(rb"\r\nContent-Length: (\d+)", http)
    need(found and length, "no HTTP length")
    size = int(length[1])
    if kind == "response":
        need(len(payload) == size, "wrong payload length")
        need(not digest.startswith("sha256:") or f"sha256:{hashlib.sha256(payload).hexdigest()}" == digest, "wrong payload digest")
    else:
        need(not payload, "a revisit with payload")
    return fields.get("x-page-id"), fields.get("warc-target-uri"), size, digest.removeprefix("sha256:"), kind, fields.get("x-refers-to-page-id"), payload if kind == "response" else None


def frame_end(raw: memoryview, at: int) -> int:
    """Where the frame that begins at `at` ends, from its header and its blocks' headers."""
    flags = raw[at + 4]
    at += 5 + (not flags & 0x20) + (0, 1, 2, 4)[flags & 3] + (1 if flags & 0x20 else 0, 2, 4, 8)[flags >> 6]
    last = False
    while not last:
        if at + 3 > len(raw):
            raise ValueError("archive: cut off")
        block = int.from_bytes(raw[at : at + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
    return at + 4 * bool(flags & 4)


def records(archive: bytes) -> Iterator[bytes]:
    """The decoded records of an archive."""
    raw, at = memoryview(archive), 0
    decoder = zstandard.ZstdDecompressor()
    while at < len(raw):
        if len(raw) - at < 8:
            raise ValueError("archive: cut off")
        magic, size = struct.unpack_from("<II", raw, at)
        if magic & ~0xF == 0x184D2A50:
            if at == 0 and magic == DICT_MAGIC:
                held = bytes(raw[8 : 8 + size])
                if held[:4] == FRAME_MAGIC.to_bytes(4, "little"):  # the dictionary may itself be compressed
                    held = decoder.decompress(held)
                decoder = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(held))
            at += 8 + size
        elif magic == FRAME_MAGIC:
            end = frame_end(raw, at)
            if end > len(raw):
                raise ValueError("archive: cut off")
            yield decoder.decompress(raw[at:end])
            at = end
        else:
            raise ValueError("archive: no frame")


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write a record for each row of pages under path."""
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload")
    ).withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    copies = rows.filter(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = small(stage(copies.filter("n > 1").select("digest", "first"), "copies"))
    target = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).cast("string")
    rows = rows.join(copies, "digest", "left").select(F.col("page_id").cast("string"), "url", "payload", "size", "digest", target.alias("target"))
    dictionary = train(pages, id_col, payload_col)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, held = TaskContext.get().partitionId(), zstandard.ZstdCompressionDict(dictionary)
        coder = zstandard.ZstdCompressor(level=3, dict_data=held if dictionary else None, write_checksum=True, write_content_size=True)
        lead = struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary
        number, size, ordinal = 0, 0, 0
        for batch in batches:
            out: list[tuple[str, int, bytes]] = []
            for page_id, url, payload, n, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                frame = coder.compress(record(page_id, url, payload, n, digest, refers_to))
                if size + len(frame) > archive_bytes and ordinal:
                    number, size, ordinal = number + 1, 0, 0
                name = f"a{task:06d}-{number:06d}"
                if not ordinal and dictionary:
                    out.append((name, 0, lead))
                ordinal, size = ordinal + 1, size + len(frame)
                out.append((name, ordinal, frame))
            names, ordinals, frames = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ordinals, pa.int64()), pa.array(frames, pa.binary())], ["archive", "ordinal", "frame"])

    frames = rows.mapInArrow(pack, "archive string, ordinal long, frame binary").sortWithinPartitions("archive", "ordinal")
    frames.select("archive", F.col("frame").cast("string").alias("value")).write.partitionBy("archive").option("lineSep", SEPARATOR).text(path)


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """A row per record of the archives under path: the columns of _SCHEMA, ids as id_type."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                held = 0
                for raw in records(content.as_py()):
                    row = parse(raw)
                    rows += [] if row is None else [row]
                    held += len(raw)
                    if held > 4_000_000:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    found = files.select("content").mapInArrow(unpack, _SCHEMA)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in _SCHEMA.split(", ")])
