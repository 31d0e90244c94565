"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

Every string of `length` bytes that also starts elsewhere is removed. Suffixes of all places would take many times the
text, so the suffix arrays are sparse: a suffix is indexed where the hash of its first `GRAM` bytes is the least of all
grams of some window of `length` bytes. The choice depends on the window's bytes alone, so two equal windows hold the
same anchor at the same place, and comparing suffixes at anchors finds every repeated window. A suffix array lists the
places of a batch's suffixes in byte order; it carries the first GRAM bytes of each, which is what is sorted by (suffixes
that agree in them stand by place), so it can be merged without the texts.

Batches arrive one after the other. Each gets its suffix array and is merge-scanned against every level of the family:
in the common order, suffixes next to each other that agree in their first GRAM bytes match, and are handed on with
their places. Levels made of equally many batches are merged in the same scan until no two are of one size, so that n
batches stand in at most log n + 1 levels and a suffix is rewritten log n times. Arrays are range-partitioned by bytes and
place, so a common string is spread over partitions; the first and last suffix of a partition count as matching, which
costs a look but no result.

Matching suffixes are then extended to all windows of `length` bytes. Each window belongs to the one anchor with its
least gram; an anchor's environment are the bytes of its windows. If another anchor has the same environment (by 128 bits
of hash), all of it is removed. Otherwise the environments of a gram are compared byte by byte. More than `GROUP` of them
never meet as such: they are dealt by blocks of windows. All windows of a block have a centre in common, so environments
that share a window share a centre, and only those with the same centre are compared, in one task up to `CENTRE` of
them; more are dealt by narrower blocks, at last by single windows.

Documents that are copies of each other are removed entirely (from `length` bytes on) and indexed once, so groups of
copies do not reach the index.

Nulls: a null text is empty. Texts shorter than `length` bytes lose nothing and hold no string. Null and repeated ids
are rows of their own. Repeated rows are copies. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiquarry.llm.common import drop, slim_rows, small, stage

LENGTH, GRAM, BATCHES = 200, 32, 4
#: Distinct environments of a gram that are compared at once (24 KB), and those with a common centre (3.7 MB).
GROUP, CENTRE = 64, 16_384
#: Distances from window to anchor in a block, one after the other where a centre is too common.
WIDTHS = (25, 5, 1)
#: Windows looked at in one go.
CHUNK = 1 << 20

_rng = np.random.default_rng(1993)
_BYTES = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = int(_rng.integers(1, 2**62)) * 2 + 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, mod 2**64, of a base and of its inverse."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        pair = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            out = np.ones(size, np.uint64)
            filled = 1
            while filled < size:
                out[filled : 2 * filled] = out[:filled] * np.uint64(pow(base, filled, 2**64))
                filled *= 2
            pair.append(out)
        _powers[size] = (pair[0], pair[1])
    return _powers[size][0][:n], _powers[size][1][:n]


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the suffixes to index, ascending, and the first and the last window that belong to each."""
    width, n = length - gram + 1, len(data)
    found = []
    for start in range(0, n - length + 1, CHUNK):
        windows = min(CHUNK, n - length + 1 - start)
        raw = np.frombuffer(data, np.uint8, windows + length - 1, start)
        power, inverse = _power(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * power[: len(raw)], out=total[1:])
        order = (total[gram:] - total[:-gram]) * inverse[: len(raw) - gram + 1]
        order ^= order >> np.uint64(31)
        order *= np.uint64(0x9E3779B97F4A7C15)
        # The upper bits order grams by hash; the lower are their place, the leftmost winning a tie.
        order &= np.uint64(~0xFFFFFF & 0xFFFFFFFFFFFFFFFF)
        order |= np.arange(len(order), dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            order = np.minimum(order[:-span], order[span:])
            span *= 2
        if span < width:
            order = np.minimum(order[: len(order) - (width - span)], order[width - span :])
        at = (order & np.uint64(0xFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        found.append((start + at[new], start + new))
    if not found:
        return (np.empty(0, np.int64),) * 3
    places, first = (np.concatenate(x) for x in zip(*found, strict=True))
    new = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])  # a chunk may begin within an anchor's windows
    places, first = places[new], first[new]
    return places, first, np.r_[first[1:] - 1, n - length]


def common_windows(envs: list[tuple[bytes, int]], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each distinct environment (bytes, place of its anchor): runs [from, to] of distances from window to anchor
    at which another environment has the same window."""
    if len(envs) == 2:
        (x, p), (y, q) = envs
        right = _common(np.frombuffer(x, np.uint8)[p:], np.frombuffer(y, np.uint8)[q:])
        left = _common(np.frombuffer(x, np.uint8)[:p][::-1], np.frombuffer(y, np.uint8)[:q][::-1])
        run = [(length - right, left)] if right + left >= length else []
        return [[(max(0, a), b) for a, b in run]] * 2
    found: list[list[int]] = [[] for _ in envs]
    reach = [(max(0, p + length - len(x)), p) for x, p in envs]
    for near in range(0, max(p for _, p in envs) + 1, WIDTHS[0]):
        far = near + WIDTHS[0] - 1
        by_centre: dict[bytes, list[int]] = {}
        for i, (x, p) in enumerate(envs):
            if reach[i][0] <= far and near <= reach[i][1]:
                by_centre.setdefault(x[p - near : p + length - far], []).append(i)
        for members in by_centre.values():
            for d in range(near, far + 1) if len(members) > 1 else ():
                seen: dict[bytes, int] = {}
                for i in members:
                    if reach[i][0] <= d <= reach[i][1]:
                        x, p = envs[i]
                        first = seen.setdefault(x[p - d : p - d + length], i)
                        if first != i:
                            found[i].append(d)
                            if not found[first] or found[first][-1] != d:
                                found[first].append(d)
    return [runs(f) for f in found]


def blocks(env: bytes, at: int, width: int, length: int = LENGTH) -> Iterator[tuple[int, bytes, int, bytes]]:
    """For each block of distances with windows of env: its number, centre, and the windows' bytes with the anchor's place."""
    least = max(0, at + length - len(env))
    for k in range(least // width, at // width + 1):
        near, far = k * width, k * width + width - 1
        a, b = min(far, at), max(near, least)
        yield k, env[at - near : at + length - far], a, env[at - a : at + length - b]


def runs(values: list[int]) -> list[tuple[int, int]]:
    """Ascending integers as runs [from, to]."""
    out: list[tuple[int, int]] = []
    for v in values:
        if out and out[-1][1] + 1 >= v:
            out[-1] = (out[-1][0], v)
        else:
            out.append((v, v))
    return out


def _common(x: np.ndarray, y: np.ndarray) -> int:
    n = min(len(x), len(y))
    differ = x[:n] != y[:n]
    return int(differ.argmax()) if differ.any() else n


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs [from, to) of spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_SUFFIX = "gram binary, key long, at int, back int, span int, env long"


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The indexed suffixes of each text: its windows begin from at - back to at - back + span."""
    for batch in batches:
        grams, keys, found, envs = [], [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = text.encode()
            at, first, last = anchors(data)
            if not len(at):
                continue
            grams.append(np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), GRAM)[at])
            keys.append(np.full(len(at), key))
            found.append(np.stack([at, at - first, last - first]).astype(np.int32))
            envs += [_xxh(data[a : b + LENGTH], p) for a, b, p in zip(first.tolist(), last.tolist(), found[-1][1].tolist(), strict=True)]
        if not keys:
            continue
        n = len(envs)
        gram = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, GRAM * (n + 1), GRAM, dtype=np.int32)), pa.py_buffer(np.concatenate(grams).tobytes())])
        at, back, span = np.concatenate(found, axis=1)
        env = pa.array(np.array(envs, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([gram, pa.array(np.concatenate(keys), pa.int64()), pa.array(at), pa.array(back), pa.array(span), env], ["gram", "key", "at", "back", "span", "env"])


_xxh = xxhash.xxh3_64_intdigest


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes with hit: told before, or next to one with the same gram, or at an end of the partition."""
    held: tuple[pa.RecordBatch, np.ndarray, bytes] | None = None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*held[0].columns, pa.array(held[1])], [*held[0].schema.names, "hit"])

    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(0)
        start = np.frombuffer(column.buffers()[1], np.int32, 1, 4 * column.offset)[0]
        gram = np.frombuffer(column.buffers()[2], np.uint64, len(column) * GRAM // 8, start).reshape(len(column), -1)
        hit = batch.column(6).to_numpy(zero_copy_only=False).copy()
        same = (gram[1:] == gram[:-1]).all(axis=1)
        hit[1:] |= same
        hit[:-1] |= same
        if held is None:
            hit[0] = True
        else:
            again = held[2] == gram[0].tobytes()
            held[1][-1] |= again
            hit[0] |= again
            yield out()
        held = batch, hit, gram[-1].tobytes()
    if held is not None:
        held[1][-1] = True
        yield out()


class Family:
    """Levels of sorted suffixes, with the number of batches in each; they are files, and further batches may come."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, batch: DataFrame) -> DataFrame:
        """Index a batch of suffixes; gives those, of the batch and of the family, that match since it came.

        A suffix of a level that is only scanned may be given again later.
        """
        new = self._sorted(batch.withColumn("told", F.lit(False)), "array")
        found = [self._fresh(new)]
        size, scanned = 1, list(self.levels)
        while self.levels and self.levels[-1][0] == size:
            _, old = self.levels.pop()
            scanned.pop()
            both = self._sorted(self._told(old).unionByName(self._told(new)), "level")
            found.append(self._fresh(both))
            drop(old, new)
            new, size = both, 2 * size
        for _, level in scanned:  # of other sizes: scanned, but not rewritten
            both = self._sorted(self._told(level).unionByName(self._told(new)), "scan")
            found.append(self._fresh(both))
            drop(both)
        self.levels.append((size, new))
        return reduce(DataFrame.unionByName, found)

    @staticmethod
    def _sorted(suffixes: DataFrame, name: str) -> DataFrame:
        keys = ["gram", "key", "at"]
        ordered = suffixes.select("gram", "key", "at", "back", "span", "env", "told").repartitionByRange(*keys).sortWithinPartitions(*keys)
        with slim_rows(suffixes.sparkSession):
            return stage(ordered.mapInArrow(_scan, f"{_SUFFIX}, told boolean, hit boolean"), name, "zstd")

    @staticmethod
    def _told(level: DataFrame) -> DataFrame:
        return level.drop("told").withColumnRenamed("hit", "told")

    @staticmethod
    def _fresh(scanned: DataFrame) -> DataFrame:
        return stage(scanned.filter("hit and not told").drop("hit", "told"), "matches")


def _environments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prefix, env, p, bytes, many) of the wanted anchors of each text."""
    for batch in batches:
        out: tuple[list, list, list, list, list] = ([], [], [], [], [])
        size = 0
        for text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode()
            for x in wanted:
                first = x["at"] - x["back"]
                last = first + x["span"]
                for to, v in zip(out, (x["prefix"], x["env"], x["back"], data[first : last + LENGTH], x["many"]), strict=True):
                    to.append(v)
                size += last + LENGTH - first
            if size > 8_000_000:
                yield _env_batch(out)
                out, size = ([], [], [], [], []), 0
        yield _env_batch(out)


def _env_batch(out: tuple[list, list, list, list, list]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], ["prefix", "env", "p", "bytes", "many"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: tuple[list, list, list, list] = ([], [], [], [])
        for prefix, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for m, found in zip(members, common_windows([(m["bytes"], m["p"]) for m in members]), strict=True):
                for a, b in found:
                    for to, v in zip(out, (prefix, m["env"], a, b), strict=True):
                        to.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["prefix", "env", "near", "far"])


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(prefix, block, centre, env, p, bytes) of environments (prefix, env, p, bytes)."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        rows = []
        for prefix, env, p, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows += [(prefix, k, _xxh(centre) - 2**63, env, a, part) for k, centre, a, part in blocks(raw, p, width)]
        columns = zip(*rows, strict=True) if rows else [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["prefix", "block", "centre", "env", "p", "bytes"])


def _crowded(envs: DataFrame) -> DataFrame:
    """(prefix, env, near, far) of environments (prefix, env, p, bytes) of grams that have many: by blocks of windows."""
    out: list[DataFrame] = []
    for width in WIDTHS:
        cut = envs.mapInArrow(lambda batches, width=width: _blocks(batches, width), "prefix long, block long, centre long, env long, p long, bytes binary")
        cut = stage(cut, "blocks")
        key = ["prefix", "block", "centre"]
        sizes = stage(cut.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes")
        if width == 1:  # a centre is a window
            hits = cut.join(sizes, key, "left_semi")
            return reduce(DataFrame.unionByName, [*out, hits.select("prefix", "env", F.col("block").alias("near"), F.col("block").alias("far"))])
        few = cut.join(sizes.filter(F.col("n") <= CENTRE).drop("n"), key).groupBy(*key).agg(F.collect_list(F.struct("env", "p", "bytes")).alias("members"))
        out.append(few.select("prefix", "members").mapInArrow(_compare, "prefix long, env long, near long, far long"))
        many = sizes.filter(F.col("n") > CENTRE).drop("n")
        if many.isEmpty():
            return reduce(DataFrame.unionByName, out)
        envs = cut.join(many, key, "left_semi").select("prefix", "env", "p", "bytes")
    raise AssertionError


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n_removed, spans, kept_sha256) of texts with their spans."""
    for batch in batches:
        out: tuple[list, list, list, list] = ([], [], [], [])
        for key, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode()
            gone = merged([(max(0, s["a"]), min(len(data), s["b"])) for s in spans])
            ends = [0, *(x for span in gone for x in span), len(data)]
            kept = hashlib.sha256(b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))).hexdigest()
            for to, v in zip(out, (key, sum(b - a for a, b in gone), [{"a": a, "b": b} for a, b in gone], kept), strict=True):
                to.append(v)
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), kind, pa.string()), strict=True)], ["key", "n_removed", "spans", "kept_sha256"])


def repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, spans (removed bytes [a, b)), kept_sha256."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    if ids["rows"] == ids["ids"] and isinstance(rows.schema["doc_id"].dataType, (T.LongType, T.IntegerType)):
        rows = rows.withColumn("key", F.col("doc_id").cast("long"))
    else:  # a key that stays the same needs a written copy
        rows = stage(rows.withColumn("key", F.monotonically_increasing_id()), "keyed")
    texts = rows.select("key", "text")

    about = stage(rows.select("key", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "about")
    groups = stage(about.groupBy("sha").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies")), "copies")
    copies = about.join(groups.filter("copies > 1"), "sha").filter("key != rep").select("key")
    copies = stage(copies, "not-indexed")
    firsts = texts.filter(F.octet_length("text") >= LENGTH).join(small(copies), "key", "left_anti")

    suffixes = firsts.mapInArrow(_suffixes, _SUFFIX).withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(batches)).cast("byte"))
    suffixes = stage(suffixes, "suffixes", "zstd")
    family, found = Family(), []
    for k in range(batches):
        found.append(family.add(suffixes.filter(F.col("batch") == k).drop("batch")))
    drop(suffixes, *(level for _, level in family.levels))
    # From here on a gram goes by its hash, which with that of the environment makes 128 bits.
    matched = reduce(DataFrame.unionByName, found).dropDuplicates(["key", "at"])
    matched = stage(matched.select("key", "at", "back", "span", F.xxhash64("gram").alias("prefix"), "env"), "matched")

    one = F.min(F.struct("key", "at", "back", "span")).alias("one")
    by_env = stage(matched.groupBy("prefix", "env").agg(F.count(F.lit(1)).alias("n"), one), "environments")
    whole = matched.join(by_env.filter("n > 1").select("prefix", "env"), ["prefix", "env"], "left_semi")
    first = (F.col("at") - F.col("back")).cast("long")
    whole = whole.select("key", first.alias("a"), (first + F.col("span") + LENGTH).alias("b"))

    mixed = by_env.groupBy("prefix").agg(F.count(F.lit(1)).alias("envs")).filter("envs > 1")
    mixed = small(stage(mixed, "mixed"))
    wanted = by_env.join(mixed, "prefix").select(F.col("one.key").alias("key"), F.struct("one.at", "one.back", "one.span", "prefix", "env", (F.col("envs") > GROUP).alias("many")).alias("x"))
    wanted = stage(wanted.groupBy("key").agg(F.collect_list("x").alias("wanted")), "wanted")
    envs = texts.join(wanted, "key").select("text", "wanted")
    envs = stage(envs.mapInArrow(_environments, "prefix long, env long, p long, bytes binary, many boolean"), "bytes")
    some = envs.filter("not many").groupBy("prefix").agg(F.collect_list(F.struct("env", "p", "bytes")).alias("members"))
    partial = some.select("prefix", "members").mapInArrow(_compare, "prefix long, env long, near long, far long")
    crowded = envs.filter("many").select("prefix", "env", "p", "bytes")
    if not crowded.isEmpty():
        partial = partial.unionByName(_crowded(crowded))
    partial = partial.join(by_env.filter("n = 1"), ["prefix", "env"])
    at = F.col("one.at").cast("long")
    partial = partial.select(F.col("one.key").alias("key"), (at - F.col("far")).alias("a"), (at - F.col("near") + LENGTH).alias("b"))

    spans = stage(whole.unionByName(partial).groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "spans")
    cut = texts.join(spans, "key").select("key", "text", "spans")
    cut = stage(cut.mapInArrow(_cut, "key long, n_removed long, spans array<struct<a:long,b:long>>, kept_sha256 string"), "cut")

    placed = about.join(groups, "sha").join(cut.withColumnRenamed("key", "rep"), "rep", "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n_bytes").alias("b")))
    return placed.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, all_of_it).otherwise(F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>"))).alias("spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
