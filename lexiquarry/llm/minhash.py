"""Near-duplicates by one-permutation MinHash, confirmed on full shingle sets.

Words are runs of anything but ASCII white space, ASCII letters in lower case; a document's set holds its distinct
5-word shingles as 64-bit hashes (with fewer words the whole sequence is one). Documents with equal sets are one
vertex from the start, so groups of copies never reach the buckets.

One hash per shingle serves all `BINS` bins: its upper bits choose the bin, and the least hash of each bin is kept. An
empty bin borrows from the first filled bin of its own random probe sequence, the same in every document (optimal
densification), so that sparse sets agree bin by bin as often as full ones. Bands of `ROWS` bins are bucket keys; at
the threshold of 0.75 a pair shares no bucket of 32 with probability 5e-6.

In each bucket a star of candidate edges leads from a hub to the other members. Edges are confirmed on full sets, and
the links become components. In `ROUNDS` further rounds a bucket that holds more than one gets a new hub from its most
frequent component, for the members outside it; that joins what the first hub happened not to resemble. Members of buckets that still hold more than one component are then compared by their
rarest shingles: with all sets in one order, from the rarest shingle to the commonest among these members, two linked
sets share a shingle within the first seventh of the smaller set and the first quarter of the larger, and what follows
their first common shingle must suffice for a link. Members with a common core and private rests have only private
shingles in front, so they are refuted without meeting, however many there are. A shingle's postings are compared only
across components: those outside its most frequent component with all. No step caps a bucket or a shingle's postings.

Nulls and empties: documents without words have an empty set, are their own component and linked with nothing. A null
id takes part like any other; the component's id is its smallest id that is not null. Repeated rows and ids are
distinct rows with equal sets, so they share a component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiquarry.llm.common import drop, fresh, keyed, release, small, stage
from lexiquarry.llm.components import components, merge_components

SHINGLE, BINS, ROWS = 5, 128, 4
#: Stars after the first.
ROUNDS = 2

_rng = np.random.default_rng(20_11)
_WEIGHTS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROW_WEIGHTS = _rng.integers(1, 2**63, (BINS // ROWS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Probe sequence of each bin: the bins in random order.
_PROBES = np.stack([_rng.permutation(BINS) for _ in range(BINS)])


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(n, shingle)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total += hashes[k : n - size + 1 + k] * _WEIGHTS[k]
    return np.unique(_mix(total))


def set_key(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    raw = xxhash.xxh3_128_digest(elements.tobytes())
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def signature(elements: np.ndarray) -> np.ndarray:
    """One-permutation signature with optimal densification; elements are sorted and not empty."""
    bins = (elements >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    out = np.zeros(BINS, np.uint64)
    filled = np.zeros(BINS, bool)
    out[bins[first]] = elements[first]
    filled[bins[first]] = True
    if len(first) < BINS:
        empty = np.flatnonzero(~filled)
        probes = _PROBES[empty]
        out[empty] = out[probes[np.arange(len(empty)), filled[probes].argmax(axis=1)]]
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A bucket key for each band."""
    rows = sig.reshape(-1, ROWS)
    total = np.arange(len(rows), dtype=np.uint64)
    for k in range(ROWS):
        total = _mix(total + rows[:, k] * _ROW_WEIGHTS[:, k])
    return total.view(np.int64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 * intersection >= 75 * union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        size, lo, hi, bands = [], [], [], []
        for text in batch.column(2).to_pylist():
            s = shingle_set(text)
            key = set_key(s)
            size.append(len(s))
            lo.append(key[0])
            hi.append(key[1])
            bands.append(band_keys(signature(s)) if len(s) else np.empty(0, np.int64))
        offsets = np.cumsum([0, *map(len, bands)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*bands, np.empty(0, np.int64)])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), lists],
            ["seq", "doc_id", "n", "lo", "hi", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the texts whose key is the one looked for."""
    for batch in batches:
        seq, raw = [], []
        for k, lo, hi, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            s = shingle_set(text)
            if set_key(s) == (lo, hi):
                seq.append(k)
                raw.append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(seq, pa.int64()), pa.array(raw, pa.binary())], ["seq", "elements"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = zip(batch.column(2), batch.column(3), strict=True)
        ok = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in sides]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], ["a", "b", "linked"])


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of pairs (a, b), on full sets."""
    left = pairs.join(sets.select(F.col("seq").alias("a"), F.col("elements").alias("left")), "a")
    both = left.join(sets.select(F.col("seq").alias("b"), F.col("elements").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(_verified, "a long, b long, linked boolean")


def _with_components(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members with comp, their component; labels: (u, v)."""
    return members.join(labels.select(F.col("u").alias("seq"), F.col("v").alias("comp")), "seq", "left").withColumn("comp", F.coalesce("comp", "seq"))


def _star(left: DataFrame, k: int) -> DataFrame:
    """(a, b): for each bucket of more than one component, a hub of the most frequent one with the members outside."""
    inside = left.join(small(stage(_mixed(left, "bucket"), "mixed")), "bucket")
    hub = F.min_by(F.struct("seq", "n"), F.xxhash64("seq", "bucket", F.lit(k))).alias("hub")
    hubs = small(stage(inside.filter("comp = major").groupBy("bucket").agg(hub), "hubs"))
    met = inside.filter("comp != major").join(hubs, "bucket").filter("4 * least(n, hub.n) >= 3 * greatest(n, hub.n)")
    return met.select(F.least("seq", "hub.seq").alias("a"), F.greatest("seq", "hub.seq").alias("b")).distinct()


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for seq, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            s = np.frombuffer(raw.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(np.full(len(s), seq))], ["shingle", "seq"])


def _mixed(members: DataFrame, key: str) -> DataFrame:
    """The keys whose members are of more than one component, and the component that most of them are of."""
    by_comp = members.groupBy(key, "comp").agg(F.count(F.lit(1)).alias("n"))
    return by_comp.groupBy(key).agg(F.count(F.lit(1)).alias("comps"), F.max_by("comp", F.struct("n", "comp")).alias("major")).filter("comps > 1").drop("comps")


def _postings(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(shingle, seq, comp, n, rest) of the first quarter of each member's shingles, the rarest first.

    rest: shingles from this one on. Shingles that one member has come first and are left out, as nobody can meet there.
    """
    shingles = stage(sets.join(members.select("seq"), "seq").select("seq", "elements").mapInArrow(_shingles, "shingle long, seq long"), "shingles")
    often = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    ranked = shingles.join(often, "shingle").groupBy("seq").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("ranked"))
    ranked = members.join(ranked, "seq").withColumn("alone", F.col("n") - F.size("ranked"))
    front = F.floor(F.col("n") / 4) + 1 - F.col("alone")  # a link needs three quarters of a set to be shared
    ranked = ranked.filter(front > 0).select("seq", "comp", "n", "alone", F.posexplode(F.slice("ranked", 1, front.cast("int"))).alias("k", "x"))
    return ranked.select(F.col("x.shingle").alias("shingle"), "seq", "comp", "n", (F.col("n") - F.col("alone") - F.col("k")).alias("rest"))


def _rare_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): members (seq, n, comp) of different components that their rarest shingles do not refute."""
    # 100 i >= 75 (n + m - i) is 7 i >= 3 (n + m), and from a common shingle on i cannot exceed what either side has left:
    # each side's spare, 7 rest - 3 n, must reach 3 m.
    found = stage(_postings(members, sets).withColumn("spare", 7 * F.col("rest") - 3 * F.col("n")), "postings")
    found = found.join(small(stage(_mixed(found, "shingle"), "mixed")), "shingle").withColumn("minor", F.col("comp") != F.col("major")).drop("major")
    found = stage(found, "met")
    # What the partners of a posting offer at most: those of the most frequent component meet the others, these meet all.
    of = lambda x: F.when(F.col("minor"), F.col(x))
    offers = [F.max("spare").alias("spare_all"), F.min("n").alias("n_all"), F.max(of("spare")).alias("spare_minor"), F.min(of("n")).alias("n_minor")]
    offers = small(stage(found.groupBy("shingle").agg(*offers), "offers"))
    offer, least = (F.when(F.col("minor"), F.col(f"{x}_all")).otherwise(F.col(f"{x}_minor")) for x in ("spare", "n"))
    found = found.join(offers, "shingle").filter((3 * F.col("n") <= offer) & (F.col("spare") >= 3 * least))
    found = stage(found.select("shingle", "seq", "comp", "n", "spare", "minor"), "left-over")
    outer = found.select("shingle", *(F.col(x).alias(f"o_{x}") for x in ("seq", "comp", "n", "spare", "minor")))
    fits = (F.col("comp") != F.col("o_comp")) & (F.struct("n", "seq") < F.struct("o_n", "o_seq")) & (F.col("spare") >= 3 * F.col("o_n")) & (F.col("o_spare") >= 3 * F.col("n"))
    minor = found.filter("minor").join(outer, "shingle").filter(fits)
    major = found.filter("not minor").join(outer.filter("o_minor"), "shingle").filter(fits)
    return minor.unionByName(major).select(F.least("seq", "o_seq").alias("a"), F.greatest("seq", "o_seq").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept, and first (one row of each component)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("seq"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = stage(rows.mapInArrow(_signatures, f"seq long, doc_id {kind}, n long, lo long, hi long, bands array<long>"), "signed")
    groups = stage(signed.filter("n > 0").groupBy("lo", "hi").agg(F.min("seq").alias("rep")), "sets")
    reps = signed.join(groups.select(F.col("rep").alias("seq")), "seq", "left_semi")
    members = reps.select("seq", "n", F.explode("bands").alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("seq").alias("h_seq"), F.min_by("n", "seq").alias("h_n")).filter("size > 1")
    shared = stage(members.join(crowded, "bucket"), "buckets")

    wanted = signed.select("seq", F.col("doc_id").alias("id"), "lo", "hi").join(shared.select("seq"), "seq", "left_semi")
    wanted = stage(wanted, "wanted")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(small(wanted), F.col("doc_id").eqNullSafe(F.col("id")))
    sets = stage(texts.select("seq", "lo", "hi", "text").mapInArrow(_sets, "seq long, elements binary"), "elements")

    near = (F.col("seq") != F.col("h_seq")) & (4 * F.least("n", "h_n") >= 3 * F.greatest("n", "h_n"))
    pairs = shared.filter(near).select(F.col("h_seq").alias("a"), F.col("seq").alias("b")).distinct()
    links = stage(verify(pairs, sets).filter("linked").select("a", "b"), "links")
    labels = components(links)
    # The hub of a bucket has met all its members.
    left = shared.filter(F.col("seq") != F.col("h_seq")).filter("size > 2").select("bucket", "seq", "n")
    left = stage(left, "left")
    named = stage(_with_components(left, labels), "named")
    for k in range(ROUNDS):
        links = stage(verify(stage(_star(named, k), "star"), sets).filter("linked").select("a", "b"), "links")
        if links.isEmpty():
            break
        labels = merge_components(labels, links)
        named = stage(_with_components(left, labels), "named")
    left = named
    members = stage(left.join(_mixed(left, "bucket"), "bucket", "left_semi").select("seq", "n", "comp").distinct(), "members")
    links = stage(verify(stage(_rare_pairs(members, sets), "pairs"), sets).filter("linked").select("a", "b"), "links")
    labels = merge_components(labels, links)
    drop(sets)

    of_rep = groups.join(labels.withColumnRenamed("u", "rep"), "rep", "left").select("lo", "hi", F.coalesce("v", "rep").alias("comp"))
    own = signed.select("seq", "doc_id", "n", "lo", "hi")
    placed = own.filter("n > 0").join(of_rep, ["lo", "hi"]).unionByName(own.filter("n = 0").withColumn("comp", F.col("seq")))
    placed = stage(placed.select("seq", "doc_id", "n", "comp"), "placed")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "seq")
    least = placed.groupBy("comp").agg(F.min(order).alias("first"))
    return placed.join(least, "comp").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("first.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")).alias("kept"),
        (F.col("seq") == F.col("first.seq")).alias("first"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with their own columns, that are the first of their component."""
    docs, key = keyed(docs, id_col)
    found = stage(near_duplicates(docs, key, text_col), "near")
    gone = fresh(docs, "gone")
    dropped = found.filter(~F.col("first")).select(F.col("doc_id").alias(gone))
    kept = docs.join(small(dropped), F.col(key) == F.col(gone), "left_anti")
    return kept if key == id_col else kept.drop(key)
