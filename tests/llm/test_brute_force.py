"""Queries without SQL against brute force, on small tables."""

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lexiquarry.llm import bpe, chat, merges, minhash, queries, substring_dedup, token_count

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def encoded(library, documents):
    return [e.ids for e in library.encode_batch([t or "" for _, t, _ in documents], add_special_tokens=False)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_op1(spark, documents, encoded):
    want, start = [], 0
    for (doc_id, *_), ids in zip(documents, encoded, strict=True):
        raw = np.array([*ids, 2], "<u4")
        want.append((doc_id, start, len(raw), zlib.crc32(raw.tobytes())))
        start += len(raw)
    assert sorted(map(tuple, queries.op1_wavelet(spark, SF).collect())) == want


def removed(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(hashlib.blake2b(d[i : i + length], digest_size=12).digest() for d in data for i in range(len(d) - length + 1))
    for d in data:
        mark = np.zeros(len(d) + 1, int)
        for i in range(len(d) - length + 1):
            if seen[hashlib.blake2b(d[i : i + length], digest_size=12).digest()] > 1:
                mark[i] += 1
                mark[i + length] -= 1
        gone = np.cumsum(mark)[: len(d)] > 0
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        yield len(d), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(d, np.uint8)[~gone].tobytes()).hexdigest()


def test_op2(spark, documents):
    want = [(i, *x) for (i, *_), x in zip(documents, removed([t for _, t, _ in documents]), strict=True)]
    assert sorted(map(tuple, queries.op2_substring_dedup(spark, SF).collect())) == want


@pytest.mark.parametrize(("group", "centre"), [(64, 16_384), (2, 3), (1, 1)])
def test_op2_on_patterns(spark, monkeypatch, group, centre):
    """Short periods, overlaps, cuts at both ends; and with every comparison dealt out by blocks, at last by windows."""
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    monkeypatch.setattr(substring_dedup, "CENTRE", centre)
    rng = random.Random(group)
    base = ["".join(rng.choices("abcdefghij klmé", k=rng.randint(150, 900))) for _ in range(5)]
    texts = []
    for _ in range(50):
        b = rng.choice(base)
        x = b[rng.randrange(len(b)) :][: rng.randint(150, 500)]
        texts.append(rng.choice([x, "q" * rng.randint(0, 30) + x + str(rng.random()), "ab" * rng.randint(90, 200), "".join(rng.choices("xyz", k=300)) + x, x + x]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in substring_dedup.repeated_strings(df).collect())
    assert got == [(i, *x) for i, x in enumerate(removed(texts))]


def test_a_family_of_suffix_arrays(spark):
    """Levels double, stand in byte order, and each batch gives what matches since it came."""
    rng = random.Random(8)
    grams = [bytes([rng.randrange(3)]) * 31 + bytes([k]) for k in range(40)]
    family, told, seen = substring_dedup.Family(), set(), collections.Counter()
    for n in range(1, 8):
        rows = [(rng.choice(grams), 1000 * n + k, k, 0, 0, 0) for k in range(8)]
        before = {key for gram, key in seen}
        found = {r.key for r in family.add(spark.createDataFrame(rows, substring_dedup._SUFFIX)).collect()}
        told |= found
        seen.update((r[0], r[1]) for r in rows)
        count = collections.Counter(gram for gram, _ in seen)
        want = {key for gram, key in seen if count[gram] > 1}
        assert want <= told and found <= before | {r[1] for r in rows}
        sizes = [size for size, _ in family.levels]
        assert sum(sizes) == n and sizes == sorted(set(sizes), reverse=True) and all(x & (x - 1) == 0 for x in sizes)
        for size, level in family.levels:
            held = [(r.file, bytes(r.gram), r.key) for r in level.withColumn("file", F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)).collect()]
            assert len(held) == 8 * size and len({x[2] for x in held}) == len(held)
            for file in {x[0] for x in held}:  # byte order within files, and from file to file
                assert [x[1:] for x in held if x[0] == file] == sorted(x[1:] for x in held if x[0] == file)
            assert [x[1:] for x in sorted(held)] == sorted(x[1:] for x in held)


def test_anchors_are_found_in_every_window_and_in_chunks_alike(monkeypatch):
    rng = random.Random(3)
    data = "".join(rng.choices("ab", k=5000)).encode()
    places, first, last = substring_dedup.anchors(data)
    assert first[0] == 0 and last[-1] == len(data) - 200 and (first[1:] == last[:-1] + 1).all()
    assert (places >= last).all() and (places <= first + 168).all()
    monkeypatch.setattr(substring_dedup, "CHUNK", 700)
    assert [x.tolist() for x in substring_dedup.anchors(data)] == [places.tolist(), first.tolist(), last.tolist()]


def test_op3_and_op6(spark, library, documents, encoded):
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    want = [(i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())) for (i, *_), ids in zip(documents, encoded, strict=True)]
    assert sorted(map(tuple, queries.op3_bpe(spark, SF).collect())) == want
    want = [(i, len((t or "").encode()), len(ids), len(ids) > 1024) for (i, t, _), ids in zip(documents, encoded, strict=True)]
    assert sorted(map(tuple, queries.op6_token_count(spark, SF).collect())) == want


def test_bpe_on_odd_texts(library):
    rng = random.Random(1)
    parts = ["a", "é", "'s", "'ll", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "1", "²", "<|endoftext|>", "<|endof", "漢", "😀", "\0", " ", ".", "!!", "_", "Z", "the", "\r\n", "ǅ", "́", "�"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(5000)]
    own = bpe.encoder(PATH)
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(t).tolist() == e.ids
        assert own.decode(own.encode(t)) == library.decode(e.ids, skip_special_tokens=False)
    raw = np.array([e for e in range(0, 50257, 17)], np.uint32)
    assert own.decode(raw) == library.decode(raw.tolist(), skip_special_tokens=False)


def test_forced_boundaries(library):
    own = bpe.encoder(PATH)
    assert b"".join(own.fragments(" naïvety—Übermaß".encode())) == " naïvety—Übermaß".encode()
    assert all(own.inside[a, b] for f in own.fragments(" naïvety—Übermaß".encode()) for a, b in zip(f, f[1:], strict=False))
    assert not own.inside[ord("q"), ord("\n")]


def test_a_full_memo_changes_nothing(library, documents):
    texts = [t for _, t, _ in documents] + ["x" * 500, "ab" * 40 + " c" * 300, "漢" * 70, None, "", " ", "a <|endoftext|>b"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for memo in (2, 50, 3000):
        own = bpe.ForcedBoundaryBPE(PATH, memo)
        for at in range(0, len(texts), 17):
            some = texts[at : at + 17]
            ids, ends = own.encode_all(some)
            assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == want[at : at + 17]
            assert own.counts(some).tolist() == list(map(len, want[at : at + 17]))


def test_merges_are_the_models(library):
    rng = random.Random(4)
    own, shown = bpe.encoder(PATH), bpe.byte_alphabet()
    words = [bytes(rng.choices(b"aabcehinorst ", k=rng.randint(1, merges.LONGEST))) for _ in range(3000)] + [b"a" * n for n in range(1, merges.LONGEST + 1)]
    want = [[t.id for t in library.model.tokenize("".join(shown[b] for b in w))] for w in words]
    lengths = np.array(list(map(len, words)))
    starts = np.cumsum(lengths) - lengths
    out = own._merges(own._byte_ids[np.frombuffer(b"".join(words), np.uint8)], starts, lengths)
    assert [[x for x in out[a : a + n].tolist() if x >= 0] for a, n in zip(starts, lengths, strict=True)] == want


def test_chunks_resynchronise(library, documents):
    rng = random.Random(3)
    parts = ["a", "é", "'s", " ", "  ", "\n", "<|endoftext|>", "漢字", "😀", "1", "the", " word", "\t"]
    texts = ["".join(rng.choices(parts, k=rng.randint(50, 400))) for _ in range(100)]
    texts += ["x" * 3000, "ab " * 900, " " * 3000, *(t for _, t, _ in documents[:20] if len(t) > 300)]
    for t in texts:
        n = len(library.encode(t, add_special_tokens=False).ids)
        for chunk, overlap in ((64, 8), (100, 1), (300, 40)):
            assert len(t) <= chunk or token_count.count_in_chunks(library, t, chunk, overlap) == n


def cheapest(roles):
    best = chat.FAR

    def go(k, s, cost):
        nonlocal best
        if cost >= best:
            return
        if k == len(roles):
            best = min(best, cost + chat.ending(s))
            return
        for t in (chat.SYSTEM, chat.USER, chat.ASSISTANT):
            change = 0 if t == roles[k] else chat.NAME if roles[k] is None else chat.RELABEL
            if s == t:
                go(k + 1, t, cost + change + chat.MERGE)
            states = [s]
            for n in range(3):
                if any(t in chat.FOLLOWS[q] for q in states):
                    go(k + 1, t, cost + change + chat.INSERT * n)
                states = [u for q in states for u in chat.FOLLOWS[q]]

    go(0, chat.START, 0)
    return best


def cut_in(roles, cuts):
    """The rendered turns of roles, repaired in runs that end at the cuts."""
    runs = [roles[a:b] for a, b in zip([0, *cuts], [*cuts, len(roles)], strict=True)]
    found = chat.borders([functools.reduce(chat.joined, (chat.SINGLE[r] for r in run)) for run in runs])
    return [x for run, border in zip(runs, found, strict=True) for x in chat.render(run, ["t"] * len(run), chat.Border.of(border.packed()))]


def test_chat_repairs_are_legal_and_cheapest_however_they_are_cut():
    rng = random.Random(2)
    for _ in range(600):
        roles = [rng.choice([None, 1, 2, 3]) for _ in range(rng.randint(1, 7))]
        turns = list(chat.render(roles, ["t"] * len(roles), chat.whole(roles)))
        said = re.findall(r"<\|im_start\|>(\w)\w*\n", "".join(x[-1] for x in turns))
        assert re.fullmatch("s?(ua)+", "".join(said))
        assert len(roles) > 5 or sum(x[3] for x in turns) == cheapest(roles)
        for n in range(len(roles)):
            for cuts in itertools.combinations(range(1, len(roles)), n):
                assert cut_in(roles, cuts) == turns
        whole = functools.reduce(chat.joined, (chat.SINGLE[r] for r in roles))
        for k in range(1, len(roles)):
            halves = (functools.reduce(chat.joined, (chat.SINGLE[r] for r in part)) for part in (roles[:k], roles[k:]))
            both = chat.joined(*halves)
            assert both[0] == whole[0] and all(x == y for s, row in enumerate(whole[1]) for t, (x, y) in enumerate(zip(row, both[1][s], strict=True)) if whole[0][s][t] < chat.FAR and all(whole[0][q][t] < chat.FAR for q in range(4)))


def chats(turns):
    """Rows of format_chats by brute force: (conv_id, turn, role, action, inserted, cost, segment), in any order."""
    by = collections.defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append((turn, role, text))
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0], r[1] is not None, r[1] or ""))
        roles = [chat.role_of(r) for _, r, _ in rows]
        for (turn, _, _), x in zip(rows, chat.render(roles, [t for *_, t in rows], chat.whole(roles)), strict=True):
            yield (conv, turn, *x)


def test_op5_over_partitions(spark):
    """A conversation that spans all partitions among short ones: the same rows however they are cut."""
    rng = random.Random(5)
    turns = [(c, k, rng.choice(["user", "assistant", "system", "human", None]), f"t{k}") for c in range(8) for k in range(400 if c == 3 else rng.randint(1, 4))]
    want = sorted(chats(turns))
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for n in (1, 7, 211):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        assert sorted(map(tuple, chat.format_chats(df.repartition(3)).collect())) == want
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_op5_ties_do_not_depend_on_partitions(spark):
    """Repeated turns and roles, and repeated rows: (turn, role, text) decide, wherever rows stand."""
    rng = random.Random(6)
    turns = [(1, rng.randrange(5), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "c", "d"])) for _ in range(300)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = []
    for n in (1, 7, 50):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append("".join(r.segment for r in chat.format_chats(df.repartition(n)).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0] == found[1] == found[2]


def test_op5(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert len({(c, t) for c, t, *_ in turns}) == len(turns)
    assert sorted(map(tuple, queries.op5_chat_format(spark, SF).collect())) == sorted(chats(turns))


def classes(texts, ids):
    """Smallest reachable id by brute force."""
    sets = [shingles(t) for t in texts]
    up = list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [ids[find(i)] for i in range(len(ids))], [len(s) for s in sets]


def test_op8_chains_and_families(spark):
    """Chains of drifting copies, families around the threshold, and short texts."""
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(500)]
    texts = [None, "", "a b", "a b", "A  b", "c"]
    for size in (6, 12, 40, 120):
        base = rng.choices(vocabulary, k=size)
        for _ in range(25):
            new = list(base)
            for _ in range(max(1, round(size * rng.choice([0.01, 0.02, 0.03])))):
                new[rng.randrange(size)] = rng.choice(vocabulary)
            texts.append(" ".join(new))
            if rng.random() < 0.5:
                base = new
    rng.shuffle(texts)
    want, sizes = classes(texts, list(range(len(texts))))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.component_id, r.n_shingles, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(i, c, n, i == c) for i, (c, n) in enumerate(zip(want, sizes, strict=True))]


def test_signatures_find_pairs_at_the_threshold():
    rng = random.Random(5)
    missed = found = 0
    for n in (6, 8, 12, 20, 40, 100, 400):
        for _ in range(60):
            w = [f"w{rng.randrange(3000)}" for _ in range(n)]
            x = list(w)
            for _ in range(rng.randint(1, max(1, n // 30))):
                x[rng.randrange(len(x))] = f"z{rng.random()}"
            a, b = minhash.shingle_set(" ".join(w)), minhash.shingle_set(" ".join(x))
            if minhash.linked(a, b):
                found += 1
                missed += not (minhash.band_keys(minhash.signature(a)) == minhash.band_keys(minhash.signature(b))).any()
    assert found > 100 and missed == 0


def test_op10_held_out_accuracy(spark, documents):
    lang = {i: x for i, _, x in documents}
    rows = queries.op10_language_id(spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(documents) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = con.execute(queries.ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in found.fetchall())


def test_pipeline(spark, library, documents):
    """All stages by brute force: language, exact copies, near copies, benchmark windows, ids."""
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    left = [(i, t) for i, t, _ in documents if t and any(c.isalpha() for c in t)]
    seen, kept = set(), []
    for i, t in left:
        k = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        if k not in seen:
            seen.add(k)
            kept.append((i, t))
    root, _ = classes([t for _, t in kept], [i for i, _ in kept])
    kept = [(i, t) for (i, t), c in zip(kept, root, strict=True) if i == c]
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    bench = set()
    for (t,) in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect():
        w = word(t)
        bench |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    clean = lambda t: not any(tuple(w[k : k + n]) in bench for w in [word(t)] for n in {len(b) for b in bench} for k in range(len(w) - n + 1))
    want = {i: t for i, t in kept if clean(t)}
    assert set(got) == set(want)
    for i, t in want.items():
        assert got[i].ids == library.encode(t, add_special_tokens=False).ids and got[i].round_trip
