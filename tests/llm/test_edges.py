"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark import RDD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexiquarry.llm import bpe, chat, decontaminate, exact_dedup, language_id, minhash, substring_dedup, token_count, warc, wavelet
from lexiquarry.llm.common import kept, prepare, shared_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
LONG = "Wer das liest, ist klug und froh. " * 20_000
#: Columns beside doc_id and text carry names that the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, seq long, key long, n long, kept boolean"


def rows(*pairs):
    return [(i, t, "de", 1, 2, 3, True) for i, t in pairs]


EDGES = rows((1, None), (2, ""), (3, " \n\t"), (4, "a"), (4, "a"), (None, "a"), (None, None), (5, "!!! 123"), (6, LONG), (7, LONG), (8, "one two three four five six"), (8, "other words with the same id here"))


@pytest.fixture(scope="module")
def edges(spark):
    prepare(spark)
    return spark.createDataFrame(EDGES, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def key(r):
    return tuple((x is not None, x) for x in r)


def test_wavelet(spark, edges, none, library):
    for docs, n in ((edges, len(EDGES)), (none, 0)):
        path = shared_path(spark, "shards")
        wavelet.write_shards(docs, path, PATH, 2, shard_tokens=1000)
        got = wavelet.read_shards(spark, path).collect()
        assert len(got) == n
        crc = lambda t: zlib.crc32(np.array([*ids_of(library, t), 2], "<u4").tobytes())
        assert sorted((key((r.doc_id, r.ids_crc32)) for r in got)) == sorted(key((i, crc(t))) for i, t, *_ in docs.collect())
        at = 0
        for r in sorted(got, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        assert [r.doc_id or 0 for r in sorted(got, key=lambda r: r.start)] == sorted(r.doc_id or 0 for r in got)


def test_a_broken_shard_is_told():
    raw = wavelet.pack([1], [3], np.array([1, 2, 3], np.uint32)) + wavelet.CLOSE.encode()
    assert wavelet.unpack(raw)[2].tokens().tolist() == [1, 2, 3]
    for bad in (raw[:-3], b"x" + raw[1:]):
        with pytest.raises(ValueError):
            wavelet.unpack(bad)


@pytest.mark.parametrize(("n", "most"), [(0, 5), (1, 0), (700, 1), (3000, 9), (3000, 70_000)])
def test_wavelet_matrix(n, most):
    x = np.random.default_rng(n + most).integers(0, most + 1, n).astype(np.uint32)
    m = wavelet.WaveletMatrix.of(x)
    assert (m.tokens() == x).all()
    for i in range(0, n, 61):
        v = int(x[i])
        assert m.access(i) == v
        assert m.rank(v, i) == (x[:i] == v).sum()
        assert m.occurrences(v) == np.flatnonzero(x == v).tolist()
    assert m.count(most + 1) == 0
    with pytest.raises(IndexError):
        m.select(most + 1, 0)


def test_substrings(edges, none):
    got = substring_dedup.repeated_strings(edges).collect()
    assert len(got) == len(EDGES)
    size = len(LONG.encode())
    for r in got:
        if r.doc_id in (6, 7):
            assert (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) == (size, size, 1, hashlib.sha256(b"").hexdigest())
        else:
            assert r.n_removed == 0
    assert substring_dedup.repeated_strings(none).count() == 0


def test_bpe(edges, none, library):
    for r in bpe.bpe_round_trip(edges, PATH).collect():
        assert r.ids == ids_of(library, r.decoded)
    assert sorted(r.decoded for r in bpe.bpe_round_trip(edges, PATH).collect()) == sorted(t or "" for _, t, *_ in EDGES)
    assert {(r.doc_id, r.n_tokens) for r in bpe.bpe_digests(edges, PATH).collect()} == {(i, len(ids_of(library, t))) for i, t, *_ in EDGES}
    assert bpe.bpe_digests(none, PATH).count() == 0
    assert all(r.round_trip for r in bpe.encoded(edges, PATH, keep=("lang", "n")).collect())


def test_unsupported_tokenizers_are_told():
    with pytest.raises(ValueError):
        bpe.ForcedBoundaryBPE(public_tokenizers.path("word_bpe_49k.json"))


def test_warc(spark, tmp_path):
    pages = [(1, "http://a/ b\r\nX: y", None, 1), (2, None, "short", 1), (3, "u", "short", 1), (9, "u", "x" * 100, 1), (5, "u", "x" * 100, 1), (5, "u", "x" * 100, 1), (None, "u", "x" * 100, 1), (None, "u", "y" * 200, 1), (None, "u", "y" * 200, 1), (7, "ü", "é漢\r\n\r\n" * 50_000, 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, size long").repartition(2)
    path = shared_path(spark, "archives")
    warc.write_archives(df, path, archive_bytes=300)
    got = warc.read_archives(spark, path).collect()
    assert sorted(key((r.page_id, r.payload_bytes, r.record_type, r.refers_to)) for r in got) == sorted(
        key(x) for x in [(1, 0, "response", None), (2, 5, "response", None), (3, 5, "response", None), (9, 100, "revisit", 5), (5, 100, "response", None), (5, 100, "response", None),
                         (None, 100, "revisit", 5), (None, 200, "response", None), (None, 200, "response", None), (7, 450_000, "response", None)]
    )
    assert {bytes(r.payload) for r in got if r.page_id == 7} == {("é漢\r\n\r\n" * 50_000).encode()}
    path = shared_path(spark, "archives")
    warc.write_archives(df.filter("false"), path)
    assert warc.read_archives(spark, path).count() == 0


def test_broken_archives_are_told():
    import struct

    import zstandard

    coder = zstandard.ZstdCompressor(write_checksum=True)
    good = warc.record("1", "u", b"abc", 3, hashlib.sha256(b"abc").hexdigest(), None)
    frame = coder.compress(good)
    gap = warc.SEPARATOR.encode()
    assert [warc.parse(r)[0] for r in warc.records(frame + gap + frame + gap)] == ["1", "1"]
    dictionary = b"HTTP/1.1 200 OK\r\nContent-Type" * 4
    packed = zstandard.ZstdCompressor().compress(dictionary)  # the dictionary may be compressed itself
    made = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).compress(good)
    for held in (dictionary, packed):
        assert list(warc.records(struct.pack("<II", warc.DICT_MAGIC, len(held)) + held + made)) == [good]
    for bad in (frame[:-6], frame + b"junkjunk", frame + b"x"):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.records(bad))
    for raw in (good[:-1], good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"abc", b"abd"), good.replace(b"WARC-Type", b"WARC-Tipe"), good.replace(b"Content-Length: 3", b"Content-Length: 4"), b""):
        with pytest.raises(ValueError):
            warc.parse(raw)


def test_chat(spark):
    turns = [(1, None, None, None), (1, 0, "user", "hi <|im_end|>"), (1, 0, "user", "hi <|im_end|>"), (None, 0, "assistant", ""), (None, 1, "nobody", "x"), (2, 0, "system", "s"), (3, 5, "user", LONG)]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, cost long")
    got = chat.format_chats(df).collect()
    assert len(got) == len(turns)
    by = {}
    for r in sorted(got, key=lambda r: (r.conv_id or 0, -1 if r.turn is None else r.turn)):
        by[r.conv_id] = by.get(r.conv_id, "") + r.segment
    assert by[2] == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert by[3] == f"<|im_start|>user\n{LONG}<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert by[1].count("<|im_end|>") == by[1].count("<|im_start|>")
    assert chat.format_chats(df.filter("false")).count() == 0


def test_token_count(edges, none, library):
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_count.count_tokens(edges, PATH).collect()}
    assert got == {(i, len((t or "").encode()), (n := len(ids_of(library, t))), n > 1024) for i, t, *_ in EDGES}
    assert token_count.count_tokens(none, PATH).count() == 0


def test_token_count_of_other_files(spark):
    import sentencepiece

    docs = spark.createDataFrame([(1, "Hello wörld"), (2, None)], "doc_id long, text string")
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: r.n_tokens for r in token_count.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()} == {1: len(model.encode("Hello wörld")), 2: 0}
    other = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert token_count.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).filter("doc_id = 1").first().n_tokens == len(other.encode("Hello wörld", add_special_tokens=False).ids)


def test_exact(edges, none):
    got = exact_dedup.exact_dedup(edges, counters=2).collect()
    assert len(got) == len(EDGES)
    by = {}
    for r in got:
        by.setdefault(r.text_sha256, []).append(r)
    assert all(len(g) == g[0].group_size and sum(r.kept for r in g) == 1 for g in by.values())
    a = by[hashlib.sha256(b"a").hexdigest()]
    assert [r.keep_id for r in a] == [4, 4, 4] and {r.kept for r in a if r.doc_id is None} == {False}
    assert len(by[hashlib.sha256(b" ").hexdigest()]) == 1
    kept = exact_dedup.keep_first(edges)
    assert kept.columns == edges.columns
    assert kept.count() == len(by)
    assert exact_dedup.exact_dedup(none).count() == 0


def test_misra_gries_names_every_frequent_value(spark):
    values = [f"v{k % 7}" for k in range(7000)] + ["hot"] * 3000 + [f"once{k}" for k in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    found = {r[0] for r in exact_dedup.frequent(df, "v", 20).collect()}
    assert {"hot", *(f"v{k}" for k in range(7))} <= found and len(found) <= 20


def test_near(edges, none):
    got = minhash.near_duplicates(edges).collect()
    assert len(got) == len(EDGES)
    for r in got:
        want = {4: 4, 6: 6, 7: 6}.get(r.doc_id, r.doc_id)
        if r.n_shingles and r.doc_id is not None and r.doc_id != 8:
            assert r.component_id == want
        if not r.n_shingles:
            assert r.component_id == r.doc_id and r.kept
    assert [r.component_id for r in got if r.doc_id is None and r.n_shingles] == [4]
    assert minhash.near_duplicates(none).count() == 0
    kept = minhash.keep_first(edges)
    assert kept.columns == edges.columns
    assert kept.filter("doc_id in (6, 7)").count() == 1 and kept.filter("text = 'a'").count() == 1


def test_decontaminate(spark, edges, none):
    items = spark.createDataFrame([("b", "Das liest, IST klug und froh. Wer das liest: ist klug!", 1), ("b", None, 1), (None, "one two three", 1), ("a", "1-2-3", 1), ("c", "", 1)], "item_id string, text string, seq long")
    for size in (10**6, 20):  # in one block and in many
        got = {(r.doc_id, r.n_words): r for r in decontaminate.decontaminate(edges, items, block_bytes=size).collect()}
        assert list(got[8, 6]["items"]) == ["null"] and [tuple(x) for x in got[8, 6].runs] == [(0, 3)] and [tuple(x) for x in got[8, 6].spans] == [(0, 13)]
        long = next(r for r in got.values() if r.doc_id == 6)
        assert list(long["items"]) == ["b"]
        assert long.n_words == 7 * 20_000
        assert [tuple(x) for x in long.runs] == [(1, 7 * 19_998 + 12)]
        assert decontaminate.keep_clean(edges, items, block_bytes=size).filter("doc_id in (6, 7) or text like 'one two%'").count() == 0
    found = decontaminate.digests(decontaminate.decontaminate(edges, items.filter("false"))).collect()
    assert len(found) == len(EDGES) and not any(r.contaminated for r in found)
    assert decontaminate.decontaminate(none, items).count() == 0


def test_language(spark, edges, none):
    train = spark.createDataFrame([(k, f"the house and the dog {k}", "en") for k in range(40)] + [(k, f"das Haus und der Hund {k}", "de") for k in range(40)] + [(99, None, "xx"), (98, "nix", None)], "doc_id long, text string, lang string")
    model = language_id.fit(train)
    assert model.langs == ["de", "en"]
    assert model.predict("The dog")[0] == "en" and model.predict("hundehaus")[0] == "de"
    assert model.predict("漢字") == ("de", 0.5)
    got = language_id.identify(edges, model).collect()
    assert len(got) == len(EDGES)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 5)} == {"und"}
    kept = language_id.keep_known(edges, model)
    assert kept.columns == edges.columns and kept.filter("doc_id = 5").count() == 0
    empty = language_id.fit(none)
    assert {r.lang_pred for r in language_id.identify(edges, empty).collect()} == {"und"}
    assert language_id.identify(none, model).count() == 0


def test_one_language_keeps_what_it_knows(spark):
    train = spark.createDataFrame([(k, f"the house and the dog {k}", "en") for k in range(40)], "doc_id long, text string, lang string")
    model = language_id.fit(train)
    assert model.langs == ["en"] and model.predict("The dog") == ("en", 1.0) and model.predict("漢字") == ("en", 1.0)
    docs = spark.createDataFrame([(1, "The dog"), (2, "dogs"), (3, "漢字"), (4, "12 !"), (5, ""), (6, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in language_id.keep_known(docs, model).collect()) == [1, 2]
    assert language_id.keep_known(train, model).count() == 40


def test_every_label_is_learned(spark):
    name = lambda k: "".join(chr(97 + int(c)) for c in f"{k:03}")
    rows = [(2 * k + i, f"{name(k)}q {name(k)}q", f"l{k:03}") for k in range(300) for i in range(2)] + [(9_000, "zzz zzz", "rare")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.langs) == 301
    assert model.predict("zzz")[0] == "rare" and model.predict(f"{name(299)}q")[0] == "l299"


def test_held_out_rows_are_the_contract_s(spark):
    ids = spark.range(300).select("id", language_id.held_out(F.col("id")).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in ids.collect())


def test_decontamination_for_any_size_of_block(spark):
    """Items that overlap each other, and short ones: the same rows, spans too, however the benchmark is dealt."""
    prepare(spark)
    word = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(word[k : k + 14])) for k in range(0, 46, 4)] + [(100, "w1, W2!"), (101, None), (102, "w59"), (103, "...")]
    items = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(1, " -- ".join(word)), (2, "x w1 w2 y w59"), (3, None), (4, "nothing"), (5, ". ".join(word[5:16]))], "doc_id long, text string")
    want = sorted(map(repr, decontaminate.decontaminate(docs, items).collect()))
    assert any("start=0, end=392" in r for r in want)
    for size in (100, 300):
        assert sorted(map(repr, decontaminate.decontaminate(docs, items, block_bytes=size).collect())) == want
        assert sorted(r.doc_id for r in decontaminate.keep_clean(docs, items, block_bytes=size).collect()) == [3, 4]


def test_a_written_shard_answers_without_being_inflated(spark, monkeypatch, library):
    """Access, count and occurrences on the file, with frames of 1,024 bits."""
    prepare(spark)
    monkeypatch.setattr(wavelet, "FRAME", 1024)
    rng = np.random.default_rng(4)
    x = rng.integers(0, 5000, 200_000).astype(np.uint32)
    x[rng.integers(0, len(x), 300)] = 4321
    raw = wavelet.pack([7], [len(x)], x) + wavelet.CLOSE.encode()
    *_, m = wavelet.unpack(raw)
    assert sum(p.inflated for p in m.planes) == 0
    at = int(np.flatnonzero(x == 4321)[5])
    assert m.access(at) == 4321 and m.rank(4321, at) == 5 and m.select(4321, 5) == at
    assert sum(p.inflated for p in m.planes) <= 8 * m.bits < sum(len(p.frames) for p in m.planes) / 8
    assert m.count(4321) == (x == 4321).sum() and m.occurrences(4321) == np.flatnonzero(x == 4321).tolist()
    assert m.count(5001) == 0 and (m.tokens() == x).all()
    monkeypatch.undo()

    docs = spark.createDataFrame([(k, f"some text number {k} " * 40) for k in range(30)], "doc_id long, text string")
    path = shared_path(spark, "shards")
    wavelet.write_shards(docs, path, PATH, 2, shard_tokens=700)
    for r in wavelet.shard_files(spark, path).collect():
        doc_ids, lengths, m = wavelet.unpack(bytes(r.content))
        ids = [i for d in doc_ids for i in [*ids_of(library, f"some text number {d} " * 40), 2]]
        assert lengths.sum() == len(ids) and m.count(2) == len(doc_ids)
        assert m.occurrences(2) == [k for k, i in enumerate(ids) if i == 2] and m.access(len(ids) // 2) == ids[len(ids) // 2]


def test_starts_follow_numbers_not_names(spark, monkeypatch):
    prepare(spark)
    names = ["s999999-999999", "s999999-1000000", "s1000000-000000", "s1000000-000001"]
    blobs = [(name, wavelet.pack([k], [k + 1], np.full(k + 1, 9, np.uint32))) for k, name in enumerate(names)]
    path = shared_path(spark, "shards")
    df = spark.createDataFrame(blobs, "shard string, blob binary")
    df.select("shard", F.col("blob").cast("string").alias("value")).write.partitionBy("shard").option("lineSep", wavelet.CLOSE).text(path)
    for tasks in (1024, 1):
        monkeypatch.setattr(wavelet, "TASKS", tasks)
        assert sorted((r.doc_id, r.start, r.n_tokens) for r in wavelet.read_shards(spark, path).collect()) == [(0, 0, 1), (1, 1, 2), (2, 3, 3), (3, 6, 4)]


def test_warc_records_of_other_writers():
    """Records of other types are passed over, foreign digests handed on; lengths are checked all the same."""
    make = lambda kind, block, *more: "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:x>", "WARC-Date: 2020-01-01T00:00:00Z", *more, f"Content-Length: {len(block)}", "", block, "", ""]).encode()
    http = "HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\n"
    for kind in ("warcinfo", "request", "metadata"):
        assert warc.parse(make(kind, "software: x")) is None
        with pytest.raises(ValueError):
            warc.parse(make(kind, "software: x")[:-1])
    assert warc.parse(make("response", http + "ok", "WARC-Payload-Digest: sha1:ABC"))[2:] == (2, "sha1:ABC", "response", None, b"ok")
    assert warc.parse(make("revisit", http, "WARC-Payload-Digest: sha1:ABC"))[2:] == (2, "sha1:ABC", "revisit", None, None)


@pytest.mark.parametrize("module", [exact_dedup, minhash])
def test_columns_that_have_the_names_of_helpers(spark, module):
    """Own columns stay, whatever they are called, with ids that repeat and without."""
    prepare(spark)
    names = ["gone", "row_key", "_row", "_sha", "gone_id", "seq", "comp", "bucket"]
    text = "one two three four five six seven"
    for ids, left in (((1, 2, 3), [1, 3]), ((2, 2, 1), [1, 2])):
        texts = (text, text, "another text with other words in it") if ids[0] == 1 else (text, "another text with other words in it", text)
        docs = spark.createDataFrame([(i, t, *range(len(names))) for i, t in zip(ids, texts, strict=True)], ["doc_id", "text", *names])
        kept = module.keep_first(docs)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == left
        assert all(tuple(r)[2:] == tuple(range(len(names))) for r in kept.collect())


def test_pipeline_stages_on_edges(spark, edges, none):
    """Every stage takes nulls, repeated ids, other columns and no rows; all but the last keep the columns."""
    import corpus_pipeline

    for docs in (edges, none):
        docs = docs.withColumn("source", F.lit("s"))
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert name == "bpe" or sorted(out.columns) == sorted(docs.columns)
            assert docs is not none or out.count() == 0
            out.count()


def test_language_id_is_fitted_without_rows_of_python(spark, monkeypatch):
    train = spark.createDataFrame([(k, text, lang) for k in range(30) for text, lang in ((f"the house {k}", "en"), (f"das Haus {k}", "de"))], "doc_id long, text string, lang string")

    def refused(self):
        raise AssertionError("Python workers of another kind are started, beside those of the Arrow functions")

    monkeypatch.setattr(RDD, "_to_java_object_rdd", refused)
    model = language_id.fit(train, sample_docs=10_000)
    assert (model.langs, model.predict("the house")[0], model.predict("das Haus")[0]) == (["de", "en"], "en", "de")


def test_a_worker_keeps_what_one_stage_needs():
    gone = weakref.ref(bpe.encoder(PATH, 1_000))
    assert bpe.encoder(PATH, 1_000) is gone()
    built = kept(decontaminate.automaton, (("a", "one two three"),), 10)
    assert gone() is None
    assert kept(decontaminate.automaton, (("a", "one two three"),), 10) is built
    gone = weakref.ref(bpe.encoder(PATH, 1_000))
    list(minhash._signatures(iter(())))
    assert gone() is None
