"""Byte-level BPE with forced-boundary splitting, and decoding.

A byte pair that occurs inside no vocabulary token can never be merged over: wherever it stands, a token ends. Each
word of the tokenizer's own pre-tokenisation is cut at all such pairs; the fragments are encoded independently by the
tokenizer file's merges and their ids concatenated, which gives the ids of the uncut word, because every merge builds a
vocabulary token and so lies within one fragment. The new words of a batch of texts are cut and merged together, as
array operations (`merges`); fragments longer than those take go through the library's model. A bounded memo holds the
ids of pieces that came before.

Before that a text is cut where a space or line feed follows a character that is no white space: the
byte-level pattern has no look-behind and no alternative that goes on from such a character into white space, so these
cuts are certain too. A text in which that is not plain (a piece ends in white space) is cut more slowly, only where
it is certain.

Added tokens in a text are found as the library does by default. Supported are byte-level BPE files whose added tokens
have plain flags and no white space; others raise ValueError.

Nulls: a null text counts as empty; empty texts have no tokens. Texts of any length are encoded whole. Memory is
bounded by the batch of texts in hand and the memo's size.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.common import kept
from lexiquarry.llm.merges import LONGEST, Merges

#: Pieces kept in the memo, of some 180 bytes each: 75 MB in a Python worker. Twice as many are not faster.
MEMO = 400_000
#: Longest piece that is kept, in characters; pieces that are encoded at a time; values that are copied at a time.
KEPT, TOGETHER, COPIED = 64, 1 << 16, 1 << 20

#: The byte-level pattern of this kind of vocabulary, in the library's order.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters whose classes all versions of Unicode agree on.
_PLAIN = re.compile(r"[\n -~À-ÖØ-öø-ɏ]*")
#: One word of letters for certain, perhaps with white space before it that the letter ends, or a mark of its own after it.
_LETTERS = re.compile(r"(\n(?! ))?( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:])?")


def byte_alphabet() -> dict[int, str]:
    """Byte to printable character: bytes that print stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs values[start : start + length], one after the other."""
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, values.dtype)
    a = done = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, done + COPIED, side="right")))
        n = int(ends[b - 1]) - done
        if b == a + 1:
            out[done : done + n] = values[starts[a] : starts[a] + n]
        else:
            shift = starts[a:b] - (ends[a:b] - lengths[a:b])
            out[done : done + n] = values[np.repeat(shift, lengths[a:b]) + np.arange(done, done + n)]
        a, done = b, done + n
    return out


class _Memo(dict):
    """Numbers of pieces, whose ids stand in one array; what it lacks is noted, to be encoded with others."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.update({"": 0})
        self.new: list[str] = []
        self.known = 1
        self.uncertain = False
        self.starts, self.lengths, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.n_ids = np.zeros(4096, "<u4"), 0

    def __missing__(self, piece: str) -> int:
        new = self.new
        k = self.known + len(new)
        new.append(piece)
        if piece[-1].isspace():
            self.uncertain = True
        elif len(piece) <= KEPT:
            self[piece] = k
        return k

    def put(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The ids of the first of the noted pieces."""
        a, b = self.known, self.known + len(lengths)
        for name in ("starts", "lengths", "used"):
            setattr(self, name, _room(getattr(self, name), b))
        self.ids = _room(self.ids, self.n_ids + len(ids))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.lengths[a:b] = lengths
        self.starts[a:b] = self.n_ids + np.cumsum(lengths) - lengths
        self.used[a:b] = 0
        self.known, self.n_ids = b, self.n_ids + len(ids)
        del self.new[: len(lengths)]

    def trim(self) -> None:
        """Where there is too much, keep the half that was used most, the latest of those used equally."""
        if self.known <= self.most and self.n_ids <= 8 * self.most:
            return
        pieces = list(self)
        numbers = np.fromiter(self.values(), np.int64, len(self))
        best = np.lexsort((numbers, self.used[numbers]))[::-1][: self.most // 2]
        best = best[np.cumsum(self.lengths[numbers[best]]) <= 4 * self.most]
        best = best[numbers[best] > 0]
        numbers, pieces = numbers[best], [pieces[k] for k in best.tolist()]
        lengths, used = self.lengths[numbers], self.used[numbers]
        ids = gather(self.ids, self.starts[numbers], lengths)
        self._empty()
        self.update(zip(pieces, range(1, len(pieces) + 1), strict=True))
        self.put(ids, lengths)
        self.used[1 : self.known] = used // 2


def _room(values: np.ndarray, n: int) -> np.ndarray:
    """values with room for n of them."""
    if n <= len(values):
        return values
    out = np.zeros(max(n, len(values) * 3 // 2), values.dtype)
    out[: len(values)] = values
    return out


class ForcedBoundaryBPE:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, path: str, memo: int = MEMO):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        spec = json.loads(self.library.to_str())
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre["use_regex"]:
            raise ValueError(f"{path}: a byte-level BPE file is needed")
        if spec["normalizer"] or model["dropout"] or model["ignore_merges"] or model["continuing_subword_prefix"] or model["end_of_word_suffix"]:
            raise ValueError(f"{path}: normalizers, dropout, ignored merges and marked words are not supported")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added):
            raise ValueError(f"{path}: added tokens with flags or white space are not supported")
        alphabet = byte_alphabet()
        back = {c: b for b, c in alphabet.items()}
        if not back.keys() <= model["vocab"].keys():
            raise ValueError(f"{path}: a token for every byte is needed")
        size = max([*model["vocab"].values(), *(t["id"] for t in added)]) + 1
        self.bytes_of = [b""] * size
        inside = np.zeros((256, 256), bool)
        for token, k in model["vocab"].items():
            raw = bytes(back[c] for c in token)
            self.bytes_of[k] = raw
            codes = np.frombuffer(raw, np.uint8)
            inside[codes[:-1], codes[1:]] = True
        for t in added:
            self.bytes_of[t["id"]] = t["content"].encode()
        #: inside[a, b]: some vocabulary token holds byte a followed by byte b.
        self.inside = inside
        #: Of each token, where its bytes stand.
        self._raw = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._raw_lengths = np.array([len(x) for x in self.bytes_of], np.int64)
        self._raw_starts = np.cumsum(self._raw_lengths) - self._raw_lengths
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._merges = Merges(np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int64).reshape(-1, 3), size)
        self._byte_ids = np.array([vocab[alphabet[b]] for b in range(256)], np.int32)
        #: Whether an added token may stand within a word of letters.
        self._lettered = any(t["content"].isalpha() for t in added)
        self._shown = str.maketrans({chr(b): c for b, c in alphabet.items()})
        self._hidden = str.maketrans({c: chr(b) for b, c in alphabet.items()})
        self._special = re.compile("|".join(map(re.escape, sorted((t["content"] for t in added), key=len, reverse=True)))) if added else None
        self._special_id = {t["content"]: t["id"] for t in added}
        self._words = regex.compile(WORDS)
        self._memo = _Memo(memo)

    def fragments(self, word: bytes) -> list[bytes]:
        """word, cut at every byte pair that no vocabulary token holds."""
        codes = np.frombuffer(word, np.uint8)
        cuts = (np.flatnonzero(~self.inside[codes[:-1], codes[1:]]) + 1).tolist()
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)] if word else []

    def _split(self, text: str) -> list[bytes]:
        """The words of a text without added tokens."""
        if _PLAIN.fullmatch(text):
            return [w.encode() for w in self._words.findall(text)]
        return [w.translate(self._hidden).encode("latin-1") for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that begin and end at certain boundaries, and how many each has."""
        words: list[bytes] = []
        ends, special = [], {}
        letters, add = _LETTERS.fullmatch, words.append
        for piece in pieces:
            found = None if self._lettered else letters(piece)
            if found:  # one word, perhaps between marks
                before, word, after = found.groups()
                if before:
                    add(b"\n")
                add(word.encode())
                if after:
                    add(after.encode())
            elif not self._special or not self._special.search(piece):
                words += self._split(piece)
            else:
                at = 0
                for m in self._special.finditer(piece):
                    words += self._split(piece[at : m.start()])
                    special[len(words)] = self._special_id[m[0]]
                    add(b"\0")  # its id is put here
                    at = m.end()
                words += self._split(piece[at:])
            ends.append(len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths)
        codes = np.frombuffer(b"".join(words), np.uint8)
        ids = self._byte_ids[codes]
        begins = np.ones(len(codes), bool)
        begins[1:] = ~self.inside[codes[:-1], codes[1:]]
        begins[stops[:-1]] = True
        starts = np.flatnonzero(begins)
        sizes = np.diff(starts, append=len(codes))
        ids = self._merges(ids, starts, sizes)
        for k in np.flatnonzero(sizes > LONGEST).tolist():
            a, n = int(starts[k]), int(sizes[k])
            merged = [t.id for t in self.library.model.tokenize(codes[a : a + n].tobytes().decode("latin-1").translate(self._shown))]
            ids[a : a + n] = -1
            ids[a : a + len(merged)] = merged
        for k, token in special.items():
            ids[stops[k] - 1] = token
        there = ids >= 0
        before = np.concatenate([[0], np.cumsum(there)])
        return ids[there].astype("<u4"), np.diff(before[np.concatenate([[0], stops])[np.array([0, *ends])]])

    def _numbers(self, text: str | None) -> np.ndarray:
        """The memo's numbers of a text's pieces."""
        memo = self._memo
        if not text:
            return np.empty(0, np.int64)
        if "\0" not in text:
            memo.uncertain = False
            pieces = text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0")
            numbers = np.fromiter(map(memo.__getitem__, pieces), np.int64, len(pieces))
            if not memo.uncertain:  # no piece ends in white space
                return numbers
        pieces = certain_pieces(text)
        return np.fromiter(map(memo.__getitem__, pieces), np.int64, len(pieces))

    def _look_up(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The memo's numbers of all texts' pieces, whose ids it has, and where each text ends."""
        memo = self._memo
        memo.trim()
        numbers = [self._numbers(t) for t in texts]
        while memo.new:
            memo.put(*self._encode_pieces(memo.new[:TOGETHER]))
        ends = np.cumsum([0, *map(len, numbers)])
        found = np.concatenate([*numbers, np.empty(0, np.int64)])
        memo.used[: memo.known] += np.bincount(found, minlength=memo.known)
        return found, ends

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """How many ids each text has."""
        found, ends = self._look_up(texts)
        return np.diff(np.concatenate([[0], np.cumsum(self._memo.lengths[found])])[ends])

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts as little-endian unsigned 32-bit integers, and where each text's begin, and the last's end."""
        found, ends = self._look_up(texts)
        lengths = self._memo.lengths[found]
        return gather(self._memo.ids, self._memo.starts[found], lengths), np.concatenate([[0], np.cumsum(lengths)])[ends]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return gather(self._raw, self._raw_starts[ids], self._raw_lengths[ids]).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, added tokens included; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


#: White space that all definitions agree on, after a character that none calls white space.
_CERTAIN = re.compile(r"(?<=\S)(?=[ \t\n\r\x0b\x0c])")


def certain_pieces(text: str) -> list[str]:
    """text, cut at all certain boundaries of the byte-level pattern."""
    cuts = [m.start() for m in _CERTAIN.finditer(text)]
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True) if a < b]


def encoder(path: str, memo: int = MEMO) -> ForcedBoundaryBPE:
    """The encoder of a file and size of the memo, kept in this Python process while no other stage needs the room."""
    return kept(ForcedBoundaryBPE, path, memo)


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, ids (array<int>), decoded."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            ids, ends = bpe.encode_all(batch.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array([bpe.decode(ids[a:b]) for a, b in pairwise(ends.tolist())], pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(encode, f"doc_id {kind}, ids array<int>, decoded string")


def bpe_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256; ids and texts stay in the worker."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for batch in batches:
            ids, ends = bpe.encode_all(batch.column(1).to_pylist())
            parts = [ids[a:b] for a, b in pairwise(ends.tolist())]
            decoded = [sha(bpe.decode(x).encode()) for x in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends), pa.int64()), pa.array([sha(x) for x in parts], pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(
        digest, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), memo: int = MEMO) -> DataFrame:
    """doc_id, the columns `keep`, ids, n_tokens, and whether decoding the ids gives the text again.

    A column of `keep` may not be called as one of these.
    """
    if taken := {"doc_id", "ids", "n_tokens", "round_trip"} & {k.lower() for k in keep}:
        raise ValueError(f"columns that clash with the result's: {', '.join(sorted(taken))}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, memo)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            ids, ends = bpe.encode_all(texts)
            same = pa.array([bpe.decode(ids[a:b]) == (t or "") for (a, b), t in zip(pairwise(ends.tolist()), texts, strict=True)], pa.bool_())
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
            columns = [*batch.columns[1:], lists, pa.array(np.diff(ends), pa.int64()), same]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[1:], "ids", "n_tokens", "round_trip"])

    rows = docs.select(text_col, F.col(id_col).alias("doc_id"), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{fields}, ids array<int>, n_tokens long, round_trip boolean")
