"""Language identification by word-first backoff.

The model has two parts, both made with Spark from labelled documents: the frequencies of words by language, and those
of character n-grams (1 to `ORDER` long) of the words between two marks. A word that the model knows scores its log
frequency in each language. An unseen word is scored by its n-grams of the longest order of which any is known, falling
back to shorter ones; a word without a known n-gram says nothing. The language with the highest sum is predicted; the
score is that language's share when the mean scores per word are taken as log probabilities.

The classifier is fitted on a bounded sample: about `sample_docs` documents of each language, chosen by a hash of the
id, and keeps at most `most_words` words and `most_grams` n-grams, with 8 bytes for each label, which bounds what is
collected and sent to workers. Every label is learned, however rare and however many there are. Prediction reads every
whole text.

Nulls and empties: a null text, or one without any letter, gets the language `und` and score 0. A text with letters of
which the model knows nothing gets the most frequent learned language, with an even share as score. Without labelled
documents all texts are `und`. Ties go to the language that sorts first. Labels that are null teach nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.common import kept, stage

UNKNOWN = "und"
ORDER = 4
SAMPLE_DOCS, MOST_WORDS, MOST_GRAMS = 3_000, 120_000, 60_000

#: Words whose rows a worker remembers.
MEMO = 100_000

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    """Log frequencies; row k of `scores` belongs to the word or n-gram with number k."""

    langs: list[str]
    default: int
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray
    memo: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def rows(self, word: str) -> tuple[int, ...]:
        """The rows whose mean scores a word."""
        k = self.words.get(word)
        if k is not None:
            return (k,)
        padded = f"^{word}$"
        for n in range(ORDER, 0, -1):
            known = [k for i in range(len(padded) - n + 1) if (k := self.grams.get(padded[i : i + n])) is not None]
            if known:
                return tuple(known)
        return ()

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its score."""
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """The language, its score, and whether the text tells it: by more than an even share or, if one language is all
        that was learned, by a known word or n-gram other than the bare marks, which every word has."""
        counts = Counter(_WORD.findall((text or "").lower()))
        if not self.langs or not any(map(str.isalpha, "".join(counts))):
            return UNKNOWN, 0.0, False
        at: list[int] = []
        weight: list[float] = []
        seen = 0
        for word, n in counts.items():
            rows = self.memo.get(word)
            if rows is None:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                rows = self.memo[word] = self.rows(word)
            if rows:
                at += rows
                weight += [n / len(rows)] * len(rows)
                seen += n
        if not seen:
            return self.langs[self.default], 1 / len(self.langs), False
        total = np.array(weight) @ self.scores[at] / seen
        share = np.exp(total - total.max())
        best = int(share.argmax())
        score = float(share[best] / share.sum())
        told = score > 1 / len(self.langs) if len(self.langs) > 1 else not {self.grams.get("^"), self.grams.get("$")}.issuperset(at)
        return self.langs[best], score, told


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS, most_words: int = MOST_WORDS, most_grams: int = MOST_GRAMS,
) -> Model:
    """A model of the rows of labelled whose text and language are known."""
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = stage(rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")), "languages")
    sizes = {r["lang"]: r["n"] for r in counts.collect()}
    if not sizes:
        return Model([], 0, {}, {}, np.zeros((0, 0)))
    langs = sorted(sizes)
    # From the staged counts: a frame of Python's rows would start Python workers beside those of the Arrow functions.
    shares = counts.select("lang", F.least(F.lit(1.0), F.lit(sample_docs) / F.col("n")).alias("share"))
    sample = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)).alias("h"))
    sample = sample.join(F.broadcast(shares), "lang").filter(F.col("h") < F.col("share") * 1_000_000)
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    counted = stage(sample.select("lang", words.alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "words")
    padded = F.concat(F.lit("^"), "word", F.lit("$"))
    starts = lambda k: F.transform(F.sequence(F.lit(1), F.length(padded) - (k - 1)), lambda i: F.substring(padded, i, F.lit(k)))
    grams = F.explode(F.flatten(F.array(*(F.when(F.length(padded) >= k, starts(k)).otherwise(F.array().cast("array<string>")) for k in range(1, ORDER + 1)))))
    by_gram = counted.select("lang", "n", grams.alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))

    def table(df: DataFrame, key: str, most: int) -> tuple[dict[str, int], np.ndarray]:
        """The `most` most frequent keys, and their counts by language."""
        wide = df.groupBy(key).agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
        top = wide.filter("all > 1").orderBy(F.desc("all"), key).limit(most).select(key, "by").toArrow()
        number = {lang: k for k, lang in enumerate(langs)}
        counts = np.zeros((top.num_rows, len(langs)))
        for i, by in enumerate(top.column(1)):
            for lang, n in by.as_py():
                counts[i, number[lang]] = n
        return {x: k for k, x in enumerate(top.column(0).to_pylist())}, counts

    known, word_n = table(counted, "word", most_words)
    parts, gram_n = table(by_gram, "gram", most_grams)
    order = np.array([len(g) for g in parts], int)
    logs = [_log_share(word_n)] if len(known) else []
    gram_scores = np.zeros_like(gram_n)
    for k in range(1, ORDER + 1):
        if (order == k).any():
            gram_scores[order == k] = _log_share(gram_n[order == k])
    scores = np.vstack([*logs, gram_scores]) if len(known) + len(parts) else np.zeros((0, len(langs)))
    default = langs.index(max(langs, key=lambda x: (sizes[x], [-ord(c) for c in x])))
    return Model(langs, default, known, {g: k + len(known) for g, k in parts.items()}, scores)


def _log_share(counts: np.ndarray, extra: float = 0.5) -> np.ndarray:
    """Log of each row's share of its column, each count `extra` larger."""
    return np.log((counts + extra) / (counts + extra).sum(axis=0))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, lang_pred, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(getattr, sent, "value")
        for batch in batches:
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs, with their own columns, whose language is told: not `und`, and likelier than by chance.

    With one learned language no score is likelier than chance: rows stay that hold a word or n-gram the model knows.
    """
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(getattr, sent, "value")
        for batch in batches:
            yield batch.filter(pa.array([model.judge(t)[2] for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
