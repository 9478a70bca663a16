"""Operator 3: language identification, words first, backing off to character n-grams.

A language is a table of log frequencies of whole words (lower-cased runs of
letters) and one table for each n-gram length from ``MAX_GRAM`` to 1 over
words padded with a start and an end mark.  A known word is scored by its
word entry; an unseen word by the mean over its known n-grams of the longest
length that has any, and so on to single characters.  A text's language has
the largest sum over its words; the score is that language's share when the
mean word score counts for ``min(words, EVIDENCE)`` words.

Fit.  Learning uses labelled rows only, at most about ``docs_per_lang`` a
language, chosen by a hash of the id (a documented bound).  Their features are
counted by Spark and all of them are kept, so the model sent to the tasks
holds the distinct words and n-grams of languages x ``docs_per_lang`` texts,
whatever the corpus.  Prediction reads every whole text.

Defined cases: null text or text without a letter gives ``und`` and score 0,
as does a table without labelled rows; ties go to the language first in
code-point order; rows with a null id count as held out; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ember.llm import textkit as K
from ember.session import ship_package

UNDETERMINED = "und"
MAX_GRAM = 5
EVIDENCE = 12
START, STOP = 2, 3                        # pads: no letter has these code points

FEATURES = pa.schema([("lang", pa.int32()), ("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        table = np.zeros(0x110000, bool)
        table[[c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] == "L"]] = True
        _letters.append(table)
    return _letters[0]


class LetterWords:
    """Lower-cased letter runs of many texts, with the distinct ones apart."""

    def __init__(self, texts: list[str | None]):
        parts = [(t or "").lower() for t in texts]
        self.raw = ("\n".join(parts) + "\n").encode("utf-32-le")
        self.points = np.frombuffer(self.raw, np.uint32)
        letter = _letter_table()[self.points]
        before = np.zeros(len(letter), bool)
        before[1:] = letter[:-1]
        starts = np.flatnonzero(letter & ~before)
        ends = np.flatnonzero(before & ~letter)
        offsets = np.r_[0, np.cumsum([len(p) + 1 for p in parts])]
        self.first = np.searchsorted(starts, offsets)
        key = K.span_hashes(self.raw + b"\0" * 8, starts * 4, ends * 4, seed=3)
        self.keys, one, self.inverse = np.unique(key, return_index=True, return_inverse=True)
        self.starts, self.ends = starts[one], ends[one]          # of the distinct words

    def grams(self, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``which``, hash) of every n-gram of the padded distinct words."""
        size = self.ends[which] - self.starts[which]
        padded = size + 2
        at = np.r_[0, np.cumsum(padded)]
        owner = np.repeat(np.arange(len(which)), padded)
        place = np.arange(at[-1]) - at[owner]
        source = self.starts[which][owner] + place - 1
        inside = (place > 0) & (place <= size[owner])
        flat = np.where(place == 0, START, STOP).astype(np.uint64)
        flat[inside] = self.points[source[inside]]
        ok = place + n <= padded[owner]
        h = K.gram_hashes(K.mix64(flat), n)
        ok = ok[:len(h)]
        with np.errstate(over="ignore"):
            return owner[:len(h)][ok], K.mix64(h[ok] + K.U64(n))


class Model:
    """Log-frequency tables, shared by all tasks; ``tables[0]`` is words, ``tables[n]`` n-grams."""

    def __init__(self, langs: list[str], features: pa.Table):
        self.langs = langs
        self.tables = []
        lang, kinds, key, n = (features.column(c).to_numpy() for c in ("lang", "kind", "key", "n"))
        for kind in range(MAX_GRAM + 1):
            mine = kinds == kind
            keys, at = np.unique(key[mine].view(np.uint64), return_inverse=True)
            counts = np.zeros((len(keys), len(langs)))
            counts[at, lang[mine]] = n[mine]
            total = counts.sum(axis=0)
            self.tables.append((keys, np.log(counts + 0.5) - np.log(total + 0.5 * len(keys) + 1)))

    @staticmethod
    def _rows(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.full(len(asked), -1)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where(keys[at] == asked, at, -1)

    def word_scores(self, words: LetterWords) -> np.ndarray:
        """One row of language scores for every distinct word."""
        keys, logs = self.tables[0]
        row = self._rows(keys, words.keys)
        out = np.zeros((len(row), len(self.langs)))
        out[row >= 0] = logs[row[row >= 0]]
        open_ = np.flatnonzero(row < 0)
        for n in range(MAX_GRAM, 0, -1):
            if not len(open_):
                break
            keys, logs = self.tables[n]
            owner, gram = words.grams(open_, n)
            at = self._rows(keys, gram)
            owner, at = owner[at >= 0], at[at >= 0]
            known = np.bincount(owner, minlength=len(open_))
            for lang in range(len(self.langs)):
                total = np.bincount(owner, weights=logs[at, lang], minlength=len(open_))
                out[open_, lang] = total / np.maximum(known, 1)
            open_ = open_[known == 0]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        words = LetterWords(texts)
        n = np.diff(words.first)
        if not self.langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        each = self.word_scores(words)
        mean = np.zeros((len(texts), len(self.langs)))
        for lang in range(len(self.langs)):
            run = np.r_[0.0, np.cumsum(each[words.inverse, lang])]
            mean[:, lang] = (run[words.first[1:]] - run[words.first[:-1]]) / np.maximum(n, 1)
        best = mean.argmax(axis=1)
        odds = np.exp((mean - mean.max(axis=1, keepdims=True)) * np.minimum(n, EVIDENCE)[:, None])
        score = np.where(n > 0, odds.max(axis=1) / odds.sum(axis=1), 0.0)
        return [self.langs[b] if k else UNDETERMINED for b, k in zip(best, n)], score


def _features(batches):
    """Counts of words and n-grams of labelled texts, summed for each slice."""
    for batch in batches:
        for part in K.byte_slices(batch, "text"):
            words = LetterWords(part.column("text").to_pylist())
            lang = np.repeat(part.column("lang").to_numpy(), np.diff(words.first))
            for one in np.unique(lang):
                count = np.bincount(words.inverse[lang == one], minlength=len(words.keys))
                some = np.flatnonzero(count)
                found = [(0, words.keys[some], count[some])]
                for n in range(1, MAX_GRAM + 1):
                    owner, gram = words.grams(some, n)
                    keys, inverse = np.unique(gram, return_inverse=True)
                    found.append((n, keys, np.bincount(inverse, weights=count[some][owner]).astype(np.int64)))
                for kind, keys, n in found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), one, np.int32)), pa.array(np.full(len(keys), kind, np.int32)),
                         pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "kind", "key", "n"])


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(docs: DataFrame, *, docs_per_lang: int = 2000) -> Model:
    """Learn from rows of ``docs(doc_id, text, lang)`` with a label that are not held out."""
    ship_package(docs.sparkSession)
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}     # one row a language
    langs = sorted(counts)
    if not langs:
        return Model([], FEATURES.empty_table())
    # A row is in the sample when its id's hash falls in its language's share of the range.
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1 << 20, (docs_per_lang << 20) // counts[lang] + 1))])
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < F.element_at(share, F.col("lang"))) \
        .select(F.element_at(number, F.col("lang")).cast("int").alias("lang"), "text")
    features = sample.mapInArrow(_features, "lang int, kind int, key long, n long").groupBy("lang", "kind", "key").agg(
        F.sum("n").alias("n"))
    return Model(langs, features.toArrow())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with held_out, lang_pred and score; input columns of these names are replaced."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(StructType([StructField("lang", StringType()), StructField("score", DoubleType())]))
    def predicted(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], names=["text"])
        lang, score = [], [np.zeros(0)]
        for part in K.byte_slices(batch, "text"):
            one, odds = shared.value.predict(part.column("text").to_pylist())
            lang += one
            score.append(odds)
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(np.concatenate(score))], ["lang", "score"])

    # Declared non-deterministic, or Spark copies it into every filter and column that reads a field of its result:
    # each copy predicts every text again, in a Python worker of its own.
    found = docs.withColumn("_found", predicted.asNondeterministic()(F.col("text").cast("string")))
    return found.withColumns({"held_out": held_out(), "lang_pred": F.col("_found.lang"),
                              "score": F.col("_found.score")}).drop("_found")
