"""Language identification, words first.

A word that the model knows scores each language by the log of its frequency there. A word it does
not know backs off to the character 4-grams of the word with its ends marked, to 3-grams if it has
none that is known, then to 2-grams and single characters; the mean of the known grams' scores
counts as the word's score. Scores of all words of the whole text are summed.

A letter is what Unicode calls one (categories L*); runs of letters are words.

The model is fitted on a bounded sample of labelled rows: about ``docs_per_language`` of each
language, chosen by a hash of id and text (repeated rows count once), and of its words and grams of each
length the most frequent, as many as its equal share of ``max_words`` and ``max_grams`` (of equally
frequent ones all or none), so that a language with few rows keeps its own. So the model that tasks
receive has a size bound, whatever the input.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from tsquality.llm.common import written

#: Runs of letters and of what else counts as alphanumeric but is no decimal digit (numerals such as ²).
_RUNS = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")
MAX_GRAM = 4


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    words = _RUNS.findall(text.lower())
    if text.isascii() or "".join(words).isalpha():
        return words
    return [w for x in words for w in ((x,) if x.isalpha() else _LETTERS.findall(x))]


def grams_of(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    marked = f" {word} "
    return [marked[k:k + n] for k in range(len(marked) - n + 1)]


@dataclass
class Model:
    """``tables[0]`` has words, ``tables[n]`` the n-grams: gram to row of ``scores[n]``, a column a language."""

    languages: list[str]
    tables: list[dict[str, int]]
    scores: list[np.ndarray]
    kept: dict[str, int] = field(default_factory=dict)
    kept_scores: np.ndarray | None = None

    #: Scores of so many words that the model does not know are kept, some 45 MB for a few languages.
    KEEP = 200_000

    def back_off(self, word: str) -> np.ndarray:
        for n in range(MAX_GRAM, 0, -1):
            rows = [r for r in map(self.tables[n].get, grams_of(word, n)) if r is not None]
            if rows:
                return self.scores[n][rows].mean(axis=0)
        return np.zeros(len(self.languages))

    def unknown(self, words: dict[str, int]) -> np.ndarray:
        """The summed scores of words that the model does not know, by how often they occur."""
        total = np.zeros(len(self.languages))
        if self.kept_scores is None:
            self.kept_scores = np.zeros((self.KEEP, len(self.languages)))
        rows, times = [], []
        for word, n in words.items():
            row = self.kept.get(word)
            if row is None:
                if len(self.kept) >= self.KEEP:
                    total += np.array(times, float) @ self.kept_scores[rows]
                    self.kept, rows, times = {}, [], []
                row = self.kept[word] = len(self.kept)
                self.kept_scores[row] = self.back_off(word)
            rows.append(row)
            times.append(n)
        return total + np.array(times, float) @ self.kept_scores[rows]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text))
        if not counts or not self.languages:
            return "und", 0.0
        rows, times, others = [], [], {}
        known = self.tables[0]
        for word, n in counts.items():
            row = known.get(word)
            if row is None:
                others[word] = n
            else:
                rows.append(row)
                times.append(n)
        total = np.array(times, float) @ self.scores[0][rows] if rows else np.zeros(len(self.languages))
        if others:
            total += self.unknown(others)
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to counts of words (n = 0) and n-grams; summed a batch, so that a task holds one batch's."""
    for b in batches:
        by_lang: dict[str, Counter] = {}
        for lang, text in zip(b.column(0), b.column(1)):
            by_lang.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
        out: list[tuple[str, int, str, int]] = []
        for lang, words in by_lang.items():
            out += [(lang, 0, w, c) for w, c in words.items()]
            for n in range(1, MAX_GRAM + 1):
                grams: Counter = Counter()
                for w, c in words.items():
                    for g in grams_of(w, n):
                        grams[g] += c
                out += [(lang, n, g, c) for g, c in grams.items()]
        cols = list(zip(*out)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.int64()))],
            names=["lang", "n", "gram", "c"])


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        docs_per_language: int = 4000, max_words: int = 60_000, max_grams: int = 20_000,
        smoothing: float = 0.1) -> Model:
    """The model of the labelled rows of ``train``; rows without language or text are passed over."""
    rows = train.select(F.xxhash64(id_col, text_col).alias("h"), F.col(lang_col).cast("string").alias("lang"),
                        F.col(text_col).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    n_docs = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row a language
    if not n_docs:
        return Model([], [{} for _ in range(MAX_GRAM + 1)], [np.zeros((0, 0))] * (MAX_GRAM + 1))
    scale = 1 << 30
    share = F.create_map(*(F.lit(x) for k, n in n_docs.items() for x in (k, -(-scale * docs_per_language // n))))
    sample = rows.where(F.pmod("h", F.lit(scale)) < share[F.col("lang")])
    sample = sample.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")  # repeated rows once
    counts = written(_summed(sample), "grams")
    # How many grams occur how often in a language (a row a frequency) gives the least frequency that is kept.
    frequencies: dict[tuple, list] = {}
    for r in counts.groupBy("n", "lang", "c").count().collect():
        frequencies.setdefault((r["n"], r["lang"]), []).append((r["c"], r["count"]))
    least = [(n, lang, _least(f, (max_grams if n else max_words) // len(n_docs))) for (n, lang), f in frequencies.items()]
    least = train.sparkSession.createDataFrame(least, "n INT, lang STRING, least BIGINT")  # a row a language and length
    each = counts.join(F.broadcast(least), ["n", "lang"])
    got = each.groupBy("n", "gram").agg(F.max(F.col("c") >= F.col("least")).alias("often"),
                                        F.collect_list(F.struct("lang", "c")).alias("by_lang")) \
        .where("often").select("n", "gram", "by_lang").orderBy("n", "gram").toArrow().to_pylist()
    languages = sorted(n_docs, key=lambda x: x.encode())
    at = {k: i for i, k in enumerate(languages)}
    tables, scores = [], []
    for n in range(MAX_GRAM + 1):
        own = [r for r in got if r["n"] == n]
        m = np.zeros((len(own), len(languages)))
        for k, r in enumerate(own):
            for x in r["by_lang"]:
                m[k, at[x["lang"]]] += x["c"]
        tables.append({r["gram"]: k for k, r in enumerate(own)})
        scores.append(np.log((m + smoothing) / (m.sum(axis=0) + smoothing * max(1, len(own)))))
    return Model(languages, tables, scores)


def _least(frequencies: list[tuple[int, int]], most: int) -> int:
    """The least frequency at which at most ``most`` grams are at least that frequent."""
    least, kept = 1 << 62, 0
    for total, n in sorted(frequencies, reverse=True):
        kept += n
        if kept > most:
            break
        least = total
    return least


def _summed(sample: DataFrame) -> DataFrame:
    """n, gram, lang, c: how often each gram occurs in a language."""
    return sample.mapInArrow(_counted, "lang STRING, n INT, gram STRING, c BIGINT") \
        .groupBy("n", "gram", "lang").agg(F.sum("c").alias("c"))


def _predicted(model: Model, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(t.as_py()) for t in b.column(text_at)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=[f"c{k}" for k in range(b.num_columns + 2)])
    return run


def predict(model: Model, docs: DataFrame, text_col: str = "text",
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with lang_pred and score after its columns; ``names`` are theirs, and must be new to ``docs``.

    ``und`` with score 0 where the text is null or has no letter; equal scores go to the language
    that comes first by code point. The score is the share of the best language in the sum of all
    languages' likelihoods. Every row is judged on its own, so repeated rows and ids do not matter.
    """
    n, given = len(docs.columns), docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    schema = StructType([*given.schema.fields]).add(f"c{n}", StringType()).add(f"c{n + 1}", DoubleType())
    out = given.mapInArrow(_predicted(model, docs.columns.index(text_col)), schema)
    return out.toDF(*docs.columns, *names)
