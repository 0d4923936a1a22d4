"""Language ID by words first, backing off to shorter and shorter character n-grams.

A word known from the learning texts scores each language by its log frequency
there. An unseen word is scored by its known n-grams of the longest length
that has any, from four characters down to one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import binaries, chunks, cut, fresh, keep_ids

#: Learning documents at most; those with the smallest hashes of their ids.
SAMPLE = 20_000
#: Most frequent words, and n-grams of each length, kept for each language.
WORDS, GRAMS, LONGEST = 8_000, 4_000, 4
UNDETERMINED = "und"


def bare(word: str) -> str:
    """A word in lower case without what isn't a letter at its ends; empty if it has no letter."""
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b].lower()


def grams(word: str, n: int) -> list[str]:
    """A word's n-grams, with a space at both ends for n over one."""
    padded = f" {word} " if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class Model:
    """Log frequencies by language of words and n-grams; scores a word by the first that knows it."""

    def __init__(self, languages: list[str], prior: np.ndarray, logs: dict[int, dict[str, np.ndarray]]):
        self.languages, self.prior = languages, prior
        # each table's items numbered, with their logs in rows; table 0 is the words' own, n that of n-grams
        self.numbers = {n: {item: i for i, item in enumerate(by)} for n, by in logs.items() if by}
        self.logs = {n: np.array(list(by.values())) for n, by in logs.items() if by}

    def score(self, words: list[str]) -> np.ndarray:
        """A row of scores for each word, at most 0; all are 0 for one that no table knows, or without letters."""
        scores = np.zeros((len(words), len(self.languages)))
        left = [i for i, word in enumerate(words) if word]
        for n in (0, *range(LONGEST, 0, -1)):
            if not left or n not in self.numbers:
                continue
            number = self.numbers[n].get
            items = [grams(words[i], n) if n else [words[i]] for i in left]
            owner = np.repeat(np.arange(len(left)), np.fromiter(map(len, items), np.int64, len(items)))
            found = np.fromiter(map(number, chain.from_iterable(items), repeat(-1)), np.int64, len(owner))
            owner, found = owner[found >= 0], found[found >= 0]
            if len(found):
                have, first, count = np.unique(owner, return_index=True, return_counts=True)
                mean = np.add.reduceat(self.logs[n][found], first, axis=0) / count[:, None]
                places = np.array(left)
                scores[places[have]] = mean - mean.max(axis=1, keepdims=True)
                left = np.delete(places, have).tolist()
        return scores

    def word(self, word: str) -> np.ndarray:
        return self.score([word])[0]


class Scores(dict):
    """Each raw word's number, with its scores in a row of `rows` and whether it has letters."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.rows = np.empty((0, len(model.languages)))
        self.letters = np.empty(0, bool)
        self.new: list[bytes] = []

    def __missing__(self, raw: bytes) -> int:
        self[raw] = i = len(self)
        self.new.append(raw)
        return i

    def numbers(self, parts: list[list[bytes]]) -> np.ndarray:
        """The numbers of all words, one part after another; new ones are scored together."""
        ids = np.fromiter(map(self.__getitem__, chain.from_iterable(parts)), np.int64, sum(map(len, parts)))
        words = [bare(raw.decode("utf-8", "replace")) for raw in self.new]
        self.new = []
        if words:
            if len(self) > len(self.rows):
                room = max(1 << 12, len(self), 2 * len(self.rows))
                self.rows = np.concatenate([self.rows, np.empty((room - len(self.rows), self.rows.shape[1]))])
                self.letters = np.concatenate([self.letters, np.empty(room - len(self.letters), bool)])
            self.rows[len(self) - len(words) : len(self)] = self.model.score(words)
            self.letters[len(self) - len(words) : len(self)] = [bool(word) for word in words]
        return ids


def learn(documents: DataFrame, sample: int = SAMPLE, words: int = WORDS, grams_each: int = GRAMS, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Model:
    """A model from at most `sample` documents with a language, those with the smallest hashes of their ids.

    Words are counted in tasks, added up by language and word, and the most
    frequent kept, at most `words` of each language and `grams_each` n-grams of each length; so what reaches the driver is bounded for each language.
    """
    spark = documents.sparkSession
    usable = documents.where(F.col(lang_column).isNotNull() & F.col(id_column).isNotNull() & F.col(text_column).isNotNull())
    ids = usable.select(F.col(id_column).alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    ids = spark.createDataFrame(pa.table({"id": pa.array([r.id for r in ids.collect()], pa.int64())}))
    texts = keep_ids(usable.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")), ids, "id", max(sample, 1))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, n, item, count): n 0 for words, -1 for documents."""

        def rows(lang: str, words: Counter) -> Iterator[pa.RecordBatch]:
            tables: dict[int, Counter] = {n: Counter() for n in range(LONGEST + 1)}
            for raw, times in words.items():
                if word := bare(raw.decode("utf-8", "replace")):
                    tables[0][word] += times
                    for n in range(1, LONGEST + 1):
                        for g in grams(word, n):
                            tables[n][g] += times
            for n, table in tables.items():
                if table:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(table)), pa.array([n] * len(table), pa.int32()), pa.array(list(table), pa.string()), pa.array(list(table.values()), pa.int64())], names=["lang", "n", "item", "count"])

        seen: dict[str, Counter] = {}
        for part in parts:
            langs = part.column("lang").to_pylist()
            for lang, text in zip(langs, binaries(part.column("text")), strict=True):
                words = seen.setdefault(lang, Counter())
                words.update(text.split())
                if len(words) > 500_000:
                    yield from rows(lang, seen.pop(lang))
            total = Counter(langs)
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([-1] * len(total), pa.int32()), pa.array([""] * len(total)), pa.array(list(total.values()), pa.int64())], names=["lang", "n", "item", "count"])
        for lang, words in seen.items():
            yield from rows(lang, words)

    counted = texts.select("text", "lang").mapInArrow(count, "lang string, n int, item string, count long").groupBy("lang", "n", "item").agg(F.sum("count").alias("count"))
    order = Window.partitionBy("lang", "n").orderBy(F.desc("count"), "item")
    counted = cut(counted)
    sums = counted.groupBy(F.col("lang").alias("_lang"), F.col("n").alias("_n")).agg(F.sum("count").alias("total"))
    kept = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= F.when(F.col("n") == 0, words).otherwise(grams_each))
    got = kept.join(sums, (F.col("lang") == F.col("_lang")) & (F.col("n") == F.col("_n"))).select("lang", "n", "item", "count", "total").collect()
    languages = sorted({r.lang for r in got})
    at = {lang: i for i, lang in enumerate(languages)}
    counts: dict[int, dict[str, np.ndarray]] = {}
    totals: dict[int, np.ndarray] = {}
    documents_of = np.zeros(len(languages))
    for r in got:
        if r.n < 0:
            documents_of[at[r.lang]] = r["count"]
            continue
        counts.setdefault(r.n, {}).setdefault(r.item, np.zeros(len(languages)))[at[r.lang]] = r["count"]
        totals.setdefault(r.n, np.zeros(len(languages)))[at[r.lang]] = r.total
    logs = {n: {item: np.log((c + 0.5) / (totals[n] + 0.5 * len(by) + 1)) for item, c in by.items()} for n, by in counts.items()}
    return Model(languages, np.log(documents_of / max(1.0, documents_of.sum())), logs)


def identified(documents: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """documents plus lang_pred and its score (0 to 1).

    Only the text is read. The columns take the place of ones of the same name. und, with score 0, is for texts that are null or have no
    letter, and for all if the model has no language. Ties go to the language
    first by name.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        scores = Scores(model)
        for texts in batches:
            names, sure = [], []
            column = [None if t is None else t.encode() for t in texts]
            for a, b in chunks(column):
                if len(scores) > 1 << 18:
                    scores = Scores(model)
                parts = [t.split() if t else [] for t in column[a:b]]
                ids = scores.numbers(parts)
                start = 0
                for words in parts:
                    own = ids[start : start + len(words)]
                    start += len(words)
                    if not model.languages or not scores.letters[own].any():
                        names.append(UNDETERMINED)
                        sure.append(0.0)
                        continue
                    # evidence beyond twenty words is taken in proportion, so that scores stay apart
                    total = scores.rows[own].sum(0) / max(1.0, len(own) / 20) + model.prior / max(1, len(own))
                    odds = np.exp(total - total.max())
                    best = int(odds.argmax())
                    names.append(model.languages[best])
                    sure.append(float(odds[best] / odds.sum()))
            yield pd.DataFrame({"lang_pred": names, "score": np.array(sure, dtype="float64")})

    both = fresh(documents, "_found")
    found = documents.withColumn(both, predict(F.col(text_column)))
    return found.withColumn("lang_pred", F.col(both)["lang_pred"]).withColumn("score", F.col(both)["score"]).drop(both)
