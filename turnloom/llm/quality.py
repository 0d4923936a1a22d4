"""Quality classifier: a factorisation machine over hashed words and structure.

Features are the words, hashed; statistics of the text's structure, cut into
intervals; and its size. Each feature has a weight and a short vector, and every
pair of features interacts by the product of their vectors. The pairs' sum is
taken in linear time, as half of (sum of vectors) squared minus the sum of
squared vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, chunks, cut, pieces

#: Hash buckets for words, intervals for each statistic, length of the vectors.
BUCKETS, INTERVALS, RANK = 1 << 16, 16, 8
STATISTICS = 14
#: Labelled rows that a model is fitted on, at most; those with the smallest hashes of their ids.
SAMPLE = 12_000
LEARNT = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("b", pa.binary()), ("v", pa.binary()), ("s", pa.binary())])

_RUN = regex.compile(rb"[^\w\s\x80-\xff]{2,}")
_DIGIT = regex.compile(rb"\d")


class WordTraits(dict):
    """Each word's number, with its bucket and traits (columns of `traits`)."""

    def __init__(self):
        super().__init__()
        self.bucket = np.empty(1 << 12, np.int64)
        self.traits = np.empty((1 << 12, 7), np.float32)

    def __missing__(self, word: bytes) -> int:
        i = len(self)
        if i == len(self.bucket):
            self.bucket = np.concatenate([self.bucket, np.empty_like(self.bucket)])
            self.traits = np.concatenate([self.traits, np.empty_like(self.traits)])
        text = word.decode("utf-8", "replace")
        letters = sum(map(str.isalpha, text))
        self.bucket[i] = xxhash.xxh3_64_intdigest(word) % BUCKETS
        self.traits[i] = (len(text), letters > 1 and text.upper() == text and text.lower() != text, letters == 0, bool(_RUN.search(word)), bool(_DIGIT.search(word)), len(text) - letters, text[:1].isupper())
        self[word] = i
        return i


def features(words: WordTraits, text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of a text's words, their values (unit length together), and its statistics."""
    text = text or b""
    parts = text.split()
    ids = np.fromiter(map(words.__getitem__, parts), np.int64, len(parts))
    n = len(parts)
    lines = text.split(b"\n")
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.float64), np.zeros(STATISTICS)
    kinds, counts = np.unique(ids, return_counts=True)
    values = np.sqrt(counts)
    values /= np.linalg.norm(values)
    traits = words.traits[ids]
    length, upper, bare, run, digit, marks, title = traits.mean(0, dtype=np.float64)
    # the longest share of the text, by tenths, that is full of marks or capitals
    cuts = np.linspace(0, n, 11).astype(int)[:-1]
    odd = np.maximum(traits[:, 2], np.maximum(traits[:, 1], traits[:, 3]))
    parts_odd = np.add.reduceat(odd, cuts[np.append(True, cuts[1:] > cuts[:-1])]).max() / max(1, n / 10)
    chars = len(text.decode("utf-8", "replace"))
    statistics = (np.log1p(chars), np.log1p(n), length, upper, bare, run, digit, marks / max(length, 1e-9), title, len(kinds) / n, counts.max() / n, len(lines) / n, len({*lines}) / len(lines), parts_odd)
    return words.bucket[kinds], values, np.array(statistics, np.float64)


@dataclass
class Machine:
    """bias, weights and vectors of all features, and the statistics' interval bounds."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    bounds: np.ndarray

    def places(self, statistics: np.ndarray) -> np.ndarray:
        """The statistics' feature numbers."""
        return BUCKETS + np.arange(STATISTICS) * INTERVALS + (self.bounds < statistics[:, None]).sum(1)

    def score(self, buckets: np.ndarray, values: np.ndarray, statistics: np.ndarray) -> float:
        index = np.concatenate([buckets, self.places(statistics)])
        x = np.concatenate([values, np.ones(STATISTICS)])
        own = self.vectors[index] * x[:, None]
        pairs = 0.5 * ((own.sum(0) ** 2).sum() - (own**2).sum())
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[index] @ x + pairs, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, rate: float = 0.05, decay: float = 1e-5, seed: int = 3) -> Machine:
    """A machine fitted by AdaGrad on the logistic loss, in small batches."""
    rng = np.random.default_rng(seed)
    table = np.array([r[2] for r in rows])
    bounds = np.quantile(table, np.linspace(0, 1, INTERVALS + 1)[1:-1], axis=0).T
    size = BUCKETS + STATISTICS * INTERVALS
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.01, (size, RANK)), bounds)
    index = [np.concatenate([b, machine.places(s)]) for b, _, s in rows]
    values = [np.concatenate([v, np.ones(STATISTICS)]) for _, v, _ in rows]
    g_w, g_v, g_b = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            i = np.concatenate([index[k] for k in batch])
            x = np.concatenate([values[k] for k in batch])
            lens = np.array([len(index[k]) for k in batch])
            ends = np.cumsum(lens) - lens
            own = machine.vectors[i] * x[:, None]
            sums = np.add.reduceat(own, ends)
            raw = machine.bias + np.add.reduceat(machine.weights[i] * x, ends) + 0.5 * ((sums**2).sum(1) - np.add.reduceat((own**2).sum(1), ends))
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]
            each = np.repeat(error, lens) * x
            grad_v = each[:, None] * (np.repeat(sums, lens, axis=0) - own)
            used, back = np.unique(i, return_inverse=True)
            w = np.bincount(back, each, len(used)) / len(batch) + decay * machine.weights[used]
            v = np.stack([np.bincount(back, grad_v[:, f], len(used)) for f in range(RANK)], 1) / len(batch) + decay * machine.vectors[used]
            b = error.mean()
            g_w[used] += w**2
            g_v[used] += v**2
            g_b += b**2
            machine.weights[used] -= rate * w / np.sqrt(g_w[used])
            machine.vectors[used] -= rate * v / np.sqrt(g_v[used])
            machine.bias -= rate * b / np.sqrt(g_b)
    return machine


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Machine | None:
    """A machine for label 1, fitted on at most `sample` labelled rows; None where there are none.

    Those with the smallest hashes of their ids are taken. Labels other than 0
    and 1, and null ids, are left out; an id with both counts as 0. Features are made in
    tasks, and one task fits the machine on the sample's.
    """
    known = labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("label"))
    chosen = cut(known.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    texts = texts.join(F.broadcast(chosen) if sample <= BROADCAST_IDS else chosen, "id")

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTraits()
        for part in parts:
            made = [features(words, t) for some in pieces(part.column("text")) for t in some]
            packed = [pa.array([m[k].astype(t).tobytes() for m in made], pa.binary()) for k, t in enumerate((np.int32, np.float32, np.float64))]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), *packed], names=["id", "label", "b", "v", "s"])

    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(parts, LEARNT).sort_by([("id", "ascending"), ("b", "ascending")])
        if got.num_rows:
            rows = [(np.frombuffer(b, np.int32), np.frombuffer(v, np.float32), np.frombuffer(s, np.float64)) for b, v, s in zip(*(got.column(c).to_pylist() for c in "bvs"), strict=True)]
            machine = fit(rows, np.asarray(got.column("label"), np.float64))
            yield pa.RecordBatch.from_pylist([{"bias": machine.bias} | {c: getattr(machine, c).tobytes() for c in ("weights", "vectors", "bounds")}])

    # packed, a sample is some 30 MB; one task fits the machine, and only that comes to the driver
    packed = texts.mapInArrow(make, "id long, label int, b binary, v binary, s binary")
    got = packed.repartition(1).mapInArrow(learn, "bias double, weights binary, vectors binary, bounds binary").first()
    if got is None:
        return None
    return Machine(got.bias, np.frombuffer(got.weights), np.frombuffer(got.vectors).reshape(-1, RANK), np.frombuffer(got.bounds).reshape(STATISTICS, -1))


def scored(documents: DataFrame, machine: Machine | None, text_column: str = "text", added: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """documents plus score (0 to 1) and predicted (1 where score is at least 0.5).

    Only the text is read. The columns take the place of ones of the same name.
    Null and empty texts get a score like any other; without a machine, as no row was labelled, every score is 0.5.
    """
    if machine is None:
        return documents.withColumns(dict(zip(added, (F.lit(0.5), F.lit(1)), strict=True)))
    shared = documents.sparkSession.sparkContext.broadcast((machine.bias, machine.weights, machine.vectors, machine.bounds))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = Machine(*shared.value)
        words = WordTraits()
        for texts in batches:
            column = [None if t is None else t.encode() for t in texts]
            out = []
            for a, b in chunks(column):
                if len(words) > 1 << 17:
                    words = WordTraits()
                out += [machine.score(*features(words, t)) for t in column[a:b]]
            yield pd.Series(out, dtype="float64")

    return documents.withColumn(added[0], score(F.col(text_column))).withColumn(added[1], (F.col(added[0]) >= 0.5).cast("int"))
