"""Quality classifier: hashed word n-gram logistic regression trained with
follow-the-regularised-leader updates, scored as sparse dot products.

Words are the text's runs of non-space, case kept. Features are words and word
pairs, and the same for word shapes (letters become a or A, digits 0, runs
collapse) with a mark for a word that repeats the one before; all are hashed
into ``2**bits`` weights. A feature counts log(1 + occurrences), each of the two
groups scaled to length 1.

Labels are learned from a bounded sample (``max_train`` ids, the first in the
order of a hash of the id, and of those the first that have ``max_features``
features together), one after the other in that order; the model is a vector of
fixed length. Every whole text is scored. Null and empty texts have only the
constant feature. Without labels every score is 0.5. Rows are scored one by one.
An id is learned once, by the smallest of its texts (null counts as empty), so
repeated rows and extra columns change nothing; labels that are null are left
out, and a doc_id labelled more than once counts with its mean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.llm.common import small_batches, wrapped

BITS = 18
MAX_TRAIN = 12_000
MAX_FEATURES = 1 << 26
EPOCHS = 2
THRESHOLD = 0.3
CACHE_WORDS = 200_000

_RUNS = re.compile(r"(.)\1+")


# -- features -------------------------------------------------------------------

def shape(word: str) -> str:
    kinds = "".join("0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in word)
    return _RUNS.sub(r"\1", kinds)


class Features:
    """texts -> (indices, values); keeps the hashes of words that come again."""

    def __init__(self, bits: int = BITS):
        self.mask = np.uint64((1 << bits) - 2)     # index 0 is the constant
        self.known: dict[str, tuple[int, int]] = {}

    def _word(self, w: str) -> tuple[int, int]:
        got = self.known.get(w)
        if got is None:
            got = (xxhash.xxh3_64_intdigest(w.encode()), xxhash.xxh3_64_intdigest(shape(w).encode()))
            if len(w) <= 64:
                self.known[w] = got
        return got

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        words = (text or "").split()
        pairs = [self._word(w) for w in words]
        h = np.array(pairs, dtype=np.uint64).reshape(-1, 2)
        w, s = h[:, 0], h[:, 1]
        same = np.zeros(len(w), dtype=np.uint64)
        same[1:] = w[1:] == w[:-1]
        s = _mix(s * np.uint64(2) + same, 3)
        index, value = [np.zeros(1, dtype=np.int64)], [np.ones(1)]
        for x, seed in ((w, 5), (s, 7)):
            grams = np.concatenate([_mix(x, seed), _mix(x[:-1] * np.uint64(31) + x[1:], seed + 10)])
            if len(grams):
                i, n = np.unique((grams & self.mask).astype(np.int64) + 1, return_counts=True)
                v = np.log1p(n)
                index.append(i)
                value.append(v / np.sqrt((v * v).sum()))
        return np.concatenate(index), np.concatenate(value)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(0x9E3779B97F4A7C15 * seed & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


# -- the learner ------------------------------------------------------------------

class FTRL:
    """Per-coordinate follow-the-regularised-leader (proximal) updates."""

    def __init__(self, bits: int = BITS, alpha: float = 0.3, beta: float = 1.0,
                 l1: float = 0.02, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((2, (1 << bits) + 1))

    def weights(self, i=slice(None)) -> np.ndarray:
        z = self.z[i]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, i: np.ndarray, v: np.ndarray, y: float) -> None:
        w = self.weights(i)
        g = (_sigmoid(float(w @ v)) - y) * v
        n = self.n[i] + g * g
        self.z[i] += g - (np.sqrt(n) - np.sqrt(self.n[i])) / self.alpha * w
        self.n[i] = n


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


# -- over the cluster ---------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = BITS,
          max_train: int = MAX_TRAIN, epochs: int = EPOCHS, max_features: int = MAX_FEATURES) -> np.ndarray:
    """The weights learned from ``labels`` (doc_id, label) outside the held-out
    fold. At most ``max_train`` labelled ids are broadcast to find their texts;
    their features (not texts), ``max_features`` at most, meet in one task in
    hash order."""
    small_batches(docs.sparkSession)
    ids = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
           .where(~held_out(F.col("doc_id")))
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg(label).alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
             .join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")))

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Features(bits)
        for b in batches:
            got = [of(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"],
                                "i": [i.astype(np.int32).tobytes() for i, _ in got],
                                "v": [v.astype(np.float32).tobytes() for _, v in got]})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for b in batches:
            for i, v, y in zip(b["i"], b["v"], b["y"]):
                size += len(i) // 4
                if size <= max_features:
                    rows.append((np.frombuffer(i, np.int32), np.frombuffer(v, np.float32), y))
        model = FTRL(bits)
        for _ in range(epochs):
            for i, v, y in rows:
                model.update(i, v.astype(float), y)
        yield pd.DataFrame({"w": [model.weights().astype(np.float32).tobytes()]})

    rows = (texts.mapInPandas(featurise, "doc_id long, y double, i binary, v binary")
            .repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "i"))
    got = rows.mapInPandas(learn, "w binary").collect()
    return np.frombuffer(bytes(got[0]["w"]), np.float32) if got else np.zeros((1 << bits) + 1, np.float32)


def probability(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> Column:
    """The probability of label 1 of the texts of ``docs``."""
    small_batches(docs.sparkSession)
    w = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf(T.DoubleType())
    def of_text(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Features(bits)
        for t in texts:
            yield pd.Series([_sigmoid(float(w.value[i] @ v)) for i, v in map(of, t)], dtype=float)

    return of_text(F.col("text"))


def keep(docs: DataFrame, weights: np.ndarray, least: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score under ``least``."""
    return wrapped(docs, score=probability(docs, weights)).where(F.col("score") >= least).select("_row.*")
