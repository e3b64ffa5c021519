"""Quality classifier: averaged subword embeddings with a softmax, trained by stochastic gradient descent.

A text is the multiset of its words, their character n-grams and a mark for each word that repeats its predecessor, all hashed into
``BUCKETS`` rows of a learned table; the average of those rows goes through a linear layer and a softmax. Scoring needs no table look-ups by
text: the layers after the average are linear, so a word always adds the same number, which is computed once for each distinct word.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nephogrid.llm._common import Remembered, label_sample, small_batches

BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
#: How often the mark of a repeated word counts, next to a word's dozens of n-grams.
REPEAT_WEIGHT = 8
CACHE = 150_000


@dataclass(frozen=True)
class QualityModel:
    gain: np.ndarray  # per bucket: what one occurrence adds to the logit of label 1, before averaging
    offset: float


def split(text: str | None) -> list[str]:
    """Words at ASCII white space."""
    return [w.decode("utf-8") for w in (text or "").encode("utf-8", "replace").split()]


def features(word: str) -> list[int]:
    """Buckets of the padded word and its character n-grams."""
    w = f"<{word}>"
    e = w.encode()
    out = [crc32(b"=" + e) % BUCKETS]
    for n in GRAMS:
        if len(e) == len(w):  # ASCII: characters are bytes
            out += [crc32(e[i : i + n]) % BUCKETS for i in range(len(w) - n + 1)]
        else:
            out += [crc32(w[i : i + n].encode()) % BUCKETS for i in range(len(w) - n + 1)]
    return out


REPEAT = crc32(b"\x00repeat") % BUCKETS


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their counts."""
    found = split(text)
    total = np.zeros(BUCKETS, np.float64)
    for w, n in Counter(found).items():
        np.add.at(total, features(w), n)
    total[REPEAT] += REPEAT_WEIGHT * sum(map(eq, found, found[1:]))
    at = np.flatnonzero(total)
    return at.astype(np.uint16), total[at].astype(np.float32)


def packed(found: tuple[np.ndarray, np.ndarray]) -> bytes:
    """A bag, compressed for its way to the driver and its stay there."""
    return zlib.compress(found[0].tobytes() + found[1].tobytes(), 1)


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(raw)
    n = len(raw) // 6
    return np.frombuffer(raw, np.uint16, n), np.frombuffer(raw, np.float32, n, 2 * n)


def train(bags: list[bytes], y: np.ndarray, prior_shift: float, dim: int = 12, epochs: int = 8, rate: float = 2.0, seed: int = 7) -> QualityModel:
    """Plain stochastic gradient descent over packed bags, one text at a time, with a linearly falling rate."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    out, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            at, n = unpacked(bags[i])
            lr = rate * (1 - done / steps)
            done += 1
            share = n / n.sum() if len(n) else n
            mean = share @ table[at]
            logit = out @ mean + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out.T @ p
            out -= lr * np.outer(p, mean)
            bias -= lr * 0.1 * p
            if len(at):
                # a row moves with its share of the text, so the step is scaled up by the number of rows that share it: the effective number, so
                # that the mean of a text of which one row is most moves no further than that of any other
                table[at] -= np.outer(share * min(50.0, 1.0 / float(share @ share)) * lr, back).astype(np.float32)
    return QualityModel((table @ (out[1] - out[0])).astype(np.float64), float(bias[1] - bias[0]) + prior_shift)


def fit(docs: DataFrame, labels: DataFrame, held_out: Callable[[Column], Column], per_class: int = 2000) -> QualityModel | None:
    """Learn from labelled rows outside ``held_out``: at most about ``per_class`` texts of each class. None if either class is missing.

    The sample's bags are made by the executors; the driver holds at most 2.4 * per_class of them and trains.
    """
    small_batches(docs.sparkSession)
    sample, sizes = label_sample(labels, "quality", held_out, per_class)
    if not sizes.get(0) or not sizes.get(1):
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "bag": [packed(bag(x)) for x in b["text"]]})

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(sample), "doc_id")
    rows = texts.mapInPandas(run, "doc_id long, y int, bag binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["bag"])))
    y = np.array([r["y"] for r in rows])
    if not len(y) or y.min() == y.max():
        return None
    shift = math.log(sizes[1] / sizes[0]) - math.log((y == 1).sum() / (y == 0).sum())
    return train([bytes(r["bag"]) for r in rows], y, shift)


class WordGains(Remembered):
    """Word -> (what it adds, number of features)."""

    def __init__(self, gain: np.ndarray):
        super().__init__(CACHE)
        self.gain = gain.tolist()

    def made(self, word: str) -> tuple[float, int]:
        at = features(word)
        gain = self.gain
        return sum([gain[i] for i in at]), len(at)


def text_score(text: str | None, model: QualityModel, words: WordGains) -> float:
    found = split(text)
    repeats = REPEAT_WEIGHT * sum(map(eq, found, found[1:]))
    got = list(map(words.__getitem__, found))
    n = sum([g[1] for g in got]) + repeats
    z = model.offset + ((sum([g[0] for g in got]) + repeats * float(model.gain[REPEAT])) / n if n else 0.0)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def scorer(model: QualityModel | None, spark: SparkSession) -> Callable[[Column], Column]:
    """The score of a text column; 1 without a model."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # BUCKETS numbers

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        words = WordGains(m.gain) if m else None
        for b in batches:
            yield pd.Series([text_score(x, m, words) if m else 1.0 for x in b], dtype=float)

    return lambda text: of(text.cast("string"))


def score(docs: DataFrame, model: QualityModel | None, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) for every row of (doc_id, text).

    Null and empty texts score as the model's offset alone. Without a model (no labels of some class) every score is 1. Repeated rows each
    come back; an empty table gives an empty result; other columns are ignored.
    """
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scorer(model, docs.sparkSession)(F.col("text")).alias("score"))
    return got.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
