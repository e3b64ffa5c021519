"""Toxicity by maximum-scoring segments.

Fit: words and their character n-grams get log-odds of the toxic against the clean labelled texts under an informative Dirichlet prior (the
prior of a unit is its share of all text); a unit counts if its log-odds are high and the number of its toxic texts is far above its share.
Scan: a word scores as its best unit, or a small negative drift, and the linear-time scan for all maximal scoring segments finds every passage. Calibrate:
the segments of clean labelled texts give the exponential tail (K, lambda) of segment scores; a text's evidence is the least Poisson tail
probability of having so many segments at least so high, and a logistic curve on unseen labelled texts turns it into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from nephogrid.llm._common import Remembered, label_sample, materialize, small_batches

#: Runs of anything but ASCII controls, blanks and punctuation.
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
GRAMS = (4, 5, 6)
CACHE = 150_000


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    drift: float
    tail_k: float
    tail_lambda: float
    slope: float
    offset: float


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def units(word: str) -> set[str]:
    """The padded word and its character n-grams."""
    w = f"<{word}>"
    return {w, *(w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1))}


class WordScores(Remembered):
    """Word -> its best unit's weight, or None."""

    def __init__(self, weights: dict[str, float]):
        super().__init__(CACHE)
        self.weights = weights

    def made(self, word: str) -> float | None:
        found = [self.weights[u] for u in units(word) if u in self.weights]
        return max(found) if found else None


def segments(at: list[int], gain: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score) of a text whose tokens at ``at`` gain and whose others lose ``drift``.

    The stack holds the disjoint candidates as [first, last, sum before, sum after, index of the nearest candidate with a smaller sum
    before]; that index makes the scan linear.
    """
    held: list[list] = []
    total, past = 0.0, 0
    for i, g in zip(at, gain, strict=True):
        total -= drift * (i - past)
        past = i + 1
        new = [i, i, total, total + g, -1]
        total += g
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= new[2]:
                j = held[j][4]
            if j < 0 or held[j][3] >= new[3]:
                new[4] = j
                held.append(new)
                break
            new = [held[j][0], new[1], held[j][2], new[3], -1]
            del held[j:]
    return [(a, b, after - before) for a, b, before, after, _ in held]


def text_segments(text: str | None, scores: WordScores, drift: float) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of tokens and the segments of one text."""
    found = list(map(scores.__getitem__, tokens(text)))
    at = [i for i, x in enumerate(found) if x is not None]
    return len(found), segments(at, [found[i] for i in at], drift) if at else []


def evidence(n: int, seg_scores: list[float], k: float, lam: float) -> float:
    """-ln of the least probability, over r, that clean text of n tokens has r segments at least as high as the r-th highest here."""
    if not seg_scores:
        return 0.0
    r = np.arange(1, len(seg_scores) + 1, dtype=float)
    mean = np.maximum(k * n * np.exp(-lam * np.sort(np.asarray(seg_scores, float))[::-1]), 1e-12)
    few = mean < r  # so P(Poisson(mean) >= r) is at most e^-mean mean^r / r! times the geometric series of mean / (r + 1)
    r, mean, ln_factorial = r[few], mean[few], np.cumsum(np.log(r))[few]
    bound = mean - r * np.log(mean) + ln_factorial + np.log1p(-mean / (r + 1))
    return float(np.max(np.minimum(700.0, bound) - np.log(r), initial=0.0))


#: Occurrences and texts, of toxic and clean texts; once without the calibration fold, once with it.
COUNTS = [f"{what}_{y}_{part}" for part in ("fit", "all") for what in ("n", "d") for y in ("t", "c")]


def _count(sample: DataFrame) -> DataFrame:
    """(unit, COUNTS...) of the sample's words and their n-grams."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: dict[str, list[int]] = {}
            for text, y, fold in zip(b["text"], b["y"], b["fold"], strict=True):
                for w, n in Counter(tokens(text)).items():
                    row = seen.setdefault(w, [0] * 8)
                    for at in (1 - y, 5 - y) if fold else (5 - y,):
                        row[at] += n
                        row[at + 2] += 1
            yield pd.DataFrame([(w, *row) for w, row in seen.items()], columns=["word", *COUNTS])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: dict[str, np.ndarray] = {}
            for w, row in zip(b["word"], b[COUNTS].to_numpy(), strict=True):
                for u in units(w):
                    seen[u] = seen[u] + row if u in seen else row
            yield pd.DataFrame([(u, *row) for u, row in seen.items()], columns=["unit", *COUNTS])

    cols = ", ".join(f"{c} long" for c in COUNTS)
    sums = [F.sum(c).alias(c) for c in COUNTS]
    by_word = sample.select("text", "y", "fold").mapInPandas(run, f"word string, {cols}").groupBy("word").agg(*sums)
    return by_word.mapInPandas(cut, f"unit string, {cols}").groupBy("unit").agg(*sums)


def _weight(part: str, total: Row, prior: float, least: float, surprise: float) -> Column:
    """Log-odds of a unit, toxic against clean, under a Dirichlet prior worth ``prior`` of all text; null unless at least ``least`` and unless
    the unit's number of toxic texts is ``surprise`` standard deviations (signed root of the likelihood ratio) above its share."""
    t, c, dt, dc = (F.col(f"{k}_{part}").cast("double") for k in ("n_t", "n_c", "d_t", "d_c"))
    n_t, n_c, m_t, m_c = (float(total[f"{k}_{part}"]) for k in ("n_t", "n_c", "d_t", "d_c"))
    a, a0 = prior * (t + c), prior * (n_t + n_c)
    odds = F.log((t + a) / (n_t + a0 - t - a)) - F.log((c + a) / (n_c + a0 - c - a))
    share = m_t / (m_t + m_c)
    part_of = lambda d, s: F.when(d > 0, d * F.log(d / ((dt + dc) * s))).otherwise(0.0)
    ratio = 2 * (part_of(dt, share) + part_of(dc, 1 - share))
    return F.when((t > 0) & (odds >= least) & (ratio >= surprise**2), odds)


def fit(docs: DataFrame, labels: DataFrame, held_out: Callable[[Column], Column], max_toxic: int = 4000, max_clean: int = 12000, prior: float = 0.1, least: float = 2.0, surprise: float = 5.0, drift: float = 0.25) -> ToxicityModel | None:
    """Learn from labelled rows outside ``held_out``: at most about ``max_toxic`` and ``max_clean`` texts, equal texts once.

    None if either class is missing. The model holds every unit that passes; all are units of the sample, which bounds them.
    """
    small_batches(docs.sparkSession)
    sample, sizes = label_sample(labels, "toxic", held_out, max(max_toxic, max_clean))
    if not sizes.get(0) or not sizes.get(1):
        return None
    if max_toxic < sizes[1]:
        sample = sample.where((F.col("y") == 0) | (F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxic")), F.lit(1 << 30)) < int(max_toxic / min(sizes[1], max_clean) * (1 << 30))))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(sample), "doc_id")
    texts = texts.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = texts.groupBy("digest").agg(F.max("y").alias("y"), F.first("text").alias("text"))
    # the fold depends on the text alone, so copies of it never calibrate what they fitted
    texts = materialize(texts.select("text", "y", (F.pmod(F.xxhash64("digest"), F.lit(10)) < 7).alias("fold")), "toxic-sample")
    counted = materialize(_count(texts), "toxic-units")
    total = counted.agg(*[F.sum(c).alias(c) for c in COUNTS]).first()
    if not all(total[c] for c in COUNTS):
        return None
    both = counted.select("unit", *[_weight(p, total, prior, least, surprise).alias(p) for p in ("fit", "all")]).where(F.coalesce("fit", "all").isNotNull())
    rows = both.collect()
    first, whole = ({r["unit"]: r[p] for r in rows if r[p] is not None} for p in ("fit", "all"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = WordScores(first)
        for b in batches:
            found = [text_segments(x, scores, drift) for x in b["text"]]
            yield pd.DataFrame({"y": b["y"], "n": [f[0] for f in found], "s": [[x[2] for x in f[1]] for f in found]})

    seen = materialize(texts.where(~F.col("fold")).select("text", "y").mapInPandas(run, "y int, n long, s array<double>"), "toxic-segments")
    add = lambda acc, x: acc + x
    clean = seen.where("y = 0").agg(F.sum("n").alias("n"), F.sum(F.size("s")).alias("segments"), F.sum(F.round(F.aggregate("s", F.lit(0.0), add) * 1e6).cast("long")).alias("total")).first()
    lam = clean["segments"] / (clean["total"] / 1e6) if clean["segments"] else 1.0  # a sum of whole numbers, so reruns agree
    k = max(1, clean["segments"] or 0) / max(1, clean["n"] or 0)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "x": [evidence(n, list(s), k, lam) for n, s in zip(b["n"], b["s"], strict=True)]})

    judged = sorted((r["y"], r["x"]) for r in seen.mapInPandas(weigh, "y int, x double").collect())  # two numbers for each text of the sample
    x, y = np.array([r[1] for r in judged]), np.array([r[0] for r in judged], float)
    share = {c: float((y == c).mean()) for c in (0, 1)} if len(y) else {}
    if not share.get(0) or not share.get(1):
        return ToxicityModel(whole, drift, k, lam, 1.0, -3.0)
    natural = sizes[1] / (sizes[0] + sizes[1])
    slope, offset = _logistic(np.sqrt(x), y, np.where(y == 1, natural / share[1], (1 - natural) / share[0]))
    return ToxicityModel(whole, drift, k, lam, slope, offset)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope (kept positive) and offset of a weighted, slightly ridged logistic curve, by Newton's method."""
    a, b = 1.0, -2.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(w * (y - p) * x).sum() - ridge * (a - 1), (w * (y - p)).sum() - ridge * 0.1 * (b + 2)])
        h = np.array([[(w * p * (1 - p) * x * x).sum() + ridge, (w * p * (1 - p) * x).sum()], [(w * p * (1 - p) * x).sum(), (w * p * (1 - p)).sum() + ridge * 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -1, 1))
        if abs(step).max() < 1e-9:
            break
    return max(a, 0.05), b


def scorer(model: ToxicityModel | None, spark: SparkSession) -> Callable[[Column], Column]:
    """struct(score, passages) of a text column; score 0 without a model."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # units of a bounded sample

    @F.pandas_udf("score double, passages array<struct<first: long, last: long, score: double>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = sent.value
        scores = WordScores(m.weights if m else {})
        for b in batches:
            got, spans = [], []
            for text in b:
                n, found = text_segments(text, scores, m.drift) if m else (0, [])
                e = evidence(n, [s for _, _, s in found], m.tail_k, m.tail_lambda) if m else 0.0
                got.append(1 / (1 + math.exp(-min(30.0, m.slope * math.sqrt(e) + m.offset))) if m else 0.0)
                spans.append([{"first": a, "last": z, "score": s} for a, z, s in found if m.tail_k * n * math.exp(-m.tail_lambda * s) < 0.05])
            yield pd.DataFrame({"score": pd.Series(got, dtype=float), "passages": pd.Series(spans, dtype=object)})

    return lambda text: of(text.cast("string"))


def score(docs: DataFrame, model: ToxicityModel | None, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted, passages) for every row of (doc_id, text).

    ``passages`` lists the segments that count as toxic on their own, as first and last token and score. Null and empty texts have no
    evidence and get the lowest score. Without a model (no labels of some class) every score is 0. Repeated rows each come back; an empty
    table gives an empty result; other columns are ignored.
    """
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scorer(model, docs.sparkSession)(F.col("text")).alias("got"))
    return got.select("doc_id", "got.score", (F.col("got.score") >= threshold).cast("int").alias("predicted"), "got.passages")
