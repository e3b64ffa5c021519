"""Held-out accuracy on labelled texts, the segment scan against brute force, and odd rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from nephogrid.llm import quality, toxicity
from nephogrid.llm._common import crc_mod, table
from nephogrid.llm.queries import op4_toxicity, op7_quality
from tests.llm.common import documents

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("query", "label", "least"), [(op4_toxicity, "toxic", 0.93), (op7_quality, "quality", 0.97)])
def test_held_out_accuracy(spark, query, label, least):
    got = query(spark, SF)
    assert got.count() == table(spark, SF, "documents").count()
    held = got.where("held_out").join(table(spark, SF, "labels"), "doc_id")
    assert held.where(F.col("predicted") == F.col(label)).count() >= least * held.count()
    assert held.groupBy(label).agg(F.avg("score").alias("s")).orderBy(label).select("s").rdd.map(lambda r: r[0]).collect() == sorted(r["s"] for r in held.groupBy(label).agg(F.avg("score").alias("s")).collect())


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels, held = table(spark, SF, "documents"), table(spark, SF, "labels"), crc_mod(4, 2)
    turned = labels.withColumn("toxic", F.when(held(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels, held) == toxicity.fit(docs, turned, held)


def brute_segments(scores):
    """Maximal segments by their recursive definition: the best one (shortest, first), then the rest on either side."""
    def go(a, z):
        best = None
        for i in range(a, z):
            total = 0.0
            for j in range(i, z):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[0] + 1e-9 or (abs(total - best[0]) <= 1e-9 and j - i < best[2] - best[1])):
                    best = (total, i, j)
        return [] if best is None else go(a, best[1]) + [(best[1], best[2])] + go(best[2] + 1, z)

    return go(0, len(scores))


def test_segments_against_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        drift = 0.25 + rng.random() / 100
        hit = [rng.random() < 0.4 for _ in range(rng.randrange(1, 25))]
        scores = [1 + rng.random() if h else -drift * rng.choice([1]) for h in hit]
        scores = [s if h else -drift for s, h in zip(scores, hit, strict=True)]
        at = [i for i, h in enumerate(hit) if h]
        got = toxicity.segments(at, [scores[i] for i in at], drift)
        assert [(a, z) for a, z, _ in got] == brute_segments(scores)


def toxic_texts():
    rng = random.Random(1)
    word = lambda: rng.choice("abcdefgh") + rng.choice("iou") + rng.choice("klmn") + rng.choice("aei") + rng.choice("rst")
    texts, labels = [], []
    for i in range(240):
        w = [word() for _ in range(60)]
        bad = i % 3 == 0
        if bad:
            for _ in range(4):
                w[rng.randrange(60)] = rng.choice(["vilework", "grimefoo", "scornbar"])
        texts.append(" ".join(w))
        labels.append((i, 1, int(bad)))
    return texts, labels


def test_toxicity_on_made_texts_and_odd_rows(spark):
    texts, labels = toxic_texts()
    known = spark.createDataFrame([*labels, (None, 1, 1), (0, 1, 1), (5000, None, None), (1, 1, None)], "doc_id long, quality int, toxic int")
    none = lambda c: F.lit(False)
    model = toxicity.fit(documents(spark, texts), known, none)
    odd = documents(spark, [texts[0], None, "", "grimefoo " * 3000, texts[1] * 40, texts[0]]).unionByName(documents(spark, ["x"]).withColumn("doc_id", F.lit(None).cast("long")))
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["predicted"]) for r in toxicity.score(odd, model).collect()))
    assert got == [(-1, 0), (0, 1), (1, 0), (2, 0), (3, 1), (4, 0), (5, 1)]
    passages = toxicity.score(odd, model).where("doc_id = 3").first()["passages"]
    assert [(p["first"], p["last"]) for p in passages] == [(0, 2999)]
    assert toxicity.score(odd.where("false"), model).collect() == []
    assert toxicity.fit(documents(spark, texts), known.where("toxic = 0"), none) is None
    assert {r["score"] for r in toxicity.score(odd, None).collect()} == {0.0}


def test_quality_on_made_texts_and_odd_rows(spark):
    rng = random.Random(3)
    words = ["stone", "river", "house", "field", "green", "walks", "under", "light"]
    texts = [" ".join(rng.choice(words) + (rng.choice(["###", "$$$"]) if i % 2 else "") for _ in range(40)) for i in range(120)]
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(120)] + [(None, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    none = lambda c: F.lit(False)
    model = quality.fit(documents(spark, texts), labels, none, per_class=200)
    odd = documents(spark, [texts[0], texts[1], None, "", "river### stone$$$ " * 20_000, texts[0]]).unionByName(documents(spark, ["x"]).withColumn("doc_id", F.lit(None).cast("long")))
    got = {(r["doc_id"], r["predicted"]) for r in quality.score(odd, model).collect()}
    assert {(0, 1), (1, 0), (4, 0), (5, 1)} <= got and len(got) == 7
    assert all(0 <= r["score"] <= 1 for r in quality.score(odd, model).collect())
    assert quality.score(odd.where("false"), model).collect() == []
    assert quality.fit(documents(spark, texts), labels.where("quality = 1"), none) is None
    assert {r["predicted"] for r in quality.score(odd, None).collect()} == {1}


def test_words_are_scored_alike_in_cache_and_out():
    model = quality.QualityModel(quality.np.linspace(-1, 1, quality.BUCKETS), 0.5)
    words = quality.WordGains(model.gain)
    text = "aa aa bb " * 3 + "é x"
    at, n = quality.bag(text)
    z = float((model.gain[at] * n).sum() / n.sum()) + 0.5
    assert abs(quality.text_score(text, model, words) - 1 / (1 + 2.718281828459045**-z)) < 1e-6


def test_evidence_of_many_short_segments():
    """Against the tail itself, also where hundreds of segments are expected and many more are there."""
    n, lam = 100_000, 1.0
    for mean in (0.01, 0.9, 5.0, 30.0, 64.0, 200.0):
        for r in (1, 5, 64, 128, 256, 512, 2000):
            got = toxicity.evidence(n, [2.0] * r, mean / n * math.exp(2.0), lam)
            terms = [i * math.log(mean) - mean - math.lgamma(i + 1) for i in range(r, r + 2000)]
            tail = -max(terms) - math.log(sum(math.exp(t - max(terms)) for t in terms))
            assert got <= max(tail, 0.0) + 1e-6
            if r > 2 * mean:
                assert got >= min(700.0, tail) - math.log(r) - 1.0
    assert toxicity.evidence(n, [], 0.001, lam) == 0.0


def test_toxicity_scores_against_brute_force(spark):
    """Every score again from the model's numbers: best units by search, segments by definition, Poisson tails by summing."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fit(docs, labels, crc_mod(4, 2))
    short = docs.where("length(text) < 500")
    texts = {r["doc_id"]: r["text"] for r in short.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in toxicity.score(short, model).collect()}
    assert len(texts) > 50 and any(r["predicted"] for r in got.values())
    for i, text in texts.items():
        scores = []
        for word in toxicity.TOKEN.findall(text.lower()):
            w = f"<{word}>"
            grams = [w, *(w[a:z] for a in range(len(w)) for z in range(a + 1, len(w) + 1) if z - a in toxicity.GRAMS)]
            own = [model.weights[g] for g in grams if g in model.weights]
            scores.append(max(own) if own else -model.drift)
        heights = sorted((sum(scores[a : z + 1]) for a, z in brute_segments(scores)), reverse=True)
        best = 0.0
        for r, h in enumerate(heights, 1):
            mean = max(1e-12, model.tail_k * len(scores) * math.exp(-model.tail_lambda * h))
            if mean < r:
                tail = mean**r * math.exp(-mean) / math.factorial(r) / (1 - mean / (r + 1))
                best = max(best, min(700.0, -math.log(tail) if tail > 0 else 700.0) - math.log(r))
        want = 1 / (1 + math.exp(-min(30.0, model.slope * math.sqrt(best) + model.offset)))
        assert abs(got[i]["score"] - want) < 1e-6, (i, got[i]["score"], want)
        assert got[i]["predicted"] == int(want >= 0.3) or abs(want - 0.3) < 1e-6


def test_quality_scores_against_brute_force(spark):
    """Every score again from the model's numbers, text by text, n-gram by n-gram."""
    from zlib import crc32

    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.fit(docs, labels, crc_mod(5, 0))
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for r in quality.score(docs, model).collect():
        total, n, before = 0.0, 0, None
        for w in texts[r["doc_id"]].translate(dict.fromkeys(range(9, 14), " ")).split(" "):
            if not w:
                continue
            at = [crc32(b"=" + f"<{w}>".encode()), *(crc32(f"<{w}>"[i : i + k].encode()) for k in quality.GRAMS for i in range(len(w) + 3 - k))]
            at += [crc32(b"\x00repeat")] * (quality.REPEAT_WEIGHT if w == before else 0)
            total, n, before = total + sum(model.gain[a % quality.BUCKETS] for a in at), n + len(at), w
        want = 1 / (1 + math.exp(-max(-30.0, min(30.0, model.offset + (total / n if n else 0.0)))))
        assert abs(r["score"] - want) < 1e-9


def test_training_stays_finite(spark):
    """Texts of one word over and over, of one word, and of none among others."""
    texts = ["spam " * 3000, "a", "", "spam " * 10, "x y z " * 400] * 20 + [" ".join(f"word{i}{j}" for j in range(40)) for i in range(100)]
    labels = spark.createDataFrame([(i, int(i >= 100), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    model = quality.fit(documents(spark, texts), labels, lambda doc_id: F.lit(False))
    assert quality.np.isfinite(model.gain).all() and math.isfinite(model.offset)
