import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from nephogrid.llm import lexical
from nephogrid.llm._common import LOWER, UPPER
from nephogrid.llm.queries import ORACLES, op13_lexical_search
from tests.llm.common import documents, rows

LOWERED = str.maketrans(UPPER, LOWER)


def terms(text):
    return re.findall(lexical.TERM, (text or "").translate(LOWERED))


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, length = len(counts), sum(s for _, _, s in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in counts:
            m = 10 + 90 * size * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def word(rng):
    return f"w{int(rng.paretovariate(0.7)) % 300}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aZ09 @[`{\x7f\x80é  ÀİK😀\n_-"))))
def test_terms_of_bytes_and_of_text_agree(text):
    assert [t.decode() for t in lexical.terms_of(text.encode())] == terms(text)


def test_against_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(word(rng) for _ in range(rng.choice([0, 1, 5, 30, 200]))) for _ in range(900)]
    texts += [texts[5]] * 40 + [None, "", "?!", "W1 w1 É é ß"]
    items = [(i, " ".join(word(rng) for _ in range(rng.choice([1, 2, 8, 40])))) for i in range(60)] + [(100, None), (101, "..."), (102, "nowhere"), (103, "É w2 W2"), (104, texts[5])]
    q = spark.createDataFrame(items, "item_id long, text string")
    got = rows(lexical.search(documents(spark, texts).repartition(5), q, k=10))
    assert got == brute(list(enumerate(texts)), items, 10)
    assert rows(lexical.search(documents(spark, texts), q, k=1)) == brute(list(enumerate(texts)), items, 1)


def test_ranges_and_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(lexical, "MOST_PAIRS", 150)
    monkeypatch.setattr(lexical, "MOST_TERMS", 12)
    monkeypatch.setattr(lexical, "LEAST_DOCUMENTS", 50)
    rng = random.Random(8)
    texts = [" ".join(word(rng) for _ in range(rng.choice([1, 5, 30]))) for _ in range(400)]
    items = [(i, " ".join(word(rng) for _ in range(8))) for i in range(6)]
    assert rows(lexical.search(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string"), k=7)) == brute(list(enumerate(texts)), items, 7)


def test_a_search_opens_few_nodes():
    rng = np.random.default_rng(1)
    strong = [70, 900, 2000]  # documents that have all terms
    terms_, places = np.repeat(np.arange(20), 400), np.concatenate([np.union1d(strong, rng.choice(lexical.RANGE, 400, replace=False))[:400] for _ in range(20)])
    shares = rng.integers(1, 100, len(terms_))
    shares[np.isin(places, strong)] = 1000
    trees, opened = lexical.MaxTrees(terms_, places, shares), []
    below = trees.below
    trees.below = lambda *a: opened.append(a) or below(*a)
    best = lexical.Best(3, [])
    trees.search(np.arange(20), best, 0)
    scores = Counter()
    for p, s in zip(places.tolist(), shares.tolist(), strict=True):
        scores[p] += s
    want = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:3]
    assert sorted(((-p, s) for s, p in best.kept), key=lambda x: (-x[1], x[0])) == want
    assert len(opened) < 0.1 * (1 + lexical.FAN + lexical.FAN**2)


def test_odd_rows(spark):
    pairs = [(None, "a b"), (None, "a b"), (4, "a b"), (4, "a b"), (2, "a b"), (7, None), (8, "c " * 100_000)]
    df = spark.createDataFrame(pairs, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as terms", "2 as score")
    items = [(1, "a"), (1, "b c"), (None, "c")]
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "5 as query")
    assert rows(lexical.search(df, q)) == brute(pairs, items, 10)
    assert rows(lexical.search(df.where("false"), q)) == [] == rows(lexical.search(df, q.where("false")))
    named = lexical.search(df, q.selectExpr("concat('item ', item_id) as item_id", "text"))
    assert {r["item_id"] for r in named.collect()} == {"item 1", None}


def test_whole_table_against_sql(spark, small):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    cur = c.execute(ORACLES["op13_lexical_search"])
    assert rows(op13_lexical_search(spark, small).select(*[x[0] for x in cur.description])) == sorted(cur.fetchall(), key=repr)
