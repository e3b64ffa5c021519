import math
import re

from nephogrid.llm import mixing
from nephogrid.llm._common import table
from nephogrid.llm.queries import op5_mixing
from tests.llm.common import documents, rows


def brute_targets(sizes, share=1.5, cap=2.0, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left, left_w = total - sum(fixed.values()), sum(w[s] for s in free)
        out = fixed | {s: left * w[s] / left_w for s in free}
        over = [s for s in free if out[s] > cap * sizes[s]]
        if not over:
            return out
        fixed |= {s: cap * sizes[s] for s in over}


def test_targets_and_words_taken(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in table(spark, sf, "documents").select("doc_id", "text", "source").collect()}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for i, r in docs.items()}
    per = {}
    for i, r in docs.items():
        per[r["source"]] = per.get(r["source"], 0) + size[i]
    want, got = brute_targets(per), op5_mixing(spark, sf).collect()
    taken = dict.fromkeys(per, 0)
    for r in got:
        s = docs[r["doc_id"]]["source"]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == per[s] and math.isclose(r["target"], want[s], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.03 * want[s] for s in per)
    assert rows(op5_mixing(spark, sf)) == rows(op5_mixing(spark, sf)) == sorted((tuple(r) for r in got), key=repr)


def test_rates_solve_the_dual(spark):
    """Rates add up to the target and are a logistic curve of the size within a source."""
    texts = ["w " * (1 + i % 17) for i in range(400)]
    docs = documents(spark, texts, ["b" if i % 4 else "a" for i in range(400)])
    got = mixing.mix(docs, ["doc_id", "source"]).collect()
    for s in "ab":
        mine = [r for r in got if r["source"] == s]
        t = mine[0]["target"]
        assert abs(sum(r["rate"] * r["size"] for r in mine) - t) <= max(1.0, 1e-6 * t)
        if t < 2 * mine[0]["source_size"]:
            slopes = {round(math.log(r["rate"] / (2 - r["rate"])) / r["size"], 6) for r in mine}
            assert len(slopes) == 1


def test_odd_rows(spark):
    docs = documents(spark, [None, "", "a b c", "a b c", "d " * 20_000, "x"], [None, "s", None, None, "s", "\U0001f600"])
    got = {r["doc_id"]: r for r in mixing.mix(docs, ["doc_id"]).collect()}
    assert len(got) == 6 and got[0]["copies"] == got[1]["copies"] == 0 and got[4]["size"] == 20_000
    assert mixing.mix(docs.where("false"), ["doc_id"]).collect() == []
    twice = mixing.mix(docs.union(docs), ["doc_id"])
    assert twice.count() == 12 and {r["copies"] for r in twice.collect()} <= {0, 1, 2}
    assert mixing.mix(documents(spark, [None, ""]), ["doc_id"]).count() == 2
