import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from nephogrid.llm import topk
from nephogrid.llm.queries import ORACLES, op1_top_k
from tests.llm.common import rows

SCHEMA = "vec_id long, embedding array<float>, label int, raw string, cell int"


def brute(vectors, is_query, k):
    """Every row is a vector of its own, whatever its id."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(256 * x) for x in v)]
    dim = max((len(v) for _, v in good), default=1)
    m = [(i, v + [0] * (dim - len(v))) for i, v in good]
    out = []
    for at, (q, v) in enumerate(m):
        if is_query(q):
            best = sorted((-max(-topk.LONG, min(topk.LONG, sum(a * b for a, b in zip(v, x, strict=True)))), i) for j, (i, x) in enumerate(m) if j != at)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out, key=repr)


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, None, "r", 1) for i, v in vectors], SCHEMA)


@pytest.mark.parametrize(("slot", "pack"), [(2048, 256), (7, 3)])
def test_against_brute_force(spark, monkeypatch, slot, pack):
    """Clusters, many equal vectors, ties, and blocks that are cut small."""
    monkeypatch.setattr(topk, "SLOT_ROWS", slot)
    monkeypatch.setattr(topk, "PACK_ROWS", pack)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (4, 6))
    v = [(i, [float(np.float32(x)) for x in centres[i % 4] + rng.normal(0, 0.3, 6)]) for i in range(260)]
    v += [(i, [0.5, 0.25, 0.0, 0.0, -0.5, 1.0]) for i in range(260, 380)]
    got = topk.top_k(frame(spark, v), F.col("vec_id") % 10 == 0, k=5, pivots=6, rings=8)
    assert rows(got) == brute(v, lambda i: i % 10 == 0, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [(0, [1.0, 2.0]), (10, [0.5]), (20, []), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]), (5, [-1.0, 0.001]), (5, [-1.0, 0.001]), (6, [300.0, -300.0])]
    got = topk.top_k(frame(spark, v), F.col("vec_id") % 10 == 0, k=5)
    assert rows(got) == brute(v, lambda i: i % 10 == 0, 5)
    wide = [(i, [float(np.float32(2e6 if i % 3 == 0 else 1.0 + i / 7)) if k == i % 64 else 0.5 * (i % 5) for k in range(64)]) for i in range(40)]
    got = topk.top_k(frame(spark, wide), F.col("vec_id") % 10 == 0, k=5)
    assert rows(got) == brute(wide, lambda i: i % 10 == 0, 5)
    one = [(0, [2e6] + [0.0] * 63), (1, [1.0] + [0.0] * 63)]
    assert rows(topk.top_k(frame(spark, one), F.col("vec_id") == 0)) == [(0, 1, 1, 131_072_000_000)]
    huge = [(0, [1e38, 1.0]), (10, [-1e30, 1e30]), (1, [-1e30, 0.0]), (2, [2.0**31, 1.0]), (3, [1.0, -3e38])]
    got = topk.top_k(frame(spark, huge), F.col("vec_id") % 10 == 0, k=5)
    assert rows(got) == brute(huge, lambda i: i % 10 == 0, 5)
    twice = [(0, [1.0]), (1, [0.5]), (1, [2.0]), (2, [0.125]), (0, [3.0])]
    got = topk.top_k(frame(spark, twice), F.col("vec_id") % 10 == 0, k=3)
    assert rows(got) == brute(twice, lambda i: i % 10 == 0, 3) and (0, 1, 0, 196608) in rows(got)
    assert topk.top_k(frame(spark, v).where("false"), F.lit(True)).collect() == []
    assert topk.top_k(frame(spark, v[:1]), F.lit(True)).collect() == []


def test_whole_table_against_sql(spark, small):
    c = duckdb.connect()
    c.execute(f"create view embeddings as select * from '{small}/embeddings.parquet'")
    assert rows(op1_top_k(spark, small)) == sorted(c.execute(ORACLES["op1_top_k"]).fetchall(), key=repr)


def test_products_are_exact():
    rng = np.random.default_rng(4)
    for top in (2.0**20, 2.0**26, 2.0**31, 2.0**40, 2.0**60, 2.0**200):
        q, x = (np.floor(rng.normal(0, 1, (6, 5)) * top) * (rng.random((6, 5)) < 0.6) for _ in range(2))
        want = [[max(-topk.LONG, min(topk.LONG, sum(int(a) * int(b) for a, b in zip(v, w, strict=True)))) for w in x] for v in q]
        assert topk.products(q, x).tolist() == want


def test_bounds_hold():
    rng = np.random.default_rng(0)
    q, x, p = rng.normal(0, 50, (20, 5)), rng.normal(0, 50, (200, 5)), rng.normal(0, 50, (1, 5))
    d = np.sqrt(((x - p) ** 2).sum(1))
    cells = {"pivot": np.zeros(200, int), "d_min": d, "d_max": d, "norm": (x**2).sum(1)}
    high = topk._ceiling(np.sqrt(((q - p) ** 2).sum(1))[:, None], (q**2).sum(1), cells)
    assert (high >= q @ x.T).all()


def test_pivots_grow_with_the_vectors():
    assert [topk.pivots_for(n) for n in (0, 2000, 10**6, 10**9, 10**12)] == [24, 24, 125, 3952, 4096]
