import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from nephogrid.llm import simhash
from tests.llm.common import documents, rows


def brute_fingerprint(text, k=4):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    found = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=4):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(fps), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in fps}


def test_texts_against_brute_force(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choice(["Ab", "cd", "É", "x y", "q"]) + str(rng.randrange(50)) for _ in range(60)) for _ in range(15)]
    texts = base + [t + " more" for t in base] + [t.replace(" ", "\t", 1) for t in base] + [None, "", " \n ", "one", "one two", "A b C d", "a b c d", "w " * 30_000, base[0]]
    df = documents(spark, texts)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(df, 4).collect()}
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == fps
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(fps)
    assert all(len(r["fingerprint"]) == 16 for r in got.values())


@pytest.mark.parametrize(("radius", "parts", "field_bits", "leaf_rows"), [(4, 3, None, 20_000), (4, 3, 3, 40), (5, 3, 2, 20_000), (4, 3, 1, 100), (13, 7, 1, 20_000), (13, 7, 1, 200)])
def test_links_against_brute_force(spark, radius, parts, field_bits, leaf_rows):
    """Random fingerprints, chains and a dense ball, whole leaves and leaves cut into blocks."""
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(120)}
    for x in list(fps)[:30]:
        for _ in range(4):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6)))
            fps.add(x)
    centre = rng.getrandbits(64)
    fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4))) for _ in range(150)}
    fps = dict(enumerate(sorted(fps)))
    signed = {i: x - (1 << 64) if x >> 63 else x for i, x in fps.items()}
    reps = spark.createDataFrame([(x,) for x in signed.values()], "fp long")
    got = dict(rows(simhash.components(simhash.links(reps, radius, parts, field_bits, leaf_rows=leaf_rows))))
    want: dict = {}
    for i, c in brute_components(fps, radius).items():
        want.setdefault(c, []).append(i)
    found: dict = {}
    for i, x in signed.items():
        found.setdefault(got.get(x, x), []).append(i)
    assert sorted(want.values()) == sorted(found.values())


def test_similar_texts_are_found_and_others_left_alone(spark):
    rng = random.Random(6)
    texts, groups = [], []
    for g in range(60):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(150, 400))]
        for k in range(3):
            w = list(base)
            for _ in range(k * len(w) // 100):  # up to 2 % of the words: a similarity of 0.8 and more
                w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
            texts.append(" ".join(w))
            groups.append(3 * g)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(spark, texts), **simhash.SIMILAR).collect()}
    right = sum(got[i] == g for i, g in enumerate(groups))
    assert right >= 0.95 * len(groups) and all(groups[got[i]] == groups[i] for i in got)


def test_trees_deepen_and_leaves_stay_small():
    assert [simhash.depth(n, 3) for n in (1000, 10**6, 3 * 10**7, 10**9)] == [3, 3, 2, 1]


def test_sketches_rule_no_similar_pair_out(spark):
    rng = random.Random(9)
    rows_ = []
    for _ in range(300):
        n = rng.randrange(20, 400)
        base = [rng.getrandbits(64) for _ in range(n)]
        other = base[: int(n * 0.9)] + [rng.getrandbits(64) for _ in range(n - int(n * 0.9))]
        far = base[: n // 3] + [rng.getrandbits(64) for _ in range(n - n // 3)]
        for kind, two in (("near", other), ("far", far)):
            a, b = (simhash.sketch_of(simhash.np.unique(simhash.np.array(x, simhash.np.uint64)))[0] for x in (base, two))
            rows_.append((kind, len(base), len(two), sum(64 - ((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a, b, strict=True))))
    df = spark.createDataFrame(rows_, "kind string, n int, m int, same int").withColumn("ok", simhash.plausible(F.col("n"), F.col("m"), F.col("same"), 0.8))
    got = {r["kind"]: r["share"] for r in df.groupBy("kind").agg(F.avg(F.col("ok").cast("int")).alias("share")).collect()}
    assert got["near"] == 1.0 and got["far"] < 0.1


def test_a_repeated_doc_id_does_not_link_texts(spark):
    texts = [" ".join(f"w{i}-{j}" for j in range(80)) for i in range(3)]
    df = documents(spark, [*texts, texts[2]]).withColumn("doc_id", F.when(F.col("doc_id") < 2, F.lit(5)).otherwise(F.col("doc_id")).cast("long"))
    for settings in ({"shingle_words": 4}, simhash.SIMILAR):
        got = simhash.grouped(df, **settings).collect()
        assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(2, 2), (3, 2), (5, 5), (5, 5)]
        assert len({r["root"] for r in got if r["doc_id"] == 5}) == 2


def test_texts_far_from_the_first_of_their_keys_are_linked_across_blocks(spark):
    """A hub of which all are variants comes last; variants are unlike the first one, but like the hub, or like one other."""
    rng = random.Random(12)
    hub = [f"w{rng.randrange(10**6)}" for _ in range(300)]

    def variant(base, n):
        w = list(base)
        at = rng.randrange(len(w) - n)
        w[at : at + n] = [f"x{rng.randrange(10**6)}" for _ in range(n)]
        return w

    texts = [" ".join(variant(hub, 28)) for _ in range(40)] + [" ".join(hub)] + [" ".join(variant(hub, 100)) for _ in range(10)]
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    root = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    assert len(set(root)) == 11
    df = documents(spark, texts)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df, **simhash.SIMILAR).collect()}
    assert [got[i] for i in range(len(texts))] == root
    reps = simhash._sketches(df, 5).withColumn("id", F.col("doc_id"))
    none = spark.createDataFrame([], "a long, b long")
    blocks = dict(rows(simhash.similar_components(df, reps, 5, 0.8, none, block_rows=7)))
    assert [blocks.get(i, i) for i in range(len(texts))] == root


def test_a_long_chain_settles(spark):
    edges = spark.range(0, 300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert rows(simhash.components(edges)) == [(i, 0) for i in range(1, 301)] or {r for _, r in rows(simhash.components(edges))} == {0}


def test_odd_rows(spark):
    none = documents(spark, ["a"]).where("false")
    assert simhash.near_duplicates(none).collect() == []
    twice = documents(spark, ["a b c", "a b c"]).unionAll(documents(spark, ["a b c", "a b c"]))
    twice = twice.withColumn("doc_id", F.when(F.col("doc_id") == 1, F.lit(7))).union(documents(spark, ["zz", "a b c"]).where("doc_id = 1").withColumn("doc_id", F.lit(5).cast("long")))
    got = simhash.near_duplicates(twice)
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in got.collect()) == [(-1, None), (-1, None), (5, 5), (7, 5), (7, 5)]


def test_shared_shingles_decide(spark):
    """Pairs a little over and under 0.8, and texts that differ in all but a line that fills more than half of each."""
    rng = random.Random(8)
    texts, similar = [], []
    for g in range(120):
        base = [f"w{rng.randrange(10**6)}" for _ in range(204)]
        n = 22 if g % 2 else 23  # of 200 shingles: 178 of 222 (0.802) or 177 of 223 (0.794) agree
        texts += [" ".join(base), " ".join(base[:-n] + [f"x{rng.randrange(10**6)}" for _ in range(n)])]
        similar.append(g % 2 == 1)
    line = "the same line again and again " * 60
    texts += [line + " ".join(f"v{rng.randrange(10**6)}" for _ in range(150)) for _ in range(6)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(spark, texts), **simhash.SIMILAR).collect()}
    assert [got[2 * g + 1] == 2 * g for g in range(120)] == similar
    assert [got[i] for i in range(240, 246)] == list(range(240, 246))
