"""SimHash near-duplicates: fingerprints, a vantage-point partition of them, exact links and their components.

Vantage-point trees on whole 64-bit fingerprints do not prune at radius 4: distances of unrelated fingerprints from any vantage point lie at
32 +- 4, so nearly every ball touches both sides of every split. The tree here measures each level on a bit field of its own. With ``x`` and
``q`` restricted to field ``f``, ``|d_f(x, v) - d_f(q, v)| <= d_f(x, q)``, and the fields are disjoint, so the differences add up against one
radius: the children to visit are those whose distances differ from the query's by no more than what is left of it. Several trees cover
disjoint parts of the bits: of 4 differing bits some third holds at most one, and of 13 some seventh, so each part is searched at radius 1,
which leaves the leaf of the query and the leaves one step away in one level (the boundary overlap). The vantage point is one of the
fingerprints; fields get narrower, and so trees deeper, as fingerprints grow in number, which keeps leaves of unrelated fingerprints at a few
thousand rows at most. Every pair that meets in a leaf is verified on all 64 bits; the result is exact.

Where texts, not fingerprints, have to agree (``least``), fingerprints only propose, beside minima of the shingles' hashes that several texts
share, and the distinct shingles of both texts decide. No pair of unlike texts leaves the task that compares it.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephogrid.llm._common import materialize, small_batches

#: Rows of one leaf that one task takes; larger leaves are cut into blocks that meet two by two.
LEAF_ROWS = 100_000
#: Rows that a leaf of unrelated fingerprints may have before trees get deeper.
TARGET_ROWS = 2_000
#: Texts of a key that one task compares with as many others, and about how many distinct shingles they may have together.
TEXT_ROWS, TEXT_SHINGLES = 1_000, 1_000_000
#: Nodes of the stars that one task holds.
FOREST_NODES = 200_000
#: Rows of 8 or 16 bytes up to which a table is broadcast.
BROADCAST_ROWS = 500_000


def _majority(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


GOLDEN = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """A bijection of 64-bit numbers that differs by k: xor-shift and odd multipliers."""
    h = h ^ np.uint64((k * GOLDEN) % (1 << 64))
    for shift, odd in ((31, 0xBF58476D1CE4E5B9), (29, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(odd)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(text: str | None, shingle_words: int) -> np.ndarray:
    """XXH64 (seed 42) of a text's shingles, repeats included; none for a text without words."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return np.empty(0, np.uint64)
    line, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= shingle_words:
        return np.array([digest(line, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(found) - shingle_words + 1].tolist()
    return np.array([digest(line[a:b], 42) for a, b in zip(starts, ends[shingle_words - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint_of(text: str | None, shingle_words: int) -> int:
    """The 64-bit SimHash of one text, see ``fingerprints``."""
    hashes = shingle_hashes(text, shingle_words)
    return _majority(hashes) if len(hashes) else 0


#: Keys of a text's sketch and minima in each: texts of which 0.8 of the shingles agree share no key in 7 cases of 100,000.
KEYS, MINIMA = 24, 5
MULTIPLIERS = _mixed(np.arange(1, KEYS * MINIMA + 1, dtype=np.uint64), 1) | np.uint64(1)
SIGNATURE = ["s0", "s1", "s2", "s3"]


def sketch_of(distinct: np.ndarray) -> tuple[list[int], list[int]]:
    """Of a set of hashes: two bits of each of its minima under several orders, in four signed longs, and keys (signed) of which two sets share
    each with probability Jaccard ** MINIMA."""
    import xxhash

    if not len(distinct):
        return [0, 0, 0, 0], []
    low = np.min([np.multiply.outer(MULTIPLIERS, distinct[at : at + 4096]).min(axis=1) for at in range(0, len(distinct), 4096)], axis=0)
    two = (_mixed(low, 2)[:, None] >> np.array([62, 63], np.uint64)).astype(np.uint8) & 1
    bits = np.zeros(256, np.uint8)
    bits[: two.size] = two.ravel()
    keys = [xxhash.xxh64_intdigest(low[k * MINIMA : (k + 1) * MINIMA].tobytes(), k) for k in range(KEYS)]
    return np.packbits(bits).view(">i8").tolist(), np.array(keys, np.uint64).view(np.int64).tolist()


def plausible(n: Column, m: Column, same_bits: Column, least: float) -> Column:
    """Whether sets of sizes n and m whose signatures agree in so many of 256 bits may have a Jaccard similarity of ``least``.

    The sizes must be near enough; the bits that agree must not lie more than 5.4 standard deviations below what that similarity makes them (one pair of
    a hundred million that has it does).
    """
    orders = KEYS * MINIMA
    of_one = 4 * least + 1.5 * (1 - least) - (1 + least) ** 2  # variance of the two bits of one minimum
    bits = orders * (1 + least) - 5.4 * math.sqrt(orders * of_one) + 256 - 2 * orders
    return (F.least(n, m) >= least * F.greatest(n, m)) & (same_bits >= math.floor(bits))


def fingerprints(docs: DataFrame, shingle_words: int = 5) -> DataFrame:
    """(doc_id, fp): each text's fingerprint as a signed long.

    Words are runs of non-ASCII-white-space with A-Z lower-cased; a shingle is ``shingle_words`` words joined by spaces, repeats included
    (fewer words: the whole sequence). A bit is set if it is set in more than half of the shingles' XXH64 (seed 42). Null, empty and blank
    texts have fingerprint zero.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(np.array([fingerprint_of(x, shingle_words) for x in b], np.uint64).view(np.int64))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), of(F.col("text").cast("string")).alias("fp"))


def depth(n: int, parts: int) -> int:
    """Bits in a field (3, 2 or 1): the most that keep a leaf of n unrelated fingerprints at TARGET_ROWS or fewer."""
    for width in (3, 2):
        meet = sum(math.comb(width, k) ** 2 for k in range(width + 1)) / 4**width  # two fingerprints lie equally far in one field
        if n * meet ** (64 // parts / width) <= TARGET_ROWS:
            return width
    return 1


def _leaves(radius: int, parts: int, field_bits: int, vantage: int) -> Column:
    """The leaves a fingerprint belongs to, as struct(leaf long, home boolean): for each tree its own and those one step up in one level."""
    if radius >= 2 * parts:
        raise ValueError(f"{parts} trees searched at radius 1 are exact up to {2 * parts - 1} differing bits")
    x = F.col("fp").bitwiseXOR(F.lit(vantage).cast("long"))
    out, base = [], 0
    for tree in range(parts):
        first, past = 64 * tree // parts, 64 * (tree + 1) // parts
        fields = [(a, min(field_bits, past - a)) for a in range(first, past, field_bits)]
        steps = [(field_bits + 1) ** k for k in range(len(fields))]
        far = [F.bit_count(F.shiftrightunsigned(x, a).bitwiseAND(F.lit((1 << n) - 1).cast("long"))).cast("long") for a, n in fields]
        home = functools.reduce(lambda p, q: p + q, [d * s for d, s in zip(far, steps, strict=True)])
        out.append(F.struct((home + F.lit(base)).alias("leaf"), F.lit(True).alias("home")))
        out += [F.when(d < n, F.struct((home + F.lit(base + s)).alias("leaf"), F.lit(False).alias("home"))) for d, s, (_, n) in zip(far, steps, fields, strict=True)]
        base += (field_bits + 1) ** len(fields)  # keeps the trees' numbers apart
    return F.filter(F.array(*out), lambda c: c.isNotNull())


def _leaf_edges(rows: pd.DataFrame, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of one leaf's links, not the links themselves: home rows against all rows; of two blocks, only across them."""
    ids, side = rows["fp"].to_numpy(), rows["side"].to_numpy()
    fps = ids.view(np.uint64)
    root = np.arange(len(ids))
    one, two = [], []
    home = np.flatnonzero(rows["home"].to_numpy())
    step = max(1, min(128, 4_000_000 // len(ids)))
    for at in range(0, len(home), step):
        mine = home[at : at + step]
        near = np.bitwise_count(fps[mine, None] ^ fps[None, :]) <= radius
        near &= (side[mine, None] != side[None, :]) | (side[None, :] == 2)
        near[np.arange(len(mine)), mine] = False
        for i in np.flatnonzero(near.any(axis=1)):
            p = mine[i]
            at_q = np.flatnonzero(near[i])
            others, first = np.unique(root[at_q], return_index=True)
            for r, q in zip(others, at_q[first], strict=True):
                if r != root[p]:
                    one.append(p)
                    two.append(q)
                    root[root == r] = root[p]
    return ids[one], ids[two]


def links(reps: DataFrame, radius: int = 4, parts: int = 3, field_bits: int | None = None, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(a, b): edges that connect exactly what the links connect, for distinct fingerprints (fp).

    Two fingerprints are linked if they differ in ``radius`` bits or fewer. ``field_bits`` stands in for the depth chosen by their number.
    """
    found = reps.select("fp").orderBy(F.xxhash64("fp", F.lit("vantage")), "fp").limit(1).collect()
    vantage = found[0]["fp"] if found else 0
    width = field_bits or depth(reps.count(), parts)
    spread = reps.select("fp", F.explode(_leaves(radius, parts, width, vantage)).alias("at")).select("fp", "at.*")
    crowded = materialize(spread.groupBy("leaf").count().where(F.col("count") > leaf_rows).select("leaf", F.ceil(F.col("count") / (leaf_rows / 2)).cast("int").alias("blocks")), "crowded", slim=True)
    n = crowded.count()
    if not n:
        dealt = spread.withColumns({"one": F.lit(0), "two": F.lit(0), "side": F.lit(2)})
    else:
        crowded = F.broadcast(crowded) if n <= BROADCAST_ROWS else crowded
        spread = spread.join(crowded, "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        dealt = _in_blocks(spread, "leaf", F.col("home"), F.col("fp"), ["fp"])
    found = _by_blocks(dealt, "leaf", lambda b: _leaf_edges(b, radius))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _in_blocks(rows: DataFrame, group: str, home: Column, key: Column, columns: list[str]) -> DataFrame:
    """``columns`` of ``rows`` (group, blocks, ...), each row once for every block it meets: one, two, the blocks' numbers, and side, which tells
    the two apart (2: a block with itself). Rows that are not ``home`` meet like others."""
    mine = F.pmod(F.xxhash64(key, F.lit("block")), F.col("blocks").cast("long")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, mine).alias("one"), F.greatest(k, mine).alias("two"), F.when(k == mine, 2).when(k > mine, 0).otherwise(1).alias("side")))
    return rows.withColumn("home", home).select(group, "home", *columns, F.explode(pairs).alias("p")).select(group, "home", *columns, "p.*")


def _by_blocks(dealt: DataFrame, group: str, edges: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(a, b): what ``edges`` finds in each (group, one, two) of rows with home and side, taken one after the other."""
    keys = [group, "one", "two"]
    n_parts = max(int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = dealt.repartition(n_parts, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def close(b: pd.DataFrame) -> pd.DataFrame:
            """Edges of the whole blocks in ``b``."""
            key = b[keys].to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(b)]))
            home = b["home"].to_numpy()
            got = [edges(b.iloc[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True) if z - a > 1 and home[a:z].any()]
            return pd.DataFrame({k: np.concatenate([g[i] for g in got] or [np.empty(0, np.int64)]) for i, k in enumerate("ab")})

        for b in batches:
            if not len(b):
                continue
            key = b[keys].to_numpy()
            last = int(np.flatnonzero((key == key[-1]).all(axis=1))[0])
            if held and last == 0 and (held[-1][keys].to_numpy()[-1] == key[0]).all():
                held.append(b)
                continue
            yield close(pd.concat([*held, b.iloc[:last]]))
            held = [b.iloc[last:]]
        if held:
            yield close(pd.concat(held))

    return dealt.mapInPandas(run, "a long, b long")


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A partition's edges as stars that connect the same nodes: each node with the smallest of its component here.

    Stars are passed on and forgotten whenever FOREST_NODES are held, which bounds the memory and loses no connection.
    """
    low: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := low.get(x, x)) != x:
            low[x] = low.get(up, up)
            x = up
        return x

    def stars() -> pd.DataFrame:
        nodes = [x for x in low if root(x) != x]
        return pd.DataFrame({"a": np.array([root(x) for x in nodes], np.int64), "b": np.array(nodes, np.int64)})

    for e in batches:
        for a, b in zip(e["a"].tolist(), e["b"].tolist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                low[max(x, y)] = min(x, y)
                low.setdefault(a, a)
                low.setdefault(b, b)
        if len(low) > FOREST_NODES:
            yield stars()
            low.clear()
    yield stars()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, root): each node of the edges (a < b) with the smallest id of its component.

    Each partition first reduces its edges to stars, without a shuffle; then large-star and small-star steps alternate, each an aggregate and a
    join, with each round's edges written down. Ends when every node hangs on one root and no root hangs on another; raises if
    ``max_rounds`` do not suffice.
    """

    def settled(e: DataFrame) -> bool:
        ends = e.select(F.col("b").alias("x"), F.lit(1).alias("hangs"), F.lit(0).alias("roots")).union(e.select("a", F.lit(0), F.lit(1)))
        return ends.groupBy("x").agg(F.sum("hangs").alias("hangs"), F.max("roots").alias("roots")).where("hangs + roots > 1").isEmpty()

    def star(e: DataFrame, large: bool) -> DataFrame:
        """Large: each node's larger neighbours move to its smallest; small: its smaller neighbours and itself do."""
        both = e.union(e.select("b", "a")) if large else e.select(F.col("b").alias("a"), F.col("a").alias("b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.join(low, "a")
        out = moved.where(F.col("b") > F.col("a")) if large else moved.where(F.col("b") != F.col("m"))
        out = out.select(F.col("m").alias("a"), "b")
        if not large:
            out = out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(low.select(F.col("m").alias("a"), F.col("a").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    now = materialize(edges.select("a", "b").mapInPandas(_forest, "a long, b long"), "edges", slim=True)
    for _ in range(max_rounds):
        if settled(now):
            return now.select(F.col("b").alias("id"), F.col("a").alias("root"))
        now = materialize(star(star(now.mapInPandas(_forest, "a long, b long"), True), False), "edges", slim=True)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def digest_of(text: Column) -> Column:
    """Equal texts share it; null and the empty text do."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _sketches(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, digest, fp, n, s0 ... s3, keys): each text's fingerprint and the sketch of its n distinct shingles."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("fp long, n int, s0 long, s1 long, s2 long, s3 long, keys array<long>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp, n, sig, keys = [], [], [], []
            for x in b:
                hashes = shingle_hashes(x, shingle_words)
                distinct = np.unique(hashes)
                s, k = sketch_of(distinct)
                fp.append(_majority(hashes) if len(hashes) else 0)
                n.append(len(distinct))
                sig.append(s)
                keys.append(k)
            yield pd.DataFrame({"fp": np.array(fp, np.uint64).view(np.int64), "n": np.array(n, np.int32), **dict(zip(SIGNATURE, np.array(sig, np.int64).reshape(-1, 4).T, strict=True)), "keys": pd.Series(keys, dtype=object)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(F.col("text")).alias("digest"), of(F.col("text").cast("string")).alias("f")).select("doc_id", "digest", "f.*")


def _judged(pairs: DataFrame, texts: DataFrame, shingle_words: int, least: float) -> DataFrame:
    """(a, b, similar) for pairs (a, b): whether ``least`` or more of the distinct shingles of their texts (id, text) agree."""
    small_batches(pairs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = functools.lru_cache(16)(lambda text: np.unique(shingle_hashes(text, shingle_words)))
        for b in batches:
            similar = []
            for x, y in zip(b["x"], b["y"], strict=True):
                p, q = of(x), of(y)
                both = len(np.intersect1d(p, q, assume_unique=True))
                similar.append(both >= least * (len(p) + len(q) - both))
            yield pd.DataFrame({"a": b["a"], "b": b["b"], "similar": np.array(similar, bool)})

    x, y = texts.select(F.col("id").alias("a"), F.col("text").alias("x")), texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    return materialize(pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInPandas(run, "a long, b long, similar boolean"), "judged", slim=True)


def _pairs(rows: DataFrame, one: str, two: str) -> DataFrame:
    return rows.where(F.col(one) != F.col(two)).select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)  # exact: no set here has 2^24 elements in common with another
    row = np.repeat(np.arange(n), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets) if n else np.empty(0, np.uint64), return_inverse=True, return_counts=True)
    several = count > 1
    number = np.cumsum(several) - 1
    keep = several[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(several.sum()), 4096):
        a, z = np.searchsorted(column, [first, first + 4096])
        part = np.zeros((n, 4096), np.float32)
        part[row[a:z], column[a:z] - first] = 1
        out += part @ part.T
    return out


def _text_edges(rows: pd.DataFrame, shingle_words: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the components (root) of the rows' texts of which ``least`` of the distinct shingles agree; of two blocks, only across them."""
    ids, roots, side = (rows[c].to_numpy() for c in ("id", "root", "side"))
    sets = [np.unique(shingle_hashes(t, shingle_words)) for t in rows["text"]]
    sizes = np.array([len(x) for x in sets], np.float64)
    both = _common(sets)
    similar = both >= least * (sizes[:, None] + sizes[None, :] - both)
    similar &= (roots[:, None] != roots[None, :]) & ((side[:, None] != side[None, :]) | (side[None, :] == 2))
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while x in up:
            x = up[x]
        return x

    one, two = [], []
    for i, j in zip(*np.nonzero(np.triu(similar, 1)), strict=True):
        x, y = root(int(roots[i])), root(int(roots[j]))
        if x != y:
            up[max(x, y)] = min(x, y)
            one.append(ids[i])
            two.append(ids[j])
    return np.array(one, np.int64), np.array(two, np.int64)


def similar_components(docs: DataFrame, reps: DataFrame, shingle_words: int, least: float, proposed: DataFrame, block_rows: int = TEXT_ROWS) -> DataFrame:
    """(id, root): components of the pairs of ``reps`` (id, digest, n, s0 ... s3, keys) of which ``least`` or more of the distinct shingles agree;
    nodes without a link are left out.

    First the ``proposed`` pairs (a, b) and each key's members with its smallest are judged, those excepted whose sketches rule it out. Keys
    whose members are in several components still (of keys with the same members one) are then compared whole, inside tasks: their members
    are dealt over blocks of bounded size that meet two by two, and only pairs that join components come out.
    """
    members = reps.select("id", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low != high").select("key", "low")
    members = materialize(members.join(shared, "key"), "members", slim=True)
    ids = materialize(members.select("id").union(proposed.select("a")).union(proposed.select("b")).distinct(), "near-ids", slim=True)
    few = ids.count() <= BROADCAST_ROWS
    near = materialize(reps.drop("keys").join(F.broadcast(ids) if few else ids, "id"), "near")
    of_text = near.select("id", "digest")
    texts = docs.where(F.col("doc_id").isNotNull()).select(digest_of(F.col("text")).alias("digest"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = materialize(texts.join(F.broadcast(of_text) if few else of_text, "digest").groupBy("id").agg(F.first("text").alias("text")), "near-texts")
    # each key's members against its smallest
    pairs = _pairs(members, "id", "low")
    a, b = (near.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), *[F.col(c).alias(f"{c}{x}") for c in SIGNATURE]) for x in "ab")
    same_bits = sum((64 - F.bit_count(F.col(f"{c}a").bitwiseXOR(F.col(f"{c}b"))) for c in SIGNATURE), F.lit(0))
    pairs = pairs.join(a, "a").join(b, "b").where(plausible(F.col("na"), F.col("nb"), same_bits, least)).select("a", "b")
    found = _judged(pairs.union(proposed.select("a", "b")).distinct(), texts, shingle_words, least).where("similar").select("a", "b")
    roots = materialize(components(found), "roots", slim=True)
    # what is left of the keys
    placed = members.select("id", "key").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    size = near.select("id", "n")
    marks = [F.sum(F.xxhash64("id", F.lit(i)).cast("decimal(38,0)")).alias(f"m{i}") for i in range(2)]
    left = placed.join(size, "id").groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("count"), F.sum("n").alias("sum"), *marks).where("low != high")
    blocks = F.ceil(F.greatest(F.col("count") / block_rows, F.col("sum") / TEXT_SHINGLES)).cast("int")
    left = left.groupBy("count", "sum", "m0", "m1").agg(F.min("key").alias("key")).select("key", F.greatest(F.lit(1), blocks).alias("blocks"))
    open_ = materialize(placed.join(left, "key"), "open", slim=True)
    if open_.isEmpty():
        return roots
    small_batches(docs.sparkSession)
    dealt = _in_blocks(open_, "key", F.lit(True), F.col("id"), ["id", "root"]).join(texts, "id")
    more = materialize(_by_blocks(dealt, "key", lambda b: _text_edges(b, shingle_words, least)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "joined", slim=True)
    return materialize(components(more.union(roots.select(F.col("root").alias("a"), F.col("id").alias("b")))), "roots", slim=True)


def _labelled(rows: DataFrame, nodes: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``root`` and ``component_id``, the smallest doc_id of the component of their node; ``nodes`` are (id, key, first doc_id)."""
    nodes = materialize(nodes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")).select(key, "root", "first"), "nodes", slim=True)
    labels = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    known = rows.join(nodes.join(labels, "root").select(key, "root", "component_id"), key, "left")
    has = F.col("doc_id").isNotNull()
    return known.withColumn("root", F.when(has, F.col("root"))).withColumn("component_id", F.when(has, F.col("component_id")))


def grouped(docs: DataFrame, shingle_words: int = 5, radius: int = 4, parts: int = 3, least: float | None = None) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row of (doc_id, text), and ``digest`` (of the text) with ``least``; see ``near_duplicates``.

    ``root`` tells components apart whose smallest doc_id is the same, because different texts repeat it.
    """
    if least is None:
        rows = materialize(fingerprints(docs, shingle_words), "fingerprints")
        nodes = materialize(rows.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes", slim=True)
        return _labelled(rows, nodes.withColumn("id", F.col("fp")), components(links(nodes, radius, parts)), "fp")
    sketches = materialize(_sketches(docs, shingle_words), "sketches")
    rows = sketches.where(F.col("doc_id").isNotNull())
    reps = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min(F.struct("fp", "n", *SIGNATURE, "keys")).alias("m"))
    # numbers are given once, as the table is written
    reps = materialize(reps.select("digest", "first", "m.*").withColumn("id", F.monotonically_increasing_id()), "reps")
    of_fp = materialize(reps.groupBy("fp").agg(F.min("id").alias("id")), "of-fp", slim=True)
    a, b = (of_fp.select(F.col("fp").alias(x), F.col("id").alias(f"id_{x}")) for x in "ab")
    near = _pairs(links(of_fp, radius, parts).join(a, "a").join(b, "b"), "id_a", "id_b")
    same = _pairs(reps.select("fp", "id").join(of_fp.withColumnRenamed("id", "other"), "fp"), "id", "other")
    proposed = materialize(near.union(same).distinct(), "proposed", slim=True)
    roots = similar_components(docs, reps, shingle_words, least, proposed)
    return _labelled(sketches.select("doc_id", "digest", "fp"), reps.select("id", "digest", "first"), roots, "digest")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, radius: int = 4, parts: int = 3, least: float | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of (doc_id, text): rows whose fingerprints differ in ``radius`` bits or fewer are linked,
    and ``component_id`` is the smallest doc_id that links reach. With ``least``, rows are linked if that share of all their distinct shingles
    is in both, whatever their fingerprints, which then only propose pairs.

    Null, empty and blank texts share fingerprint zero and link like any other. Repeated rows each come back; a doc_id that different texts
    repeat does not link them. A row without doc_id gets a fingerprint, links nothing and has no component. An empty table gives an empty
    result. Other columns are ignored.
    """
    out = grouped(docs, shingle_words, radius, parts, least)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Settings that link texts of which 0.8 or more of the distinct shingles agree.
SIMILAR = {"shingle_words": 5, "least": 0.8}
