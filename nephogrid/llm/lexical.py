"""Ranked lexical search by branch and bound over trees of maxima.

One pass over the texts keeps, of each document, its length and how often it has each term of the queries; whole-corpus counts give the terms'
weights. These slim rows are sorted by document, and each task goes through its documents in ranges: for every term a tree has the greatest share of a
score that a document can get from the term in ranges of 16^h documents. A query starts at the whole range and always opens the node with the
highest sum of its terms' maxima, the one with earlier documents if sums are equal; what is popped as a single document is next in rank. It stops
when the highest sum cannot pass the worst of the best that the task has found so far, so later ranges are mostly closed near their roots.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nephogrid.llm._common import ascii_lower, materialize

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Of UTF-8 bytes: A-Z lower-cased, everything that no term has a space.
_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())
#: Children of a node, and documents of a range with as many levels as it takes.
FAN, LEVELS = 16, 3
RANGE = FAN**LEVELS
#: (term, document) pairs of a range after which it is searched, however few its documents.
MOST_PAIRS = 1 << 20
#: Terms of the queries that are searched at once; more queries are searched in blocks.
MOST_TERMS = 200_000
#: Documents of a task, at least.
LEAST_DOCUMENTS = 4 * RANGE


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


def weight(n_documents: int, document_frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * document_frequency + 1)))


@dataclass
class Best:
    """The best so far of one query, the worst of them first: (score, -place)."""

    k: int
    kept: list[tuple[int, int]]

    def floor(self) -> int:
        """What a score of a later document has to pass."""
        return self.kept[0][0] if len(self.kept) == self.k else 0

    def add(self, score: int, place: int) -> None:
        (heapq.heappushpop if len(self.kept) == self.k else heapq.heappush)(self.kept, (score, -place))


class MaxTrees:
    """The trees of all terms over one range: at each level, sorted keys (term * nodes + node) and the greatest share below."""

    def __init__(self, terms: np.ndarray, places: np.ndarray, shares: np.ndarray):
        order = np.argsort(key := terms.astype(np.int64) * RANGE + places, kind="stable")
        self.keys, self.most = [key[order]], [shares[order]]
        for _ in range(LEVELS):
            up = self.keys[-1] // FAN
            first = np.flatnonzero(np.r_[True, up[1:] != up[:-1]]) if len(up) else np.zeros(0, np.int64)
            self.keys.append(up[first])
            self.most.append(np.maximum.reduceat(self.most[-1], first) if len(first) else self.most[-1])

    def below(self, terms: np.ndarray, level: int, node: int, children: int) -> np.ndarray:
        """Sums over ``terms`` of the maxima of the ``children`` nodes of ``level`` from ``node`` on."""
        keys = self.keys[level]
        start = terms * (RANGE // FAN**level) + node
        low, high = np.searchsorted(keys, start), np.searchsorted(keys, start + children)
        many = high - low
        at = np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        sums = np.zeros(children, np.int64)
        np.add.at(sums, keys[at] - np.repeat(start, many), self.most[level][at])
        return sums

    def search(self, terms: np.ndarray, best: Best, offset: int) -> None:
        """Put the documents of this range that belong to the best there; their places count from ``offset``."""
        open_ = [(-int(self.below(terms, LEVELS, 0, 1)[0]), 0, LEVELS)]
        while open_:
            bound, place, level = heapq.heappop(open_)
            if -bound <= best.floor():
                return
            if level == 0:
                best.add(-bound, offset + place)
                continue
            sums, width = self.below(terms, level - 1, place // FAN ** (level - 1), FAN), FAN ** (level - 1)
            for i in np.flatnonzero(sums > best.floor()).tolist():
                heapq.heappush(open_, (-int(sums[i]), place + i * width, level - 1))


def _count(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, terms, times, offsets = [], [], [], [0]
            for text in b.column("text").cast(pa.binary()).to_pylist():
                found = terms_of(text) if text else []
                lengths.append(len(found))
                counts = Counter(found)
                for t in counts.keys() & vocabulary.keys():
                    terms.append(vocabulary[t])
                    times.append(counts[t])
                offsets.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32())) for x in (terms, times)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "times"])

    return run


def _search(queries: list[np.ndarray], weights: np.ndarray, documents: int, length: int, k: int):
    """Of rows sorted by document: each query's best of the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, []) for _ in queries]
        known: dict[int, int | None] = {}
        rows: list[tuple] = []
        seen = pairs = 0

        def close() -> None:
            nonlocal seen, pairs
            if not rows:
                return
            n = np.concatenate([r[1] for r in rows])
            many = np.concatenate([r[2] for r in rows])
            terms, times = (np.concatenate([r[i] for r in rows]).astype(np.int64) for i in (3, 4))
            places = np.repeat(np.arange(len(n)), many)
            m = 10 + (90 * n * documents) // length
            trees = MaxTrees(terms, places, weights[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * m[places])))
            for q, own in zip(queries, best, strict=True):
                trees.search(q, own, seen)
            ids = [i for r in rows for i in r[0]]
            for own in best:
                for _, place in own.kept:
                    if -place >= seen:
                        known[-place] = ids[-place - seen]
            live = {-place for own in best for _, place in own.kept}
            for place in known.keys() - live:
                del known[place]
            seen, pairs = seen + len(n), 0
            rows.clear()

        for b in batches:
            at = 0
            while at < b.num_rows:
                have = sum(len(r[1]) for r in rows)
                terms = b.column("terms")
                offsets = terms.offsets.to_numpy()
                stop = min(b.num_rows, at + RANGE - have)
                within = int(np.searchsorted(offsets, offsets[at] + MOST_PAIRS - pairs, side="right")) - 1  # rows up to here keep to the bound
                stop = max(min(stop, within), at + (have == 0))
                if stop > at:
                    a, z = offsets[at], offsets[stop]
                    rows.append((b.column("doc_id")[at:stop].to_pylist(), b.column("n").to_numpy()[at:stop], np.diff(offsets[at : stop + 1]), terms.values.to_numpy()[a:z].copy(), b.column("times").values.to_numpy()[a:z].copy()))
                    pairs += int(z - a)
                    at = stop
                if at < b.num_rows:
                    close()
        close()
        out = [(i, known[-place], score, -place) for i, own in enumerate(best) for score, place in own.kept]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["query", "doc_id", "score", "place"])

    return run


def _blocks(terms: DataFrame) -> list[DataFrame]:
    """(query, item_id, terms) in parts of at most MOST_TERMS terms, or one query."""
    total, n = terms.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)), F.count(F.lit(1))).first()
    parts = 1
    while total > MOST_TERMS and parts < n:
        parts = min(n, max(2 * parts, math.ceil(total / MOST_TERMS)))
        most = terms.groupBy(F.pmod(F.xxhash64("query"), F.lit(parts))).agg(F.sum(F.size("terms")).alias("t")).agg(F.max("t")).first()[0]
        if most <= MOST_TERMS:
            break
    return [terms.where(F.pmod(F.xxhash64("query"), F.lit(parts)) == p) for p in range(parts)] if total else []


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents (doc_id, text) of every row of ``items`` (item_id, text), with scores above 0.

    Terms are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased; null texts have none. A term's weight is
    floor(1000 ln((2 N + 2) / (2 df + 1))), N being the documents with a term; a document of n terms has m = 10 + 90 n N div L, L being all terms;
    its score is the sum of weight * (10^9 tf div (1000 tf + 8 m)) over the query's distinct terms. Equal scores go by doc_id, null ids last; rows
    that repeat an id are ranked each. Items that repeat an id are searched each and ranked by themselves; items without a term have no rows, like
    empty tables. Other columns are ignored. Queries are searched in blocks of at most MOST_TERMS distinct terms, each a pass over the texts.
    """
    spark = docs.sparkSession
    words = F.array_distinct(F.regexp_extract_all(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(TERM), F.lit(0)))
    asked = materialize(items.select("item_id", F.monotonically_increasing_id().alias("query"), words.alias("terms")), "queries", slim=True)
    kind, found = items.schema["item_id"].dataType.simpleString(), None
    for block in _blocks(asked):
        part = _search_block(docs, block.collect(), k).select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")
        found = part if found is None else found.union(part)
    return found if found is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


def _search_block(docs: DataFrame, queries: list, k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    asked = [np.array(sorted({vocabulary.setdefault(t.encode(), len(vocabulary)) for t in q["terms"]}), np.int64) for q in queries]
    sent = spark.sparkContext.broadcast(vocabulary)
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda batches: _count(sent.value)(batches), "doc_id long, n long, terms array<int>, times array<int>")
    counted = materialize(counted.where("n > 0"), "term-counts")
    documents, length, pairs = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0)).cast("long")).first()
    frequency = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect())  # a row for each term of the block at most
    weights = np.array([weight(documents, frequency.get(t, 0)) for t in range(len(vocabulary))], np.int64)
    setup = spark.sparkContext.broadcast((asked, weights))
    order = F.col("doc_id").asc_nulls_last()
    tasks = max(1, min(documents // LEAST_DOCUMENTS, 8 * spark.sparkContext.defaultParallelism), pairs // (64 * MOST_PAIRS))
    ranges = counted.where(F.size("terms") > 0).repartitionByRange(tasks, order).sortWithinPartitions(order)
    best = ranges.mapInArrow(lambda batches: _search(*setup.value, documents, length, k)(batches), "query int, doc_id long, score long, place long")
    names = spark.createDataFrame([(i, q["query"], str(q["item_id"]) if q["item_id"] is not None else None) for i, q in enumerate(queries)], "query int, row long, item_id string")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), order, "place"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
