"""Exact top-k inner products by a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it; equal-width annuli around each pivot are the cells. For a query q, a pivot
p and a vector x of a cell, ``|q - x| >= max(|q - p| - d_max, d_min - |q - p|, 0)``, so ``<q, x> = (|q|^2 + |x|^2 - |q - x|^2) / 2`` is
bounded by what the cell's table entry says. A query first takes its cells in order of that bound until enough vectors are in; the
k-th best score so far then closes every cell whose bound lies below it. The rest are searched. The result is exact.

The cell table has at most pivots times rings rows and is what the driver and the tasks hold. Pivots grow with the root of the number of
vectors up to a bound. Vectors and queries meet in blocks: a cell's vectors are dealt over slots of bounded size, its queries over packs of
bounded size, and a pack is sent once to each group of slots in which it has something to search. How much the bounds close is up to the data: vectors whose neighbours are about as far away as all others leave nearly every
cell open, and the search is then a blocked product of queries and vectors.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nephogrid.llm._common import materialize

#: Least and most pivots. Between them there is one for each 64 of the root's square, so that cells have some thousands of vectors.
PIVOTS, MOST_PIVOTS, RINGS = 24, 4096, 24
SLOT_ROWS, PACK_ROWS = 2048, 256
#: Slots of a group: a pack of queries is sent once to each group where it has a cell to search. Groups of each core, where there are enough slots.
GROUP_SLOTS, GROUPS_A_CORE = 64, 4
LONG = (1 << 63) - 1

def quantized(embedding: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component, as doubles that hold whole numbers; null if the vector is null or has a component that is null or, scaled, not finite."""
    v = F.transform(embedding.cast("array<double>"), lambda x: x * scale)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # from 2^53 on doubles are whole, and beyond 2^63 floor would not hold them
    return F.when(fine, F.transform(v, lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact; beyond 2^63 - 1 either way they count as that."""
    if q.dtype == np.int16:
        return np.rint(q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    most_q, most_x = np.abs(q).max(axis=1, initial=0), np.abs(x).max(axis=1, initial=0)
    with np.errstate(over="ignore"):
        size = np.outer(most_q, most_x) * max(1, q.shape[1])
        if (top := size.max(initial=0)) < 2.0**53:
            return np.rint(q @ x.T).astype(np.int64)
    small = 2.0**62
    out = np.clip(q, -small, small).astype(np.int64) @ np.clip(x, -small, small).astype(np.int64).T
    if top >= small:  # what may not fit is summed as Python's whole numbers
        whole = {}
        for i, j in np.argwhere(size >= small).tolist():
            for key, row in ((("q", i), q[i]), (("x", j), x[j])):
                if key not in whole:
                    whole[key] = list(map(int, row.tolist()))
            exact = sum(map(operator.mul, whole["q", i], whole["x", j]))
            out[i, j] = max(-LONG, min(LONG, exact))
    return out


def pivots_for(n: int) -> int:
    return min(MOST_PIVOTS, max(PIVOTS, math.isqrt(n // 64)))


def _matrix(raw: pd.Series, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(raw), kind).reshape(-1, dim)


def _ceiling(d_qp: np.ndarray, q2: np.ndarray, cells: dict[str, np.ndarray]) -> np.ndarray:
    """Upper bounds of the inner products of queries (rows) with the vectors of cells (columns), rounding outwards; where doubles overflow, infinity."""
    with np.errstate(over="ignore", invalid="ignore"):
        d = d_qp[:, cells["pivot"]]
        # distances come from squared norms: near zero they are off by the root of those norms' rounding
        slack = 1e-6 + 1e-6 * (np.sqrt(q2)[:, None] + np.sqrt(cells["norm"]) + d)
        gap = np.maximum(0.0, np.maximum(d - cells["d_max"], cells["d_min"] - d) - slack)
        both = q2[:, None] + cells["norm"]
        return np.nan_to_num((both - np.square(gap)) / 2 + 1e-3 + 1e-12 * both, nan=np.inf, posinf=np.inf, neginf=-np.inf)


class PivotIndex:
    """The index over (num, vec_id, v): rows of whole numbers, zero-extended to the longest; ``num`` tells rows apart."""

    def __init__(self, vectors: DataFrame, pivots: int | None = None, rings: int = RINGS):
        spark = vectors.sparkSession
        shape = vectors.agg(F.max(F.size("v")).alias("dim"), F.max(F.array_max(F.transform("v", F.abs))).alias("top"), F.count(F.lit(1)).alias("n")).first()
        self.empty = shape["dim"] is None
        if self.empty:
            return
        self.dim = dim = max(1, shape["dim"])
        self.kind = kind = "<i2" if (shape["top"] or 0) < 2**15 and dim < 2**22 else "<f8"
        # Pivots: a sample by hash of the id, bounded by its size; equal ones once.
        sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots or pivots_for(shape["n"])).select("v").collect()
        self.pivots = at = np.unique(np.array([[*r["v"], *[0.0] * (dim - len(r["v"]))] for r in sample], np.float64), axis=0)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                m = np.zeros((len(b), dim))
                for i, v in enumerate(b["v"]):
                    m[i, : len(v)] = v
                with np.errstate(over="ignore", invalid="ignore"):
                    d2 = _distances2(m, at)
                    near = d2.argmin(1)
                    norm = np.nan_to_num(np.square(m).sum(1), nan=np.inf, posinf=np.inf)
                yield pd.DataFrame({"num": b["num"], "vec_id": b["vec_id"], "pivot": near, "dist": np.sqrt(d2[np.arange(len(b)), near]), "norm": norm, "raw": [x.tobytes() for x in m.astype(kind)]})

        keyed = materialize(vectors.mapInPandas(run, "num long, vec_id long, pivot int, dist double, norm double, raw binary"), "keyed")
        finite = F.col("dist") < float("inf")
        width = max(1e-9, keyed.agg(F.max(F.when(finite, F.col("dist")))).first()[0] or 0.0) / rings * (1 + 1e-9)
        keyed = keyed.withColumn("ring", F.when(finite, F.floor(F.col("dist") / width)).otherwise(rings).cast("int"))  # the last ring is open
        table = keyed.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("d_min"), F.max("dist").alias("d_max"), F.max("norm").alias("norm")).orderBy("pivot", "ring").collect()
        self.cells = {k: np.array([r[k] for r in table]) for k in ("pivot", "ring", "n", "d_min", "d_max", "norm")}
        slots = np.array([-(-r["n"] // SLOT_ROWS) for r in table])
        # groups hold slots that follow each other, a cell's over several groups if it has many
        groups = min(int(slots.sum()), max(-(-int(slots.sum()) // GROUP_SLOTS), GROUPS_A_CORE * spark.sparkContext.defaultParallelism))
        self.first_slot, self.last_slot, self.per_group = np.cumsum(slots) - slots, np.cumsum(slots) - 1, -(-int(slots.sum()) // groups)
        places = spark.createDataFrame([(r["pivot"], r["ring"], i, int(a), int(n)) for i, (r, a, n) in enumerate(zip(table, self.first_slot, slots, strict=True))], "pivot int, ring int, cell int, first_slot int, slots int")
        dealt = keyed.join(F.broadcast(places), ["pivot", "ring"])  # pivots times rings at most
        slot = (F.col("first_slot") + F.pmod(F.xxhash64("num"), F.col("slots").cast("long"))).cast("int")
        self.blocks = materialize(_packed(dealt.withColumn("slot", slot), ["cell", "slot"]).withColumn("grp", F.floor(F.col("slot") / self.per_group).cast("int")), "blocks")
        self.spark = spark

    def _visits(self, packs: DataFrame, near: bool, enough: int) -> DataFrame:
        """(grp, q_nums, q_ids, q_rows, cells, rows_of): each pack of queries once for every group where it has cells to search, first (``near``) or
        because of its queries' floors (``least``), with the queries that search each cell."""
        cells, at, dim, kind = self.cells, self.pivots, self.dim, self.kind
        first_group, last_group = self.first_slot // self.per_group, self.last_slot // self.per_group

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for nums, ids, rows, least in zip(b["nums"], b["ids"], b["rows"], b["least"], strict=True):
                    q = np.frombuffer(rows, kind).reshape(-1, dim).astype(np.float64)
                    with np.errstate(over="ignore", invalid="ignore"):
                        q2 = np.nan_to_num(np.square(q).sum(1), nan=np.inf, posinf=np.inf)
                        high = _ceiling(np.sqrt(_distances2(q, at)), q2, cells)
                    order = np.argsort(-high, axis=1, kind="stable")
                    before = np.cumsum(cells["n"][order], axis=1) - cells["n"][order]
                    wanted = np.zeros(high.shape, bool)
                    np.put_along_axis(wanted, order, before < enough, axis=1)
                    if not near:
                        wanted = ~wanted & (high >= np.frombuffer(least, "<f8")[:, None])
                    sent: dict[int, tuple[list, list]] = {}
                    for c in np.flatnonzero(wanted.any(axis=0)).tolist():
                        own = np.flatnonzero(wanted[:, c]).astype("<i4").tobytes()
                        for g in range(first_group[c], last_group[c] + 1):
                            into = sent.setdefault(g, ([], []))
                            into[0].append(c)
                            into[1].append(own)
                    for g, (which, own) in sent.items():
                        yield pd.DataFrame({"grp": [g], "q_nums": [nums], "q_ids": [ids], "q_rows": [rows], "cells": [which], "rows_of": [own]})

        return packs.mapInPandas(run, "grp int, q_nums binary, q_ids binary, q_rows binary, cells array<int>, rows_of array<binary>")

    def _search(self, visits: DataFrame, k: int) -> DataFrame:
        """(query, query_id, vec_id, score): the best k of each query row in the cells it visits, or more; ``query`` is the row's number."""
        dim, kind = self.dim, self.kind
        sides = ["q_nums", "q_ids", "q_rows", "own", "nums", "ids", "rows"]
        own = F.try_element_at("rows_of", F.array_position("cells", F.col("cell")).cast("int"))
        met = visits.join(self.blocks, "grp").where(F.array_contains("cells", F.col("cell"))).withColumn("own", own).select(*sides)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                found = []
                for q_nums, q_ids, q_rows, some, nums, ids, rows in zip(*[b[c] for c in sides], strict=True):
                    some = np.frombuffer(some, "<i4")
                    qn, qi, xn, xi = (np.frombuffer(r, "<i8") for r in (q_nums, q_ids, nums, ids))
                    q, x = (np.frombuffer(r, kind).reshape(-1, dim) for r in (q_rows, rows))
                    qn, qi = qn[some], qi[some]
                    s = products(q[some], x)
                    # ids ascend within a block, so a stable order breaks ties as asked; no more than k of a block go on
                    own = qn[:, None] == xn[None, :]
                    m = len(xi)
                    if m > k and max(int(s.max(initial=0)), -int(s.min(initial=0))) < (1 << 61) // (m + 1):
                        key = np.where(own, np.iinfo(np.int64).min, s * m + np.arange(m - 1, -1, -1))
                        j = np.argpartition(key, m - k, axis=1)[:, m - k :]
                    else:
                        j = np.argsort(np.where(own, np.iinfo(np.int64).max, -s), axis=1, kind="stable")[:, :k]
                    i = np.repeat(np.arange(len(qi)), j.shape[1])
                    j = j.ravel()
                    i, j = i[~own[i, j]], j[~own[i, j]]
                    found.append((qn[i], qi[i], xi[j], s[i, j]))
                if found:
                    n, q, x, s = (np.concatenate(c) for c in zip(*found, strict=True))
                    order = np.lexsort((x, -s, n))
                    n, q, x, s = n[order], q[order], x[order], s[order]
                    begins = np.flatnonzero(np.concatenate(([True], n[1:] != n[:-1]))) if len(n) else np.empty(0, np.int64)
                    rank = np.arange(len(n)) - np.repeat(begins, np.diff(np.concatenate([begins, [len(n)]])))
                    best = rank < k
                    yield pd.DataFrame({"query": n[best], "query_id": q[best], "vec_id": x[best], "score": s[best]})

        return met.mapInPandas(run, "query long, query_id long, vec_id long, score long")

    def top(self, is_query: Column, k: int) -> DataFrame:
        """(query_id, rank, vec_id, score) of the index's own vectors for which ``is_query`` (of vec_id) holds."""
        rows = self.blocks.mapInPandas(_unpacked(self.dim * np.dtype(self.kind).itemsize), "num long, vec_id long, raw binary")
        queries = materialize(rows.where(is_query), "queries")
        pack = F.pmod(F.xxhash64("num", F.lit("pack")), F.lit(-(-max(1, queries.count()) // PACK_ROWS)).cast("long")).cast("int")
        packs = materialize(_packed(queries.withColumn("pack", pack), ["pack"]), "packs")
        best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
        enough = max(64, 8 * (k + 1))
        near = self._search(self._visits(packs.withColumn("least", F.lit(None).cast("binary")), True, enough), k)
        first = materialize(near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "first")
        least = first.where(F.col("rank") == k).select(F.col("query").alias("num"), F.col("score").cast("double").alias("least"))
        rest = self._search(self._visits(_floored(packs, least), False, enough), k)
        both = first.select("query", "query_id", "vec_id", "score").union(rest)
        return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _distances2(m: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of rows to pivots; what overflows is infinite."""
    d2 = np.square(m).sum(1)[:, None] + np.square(at).sum(1) - 2 * m @ at.T
    return np.nan_to_num(np.maximum(0.0, d2), nan=np.inf, posinf=np.inf)


def _floored(packs: DataFrame, least: DataFrame) -> DataFrame:
    """The packs with ``least``, the floors of their queries in order (num, least); a query without one has none."""

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, nums in zip(b["pack"], b["nums"], strict=True):
                n = np.frombuffer(nums, "<i8")
                yield pd.DataFrame({"pack": p, "at": np.arange(len(n)), "num": n})

    each = packs.select("pack", "nums").mapInPandas(numbers, "pack int, at long, num long").join(least, "num", "left")
    floors = each.groupBy("pack").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", F.coalesce("least", F.lit(float("-inf"))).alias("least")))), lambda x: x["least"]).alias("floors"))  # a pack's queries are bounded

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns="floors").assign(least=[np.array(f, "<f8").tobytes() for f in b["floors"]])

    return packs.join(floors, "pack").mapInPandas(packed, "pack int, nums binary, ids binary, rows binary, least binary")


def _packed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row (keys, nums, ids, rows) for each of the keys' groups of (num, vec_id, raw), which the caller keeps small; by vec_id within."""
    rows = rows.select(*keys, "num", "vec_id", "raw").repartition(*keys).sortWithinPartitions(*keys, "vec_id", "num")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, nums, ids, raws = None, [], [], []

        def closed() -> tuple:
            return (*key, np.array(nums, "<i8").tobytes(), np.array(ids, "<i8").tobytes(), b"".join(raws))

        for b in batches:
            out = []
            for *k, num, i, r in zip(*[b[c].tolist() for c in [*keys, "num", "vec_id"]], b["raw"], strict=True):
                if k != key:
                    if ids:
                        out.append(closed())
                    key, nums, ids, raws = k, [], [], []
                nums.append(num)
                ids.append(i)
                raws.append(r)
            if out:
                yield pd.DataFrame(out, columns=[*keys, "nums", "ids", "rows"])
        if ids:
            yield pd.DataFrame([closed()], columns=[*keys, "nums", "ids", "rows"])

    return rows.mapInPandas(run, ", ".join(f"{c} int" for c in keys) + ", nums binary, ids binary, rows binary")


def _unpacked(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for nums, ids, rows in zip(b["nums"], b["ids"], b["rows"], strict=True):
                n = np.frombuffer(ids, "<i8")
                yield pd.DataFrame({"num": np.frombuffer(nums, "<i8"), "vec_id": n, "raw": [rows[i * width : (i + 1) * width] for i in range(len(n))]})

    return run


def top_k(embeddings: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, pivots: int | None = None, rings: int = RINGS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector of (vec_id, embedding) for which ``is_query`` (an expression of vec_id) holds, the k other
    vectors of the highest integer inner product, all if there are fewer; ties go to the smaller vec_id.

    Components are floor(scale * x). Vectors that are null or hold a component that is null or, scaled, not finite, and rows without a vec_id, take no part.
    Rows that repeat a vec_id are vectors of their own, as candidates (also of each other) and as queries. Vectors of different lengths are
    compared as if zero-extended, empty ones too. Products are exact whatever the components; one that does not fit a long counts as the
    nearest long. An empty table gives an empty result; other columns are ignored. ``pivots`` stands in for the number that grows with the vectors.
    """
    v = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), quantized(F.col("embedding"), scale).alias("v")).where("vec_id is not null and v is not null")
    # rows are numbered once, as they are written
    index = PivotIndex(materialize(v.withColumn("num", F.monotonically_increasing_id()), "vectors"), pivots, rings)
    if index.empty:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return index.top(is_query, k)
