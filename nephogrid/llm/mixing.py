"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and 2. Among all rates whose words add up to each source's target, the chosen ones lie nearest to 1 in
the entropy of a quantity bounded by 2: ``rate = 2 / (1 + exp(-lambda * size / mean size))``, an exponential tilt that saturates at the
bound. The multipliers, one for each source, solve a convex dual; Newton's method finds them in a few passes over the counts of documents by
source and size. Rates become whole copies where the documents are: each has a fixed number in [0, 1) from a hash, and is taken once more where
rate and number, moved by an offset of its source, pass a whole number; of many offsets a source takes the one that comes nearest to its
target. So texts are neither shuffled nor sorted. All sums that steer the result are of whole numbers, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nephogrid.llm._common import WORD, materialize

WEIGHTS = (3, 1, 2)
#: Fractions in whole-number sums.
UNIT = 1024
#: Newton steps in one job, and how many jobs they may take; halving the bracket alone would need fewer.
STEPS, MAX_ROUNDS = 3, 40
#: Sources up to which a row for each is broadcast: some 100 bytes a row.
MANY_SOURCES = 100_000
OFFSETS = 64
#: Levels tried in one pass when targets are shared out.
LEVELS = 32


def text_size(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(per: DataFrame) -> DataFrame:
    """``per`` with ``turn``, its rows' numbers from 0 by source (code point, null last), without bringing all sources into one task."""
    by_source = F.col("source").asc_nulls_last()
    dealt = materialize(per.repartitionByRange(by_source).withColumn("part", F.spark_partition_id()), "mix-sources", slim=True)
    parts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each partition
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    here = F.row_number().over(Window.partitionBy("part").orderBy(by_source)) - 1
    return dealt.withColumn("here", here).join(F.broadcast(before), "part").withColumn("turn", F.col("before") + F.col("here")).drop("part", "here", "before")


def targets(counts: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, n_docs, n_sized, source_size, target) from the counts (source, size, n) of documents.

    Sources by code point, null last, take the ``weights`` in turn and share ``share`` times all words; a target stops at ``cap`` times its
    source's words and the excess is shared anew by weight, which is water filling: sources whose cap by weight lies below a level are full,
    the others get their weight times the level. The level is bracketed by trying several at once, each pass one aggregate of the sources.
    """
    if share > cap:
        raise ValueError("the sources cannot give that much")
    per = counts.groupBy("source").agg(F.sum("n").alias("n_docs"), F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(F.lit(0))).alias("n_sized"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("turn"), F.lit(len(weights))).cast("int"))
    per = materialize(_ranked(per).withColumn("w", w).withColumn("full", cap * F.col("source_size")).withColumn("ratio", F.col("full") / F.col("w")), "mix-shares", slim=True)
    goal = share * (per.agg(F.sum("source_size")).first()[0] or 0)
    low, high, filled, open_w = -1.0, math.inf, 0.0, 0.0  # at ``low`` the words do not suffice for the goal, at ``high`` they do
    while True:
        inside = (F.col("ratio") > low) & (F.col("ratio") < high)
        tried = per.where(inside).agg(F.percentile_approx("ratio", [i / LEVELS for i in range(1, LEVELS + 1)], 10_000)).first()[0]
        levels = sorted(set(tried or []))
        at = [(F.sum(F.when(F.col("ratio") <= x, F.col("full")).otherwise(0.0)), F.sum(F.when(F.col("ratio") > x, F.col("w")).otherwise(0.0))) for x in [low, *levels]]
        sums = per.agg(*[c for pair in at for c in pair]).first()
        for i, x in enumerate([low, *levels]):
            full, rest = sums[2 * i] or 0.0, sums[2 * i + 1] or 0.0
            if i and full + x * rest > goal:
                high = x
                break
            low, filled, open_w = x, full, rest
        if not levels:
            break
    level = (goal - filled) / open_w if open_w else 0.0
    return per.select("source", "n_docs", "n_sized", "source_size", F.when(F.col("ratio") <= low, F.col("full")).otherwise(F.col("w") * level).alias("target"))


def _rate(size: Column, lam: Column, scale: Column) -> Column:
    """Documents without words take no part: rate 0."""
    return F.when(size <= 0, F.lit(0.0)).when(lam.isNull(), F.lit(2.0)).otherwise(2.0 / (1.0 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), lam * size / scale)))))


def _near(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def multipliers(counts: DataFrame, goals: DataFrame) -> DataFrame:
    """The goals with scale (mean size) and lam, the multiplier; lam is null where the target is all the source can give.

    Raises if the multipliers do not settle.
    """
    scale = F.greatest(F.lit(1.0), F.col("source_size") / F.greatest(F.lit(1), F.col("n_sized")))
    part = F.col("target") / F.col("source_size")
    free = F.col("target") < 2.0 * F.col("source_size") * (1 - 1e-9)
    state = goals.withColumns({"scale": scale, "lam": F.when(free, F.ln(part / (2.0 - part))), "lo": F.lit(-1e5), "hi": F.lit(1e5), "done": ~free})
    state = materialize(state, "mix-state", slim=True)
    names, small = state.columns[1:], state.count() <= MANY_SOURCES
    for _ in range(MAX_ROUNDS):
        if state.where("not done").isEmpty():
            return state.select("source", "n_docs", "source_size", "target", "scale", "lam")
        for _ in range(STEPS):
            at = counts.alias("c").join(_near(state, small).alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
            r, n, size = _rate(F.col("size"), F.col("lam"), F.col("scale")), F.col("n"), F.col("size")
            whole = lambda x: F.sum(F.round(x * UNIT).cast("long"))
            sums = at.groupBy("c.source").agg(whole(n * size * r).alias("words"), whole(n * size * size / F.col("scale") * r * (1 - r / 2)).alias("slope"), *[F.first(c).alias(c) for c in names])
            over = F.col("words") / UNIT - F.col("target")
            step = F.col("lam") - over / F.greatest(F.col("slope") / UNIT, F.lit(1e-9))
            lo, hi = F.when(over < 0, F.col("lam")).otherwise(F.col("lo")), F.when(over > 0, F.col("lam")).otherwise(F.col("hi"))
            # Newton, halved back into the bracket where it leaves it
            inside = F.when((step > lo) & (step < hi), step).otherwise((lo + hi) / 2)
            near = F.col("done") | (F.abs(over) <= F.greatest(F.lit(0.5), F.col("target") * 1e-7))
            moved = {"lam": F.when(near, F.col("lam")).otherwise(inside), "lo": F.when(near, F.col("lo")).otherwise(lo), "hi": F.when(near, F.col("hi")).otherwise(hi), "done": near}
            state = sums.select("source", *[moved.get(c, F.col(c)).alias(c) for c in names])
        state = materialize(state, "mix-state", slim=True)
    raise RuntimeError(f"the multipliers did not settle in {STEPS * MAX_ROUNDS} steps")


ADDED = ("size", "source_size", "target", "rate", "copies")


def mix(docs: DataFrame, keep: list[str], size: Column | None = None, key: Column | None = None, share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The ``keep`` columns of every row of (doc_id, text, source, ...) with size, source_size, target, rate and copies.

    Null and empty texts have size 0 and are not taken. Rows without a source form a source, the last. An empty table gives an empty result.
    Other columns are ignored, whatever their names; ``keep`` with a name that is added here raises. ``size`` stands in for the words of
    ``text`` where they are counted already, ``key`` for the hash of doc_id and text that rounding goes by; rows of one key, rate and source
    are rounded alike, so repeated rows are both taken or both left.
    """
    if cap != 2.0:
        raise ValueError("rates saturate at 2")
    if clash := sorted(set(keep) & set(ADDED)):
        raise ValueError(f"rename {', '.join(clash)}: mixing adds columns of these names")
    size = text_size(F.col("text")) if size is None else size
    key = F.xxhash64(F.col("doc_id"), F.col("text")) if key is None else key
    drawn = F.pmod(F.xxhash64(key, F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    # names that no kept column can have
    sized = docs.select(*keep, F.col("source").alias("mix.source"), size.cast("long").alias("mix.size"), drawn.alias("mix.u"))
    slim = materialize(sized.select(F.col("`mix.source`").alias("source"), F.col("`mix.size`").alias("size"), F.col("`mix.u`").alias("u")), "mix-sizes", slim=True)
    counts = materialize(slim.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts", slim=True)
    goals = multipliers(counts, targets(counts, share, cap, weights))
    small = goals.count() <= MANY_SOURCES

    def copies(size: Column, rate: Column, u: Column, offset: Column) -> Column:
        moved = u + offset
        return F.when(size > 0, F.least(F.lit(2), F.floor(rate + moved - F.floor(moved)))).otherwise(F.lit(0)).cast("long")

    # Any offset rounds to the same rates; each source takes the one that comes nearest to its target.
    tried = [i / OFFSETS for i in range(OFFSETS)]
    rated = slim.alias("d").join(_near(goals, small).alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))).select("d.source", "size", "u", "target", _rate(F.col("size"), F.col("lam"), F.col("scale")).alias("rate"))
    sums = rated.groupBy("source").agg(F.first("target").alias("t"), F.array(*[F.sum(F.col("size") * copies(F.col("size"), F.col("rate"), F.col("u"), F.lit(o))) for o in tried]).alias("sums"))
    misses = F.transform("sums", lambda x, i: F.struct(F.abs(x - F.col("t")).alias("miss"), i.alias("i")))
    best = sums.select(F.col("source").alias("its"), (F.array_min(misses)["i"] / OFFSETS).alias("offset"))
    goals = materialize(goals.join(_near(best, small), F.col("source").eqNullSafe(F.col("its"))).drop("its"), "mix-goals", slim=True)
    goals = goals.select(F.struct("*").alias("mix.goal"), F.col("source").alias("mix.of"))
    mixed = sized.join(_near(goals, small), F.col("`mix.source`").eqNullSafe(F.col("`mix.of`")), "left")
    g = F.col("`mix.goal`")
    rate = _rate(F.col("`mix.size`"), g["lam"], g["scale"])
    out = [F.col("`mix.size`").alias("size"), g["source_size"].alias("source_size"), g["target"].cast("double").alias("target"), rate.alias("rate")]
    return mixed.select(*keep, *out, copies(F.col("`mix.size`"), rate, F.col("`mix.u`"), g["offset"]).alias("copies"))
