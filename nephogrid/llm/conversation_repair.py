"""Cheapest repair of a conversation's structure, by dynamic programming over a trie of signatures.

A row becomes one character, its role's initial and its fault; a conversation becomes a signature, one character a row. Signatures are sorted, so
those that share a beginning follow each other, and a task walks the trie they form with the path from the root as a stack: a layer of the
dynamic programme is made once for each shared prefix, and where a signature ends its answer is read off.

A repaired conversation has the role initials ``(s?(ua)+)?``. Keeping a row costs nothing, giving it another role 3, leaving it out 4 (blank rows
and duplicates must be), an empty new row 3; a truncated row that stays costs 3 more. Of the cheapest edits those whose initials (K, R, D, I) come
first in ASCII are taken. What comes next in a repaired conversation follows from what it has, so the initials say all about the edits.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephogrid.llm._common import materialize, with_group

SPACES = " \t\n\x0b\x0c\r"
OK, TRUNCATED, BLANK, DUPLICATE = range(4)
#: A row's character: 4 * fault + 0, 1, 2 or 3 for the initial s, u, a or another.
ALPHABET = "ABCDEFGHIJKLMNOP"
REROLE, DELETE, INSERT, KEEP_TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a; what comes next is s or u, u, a, u.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = "uuau"
#: A script has K and D for rows that are kept or left out, u and a for new roles, U and A for new rows; their initials are those of the edits.
TO_INITIALS = str.maketrans("uaUA", "RRII")
LEGAL = {(0, 1), (1, 2), (2, 1)}
FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _kept(state: int, initial: int) -> int | None:
    """The state after a row of this initial, if it fits."""
    if initial == 0:
        return AFTER_S if state == START else None
    if initial == 1:
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if initial == 2 and state == AFTER_U else None


def _next(state: int) -> int:
    return AFTER_A if state == AFTER_U else AFTER_U


#: (cost above the layer's least, rank of the edits so far) of each state that is reached; edits end with the one of the last row.
Layer = tuple[tuple[int, int] | None, ...]


@cache  # layers differ by small costs and by order, so there are few
def step(layer: Layer, symbol: str) -> tuple[Layer, int, tuple]:
    """The layer after a row, how much its least cost grows, and for each state the one before and the edits in between.

    Edits of two states never start with each other's, as each ends with that of the same row; so their order is that of their ranks and what
    follows, and a rank stands for all that came before.
    """
    fault, initial = divmod(ALPHABET.index(symbol), 4)
    stays = KEEP_TRUNCATED if fault == TRUNCATED else 0
    found: dict[int, tuple] = {}
    for before, reached in enumerate(layer):
        if reached is None:
            continue
        (cost, rank), state, new = reached, before, ""
        for _ in range(3):  # new rows before this one: more would only repeat states
            moves = [("D", state, DELETE)]
            if fault in (OK, TRUNCATED):
                moves.append((NEXT[state], _next(state), REROLE + stays))
                if (kept := _kept(state, initial)) is not None:
                    moves.append(("K", kept, stays))
            for edit, to, price in moves:
                edits = new + edit
                way = (cost + price, rank, edits.translate(TO_INITIALS), before, edits)
                found[to] = min(found.get(to, way), way)
            new, state, cost = new + NEXT[state].upper(), _next(state), cost + INSERT
    least = min(w[0] for w in found.values())
    order = {s: i for i, s in enumerate(sorted(found, key=lambda s: found[s][1:3]))}
    after = tuple((found[s][0] - least, order[s]) if s in found else None for s in range(4))
    return after, least, tuple(found[s][3:] if s in found else None for s in range(4))


@cache
def last(layer: Layer) -> tuple[int, int, str]:
    """What ending here costs above the least, the state that is ended in, and the new rows at the end."""
    ways = []
    for state, reached in enumerate(layer):
        if reached:
            new, at = "", state
            while at not in (START, AFTER_A):
                new, at = new + NEXT[at].upper(), _next(at)
            ways.append((reached[0] + INSERT * len(new), reached[1], state, new))
    cost, _, state, new = min(ways)
    return cost, state, new


class Trie:
    """The path from the root to the signature at hand; signatures come sorted."""

    def __init__(self) -> None:
        self.path, self.layers, self.costs, self.illegal = "", [], array("q"), array("q")
        self.answer: tuple | None = None

    def insert(self, signature: str) -> tuple:
        """(blank, duplicate, truncated, illegal, cost, script) of a signature."""
        if self.answer is not None and signature == self.path:
            return self.answer
        low, high = 0, min(len(signature), len(self.path))
        while low < high:  # the longest shared prefix
            mid = (low + high + 1) // 2
            low, high = (mid, high) if signature[:mid] == self.path[:mid] else (low, mid - 1)
        del self.layers[low:], self.costs[low:], self.illegal[low:]
        layer: Layer = self.layers[-1][0] if low else ((0, 0), None, None, None)
        for i in range(low, len(signature)):
            self.layers.append(step(layer, signature[i]))
            layer = self.layers[-1][0]
            self.costs.append(self.layers[-1][1] + (self.costs[-1] if i else 0))
            pair = (ALPHABET.index(signature[i - 1]) % 4, ALPHABET.index(signature[i]) % 4) if i else (0, 1)
            self.illegal.append((pair not in LEGAL) + (self.illegal[-1] if i else 0))
        cost, state, new = last(layer)
        edits = [new]
        for _, _, ways in reversed(self.layers):
            state, edit = ways[state]
            edits.append(edit)
        count = [sum(map(signature.count, ALPHABET[4 * f : 4 * f + 4])) for f in range(4)]
        self.path = signature
        self.answer = (count[BLANK], count[DUPLICATE], count[TRUNCATED], self.illegal[-1] if signature else 0, cost + (self.costs[-1] if signature else 0), "".join(reversed(edits)))
        return self.answer


def _fault(text: Column) -> Column:
    end = F.right(F.rtrim(text, F.lit(SPACES)), F.lit(1))
    return F.when(end == "", BLANK).when(end.isin(".", "!", "?"), OK).otherwise(TRUNCATED)


def _initial(role: Column) -> Column:
    first = F.substr(role, F.lit(1), F.lit(1))
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows (conv_id, symbol): the characters of each conversation in each batch, numbered in order."""
    part = TaskContext.get().partitionId()
    for no, b in enumerate(batches):
        ids = b.column("conv_id")
        null, value = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        cuts = [0, *(np.flatnonzero((value[1:] != value[:-1]) | (null[1:] != null[:-1])) + 1), len(value)] if len(value) else [0]
        symbols = b.column("symbol").to_pylist()
        pieces = ["".join(s for s in symbols[a:z] if s) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(cuts[:-1], pa.int64())), pa.array([part] * len(pieces), pa.int64()), pa.array([no] * len(pieces), pa.int64()), pa.array(pieces, pa.string())], ["conv_id", "part", "no", "piece"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of sorted rows (conv_id, gaps, signature)."""
    trie, names = Trie(), ["blank", "duplicate", "truncated", "illegal", "cost", "script"]
    for b in batches:
        answers = [trie.insert(s) for s in b.column("signature").to_pylist()]
        found = [pa.array([a[i] for a in answers], pa.string() if n == "script" else pa.int64()) for i, n in enumerate(names)]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("gaps"), *found], ["conv_id", "gaps", *names])


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's rows with its edits made: first comes the row with its script, then its turns in order."""
    script, at, position, conv = "", 0, 0, None
    made: list[tuple] = []

    def new_rows() -> None:
        nonlocal at, position
        while at < len(script) and script[at] in "UA":
            made.append((conv, position, "user" if script[at] == "U" else "assistant", "", "I"))
            at, position = at + 1, position + 1

    for b in batches:
        columns = [b.column(n).to_pylist() for n in ("conv_id", "script", "role", "text")]
        heads, at_head = b.column("script").is_valid(), []
        for c, own, role, text in zip(*columns, strict=True):
            if own is not None:
                new_rows()  # what the conversation before still gets
                script, at, position, conv = own, 0, 0, c
                at_head.append(len(made))
                made.append((c, None, None, None, None))
                continue
            new_rows()
            edit, at = script[at], at + 1
            if edit != "D":
                made.append((c, position, role if edit == "K" else "user" if edit == "u" else "assistant", text, edit.translate(TO_INITIALS)))
                position += 1
        facts = b.column("facts").filter(heads)
        where = np.full(len(made), -1)
        where[at_head] = np.arange(len(at_head))
        yield _rows(made, facts.take(pa.array(where, mask=where < 0)))
        made.clear()
    new_rows()
    if made:
        yield _rows(made, pa.nulls(len(made), pa.struct([(n, pa.string() if kind == "string" else pa.int64()) for n, kind in (f.split() for f in FACTS.split(", "))])))


def _rows(made: list[tuple], facts: pa.Array) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([*(pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)), facts], ["conv_id", "position", "role", "text", "edit", "facts"])


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """(conv_id, position, role, text, edit, facts): for every conversation of (conv_id, turn, role, text) a row with its facts, then its repaired rows.

    Facts are gaps (turns that no row has between the least and the greatest; at most 2^63 - 1), the numbers of blank, duplicate and truncated
    rows and of illegal pairs of adjacent roles, the cost and the initials of the edits; they are null in the repaired rows, whose edit is K, R or
    I. Rows come by turn, null turns first, those of one turn by the digest of role and text; a row's first fault counts. Null roles and texts are
    one space; rows without conv_id are one conversation; rows where ``present`` is false only say that their conversation is there. Empty tables
    give no rows; other columns are ignored.

    Texts are shuffled once; before, rows of a digest and a character are sorted by ranges that cut a long conversation anywhere. Edits are made
    in one task for a conversation, which holds a batch of its texts and one character for each row.
    """
    t = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("live"),
    )
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    t = t.withColumn("key", F.unhex(F.sha2(F.concat_ws(":", conv, F.length("role").cast("string"), F.concat("role", "text")), 256)))
    slim = materialize(t.select("conv_id", "turn", "key", "live", _fault(F.col("text")).alias("fault"), _initial(F.col("role")).alias("initial"), F.monotonically_increasing_id().alias("row")), "conversation-rows", slim=True)
    order = F.struct(F.col("turn").isNotNull().alias("has_turn"), "turn", "row")
    repeated = slim.where(F.col("live") & (F.col("fault") != BLANK)).groupBy("key").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = materialize(repeated, "repeated-turns", slim=True)
    met = with_group(slim, repeated, "key", slim.count(), "left")
    is_copy = F.coalesce(F.col("first.row") != F.col("row"), F.lit(False)) & (F.col("fault") != BLANK)
    symbol = F.substr(F.lit(ALPHABET), 4 * F.when(is_copy, DUPLICATE).otherwise(F.col("fault")) + F.col("initial") + 1, F.lit(1))
    marked = materialize(met.select("conv_id", "turn", "key", "row", F.when(F.col("live"), symbol).alias("symbol")), "marked-turns", slim=True)
    by = ["conv_id", "turn", "key", "row"]
    pieces = marked.repartitionByRange(*by).sortWithinPartitions(*by).select("conv_id", "symbol").mapInArrow(_pieces, "conv_id long, part long, no long, piece string")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "no", "piece"))), lambda p: p["piece"]), "")
    signatures = pieces.groupBy("conv_id").agg(whole.alias("signature"))
    wide = lambda c: c.cast("decimal(38,0)")
    span = wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn")
    gaps = marked.where("symbol is not null").groupBy("conv_id").agg(F.when(span.isNotNull(), F.least(span, F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")).alias("gaps"))
    gaps = gaps.withColumnRenamed("conv_id", "of")
    known = signatures.join(gaps, F.col("conv_id").eqNullSafe(F.col("of")), "left").select("conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "signature")
    known = materialize(known, "signatures")  # the ranges of the next step are sampled from it
    answers = known.repartitionByRange("signature", "conv_id").sortWithinPartitions("signature", "conv_id").mapInArrow(_walk, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, script string")
    facts = F.struct("gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.translate("script", "uaUA", "RRII").alias("audit"))
    heads = answers.select("conv_id", F.lit(False).alias("is_turn"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("key"), "script", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), facts.alias("facts"))
    texts = t.where("live").select("conv_id", F.lit(True).alias("is_turn"), "turn", "key", F.lit(None).cast("string").alias("script"), "role", "text", F.lit(None).cast(f"struct<{FACTS.replace(' ', ':').replace(',:', ',')}>").alias("facts"))
    together = heads.union(texts).repartition("conv_id").sortWithinPartitions("conv_id", "is_turn", "turn", "key").select("conv_id", "script", "role", "text", "facts")
    return together.mapInArrow(_edit, f"conv_id long, position long, role string, text string, edit string, facts struct<{FACTS.replace(' ', ':').replace(',:', ',')}>")


def digest(repaired: DataFrame) -> DataFrame:
    """(conv_id, the facts, repaired_sha256) from what ``repair`` returns, read as it comes: the SHA-256 of the repaired ``role:text``, joined by line breaks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha, done = None, hashlib.sha256(), []
        names = [f.split()[0] for f in FACTS.split(", ")]

        def out() -> pa.RecordBatch:
            rows = [(c, *(f[n] for n in names), s) for c, f, s in done]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for i, n in enumerate(["conv_id", *names, "repaired_sha256"])], ["conv_id", *names, "repaired_sha256"])

        for b in batches:
            for c, facts, position, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "facts", "position", "role", "text")), strict=True):
                if facts is not None:
                    if head:
                        done.append((*head, sha.hexdigest()))
                    head, sha = (c, facts), hashlib.sha256()
                else:
                    sha.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            yield out()
        if head:
            done.append((*head, sha.hexdigest()))
            yield out()

    return repaired.mapInArrow(run, f"conv_id long, {FACTS}, repaired_sha256 string")
