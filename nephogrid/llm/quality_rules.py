"""Quality rules: a learned decision list over statistics of the text.

Sequential covering: from labelled statistics, grow a conjunction of thresholds that covers low-quality texts and no others (FOIL gain), prune
it on rows kept apart, emit it if it is precise, take the rows it covers away and start again. The list becomes one ordered conditional
expression. Statistics, histograms and the expression are Spark's own; the driver only sees histograms of fixed size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephogrid.llm._common import let, materialize, words

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def statistics(text: Column) -> Column:
    """struct(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_ends) of a text; zeros for null.

    n_repeat_words counts words in 3-word windows that occur twice or more. Windows are sorted with their positions, so equal ones are
    neighbours: n log n in the length of the text, whatever repeats.
    """
    t = F.coalesce(text, F.lit(""))

    def repeated(w: Column) -> Column:
        n = F.size(w) - 2
        windows = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("w"), i.alias("i")))

        def twice(s: Column) -> Column:
            marked = F.filter(s, lambda x, k: (F.get(s, k - 1)["w"] == x["w"]) | F.coalesce(F.get(s, k + 1)["w"] == x["w"], F.lit(False)))
            at = F.flatten(F.transform(marked, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
            return F.size(F.array_distinct(at))

        return F.when(n < 1, F.lit(0)).otherwise(let(F.sort_array(windows), twice))

    def duplicates(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    ends = F.length(t) - F.length(F.translate(t, ".!?", ""))
    from_words = let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated(w).cast("long").alias("n_repeat_words")))
    from_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), duplicates(x).cast("long").alias("n_dup_lines")))
    return F.struct(
        from_words.alias("of_words"),
        from_lines.alias("of_lines"),
        F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper"),
        ends.cast("long").alias("n_ends"),
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_ends"]


def features() -> dict[str, Column]:
    """What the rules may test, by name."""
    n, c = F.greatest(F.col("n_words"), F.lit(1)).cast("double"), F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "word_length": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "upper_share": F.col("n_upper") / c,
        "ends_per_word": F.col("n_ends") / n,
        "repeat_share": F.col("n_repeat_words") / n,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"),
    }


@dataclass(frozen=True)
class Rule:
    """Texts that meet all (feature, at_least, threshold) tests are low quality; hits and misses are counts on the pruning rows."""

    tests: tuple[tuple[str, bool, float], ...]
    hits: int
    misses: int

    def condition(self) -> Column:
        f = features()
        out = F.lit(True)
        for name, at_least, t in self.tests:
            value = F.round(f[name], 3)
            out = out & ((value >= t) if at_least else (value < t))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>=' if up else '<'} {t:.6g}" for n, up, t in self.tests) + f" ({self.hits} right, {self.misses} wrong)"


def least_share(hits: int, misses: int, z: float = 1.0) -> float:
    """Wilson's lower bound of the share of hits."""
    n = hits + misses
    p = hits / n if n else 0.0
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n) if n else 0.0


def learn(labelled: DataFrame, max_rules: int = 8, max_tests: int = 3, n_cuts: int = 32, precision: float = 0.8) -> list[Rule]:
    """A decision list from rows of COUNTS, y (0: low quality) and grow (false: for pruning). Empty if either class is missing.

    A rule is emitted if the lower bound of its precision on the pruning rows is ``precision`` or more, which takes four hits without a miss.
    Features count in steps of a thousandth, so quantiles come from counts of few values and do not depend on the order of rows.
    """
    names = list(features())
    table = materialize(labelled.select(F.col("y").cast("int").alias("y"), "grow", *[F.round(c, 3).alias(k) for k, c in features().items()]), "rule-features")
    if table.where("grow").select("y").distinct().count() < 2:
        return []
    # Cuts lie at the quantiles of either class, so a rare class gets its share of them.
    by_class = table.where("grow").groupBy("y").agg(*[F.percentile(k, [i / n_cuts for i in range(n_cuts + 1)]).alias(k) for k in names]).collect()
    cuts = {k: sorted({x for r in by_class for x in r[k]}) for k in names}

    def bin_of(k: str) -> Column:
        """Bin i holds the values from cut i - 1 (inclusive) to cut i."""
        return F.aggregate(F.array(*map(F.lit, cuts[k])), F.lit(0), lambda n, t: n + (F.col(k) >= t).cast("int"))

    bins = F.array(*[F.struct(F.lit(k).alias("feature"), bin_of(k).alias("bin")) for k in names])

    def holds(tests: list[tuple[str, bool, float]]) -> Column:
        out = F.lit(True)
        for k, up, t in tests:
            out = out & ((F.col(k) >= t) if up else (F.col(k) < t))
        return out

    rules: list[Rule] = []
    left = table
    while len(rules) < max_rules:
        tests: list[tuple[str, bool, float]] = []
        while len(tests) < max_tests:
            seen = left.where(F.col("grow") & holds(tests)).select("y", F.explode(bins).alias("b")).groupBy("b.feature", "b.bin", "y").count().collect()
            of: dict[str, dict[int, list[int]]] = {k: {} for k in names}
            for r in seen:
                of[r["feature"]].setdefault(r["bin"], [0, 0])[r["y"]] += r["count"]
            p0, n0 = (sum(x[y] for x in of[names[0]].values()) for y in (0, 1))
            if not p0 or not n0:
                break
            best = None
            for k in names:
                below = [0, 0]
                for i, t in enumerate(cuts[k]):
                    below = [a + b for a, b in zip(below, of[k].get(i, [0, 0]), strict=True)]
                    for up, (p, n) in ((True, (p0 - below[0], n0 - below[1])), (False, tuple(below))):
                        if p:
                            gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                            if best is None or gain > best[0] + 1e-9:
                                best = (gain, (k, up, t))
            if best is None or best[0] <= 0:
                break
            tests.append(best[1])
        if not tests:
            break
        # Pruning: the shortest prefix of the tests that is best on rows they have not seen.
        prefixes = [tests[: i + 1] for i in range(len(tests))]
        row = left.where(~F.col("grow")).agg(*[F.count_if(holds(x) & (F.col("y") == y)).alias(f"c{i}{y}") for i, x in enumerate(prefixes) for y in (0, 1)]).first()
        worth = [(row[f"c{i}0"], row[f"c{i}1"]) for i in range(len(prefixes))]
        at = max(range(len(prefixes)), key=lambda i: ((worth[i][0] - worth[i][1]) / (worth[i][0] + worth[i][1] + 1), -i))
        hits, misses = worth[at]
        if least_share(hits, misses) < precision:
            break
        rules.append(Rule(tuple(prefixes[at]), hits, misses))
        left = left.where(~holds(prefixes[at]))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Index of the first rule that fits (from 1), null if none does, as one conditional expression."""
    out = None
    for i, r in enumerate(rules, 1):
        out = F.when(r.condition(), i) if out is None else out.when(r.condition(), i)
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, COUNTS..., base_failed, rule, kept) for every row of (doc_id, text); ``rule`` is the rule that rejects the text.

    Learns from all labelled rows that pass the base, for the others never reach the list: two thirds (by hash of the id) grow rules, one third prunes them. A null text has no words and fails the
    base; so does an empty or short one. Without labels of both classes the list is empty and only the base judges. Repeated rows each come
    back; labels that repeat an id count once; null ids and labels are not learnt from; other columns are ignored.
    """
    s = docs.select(F.col("doc_id").cast("long").alias("doc_id"), statistics(F.col("text")).alias("s"))
    s = s.select("doc_id", "s.of_words.*", "s.of_lines.*", "s.word_chars", "s.n_symbols", "s.n_upper", "s.n_ends").select("doc_id", *COUNTS)
    s = materialize(s, "text-statistics")
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("y"))
    grow = F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(3)) < 2
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rule = verdict(learn(s.where(~base).join(known, "doc_id").withColumn("grow", grow)))
    return s.withColumn("base_failed", base).withColumn("rule", F.when(~F.col("base_failed"), rule)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
