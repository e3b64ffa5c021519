"""What several operators of this subpackage share: scratch tables, let-bindings, words and label samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nephogrid.storage import materialize, scratch_root

__all__ = ["LOWER", "Remembered", "UPPER", "WORD", "ascii_lower", "crc_mod", "label_sample", "let", "materialize", "scratch_root", "small_batches", "table", "with_group", "words"]

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Let Arrow batches to Python hold no more than ``size`` of a column's texts: each is held several times over while it is turned into Python's."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` (or a lambda in it) uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


_ABSENT = object()


class Remembered(dict):
    """Word -> ``made(word)``, kept in two generations of at most ``most`` words: when the young one is full it becomes the old one, whose words
    come back as they are met. Long words are not kept."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def made(self, word: str):
        raise NotImplementedError

    def __missing__(self, word: str):
        out = self.old.get(word, _ABSENT)
        if out is _ABSENT:
            out = self.made(word)
        if len(word) <= 40:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[word] = out
        return out


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def label_sample(labels: DataFrame, label: str, held_out: Callable[[Column], Column], per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """A hash sample of about ``per_class`` labelled rows of each class outside ``held_out``: (doc_id, y), and the class sizes.

    It is counted before it is broadcast; more than a fifth above what was asked for raises. Null ids and labels take no part, labels other
    than 0 and 1 neither; of rows that repeat a doc_id the larger label counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = [min(1.0, per_class / max(1, sizes.get(y, 0))) for y in (0, 1)]
    # A uniform number in [0, 1) that only depends on the id.
    u = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    taken = materialize(known.where(u < F.when(F.col("y") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))), "label-sample")
    if (n := taken.count()) > int(2 * per_class * 1.2 + 100):
        raise ValueError(f"a sample of {n} rows is too large to broadcast")
    return taken, sizes


#: Groups that can each hold more than this part of all rows.
HEAVY_GROUPS = 100_000


def with_group(rows: DataFrame, groups: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """``rows``, each with the columns of its group of ``groups`` (one for each ``key``, with ``n``, the number of its rows).

    ``total`` is the number of all rows or more. Groups of over a HEAVY_GROUPS-th of it can be HEAVY_GROUPS at most, so they are broadcast and their rows
    stay where they are; the others meet their rows by a shuffle in which no key holds more than that part. Rows without a group are left out,
    or stay if ``how`` is left.
    """
    heavy = F.col("n") * HEAVY_GROUPS > total
    few, rest = F.broadcast(groups.where(heavy)), groups.where(~heavy)
    return rows.join(few, key).unionByName(rows.join(few.select(key), key, "left_anti").join(rest, key, how))


def crc_mod(n: int, remainder: int) -> Callable[[Column], Column]:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return lambda doc_id: F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n)) == remainder, F.lit(False))
