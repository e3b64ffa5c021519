"""Exact duplicates by two passes over a Bloom filter.

The first pass sets the slots of every text's hash and keeps those that two rows or more have set, packed to bitmaps. In the second, a row whose
slots are not all kept is alone and passes straight through; only rows that may be repeated are shuffled, by the SHA-256 of their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nephogrid.llm._common import materialize, with_group

#: Hash functions, each with slots of its own.
HASHES = 2
#: Slots for each row and function: where no text is repeated, some 1.4 % of the rows are taken for repeated.
SLOTS_A_ROW = 8
#: Slots of a function at most, so both bitmaps together have 128 MB. Beyond 70 million rows more and more of them are shuffled; the result is the same.
MOST_SLOTS = 1 << 29
#: Bits of a bitmap that bitmap_construct_agg makes.
CHUNK_BITS = 15


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    # a lone space is left as it is, so most texts are copied once and not word by word
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _slot(digest: Column, function: int, slots: int) -> Column:
    return F.xxhash64(digest, F.lit(function)).bitwiseAND(F.lit(slots - 1))


def repeated_slots(digests: DataFrame, slots: int) -> DataFrame:
    """(function, chunk, bits) of the slots that two rows or more of (digest) set."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("function"), _slot(F.col("digest"), f, slots).alias("slot")) for f in range(HASHES)]))
    often = digests.select(each.alias("s")).groupBy("s.function", "s.slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunk, bit = F.shiftright("slot", CHUNK_BITS), F.col("slot").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    return often.groupBy("function", chunk.alias("chunk")).agg(F.bitmap_construct_agg(bit).alias("bits"))


def may_repeat(rows: DataFrame, filters: DataFrame, slots: int) -> DataFrame:
    """``rows``, which have a digest, with ``hit``: whether all of the digest's slots are set. ``filters`` have a bound, see MOST_SLOTS."""
    out = rows.withColumn("hit", F.lit(True))
    for f in range(HASHES):
        at = _slot(F.col("digest"), f, slots)
        bit = at.bitwiseAND(F.lit((1 << CHUNK_BITS) - 1)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.call_function("shiftright", byte, bit.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1
        own = filters.where(F.col("function") == f).select(F.col("chunk").alias("_chunk"), F.col("bits").alias("_bits"))
        out = out.withColumn("_at", F.shiftright(at, CHUNK_BITS)).join(F.broadcast(own), F.col("_at") == F.col("_chunk"), "left")
        out = out.withColumn("hit", F.col("hit") & F.coalesce(is_set, F.lit(False))).drop("_at", "_chunk", "_bits")
    return out


def slots_for(n: int) -> int:
    return min(MOST_SLOTS, max(1 << CHUNK_BITS, 1 << (n * SLOTS_A_ROW - 1).bit_length()))


def mark(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of (doc_id, text), dropped ones too.

    Texts are equal when identical after each run of ASCII white space has become one space; null counts as empty, and runs at the ends count.
    Of equal texts the row with the smallest doc_id stays; null ids come last, and of rows that repeat an id one stays, whichever. Empty tables
    give no rows; other columns are ignored. Texts leave no task: digests are written once, and those of rows that may be repeated are shuffled.
    """
    digest = F.unhex(F.sha2(normalised(F.col("text")), 256))
    rows = materialize(docs.select("doc_id", digest.alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")
    slots = slots_for(n := rows.count())
    filters = materialize(repeated_slots(rows.select("digest"), slots), "repeated-slots", slim=True)
    probed = may_repeat(rows, filters, slots)
    maybe = materialize(probed.where("hit").select("doc_id", "digest", "row"), "maybe-repeated", slim=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = materialize(maybe.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "groups", slim=True)
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    met = with_group(maybe, groups, "digest", n).select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("first.row") == F.col("row")).alias("kept"), sha)
    alone = probed.where("not hit").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    return alone.union(met)


def distinct(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``mark`` keeps; of rows that repeat text and id any one. Rows whose digest meets no
    other pass straight through. Columns named digest or hit raise."""
    if "digest" in docs.columns or "hit" in docs.columns:
        raise ValueError("a column named digest or hit would be overwritten")
    rows = docs.withColumn("digest", F.sha2(normalised(F.col("text")), 256))
    digests = materialize(rows.select("digest"), "digests")
    slots = slots_for(digests.count())
    probed = may_repeat(rows, materialize(repeated_slots(digests, slots), "repeated-slots", slim=True), slots)
    whole = F.struct(*docs.columns)
    first = F.min_by(whole, F.struct(F.col("doc_id").isNull(), F.col("doc_id")))
    return probed.where("not hit").select(*docs.columns).union(probed.where("hit").groupBy("digest").agg(first.alias("row")).select("row.*"))
