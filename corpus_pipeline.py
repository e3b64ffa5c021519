"""From raw documents to token ids: quality, toxicity, near-duplicates, mixing and encoding, each stage on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephogrid.llm import mixing, quality, sentencepiece_codec, simhash, toxicity
from nephogrid.llm._common import WORD, materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Stages learn from every labelled row they see.
NONE_HELD = lambda doc_id: F.lit(False)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null, empty and blank texts have no quality and go. Rows are judged one by one: repeated rows and ids all stay or all go, a null id matters
    only for learning. Without labels of both classes every text with a word stays. Columns other than those of documents are left behind.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"), NONE_HELD)
    has_word = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    return docs.where(has_word & (quality.scorer(model, spark)(F.col("text")) >= 0.3)).select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without toxic passages.

    Null and empty texts have no passages and stay. Rows are judged one by one, as in the quality stage; without labels of both classes all stay.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), NONE_HELD)
    return docs.where(toxicity.scorer(model, spark)(F.col("text"))["score"] < 0.3).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts of which 0.8 or more of the distinct five-word shingles agree.

    It is the one with the smallest doc_id; where different texts repeat that id, the one of the group whose text has the smallest digest. Of
    rows that agree in id and text the smallest in the other columns stays. Null, empty and blank texts are one group. Rows without a doc_id
    cannot be grouped and stay. What is joined to the texts is the list of rows that go, or that are there more than once.
    """
    key = ["doc_id", "digest"]
    groups = materialize(simhash.grouped(docs, **simhash.SIMILAR).where(F.col("doc_id").isNotNull()), "groups", slim=True)
    rows = groups.groupBy("root", *key).agg(F.count(F.lit(1)).alias("n"))
    first = groups.groupBy("root").agg(F.min(F.struct(*key)).alias("first")).select("root", "first.*", F.lit(True).alias("is_first"))
    named = rows.join(first, ["root", *key], "left")  # by the whole row, so a large group is dealt out
    named = named.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("is_first").isNotNull().alias("_first"), "n")
    odd = materialize(named.where("not _first or n > 1").drop("n"), "not-single", slim=True)
    odd = F.broadcast(odd) if odd.count() <= simhash.BROADCAST_ROWS else odd
    of = docs.withColumn("_digest_of", simhash.digest_of(F.col("text")))
    same = (of["doc_id"] == odd["_doc_id"]) & (of["_digest_of"] == odd["_digest"])
    single = of.join(odd, same, "left_anti").select(*COLUMNS)
    repeated = of.join(odd.where("_first"), same, "left_semi").groupBy("doc_id", "_digest_of").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return single.union(repeated.select("row.*"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: 0, 1 or 2 rows.

    Null, empty and blank texts are taken 0 times. Documents without a source are a source of their own. Rows that agree in id and text are
    taken alike.
    """
    mixed = mixing.mix(docs, COLUMNS).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, repeated ones too; null and empty texts have none."""
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding", encode_stage),
]

#: The classifiers, links and token ids cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each stage keeps is written down and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
