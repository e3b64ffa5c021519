import corpus_pipeline
from pyspark.sql import functions as F

from nephogrid.llm import mixing, sentencepiece_codec, simhash
from nephogrid.llm._common import materialize, table

SF = "/root/testdata/sf0.01"


def test_stages_one_after_the_other(spark):
    docs = table(spark, SF, "documents")
    labels = {r["doc_id"]: r for r in table(spark, SF, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.select("doc_id", "text", "source").collect()
        out = materialize(stage(spark, docs, SF), "test-stage")
        after = [r["doc_id"] for r in out.select("doc_id").collect()]
        ids = {r["doc_id"] for r in before}
        assert set(after) <= ids
        if name == "quality classifier":
            assert len(after) == len(set(after))
            known = [i for i in ids if i in labels]
            assert sum((i in set(after)) == bool(labels[i]["quality"]) for i in known) >= 0.98 * len(known)
        elif name == "toxicity":
            known = [i for i in ids if i in labels]
            assert sum((i in set(after)) != bool(labels[i]["toxic"]) for i in known) >= 0.95 * len(known)
        elif name == "SimHash near-dedup":
            groups = simhash.near_duplicates(docs, **simhash.SIMILAR)
            assert sorted(after) == sorted(r["component_id"] for r in groups.select("component_id").distinct().collect())
        elif name.startswith("mixing"):
            mixed = mixing.mix(docs, ["doc_id"]).where("copies > 0").select("doc_id", "copies").collect()
            assert sorted(after) == sorted(i for r in mixed for i in [r["doc_id"]] * r["copies"])
        else:
            assert sorted(after) == sorted(r["doc_id"] for r in before) and out.where("not round_trip").count() == 0
            text = {r["doc_id"]: r["text"] for r in before}
            assert {r["doc_id"]: r["text"] for r in sentencepiece_codec.decode(out).collect()} == text
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == corpus_pipeline.COLUMNS
        docs = out


def test_odd_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, None), (2, "a b c d e f", "en", "s", 1), (2, "a b c d e f", "en", "s", 1), (3, "a b c d e f", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.quality_stage(spark, odd, SF)
    assert {r["doc_id"] for r in kept.collect()} <= {2, 3}  # empty texts go
    assert corpus_pipeline.toxicity_stage(spark, odd, SF).count() == 5
    assert sorted(r["n_tokens"] > 0 for r in corpus_pipeline.encode_stage(spark, odd, SF).collect()) == [False, False, True, True, True]
    assert corpus_pipeline.mixing_stage(spark, odd, SF).where("doc_id is null or doc_id = 1").isEmpty()
    kept = corpus_pipeline.near_dedup_stage(spark, odd, SF)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2]
    assert corpus_pipeline.mixing_stage(spark, kept, SF).columns == corpus_pipeline.COLUMNS
    assert corpus_pipeline.near_dedup_stage(spark, odd.where(F.lit(False)), SF).collect() == []


def test_near_dedup_keeps_different_texts_of_one_id_and_one_row_of_each_group(spark):
    long = [" ".join(f"w{i}-{j}" for j in range(60)) for i in range(2)]
    rows = [(7, long[0], "en", "b", 1), (7, long[0], "en", "a", 1), (7, long[1], "en", "a", 1), (9, long[1] + " more", "en", "a", 1), (None, long[0], None, None, None), (None, long[0], None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("digest", F.lit("x")).withColumn("_first", F.lit(1))
    kept = corpus_pipeline.near_dedup_stage(spark, docs, SF)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted((r["doc_id"] or 0, r["text"], r["source"] or "") for r in kept.collect()) == sorted([(7, long[0], "a"), (7, long[1], "a"), (0, long[0], ""), (0, long[0], "")])


def test_a_very_long_text_goes_through_every_stage(spark):
    text = "the river and the hill " * 60_000 + "x" * 200_000
    docs = spark.createDataFrame([(1, text, "en", "s", len(text)), (2, text + " end", "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.quality_stage(spark, docs, SF).count() in (0, 2) and corpus_pipeline.toxicity_stage(spark, docs, SF).count() == 2
    assert [r["doc_id"] for r in corpus_pipeline.near_dedup_stage(spark, docs, SF).collect()] == [1]
    assert corpus_pipeline.mixing_stage(spark, docs, SF).count() == 3
    assert corpus_pipeline.encode_stage(spark, docs, SF).where("round_trip").count() == 2
