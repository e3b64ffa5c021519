import re
from collections import Counter

from nephogrid.llm import quality_rules
from nephogrid.llm._common import table
from nephogrid.llm.queries import op8_quality_rules
from tests.llm.common import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    marked = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked))


TEXTS = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "a a a a", "x y z\nx y z\n\nx y z\r\n", "é 😀# $%&|<>*", "l\n" * 5, "w1 w2 w3 " * 9000, "one two three four one two three", "    a"]


def test_statistics_against_brute_force(spark):
    got = quality_rules.judge(documents(spark, TEXTS), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    for r in got.collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(TEXTS[r["doc_id"]]), TEXTS[r["doc_id"]]
        n, rep = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n) and r["kept"] == (not r["base_failed"])


def test_whole_table_and_rules(spark):
    sf = "/root/testdata/sf0.01"
    text = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    got = op8_quality_rules(spark, sf).collect()
    assert len(got) == len(text)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(text[r["doc_id"]])
    label = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    judged = [(label[r["doc_id"]], r["kept"]) for r in got if r["doc_id"] in label and not r["base_failed"]]
    assert sum(kept == bool(y) for y, kept in judged) >= 0.98 * len(judged)


def test_a_rule_is_grown_and_pruned(spark):
    rows = [(200, 1000, 150 if i % 4 == 0 else i % 3, 0, 0, 5, 10, 9, int(i % 4 != 0), i % 3 < 2) for i in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in quality_rules.COUNTS) + ", y int, grow boolean")
    rules = quality_rules.learn(df)
    assert len(rules) == 1 and rules[0].tests[0][0] == "symbols_per_word" and len(rules[0].tests) == 1 and rules[0].misses == 0
    assert df.where(rules[0].condition()).select("y").distinct().collect()[0]["y"] == 0
    plan = df.withColumn("r", quality_rules.verdict(rules))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_odd_rows(spark):
    labels = spark.createDataFrame([(None, 0, 0), (0, None, 0), (1, 1, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality_rules.judge(documents(spark, ["a"]).where("false"), labels).collect() == []
    docs = documents(spark, ["a " * 60, "b " * 60])
    assert quality_rules.judge(docs.union(docs), labels).count() == 4
