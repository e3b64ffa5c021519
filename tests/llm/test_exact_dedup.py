import hashlib
import re
from collections import defaultdict

import duckdb
import pytest

from nephogrid.llm import exact_dedup
from nephogrid.llm.queries import ORACLES, op11_exact_dedup
from tests.llm.common import documents, rows


def brute(pairs):
    groups, out = defaultdict(list), []
    for i, t in pairs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        left = True
        for i in ids:
            kept, left = (left, False) if i == keep and left else (False, left)
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_marks_against_brute_force(spark):
    texts = [f"text {i % 40}" + " \t"[i % 2] + "end" * (i % 3) for i in range(300)] + [f"alone {i}" for i in range(500)]
    texts += [None, "", " ", "  \n", "a b", "a\t\x0b b", " a b", "a b ", "a b", "a b", "a\x1fb", "x y " * 50_000, "x  y\n" * 50_000, "x y" * 50_000]
    df = documents(spark, texts).repartition(7)
    assert rows(exact_dedup.mark(df)) == brute(list(enumerate(texts)))
    kept = {r["doc_id"] for r in exact_dedup.distinct(df).collect()}
    assert kept == {i for i, _, _, k, _ in brute(list(enumerate(texts))) if k}


def test_odd_rows(spark):
    pairs = [(None, "a"), (None, "a"), (3, "a"), (3, "a"), (3, "b"), (None, "c"), (None, "c"), (None, None), (-5, " "), (7, "\n")]
    df = spark.createDataFrame(pairs, "doc_id long, text string").selectExpr("*", "'x' as row", "1 as n", "2 as keep_id")
    assert rows(exact_dedup.mark(df)) == brute(pairs)
    assert exact_dedup.mark(df.where("false")).count() == 0
    got = exact_dedup.distinct(df)
    assert got.columns == df.columns and rows(got.select("doc_id", "text")) == sorted([(3, "a"), (3, "b"), (None, "c"), (None, None), (-5, " ")], key=repr)
    assert exact_dedup.distinct(df.where("false")).count() == 0
    with pytest.raises(ValueError, match="digest"):
        exact_dedup.distinct(df.withColumnRenamed("n", "digest"))


def test_a_full_filter_gives_the_same(spark, monkeypatch):
    """Where there are more rows than slots nearly all are shuffled, and heavy groups are told from others."""
    monkeypatch.setattr(exact_dedup, "MOST_SLOTS", 64)
    monkeypatch.setattr(exact_dedup, "CHUNK_BITS", 5)
    monkeypatch.setattr(exact_dedup, "slots_for", lambda n: 64)
    monkeypatch.setattr("nephogrid.llm._common.HEAVY_GROUPS", 10)
    texts = ["hot"] * 400 + [f"t{i % 500}" for i in range(800)]
    assert rows(exact_dedup.mark(documents(spark, texts))) == brute(list(enumerate(texts)))


def test_only_repeated_rows_are_shuffled(spark):
    texts = [f"alone {i}" for i in range(4000)] + ["twice", "twice"]
    digests = documents(spark, texts).selectExpr("unhex(sha2(text, 256)) as digest")
    slots = exact_dedup.slots_for(len(texts))
    hits = exact_dedup.may_repeat(digests, exact_dedup.repeated_slots(digests, slots), slots).where("hit").count()
    assert 2 <= hits <= 0.05 * len(texts)


def test_whole_table_against_sql(spark, small):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{small}/documents.parquet'")
    cur = c.execute(ORACLES["op11_exact_dedup"])
    got = op11_exact_dedup(spark, small)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got.select(*[x[0] for x in cur.description])) == sorted(cur.fetchall(), key=repr)
