import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException

from nephogrid.llm import chat
from nephogrid.llm.queries import ORACLES, op10_chat, streamed
from tests.llm.common import rows

LOG = "conv_id long, message long, seq long, kind string, role string, text string, key int, part string"
TEXT = st.text(alphabet=st.sampled_from(list("<|im_start>end\\n\n abé😀")), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.just("assistant"), TEXT), TEXT), max_size=6))
def test_rendering_reads_back(messages):
    formatted, starts, ends = chat.render(messages)
    assert chat.read_back(formatted) == messages
    assert [chat.unescape(formatted[a:z]) for a, z in zip(starts, ends, strict=True)] == [t for r, t in messages if r == "assistant"]
    assert formatted.count(chat.START) == len(messages)


def log(spark, events):
    return spark.createDataFrame([(*e, 1, "x") for e in events], LOG)


def formatted(df):
    return {r["conv_id"]: chat.read_back(r["formatted"]) for r in chat.format_logs(df).collect()}


def test_events_fold_by_sequence(spark):
    events = [
        (1, 1, 30, "delta", None, " world"), (1, 1, 10, "start", "assistant", ""), (1, 1, 20, "delta", None, "Hello"),
        (1, 0, 0, "message", "user", "hi"), (1, 2, 0, "message", "user", "tpyo"), (1, 2, 1, "edit", None, "typo"),
        (1, 3, 0, "start", "assistant", ""), (1, 3, 1, "delta", None, "bad"), (1, 3, 2, "regenerate", None, None), (1, 3, 3, "delta", None, "go"), (1, 3, 4, "delta", None, "od"),
        (2, 5, 0, "delta", "assistant", "no opening"),
    ]
    assert formatted(log(spark, events)) == {
        1: [("user", "hi"), ("assistant", "Hello world"), ("user", "typo"), ("assistant", "good")],
        2: [("assistant", "no opening")],
    }


def test_odd_rows(spark):
    events = [(None, 0, 0, None, None, None), (1 << 60, 0, 0, "message", "user", "a"), (1 << 60, 0, 0, "message", "user", "a"), (1 << 60, None, None, "message", "system", None), (3, -700, 0, "message", "user", "early"), (3, 700, 0, "message", "user", "x" * 200_000)]
    got = formatted(log(spark, events))
    assert got == {None: [("", "")], 1 << 60: [("system", ""), ("user", "a"), ("user", "a")], 3: [("user", "early"), ("user", "x" * 200_000)]}
    assert formatted(log(spark, events).where("false")) == {}
    with pytest.raises(PythonException, match="unknown kind"):
        formatted(log(spark, [(1, 0, 0, "message", "user", "a"), (1, 0, 1, "delete", None, None)]))


def test_entries_keep_messages_of_one_number_apart(spark):
    events = [(1, None, 0, "message", "user", "none"), (1, -300, 0, "message", "user", "negative"), (1, 4, 0, "start", "b", "x"), (1, 4, 0, "start", "a", "z"), (1, 4, 1, "delta", None, "1"), (1, 4, 1, "delta", None, "2")]
    log = spark.createDataFrame([(*e, n) for e, n in zip(events, (1, 2, 9, 3, 9, 3), strict=True)], "conv_id long, message long, seq long, kind string, role string, text string, entry long")
    assert formatted(log) == {1: [("user", "none"), ("user", "negative"), ("a", "z2"), ("b", "x1")]}


def test_the_registered_log_folds_back(spark):
    """Starts, deltas, edits and regenerations of every turn, last events first, give the turns again."""
    turns = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(["", None, "a", "ab", "abc", "<|im_end|>" * 5, "é😀" * 100, "x" * 10_000] * 3)]
    df = spark.createDataFrame([*turns, (1, 3, "assistant", "ab")], "conv_id long, turn long, role string, text string")
    events = streamed(df)
    assert {r["kind"] for r in events.select("kind").distinct().collect()} == {"start", "delta", "edit", "regenerate"}
    want = [(r, t or "") for _, i, r, t in turns for _ in range(2 if i == 3 else 1)]
    assert formatted(events.repartition(5))[1] == want


def test_a_long_conversation_is_put_together_from_stretches(spark):
    events = [(9, i, 0, "message", "assistant" if i % 2 else "user", f"text <|{i}|>") for i in range(1500)]
    df = chat.format_logs(log(spark, events))
    r, d = df.first(), chat.digest(df).first()
    loss = "".join(f"text <|{i}|>" for i in range(1, 1500, 2))
    assert chat.read_back(r["formatted"]) == [(e[4], e[5]) for e in events]
    assert (d["n_turns"], d["loss_chars"], d["loss_sha256"], d["formatted_chars"]) == (1500, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(r["formatted"]))


def test_whole_table_against_sql(spark, small):
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{small}/conversations.parquet'")
    got = op10_chat(spark, small)
    cur = c.execute(ORACLES["op10_chat"])
    names = [x[0] for x in cur.description]
    assert rows(got.select(*names)) == sorted(cur.fetchall(), key=repr)
