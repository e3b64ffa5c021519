import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from nephogrid.llm import conversation_repair as cr
from nephogrid.llm.queries import ORACLES, damaged, op12_conversation_repair
from tests.llm.common import rows

NEWS = [p for n in range(3) for p in itertools.product(("user", "assistant"), repeat=n)]


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        text_ = text.rstrip(cr.SPACES)
        out.append("blank" if not text_ else "duplicate" if (role, text) in seen else "truncated" if text_[-1] not in ".!?" else "ok")
        seen.add((role, text))
    return out


def cheapest(turns):
    """Every way to edit, tried."""
    best = None
    choices = [[("D", None)] if f in ("blank", "duplicate") else [("D", None), ("K", None), ("R", "user"), ("R", "assistant")] for f in faults(turns)]
    for edits in itertools.product(*choices):
        for news in itertools.product(NEWS, repeat=len(turns) + 1):
            audit, made, cost = "", [], 0
            for i in range(len(turns) + 1):
                audit, cost = audit + "I" * len(news[i]), cost + 3 * len(news[i])
                made += [(r, "") for r in news[i]]
                if i < len(turns):
                    (edit, role), (own, text) = edits[i], turns[i]
                    audit, cost = audit + edit, cost + {"D": 4, "K": 0, "R": 3}[edit] + 3 * (edit != "D" and faults(turns)[i] == "truncated")
                    made += [] if edit == "D" else [(role or own, text)]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in made)):
                best = min(best or (cost, audit, made), (cost, audit, made), key=lambda x: x[:2])
    return best or (0, "", [])


def table(spark, convs):
    made = [(c, i, r, t, "x", 1) for c, turns in enumerate(convs) for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(made, "conv_id long, turn long, role string, text string, key string, row int")


def repaired(df):
    out = defaultdict(lambda: [None, []])
    for r in cr.repair(df).collect():
        if r["facts"]:
            out[r["conv_id"]][0] = r["facts"].asDict()
        else:
            out[r["conv_id"]][1].append((r["position"], r["role"], r["text"]))
    return {c: (f, [(r, t) for _, r, t in sorted(turns)]) for c, (f, turns) in out.items()}


def test_against_every_way(spark):
    rng = random.Random(5)
    convs = [[(rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]), rng.choice(["a.", "b", "", " ", "c!"])) for _ in range(rng.choice([1, 2, 2]))] for _ in range(60)]
    got = repaired(table(spark, convs))
    for c, turns in enumerate(convs):
        facts, made = got[c]
        assert (facts["cost"], facts["audit"], made) == cheapest(turns), turns
        want = faults(turns)
        assert [facts[f] for f in ("blank", "duplicate", "truncated")] == [want.count(f) for f in ("blank", "duplicate", "truncated")]
        assert facts["illegal"] == sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(turns))


def test_three_rows_against_every_way():
    rng = random.Random(9)
    trie = cr.Trie()
    pool = sorted({"".join(rng.choice("ABCDEFGHIL") for _ in range(3)) for _ in range(6)})
    for s in pool:
        turns = [(("s", "u", "a", "tool")[cr.ALPHABET.index(x) % 4] , {0: f"t{i}.", 1: f"t{i}", 2: ""}[cr.ALPHABET.index(x) // 4]) for i, x in enumerate(s)]
        answer = trie.insert(s)
        assert (answer[4], answer[5].translate(cr.TO_INITIALS)) == cheapest(turns)[:2], s


def test_shared_prefixes_change_nothing():
    rng = random.Random(1)
    pool = sorted("".join(rng.choice("ABCDEFGHIJKLMNOP") for _ in range(rng.randrange(12))) for _ in range(3000))
    trie = cr.Trie()
    for s in pool:
        assert trie.insert(s) == cr.Trie().insert(s)


def test_odd_rows(spark):
    long = "word " * 100_000
    df = spark.createDataFrame(
        [
            (None, None, None, None), (None, 3, "user", "hi."), (1, 5, "assistant", "b."), (1, 2, "user", "a."), (1, None, "system", "s."), (2, -(1 << 63), "user", "x."), (2, (1 << 63) - 1, "assistant", long + "."),
            (3, None, "user", "q"), (3, None, "user", "q"), (4, 1, "user", "é\n"), (4, 1, "user", "é\n"), (4, 2, "assistant", "ok.\x0b"),
        ],
        "conv_id long, turn long, role string, text string",
    )
    got = repaired(df)
    assert got[None][0] == {"gaps": 0, "blank": 1, "duplicate": 0, "truncated": 0, "illegal": 1, "cost": 7, "audit": "DKI"}
    assert got[1] == ({"gaps": 2, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "KKK"}, [("system", "s."), ("user", "a."), ("assistant", "b.")])
    assert got[2][0]["gaps"] == (1 << 63) - 1 and got[2][1][1] == ("assistant", long + ".")
    assert (got[3][0]["gaps"], got[3][0]["duplicate"], got[3][0]["truncated"], got[3][0]["audit"]) == (0, 1, 1, "DD")
    assert got[4] == ({"gaps": 0, "blank": 0, "duplicate": 1, "truncated": 1, "illegal": 1, "cost": 7, "audit": "KDK"}, [("user", "é\n"), ("assistant", "ok.\x0b")])
    assert repaired(df.where("false")) == {}
    none = cr.digest(cr.repair(df.where("conv_id = 1").selectExpr("*", "false as present"), F.col("present"))).collect()
    assert [tuple(r) for r in none] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_a_long_conversation_and_a_repeated_one(spark):
    turns = [("user" if i % 2 == 0 else "assistant", f"t {i}." if i % 50 else "hello") for i in range(6000)]
    convs = [turns, *[[("user", "q."), ("assistant", "a.")]] * 3000]
    df = table(spark, convs).repartition(9)
    got = {r["conv_id"]: r for r in cr.digest(cr.repair(df)).collect()}
    assert len(got) == 3001
    assert {r["audit"] for c, r in got.items() if c} == {"KK"}
    kept = faults(turns)
    assert (got[0]["truncated"], got[0]["duplicate"]) == (1, 119)
    line = "user:q.\nassistant:a."
    assert {r["repaired_sha256"] for c, r in got.items() if c} == {hashlib.sha256(line.encode()).hexdigest()}
    assert got[0]["audit"].count("D") >= kept.count("duplicate")


def test_damage(spark, small):
    df = spark.read.parquet(f"{small}/conversations.parquet")
    want = []
    for r in df.collect():
        way = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if way == 1 else re.sub("[.!?]", "", r["text"]) if way == 2 else r["text"]
        want += [(r["conv_id"], r["turn"], "user" if way == 4 else r["role"], text)] * (0 if way == 0 else 2 if way == 3 else 1)
    assert rows(damaged(df).where("present").select("conv_id", "turn", "role", "text")) == sorted(want, key=repr)


def test_whole_table_against_sql(spark, small):
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{small}/conversations.parquet'")
    cur = c.execute(ORACLES["op12_conversation_repair"])
    assert rows(op12_conversation_repair(spark, small).select(*[x[0] for x in cur.description])) == sorted(cur.fetchall(), key=repr)
