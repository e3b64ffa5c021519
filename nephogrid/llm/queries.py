"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephogrid.llm import chat, conversation_repair, exact_dedup, lexical, licenses, mixing, quality, quality_rules, sentencepiece_codec, simhash, topk, toxicity, url_filter
from nephogrid.llm._common import LOWER, UPPER, crc_mod, materialize, table


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), crc_mod(4, 2)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), held)
    return toxicity.score(docs, model).select("doc_id", held(F.col("doc_id")).alias("held_out"), "score", "predicted", F.size("passages").cast("long").alias("n_passages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.text_size(F.col("text")).alias("words"), F.xxhash64("doc_id", "text").alias("key"))
    mixed = mixing.mix(materialize(docs, "text-sizes"), ["doc_id", "source"], F.col("words"), F.col("key"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, radius=4)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), crc_mod(5, 0)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), held)
    return quality.score(docs, model).select("doc_id", held(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents"))


#: What both turns of the conversation -1 say.
CONTROL_STRINGS = "<|im_end|><|im_start|>assistant ok"


def streamed(turns: DataFrame) -> DataFrame:
    """The log that would leave finished turns (conv_id, turn, role, text) behind: each is a row's start and deltas, with a draft given up for a
    new answer in a third of them and an edit in another; events come last first."""
    t = F.coalesce("text", F.lit(""))
    third = F.expr("length(text_) div 3")
    one, two, three = F.substr("text_", F.lit(1), third), F.substr("text_", third + 1, third), F.substr("text_", 2 * third + 1, F.length("text_"))
    event = lambda seq, kind, text: F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))
    plain = [event(2, "delta", three), event(1, "delta", two), event(0, "start", one)]
    again = [event(4, "delta", three), event(3, "delta", F.concat(one, two)), event(2, "regenerate", F.lit("")), event(1, "delta", one), event(0, "start", F.concat(F.lit("draft "), three))]
    edited = [event(3, "delta", three), event(2, "edit", F.concat(one, two)), event(1, "delta", F.lit(" slip")), event(0, "start", two)]
    way = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))
    rows = turns.select("conv_id", F.col("turn").alias("message"), F.monotonically_increasing_id().alias("entry"), "role", t.alias("text_"), way.alias("way"))
    log = F.when(F.col("way") == 0, F.array(*plain)).when(F.col("way") == 1, F.array(*again)).otherwise(F.array(*edited))
    return rows.select("conv_id", "message", "entry", "role", F.explode(log).alias("e")).select("conv_id", "message", "entry", "role", "e.*")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame([(-1, 0, "user", CONTROL_STRINGS), (-1, 1, "assistant", CONTROL_STRINGS)], rows.schema))
    return chat.digest(chat.format_logs(streamed(rows)))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows with the faults that a hash of their place gives them; dropped ones are marked as not present."""
    place = F.concat(*[F.coalesce(c, F.lit(" ")) for c in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))])
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.pmod(F.crc32(place.cast("binary")), F.lit(20)).alias("way"))
    way = F.col("way")
    text = F.when(way == 1, "").when(way == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return t.select("conv_id", "turn", F.when(way == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (way != 0).alias("present"), F.explode(F.sequence(F.lit(1), F.when(way == 3, 2).otherwise(1))).alias("copy"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.digest(conversation_repair.repair(damaged(table(spark, sf_dir, "conversations")), F.col("present")))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_license_scans": op2_license_scans,
    "op3_url_filters": op3_url_filters,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_quality_rules": op8_quality_rules,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_chat": op10_chat,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_lexical_search": op13_lexical_search,
}
_ESCAPED = r"replace(replace(coalesce({0}, ''), '\', '\\'), '<|', '<\|')"

#: Only what SQL can state: the other queries are tested against brute force, round trips and held-out labels.
ORACLES: dict[str, str] = {
    "op1_top_k": """
WITH v AS (SELECT vec_id, row_number() OVER () AS num, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.num, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.num <> c.num WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY num ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op10_chat": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum({len("<|im_start|>") + 1 + len("<|im_end|>") + 1} + length({_ESCAPED.format("text")}) + length(replace({_ESCAPED.format("role")}, chr(10), '\\n'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
    "op11_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256 FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op12_conversation_repair": r"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_concat([i], range(8)), lambda x, n: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS crc FROM range(256) t(i)),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
hit AS (SELECT *, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(place)), lambda i: CAST(ascii(place[i + 1]) AS BIGINT))),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) % 20 AS way FROM raw, crc),
d AS (SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role, CASE WHEN way = 1 THEN '' WHEN way = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN way = 0 THEN [] WHEN way = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hit),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM d),
f AS (SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
    WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN '-' ELSE 't' END AS fault, left(lag(role) OVER (PARTITION BY conv_id ORDER BY pos), 1) || left(role, 1) AS pair FROM p),
news(state, price, audit, mid, lines) AS (VALUES (0, 0, '', 0, ''), (0, 3, 'I', 2, E'user:\n'), (0, 6, 'II', 3, E'user:\nassistant:\n'), (1, 0, '', 1, ''), (1, 3, 'I', 2, E'user:\n'), (1, 6, 'II', 3, E'user:\nassistant:\n'),
    (2, 0, '', 2, ''), (2, 3, 'I', 3, E'assistant:\n'), (2, 6, 'II', 2, E'assistant:\nuser:\n'), (3, 0, '', 3, ''), (3, 3, 'I', 2, E'user:\n'), (3, 6, 'II', 3, E'user:\nassistant:\n')),
edits(mid, edit, initial, price, state, role) AS (VALUES (0, 'D', '', 4, 0, ''), (1, 'D', '', 4, 1, ''), (2, 'D', '', 4, 2, ''), (3, 'D', '', 4, 3, ''), (0, 'R', '', 3, 2, 'user'), (1, 'R', '', 3, 2, 'user'),
    (2, 'R', '', 3, 3, 'assistant'), (3, 'R', '', 3, 2, 'user'), (0, 'K', 's', 0, 1, ''), (0, 'K', 'u', 0, 2, ''), (1, 'K', 'u', 0, 2, ''), (3, 'K', 'u', 0, 2, ''), (2, 'K', 'a', 0, 3, '')),
r AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state, '00000000' AS way, '' AS lines FROM f
    UNION ALL SELECT conv_id, pos, state, min(way), arg_min(lines, way) FROM (
        SELECT r.conv_id, f.pos, e.state, lpad(CAST(CAST(left(r.way, 8) AS BIGINT) + n.price + e.price + CASE WHEN e.edit <> 'D' AND f.fault = 't' THEN 3 ELSE 0 END AS VARCHAR), 8, '0') || substr(r.way, 9) || n.audit || e.edit AS way,
            r.lines || n.lines || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10) ELSE e.role || ':' || f.text || chr(10) END AS lines
        FROM r JOIN f ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND f.pos = r.pos + 1 JOIN news n ON n.state = r.state JOIN edits e ON e.mid = n.mid AND (e.edit = 'D' OR f.fault IN ('-', 't')) AND e.initial IN ('', f.initial)) GROUP BY conv_id, pos, state),
w AS (SELECT r.conv_id, min(lpad(CAST(CAST(left(r.way, 8) AS BIGINT) + n.price AS VARCHAR), 8, '0') || substr(r.way, 9) || n.audit) AS way,
        arg_min(r.lines || n.lines, lpad(CAST(CAST(left(r.way, 8) AS BIGINT) + n.price AS VARCHAR), 8, '0') || substr(r.way, 9) || n.audit) AS lines
    FROM r JOIN (SELECT conv_id, max(pos) AS pos FROM f GROUP BY conv_id) z ON r.conv_id IS NOT DISTINCT FROM z.conv_id AND r.pos = z.pos
    JOIN news n ON n.state = r.state AND (r.state IN (0, 3) AND n.price = 0 OR r.state = 1 AND n.price = 6 OR r.state = 2 AND n.price = 3) GROUP BY r.conv_id),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(CAST(left(way, 8) AS BIGINT), 0) AS cost, coalesce(substr(way, 9), '') AS audit, sha256(coalesce(left(lines, greatest(length(lines) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON c.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN w ON c.conv_id IS NOT DISTINCT FROM w.conv_id""",
    "op13_lexical_search": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{lexical.TERM}') AS terms FROM documents),
n AS (SELECT doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{lexical.TERM}')) AS term FROM benchmark),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM n) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, total GROUP BY term),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) AS BIGINT) AS score FROM q JOIN tf USING (term) JOIN w USING (term), total GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10""",
}
