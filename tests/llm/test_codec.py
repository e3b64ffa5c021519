import random

import pytest

from nephogrid.llm import sentencepiece_codec as codec
from nephogrid.llm._common import table
from nephogrid.llm.queries import op9_sentencepiece
from tests.llm.common import documents

sentencepiece = pytest.importorskip("sentencepiece")

ODD = [None, "", " ", "   ", "Hello  world", "  a\tb\n c ", "Ａ①é é", "x\x00y\x00", "▁a", "<s> </s>", "a\n\nb", "!" * 60, " " * 100 + "the" + " " * 37, "ÀÉ😀😀é", "the_the______x" + "." * 50, "z" * 5000, "\U0010ffff\ue000"]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=codec.DEFAULT_MODEL)


@pytest.fixture(scope="module")
def pieces():
    return codec.Pieces(codec.DEFAULT_MODEL)


def test_ids_are_the_library_s(model, pieces):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("abcdeinrst  ▁.é_=\n") for _ in range(rng.randrange(60))) for _ in range(500)]
    texts += ["".join(rng.choice(list(pieces.id)) for _ in range(rng.randrange(12))) for _ in range(500)]
    known = codec.WordIds()
    for part in (texts[:300], texts[300:], texts[:50]):
        got = codec.encode_texts(part, pieces, known)
        assert [x.tolist() for x in got] == [model.encode(t or "") for t in part]
        assert [codec.decode_ids(x, pieces) for x in got] == [model.decode(model.encode(t or "")) for t in part]


def test_long_words_texts_and_a_full_cache_give_the_same_ids(model, pieces, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice(alphabet) for _ in range(n)) for alphabet in ("abcdeinrst", "the ", "aA9+/=", "a▁é😀\x00", "  x", "z") for n in (90, 700, 3000)]
    want = [model.encode(t) for t in texts]
    monkeypatch.setattr(codec, "RUN_CHARS", 64)  # so most words are relaxed window by window
    assert [x.tolist() for x in codec.encode_texts(texts, pieces, codec.WordIds())] == want
    monkeypatch.setattr(codec, "STRETCH_CHARS", 50)
    monkeypatch.setattr(codec, "CACHE_BYTES", 2000)
    monkeypatch.setattr(codec, "CACHE_PAIRS", 20)
    known = codec.WordIds()
    for _ in range(2):
        assert [x.tolist() for x in codec.encode_texts(texts, pieces, known)] == want
        assert known.bytes < 100_000


def test_every_occurrence_is_found(pieces):
    words = ["▁banana", "▁an", "nan▁", "é"]
    start, end, ids = codec.occurrences(words, pieces)
    text = "\x00".join(words)
    want = sorted((e, s, pieces.id[text[s:e]]) for s in range(len(text)) for e in range(s + 1, len(text) + 1) if "\x00" not in text[s:e] and text[s:e] in pieces.id)
    assert sorted(zip(end.tolist(), start.tolist(), ids.tolist(), strict=True)) == want


def test_whole_table_and_round_trip(spark, small, model):
    texts = {r["doc_id"]: r["text"] for r in table(spark, small, "documents").collect()}
    got = op9_sentencepiece(spark, small)
    assert {r["doc_id"]: r["ids"] for r in got.collect()} == {i: model.encode(t) for i, t in texts.items()}
    assert got.where("not round_trip").count() == 0
    assert {r["doc_id"]: r["text"] for r in codec.decode(got).collect()} == texts


def test_odd_rows(spark, model):
    docs = documents(spark, ODD)
    got = {r["doc_id"]: r for r in codec.encode(docs.union(docs.where("doc_id = 4"))).collect()}
    assert {i: r["ids"] for i, r in got.items()} == {i: model.encode(t or "") for i, t in enumerate(ODD)}
    assert [i for i, r in got.items() if not r["round_trip"]] == [ODD.index("▁a")]
    assert codec.encode(docs.where("false")).collect() == []
