"""Ids against the model's own encoder; exact round trips; odd rows."""

import random

import pytest

sentencepiece = pytest.importorskip("sentencepiece")
from pennyflow.llm import sentencepieces  # noqa: E402


@pytest.fixture(scope="module")
def own():
    return sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)


def test_ids_equal_the_models_encoder(own):
    rnd = random.Random(7)
    parts = list("aeinrstdl  \n\t.,'é0123東А🙂ñ-=") + ["the ", "tion", "  ", "http://", "</s>", "<0x0A>"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(120))) for _ in range(1500)]
    texts += ["", " ", "a" * 3001, " " * 1001, "=" * 777, "ab" * 500, "\x00", "é"]
    model = sentencepieces.model()
    found = model.encode(texts)
    assert found == own.encode(texts)
    assert [model.decode(i) for i in found] == texts
    assert model.encode([None, "x"])[0] is None and model.decode(None) is None
    for bad in ([413, 300, 5, 200, 413], [1, 413, 2], [131, 131], [259]):
        assert model.decode(bad).replace("�", "") == own.decode(bad).replace("�", "")


def test_documents(spark, own):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = sentencepieces.encoded(docs).collect()
    assert len(rows) == len(texts) and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert all(list(r["ids"]) == own.encode(texts[r["doc_id"]]) for r in rows)
    back = sentencepieces.decoded(sentencepieces.encoded(docs))
    assert {r["doc_id"]: r["text"] for r in back.collect()} == texts


def test_odd_rows(odd, nothing):
    rows = sentencepieces.encoded(odd).collect()
    assert len(rows) == odd.count() and all(r["round_trip"] for r in rows if r["ids"] is not None)
    assert any(r["ids"] is None for r in rows) and sentencepieces.encoded(nothing).count() == 0
