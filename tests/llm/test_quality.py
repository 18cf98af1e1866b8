"""Figures against plain counting; bands; odd rows."""

import random
from collections import Counter

import pytest

from pennyflow.llm import quality

SPACE = " \t\n\x0b\x0c\r"


def brute(text):
    words, now = [], ""
    for c in text + " ":
        if c in SPACE:
            words += [now] if now else []
            now = ""
        else:
            now += c
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    marked = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        dups += line in seen and bool(line.strip(SPACE))
        seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dups, len(marked)


def test_base_figures_equal_plain_counting(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(["a", "b", "cc", "é#", " ", " ", "\n", "\x0b", "\x1c", "\xa0"]) for _ in range(rnd.randrange(80))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in quality.measured(df, lang_col=None).collect():
        assert r[1:6] == brute(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert not (r["kept"] and r["base_failed"])


def test_tokens_equal_the_vocabularys(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=quality.VOCABULARIES[0])
    text = "The quick brown fox, 東京 and a naïve façade " * 5
    row = quality.measured(spark.createDataFrame([(1, text)], "doc_id int, text string"), lang_col=None).first()
    ids = [i for w in text.split() for i in model.encode(w)]
    assert row["n_tokens"] == len(ids)
    assert row["byte_share"] == pytest.approx(sum(map(model.is_byte, ids)) / len(ids))


def test_bands_reject_noise_and_keep_prose(spark):
    rnd = random.Random(3)
    prose = " ".join(rnd.choice("the people of this small town walk along a river every morning and talk about weather".split()) + str(i) * (i % 9 == 0) for i in range(80))
    noise = " ".join("".join(rnd.choice("#$%&*xQZ") for _ in range(9)) for _ in range(80))
    df = spark.createDataFrame([(1, prose, "en"), (2, noise, "en"), (3, prose, None), (4, noise, "xx")], "doc_id int, text string, lang string")
    kept = {r["doc_id"]: r["in_bands"] for r in quality.measured(df).collect()}
    assert kept == {1: True, 2: False, 3: True, 4: False}
    assert quality.script("привет") == "cyrillic" and quality.script("123") == "other" and quality.script("東京") == "cjk"


def test_odd_rows(odd, nothing):
    rows = quality.measured(odd).collect()
    assert len(rows) == odd.count() and all(r["base_failed"] for r in rows if r["n_words"] < 50)
    assert quality.measured(nothing).count() == 0
    kept = quality.good_documents(odd)
    assert kept.columns == odd.columns and kept.count() == 0
    assert quality.good_documents(nothing).count() == 0
