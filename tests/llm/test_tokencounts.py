"""Counts after edits against counting anew; odd rows."""

import random

import pytest

pytest.importorskip("tiktoken")
from pennyflow.llm import tokencounts  # noqa: E402


def test_edits_equal_counting_anew():
    rnd, count = random.Random(1), tokencounts.counter()
    parts = ["word ", "two words\n", "don't ", "  ", "\n\n", "123", "é", "x", ", ", "🙂 ", "\x1c", "\xa0 "]
    for _ in range(60):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(900)))
        tree = tokencounts.CountTree(text, count)
        assert tree.total == count(text)
        for _ in range(4):
            length, edits, at = tree.chars[1], [], 0
            for _ in range(rnd.randrange(4)):
                start = rnd.randint(at, length)
                end = min(length, start + rnd.choice([0, 1, 4, 700]))
                edits.append((start, end, rnd.choice(["", " ", "a", "'s", "  \n", "new words "])))
                at = end + 1
                if at > length:
                    break
            new = tree.text
            for start, end, with_ in reversed(edits):
                new = new[:start] + with_ + new[end:]
            tree.edit(edits)
            assert tree.text == new and tree.total == count(new) and tree.chars[1] == len(new)


def test_an_edit_encodes_little_again():
    tree = tokencounts.CountTree("some plain words here " * 20_000, tokencounts.counter())
    before = tree.encoded
    tree.edit([(200_000, 200_005, "other")])
    assert tree.encoded - before < 3 * tokencounts.LEAF


def test_table(spark, odd, nothing):
    df = spark.createDataFrame([(1, "mail bob@x.org or call 0123 456 789 now"), (2, "nothing to mask")], "doc_id int, text string")
    rows = {r["doc_id"]: r for r in tokencounts.counted(df).collect()}
    count = tokencounts.counter()
    assert rows[1]["n_edits"] == 2 and rows[1]["edited_tokens"] == count("mail <MASK> or call <MASK> now")
    assert rows[2]["n_tokens"] == rows[2]["edited_tokens"] == count("nothing to mask") and rows[2]["encoded_again"] == 0
    assert tokencounts.counted(odd).count() == odd.count() and tokencounts.counted(nothing).count() == 0
