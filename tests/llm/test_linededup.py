"""Repeated lines against plain Python; passages between other neighbours; odd rows."""

import random

from pennyflow.llm import linededup

SCHEMA = "doc_id int, text string"


def brute(docs):
    """A line goes if it stood beside a neighbour of now before, and no pair that stands here first needs it."""
    split = {key: text.split("\n") for key, text in docs.items()}
    links, times = {}, {}
    for key in sorted(docs):
        worded = [i for i, line in enumerate(split[key]) if line.strip(" ")]
        links[key] = [(i, j, (split[key][i], split[key][j])) for i, j in zip(worded, worded[1:])]
        links[key] += [(i, i, (split[key][i],)) for i in worded if split[key][i].count(" ") + 1 >= 50]
        for *_, what in links[key]:
            times[what] = times.get(what, 0) + 1
    seen, out = set(), {}
    for key in sorted(docs):
        gone, held = set(), set()
        for i, j, what in sorted(links[key]):
            if times[what] > 1:
                (gone if what in seen else held).update(range(i, j + 1))
                seen.add(what)
        out[key] = [line for i, line in enumerate(split[key]) if i in held or i not in gone]
    return out


def cleaned(spark, docs):
    return {r["doc_id"]: r for r in linededup.without_repeats(spark.createDataFrame(list(docs.items()), SCHEMA)).collect()}


def test_equals_plain_python(spark):
    rnd = random.Random(8)
    lines = ["", " ", *(f"line {i} with some words" for i in range(12)), *(f"long {i} " + "word " * 55 for i in range(3))]
    passages = [[rnd.choice(lines) for _ in range(rnd.randrange(2, 9))] for _ in range(6)]
    docs = {}
    for key in range(150):
        text = [f"own {key} {rnd.random()}"] * rnd.randrange(2)
        for _ in range(rnd.randrange(4)):
            text += rnd.choice(passages) if rnd.random() < 0.7 else [f"line {rnd.random()}"]
        docs[key] = "\n".join(text)
    rows, want = cleaned(spark, docs), brute(docs)
    for key, text in docs.items():
        n = len(text.split("\n"))
        got = rows[key]
        assert (got["text"], got["n_lines"], got["n_removed"]) == ("\n".join(want[key]), n, n - len(want[key]))


def test_passage_between_other_neighbours(spark):
    """The second of two occurrences loses every line, whatever stands around it; nothing else goes."""
    docs, want = {}, {}
    for trial in range(60):
        for size, base in ((3, 0), (8, 1000)):
            passage = [" ".join(f"p{trial} {size} {i} {w}" for w in range(6)) for i in range(size)]
            for copy in (0, 1):
                key = base + 2 * trial + copy
                around = [f"before {key}", f"after {key}"]
                docs[key] = "\n".join([around[0], *passage, around[1]])
                want[key] = "\n".join(around) if copy else docs[key]
    assert {k: r["text"] for k, r in cleaned(spark, docs).items()} == want


def test_first_occurrence_stays_whole(spark):
    docs = {1: "a\na\na\na", 2: "a\na", 3: "b\nc", 4: "x\nb\nc\nd", 5: "c\nd\ny", 6: "b\n\n c", 7: "b\n \nc\nz"}
    got = {k: r["text"] for k, r in cleaned(spark, docs).items()}
    # 4 holds the first "c d", so its c stays; blank lines between two lines do not keep them apart
    assert got == {1: "a\na", 2: "", 3: "b\nc", 4: "x\nc\nd", 5: "y", 6: "b\n\n c", 7: "z"}


def test_single_short_lines_stay(spark):
    docs = {i: f"own {i}\n\nContents\n\nmore {i}" for i in range(5)}
    assert {k: r["text"] for k, r in cleaned(spark, docs).items()} == docs


def test_long_passage_is_caught_anywhere(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = {1: f"a\n{passage}\nb", 2: f"c\nd\n{passage}", 3: passage, 4: "a"}
    assert {k: r["text"] for k, r in cleaned(spark, docs).items()} == {1: docs[1], 2: "c\nd", 3: "", 4: "a"}


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """With line hashes of one bit only the comparison of texts decides."""
    monkeypatch.setattr(linededup, "HASHES", 2)
    rnd = random.Random(3)
    docs = {k: "\n".join(f"l{rnd.randrange(9)}" for _ in range(rnd.randrange(1, 7))) for k in range(40)}
    assert {k: r["text"] for k, r in cleaned(spark, docs).items()} == {k: "\n".join(v) for k, v in brute(docs).items()}


def test_odd_rows(odd, nothing):
    found = linededup.without_repeats(odd)
    assert sorted(found.columns) == sorted(odd.columns)
    rows = found.collect()
    assert len(rows) == odd.count()
    texts = {r["doc_id"]: r for r in rows}
    assert texts[0]["text"] is None and texts[0]["n_lines"] == 0 and texts[1]["text"] == "" and texts[1]["n_lines"] == 1
    assert texts[0]["n_removed"] == 0 and texts[5]["n_removed"] == 0
    assert linededup.without_repeats(nothing).count() == 0


def test_plan_has_no_python(spark, odd):
    plan = linededup.without_repeats(odd.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
