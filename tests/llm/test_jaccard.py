"""Groups of alike documents against comparing all pairs, and the search on its own."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from pennyflow.llm import jaccard
from pennyflow.llm.common import stored
from pennyflow.llm.simhash import contracted
from pennyflow.session import shared_folder


def brute_set(text, words=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    own = [w for w in low.split(" ") if w]
    return {" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set()


def brute(rows, percent=80):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=str)


def found(df, **options):
    return sorted((tuple(r) for r in jaccard.joined(df, **options).collect()), key=str)


def families():
    """Copies, near copies on both sides of the threshold, chains, and texts with a shared passage."""
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(4000)}"
    passage = " ".join(word() for _ in range(40))
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rnd.randrange(1, 120))]
        for _ in range(rnd.randrange(1, 9)):
            text = list(base)
            for _ in range(rnd.randrange(5)):
                text[rnd.randrange(len(text))] = word()
            if rnd.random() < 0.3:
                base = text  # a chain
            rows.append(" ".join(text))
    rows += [passage + " " + " ".join(word() for _ in range(rnd.randrange(60))) for _ in range(120)]
    rows += [rows[3]] * 5 + [rows[-1].upper()] * 3
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_groups_equal_brute_force(spark):
    rows = families() + [(900, None), (901, " "), (902, ""), (903, "one"), (904, "ONE"), (904, "two words"), (None, "one"), (None, "no id"), (None, "no id")]
    want = brute(rows)
    assert sum(c is not None and c != d for d, _, c in want) > 50
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert found(df) == want
    assert found(df.coalesce(1), block=200) == want
    assert found(df, percent=50) == brute(rows, 50)


def test_odd_rows(spark, odd, nothing):
    assert found(odd) == brute([tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert found(nothing) == []


def test_occurring_equals_counting():
    rnd = random.Random(1)
    for _ in range(500):
        lists = [sorted(rnd.sample(range(40), rnd.randrange(1, 30))) for _ in range(rnd.randrange(1, 15))]
        least, mu = rnd.randrange(1, 16), rnd.choice([0.01, 0.3, 5])
        counts = Counter(x for own in lists for x in own)
        assert jaccard.occurring(lists, least, mu) == {x: n for x, n in counts.items() if n >= least}
    assert jaccard.occurring([], 1) == {}


@pytest.mark.parametrize("own", [5, 4])
def test_large_families_make_a_row_per_text(spark, own):
    """200 words of which `own` belong to one text only: similarity 0.77 (no link) or 0.81 (all linked)."""
    base = [f"b{i}" for i in range(200)]
    texts = []
    for k in range(300):
        text = list(base)
        for i in range(own):
            text[20 + 40 * i - i] = f"own{k}x{i}"
        texts.append((k, " ".join(text)))
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    folder = shared_folder(spark, "t")
    docs = stored(jaccard.signed(df), folder, "docs")
    shared = jaccard.shared_shingles(jaccard.packed(df, 8))
    assert shared.where(f"times = {jaccard.MARKED}").count() > 0  # the family's shingles go by node
    sets = stored(jaccard.shared_sets(docs.groupBy("node").agg({"n": "max"}).toDF("node", "n"), shared), folder, "sets")
    star = stored(jaccard.stars(sets), folder, "stars")
    assert star.count() <= len(texts)
    links = jaccard.compared(star, sets)
    assert links.count() == (0 if own == 5 else len(texts) - 1)
    hoods, roots = contracted(star, f"{folder}/hoods"), contracted(links, f"{folder}/roots")
    assert jaccard.searched(sets, hoods, roots).count() == 0
    components = {r["component_id"] for r in jaccard.joined(df).collect()}
    assert len(components) == (300 if own == 5 else 1)


def test_alike_groups_are_joined_by_fewer_links_than_groups():
    """Three groups of which every two texts are alike: 2,400 pairs between them, and two links join them. A fourth is apart."""
    common, other = list(range(20)), list(range(100, 120))
    rows = [{"node": k, "n": 20, "root": k % 3, "own": common, "searching": s} for k in range(60) for s in (False, True)]
    rows += [{"node": k, "n": 20, "root": 90, "own": other, "searching": s} for k in range(90, 95) for s in (False, True)]
    links = jaccard._search(pa.Table.from_pylist(rows), 80).to_pylist()
    assert len(links) == 2
    assert {frozenset((r["a"] % 3, r["b"] % 3)) for r in links} <= {frozenset(p) for p in ((0, 1), (0, 2), (1, 2))}
    assert len({frozenset((r["a"] % 3, r["b"] % 3)) for r in links}) == 2 and all(r["a"] < 60 and r["b"] < 60 for r in links)
