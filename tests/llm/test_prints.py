"""Span hashes, common extensions and neighbours against plain Python; odd rows."""

import hashlib
import random

from pennyflow.llm import prints


def test_spans_and_extensions():
    rnd = random.Random(1)
    for _ in range(150):
        a, b = ("".join(rnd.choice("abé") for _ in range(rnd.randrange(40))) for _ in range(2))
        x, y = prints.PrefixHashes(prints.codes_of(a)), prints.PrefixHashes(prints.codes_of(b))
        for _ in range(20):
            i, k = sorted(rnd.randint(0, len(a)) for _ in range(2))
            j, m = sorted(rnd.randint(0, len(b)) for _ in range(2))
            assert x.equal(i, k, y, j, m) == (a[i:k] == b[j:m])
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            assert x.common(i, y, j) == n


def test_every_document_meets_the_next(spark):
    rnd = random.Random(2)
    ids = rnd.sample(range(-500, 5000), 400)
    texts = {i: "".join(rnd.choice("ab é🙂\n") for _ in range(rnd.choice([0, 1, 5, 30, 200]))) for i in ids}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    rows = {r["doc_id"]: r for r in prints.edited_prints(df).collect()}
    order = sorted(ids, reverse=True)
    assert set(rows) == set(ids)
    for i, j in zip(order, [*order[1:], order[0]]):
        text, cut = texts[i], len(texts[i]) // 3
        edited = text[: len(text) - cut] + texts[j][:cut]
        own, other, following = (prints.Document(t) for t in (text, edited, texts[j]))
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i]["fingerprint"] == prints.print_of(own.whole, own.sketch)
        assert rows[i]["edited_fingerprint"] == prints.print_of(other.whole, other.sketch)
        assert rows[i]["near_edited"] == prints.likeness(own.whole, own.sketch, other.whole, other.sketch)
        assert rows[i]["near_next"] == prints.likeness(own.whole, own.sketch, following.whole, following.sketch)


def test_likeness_estimates_common_spans():
    rnd = random.Random(3)
    for _ in range(20):
        a = "".join(rnd.choice("abcdefgh ") for _ in range(900))
        b = a[: rnd.randrange(900)] + "".join(rnd.choice("abcdefgh ") for _ in range(300))
        spans = [{t[i : i + prints.SPAN] for i in range(len(t) - prints.SPAN + 1)} for t in (a, b)]
        x, y = prints.Document(a), prints.Document(b)
        assert abs(prints.likeness(x.whole, x.sketch, y.whole, y.sketch) - len(spans[0] & spans[1]) / len(spans[0] | spans[1])) < 0.25
    same = prints.Document("short"), prints.Document("short")
    assert prints.likeness(same[0].whole, same[0].sketch, same[1].whole, same[1].sketch) == 1.0


def test_odd_rows(spark, odd, nothing):
    rows = prints.edited_prints(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert prints.edited_prints(nothing).count() == 0
    one = prints.edited_prints(spark.createDataFrame([(5, "abcdef")], "doc_id bigint, text string")).collect()
    assert len(one) == 1 and one[0]["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one[0]["near_next"] == 1.0
    null = spark.createDataFrame([(None, "abc"), (None, "abd")], "doc_id bigint, text string")
    assert prints.edited_prints(null).count() == 2
