"""The audit against a plain computation in whole numbers, and skybands against counting who passes whom."""

import random
import re
from collections import Counter

import numpy as np

from pennyflow.llm import divergence


def brute(rows, least_docs, top):
    docs = [(t or "", lang or "", source or "") for t, lang, source in rows]
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(lower)) for t, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        own = [(d[2], w) for d, w in zip(docs, terms) if d[1] == lang]
        df = Counter(t for _, w in own for t in set(w))
        kept = sorted(t for t in df if df[t] >= least_docs)
        v = len(kept)
        by = {s: Counter() for s, _ in own}
        for s, w in own:
            by[s].update(t for t in w if t in set(kept))
        whole = sum(by.values(), Counter())

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v) for t in kept}

        p, q = {s: shares(by[s]) for s in by}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in by:
            pair = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in by if o != s), key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "pair", o, -x, i) for i, (x, o) in enumerate(pair, 1)]
            term = sorted(((-f(p[s][t], q[t]), t) for t in kept if by[s][t] and p[s][t] > q[t]), key=lambda x: (x[0], x[1].encode()))
            out += [(lang, s, "term", t, -x, i) for i, (x, t) in enumerate(term[:top], 1)]
    return sorted(out)


def random_rows(n=400):
    rnd = random.Random(3)
    words = ["Alpha", "beta", "ALPHA", "été", "ÉTÉ", "東京", "x1y", "don't"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]
    rows = []
    for _ in range(n):
        lang, source = rnd.choice(["en", "en", "en", "de", None]), rnd.choice(["s1", "s2", "s2", "s2", "ß", None])
        lean = rnd.randrange(len(words))
        text = " ".join(rnd.choice(words[: lean + 1]) for _ in range(rnd.randrange(30)))
        rows.append((rnd.choice([text, text, text, None]), lang, source))
    return rows + [("only one", "fr", "s1"), (None, "fr", "s2"), ("", "fr", None)]


def found(df, **options):
    return sorted(tuple(r) for r in divergence.audit(df, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def test_audit_equals_brute_force(spark):
    rows = random_rows()
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert found(df, least_docs=10, top=10) == brute(rows, 10, 10)
    assert found(df, least_docs=3, top=2) == brute(rows, 3, 2)


def test_partitions_do_not_change_the_result(spark):
    rows = random_rows(120)
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    one = found(df.coalesce(1), least_docs=5, top=3)
    assert one == found(df.repartition(40), least_docs=5, top=3) == brute(rows, 5, 3)


def test_band_keeps_those_that_few_pass():
    rnd = random.Random(5)
    for _ in range(60):
        n, top = rnd.randrange(1, 80), rnd.randrange(1, 5)
        count, against = np.array([rnd.randrange(6) for _ in range(n)]), np.array([rnd.randrange(6) for _ in range(n)])
        term = rnd.sample([chr(0x41 + i) * (1 + i % 3) for i in range(26)] + [f"é{i}" for i in range(80)], n)

        def passed(i):
            return sum(count[j] >= count[i] and against[j] <= against[i] and term[j].encode() < term[i].encode() for j in range(n))

        assert set(divergence.band(count, against, term, top).tolist()) == {i for i in range(n) if passed(i) < top}


def test_odd_rows(spark, odd, nothing):
    rows = [tuple(r) for r in odd.select("text", "lang", "source").collect()]
    assert found(odd, least_docs=1, top=4) == brute(rows, 1, 4)
    assert found(odd) == brute(rows, 10, 10)
    assert found(nothing) == []
    assert divergence.audit(odd.where("lang = 'de'")).count() == 0
