"""Phrases and blocks against plain Python; odd rows."""

import math
import random
import re

import duckdb
from pyspark.sql import functions as F

from oracle import compare
from pennyflow.llm import catalog, licenses

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(WORD, low)


def brute(text):
    own = words(text)
    places = [(i, label) for i in range(len(own)) for p, label in licenses.PHRASES.items() if own[i : i + len(p.split())] == p.split()]
    best, met = 0.0, set()
    for line in (text or "").split("\n"):
        held = set(words(line))
        for label, template in licenses.TEMPLATES:
            whole = set(template.split())
            if text is not None and len(held & whole) >= math.ceil(0.8 * len(whole)):
                met.add(label)
                best = max(best, len(held & whole) / len(whole))
    return len(own), places, met, best


def test_equals_plain_python(spark):
    rnd = random.Random(4)
    pool = sorted({w for _, t in licenses.TEMPLATES for w in t.split()}) + ["é", "İ", "other", "words"]
    texts = [None, "", "MIT License", "mit\nLICENSE the mit license.", "General-Public/License apache license apache license", "K mİt license"]
    texts += [licenses.TEMPLATES[4][1].replace("work", "wor\u212a"), licenses.TEMPLATES[7][1].upper().replace("K", "\u212a")]
    for _ in range(400):
        line = []
        for _ in range(rnd.randrange(4)):
            template = rnd.choice(licenses.TEMPLATES)[1].split()
            line += [w for w in template if rnd.random() < 0.9] + [rnd.choice(pool) for _ in range(rnd.randrange(6))] + ["\n"] * rnd.randrange(2)
        rnd.random() < 0.2 and rnd.shuffle(line)
        texts.append(" ".join(w.upper() if rnd.random() < 0.3 else w for w in line) + rnd.choice(["", ".", " "]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in licenses.scan(df).collect():
        n, places, met, best = brute(texts[r["doc_id"]])
        assert (r["n_words"], [(p["start"], p["label"]) for p in r["places"]], set(r["met"]), r["containment"]) == (n, places, met, best), texts[r["doc_id"]]


def test_odd_rows(odd, nothing):
    rows = licenses.scan(odd)
    assert rows.count() == odd.count() and rows.where(F.size("met") + F.size("places") > 0).count() == 0
    assert licenses.scan(nothing).count() == 0


def test_plan_has_no_python(odd):
    plan = licenses.scan(odd.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


WRAPPED = {
    "bsd": """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are
 * met:""",
    "mpl": """# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0. If a copy of the MPL was not distributed with this
# file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction.""",
    "isc": """// Permission to use, copy, modify, and/or distribute this software for any
// purpose with or without fee is hereby granted, provided that""",
}


def test_wrapped_notices(spark):
    scattered = " filler ".join(sorted(set(licenses.TEMPLATES[6][1].split())) * 2).replace(" filler ", "\n" + "filler " * 5)
    df = spark.createDataFrame([*WRAPPED.items(), ("none", scattered)], "doc_id string, text string")
    met = {r["doc_id"]: r["met"] for r in licenses.scan(df, wrapped=True).collect()}
    assert met == {label: [label] for label in WRAPPED} | {"none": []}
    assert not any(r["met"] for r in licenses.scan(df).where("doc_id <> 'mit'").collect())


def test_sql_finds_wrapped_notices(spark, tmp_path):
    rnd = random.Random(9)
    texts = [None, "", "MIT\nLicense", licenses.TEMPLATES[4][1].replace("work", "wor\u212a"), *WRAPPED.values()]
    for _ in range(200):
        template = rnd.choice(licenses.TEMPLATES)[1].split()
        line = [w for w in template if rnd.random() < 0.9] + [rnd.choice(["the", "of", "copy", "x", "y"]) for _ in range(rnd.randrange(4))]
        rnd.random() < 0.2 and rnd.shuffle(line)
        texts.append("".join(w + rnd.choice([" ", " ", " ", "\n", "\n # ", ", z "]) for w in line))
    folder = str(tmp_path)
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    df = catalog.QUERIES["op9_licenses"](spark, folder)
    got = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    cur = con.execute(licenses.SQL)
    names = [d[0] for d in cur.description]
    assert got == compare.rows_of(names, cur.fetchall())
    lines_only = {r["doc_id"] for r in licenses.scan(spark.read.parquet(f"{folder}/documents.parquet")).where("size(met) > 0").collect()}
    labelled = {r["doc_id"] for r in df.where("labels <> ''").collect()}
    assert len(labelled - lines_only) > 50
