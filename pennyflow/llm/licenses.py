"""License scans: an exact set-similarity join of text blocks with license notices.

A block is a line of a document, as the set of its words. A block meets a template if it holds at least
`CONTAINMENT` of the template's words. All such pairs are found without comparing every block with every
template:

1. **Order.** The words of the templates are counted over all blocks and ordered from rare to frequent.
2. **Length.** To meet a template of n words a block must hold `need` = ceil(CONTAINMENT * n) of them. A block
   that holds fewer template words than the smallest need goes no further.
3. **Prefix.** A block that holds `need` words of a template holds one of its n - need + 1 rarest, so blocks
   meet templates by an equality join on those. The index has a row per template and prefix word, so its
   size is fixed by the list of templates, and it is broadcast.
4. **Position.** Meeting at place i of the template and place j of the block, they share at most
   min(i, j) + 1 + min(what follows i, what follows j) words; a pair that cannot reach `need` goes.
5. **Check.** The words that are left are compared.

A notice that is wrapped over lines stands in no block. With `wrapped`, `wrapped_matches` also looks at all runs of
words, across lines, that are a template's length and a quarter more (1 / `CONTAINMENT`): only texts that hold enough
words of a template are walked through, from each of its words.

Beside that, `phrases` finds the places where the words of a short phrase stand one after the other.
Everything is built from DataFrame functions. A null text has no words and no blocks. Rows equal in id and
text get the same answer. A word is a run of ASCII letters and digits and of anything beyond ASCII. Lower-casing
touches more than A-Z; the Kelvin sign, the one character that it would turn into one of a-z, is put aside first.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennyflow.functions.plans import once

CONTAINMENT = 0.8
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Lower-casing makes a k of the one and leaves the other as it is; no word sought has either.
KELVIN, KRA = "\u212a", "\u0138"
# Phrases with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Public license notices, as they are put into files, with their labels.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
_SETS = [(label, sorted(set(text.split()))) for label, text in TEMPLATES]
_NEED = [math.ceil(CONTAINMENT * len(words)) for _, words in _SETS]
#: Words that a run may have: what it must hold is as large a part of it as of the template.
_SPANS = [math.ceil(len(text.split()) / CONTAINMENT) for _, text in TEMPLATES]
_VOCABULARY = sorted({w for _, words in _SETS for w in words})


def _words(text: Column) -> Column:
    """Words of a text, with an empty string at either end where it begins or ends outside a word."""
    return F.split(F.lower(F.replace(text, F.lit(KELVIN), F.lit(KRA))), NOT_WORD)


def phrases(df: DataFrame, text: Column, found: dict[str, str] = PHRASES) -> DataFrame:
    """Adds `n_words` and `places`, an array of (start word, label) of the phrases, in order."""
    df = df.withColumn("_words", once(F.filter(_words(F.coalesce(text, F.lit(""))), lambda w: w != "")))
    sought = [(phrase.split(), label) for phrase, label in found.items()]
    lasts = sorted({words[-1] for words, _ in sought})

    def label_at(i: Column) -> Column:
        chosen = F.lit(None).cast("string")
        for words, label in sought:
            here = reduce(lambda a, b: a & b, (F.get("_words", i + k) == w for k, w in enumerate(words)))
            chosen = F.coalesce(F.when(here, label), chosen)
        return chosen

    # Only texts that hold a last word of a phrase are walked through.
    there = F.when(F.arrays_overlap("_words", F.array(*map(F.lit, lasts))), F.col("_words"))
    walked = F.transform(there, lambda w, i: F.when(w.isin(*{s[0] for s, _ in sought}), F.struct(i.alias("start"), label_at(i).alias("label"))))
    places = F.filter(F.coalesce(walked, F.array()), lambda p: p["label"].isNotNull())
    return df.withColumn("n_words", F.size("_words").cast("bigint")).withColumn("places", once(places)).drop("_words")


def blocks(df: DataFrame, text: Column) -> DataFrame:
    """Exploded: the number of the block, and which template words it has, for blocks with any."""
    lines = df.select("id", "key", F.posexplode(F.split(text, "\n", -1)).alias("block", "line"))
    words = F.array_intersect(_words(F.col("line")), F.array(*map(F.lit, _VOCABULARY)))
    return lines.select("id", "key", "block", words.alias("words"))


def template_matches(df: DataFrame, text: Column) -> DataFrame:
    """(id, key, block, label, containment): every pair of block and template that meets the threshold.

    `df` has the columns id and key, which name a document.
    """
    spark, found = df.sparkSession, blocks(df, text)
    counts = found.select(F.explode("words").alias("word")).groupBy("word").count()
    times = {r["word"]: r["count"] for r in counts.collect()}  # at most one row per word of the templates
    rank = {w: i for i, w in enumerate(sorted(_VOCABULARY, key=lambda w: (times.get(w, 0), w)))}
    index = []
    for number, ((label, words), need) in enumerate(zip(_SETS, _NEED)):
        ordered = sorted(words, key=rank.__getitem__)
        for i, word in enumerate(ordered[: len(ordered) - need + 1]):
            index.append((rank[word], number, label, i, need, [rank[w] for w in ordered]))
    index_df = spark.createDataFrame(
        index, "word int, template int, label string, at int, need int, whole array<int>"
    )
    ranks = F.create_map(*(F.lit(x) for w, i in rank.items() for x in (w, i)))
    prefixes = F.array(*(F.lit(i) for i in sorted({row[0] for row in index})))
    held = (
        found.where(F.size("words") >= min(_NEED))
        .withColumn("held", once(F.array_sort(F.transform("words", lambda w: F.element_at(ranks, w)))))
        .where(F.arrays_overlap("held", prefixes))
    )
    met = held.select("id", "key", "block", "held", F.posexplode("held").alias("place", "word"))
    met = met.join(F.broadcast(index_df), "word")
    follow = F.least(F.size("whole") - F.col("at"), F.size("held") - F.col("place"))
    met = met.where(F.least("at", "place") + follow >= F.col("need"))
    shared = F.size(F.array_intersect("held", "whole"))
    met = met.withColumn("shared", shared).where(F.col("shared") >= F.col("need"))
    return met.select(
        "id", "key", "block", "label", "template", (F.col("shared") / F.size("whole")).alias("containment")
    ).distinct()


def wrapped_matches(df: DataFrame, text: Column) -> DataFrame:
    """(id, key, label, containment): every template of which some run of words, across lines, holds enough."""
    templates = F.array(*(
        F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, words)).alias("words"), F.lit(need).alias("need"), F.lit(span).alias("span"))
        for (label, words), need, span in zip(_SETS, _NEED, _SPANS)
    ))
    rows = df.select("id", "key", once(F.filter(_words(text), lambda w: w != "")).alias("all"))
    rows = rows.withColumn("held", once(F.array_intersect("all", F.array(*map(F.lit, _VOCABULARY))))).where(F.size("held") >= min(_NEED))
    rows = rows.withColumn("t", F.explode(F.filter(templates, lambda t: F.size(F.array_intersect("held", t["words"])) >= t["need"])))
    spots = F.filter(F.transform("all", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda s: F.array_contains(F.col("t.words"), s["word"]))
    rows = rows.select("id", "key", "t", once(spots).alias("spots"))

    def held_from(spot: Column, i: Column) -> Column:
        near = F.filter(F.slice("spots", i + 1, F.col("t.span")), lambda s: s["at"] < spot["at"] + F.col("t.span"))
        return F.size(F.array_distinct(F.transform(near, lambda s: s["word"])))

    rows = rows.withColumn("shared", once(F.array_max(F.transform("spots", held_from)))).where("shared >= t.need")
    return rows.select("id", "key", F.col("t.label").alias("label"), (F.col("shared") / F.size("t.words")).alias("containment"))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", wrapped: bool = False) -> DataFrame:
    """A row per row of `df`: id, n_words, places of phrases, labels of templates met, best containment."""
    text = F.col(f"`{text_col}`")
    # A document is known by its id and the hash of its text: no numbering of rows that a lost task may change.
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    met = template_matches(own, F.col("text")).select("id", "key", "label", "containment")
    if wrapped:
        met = met.union(wrapped_matches(own, F.col("text")))
    met = met.groupBy(F.col("id").alias("met_id"), F.col("key").alias("met_key"))
    met = met.agg(F.collect_set("label").alias("met"), F.max("containment").alias("containment"))
    rows = phrases(own, F.col("text")).select("id", "key", "n_words", "places")
    rows = rows.join(met, F.col("id").eqNullSafe(F.col("met_id")) & (F.col("key") == F.col("met_key")), "left")
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        "places",
        F.coalesce("met", F.array().cast("array<string>")).alias("met"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )


def label_list(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def _sql() -> str:
    """The same in DuckDB: every line is compared with every template, and every run of words from a template's word on."""
    templates = ", ".join(f"('{label}', {words!r}, {span})" for (label, words), span in zip(_SETS, _SPANS))
    low = lambda x: f"lower(replace({x}, '{KELVIN}', '{KRA}'))"
    places = " UNION ALL ".join(
        f"SELECT r, i - {len(p.split())} AS start, '{label}' AS label FROM words WHERE "
        + " AND ".join(f"w[i - {len(p.split()) - 1 - k}] = '{x}'" for k, x in enumerate(p.split()))
        for p, label in PHRASES.items()
    )
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, text, regexp_extract_all({low("coalesce(text, '')")}, '{word}') AS w
    FROM documents
), words AS (
    SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs
), places AS ({places}), base AS (
    SELECT r, count(*) AS n, min(start) AS first_word, max(start) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, list(DISTINCT label) AS all_labels
    FROM places GROUP BY r
), lines AS (
    SELECT r, list_distinct(regexp_extract_all({low("line")}, '{word}')) AS held
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
), templates(label, words, span) AS (VALUES {templates}), spots AS (
    SELECT r, i, w[i] AS word, label, span, t.words AS sought, hash(t.words) AS template
    FROM words JOIN (SELECT *, unnest(words) AS word FROM templates) t ON w[i] = t.word
), enough AS (
    SELECT r, template FROM spots GROUP BY r, template HAVING count(DISTINCT word) >= ceil({CONTAINMENT} * any_value(len(sought)))
), runs AS (
    SELECT r, label, len(sought) AS n, count(DISTINCT word) OVER (
        PARTITION BY r, template ORDER BY i RANGE BETWEEN CURRENT ROW AND span - 1 FOLLOWING) AS shared
    FROM spots JOIN enough USING (r, template)
), met AS (
    SELECT r, label, len(list_intersect(held, words)) AS shared, len(words) AS n FROM lines, templates
    UNION ALL SELECT r, label, shared, n FROM runs
), resembling AS (
    SELECT r, list(DISTINCT label) AS all_labels, max(shared / n) AS score FROM met
    WHERE shared >= ceil({CONTAINMENT} * n) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.first_word::BIGINT AS first_word,
    b.last_word::BIGINT AS last_word, coalesce(b.labels, '') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(b.all_labels, []), coalesce(s.all_labels, [])))), ',') AS labels,
    CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(s.score, 0)::DOUBLE END AS score
FROM docs LEFT JOIN base b USING (r) LEFT JOIN resembling s USING (r)
"""


SQL = _sql()
