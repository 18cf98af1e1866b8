"""How far the sources of a language differ in their words, and the words that mark a source.

A term is a run of letters (ASCII, lower-cased, and everything beyond ASCII). Each language keeps the terms that
stand in `LEAST_DOCS` of its documents or more. Every (language, source) group, and the language as a whole, gives
each kept term a smoothed share in billionths, p = 1 + floor(10**9 * (count + 2) / (N + 2 V)), where N is the group's
count of kept terms and V their number. Two shares differ by f = floor((p - q)**2 / (p + q)). All of it is in whole
numbers: shares in decimals, which no count overflows, and f in 64 bits, since p is at most 10**9 + 1.

`pairs` sums f over all kept terms for each two sources of a language. The terms of a language are dealt to all
tasks; each adds up a square of sums over its own terms and hands on one row per pair.

`marks` ranks the terms in which a group lies above its language. f grows with the group's count and falls with the
language's, so a term is passed by another with a count as high or higher, a language count as low or lower, and an
earlier place in UTF-8; a term passed by `top` others cannot be among the first `top`. Every partition keeps the
terms passed by fewer than `top` others (the skyband), bands are merged by the same step, and only what is left is
ranked by f itself.

A null text, language or source counts as ''. A group without terms, and a language without kept terms, keep their
rows in `pairs` (all 0 for the latter). Repeated rows and ids count as often as they stand, as no id is read. An empty
table gives no rows. Tokens are counted per task and handed on when `HELD` of them are held, so memory is bounded.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pennyflow.llm.common import stored
from pennyflow.session import shared_folder

LEAST_DOCS = 10
TOP = 10
#: Counted (language, source, term) triples that a task holds before it hands them on.
HELD = 800_000
#: A held count is occurrences, below this bit, and documents, above it.
DOC_BIT = 40
DOC = 1 << DOC_BIT
#: Points of a group that a task holds before it cuts them to their skyband.
POINTS = 20_000
#: Points of a group that are held against its band at once.
TOGETHER = 256
#: Numbers in one block of differences, so that many sources make small blocks.
BLOCK = 1 << 20
_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _groups(df: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return df.select(
        *(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source")))
    )


def term_counts(groups: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): partial counts of occurrences and of documents, of each task."""

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), own in held.items():
            both = np.fromiter(own.values(), np.int64, len(own))
            columns = [pa.array([x] * len(own), pa.string()) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(own.keys(), pa.string()), pa.array(both & (DOC - 1)), pa.array(both >> DOC_BIT)], ["lang", "source", "term", "n", "docs"]
            )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[str, int]] = {}
        size = 0
        for batch in batches:
            for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
                own = held.setdefault((lang, source), {})
                size -= len(own)
                before = own.get
                # bytes: ASCII letters only
                for term, n in Counter(_TERM.findall(text.encode().lower().decode())).items():
                    own[term] = before(term, 0) + n + DOC
                size += len(own)
                if size > HELD:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    return groups.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def kept_terms(groups: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, n, held): the kept terms with their counts in the language and, above 0, in its sources."""
    # Counted before the shuffle, so that a term has a row per task and source at most; both groupings share it.
    counts = term_counts(groups).repartition("lang", "term")
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("held")
    )
    return terms.where(F.col("docs") >= least_docs).drop("docs")


def _share(count, total, terms):
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)), in decimals of 38 digits."""
    whole = [F.col(c) if isinstance(c, str) else c for c in (count, total, terms)]
    count, total, terms = (c.cast("decimal(27,0)") for c in whole)
    above = ((count + 2) * F.lit(10**9).cast("decimal(10,0)")).alias("above")
    return F.call_function("div", above, (total + 2 * terms)) + 1


def totals(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, v): every occurring group with its count of kept terms, its language's, and
    their number."""
    own = terms.select("lang", F.explode("held").alias("h")).groupBy("lang", F.col("h.source").alias("source")).agg(F.sum("h.n").alias("total"))
    langs = terms.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("v"))
    every = groups.select("lang", "source").distinct()
    zero = F.lit(0).cast("bigint")
    return every.join(own, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "lang_total", "v"]).select(
        "lang", "source", "total", F.coalesce("lang_total", zero).alias("lang_total"), F.coalesce("v", zero).alias("v")
    )


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def pairs(terms: DataFrame, sums: DataFrame) -> DataFrame:
    """(lang, source, item, value): f summed over all kept terms, for each source and each other source of its language."""
    # One array per language: its sources in order, with their totals and their share of a term that they lack.
    order = F.array_sort(F.collect_list(F.struct("source", "total", "none")))
    with_none = sums.where("v > 0").withColumn("none", _share(F.lit(0), "total", "v"))
    langs = with_none.groupBy("lang").agg(order.alias("all"), F.first("v").alias("v"))
    shares = F.transform("held", lambda h: F.struct(h["source"].alias("source"), h["n"].alias("n")))
    rows = terms.select("lang", shares.alias("held")).join(langs, "lang")
    names = F.transform("all", lambda g: g["source"])

    def dense(h):
        at = F.array_position("names", h["source"]).cast("int")
        return F.struct((at - 1).alias("at"), _share(h["n"], F.element_at("all", at)["total"], F.col("v")).alias("p"))

    rows = rows.withColumn("names", names).withColumn("held", F.transform("held", dense))
    rows = rows.select(
        "lang", "names", F.transform("all", lambda g: g["none"]).alias("none"),
        F.transform("held", lambda h: h["at"]).alias("at"), F.transform("held", lambda h: h["p"]).alias("p"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares: dict[str, tuple[list, np.ndarray]] = {}
        for batch in batches:
            for lang, names, none, at, p in zip(*(c.to_pylist() for c in batch.columns)):
                if lang not in squares:
                    squares[lang] = (names, np.zeros((len(names), len(names)), np.int64))
                share = np.array(none, np.int64)
                share[at] = p
                step = max(1, BLOCK // len(names))
                for i in range(0, len(names), step):
                    squares[lang][1][i : i + step] += divergence(share[i : i + step, None], share[None, :])
        for lang, (names, square) in squares.items():
            for i, name in enumerate(names):
                others = [j for j in range(len(names)) if j != i]
                columns = [[lang] * len(others), [name] * len(others), [names[j] for j in others]]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.string()) for c in columns), pa.array(square[i][others], pa.int64())], ["lang", "source", "item", "part"]
                )

    found = rows.mapInArrow(run, "lang string, source string, item string, part bigint")
    found = found.groupBy("lang", "source", "item").agg(F.sum("part").alias("value"))
    # A language without kept terms has pairs too.
    bare = sums.where("v = 0").select("lang", "source")
    bare = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item")
    return found.union(bare.select("lang", "source", "item", F.lit(0).cast("bigint")))


def band(count: np.ndarray, against: np.ndarray, term: list[str], top: int) -> np.ndarray:
    """Places of the points that fewer than `top` others pass: a count as high, `against` as low, an earlier term.

    In the order of falling counts all that pass a point come before it, and if `top` do, then `top` of the band do.
    """
    names = [t.encode() for t in term]
    place = np.empty(len(names), np.int64)
    place[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    kept: list[int] = []
    low, early = np.empty(len(names), np.int64), np.empty(len(names), np.int64)
    order = np.lexsort((place, against, -count))
    for start in range(0, len(order), TOGETHER):
        some, n = order[start : start + TOGETHER], len(kept)
        # Most are passed by what is kept already; the others may also be passed by each other.
        passed = ((low[:n, None] <= against[some]) & (early[:n, None] < place[some])).sum(axis=0)
        for i in some[passed < top]:
            n = len(kept)
            if np.count_nonzero((low[:n] <= against[i]) & (early[:n] < place[i])) < top:
                low[n], early[n] = against[i], place[i]
                kept.append(i)
    return np.array(kept, np.int64)


def skybands(points: DataFrame, top: int = TOP) -> DataFrame:
    """Of (lang, source, term, n, lang_n), the rows of each partition that fewer than `top` of the same group pass."""

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.iloc[band(rows["n"].to_numpy(), rows["lang_n"].to_numpy(), rows["term"].tolist(), top)]

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list[pd.DataFrame]] = {}
        sizes: Counter = Counter()
        for frame in frames:
            for key, rows in frame.groupby(["lang", "source"], sort=False):
                held.setdefault(key, []).append(rows)
                sizes[key] += len(rows)
                if sizes[key] > POINTS:
                    held[key] = [cut(pd.concat(held[key]))]
                    # A band may itself be large; it is cut again when it has doubled.
                    sizes[key] = min(len(held[key][0]), POINTS // 2)
        for own in held.values():
            yield cut(pd.concat(own))

    return points.mapInPandas(run, points.schema)


def marks(terms: DataFrame, sums: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value): the terms of a group above its language that can be among its first `top`."""
    points = terms.select("lang", "term", F.explode("held").alias("h"), F.col("n").alias("lang_n"))
    points = points.select("lang", F.col("h.source").alias("source"), "term", F.col("h.n").alias("n"), "lang_n")
    merged = skybands(skybands(points, top).repartition("lang", "source"), top)
    rows = merged.join(sums, ["lang", "source"])
    rows = rows.withColumn("p", _share("n", "total", "v")).withColumn("q", _share("lang_n", "lang_total", "v")).where("p > q")
    return rows.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))


def audit(
    df: DataFrame,
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` with all other sources, part `term` with the first `top`
    terms; ranks by falling value, then the item in UTF-8."""
    folder = shared_folder(df.sparkSession, "divergence")
    groups = _groups(df, text_col, lang_col, source_col)
    terms = stored(kept_terms(groups, least_docs), folder, "terms")
    sums = stored(totals(terms, groups), folder, "sums")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs(terms, sums), "pair").union(ranked(marks(terms, sums, top), "term").where(F.col("rank") <= top))


#: The same in DuckDB, every two sources of a language compared term by term.
SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
    FROM documents
), tokens AS (
    SELECT r, lang, source, unnest(words) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS d FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= {LEAST_DOCS}
), v AS (
    SELECT lang, count(*) AS v, sum(d) AS n FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*) AS c FROM tokens JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
    SELECT g.lang, g.source, coalesce(n, 0) AS n
    FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source) s USING (lang, source)
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (g.n + 2 * v.v) AS p,
        1 + (1000000000::HUGEINT * (k.d + 2)) // (v.n + 2 * v.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN v USING (lang)
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM found
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
