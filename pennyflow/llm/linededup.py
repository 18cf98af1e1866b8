"""Line deduplication: repeated runs of lines are found as content-defined chunks and removed.

**Boundaries.** A text is cut at "\\n"; lines of spaces only belong to no chunk. A polynomial hash rolls over the
hashes of two neighbouring lines with words. A gap between such lines is a boundary unless its rolling hash
occurs elsewhere in the table, so boundaries stand exactly where a passage begins and ends, wherever it
stands. A chunk is what lies between two boundaries and has two or more lines. A line of `LONG_LINE` words
or more is a chunk of its own as well: a long passage pasted as one line needs no neighbour.

**Repeats.** Chunks of different documents may overlap in part only, so they are compared and removed by their links,
the two lines beside a gap. Links whose hash occurs twice or more are found first, which moves hashes only. Their
lines are then grouped by hash and whole text, which is the comparison byte by byte. The first occurrence of a link,
by id (null last), text and place, is held; lines of any other occurrence go, with the blank lines between, unless a link
that is held here needs them. So each repeated passage stays whole once, and "a a a a" becomes "a a".

The minimum is taken map side, and occurrences are marked by joins, whose large keys Spark splits; what is gathered is
the links of one document.

Rows equal in id and text are one document: they keep and lose the same lines. A null text stays null and an
empty one empty, with 0 and 1 lines. A text that loses all its lines becomes empty. Other columns pass
through, except that columns named like the two that are added, or with `_ld_` in front, give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennyflow.functions.plans import once

LONG_LINE = 50
BASE = 31
#: Line hashes stay below 2**56, so that the polynomial fits in 64 bits.
HASHES = 2**56


def line_hash(line: Column) -> Column:
    return F.pmod(F.xxhash64(line), F.lit(HASHES))


def _words(line: Column) -> Column:
    """Words as counted by single spaces: a bound that needs no pattern."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "))) + 1


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _links(source: DataFrame) -> DataFrame:
    """(_ld_id, _ld_key, a, b, hash): the numbers, from 0, of two neighbouring lines with words, or twice that of a long one."""
    worded = F.filter(
        F.transform(
            _lines(F.col("_ld_text")),
            lambda x, i: F.when(F.trim(x) != "", F.struct(i.alias("i"), line_hash(x).alias("h"), (_words(x) >= LONG_LINE).alias("long"))),
        ),
        lambda s: s.isNotNull(),
    )
    facts = source.where(F.col("_ld_text").isNotNull()).select("_ld_id", "_ld_key", once(worded).alias("s"))
    following = F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0)))

    def link(a: Column, b: Column) -> Column:
        return F.struct(a["i"].alias("a"), b["i"].alias("b"), (BASE * a["h"] + b["h"]).alias("hash"))

    pairs = F.filter(F.zip_with("s", following, link), lambda x: x["b"].isNotNull())
    alone = F.transform(F.filter("s", lambda x: x["long"]), lambda x: F.struct(x["i"].alias("a"), x["i"].alias("b"), (BASE * x["h"]).alias("hash")))
    return facts.select("_ld_id", "_ld_key", F.explode(F.concat(pairs, alone)).alias("x")).select("_ld_id", "_ld_key", "x.a", "x.b", "x.hash")


def _with(df: DataFrame, id_col: str, of_document: DataFrame, how: str) -> DataFrame:
    """`df`, which has `_ld_key`, with a column of its document from `of_document`."""
    right = of_document.withColumnsRenamed({"_ld_id": "_ld_of", "_ld_key": "_ld_of_key"}).hint("shuffle_hash")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("_ld_of")) & (F.col("_ld_key") == F.col("_ld_of_key"))
    return df.join(right, same, how)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` with the text cleaned, and `n_lines`, `n_removed` (lines)."""
    df = df.select(*(F.col(f"`{c}`") for c in df.columns if c not in ("n_lines", "n_removed") and not c.startswith("_ld_")))
    # A document is known by its id and the hash of its text: no numbering of rows that a lost task may change.
    source = df.select(F.col(f"`{id_col}`").alias("_ld_id"), F.col(f"`{text_col}`").alias("_ld_text"))
    source = source.withColumn("_ld_key", F.xxhash64("_ld_text"))
    links = _links(source)
    repeated = links.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1").select("hash")
    candidates = links.join(repeated, "hash", "left_semi")

    place = F.struct(F.col("_ld_id").isNull().alias("last"), "_ld_id", "_ld_key", "a")
    per_document = candidates.groupBy("_ld_id", "_ld_key").agg(F.collect_set(F.struct("a", "b", "hash")).alias("_ld_links"))
    text = F.col(f"`{text_col}`")
    # Both joins with the documents start from the same rows by the same keys, so Spark can shuffle the texts once for both.
    rows = df.withColumn("_ld_key", F.xxhash64(text))
    texts = _with(rows, id_col, per_document, "inner")
    texts = texts.select(F.col(f"`{id_col}`").alias("_ld_id"), "_ld_key", once(_lines(text)).alias("lines"), "_ld_links")
    texts = texts.select("_ld_id", "_ld_key", "lines", F.explode("_ld_links").alias("x"))
    first_line, next_line = F.get("lines", F.col("x.a")), F.get("lines", F.col("x.b"))
    whole = F.when(F.col("x.a") == F.col("x.b"), first_line).otherwise(F.concat(first_line, F.lit("\n"), next_line))
    texts = texts.select("_ld_id", "_ld_key", "x.a", "x.hash", whole.alias("whole"))
    firsts = texts.groupBy("hash", "whole").agg(F.min(place).alias("first"), F.max(place).alias("final"))
    # Unlike texts of one hash have a first place each; an occurrence in none of these places repeats its own text.
    firsts = firsts.select("hash", F.struct("first", (F.col("first") != F.col("final")).alias("again")).alias("f"))
    firsts = firsts.groupBy("hash").agg(F.collect_list("f").alias("firsts")).where(F.exists("firsts", lambda f: f["again"]))
    mine = F.filter("firsts", lambda f: f["first"].eqNullSafe(place))
    marked = candidates.join(firsts, "hash").select("_ld_id", "_ld_key", "a", "b", once(mine).alias("mine"))
    held = F.size("mine") > 0
    marked = marked.where(~held | F.exists("mine", lambda f: f["again"])).withColumn("held", held)
    marks = marked.groupBy("_ld_id", "_ld_key").agg(F.collect_set(F.struct("a", "b", "held")).alias("_ld_marks"))
    marks = marks.where(F.exists("_ld_marks", lambda m: ~m["held"]))

    joined = _with(rows, id_col, marks, "left")
    cut = F.col("_ld_marks").isNotNull()
    touched = joined.withColumn("_ld_lines", once(F.when(cut, _lines(text))))

    def spans(of: Column) -> Column:
        return F.flatten(F.transform(of, lambda m: F.sequence(m["a"], m["b"])))

    gone = F.array_except(spans(F.filter("_ld_marks", lambda m: ~m["held"])), spans(F.filter("_ld_marks", lambda m: m["held"])))
    touched = touched.withColumn("_ld_kept", once(F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), gone)))
    cleaned = F.array_join(F.transform("_ld_kept", lambda k: F.get("_ld_lines", k)), "\n")
    n_lines = F.coalesce(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"))) + 1, F.lit(0))
    touched = touched.withColumn("n_lines", n_lines.cast("bigint")).withColumn(
        "n_removed", F.when(cut, n_lines - F.size("_ld_kept")).otherwise(0).cast("bigint")
    )
    out = [F.when(cut, cleaned).otherwise(text).alias(text_col) if c == text_col else F.col(f"`{c}`") for c in df.columns]
    return touched.select(*out, "n_lines", "n_removed")


#: The same in DuckDB, from what a repeat is: two lines that stood together before. No hash is used.
SQL = f"""
WITH lines AS (
    SELECT DISTINCT doc_id, text, unnest(string_split(text, chr(10))) AS line,
        unnest(range(len(string_split(text, chr(10))))) AS i
    FROM documents WHERE text IS NOT NULL
), worded AS (
    SELECT *, lead(line) OVER w AS next_line, lead(i) OVER w AS next_i,
        strlen(line) - strlen(replace(line, ' ', '')) + 1 >= {LONG_LINE} AS long
    FROM lines WHERE trim(line, ' ') <> '' WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)
), links AS (
    SELECT doc_id, text, i AS a, next_i AS b, line || chr(10) || next_line AS whole FROM worded WHERE next_i IS NOT NULL
    UNION ALL
    SELECT doc_id, text, i, i, line FROM worded WHERE long
), marked AS (
    SELECT *, row_number() OVER (PARTITION BY whole ORDER BY doc_id NULLS LAST, text, a) = 1 AS held,
        count(*) OVER (PARTITION BY whole) AS times
    FROM links
), marks AS (
    SELECT DISTINCT doc_id, text, unnest(range(a, b + 1)) AS i, held FROM marked WHERE times > 1
), gone AS (
    SELECT doc_id, text, i FROM marks GROUP BY doc_id, text, i HAVING NOT bool_or(held)
), cleaned AS (
    SELECT l.doc_id, l.text, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS kept,
        count(g.i) AS n_removed, count(*) AS n_lines
    FROM lines l LEFT JOIN gone g ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.text = g.text AND l.i = g.i
    GROUP BY l.doc_id, l.text
)
SELECT d.doc_id, c.kept AS text, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN cleaned c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.text = c.text
"""
