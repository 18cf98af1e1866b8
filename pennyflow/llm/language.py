"""Language identification by words first, and shorter and shorter character n-grams for unseen words.

**Model.** From labelled rows, per language, the log frequency of its most frequent words and of the n-grams of its
words (with a mark at either end). It is fitted on about `SAMPLE` rows per language, chosen by a hash, and keeps
`MOST_WORDS` words and `MOST_GRAMS` n-grams of each length per language; these bounds are parameters, and they bound
what is collected and sent to the executors. Everything is counted by Spark.

**Prediction.** A known word scores its log frequency in each language. An unseen word scores the mean over its known
n-grams of the greatest length of which it has any, discounted once for every step down. The sum over the words
of the whole text decides; `score` is the probability that follows from the sums under equal priors.

A text that is null or without a letter gets `und` and score 0. A text of which nothing is known, not even single
characters, gets the language with most labelled rows, and the score of a guess. Ties go to the first
language by code points. Without any labelled row all texts get `und`. Each distinct row is judged by itself.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennyflow.llm.common import arrow_map, own_columns

UNDETERMINED = "und"
SAMPLE = 2_000
MOST_WORDS = 15_000
MOST_GRAMS = 6_000
MOST_LANGUAGES = 1_000
LONGEST = 5
DISCOUNT = 0.6
#: Words whose scores a task remembers; beyond it starts anew.
REMEMBERED = 300_000
#: Faster than a class of letters, but also takes superscripts, fractions and the like; `words` cuts them out.
NEAR_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """The runs of letters of a text."""
    found = NEAR_LETTERS.findall(text)
    if not all(map(str.isalpha, found)):
        found = [w for near in found for w in "".join(c if c.isalpha() else " " for c in near).split()]
    return found


def in_test_fold(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def _most(counts: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("n"), "token")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")


def frequencies(rows: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, dict[str, int]]:
    """(lang, size, token, n): counts of words (size 0) and of n-grams by length; and rows per language.

    `rows` has text, lang and a hash, `draw`, that chooses the sample.
    """
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    per_lang = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(per_lang) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    shares = [x for lang, n in per_lang.items() for x in (F.lit(lang), F.lit(min(1.0, sample / n)))]
    if shares:
        chance = F.element_at(F.create_map(*shares), F.col("lang"))
        rows = rows.where(F.pmod("draw", F.lit(1 << 30)) < chance * (1 << 30))
    token = F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("token")
    words = rows.select("lang", token).where("token <> ''").groupBy("lang", "token").agg(F.count("*").alias("n"))
    marked = F.concat(F.lit("^"), F.col("token"), F.lit("$"))
    sizes = F.explode(F.array(*map(F.lit, range(1, LONGEST + 1)))).alias("size")
    grams = words.select("lang", "n", marked.alias("word"), sizes).where(F.length("word") >= F.col("size"))
    starts = F.sequence(F.lit(1), F.length("word") - F.col("size") + 1)
    grams = grams.select("lang", "n", "size", F.explode(F.transform(starts, lambda i: F.substr("word", i, F.col("size")))).alias("token"))
    grams = grams.groupBy("lang", "size", "token").agg(F.sum("n").alias("n"))
    both = _most(words, ["lang"], MOST_WORDS).select("lang", F.lit(0).alias("size"), "token", "n")
    return both.union(_most(grams, ["lang", "size"], MOST_GRAMS).select("lang", "size", "token", "n")), per_lang


class Model:
    """Log frequencies per language of words and n-grams."""

    def __init__(self, counts: list[tuple[str, int, str, int]], per_lang: dict[str, int]):
        self.langs = sorted(per_lang)
        self.usual = min(self.langs, key=lambda x: (-per_lang[x], x)) if self.langs else UNDETERMINED
        place = {lang: i for i, lang in enumerate(self.langs)}
        totals: dict[int, list[int]] = defaultdict(lambda: [0] * len(place))
        by_size: dict[int, dict[str, list[int]]] = defaultdict(dict)
        for lang, size, token, n in counts:
            by_size[size].setdefault(token, [0] * len(place))[place[lang]] += n
            totals[size][place[lang]] += n
        self.tables = {
            size: {
                token: tuple(math.log((n + 0.5) / (total + 1)) for n, total in zip(row, totals[size]))
                for token, row in table.items()
            }
            for size, table in by_size.items()
        }

    def score(self, word: str) -> tuple[float, ...] | None:
        known = self.tables.get(0, {}).get(word)
        if known is not None:
            return known
        word, weight = f"^{word}$", DISCOUNT
        for size in range(min(LONGEST, len(word)), 0, -1):
            table = self.tables.get(size, {})
            rows = [row for i in range(len(word) - size + 1) if (row := table.get(word[i : i + size])) is not None]
            if rows:
                return tuple(weight * sum(column) / len(rows) for column in zip(*rows))
            weight *= DISCOUNT
        return None


class Judge:
    def __init__(self, model: Model):
        self._model, self._known = model, {}
        self._nothing = (0.0,) * len(model.langs)

    def __call__(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words((text or "").lower()))
        if not counts or not self._model.langs:
            return UNDETERMINED, 0.0
        if len(self._known) > REMEMBERED:
            self._known.clear()
        known, rows, found = self._known, [], False
        for word in counts:
            row = known.get(word)
            if row is None:
                row = known[word] = self._model.score(word) or self._nothing
            rows.append(row)
            found = found or row is not self._nothing
        if not found:
            return self._model.usual, 1.0 / len(self._model.langs)
        sums = np.array(rows).T @ np.fromiter(counts.values(), np.float64, len(rows))
        best = int(sums.argmax())
        return self._model.langs[best], float(1.0 / np.exp(sums - sums[best]).sum())


def predicted(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of `df`: its id, `lang_pred` and `score`."""
    kept = own_columns(df, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        judge = Judge(shared.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            langs, scores = zip(*map(judge, batch.column(text_col).to_pylist()))
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [id_col, "lang_pred", "score"],
            )

        return step

    kind = dict(kept.dtypes)[id_col]
    return arrow_map(kept, text_col, f"`{id_col}` {kind}, lang_pred string, score double", start)


def fitted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from the labelled rows of `df`. The id only draws the sample."""
    rows = df.select(
        F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").alias("lang"),
        F.xxhash64(F.col(f"`{id_col}`"), F.lit("sample")).alias("draw"),
    )
    counts, per_lang = frequencies(rows, sample)
    # At most (MOST_WORDS + LONGEST * MOST_GRAMS) rows per language.
    return Model([tuple(r) for r in counts.collect()], per_lang)
