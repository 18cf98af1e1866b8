"""Naive Bayes and the commoner answer in closed form.

One aggregate over the training rows gives every number of these models, and scores are column expressions:
no iterative fit, no pass of its own per model.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from pennyflow.plans.ml import INPUTS, LABEL, evaluate

#: Part of the largest variance that is added to every variance, so that none is 0.
SMOOTHING = 1e-9


def split_by_digest(df: DataFrame, sixteenths: int = 3) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the first hexadecimal digit of the MD5 of the row's key."""
    digit = F.substring(F.md5(F.concat_ws("/", "user_id", "boost_id")), 1, 1)
    is_test = F.conv(digit, 16, 10).cast("int") < sixteenths
    return df.where(~is_test), df.where(is_test)


def statistics(train: DataFrame, inputs: Sequence[str] = INPUTS) -> Row:
    """The one row that all models here are made of: sizes, and per input its means, variances, least and greatest."""
    of = lambda x, c: F.when(F.col(LABEL) == c, x)
    parts = [F.count(of(F.lit(1), c)).alias(f"n_{c}") for c in (0, 1)]
    for i, name in enumerate(inputs):
        x = F.col(name)
        parts += [F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}"), F.var_pop(x).alias(f"var_{i}")]
        for c in (0, 1):
            parts += [F.avg(of(x, c)).alias(f"mean_{i}_{c}"), F.var_pop(of(x, c)).alias(f"var_{i}_{c}")]
    return train.agg(*parts).first()


def commoner(found: Row) -> float:
    """The commoner label; of equals, and without rows, the positive one."""
    return float(found["n_1"] >= found["n_0"])


def _sum(terms: list[Column]) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _one_class(found: Row) -> Column | None:
    """Where the training rows hold one class, or none, every row scores the same."""
    return None if found["n_0"] and found["n_1"] else F.lit(0.0) + (1.0 if commoner(found) else -1.0)


def gaussian_score(found: Row, inputs: Sequence[str] = INPUTS) -> Column:
    """Log odds of the positive class if each input is normal within a class."""
    if (same := _one_class(found)) is not None:
        return same
    # inputs that never vary leave no largest variance to take a part of
    least = SMOOTHING * (max(found[f"var_{i}"] for i in range(len(inputs))) or 1.0)

    def log_likelihood(c: int) -> Column:
        terms = [F.lit(math.log(found[f"n_{c}"] / (found["n_0"] + found["n_1"])))]
        for i, name in enumerate(inputs):
            spread, away = found[f"var_{i}_{c}"] + least, F.col(name) - found[f"mean_{i}_{c}"]
            terms.append(-0.5 * (math.log(2.0 * math.pi * spread) + away * away / spread))
        return _sum(terms)

    return log_likelihood(1) - log_likelihood(0)


def multinomial_score(found: Row, inputs: Sequence[str] = INPUTS) -> Column:
    """Log odds of the positive class if inputs, scaled to 0 to 1 by the training rows, are counts; one is added to each."""
    if (same := _one_class(found)) is not None:
        return same
    width = [(found[f"max_{i}"] - found[f"min_{i}"]) or 1.0 for i in range(len(inputs))]

    def logs(c: int) -> list[float]:
        sums = [found[f"n_{c}"] * (found[f"mean_{i}_{c}"] - found[f"min_{i}"]) / w for i, w in enumerate(width)]
        return [math.log((s + 1.0) / (sum(sums) + len(inputs))) for s in sums]

    terms = [F.lit(math.log(found["n_1"] / found["n_0"]))]
    for i, (name, one, none) in enumerate(zip(inputs, logs(1), logs(0))):
        terms.append((F.col(name) - found[f"min_{i}"]) / width[i] * (one - none))
    return _sum(terms)


def compare(train: DataFrame, test: DataFrame, inputs: Sequence[str] = INPUTS) -> DataFrame:
    """Scores over the test rows of both kinds of naive Bayes and of always giving the commoner answer."""
    found = statistics(train, inputs)
    models = {
        "gaussian_naive_bayes": gaussian_score(found, inputs),
        "multinomial_naive_bayes": multinomial_score(found, inputs),
        "majority": F.lit(0.0) + (commoner(found) - 0.5),
    }
    tables = []
    for name, score in models.items():
        guess = test.select(LABEL, score.cast("double").alias("score"))
        guess = guess.withColumn("prediction", (F.col("score") > 0).cast("double"))
        tables.append(evaluate(guess, "score").withColumn("model", F.lit(name)))
    return tables[0].unionByName(tables[1]).unionByName(tables[2])
