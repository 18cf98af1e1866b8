"""Counting matching (withdrawal, saving) pairs per user.

A withdrawal w matches a saving s when ``0.95 * s <= w <= s`` and w came at most h hours after s; a
withdrawal that came first also matches, as the published rule has no lower time bound. The amounts
that match w are a range of integers. Amounts are cut into bands 5 % wide, and w meets the savings of
its range's two or three bands.

A user's band with up to `FEW` savings is joined as it is: a withdrawal looks at each of them, so it
makes at most a fixed number of comparisons, and no pair is kept. A crowded band is counted without forming
pairs: the range is cut into blocks of an 8-way number tree; each saving is entered under every block
that contains it, about nine rows, and a withdrawal, some sixty rows, then only asks how many savings of one
block are not older than h hours. That is a count along a timeline. Either way the work is linear in the
rows, however many pairs there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.operators.skew import lookup_join
from pennyflow.operators.timeline import Look, look_around

_STEP = 3  # 8 = 2**3 children per block
FEW = 256  # savings of a user in one band and case that are compared one by one


@dataclass(frozen=True)
class Case:
    """One question: pairs within ``hours``, among the rows where ``applies`` holds."""

    name: str
    hours: int
    applies: Column


def highest_match(amount: Column) -> Column:
    """The largest saving that a withdrawal of ``amount`` still matches: max s, 0.95 * s <= amount."""
    guess = F.floor(amount / F.lit(C.TOLERANCE)).cast("long")
    fits = lambda s: s * F.lit(C.TOLERANCE) <= amount
    return F.when(fits(guess + 1), guess + 1).when(fits(guess), guess).otherwise(guess - 1)


def _band(amount: Column) -> Column:
    """Grows with the amount; any saving that matches lies in a band of the withdrawal's range."""
    width = F.lit(1.0 / C.TOLERANCE)
    return F.when(amount > 0, F.floor(F.ln(amount) / F.ln(width))).otherwise(F.lit(-1)).cast("long")


def _top_level(amount: Column) -> Column:
    """No range that reaches ``amount`` holds a block larger than this level's."""
    widest = amount * F.lit(1.0 / C.TOLERANCE - 1.0) + 2.0
    return F.ceil(F.log(8.0, widest)).cast("int")


def _enter_blocks(savings: DataFrame) -> DataFrame:
    """Each saving once under every block that holds its amount."""
    return savings.withColumn(
        "level", F.explode(F.sequence(F.lit(0), _top_level(F.col("amount"))))
    ).withColumn("block", F.call_function("shiftright", F.col("amount"), F.col("level") * _STEP))


def _cover_range(withdrawals: DataFrame) -> DataFrame:
    """Each withdrawal under blocks that together hold every integer of [amount, high] once.

    ``a`` and ``b`` bound the blocks of a level that lie inside the range, ``inner_a`` and
    ``inner_b`` those of the next level; what the larger blocks take is left out of this level.
    """
    low, stop = F.col("amount"), F.col("high") + 1

    def first_at(level):
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level * _STEP)
        return F.call_function("shiftright", low + size - 1, level * _STEP)

    def end_at(level):
        return F.call_function("shiftright", stop, level * _STEP)

    def run(start: str, end: str):
        some = F.sequence(F.col(start), F.col(end) - 1)
        return F.when(F.col(start) < F.col(end), some).otherwise(F.array().cast("array<bigint>"))

    level = F.col("level")
    return (
        withdrawals.withColumn("level", F.explode(F.sequence(F.lit(0), _top_level(F.col("high")))))
        .withColumns({"a": first_at(level), "b": end_at(level)})
        .where("a < b")
        .withColumns({"inner_a": first_at(level + 1) * 8, "inner_b": end_at(level + 1) * 8})
        .withColumn("nested", F.col("inner_a") < F.col("inner_b"))
        .withColumns(
            {
                "left_end": F.when(F.col("nested"), F.col("inner_a")).otherwise(F.col("b")),
                "right_start": F.when(F.col("nested"), F.col("inner_b")).otherwise(F.col("b")),
            }
        )
        .withColumn("block", F.explode(F.concat(run("a", "left_end"), run("right_start", "b"))))
        .drop("a", "b", "inner_a", "inner_b", "nested", "left_end", "right_start")
    )


def matching_pairs(
    behaviour: DataFrame,
    cases: Sequence[Case],
    strict: bool = False,
    few: int = FEW,
) -> DataFrame:
    """(user_id, case, pairs) for the users with at least one pair.

    ``strict`` counts only withdrawals at or after the saving. ``few`` decides how a band is counted,
    never what is counted.
    """
    chosen = F.array_compact(
        F.array(
            *[
                F.when(
                    c.applies,
                    F.struct(F.lit(c.name).alias("case"), F.lit(c.hours * C.HOUR_MS).alias("span")),
                )
                for c in cases
            ]
        )
    )
    rows = (
        behaviour.where((F.col("amount") >= 0) & F.col("transaction_type").isin(C.SAVING, C.WITHDRAWAL))
        .withColumn("c", F.explode(chosen))
        .select(
            "user_id",
            "c.case",
            "c.span",
            "transaction_type",
            "amount",
            F.col("time_transaction_occurred").alias("t"),
        )
    )
    key = ["user_id", "case"]
    withdrawals = rows.where(F.col("transaction_type") == C.WITHDRAWAL).withColumn(
        "high", highest_match(F.col("amount"))
    )
    asks = withdrawals.withColumn("band", F.explode(F.sequence(_band(F.col("amount")), _band(F.col("high")))))
    savings = rows.where(F.col("transaction_type") == C.SAVING).withColumn("band", _band(F.col("amount")))
    savings = savings.select(*key, "band", "amount", "t")
    place = [*key, "band"]
    sizes = savings.groupBy(*place).agg(
        F.count(F.lit(1)).alias("n"), F.min("amount").alias("least"), F.max("amount").alias("most")
    )
    crowded = sizes.where(F.col("n") > few).drop("n")
    told = lookup_join(savings, crowded, place)
    # A withdrawal meets at most `few` savings of a band; adaptive execution may split its withdrawals. Both sides grow
    # with the rows, so they are merged: a broadcast would pass the driver.
    one = told.where(F.col("least").isNull()).select(*place, F.col("amount").alias("saved"), F.col("t").alias("saved_at"))
    met = asks.join(one.hint("merge"), place).where(
        F.col("saved").between(F.col("amount"), F.col("high")) & (F.col("saved_at") >= F.col("t") - F.col("span"))
    )
    if strict:
        met = met.where(F.col("saved_at") <= F.col("t"))
    # of the other bands a withdrawal asks for the part of its range that has savings
    wide = lookup_join(asks.hint("merge"), crowded, place, "inner").withColumns(
        {"amount": F.greatest("amount", "least"), "high": F.least("high", "most")}
    )
    counted = _counted(told.where(F.col("least").isNotNull()), wide.where("amount <= high"), place, strict)
    found = met.select(*key, F.lit(1).cast("long").alias("pairs")).unionByName(counted.select(*key, "pairs"))
    return found.groupBy(*key).agg(F.sum("pairs").alias("pairs")).where("pairs > 0")


def _counted(savings: DataFrame, withdrawals: DataFrame, place: Sequence[str], strict: bool) -> DataFrame:
    """Per asked block the savings that match, as ``pairs``; in strict mode less those after the withdrawal."""
    entered = _enter_blocks(savings).select(
        *place, "level", "block", "t", F.lit(None).cast("int").alias("weight")
    )
    # savings at or after t - span; in strict mode less those after t
    asks = [F.struct((F.col("t") - F.col("span") - 1).alias("at"), F.lit(1).alias("weight"))]
    if strict:
        asks.append(F.struct(F.col("t").alias("at"), F.lit(-1).alias("weight")))
    asked = (
        _cover_range(withdrawals)
        .withColumn("ask", F.explode(F.array(*asks)))
        .select(*place, "level", "block", F.col("ask.at").alias("t"), F.col("ask.weight").alias("weight"))
    )
    is_saving = F.when(F.col("weight").isNull(), F.lit(True))
    counted = look_around(
        entered.unionByName(asked),
        [*place, "level", "block"],
        "t",
        [Look("later", "count", is_saving, "after")],
        F.col("weight").isNotNull(),
    )
    return counted.select(*place, (F.col("later") * F.col("weight")).alias("pairs"))
