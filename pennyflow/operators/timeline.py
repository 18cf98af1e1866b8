"""Looking back and ahead along each key's timeline without joining the events to each other.

"How many saves came before this offer" and "when is the next save" are asked of every row of a
table that mixes both kinds of event. A self join would pair every offer with every save of the
user. Here a timeline is cut into cells of an hour. A window over a key's cell answers from the rows
of the cell, a second one over the key's cells adds what the cells before or after hold, and one
join brings both together. All keys go this way: a key with a third of all rows has many cells, and
no task holds more than a cell's rows or a row per cell of a key.

A question with an offset is asked at the row's own time of rows that are moved by the offset, so a
row asks all its questions in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL_MS = 3_600_000
_COMBINE = {"count": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Look:
    """One question about the other rows of the same key.

    ``before`` covers rows with time < t + offset, ``after`` rows with time > t + offset, where t is
    the asking row's time. Rows whose ``value`` is null take no part.
    """

    name: str
    kind: str  # count | min | max
    value: Column
    side: str  # before | after
    offset: int = 0

    def counted(self) -> Column:
        """What is combined: the value, or 1 for each."""
        return F.when(self.value.isNotNull(), F.lit(1).cast("long")) if self.kind == "count" else self.value


def look_around(
    rows: DataFrame, key: Sequence[str], t: str, looks: Sequence[Look], asks: Column, cell_ms: int | None = None
) -> DataFrame:
    """The rows where ``asks`` holds, each with one added column per look.

    A count with nothing to count is 0; a minimum or maximum of nothing is null. Rows whose key is
    null form a timeline like others.
    """
    # a struct is never null, and equal to another with nulls in the same places
    owner = F.struct(*key).alias("_key")
    kept = rows.columns
    valued = rows.withColumns({_v(look): look.counted() for look in looks} | {"_asks": F.coalesce(asks, F.lit(False))})
    kinds = dict(valued.dtypes)

    def moments(*payload: Column) -> DataFrame:
        """Per asking row a moment with its payload, per row with values a moment at each offset."""

        def moment(at: Column, of: int | None, cargo: Sequence[Column]) -> Column:
            own = [
                (F.col(_v(look)) if look.offset == of else F.lit(None).cast(kinds[_v(look)])).alias(_v(look))
                for look in looks
            ]
            return F.struct(at.cast("long").alias("_at"), *own, *cargo)

        nothing = [F.lit(None).cast(valued.select(c).schema[0].dataType).alias("_row") for c in payload]
        made = [F.when(F.col("_asks"), moment(F.col(t), None, payload))]
        for offset in sorted({look.offset for look in looks}):
            holds = [F.col(_v(look)).isNotNull() for look in looks if look.offset == offset]
            some = holds[0]
            for more in holds[1:]:
                some = some | more
            made.append(F.when(some, moment(F.col(t) - F.lit(offset), offset, nothing)))
        exploded = valued.select(owner, F.explode(F.array_compact(F.array(*made))).alias("_m"))
        return exploded.select("_key", "_m.*").withColumn("_cell", F.floor(F.col("_at") / (cell_ms or CELL_MS)))

    inside = _frames(["_key", "_cell"], "_at")
    within = moments(F.struct(*kept).alias("_row")).select(
        "_key", "_cell", "_row", *[_running(look, inside).alias(f"_in_{look.name}") for look in looks]
    )
    cells = moments().groupBy("_key", "_cell").agg(*[_COMBINE[look.kind](_v(look)).alias(_v(look)) for look in looks])
    across = _frames(["_key"], "_cell")
    carried = cells.select("_key", "_cell", *[_running(look, across).alias(f"_out_{look.name}") for look in looks])

    def total(look: Look) -> Column:
        near, far = F.col(f"_in_{look.name}"), F.col(f"_out_{look.name}")
        if look.kind == "count":
            zero = F.lit(0).cast("long")
            return F.coalesce(near, zero) + F.coalesce(far, zero)
        return (F.least if look.kind == "min" else F.greatest)(near, far)

    # both sides grow with the rows and are small only when packed: neither may go through the driver as a broadcast
    answered = within.where(F.col("_row").isNotNull()).join(carried.hint("merge"), ["_key", "_cell"])
    return answered.select("_row.*", *[total(look).alias(look.name) for look in looks])


def _v(look: Look) -> str:
    return f"_v_{look.name}"


def _frames(key: Sequence[str], t: str) -> dict[str, Window]:
    """Both frames grow from the far end, so each is one running aggregate."""
    return {
        "before": Window.partitionBy(*key).orderBy(F.col(t)),
        "after": Window.partitionBy(*key).orderBy(-F.col(t)),
    }


def _running(look: Look, frames: dict[str, Window]) -> Column:
    frame = frames[look.side].rangeBetween(Window.unboundedPreceding, -1)
    return _COMBINE[look.kind](F.col(_v(look))).over(frame)
