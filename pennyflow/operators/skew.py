"""A join that keeps its balance when one key holds a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def lookup_join(
    rows: DataFrame, table: DataFrame, key: Sequence[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join many ``rows`` to a ``table`` with at most one row per key.

    The table is repeated ``salts`` times, and the rows of a key are dealt to the copies by the
    number of the partition they were read from, which stays the same when a task is repeated. An
    aggregation by key after the join is then made in two steps, of which the first is spread.
    Adaptive execution splits a plain join by itself; this one is for joins whose partitions a later
    step would rely on.
    """
    key = list(key)
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = rows.withColumn("_salt", F.spark_partition_id() % salts)
    return dealt.join(copies, [*key, "_salt"], how).drop("_salt")
