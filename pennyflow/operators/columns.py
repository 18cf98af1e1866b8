"""Small summaries of any column."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennyflow.operators.skew import lookup_join


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), column)


def with_group_size(df: DataFrame, key: Sequence[str], name: str = "group_size") -> DataFrame:
    """Each row with the number of rows of its group. A window over the group would hold a whole
    group in one task; counting first and looking the counts up does not."""
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias(name))
    return lookup_join(df, sizes, key)


def first_per_group(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """One row per group with each column's first value that is not null, in ``order``."""
    return _edge(df, key, order, F.min_by)


def last_per_group(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """One row per group with each column's last value that is not null, in ``order``."""
    return _edge(df, key, order, F.max_by)


def _edge(df: DataFrame, key: Sequence[str], order: str, pick) -> DataFrame:
    # equal places in the order are decided by the value
    place = lambda c: F.when(F.col(c).isNotNull(), F.struct(order, F.col(c).alias("_v")))
    others = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(*[pick(c, place(c)).alias(c) for c in others])


def distinct_and_null_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count_distinct(column).alias("distinct_values"),
        F.count_if(F.col(column).isNull()).alias("null_values"),
    )


def describe_whole_numbers(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max, exact. Values are counted first, so that each
    distinct value reaches the final step once."""
    v, n = F.col(column), F.col("_rows")
    counts = df.where(v.isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    rows, total, squares = F.sum(n), F.sum(v * n), F.sum((v * v).cast("double") * n)
    spread = (squares - total.cast("double") * total / rows) / F.nullif(rows - 1, F.lit(0))
    quantile = lambda p: F.percentile(v, F.lit(p), n)
    return counts.agg(
        rows.alias("count"),
        (total / rows).alias("mean"),
        F.sqrt(spread).alias("std"),
        F.min(v).alias("min"),
        quantile(0.25).alias("q25"),
        quantile(0.5).alias("q50"),
        quantile(0.75).alias("q75"),
        F.max(v).alias("max"),
    )


def one_row_to_items(df: DataFrame, items: list[tuple[int, str, Column, Column]]) -> DataFrame:
    """Turn a one-row aggregate into (position, metric_name, metric_value, display) rows."""
    structs = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("metric_name"),
            value.cast("double").alias("metric_value"),
            shown.alias("display"),
        )
        for position, name, value, shown in items
    ]
    return df.select(F.explode(F.array(*structs)).alias("m")).select("m.*")
