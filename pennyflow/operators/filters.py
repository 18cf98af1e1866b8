"""Predicates shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.timebox import Window

T = "time_transaction_occurred"


def in_window(window: Window, t: str = T) -> Column:
    return window.holds(F.col(t))


def _days(df: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """On a table laid out by ``event_date``, leave out the days that cannot matter; their files are
    then not even listed."""
    if "event_date" not in df.columns:
        return df
    day = lambda ms: F.to_date(F.timestamp_millis(F.lit(ms)))
    if start is not None:
        df = df.where(F.col("event_date") >= day(start))
    return df if end is None else df.where(F.col("event_date") <= day(end))


def within(df: DataFrame, window: Window) -> DataFrame:
    return _days(df, window.start, window.end).where(in_window(window))


def since(df: DataFrame, start: int) -> DataFrame:
    return _days(df, start, None).where(F.col(T) >= start)


def up_to(df: DataFrame, end: int) -> DataFrame:
    return _days(df, None, end).where(F.col(T) <= end)


def event_is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def event_in(event_types: Sequence[str]) -> Column:
    return F.col("event_type").isin(*event_types)


def event_prefix(prefix: str) -> Column:
    return F.col("event_type").startswith(prefix)


def event_contains(part: str) -> Column:
    return F.col("event_type").contains(part)


def source_is(source: str) -> Column:
    return F.col("source_of_event") == source


def transaction_is(kind: str) -> Column:
    return F.col("transaction_type") == kind


def amount_above(whole_currency: int) -> Column:
    return F.col("amount") > whole_currency * C.UNITS_PER_CURRENCY[C.HUNDREDTH_CENT]


def after_cutoff(cutoff: Column, t: str = T) -> Column:
    """Strictly after the last flag; a user never flagged has no cut-off."""
    return F.col(t) > F.coalesce(cutoff, F.lit(C.NEVER_FLAGGED))


def older_than(t: Column, now_ms: int, days: int) -> Column:
    return t < now_ms - days * C.DAY_MS


def has_save_requirement() -> Column:
    return F.col("save_type").isNotNull()


def top_users(rows: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` users with the most rows; equal counts are decided by user id."""
    counts = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return counts.orderBy(F.desc("events"), "user_id").limit(n)


def drop_top_users(rows: DataFrame, n: int = 2) -> DataFrame:
    """Without the ``n`` busiest users, who are the team's own test accounts."""
    return rows.join(F.broadcast(top_users(rows, n).select("user_id")), "user_id", "left_anti")


def flags_for(flags: DataFrame, user_id: str, account_id: str) -> DataFrame:
    return flags.where((F.col("user_id") == user_id) & (F.col("account_id") == account_id))
