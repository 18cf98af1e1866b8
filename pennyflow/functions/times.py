"""Time expressions over epoch milliseconds (UTC)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pennyflow.constants import DAY_MS, HOUR_MS


def hours_between(later: Column, earlier: Column) -> Column:
    """Whole hours, cut toward zero: anything within an hour of each other is 0."""
    return ((later - earlier) / HOUR_MS).cast("long")


def days_between(later: Column, earlier: Column) -> Column:
    return ((later - earlier) / DAY_MS).cast("long")


def instant(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def calendar_fields(ms: Column) -> dict[str, Column]:
    at = instant(ms)
    return {
        "day_of_month": F.dayofmonth(at),
        "hour_of_day": F.hour(at),
        "day_of_week": F.weekday(at),  # Monday is 0
    }


def day_number(ms: Column) -> Column:
    return F.floor(ms / DAY_MS)


def month_start(ms: Column) -> Column:
    """First day of the month as text, yyyy-MM-dd."""
    return F.date_format(F.date_trunc("month", instant(ms)), "yyyy-MM-dd")


def parse_client_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with an optional fraction, to whole milliseconds; null if malformed."""
    at = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]"))
    return F.unix_millis(at)
