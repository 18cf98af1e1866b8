"""Dates to epoch-millisecond bounds. Every report takes an explicit ``as_of`` date, in UTC."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from pennyflow.constants import DAY_MS, SECOND_MS


def as_date(day: date | str) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def day_start(day: date | str) -> int:
    midnight = datetime.combine(as_date(day), datetime.min.time(), tzinfo=timezone.utc)
    return int(midnight.timestamp()) * SECOND_MS


def day_end(day: date | str) -> int:
    """Days close at 23:59:59.000: the last 999 ms of a day belong to no day."""
    return day_start(day) + DAY_MS - SECOND_MS


def days_before(day: date | str, n: int) -> date:
    return as_date(day) - timedelta(days=n)


def months_before(day: date | str, n: int) -> date:
    """A month is 365/12 days and the half day is dropped: six months are 182 days."""
    return as_date(day) - timedelta(days=int(n * 365 / 12))


@dataclass(frozen=True)
class Window:
    """Inclusive range of epoch milliseconds."""

    start: int
    end: int

    @classmethod
    def of_day(cls, day: date | str) -> "Window":
        return cls(day_start(day), day_end(day))

    @classmethod
    def of_days(cls, first: date | str, last: date | str) -> "Window":
        return cls(day_start(first), day_end(last))

    def holds(self, t: Column) -> Column:
        return t.between(F.lit(self.start), F.lit(self.end))
