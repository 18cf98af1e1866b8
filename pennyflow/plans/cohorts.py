"""Cohort and conversion analysis. Times are epoch milliseconds, months yyyy-MM-dd text.

Joins to a one-row-per-user table are plain where no aggregation by user follows: adaptive execution
then splits a large user's partition by itself. Where one follows it may not, as the aggregation
relies on the partitions, and ``lookup_join`` is used.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.functions.money import whole_currency
from pennyflow.functions.times import days_between, instant, month_start
from pennyflow.operators.columns import describe_whole_numbers
from pennyflow.operators.filters import event_is, event_prefix, older_than, transaction_is
from pennyflow.operators.skew import lookup_join
from pennyflow.operators.timeline import Look, look_around
from pennyflow.timebox import day_start

USER, T = "user_id", "time_transaction_occurred"


def _savings(behaviour: DataFrame) -> DataFrame:
    return behaviour.where(transaction_is(C.SAVING))


def _times_of(events: DataFrame, event_type: str, name: str, t: str = T) -> DataFrame:
    return events.where(event_is(event_type)).select(USER, F.col(t).alias(name))


# --- per user ----------------------------------------------------------------------------


def last_save_per_user(behaviour: DataFrame) -> DataFrame:
    return _savings(behaviour).groupBy(USER).agg(F.max(T).alias("save_time"))


def user_first_seen_total(behaviour: DataFrame) -> DataFrame:
    return behaviour.groupBy(USER).agg(
        F.min(T).alias("first_seen"), F.sum("amount").alias("total_amount")
    )


def monthly_save_totals(behaviour: DataFrame) -> DataFrame:
    """By month of the year: the same month of different years falls together."""
    month = F.month(instant(F.col(T))).alias("save_month")
    return (
        _savings(behaviour)
        .groupBy(month, "unit")
        .agg(
            F.sum("amount").alias("sum_amount"),
            F.avg("amount").alias("avg_amount"),
            F.count(F.lit(1)).alias("saves"),
        )
        .orderBy(F.desc("save_month"), "unit")
    )


def never_redeemed_boosts(events: DataFrame) -> DataFrame:
    """Offers made to users that never redeemed any."""
    redeemed = events.where(event_is(C.BOOST_REDEEMED)).select(USER).distinct()
    offers = events.where(event_prefix(C.BOOST_CREATED)).select(
        USER, "event_type", "context", F.col("created_at").alias("boost_creation_time")
    )
    return offers.join(redeemed, USER, "left_anti")


# --- saving after a withdrawal -----------------------------------------------------------


def _withdrawals_and_savings(events: DataFrame, behaviour: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("long")
    w = _times_of(events, C.WITHDRAWAL_SETTLED, "t").withColumn("save_time", nothing)
    s = _savings(behaviour).select(USER, F.col(T).alias("t"), F.col(T).alias("save_time"))
    return w.unionByName(s)


def withdraw_then_save(events: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Per withdrawal time: the next save and how many saves followed."""
    save = F.col("save_time")
    seen = look_around(
        _withdrawals_and_savings(events, behaviour),
        [USER],
        "t",
        [Look("next_save", "min", save, "after"), Look("later_saves", "count", save, "after")],
        save.isNull(),
    )
    return (
        seen.where(F.col("next_save").isNotNull())
        .groupBy(USER, F.col("t").alias("withdrawal_time"))
        .agg(
            F.min("next_save").alias("next_save_time"),
            F.sum("later_saves").alias("subsequent_save_count"),
        )
    )


def returning_savers(events: DataFrame, behaviour: DataFrame) -> DataFrame:
    """How many users saved after a withdrawal: their last save is later than the first withdrawal."""
    first_last = (
        _withdrawals_and_savings(events, behaviour)
        .groupBy(USER)
        .agg(
            F.min(F.when(F.col("save_time").isNull(), F.col("t"))).alias("first_withdrawal"),
            F.max("save_time").alias("last_save"),
        )
    )
    return first_last.agg(F.count_if(F.col("last_save") > F.col("first_withdrawal")).alias("users"))


def open_to_withdrawal(events: DataFrame) -> DataFrame:
    """Days from each opening of an account to the user's first withdrawal."""
    first = _times_of(events, C.WITHDRAWAL_SETTLED, "w").groupBy(USER).agg(
        F.min("w").alias("first_withdraw_time")
    )
    opened = _times_of(events, C.ACCOUNT_CREATED, "account_open_time").distinct()
    days = days_between(F.col("first_withdraw_time"), F.col("account_open_time"))
    return opened.join(first, USER).withColumn("days_to_withdraw", days)


def days_to_withdraw_summary(events: DataFrame) -> DataFrame:
    return describe_whole_numbers(open_to_withdrawal(events), "days_to_withdraw")


# --- messages and offers that led to something -------------------------------------------


def message_app_open(events: DataFrame, as_of: date | str) -> DataFrame:
    """Per user and hour with a message: the first app opening, if it came within 48 hours.

    An hour followed only by later openings is left out; one never followed by any is kept.
    """
    sent = event_is(C.MESSAGE_SENT)
    hour = (F.floor(F.col(T) / C.HOUR_MS) * C.HOUR_MS).cast("long")
    rows = events.where(sent | event_is(C.APP_OPENED)).select(
        USER,
        F.when(sent, hour).otherwise(F.col(T)).alias("t"),
        F.when(~sent, F.col(T)).alias("open_time"),
    )
    opened = F.col("open_time")
    seen = look_around(
        rows, [USER], "t", [Look("earliest_app_open", "min", opened, "after")], opened.isNull()
    )
    hours = seen.select(USER, "t", "earliest_app_open").distinct()
    return _led_on(hours, "t", "earliest_app_open", as_of, 48).select(
        USER, F.col("t").alias("message_hour"), "earliest_app_open"
    )


def boost_next_save(events: DataFrame, as_of: date | str) -> DataFrame:
    """Per user and offer time: the next save, if it came within 96 hours."""
    offer = event_prefix(C.BOOST_CREATED)
    rows = events.where(offer | event_is(C.SAVE_SUCCEEDED)).select(
        USER, F.col("created_at").alias("t"), F.when(~offer, F.col("created_at")).alias("save_time")
    )
    saved = F.col("save_time")
    seen = look_around(
        rows, [USER], "t", [Look("earliest_save_time", "min", saved, "after")], saved.isNull()
    )
    offers = seen.select(USER, "t", "earliest_save_time").distinct()
    return _led_on(offers, "t", "earliest_save_time", as_of, 96).select(
        USER, F.col("t").alias("boost_creation_time"), "earliest_save_time"
    )


def _led_on(seen: DataFrame, t: str, following: str, as_of: date | str, hours: int) -> DataFrame:
    old_enough = older_than(F.col(t), day_start(as_of), 2)
    soon = F.col(following) - F.col(t) < hours * C.HOUR_MS
    return seen.where(old_enough & (F.col(following).isNull() | soon))


def message_open_rate(events: DataFrame, as_of: date | str) -> DataFrame:
    return _monthly_rate(
        message_app_open(events, as_of), "message_hour", "earliest_app_open", ("messages", "opens", "open_rate")
    )


def boost_induce_rate(events: DataFrame, as_of: date | str) -> DataFrame:
    return _monthly_rate(
        boost_next_save(events, as_of), "boost_creation_time", "earliest_save_time", ("offers", "induced", "induce_rate")
    )


def _monthly_rate(df: DataFrame, t: str, following: str, names: tuple[str, str, str]) -> DataFrame:
    rows, led, rate = names
    counts = df.groupBy(month_start(F.col(t)).alias("month")).agg(
        F.count(F.lit(1)).alias(rows), F.count(following).alias(led)
    )
    return _every_month(counts, "month", {rows: 0, led: 0}).withColumn(
        rate, F.try_divide(F.col(led), F.col(rows))
    )


def _every_month(df: DataFrame, month: str, fill: dict[str, int]) -> DataFrame:
    """Add the months without rows between the first and the last month.

    ``df`` has one row per month, so one task can put them in order; each month is followed by the
    empty ones up to the next.
    """
    this = F.to_date(month)
    following = F.lead(this).over(Window.orderBy(month))
    last = F.coalesce(F.add_months(following, -1), this)
    months = F.sequence(this, last, F.expr("interval 1 month"))
    others = [c for c in df.columns if c != month]
    filled = df.withColumn("_months", months).select("*", F.posexplode("_months").alias("_i", "_m"))
    return filled.select(
        F.date_format("_m", "yyyy-MM-dd").alias(month),
        *[F.when(F.col("_i") == 0, F.col(c)).otherwise(fill.get(c)).alias(c) for c in others],
    )


def boost_monthly_stats(events: DataFrame, as_of: date | str) -> DataFrame:
    """By month of the year. The rate is induced offers per distinct user, as published."""
    month = F.month(instant(F.col("boost_creation_time"))).alias("month")
    per_user = (
        boost_next_save(events, as_of)
        .groupBy(month, USER)
        .agg(F.count(F.lit(1)).alias("o"), F.count("earliest_save_time").alias("i"))
    )
    stats = per_user.groupBy("month").agg(
        F.sum("o").alias("offers"), F.sum("i").alias("induced"), F.count(F.lit(1)).alias("unique_users")
    )
    return stats.withColumns(
        {
            "boost_per_user": F.col("offers") / F.col("unique_users"),
            "induce_rate": F.col("induced") / F.col("unique_users"),
        }
    )


# --- cohorts -----------------------------------------------------------------------------


def cohort_savings(events: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Per account opening: what the user saved, in whole currency.

    Savings are summed up per user before they meet the openings. A user with several openings at
    one time has every saving counted once for each, as in a join of the rows.
    """
    saved = _savings(behaviour).groupBy(USER).agg(
        F.count(F.lit(1)).alias("n"), F.max("amount").alias("m"), F.sum("amount").alias("s")
    )
    opened = (
        _times_of(events, C.ACCOUNT_CREATED, "account_open_time")
        .groupBy(USER, "account_open_time")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return opened.join(saved, USER).select(
        USER,
        "account_open_time",
        (F.col("n") * F.col("times")).alias("count_save_events"),
        whole_currency(F.col("m")).alias("max_save"),
        whole_currency(F.col("s") * F.col("times")).alias("total_save"),
        (whole_currency(F.col("s")) / F.col("n")).alias("average_save"),
    )


def cohort_monthly(events: DataFrame, behaviour: DataFrame) -> DataFrame:
    """By month of opening, months without openings included: total and mean average save."""
    by_month = (
        cohort_savings(events, behaviour)
        .groupBy(month_start(F.col("account_open_time")).alias("cohort_month"))
        .agg(F.sum("total_save").alias("total_save"), F.avg("average_save").alias("average_save"))
    )
    return _every_month(by_month, "cohort_month", {"total_save": 0})


def saves_after_14_days(events: DataFrame, behaviour: DataFrame, as_of: date | str) -> DataFrame:
    """Per user whose first save is over 30 days old: number and mean of saves 15 days later or more."""
    first = (
        _times_of(events, C.SAVE_SUCCEEDED, "t")
        .groupBy(USER)
        .agg(F.min("t").alias("first_save_time"))
        .where(older_than(F.col("first_save_time"), day_start(as_of), 30))
    )
    savings = _savings(behaviour).select(USER, F.col(T).alias("t"), "amount")
    later = lookup_join(savings, first, [USER], "inner").where(
        days_between(F.col("t"), F.col("first_save_time")) > 14
    )
    return later.groupBy(USER, "first_save_time").agg(
        F.count(F.lit(1)).alias("later_saves"), whole_currency(F.avg("amount")).alias("average_save")
    )


def late_savers_by_cohort(events: DataFrame, behaviour: DataFrame, as_of: date | str) -> DataFrame:
    at = instant(F.col("first_save_time"))
    savers = saves_after_14_days(events, behaviour, as_of)
    return savers.groupBy(F.year(at).alias("year"), F.month(at).alias("month")).agg(
        F.count(F.lit(1)).alias("users"),
        F.avg("average_save").alias("average_save"),
        F.avg("later_saves").alias("later_saves"),
    )


# --- recency -----------------------------------------------------------------------------


def _days_since_save(behaviour: DataFrame, as_of: date | str) -> DataFrame:
    days = F.floor((F.lit(day_start(as_of)) - F.col("save_time")) / C.DAY_MS)
    return last_save_per_user(behaviour).select(days.alias("days"))


def _count_in(df: DataFrame, bucket: Column, labels: list[str], name: str) -> DataFrame:
    """Users per bucket in order, empty buckets included."""
    counts = df.select(bucket.alias("b")).agg(*[F.count_if(F.col("b") == i).alias(f"n{i}") for i in range(len(labels))])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(label).alias(name), F.col(f"n{i}").alias("users"))
        for i, label in enumerate(labels)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def recency_buckets(behaviour: DataFrame, as_of: date | str) -> DataFrame:
    """Users by days since their last save: (0,30], (30,60], (60,90], (90,120]."""
    ends = [0, 30, 60, 90, 120]
    d, bucket = F.col("days"), F.lit(None).cast("int")
    for i, (low, high) in enumerate(zip(ends, ends[1:])):
        bucket = F.when((d > low) & (d <= high), i).otherwise(bucket)
    labels = [f"({low},{high}]" for low, high in zip(ends, ends[1:])]
    return _count_in(_days_since_save(behaviour, as_of), bucket, labels, "bucket")


def recency_histogram(behaviour: DataFrame, as_of: date | str) -> DataFrame:
    """15-day bins from 0 to 120, closed on the left, the last one on both sides."""
    d = F.col("days")
    bucket = F.when((d >= 0) & (d <= 120), F.least(F.floor(d / 15), F.lit(7)))
    labels = [f"[{low},{low + 15}{']' if low == 105 else ')'}" for low in range(0, 120, 15)]
    return _count_in(_days_since_save(behaviour, as_of), bucket, labels, "bin")
