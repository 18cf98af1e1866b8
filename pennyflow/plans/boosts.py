"""Features and labels for deciding which users get an offer ("boost").

An offer looks back and ahead along its user's timeline (see ``operators.timeline``); no offer is
joined to the user's saves.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.functions.offers import days_open, offer_fields, one_hot, parse_offer, save_requirement
from pennyflow.functions.times import calendar_fields, hours_between
from pennyflow.operators.filters import (
    drop_top_users,
    event_is,
    event_prefix,
    has_save_requirement,
    transaction_is,
)
from pennyflow.operators.timeline import Look, look_around
from pennyflow.plans.cohorts import withdraw_then_save
from pennyflow.timebox import as_date, day_start

USER, T = "user_id", "time_transaction_occurred"
# At least a full hour apart. Closer events count neither as earlier nor as later, because hour
# differences are cut toward zero.
AN_HOUR = C.HOUR_MS - 1


def _offers() -> Column:
    return event_prefix(C.BOOST_CREATED)


def _saves() -> Column:
    return event_is(C.SAVE_SUCCEEDED)


def boost_fields(events: DataFrame) -> DataFrame:
    """Every offer with the fields of its context."""
    offer = parse_offer(F.col("context"))
    return (
        events.where(_offers())
        .select(USER, T, offer.alias("offer"))
        .select(USER, T, *[c.alias(n) for n, c in offer_fields(F.col("offer")).items()], days_open(F.col("offer")).alias("days_open"))
    )


def save_requirements(events: DataFrame) -> DataFrame:
    return (
        events.where(_offers())
        .select(USER, T, parse_offer(F.col("context")).alias("offer"))
        .select(USER, T, *[c.alias(n) for n, c in save_requirement(F.col("offer")).items()])
    )


def boosts_with_saves(events: DataFrame) -> DataFrame:
    """Every offer with the number of saves before it and whether one followed within 48 hours."""
    save_time = F.when(_saves(), F.col(T))
    rows = events.where(_offers() | _saves()).select(USER, T, "event_type", "context")
    looks = [
        Look("prior_save_count", "count", save_time, "before"),
        Look("next_save", "min", save_time, "after"),
    ]
    seen = look_around(rows, [USER], T, looks, _offers())
    soon = F.col("next_save") - F.col(T) < 48 * C.HOUR_MS
    return seen.withColumn("save_within_48", F.coalesce(soon, F.lit(False)))


def boost_dataset(events: DataFrame, top_users: int = 2) -> DataFrame:
    """The ten columns of the offer data set; only offers that ask for a save."""
    rows = events.where(_offers() | _saves()).select(USER, T, "event_type", "context")
    seen = boosts_with_saves(drop_top_users(rows, top_users)).withColumn(
        "offer", parse_offer(F.col("context"))
    )
    fields, required = offer_fields(F.col("offer")), save_requirement(F.col("offer"))
    calendar = calendar_fields(F.col(T))
    return (
        seen.select(
            fields["boost_type"].alias("boost_type"),
            fields["boost_category"].alias("boost_category"),
            *[c.alias(n) for n, c in required.items()],
            fields["boost_amount"].alias("boost_amount"),
            calendar["day_of_month"].alias("day_of_month"),
            calendar["day_of_week"].alias("day_of_week"),
            "prior_save_count",
            "save_within_48",
        )
        .where(has_save_requirement())
        .withColumn("boost_save_ratio", F.try_divide("save_amount", "boost_amount"))
    )


# --- training set ------------------------------------------------------------------------


def busiest_pair_users(events: DataFrame, n: int = 2) -> DataFrame:
    """The users with the most (offer, save) combinations, counted without forming them."""
    counts = (
        events.where(_offers() | _saves())
        .groupBy(USER)
        .agg(F.count_if(_offers()).alias("o"), F.count_if(_saves()).alias("s"))
    )
    pairs = (F.col("o") * F.greatest(F.col("s"), F.lit(1))).alias("pairs")
    return counts.where("o > 0").select(USER, pairs).orderBy(F.desc("pairs"), USER).limit(n)


def boost_training_set(
    events: DataFrame,
    behaviour: DataFrame | None = None,
    top_users: int = 2,
) -> DataFrame:
    """One row per user and offer id that has both an earlier and a later save.

    An id offered to a user several times forms one row: the save that follows soonest decides the
    label and the offer's fields. Users whose only redemptions came later are left out. With
    ``behaviour`` two columns about saving after a withdrawal are added.
    """
    redeemed = event_is(C.BOOST_REDEEMED)
    created = F.col("created_at")
    chosen = events.where(_offers() | _saves() | redeemed)
    if top_users:
        busiest = busiest_pair_users(events, top_users).select(USER)
        chosen = chosen.join(F.broadcast(busiest), USER, "left_anti")
    rows = chosen.select(USER, "event_type", F.when(_offers(), F.col("context")).alias("context"), created.alias("t"))
    save_time, redeem_time = F.when(_saves(), F.col("t")), F.when(redeemed, F.col("t"))
    looks = [
        Look("prior_saves", "count", save_time, "before", -AN_HOUR),
        Look("latest_save", "max", save_time, "before", -AN_HOUR),
        Look("first_save", "min", save_time, "before", -AN_HOUR),
        Look("next_save", "min", save_time, "after", AN_HOUR),
        Look("prior_redeems", "count", redeem_time, "before", -AN_HOUR),
        Look("other_redeems", "count", redeem_time, "after", -C.HOUR_MS),
    ]
    seen = look_around(rows, [USER], "t", looks, _offers())
    fields = offer_fields(F.col("offer"))
    offers = seen.withColumn("offer", parse_offer(F.col("context"))).select(
        USER,
        "t",
        *[look.name for look in looks],
        *[fields[n].alias(n) for n in ("boost_id", "boost_amount", "boost_type_category")],
    )

    # a pair of a save and one of the offers with this id; equal saves are decided by the offer time
    pair = lambda save: F.when(
        F.col(save).isNotNull(),
        F.struct(F.col(save).alias("save"), F.col("t"), "boost_amount", "boost_type_category"),
    )
    grouped = offers.groupBy(USER, "boost_id").agg(
        F.sum("prior_saves").alias("boost_prior_saves"),
        F.max(pair("latest_save")).alias("latest"),
        F.min(pair("first_save")).alias("first"),
        F.min(pair("next_save")).alias("next"),
        F.bool_or(F.col("prior_redeems") > 0).alias("has_prior_redeemed"),
        F.bool_or(F.col("prior_redeems") + F.col("other_redeems") == 0).alias("never_redeemed"),
    )
    complete = grouped.where(
        F.col("latest").isNotNull()
        & F.col("next").isNotNull()
        & (F.col("has_prior_redeemed") | F.col("never_redeemed"))
    )
    days = lambda p: F.abs(hours_between(F.col(f"{p}.save"), F.col(f"{p}.t"))) / F.lit(24.0)
    calendar = calendar_fields(F.col("next.t"))
    result = complete.select(
        USER,
        "boost_id",
        F.col("next.boost_amount").alias("boost_amount_whole_currency"),
        calendar["day_of_month"].alias("day_of_month"),
        "boost_prior_saves",
        F.col("next.boost_type_category").alias("boost_type_category"),
        days("latest").alias("days_since_latest_save"),
        "has_prior_redeemed",
        days("first").alias("days_since_first_save"),
        calendar["day_of_week"].alias("day_of_week"),
        (hours_between(F.col("next.save"), F.col("next.t")) < 24).alias("is_save_within_day"),
    )
    if behaviour is None:
        return result
    after = withdraw_then_save(events, behaviour).groupBy(USER).agg(
        F.sum("subsequent_save_count").alias("saves_after_withdraw")
    )
    # no aggregation relies on this join's partitions, so adaptive execution may split a large user
    return result.join(after, USER, "left").withColumn(
        "has_withdrawn_and_saved", F.coalesce(F.col("saves_after_withdraw") > 0, F.lit(False))
    )


def boost_future_saves(events: DataFrame) -> DataFrame:
    """Every offer with the next save at least an hour later; offers to users that only saved
    earlier are left out, offers to users that never saved are kept with a null."""
    save_time = F.when(_saves(), F.col("created_at"))
    rows = events.where(_offers() | _saves()).select(USER, "event_type", "created_at")
    looks = [
        Look("next_save", "min", save_time, "after", AN_HOUR),
        Look("saves_before", "count", save_time, "before", C.HOUR_MS),
    ]
    seen = look_around(rows, [USER], "created_at", looks, _offers())
    kept = seen.where(F.col("next_save").isNotNull() | (F.col("saves_before") == 0))
    hours = hours_between(F.col("next_save"), F.col("created_at"))
    return kept.select(
        USER,
        F.col("created_at").alias("boost_creation_time"),
        "next_save",
        F.coalesce(hours < 24, F.lit(False)).alias("is_save_within_day"),
    )


def boost_prior_redemptions(events: DataFrame) -> DataFrame:
    """Every offer with its number of earlier redemptions; offers to users that only redeemed
    later are left out."""
    redeemed = event_is(C.BOOST_REDEEMED)
    at = F.when(redeemed, F.col("created_at"))
    rows = events.where(_offers() | redeemed).select(USER, "event_type", "created_at")
    looks = [
        Look("prior_redemptions", "count", at, "before", -AN_HOUR),
        Look("other_redemptions", "count", at, "after", -C.HOUR_MS),
    ]
    seen = look_around(rows, [USER], "created_at", looks, _offers())
    kept = seen.where((F.col("prior_redemptions") > 0) | (F.col("other_redemptions") == 0))
    return kept.select(
        USER,
        F.col("created_at").alias("boost_creation_time"),
        "prior_redemptions",
        (F.col("prior_redemptions") > 0).alias("has_prior_redeemed"),
    )


# --- scoring input -----------------------------------------------------------------------


def user_save_stats(behaviour: DataFrame, as_of: date | str, users: DataFrame | None = None) -> DataFrame:
    rows = behaviour.where(transaction_is(C.SAVING))
    stats = rows.groupBy(USER).agg(
        F.count(F.lit(1)).alias("prior_save_count"),
        F.max(T).alias("latest_save"),
        F.min(T).alias("earliest_save"),
    )
    if users is not None:
        stats = stats.join(users.select(USER).distinct(), USER, "left_semi")
    now = F.lit(day_start(as_of))
    return stats.withColumns(
        {
            "hours_since_latest": hours_between(now, F.col("latest_save")),
            "hours_since_earliest": hours_between(now, F.col("earliest_save")),
        }
    )


def redeem_counts(events: DataFrame, users: DataFrame | None = None) -> DataFrame:
    counts = events.where(event_is(C.BOOST_REDEEMED)).groupBy(USER).agg(
        F.count(F.lit(1)).alias("number_boost_redeems")
    )
    return counts if users is None else counts.join(users.select(USER).distinct(), USER, "left_semi")


def score_input(
    events: DataFrame,
    behaviour: DataFrame,
    users: DataFrame,
    as_of: date | str,
    boost_amount: float,
    boost_type_category: str,
) -> DataFrame:
    """The model's columns for each candidate that has saved before."""
    day = as_date(as_of)
    stats = user_save_stats(behaviour, as_of, users)
    redeems = redeem_counts(events)
    joined = stats.join(redeems, USER, "left")
    return joined.select(
        USER,
        F.lit(float(boost_amount)).alias("boost_amount_whole_currency"),
        (F.col("hours_since_latest") / F.lit(24.0)).alias("days_since_latest_save"),
        (F.col("hours_since_earliest") / F.lit(24.0)).alias("days_since_first_save"),
        F.col("prior_save_count").alias("boost_prior_saves"),
        (F.coalesce("number_boost_redeems", F.lit(0)) > 0).alias("has_prior_redeemed"),
        F.lit(day.weekday()).alias("day_of_week"),
        F.lit(day.day).alias("day_of_month"),
        F.lit(boost_type_category).alias("boost_type_category"),
        *[c.alias(n) for n, c in one_hot(F.lit(boost_type_category)).items()],
    )
