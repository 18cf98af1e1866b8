"""Daily figures. One-number reports return one row; ``daily_metrics`` returns the ordered list.

Questions about several events of the same user ("signed up, then saved") are answered by one
``groupBy(user_id)`` over truth values. It combines on the map side, needs no join and no list of
users, and holds however many events one user has.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.functions.money import money_text, whole_currency
from pennyflow.functions.times import day_number
from pennyflow.operators.columns import one_row_to_items
from pennyflow.operators.filters import (
    event_contains,
    event_is,
    in_window,
    source_is,
    transaction_is,
    up_to,
    within,
)
from pennyflow.timebox import Window, day_end, day_start, days_before

USER, T = "user_id", "time_transaction_occurred"
#: The longest piece by which ids are looked for in texts.
PIECE = 6


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def flags_per_user(events: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """One row per user and a truth value per question: did any of their events fulfil it."""
    any_of = None
    for condition in flags.values():
        any_of = condition if any_of is None else any_of | condition
    return (
        events.where(any_of)
        .groupBy(USER)
        .agg(*[F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
    )


# --- sums and distinct users -------------------------------------------------------------


def total_amount(behaviour: DataFrame, kind: str, window: Window) -> DataFrame:
    rows = within(behaviour, window).where(transaction_is(kind))
    return rows.agg(whole_currency(F.sum("amount")).alias("total_amount"))


def users_by_transaction(behaviour: DataFrame, kind: str, window: Window) -> DataFrame:
    rows = within(behaviour, window).where(transaction_is(kind))
    return rows.agg(F.count_distinct(USER).alias("users"))


def _by_event(events: DataFrame, event_type: str, window: Window, source: str) -> DataFrame:
    return within(events, window).where(event_is(event_type) & source_is(source))


def users_by_event(
    events: DataFrame, event_type: str, window: Window, source: str = C.APP_SOURCE
) -> DataFrame:
    return _by_event(events, event_type, window, source).agg(F.count_distinct(USER).alias("users"))


def user_ids_by_event(
    events: DataFrame, event_type: str, window: Window, source: str = C.APP_SOURCE
) -> DataFrame:
    return _by_event(events, event_type, window, source).select(USER).distinct()


def total_users(events: DataFrame, until_ms: int) -> DataFrame:
    rows = up_to(events, until_ms).where(source_is(C.SERVICE_SOURCE))
    return rows.agg(F.count_distinct(USER).alias("users"))


def users_in_list_that_did(
    users: DataFrame,
    events: DataFrame,
    event_type: str,
    window: Window,
    source: str = C.APP_SOURCE,
) -> DataFrame:
    did = user_ids_by_event(events, event_type, window, source)
    listed = users.select(USER).distinct()
    return did.join(listed, USER, "left_semi").agg(F.count(F.lit(1)).alias("users"))


def new_users_that_saved(
    events: DataFrame, window: Window, next_event: str = C.APP_OPENED
) -> DataFrame:
    """New users of the window that then did ``next_event``; the published default is the app
    being opened, pass the saving event to count savers."""
    flags = {
        "joined": event_is(C.ACCOUNT_CREATED) & source_is(C.SERVICE_SOURCE),
        "did": event_is(next_event) & source_is(C.APP_SOURCE),
    }
    users = flags_per_user(within(events, window), flags)
    return users.agg(F.count_if(F.col("joined") & F.col("did")).alias("users"))


def saved_vs_tried_ratio(events: DataFrame, behaviour: DataFrame, window: Window) -> DataFrame:
    """Users that saved over users that started to; 0 when nobody started."""
    saved = within(behaviour, window).where(transaction_is(C.SAVING)).select(USER, F.lit("saved").alias("what"))
    tried = _by_event(events, C.ADD_CASH_STARTED, window, C.APP_SOURCE).select(
        USER, F.lit("tried").alias("what")
    )
    users = saved.unionByName(tried).distinct()
    return users.agg(
        ratio(
            F.count_if(F.col("what") == "saved"), F.count_if(F.col("what") == "tried")
        ).alias("ratio")
    )


def users_that_tried_saving(events: DataFrame, window: Window) -> DataFrame:
    return users_by_event(events, C.ADD_CASH_STARTED, window)


def pct_not_returned(
    events: DataFrame,
    as_of: date | str,
    n: int = 3,
    start_event: str = C.ACCOUNT_CREATED,
    next_event: str = C.APP_OPENED,
) -> DataFrame:
    """Of the users with ``start_event`` n days ago, the percentage without ``next_event`` since."""
    began = Window.of_day(days_before(as_of, n))
    since = Window.of_days(days_before(as_of, n - 1), as_of)
    flags = {
        "began": event_is(start_event) & source_is(C.SERVICE_SOURCE) & in_window(began),
        "returned": event_is(next_event) & source_is(C.APP_SOURCE) & in_window(since),
    }
    users = flags_per_user(within(events, Window(began.start, since.end)), flags)
    gone = F.count_if(F.col("began") & ~F.col("returned"))
    return users.agg((ratio(gone, F.count_if("began")) * 100).alias("percent"))


# --- daily averages ----------------------------------------------------------------------


def _mean_of_days(rows: DataFrame, as_of: date | str, n: int) -> DataFrame:
    """Mean over the n days before ``as_of`` of the day's distinct users; empty days count as 0."""
    whole = Window.of_days(days_before(as_of, n), days_before(as_of, 1))
    inside_a_day = F.pmod(F.col(T), F.lit(C.DAY_MS)) <= C.DAY_MS - C.SECOND_MS
    user_days = within(rows, whole).where(inside_a_day).select(day_number(F.col(T)).alias("day"), USER)
    return user_days.distinct().agg((F.count(F.lit(1)) / F.lit(float(n))).alias("daily_average"))


def daily_avg_users_by_event(
    events: DataFrame, event_type: str, as_of: date | str, n: int, source: str = C.APP_SOURCE
) -> DataFrame:
    return _mean_of_days(events.where(event_is(event_type) & source_is(source)), as_of, n)


def daily_avg_users_by_transaction(
    behaviour: DataFrame, kind: str, as_of: date | str, n: int
) -> DataFrame:
    return _mean_of_days(behaviour.where(transaction_is(kind)), as_of, n)


def avg_signups(events: DataFrame, window: Window, n: int) -> DataFrame:
    joined = _by_event(events, C.ACCOUNT_CREATED, window, C.SERVICE_SOURCE)
    return joined.agg((F.count_distinct(USER) / F.lit(float(n))).alias("daily_average"))


# --- events by context -------------------------------------------------------------------


def users_with_context_value(
    events: DataFrame,
    event_like: str,
    context_like: str,
    window: Window,
    source: str = C.SERVICE_SOURCE,
) -> DataFrame:
    rows = within(events, window).where(
        source_is(source) & F.col("event_type").like(event_like) & F.col("context").like(context_like)
    )
    return rows.agg(F.count_distinct(USER).alias("users"))


def context_values(events: DataFrame, key: str) -> DataFrame:
    return events.select(USER, F.get_json_object("context", f"$.{key}").alias("value"))


def expired_on(events: DataFrame, as_of: date | str) -> DataFrame:
    return _by_event(events, C.BOOST_EXPIRED, Window.of_day(as_of), C.SERVICE_SOURCE)


def _pieces(df: DataFrame, text: str, size: Column, *kept: Column | str) -> DataFrame:
    """Each row once for every distinct piece of `size` characters of its text."""
    sized = df.withColumn("size", size).where(F.length(text) >= F.col("size"))
    starts = F.sequence(F.lit(1), F.length(text) - F.col("size") + 1)
    pieces = F.array_distinct(F.transform(starts, lambda p: F.substring(F.col(text), p, F.col("size"))))
    return sized.select(*kept, F.explode(pieces).alias("piece"))


def ids_in_texts(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(context, boost_id): which distinct texts hold which ids, anywhere.

    Pieces have one length, that of the shortest id, `PIECE` at most. An id is indexed by the one of its
    pieces that the fewest ids have, so a text gives one row per character, however many lengths the ids
    have, and meets an id only where that piece stands; the id is then looked for whole.
    """
    ids = ids.where(F.length("boost_id") > 0).distinct()
    size = ids.agg(F.least(F.min(F.length("boost_id")), F.lit(PIECE))).scalar()
    own = _pieces(ids, "boost_id", size, "boost_id")
    rarity = own.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    index = own.join(rarity, "piece").groupBy("boost_id").agg(F.min(F.struct("n", "piece"))["piece"].alias("piece"))
    # The pieces carry the text's hash; the text itself comes back where a piece was met.
    distinct = texts.where(F.col("context").isNotNull()).distinct().withColumn("text", F.xxhash64("context"))
    met = _pieces(distinct, "context", size, "text").join(index, "piece").select("text", "boost_id").distinct()
    return distinct.join(met, "text").where(F.contains("context", "boost_id")).select("context", "boost_id")


def users_offered_boosts(
    events: DataFrame, ids: DataFrame, as_of: date | str, match: str = "literal"
) -> DataFrame:
    """(boost_id, times, users): for every id, how often ``ids`` lists it and how many users had an
    expired offer with it up to ``as_of``.

    ``literal`` finds the id anywhere in the context text, so ``b1`` also counts ``b12``; ``key``
    compares the offer's own id. Ids are looked for in distinct texts (`ids_in_texts`), and the users
    come to the texts that hold an id. Users are made distinct per id by id and user, so an offer made
    to everybody is spread over all tasks.
    """
    listed = ids.where(F.col("boost_id").isNotNull()).groupBy("boost_id")
    listed = listed.agg(F.count(F.lit(1)).alias("times"))
    expired = within(events, Window(C.NEVER_FLAGGED, day_end(as_of))).where(
        source_is(C.SERVICE_SOURCE) & event_contains(C.BOOST_EXPIRED)
    )
    if match == "key":
        found = expired.select(USER, F.get_json_object("context", "$.boostId").alias("boost_id"))
    elif match == "literal":
        holding = ids_in_texts(expired.select("context"), listed.select("boost_id"))
        found = expired.select(USER, "context").join(holding, "context").select(USER, "boost_id")
    else:
        raise ValueError(f"match must be 'literal' or 'key', not {match!r}")
    users = found.distinct().groupBy("boost_id").agg(F.count(F.lit(1)).alias("users"))
    return listed.join(users, "boost_id", "left").select(
        "boost_id", "times", F.coalesce("users", F.lit(0)).cast("long").alias("users")
    )


def pct_boosts_expired(events: DataFrame, as_of: date | str, match: str = "literal") -> DataFrame:
    """Offers that expired on the day, per 100 users that were offered one of them.

    An id that expired for two users counts its offered users twice.
    """
    today = expired_on(events, as_of).select(F.get_json_object("context", "$.boostId").alias("boost_id"))
    offered = users_offered_boosts(events, today, as_of, match).agg(
        F.sum(F.col("times") * F.col("users")).alias("n"), F.lit(0).cast("long").alias("expired")
    )
    expired = today.agg(F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("expired"))
    both = expired.unionByName(offered)
    return both.agg((ratio(F.sum("expired"), F.sum("n")) * 100).alias("percent"))


# --- the daily list ----------------------------------------------------------------------


def compare_withdrew_saved(behaviour: DataFrame, window: Window) -> DataFrame:
    users = flags_per_user(
        within(behaviour, window),
        {"withdrew": transaction_is(C.WITHDRAWAL), "saved": transaction_is(C.SAVING)},
    )
    counts = users.agg(F.count_if("withdrew").alias("w"), F.count_if("saved").alias("s"))
    sentence = lambda word: f"Number of Users that Withdrew {word} Number of Users that Saved"
    return counts.select(
        F.when(F.col("w") > F.col("s"), sentence("GREATER THAN"))
        .when(F.col("w") < F.col("s"), sentence("LESS THAN"))
        .otherwise(sentence("EQUAL"))
        .alias("comparison")
    )


def users_entered(events: DataFrame, as_of: date | str) -> DataFrame:
    """Users that reached the intro screen yesterday; worked out daily but not on the list."""
    return users_by_event(events, C.INTRO_ENTERED, Window.of_day(days_before(as_of, 1)))


def daily_metrics(
    events: DataFrame, behaviour: DataFrame, as_of: date | str, match: str = "literal"
) -> DataFrame:
    """The eleven figures of the daily report: (position, metric_name, metric_value, display)."""
    yesterday = Window.of_day(days_before(as_of, 1))
    to_today = Window(yesterday.start, day_start(as_of))
    week = Window(day_start(days_before(as_of, 7)), yesterday.end)
    service, app = source_is(C.SERVICE_SOURCE), source_is(C.APP_SOURCE)
    created, saved = event_is(C.ACCOUNT_CREATED), event_is(C.SAVE_SUCCEEDED)
    users = flags_per_user(
        up_to(events, day_start(as_of)),
        {
            "known": service & (F.col(T) <= day_start(as_of)),
            "saved_y": saved & service & in_window(yesterday),
            "joined_y": created & service & in_window(yesterday),
            "saved_in_app": saved & app & in_window(to_today),
            "joined_w": created & service & in_window(week),
            "saved_w": saved & service & in_window(week),
            "messaged": event_is(C.MESSAGE_SENT) & service & in_window(to_today),
            "opened": event_is(C.APP_OPENED) & app & in_window(to_today),
        },
    )
    both = lambda a, b: F.count_if(F.col(a) & F.col(b))
    counts = users.agg(
        *[F.count_if(c).alias(c) for c in ("known", "saved_y", "joined_y", "joined_w", "messaged")],
        both("joined_y", "saved_in_app").alias("joined_and_saved"),
        both("joined_w", "saved_w").alias("joined_w_and_saved"),
        both("messaged", "opened").alias("messaged_and_opened"),
    )
    c = F.col
    plain = lambda name: (c(name), c(name).cast("string"))
    completed = F.bround(ratio(c("joined_w_and_saved"), c("joined_w")) * 100, 2)
    opened = F.bround(ratio(c("messaged_and_opened"), c("messaged")) * 100)
    from_events = one_row_to_items(
        counts,
        [
            (1, "Total users @ start of day", *plain("known")),
            (3, "How many saved yesterday", *plain("saved_y")),
            (4, "Number users opened account yesterday", *plain("joined_y")),
            (5, "Number of those who saved", *plain("joined_and_saved")),
            (6, "Number opened account in last week", *plain("joined_w")),
            (7, "% who completed save", completed, F.format_string("%.2f", completed)),
            (8, "Number users sent msg yesterday", *plain("messaged")),
            (9, "Number of those who opened app", *plain("messaged_and_opened")),
            (10, "% of messages led to open", opened, F.format_string("%d%%", opened.cast("long"))),
        ],
    )
    amount = within(behaviour, yesterday).where(transaction_is(C.SAVING)).agg(F.sum("amount").alias("a"))
    from_payments = one_row_to_items(
        amount,
        [(2, "Total amount saved yesterday", whole_currency(c("a")), money_text(c("a")))],
    )
    percent = F.round(c("percent"), 6)
    from_offers = one_row_to_items(
        pct_boosts_expired(events, as_of, match),
        [(11, "% whose boosts expired", percent, F.format_string("%.6f", percent))],
    )
    return from_events.unionByName(from_payments).unionByName(from_offers).orderBy("position")
