"""The registered queries: every report on the mapped test tables with fixed parameters.

Each entry takes (spark, folder) and returns a DataFrame over the folder's whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow import schemas as S
from pennyflow.functions.plans import once
from pennyflow.functions.signature import signature_holds
from pennyflow.operators import columns, filters, ingest
from pennyflow.plans import bayes, boosts, cohorts, fraud, funnel, metrics, ml
from pennyflow.sources import mapped, round_trips
from pennyflow.streaming import runs
from pennyflow.timebox import Window, day_start, days_before

Query = Callable[[SparkSession, str], DataFrame]

METRICS_AS_OF, FUNNEL_AS_OF, FRAUD_AS_OF, COHORT_AS_OF = "2024-01-20", "2024-01-05", "2024-01-30", "2024-03-01"
YESTERDAY = Window.of_day("2024-01-19")
LAST_WEEK = Window.of_days("2024-01-13", "2024-01-19")
SIGNUP_TO_SAVE = funnel.Step(C.ACCOUNT_CREATED, (C.SAVE_SUCCEEDED,))
CHAIN = funnel.Step.pairs(
    [
        (C.ACCOUNT_CREATED, C.APP_OPENED),
        (C.APP_OPENED, C.ADD_CASH_STARTED),
        (C.ADD_CASH_STARTED, C.SAVE_SUCCEEDED),
    ]
)
NOW_MS = day_start(FRAUD_AS_OF)

QUERIES: dict[str, Query] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Doubles at six decimals, so that the order of additions does not show."""
    return df.select(
        *[
            F.round(F.col(f"`{name}`"), 6).alias(name) if kind == "double" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def register(name: str, query: Query) -> None:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return tidy(query(spark, folder))

    QUERIES[name] = run


def on_events(name: str, report: Callable[[DataFrame], DataFrame]) -> None:
    register(name, lambda spark, d: report(mapped.event_log(spark, d)))


def on_payments(name: str, report: Callable[[DataFrame], DataFrame]) -> None:
    register(name, lambda spark, d: report(mapped.behaviour(spark, d)))


def on_both(name: str, report: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    register(name, lambda spark, d: report(mapped.event_log(spark, d), mapped.behaviour(spark, d)))


def on_flags(name: str, report: Callable[[DataFrame], DataFrame]) -> None:
    register(name, lambda spark, d: report(mapped.flags(spark, d)))


# --- funnel ------------------------------------------------------------------------------
on_events(
    "drop_off_users",
    lambda ev: funnel.drop_off_users(ev, SIGNUP_TO_SAVE, Window.of_days("2024-01-01", "2024-01-04")),
)
for _mode in ("intent", "literal"):
    on_events(
        f"recovered_users_{_mode}",
        lambda ev, mode=_mode: funnel.recovered_users(ev, SIGNUP_TO_SAVE, FUNNEL_AS_OF, mode),
    )
on_events(
    "drop_off_counts",
    lambda ev: funnel.drop_off_counts(
        ev, CHAIN, funnel.default_window(FUNNEL_AS_OF), FUNNEL_AS_OF, recovery_mode="intent"
    ),
)
STAGES = funnel.Step.pairs((*C.SAVING_STAGES, *C.ONBOARDING_STAGES))
on_events("drop_off_by_stage", lambda ev: funnel.drop_off_by_stage(ev, STAGES, "2024-01-02"))
on_events("drop_off_daily_avg", lambda ev: funnel.drop_off_daily_avg(ev, CHAIN, FUNNEL_AS_OF, 3))

# --- metrics -----------------------------------------------------------------------------
on_payments("total_saved", lambda ub: metrics.total_amount(ub, C.SAVING, YESTERDAY))
on_payments("total_withdrawn", lambda ub: metrics.total_amount(ub, C.WITHDRAWAL, YESTERDAY))
on_payments("users_by_transaction", lambda ub: metrics.users_by_transaction(ub, C.SAVING, YESTERDAY))
on_events("users_by_event", lambda ev: metrics.users_by_event(ev, C.APP_OPENED, YESTERDAY))
on_events("total_users", lambda ev: metrics.total_users(ev, day_start(METRICS_AS_OF)))
on_events(
    "user_ids_by_event",
    lambda ev: metrics.user_ids_by_event(ev, C.ACCOUNT_CREATED, YESTERDAY, C.SERVICE_SOURCE),
)
on_events(
    "users_in_list_that_did",
    lambda ev: metrics.users_in_list_that_did(
        metrics.user_ids_by_event(ev, C.ACCOUNT_CREATED, LAST_WEEK, C.SERVICE_SOURCE),
        ev,
        C.SAVE_SUCCEEDED,
        LAST_WEEK,
        C.SERVICE_SOURCE,
    ),
)
on_events("new_users_that_saved", lambda ev: metrics.new_users_that_saved(ev, LAST_WEEK))
on_both("saved_vs_tried_ratio", lambda ev, ub: metrics.saved_vs_tried_ratio(ev, ub, YESTERDAY))
on_events("pct_not_returned", lambda ev: metrics.pct_not_returned(ev, METRICS_AS_OF, 3))
on_events(
    "daily_avg_users_by_event",
    lambda ev: metrics.daily_avg_users_by_event(ev, C.APP_OPENED, METRICS_AS_OF, 3),
)
on_payments(
    "daily_avg_users_by_transaction",
    lambda ub: metrics.daily_avg_users_by_transaction(ub, C.SAVING, METRICS_AS_OF, 10),
)
on_events(
    "avg_signups", lambda ev: metrics.avg_signups(ev, Window.of_days("2024-01-17", "2024-01-19"), 3)
)
on_events(
    "users_with_context_value",
    lambda ev: metrics.users_with_context_value(
        ev, "%BOOST_EXPIRED%", "%SOCIAL%", Window.of_days("2024-01-01", METRICS_AS_OF)
    ),
)
on_events(
    "context_values", lambda ev: metrics.context_values(ev.where(filters.event_prefix("BOOST_")), "boostId")
)
for _suffix, _match in (("", "literal"), ("_by_key", "key")):
    on_events(
        f"users_offered_boosts{_suffix}",
        lambda ev, match=_match: metrics.users_offered_boosts(
            ev,
            metrics.context_values(metrics.expired_on(ev, METRICS_AS_OF), "boostId").withColumnRenamed(
                "value", "boost_id"
            ),
            METRICS_AS_OF,
            match,
        ),
    )
    on_events(
        f"pct_boosts_expired{_suffix}",
        lambda ev, match=_match: metrics.pct_boosts_expired(ev, METRICS_AS_OF, match),
    )
on_events("users_entered", lambda ev: metrics.users_entered(ev, METRICS_AS_OF))
on_events("users_that_tried_saving", lambda ev: metrics.users_that_tried_saving(ev, YESTERDAY))
on_payments("compare_withdrew_saved", lambda ub: metrics.compare_withdrew_saved(ub, YESTERDAY))
on_both("daily_metrics", lambda ev, ub: metrics.daily_metrics(ev, ub, METRICS_AS_OF))

# --- fraud -------------------------------------------------------------------------------
on_payments("quick_withdrawal_pairs", lambda ub: fraud.quick_withdrawals(ub, 48, 30, FRAUD_AS_OF))
on_payments(
    "quick_withdrawal_pairs_strict", lambda ub: fraud.quick_withdrawals(ub, 48, 30, FRAUD_AS_OF, strict=True)
)
on_flags("last_flag_times", fraud.last_flag_times)
register(
    "fraud_facts",
    lambda spark, d: fraud.fraud_facts(mapped.behaviour(spark, d), mapped.flags(spark, d), FRAUD_AS_OF),
)
register(
    "fraud_flags",
    lambda spark, d: fraud.fraud_flags(
        mapped.behaviour(spark, d), mapped.flags(spark, d), FRAUD_AS_OF, NOW_MS
    ),
)
on_flags(
    "flags_for_user",
    lambda fl: filters.flags_for(fl, "3", "acc-3").select("user_id", "account_id", "rule_label", "created_at"),
)

# --- cohorts -----------------------------------------------------------------------------
on_payments("last_save_per_user", cohorts.last_save_per_user)
on_payments("user_first_seen_total", cohorts.user_first_seen_total)
on_payments("monthly_save_totals", cohorts.monthly_save_totals)
on_events("never_redeemed_boosts", cohorts.never_redeemed_boosts)
on_both("withdraw_then_save", cohorts.withdraw_then_save)
on_both("returning_savers", cohorts.returning_savers)
on_events("open_to_withdrawal", cohorts.open_to_withdrawal)
on_events("days_to_withdraw_summary", cohorts.days_to_withdraw_summary)
on_events("message_app_open", lambda ev: cohorts.message_app_open(ev, COHORT_AS_OF))
on_events("message_open_rate", lambda ev: cohorts.message_open_rate(ev, COHORT_AS_OF))
on_events("boost_next_save", lambda ev: cohorts.boost_next_save(ev, COHORT_AS_OF))
on_events("boost_induce_rate", lambda ev: cohorts.boost_induce_rate(ev, COHORT_AS_OF))
on_events("boost_monthly_stats", lambda ev: cohorts.boost_monthly_stats(ev, COHORT_AS_OF))
on_both("cohort_savings", cohorts.cohort_savings)
on_both("cohort_monthly", cohorts.cohort_monthly)
on_both("saves_after_14_days", lambda ev, ub: cohorts.saves_after_14_days(ev, ub, COHORT_AS_OF))
on_both("late_savers_by_cohort", lambda ev, ub: cohorts.late_savers_by_cohort(ev, ub, COHORT_AS_OF))
on_payments("recency_buckets", lambda ub: cohorts.recency_buckets(ub, COHORT_AS_OF))
on_payments("recency_histogram", lambda ub: cohorts.recency_histogram(ub, COHORT_AS_OF))
on_events("value_counts", lambda ev: columns.value_counts(ev, "event_type"))
on_events("distinct_and_null_count", lambda ev: columns.distinct_and_null_count(ev, "user_id"))

on_events(
    "group_size",
    lambda ev: columns.with_group_size(ev.select("user_id", "event_type", "created_at"), ["user_id"]),
)
for _name, _edge in (("first_per_group", columns.first_per_group), ("last_per_group", columns.last_per_group)):
    on_events(
        _name,
        lambda ev, edge=_edge: edge(
            ev.select("user_id", "event_type", "created_at", F.nullif("context", F.lit("")).alias("context")),
            ["user_id"],
            "created_at",
        ),
    )

# --- offers ------------------------------------------------------------------------------
_T = "time_transaction_occurred"
_RENAMED = lambda df: df.withColumnRenamed(_T, "t")
_OFFERS_AND_SAVES = lambda ev: ev.where(
    filters.event_prefix(C.BOOST_CREATED) | filters.event_is(C.SAVE_SUCCEEDED)
)


def recent_openers(events: DataFrame) -> DataFrame:
    """The candidates for an offer: users that opened the app in the last two days."""
    recent = filters.since(events, day_start(days_before(FRAUD_AS_OF, 2)))
    return recent.where(filters.event_is(C.APP_OPENED)).select("user_id").distinct()


on_events(
    "drop_top_users",
    lambda ev: _RENAMED(filters.drop_top_users(_OFFERS_AND_SAVES(ev)).select("user_id", "event_type", _T)),
)
on_events("top_users", lambda ev: filters.top_users(_OFFERS_AND_SAVES(ev)))
on_events("boost_fields", lambda ev: _RENAMED(boosts.boost_fields(ev)))
on_events("save_requirement", lambda ev: _RENAMED(boosts.save_requirements(ev)))
for _column in ("prior_save_count", "save_within_48"):
    on_events(
        _column,
        lambda ev, column=_column: _RENAMED(boosts.boosts_with_saves(ev).select("user_id", _T, column)),
    )
on_events("boost_dataset", boosts.boost_dataset)
on_events("boost_training_set", boosts.boost_training_set)
on_both("boost_training_set_with_withdrawals", boosts.boost_training_set)
on_events("boost_future_saves", boosts.boost_future_saves)
on_events("boost_prior_redemptions", boosts.boost_prior_redemptions)
on_both(
    "user_save_stats", lambda ev, ub: boosts.user_save_stats(ub, FRAUD_AS_OF, recent_openers(ev))
)
on_events("redeem_counts", lambda ev: boosts.redeem_counts(ev, recent_openers(ev)))
on_both(
    "score_input",
    lambda ev, ub: boosts.score_input(
        ev, ub, recent_openers(ev), FRAUD_AS_OF, 10, "GAME::TAP_SCREEN"
    ),
)

# --- ingest ------------------------------------------------------------------------------
INGEST_NOW = day_start("2024-01-31")
SECRET = "shared-secret"


def _notes(spark: SparkSession, folder: str) -> DataFrame:
    return mapped.notifications(spark, folder, SECRET)


def _verified(spark: SparkSession, folder: str) -> DataFrame:
    genuine = signature_holds(F.col("hash"), F.col("eventType"), SECRET)
    return _notes(spark, folder).select(
        F.col("userId").alias("user_id"),
        F.col("eventType").alias("event_type"),
        F.col("timestamp").alias(_T),
        genuine.alias("genuine"),
    )


CONTEXT_NAMES = [n.lstrip("$") for n in S.EXPORT_FIELDS] + ["reference_time"]
FLATTENED = ", ".join(f"`{n}` string" for n in CONTEXT_NAMES) + (
    ", event_properties array<struct<property_type: string, insert_id: string, key: string, value: string>>"
)


def _opened(rows: DataFrame) -> DataFrame:
    """Export rows with every member of the context in a column of its own."""
    as_number = lambda n: F.col(f"ctx.{n}").cast("double") if n == "location_lat" else F.col(f"ctx.{n}")
    properties = F.col("ctx.event_properties")
    told = F.transform(
        F.slice(properties, 1, 3), lambda p: F.concat_ws(":", p["property_type"], p["insert_id"], p["key"], p["value"])
    )
    return rows.withColumn("ctx", once(F.from_json("context", FLATTENED))).select(
        "user_id",
        "event_type",
        _T,
        "source_of_event",
        "created_at",
        "updated_at",
        *[as_number(n).alias(f"c_{n}") for n in CONTEXT_NAMES],
        F.array_join(told, ",").alias("properties"),
        F.concat_ws(":", properties[3]["property_type"], properties[3]["insert_id"], properties[3]["key"]).alias("last_property"),
        properties[3]["value"].cast("double").alias("last_value"),
        F.size(properties).alias("n_properties"),
    )


def _flattened(spark: SparkSession, folder: str) -> DataFrame:
    return _opened(ingest.flatten_export(ingest.parse_export(mapped.export_lines(spark, folder)), INGEST_NOW))


register("normalise_sns", lambda spark, d: ingest.normalise_notification(_notes(spark, d)))
register("verify_signature", _verified)
on_events(
    "stamp_events",
    lambda ev: ingest.stamp_events(
        ingest.decode_messages(ingest.encode_messages(ev)), C.SERVICE_SOURCE, INGEST_NOW
    ),
)
register(
    "to_behaviour", lambda spark, d: ingest.to_behaviour(mapped.payment_events(spark, d), INGEST_NOW)
)
register(
    "rejected_payments",
    lambda spark, d: ingest.rejected_payments(mapped.payment_events(spark, d))
    .groupBy("reject_reason")
    .agg(F.count(F.lit(1)).alias("rows")),
)
register("flatten_export", _flattened)
register(
    "bad_export_lines",
    lambda spark, d: ingest.bad_export_lines(ingest.parse_export(mapped.export_lines(spark, d))).agg(
        F.count(F.lit(1)).alias("rows")
    ),
)

# --- streams -----------------------------------------------------------------------------
register("ingest_stream", lambda spark, d: runs.run_ingest(spark, d, INGEST_NOW))
register("behaviour_stream", lambda spark, d: runs.run_behaviour(spark, d, INGEST_NOW))
register("fraud_stream", lambda spark, d: runs.run_fraud(spark, d, ("2024-01-11", "2024-01-21")))
register("last_flag_stream", runs.run_last_flags)
register("events_per_hour_stream", runs.run_hourly_counts)
register("deduplicated_stream", runs.run_deduplicated)

# --- models ------------------------------------------------------------------------------


def _training_rows(spark: SparkSession, folder: str) -> DataFrame:
    training = boosts.boost_training_set(mapped.event_log(spark, folder))
    return ml.materialise(spark, ml.model_input(training))


def _linear(spark: SparkSession, folder: str) -> DataFrame:
    rows = _training_rows(spark, folder)
    train, test = ml.split(rows)
    scores = ml.evaluate(ml.train_linear(train).transform(test))
    return ml.training_result(scores, rows, FRAUD_AS_OF)


def _boosted(spark: SparkSession, folder: str) -> DataFrame:
    train, test = ml.split(_training_rows(spark, folder))
    return ml.evaluate(ml.train_boosted_trees(train).transform(test))


def _importance(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = ml.split(_training_rows(spark, folder))
    return ml.feature_importance(spark, ml.train_boosted_trees(train))


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = ml.split(_training_rows(spark, folder))
    events, payments = mapped.event_log(spark, folder), mapped.behaviour(spark, folder)
    return ml.score_users(
        events,
        payments,
        recent_openers(events),
        ml.train_linear(train),
        FRAUD_AS_OF,
        10,
        "GAME::TAP_SCREEN",
    )


register("train_linear", _linear)
register("train_gbt", _boosted)
register("model_portfolio", lambda spark, d: ml.compare_models(*ml.split(_training_rows(spark, d))))
register("bayes_portfolio", lambda spark, d: bayes.compare(*bayes.split_by_digest(_training_rows(spark, d))))
register("svm_grid", lambda spark, d: ml.svm_grid(ml.split(_training_rows(spark, d))[0])[1])
register("feature_importance", _importance)
register("score_users", _scores)

# --- tables and files --------------------------------------------------------------------
register("read_events", lambda spark, d: round_trips.event_table(spark, d).drop("event_date"))
register("read_behaviour", lambda spark, d: round_trips.behaviour_table(spark, d).drop("event_date"))
register("read_flags", round_trips.flag_table)
register("append_events", round_trips.appended_events)
register("read_events_csv", round_trips.csv_log)
register(
    "export_files",
    # the made-up export has a fixed share of bad lines, so none of them refuses the load
    lambda spark, d: _opened(round_trips.export_files(spark, d, INGEST_NOW, None)),
)
register("write_features_csv", lambda spark, d: round_trips.feature_files(spark, d, FRAUD_AS_OF))


def _dummies(spark: SparkSession, folder: str) -> DataFrame:
    offers = boosts.boost_fields(mapped.event_log(spark, folder)).select("user_id", "boost_id", "boost_type_category")
    return ml.dummies(offers, "boost_type_category")


def _dummy_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Every event of a user as one place among all users; as many values as the log has users."""
    log = mapped.event_log(spark, folder).select("user_id", "event_type")
    frame, _ = ml.dummy_vectors(spark, log, "user_id")
    vector = F.col("user_id_vector").cast("string")
    return frame.groupBy("user_id", "event_type", "user_id_place", vector.alias("vector")).agg(F.count(F.lit(1)).alias("n"))


def _amount_scores(payments: DataFrame) -> DataFrame:
    """How well the amount tells savings from withdrawals; nearly every payment has a score of its own."""
    amount = F.col("amount")
    rows = payments.select(
        (F.col("transaction_type") == C.SAVING).cast("double").alias(ml.LABEL),
        (amount > 100_000_000).cast("double").alias("prediction"),
        amount.cast("double").alias("score"),
    )
    return ml.evaluate(rows, "score")


def _rule_scores(spark: SparkSession, folder: str) -> DataFrame:
    """How well "has saved more than five times" foretells the label."""
    rows = ml.model_input(boosts.boost_training_set(mapped.event_log(spark, folder)))
    saves = F.col("boost_prior_saves")
    guess = rows.withColumns({"prediction": (saves > 5).cast("double"), "score": saves.cast("double")})
    return ml.evaluate(guess.select(ml.LABEL, "prediction", "score"), "score")


def _training_log(spark: SparkSession, folder: str) -> DataFrame:
    """The figures of a run, appended to a table and read back."""
    rows = ml.model_input(boosts.boost_training_set(mapped.event_log(spark, folder)))
    saves = F.col("boost_prior_saves")
    guess = rows.withColumns({"prediction": (saves > 5).cast("double"), "score": saves.cast("double")})
    return round_trips.training_log(ml.training_result(ml.evaluate(guess, "score"), rows, FRAUD_AS_OF))


def _saved_model(spark: SparkSession, folder: str) -> DataFrame:
    """What a model says of the test rows before it is saved and after it is loaded."""
    train, test = ml.split(_training_rows(spark, folder))
    model = ml.train_boosted_trees(train, rounds=3)
    again = round_trips.saved_model(spark, model, FRAUD_AS_OF)
    key = ["user_id", "boost_id"]
    told = [m.transform(test).select(*key, F.col("prediction").alias(n)) for m, n in ((model, "before"), (again, "after"))]
    return told[0].join(told[1], key)


# a rule on trial, beside the published ones, as it stands in a file of rules
TRIAL = fraud.TreeRule(
    "any_large_saving_event",
    "User has any large saving_event",
    '{"any": [{"fact": "saves_above_50k_6m", "is": ">", "value": 0}]}',
    experimental=True,
)


def _rules_on_trial(spark: SparkSession, folder: str) -> DataFrame:
    """Flags per rule, without and with the rules on trial."""
    facts = fraud.fraud_facts(mapped.behaviour(spark, folder), mapped.flags(spark, folder), FRAUD_AS_OF)
    both = [
        fraud.evaluate_rules(facts, NOW_MS, (*fraud.RULES, TRIAL), on).withColumn("on_trial", F.lit(on)) for on in (False, True)
    ]
    return both[0].unionByName(both[1]).groupBy("on_trial", "rule_label").agg(F.count(F.lit(1)).alias("flags"))


register("training_log", _training_log)
register("saved_model", _saved_model)
register("rules_on_trial", _rules_on_trial)
register("dummies", _dummies)
register("dummy_vectors", _dummy_vectors)
register("evaluate", _rule_scores)
on_payments("evaluate_payments", _amount_scores)
