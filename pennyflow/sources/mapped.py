"""Builds the three analytics tables from the generic ``events`` test table.

``events(event_id, ts, user_id, event_type, value, props)`` carries everything needed; the mapping is
a pure projection, so each report still reads only the columns it uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.functions.signature import hmac_sha256
from pennyflow.schemas import EXPORT_FIELDS
from pennyflow.timebox import day_start

SEEDED_FLAG_TIME = day_start("2024-01-15")
LARGE_FROM = day_start("2024-01-29")


def _raw(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    # a time without zone is read as UTC; the cast also floors microseconds to milliseconds
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        "value",
        k.alias("k"),
        ms.alias("ms"),
        *more,
    )


# The screens of the published stages: odd k below SCREENS_BELOW, in turn.
SCREENS = (
    C.INTRO_ENTERED,
    C.REFERRAL_SCREEN,
    C.VALID_REFERRAL_CODE,
    C.REGISTER_SUCCEEDED,
    C.PASSWORD_SUCCEEDED,
    C.FIRST_ADD_CASH_STARTED,
    C.LEFT_AT_PAYMENT_LINK,
    C.RETURNED_TO_PAYMENT_LINK,
    C.PAYMENT_SUCCEEDED,
)
SCREENS_BELOW = 54


def _screen(k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SCREENS)), ((k / 2).cast("int") % len(SCREENS)) + 1)


def _event_type() -> Column:
    kind, k = F.col("event_type"), F.col("k")
    return (
        F.when(kind == "signup", C.ACCOUNT_CREATED)
        .when(kind == "purchase", C.SAVE_SUCCEEDED)
        .when(kind == "error", C.WITHDRAWAL_SETTLED)
        .when((kind == "view") & (k % 2 == 0), C.APP_OPENED)
        .when((kind == "view") & (k < SCREENS_BELOW), _screen(k))
        .when(kind == "view", C.ADD_CASH_STARTED)
        .when(k % 4 == 0, C.BOOST_CREATED)
        .when(k % 4 == 1, C.BOOST_REDEEMED)
        .when(k % 4 == 2, C.BOOST_EXPIRED)
        .otherwise(C.MESSAGE_SENT)
    )


def _offer_context() -> Column:
    k, ms = F.col("k"), F.col("ms")
    pick = lambda a, b, c: F.when(k % 3 == 0, a).when(k % 3 == 1, b).otherwise(c)
    conditions = F.when(
        k % 5 != 0,
        F.format_string(
            ',"statusConditions":{"UNLOCKED":["app_opened"],'
            '"REDEEMED":["save_greater_than #{%d::WHOLE_CURRENCY::ZAR}"]}',
            10 * (1 + k),
        ),
    ).otherwise("")
    return F.concat(
        F.format_string('{"boostId":"b%d","boostType":"', k),
        pick("GAME", "SIMPLE", "SOCIAL"),
        F.lit('","boostCategory":"'),
        pick("TAP_SCREEN", "SIMPLE_SAVE", "NUMBER_FRIENDS"),
        F.format_string('","boostAmount":"%d","boostUnit":"WHOLE_CURRENCY"', 1 + k),
        F.format_string(',"boostStartTime":%d,"boostEndTime":%d', ms, ms + (1 + k % 7) * C.DAY_MS),
        conditions,
        F.lit("}"),
    )


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(spark, folder)
    from_app = (F.col("event_type") == "view") | (F.col("event_id") % 5 == 0)
    stamped = F.col("ms") + (F.col("event_id") % 7) * 60_000
    is_offer = (F.col("event_type") == "click") & (F.col("k") % 4 < 3)
    return raw.select(
        "user_id",
        _event_type().alias("event_type"),
        F.col("ms").alias("time_transaction_occurred"),
        F.when(from_app, C.APP_SOURCE).otherwise(C.SERVICE_SOURCE).alias("source_of_event"),
        stamped.alias("created_at"),
        stamped.alias("updated_at"),
        F.when(is_offer, _offer_context()).otherwise("").alias("context"),
    )


def behaviour(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(spark, folder).where(F.col("event_type").isin("purchase", "error"))
    # some users' last savings are far above their average
    large = (F.col("ms") >= LARGE_FROM) & (F.col("k") % 5 == 0)
    stamped = F.col("ms") + (F.col("event_id") % 7) * 60_000
    return raw.select(
        "user_id",
        F.concat(F.lit("acc-"), "user_id").alias("account_id"),
        F.when(F.col("event_type") == "purchase", C.SAVING)
        .otherwise(C.WITHDRAWAL)
        .alias("transaction_type"),
        (F.round(F.col("value") * 100).cast("bigint") * F.when(large, 1_000_000).otherwise(50_000)).alias("amount"),
        F.lit(C.HUNDREDTH_CENT).alias("unit"),
        F.lit("ZAR").alias("currency"),
        F.col("ms").alias("time_transaction_occurred"),
        stamped.alias("created_at"),
        stamped.alias("updated_at"),
    )


def flags(spark: SparkSession, folder: str) -> DataFrame:
    """Flags given before ``SEEDED_FLAG_TIME``, so that every rule has users with a cut-off.

    Any payment above a limit gave its user a flag at the payment's processing time.
    """
    saving, amount = F.col("transaction_type") == C.SAVING, F.col("amount")
    label = (
        F.when(saving & (amount > 1_000_000_000), C.RULE_VERY_LARGE)
        .when(saving & (amount > 500_000_000), C.RULE_SEVERAL_LARGE)
        .when(saving & (amount > 400_000_000), C.RULE_ABOVE_AVERAGE)
        .when(~saving & (amount > 500_000_000), C.RULE_TWO_DAYS)
        .when(~saving & (amount > 400_000_000), C.RULE_ONE_DAY)
    )
    return (
        behaviour(spark, folder)
        .where(F.col("created_at") < SEEDED_FLAG_TIME)
        .withColumn("rule_label", label)
        .where(F.col("rule_label").isNotNull())
        .select(
            "user_id",
            "account_id",
            "rule_label",
            F.lit("earlier payment").alias("reason"),
            F.lit(C.ACCURACY_PENDING).alias("accuracy"),
            "created_at",
            "updated_at",
        )
    )


# --- raw inputs, as the services and the app send them -----------------------------------


def payment_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as they reach the behaviour table's loader: amounts in three units, some unreadable
    and some without an amount."""
    k, cents = F.col("k"), F.round(F.col("value") * 100).cast("bigint")
    packed = (
        F.when(k % 10 == 7, F.lit("abc::WHOLE_CENT::ZAR"))
        .when(k % 3 == 0, F.concat(cents.cast("string"), F.lit("::WHOLE_CENT::ZAR")))
        .when(k % 3 == 1, F.concat((cents * 100).cast("string"), F.lit("::HUNDREDTH_CENT::ZAR")))
        .otherwise(F.concat(F.floor(cents / 100).cast("string"), F.lit("::WHOLE_CURRENCY::ZAR")))
    )
    amount = F.when(k % 10 == 8, "").otherwise(F.concat(F.lit(',"savedAmount":"'), packed, F.lit('"')))
    context = F.concat(F.lit('{"accountId":"acc-'), "user_id", F.lit('"'), amount, F.lit("}"))
    pays = F.col("event_type").isin("purchase", "error")
    return _raw(spark, folder).select(
        "user_id",
        F.when(F.col("event_type") == "error", C.WITHDRAWAL_CONFIRMED)
        .otherwise(_event_type())
        .alias("event_type"),
        F.col("ms").alias("time_transaction_occurred"),
        F.when(pays, context).otherwise("").alias("context"),
    )


def notifications(spark: SparkSession, folder: str, secret: str) -> DataFrame:
    """Service notifications; those of small values carry a forged signature."""
    event_type = _event_type()
    signed = hmac_sha256(F.concat(F.lit(f"{secret}_"), event_type), secret)
    context = F.create_map(F.lit("accountId"), F.concat(F.lit("acc-"), "user_id"))
    return _raw(spark, folder).select(
        event_type.alias("eventType"),
        F.col("user_id").alias("userId"),
        F.col("ms").alias("timestamp"),
        F.when(F.col("event_type") == "purchase", context).alias("context"),
        F.when(F.col("value") >= 5, signed).otherwise(F.lit("forged")).alias("hash"),
    )


def export_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the app export, with users known only by device, times without a fraction, lines
    that break off and blank ones."""
    k = F.col("k")
    time = F.col("ts").cast("timestamp")
    text = F.when(k % 4 == 0, F.date_format(time, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    given = {
        "client_event_time": text,
        "$insert_id": F.concat(F.lit("i-"), F.col("event_id").cast("string")),
        # some typed fields come as texts, some of them as the text 'null'
        "app": F.when(k % 7 == 4, F.lit("240").cast("variant")).otherwise(F.lit(240_000).cast("variant")),
        "session_id": F.when(k % 7 == 3, F.lit("null").cast("variant")).otherwise(F.col("event_id").cast("variant")),
        "event_id": F.when(k % 7 == 5, "null"),
        "user_id": F.when(k % 11 == 0, "null").when(k % 11 == 1, F.lit(None)).otherwise(F.col("user_id")),
        "city": F.when(k % 3 == 0, "null").otherwise("Cape Town"),
        "event_type": F.col("mapped_type"),
        "paying": F.when(k % 2 == 0, F.lit(True)),
        "amplitude_id": F.lit(100_000) + F.col("user_id").cast("long"),
        "is_attribution_event": F.lit(False),
        "location_lat": F.col("value"),
    }
    fields = [given.get(f, F.lit(None).cast("string")).alias(f) for f in EXPORT_FIELDS]
    properties = F.struct(
        k.alias("k"), (k % 2 == 0).alias("even"), F.col("event_type").alias("kind")
    ).alias("event_properties")
    extra = F.struct(F.col("value").alias("value")).alias("user_properties")
    line = F.to_json(F.struct(*fields, properties, extra), {"ignoreNullFields": "false"})
    broken = F.when(k == 50, F.substring(line, 1, 40)).when(k == 51, "null").when(k == 52, "")
    raw = _raw(spark, folder, "ts").withColumn("mapped_type", _event_type())
    return raw.select(F.coalesce(broken, line).alias("value"))
