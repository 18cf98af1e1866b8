import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from pennyflow.functions.money import money_text, parse_saved_amount, transaction_type, whole_currency
from pennyflow.functions.offers import days_open, offer_fields, parse_offer, save_requirement
from pennyflow.functions.signature import hmac_sha256, signature_holds
from pennyflow.functions.text import default_false, fallback_user_id, null_token
from pennyflow.functions.times import calendar_fields, hours_between, parse_client_time
from pennyflow.timebox import Window, day_end, day_start, days_before, months_before


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_day_bounds_stop_at_the_last_whole_second():
    assert day_start("2019-04-03") == 1554249600000
    assert day_end("2019-04-06") == 1554595199000
    assert Window.of_day("2019-04-03").end - Window.of_day("2019-04-03").start == 86_399_000


def test_dates_before():
    assert str(days_before("2024-03-01", 1)) == "2024-02-29"
    assert str(months_before("2024-01-30", 6)) == "2023-08-01"  # 182 days


def test_client_time(spark):
    rows = [
        ("2022-06-01 00:00:00.4560",),
        ("2022-06-01 23:59:59.7894",),
        ("2022-06-02 00:00:00",),
        ("2021-03-05 06:07:08.090000",),
        ("yesterday",),
        (None,),
    ]
    got = [r[0] for r in values(spark, rows, "s string", parse_client_time(F.col("s")))]
    assert got == [1654041600456, 1654127999789, 1654128000000, 1614924428090, None, None]


def test_hours_are_cut_toward_zero(spark):
    rows = [(0, 3_599_999), (0, 3_600_000), (3_599_999, 0), (3_660_001, 0)]
    got = values(spark, rows, "a long, b long", hours_between(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [0, -1, 0, 1]


def test_calendar_starts_on_monday(spark):
    fields = calendar_fields(F.col("t"))
    rows = [(day_start("2024-01-01") + 5 * 3_600_000,), (day_start("2024-01-07"),)]
    got = values(spark, rows, "t long", *fields.values())
    assert got == [(1, 5, 0), (7, 0, 6)]


@pytest.mark.parametrize(
    "packed, expected",
    [
        ("100::HUNDREDTH_CENT::ZAR", (100, "HUNDREDTH_CENT", "ZAR")),
        ("100::WHOLE_CENT::ZAR", (10_000, "HUNDREDTH_CENT", "ZAR")),
        ("100::WHOLE_CURRENCY::USD", (1_000_000, "HUNDREDTH_CENT", "USD")),
        ("100::SHELLS::ZAR", (None, "HUNDREDTH_CENT", "ZAR")),
        ("x::WHOLE_CENT::ZAR", (None, "HUNDREDTH_CENT", "ZAR")),
        ("100", (None, "HUNDREDTH_CENT", None)),
    ],
)
def test_saved_amount(spark, packed, expected):
    got = values(spark, [(packed,)], "s string", parse_saved_amount(F.col("s")))
    assert tuple(got[0][0]) == expected


def test_money(spark):
    rows = [(12_500,), (None,), (0,), (123_456_789_012,)]
    got = values(spark, rows, "a long", whole_currency(F.col("a")), money_text(F.col("a")))
    assert got == [(1.25, "R1.25"), (0.0, "R0.0"), (0.0, "R0.0"), (12345678.9012, "R12345678.9012")]


def test_transaction_type(spark):
    rows = [("SAVING_PAYMENT_SUCCESSFUL",), ("WITHDRAWAL_EVENT_CONFIRMED",), ("RANDOM_STRING",)]
    got = [r[0] for r in values(spark, rows, "e string", transaction_type(F.col("e")))]
    assert got == ["SAVING_EVENT", "WITHDRAWAL", None]


CONTEXT = '{"boostId":"b1","boostType":"GAME","boostCategory":"TAP_SCREEN","boostAmount":"%s","boostUnit":"%s","statusConditions":%s}'


@pytest.mark.parametrize(
    "conditions, expected",
    [
        ('{"REDEEMED":["save_greater_than #{100::WHOLE_CURRENCY::ZAR}"]}', ("save_greater_than", 100.0)),
        ('{"REDEEMED":["save_greater_than #{100::WHOLE_CENT::ZAR}"]}', ("save_greater_than", 1.0)),
        # within a list the first condition counts, over the lists the last one
        (
            '{"UNLOCKED":["app_opened","first_save_above #{5::WHOLE_CURRENCY::ZAR}","save_greater_than #{6::WHOLE_CURRENCY::ZAR}"],'
            '"REDEEMED":["balance_crossed_abs_target #{7::WHOLE_CURRENCY::ZAR}","save_greater_than #{8::WHOLE_CURRENCY::ZAR}"],'
            '"EXPIRED":["too_late"]}',
            ("balance_crossed_abs_target", 7.0),
        ),
        # without a space the kind loses its last character
        ('{"REDEEMED":["save_greater_than#{9::WHOLE_CURRENCY::ZAR}"]}', ("save_greater_than#{9::WHOLE_CURRENCY::ZAR", 9.0)),
        ('{"UNLOCKED":["app_opened"]}', (None, None)),
        ("null", (None, None)),
    ],
)
def test_save_requirement(spark, conditions, expected):
    text = CONTEXT % ("10", "WHOLE_CURRENCY", conditions)
    got = values(spark, [(text,)], "c string", *save_requirement(parse_offer(F.col("c"))).values())
    assert got == [expected]


def test_offer_fields(spark):
    text = CONTEXT % ("500", "WHOLE_CENT", "{}")
    got = values(spark, [(text,)], "c string", *offer_fields(parse_offer(F.col("c"))).values())
    assert got == [("b1", "GAME", "TAP_SCREEN", 5.0, "GAME::TAP_SCREEN")]
    text = '{"boostStartTime":0,"boostEndTime":129600000}'
    assert values(spark, [(text,)], "c string", days_open(parse_offer(F.col("c")))) == [(1.5,)]


@pytest.mark.parametrize("secret", ["s", "a secret", "x" * 64, "long" * 40])
def test_signature(spark, secret):
    wanted = hmac.new(secret.encode(), f"{secret}_SAVED".encode(), hashlib.sha256).hexdigest()
    got = values(
        spark,
        [("SAVED", wanted), ("SAVED", "other"), ("SAVED", None)],
        "e string, h string",
        hmac_sha256(F.concat(F.lit(f"{secret}_"), "e"), secret),
        signature_holds(F.col("h"), F.col("e"), secret),
        signature_holds(F.col("h"), F.col("e"), secret, dry_run=True),
    )
    assert got == [(wanted, True, True), (wanted, False, True), (wanted, False, True)]


def test_null_handling(spark):
    rows = [("u", 1, True), ("null", 2, None), (None, 3, False)]
    got = values(
        spark,
        rows,
        "u string, a long, p boolean",
        fallback_user_id(F.col("u"), F.col("a")),
        null_token(F.col("u")),
        default_false(F.col("p")),
    )
    assert got == [("u", "u", True), ("2", None, False), ("3", None, False)]
