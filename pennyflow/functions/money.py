"""Amounts. Stored as hundredths of a cent in a long; shown in whole currency as a double."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pennyflow import constants as C

PER_CURRENCY = C.UNITS_PER_CURRENCY[C.HUNDREDTH_CENT]


def whole_currency(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0)) / F.lit(float(PER_CURRENCY))


def per_currency(unit: Column) -> Column:
    """How many of ``unit`` make one whole currency; null for an unknown unit."""
    factor = F.lit(None).cast("long")
    for name, count in C.UNITS_PER_CURRENCY.items():
        factor = F.when(unit == name, F.lit(count).cast("long")).otherwise(factor)
    return factor


def parse_saved_amount(packed: Column) -> Column:
    """``amount::unit::currency`` to a struct of hundredth cents and currency; null parts if bad."""
    part = lambda i: F.get(F.split(packed, "::"), i)
    factor = (F.lit(PER_CURRENCY) / per_currency(part(1))).cast("long")
    return F.struct(
        (part(0).try_cast("long") * factor).alias("amount"),
        F.lit(C.HUNDREDTH_CENT).alias("unit"),
        part(2).alias("currency"),
    )


def transaction_type(event_type: Column) -> Column:
    return F.when(event_type == C.SAVE_SUCCEEDED, C.SAVING).when(
        event_type == C.WITHDRAWAL_CONFIRMED, C.WITHDRAWAL
    )


def money_text(amount: Column, sign: str = "R") -> Column:
    """Exact text of an amount in hundredth cents, for example ``R12.5`` and ``R0.0``."""
    digits = (F.coalesce(amount, F.lit(0)).cast("decimal(38,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast(
        "decimal(38,4)"
    )
    return F.concat(F.lit(sign), F.regexp_replace(digits.cast("string"), "(\\.\\d+?)0*$", "$1"))
