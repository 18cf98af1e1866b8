"""Null handling of the app export."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_token(value: Column) -> Column:
    """The text 'null' means null."""
    return F.nullif(value, F.lit("null"))


def default_false(value: Column, no: Column | None = None) -> Column:
    return F.coalesce(value, F.lit(False) if no is None else no)


def fallback_user_id(user_id: Column, device_user: Column) -> Column:
    """Users who are not logged in are known by their device's number only."""
    return F.coalesce(null_token(user_id), device_user.cast("string"))
