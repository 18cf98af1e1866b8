"""From raw messages and export lines to rows of the declared tables.

Every step is a projection, so a batch read and a stream use the same code. A bad row never stops
its neighbours: it is set aside with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pennyflow import constants as C
from pennyflow import schemas as S
from pennyflow.functions.money import parse_saved_amount, transaction_type
from pennyflow.functions.plans import once
from pennyflow.functions.text import default_false, fallback_user_id, null_token
from pennyflow.functions.times import parse_client_time

# --- notifications and queued messages ---------------------------------------------------


def normalise_notification(df: DataFrame) -> DataFrame:
    """Service names to table names; the context object becomes text, '' when absent."""
    return df.select(
        F.col("userId").alias("user_id"),
        F.col("eventType").alias("event_type"),
        F.col("timestamp").alias("time_transaction_occurred"),
        F.coalesce(F.to_json("context"), F.lit("")).alias("context"),
    )


def encode_messages(df: DataFrame) -> DataFrame:
    """Rows to queued messages: the base64 text of a one-element JSON list."""
    row = F.struct("user_id", "event_type", "time_transaction_occurred", "context")
    text = F.base64(F.to_json(F.array(row)).cast("binary"))
    # the encoder breaks long texts into lines
    return df.select(F.translate(text, "\r\n", "").alias("value"))


def decode_messages(df: DataFrame, column: str = "value") -> DataFrame:
    """Queued messages to rows, with undecodable text kept in ``raw``."""
    text = F.try_to_binary(F.col(column), F.lit("base64")).cast("string")
    parsed = F.from_json(text, T.ArrayType(S.MESSAGE))
    return (
        df.select(F.col(column).alias("raw"), F.explode_outer(parsed).alias("m"))
        .select("m.*", "raw")
        .withColumn("decoded", F.col("user_id").isNotNull() & F.col("event_type").isNotNull())
    )


def stamp_events(df: DataFrame, source: str, now_ms: int) -> DataFrame:
    """Add source and processing time; the result has the event table's columns."""
    return df.select(
        "user_id",
        "event_type",
        "time_transaction_occurred",
        F.lit(source).alias("source_of_event"),
        F.lit(now_ms).cast("long").alias("created_at"),
        F.lit(now_ms).cast("long").alias("updated_at"),
        "context",
    )


# --- money movements ---------------------------------------------------------------------


def reject_reason() -> Column:
    """Why an event cannot become a money movement; null if it can.

    The two context keys are looked for in the text itself, as upstream does; a key that is there
    but unreadable is caught by the amount check.
    """
    context = F.coalesce(F.col("context"), F.lit(""))
    amount = F.col("payment.amount")
    return (
        F.when(F.col("time_transaction_occurred").isNull(), "no time")
        .when(F.col("context").isNull(), "no context")
        .when(~context.contains("accountId"), "no account")
        .when(~context.contains("savedAmount"), "no amount")
        .when(F.col("transaction_type").isNull(), "unsupported event type")
        .when(amount.isNull() | F.col("payment.currency").isNull(), "unreadable amount")
        .when(F.col("account_id").isNull(), "unreadable account")
    )


def judge_payments(events: DataFrame) -> DataFrame:
    """Events with parsed payment fields and a ``reject_reason`` column."""
    context = F.from_json("context", S.PAYMENT_CONTEXT)
    return (
        events.withColumn("_ctx", once(context))
        .withColumn(
            "_pay",
            once(
                F.struct(
                    F.col("_ctx.accountId").alias("account_id"),
                    parse_saved_amount(F.col("_ctx.savedAmount")).alias("payment"),
                    transaction_type(F.col("event_type")).alias("transaction_type"),
                )
            ),
        )
        .select(*events.columns, "_pay.*")
        .withColumn("reject_reason", reject_reason())
    )


def to_behaviour(events: DataFrame, now_ms: int) -> DataFrame:
    """The valid payments, as rows of the behaviour table."""
    return (
        judge_payments(events)
        .where(F.col("reject_reason").isNull())
        .select(
            "user_id",
            "account_id",
            "transaction_type",
            F.col("payment.amount").alias("amount"),
            F.col("payment.unit").alias("unit"),
            F.col("payment.currency").alias("currency"),
            "time_transaction_occurred",
            F.lit(now_ms).cast("long").alias("created_at"),
            F.lit(now_ms).cast("long").alias("updated_at"),
        )
    )


def rejected_payments(events: DataFrame) -> DataFrame:
    return (
        judge_payments(events)
        .where(F.col("reject_reason").isNotNull())
        .select("user_id", "event_type", "time_transaction_occurred", "context", "reject_reason")
    )


# --- daily app export --------------------------------------------------------------------


def parse_export(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text lines to export fields; a line that is no JSON object keeps its text as a bad record.

    Every field is read as a variant, so no line is lost for a text where a number is usual. A property
    map that is none is read as missing. The parser reports such lines, and broken ones; only those are
    looked at again.
    """
    options = {"columnNameOfCorruptRecord": S.BAD_RECORD, "mode": "PERMISSIVE"}
    parsed = lines.select(F.col(column).alias("_text"), once(F.from_json(column, S.EXPORT_LINE, options)).alias("line"))
    reported = F.col("line").isNull() | F.col("line").getField(S.BAD_RECORD).isNotNull() | F.trim("_text").isin("", "null")
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json("_text")).startswith("OBJECT"), F.lit(False))
    return parsed.select("line", F.when(reported, F.when(~is_object, F.col("_text"))).alias(S.BAD_RECORD))


def _field(name: str) -> Column:
    """A field's value as it came; null for JSON's null and for the text 'null'."""
    return F.when(_text(name).isNotNull(), F.col("line").getField(name))


def _text(name: str) -> Column:
    return null_token(F.try_variant_get(F.col("line").getField(name), "$", "string"))


def collect_properties() -> Column:
    """All entries of the five property maps as one list; truth values become 'True' / 'False'."""

    def entries(name: str) -> Column:
        def item(e: Column) -> Column:
            is_bool = F.schema_of_variant(e["value"]) == "BOOLEAN"
            text = F.initcap(F.try_variant_get(e["value"], "$", "string")).cast("variant")
            return F.struct(
                F.lit(name).alias("property_type"),
                _text("$insert_id").alias("insert_id"),
                null_token(e["key"]).alias("key"),
                F.when(is_bool, text).otherwise(e["value"]).alias("value"),
            )

        return F.transform(F.map_entries(F.col("line").getField(name)), item)

    lists = [entries(n) for n in S.EXPORT_PROPERTY_MAPS]
    return F.flatten(F.array_compact(F.array(*lists)))


def _user_id() -> Column:
    return null_token(fallback_user_id(_text("user_id"), _text("amplitude_id")))


def export_context() -> Column:
    """The context object: the export's fields in their order, then the reference time and the
    properties. Nulls are kept."""
    special = {"user_id": _user_id(), "paying": default_false(_field("paying"), F.lit(False).cast("variant"))}
    return F.struct(
        *[special.get(n, _field(n)).alias(n.lstrip("$")) for n in S.EXPORT_FIELDS],
        _text("client_event_time").alias("reference_time"),
        collect_properties().alias("event_properties"),
    )


def flatten_export(parsed: DataFrame, now_ms: int) -> DataFrame:
    """Parsed export lines to rows of the event table; bad records are left out here."""
    good = parsed.where(F.col(S.BAD_RECORD).isNull())
    rows = good.select(
        _user_id().alias("user_id"),
        _text("event_type").alias("event_type"),
        parse_client_time(_text("client_event_time")).alias("time_transaction_occurred"),
        F.to_json(export_context(), {"ignoreNullFields": "false"}).alias("context"),
    )
    return stamp_events(rows, C.APP_SOURCE, now_ms)


def bad_export_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(S.BAD_RECORD).isNotNull()).select(F.col(S.BAD_RECORD).alias("value"))
