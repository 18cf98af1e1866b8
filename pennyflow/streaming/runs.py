"""The streams, run over messages made from the test tables until all are used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pennyflow import constants as C
from pennyflow import schemas as S
from pennyflow.operators.ingest import encode_messages
from pennyflow.session import shared_folder
from pennyflow.sources import mapped
from pennyflow.sources.streams import read_event_stream, read_message_stream
from pennyflow.streaming import jobs

BYTES_PER_BATCH = 4 << 30
T = "time_transaction_occurred"


def _message_files(spark: SparkSession, events: DataFrame, work: str) -> DataFrame:
    encode_messages(events).write.text(f"{work}/messages")
    return read_message_stream(spark, f"{work}/messages", bytes_per_batch=BYTES_PER_BATCH)


def _event_files(spark: SparkSession, events: DataFrame, work: str) -> DataFrame:
    events.write.json(f"{work}/events")
    return read_event_stream(spark, f"{work}/events", bytes_per_batch=BYTES_PER_BATCH)


def _columns_of(schema: StructType, df: DataFrame) -> DataFrame:
    """Without the columns that come from the folder names."""
    return df.select(*schema.names)


def run_ingest(spark: SparkSession, folder: str, now_ms: int) -> DataFrame:
    work = shared_folder(spark, "ingest")
    messages = _message_files(spark, mapped.event_log(spark, folder), work)
    jobs.ingest_stream(
        messages, f"{work}/log", f"{work}/checkpoint", C.SERVICE_SOURCE, now_ms
    ).awaitTermination()
    return _columns_of(S.EVENTS, spark.read.schema(S.EVENTS).parquet(f"{work}/log"))


def run_behaviour(spark: SparkSession, folder: str, now_ms: int) -> DataFrame:
    work = shared_folder(spark, "behaviour")
    messages = _message_files(spark, mapped.payment_events(spark, folder), work)
    jobs.behaviour_stream(
        messages, f"{work}/payments", f"{work}/rejected", f"{work}/checkpoint", now_ms
    ).awaitTermination()
    return _columns_of(S.BEHAVIOUR, spark.read.schema(S.BEHAVIOUR).parquet(f"{work}/payments"))


def run_fraud(spark: SparkSession, folder: str, days: tuple[str, ...]) -> DataFrame:
    """Payments arrive in one batch per period; ``days`` are the first days of the later periods."""
    work = shared_folder(spark, "fraud")
    payments = mapped.behaviour(spark, folder)
    day = F.date_format(F.timestamp_millis("created_at"), "yyyy-MM-dd")
    bounds = ("0000-00-00", *days, "9999-99-99")
    stream = spark.readStream.schema(S.BEHAVIOUR).parquet(f"{work}/incoming/period=*")
    for number, (first, stop) in enumerate(zip(bounds, bounds[1:])):
        period = payments.where((day >= first) & (day < stop))
        period.write.parquet(f"{work}/incoming/period={number}")
        jobs.fraud_stream(stream, f"{work}/history", f"{work}/flags", f"{work}/checkpoint").awaitTermination()
    return _columns_of(S.FLAGS, spark.read.schema(S.FLAGS).parquet(f"{work}/flags"))


def run_last_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Flags arrive in three parts; the stream is stopped and started again between them."""
    work = shared_folder(spark, "last-flags")
    given = mapped.flags(spark, folder)
    part = F.pmod(F.xxhash64("user_id", "rule_label", "created_at"), F.lit(3))
    stream = spark.readStream.schema(S.FLAGS).option("maxBytesPerTrigger", BYTES_PER_BATCH).parquet(f"{work}/flags/part=*")
    for number in range(3):
        given.where(part == number).write.parquet(f"{work}/flags/part={number}")
        jobs.last_flag_stream(stream.select(*S.FLAGS.names), f"{work}/last", f"{work}/checkpoint").awaitTermination()
    return jobs.newest_flag_times(spark, f"{work}/last")


def run_hourly_counts(spark: SparkSession, folder: str) -> DataFrame:
    work = shared_folder(spark, "hourly")
    events = _event_files(spark, mapped.event_log(spark, folder), work)
    jobs.events_per_window(events, f"{work}/counts", f"{work}/checkpoint").awaitTermination()
    return jobs.newest_windows(spark, f"{work}/counts").select(F.col("start").alias("hour"), "event_type", "rows")


def run_deduplicated(spark: SparkSession, folder: str) -> DataFrame:
    """Every event is delivered twice; one of each comes out."""
    work = shared_folder(spark, "dedup")
    once = mapped.event_log(spark, folder)
    events = _event_files(spark, once.unionByName(once), work)
    jobs.deduplicated_stream(events, f"{work}/unique", f"{work}/seen", f"{work}/checkpoint").awaitTermination()
    return spark.read.schema(S.EVENTS).parquet(f"{work}/unique").select("user_id", "event_type", T, "context")


