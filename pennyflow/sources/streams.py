"""Streams of queued messages, from files or from a message broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennyflow import schemas as S


def _bounded(reader, files_per_batch: int | None, bytes_per_batch: int | None):
    """A batch takes so many files or bytes at most; without either, all that has come."""
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("maxBytesPerTrigger", bytes_per_batch) if bytes_per_batch else reader


def read_message_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """Message files, one base64 text per line."""
    return _bounded(spark.readStream, files_per_batch, bytes_per_batch).text(folder)


def read_event_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """Event rows as JSON files of the declared schema."""
    return _bounded(spark.readStream.schema(S.EVENTS), files_per_batch, bytes_per_batch).json(folder)


def read_broker_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Messages of a broker topic; needs the connector for it on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("value"))
