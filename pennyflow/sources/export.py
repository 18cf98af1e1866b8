"""The app's daily export: hourly gzip files of one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennyflow import schemas as S
from pennyflow.operators.ingest import flatten_export, parse_export


class TooManyBadRecords(ValueError):
    pass


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of a day. Files need the ``.gz`` suffix to be unpacked while reading."""
    return spark.read.text(path)


def load_ndjson(spark: SparkSession, path: str, max_bad: int | None = 25) -> DataFrame:
    """Parsed lines without the bad ones; more than ``max_bad`` bad lines refuse the load, None takes any."""
    parsed = parse_export(read_export(spark, path))
    if max_bad is not None:
        bad = parsed.agg(F.count_if(F.col(S.BAD_RECORD).isNotNull())).first()[0]
        if bad > max_bad:
            raise TooManyBadRecords(f"{bad} unreadable lines in {path}, more than {max_bad}")
    return parsed.where(F.col(S.BAD_RECORD).isNull())


def export_to_events(spark: SparkSession, path: str, now_ms: int, max_bad: int | None = 25) -> DataFrame:
    return flatten_export(load_ndjson(spark, path, max_bad), now_ms)


def write_formatted_ndjson(df: DataFrame, path: str) -> None:
    """Rows as JSON lines, nulls kept; packed, as every line repeats the names of its fields."""
    df.write.mode("overwrite").option("ignoreNullFields", False).option("compression", "gzip").json(path)


def archive_raw(lines: DataFrame, folder: str, day: str) -> str:
    """Keep the raw lines of a day, packed, under ``day=yyyymmdd``."""
    target = f"{folder.rstrip('/')}/day={day.replace('-', '')}"
    lines.select("value").write.mode("overwrite").option("compression", "gzip").text(target)
    return target
