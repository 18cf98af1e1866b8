"""The tables and files of this package, written from the test tables and read back."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennyflow import schemas as S
from pennyflow.operators.ingest import flatten_export
from pennyflow.plans import ml
from pennyflow.plans.boosts import boost_dataset
from pennyflow.session import shared_folder
from pennyflow.sources import export, mapped, tables


def event_table(spark: SparkSession, folder: str) -> DataFrame:
    """The event log, laid out by day."""
    path = shared_folder(spark, "events")
    tables.append_rows(mapped.event_log(spark, folder), path)
    return tables.read_events(spark, path)


def appended_events(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries, the first of them twice, with rows that cannot be inserted: rows taken by type and day, rows
    refused by reason."""
    path, log = shared_folder(spark, "appended"), mapped.event_log(spark, folder)
    t = F.col(tables.TIME)
    log = log.withColumns(
        {
            "user_id": F.when(t % 11 != 0, F.col("user_id")),
            "event_type": F.when(t % 13 != 0, F.col("event_type")),
            tables.TIME: F.when(t % 17 == 0, -t).otherwise(t),
        }
    )
    first = t % 2 == 0
    for name, rows in (("a", log.where(first)), ("b", log.where(~first)), ("a", log.where(first))):
        tables.append_once(rows, path, name, S.EVENTS)
    count = F.count(F.lit(1)).alias("rows")
    taken = tables.read_appended(spark, path, S.EVENTS).groupBy(F.col("event_type").alias("what"), F.col("event_date").cast("string").alias("day")).agg(count)
    refused = tables.read_refused(spark, path, S.EVENTS).select(F.explode("reasons").alias("what")).groupBy("what").agg(count)
    return taken.withColumn("taken", F.lit(True)).unionByName(refused.withColumn("taken", F.lit(False)), allowMissingColumns=True)


def behaviour_table(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "payments")
    tables.append_rows(mapped.behaviour(spark, folder), path)
    return tables.read_behaviour(spark, path)


def flag_table(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "flags")
    tables.append_flags(mapped.flags(spark, folder), path)
    return tables.read_flags(spark, path)


def csv_log(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV does not tell an empty context from a missing one; it is read as missing."""
    path = shared_folder(spark, "csv")
    log = mapped.event_log(spark, folder).select(*S.EVENTS.names)
    log.write.option("header", True).option("escape", '"').csv(path)
    return tables.read_events_csv(spark, path)


def export_files(spark: SparkSession, folder: str, now_ms: int, max_bad: int | None) -> DataFrame:
    """A day of the export: kept raw, loaded, flattened, written formatted and read again."""
    path = shared_folder(spark, "export")
    raw = export.archive_raw(mapped.export_lines(spark, folder), path, "2024-01-31")
    rows = flatten_export(export.load_ndjson(spark, raw, max_bad), now_ms)
    export.write_formatted_ndjson(rows, f"{path}/formatted")
    return spark.read.schema(S.EVENTS).json(f"{path}/formatted")


def feature_files(spark: SparkSession, folder: str, as_of: str) -> DataFrame:
    features = boost_dataset(mapped.event_log(spark, folder))
    written = tables.write_features_csv(features, shared_folder(spark, "features"), as_of)
    return spark.read.schema(features.schema).csv(written, header=True)


def training_log(result: DataFrame) -> DataFrame:
    spark, path = result.sparkSession, shared_folder(result.sparkSession, "training-log")
    tables.write_training_result(result, path)
    return spark.read.schema(result.schema).parquet(path)


def saved_model(spark: SparkSession, model: PipelineModel, as_of: str) -> PipelineModel:
    path = shared_folder(spark, "model")
    ml.save_model(model, path, as_of)
    return ml.load_model(path)
