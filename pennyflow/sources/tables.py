"""Scans and sinks of the declared tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pennyflow import schemas as S

TIME = "time_transaction_occurred"


def _scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType(schema.fields + [T.StructField("event_date", T.DateType())])).parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, S.EVENTS)


def read_behaviour(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, S.BEHAVIOUR)


def read_flags(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.FLAGS).parquet(path)


def read_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """The event log as CSV with a header; quotes inside the JSON context are doubled and an empty
    context is read as missing."""
    return spark.read.schema(S.EVENTS).csv(path, header=True, escape='"', multiLine=False)


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "event_date", F.to_date(F.timestamp_millis("time_transaction_occurred"))
    )


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that are there, in whatever store they name."""
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    return [p for p in paths if path(p).getFileSystem(conf).exists(path(p))]


def numbered(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The numbers of the finished folders `name=number` in a folder, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath().getName() for f in store.listStatus(path)] if store.exists(path) else []
    numbers = sorted(int(f.split("=")[1]) for f in found if f.startswith(f"{name}="))
    done = set(existing(spark, [f"{folder}/{name}={n}/_SUCCESS" for n in numbers]))
    return [n for n in numbers if f"{folder}/{name}={n}/_SUCCESS" in done]


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def refusals(schema: T.StructType) -> Column:
    """Why a row cannot be inserted: each required field that is missing, and a time that is none. Empty if it can."""
    missing = [F.when(F.col(f.name).isNull(), F.lit(f"no {f.name}")) for f in schema.fields if not f.nullable]
    return F.array_compact(F.array(*missing, F.when(F.col(TIME) <= 0, F.lit(f"{TIME} is not a time"))))


def append_once(df: DataFrame, path: str, append_id: str, schema: T.StructType) -> tuple[int, int]:
    """Insert the rows of one delivery, whole or not at all; returns how many were taken and how many refused.

    The rows are written under the id of the delivery, refused ones with their reasons beside them, and become part of
    the table when the id is published, which is the last step. A delivery that is already published changes nothing;
    one that died before is written anew over what it left.
    """
    spark, published = df.sparkSession, f"{path}/published/append={append_id}"
    if not existing(spark, [f"{published}/_SUCCESS"]):
        checked = df.select(*schema.names, refusals(schema).alias("reasons"))
        whole = with_event_date(checked.where(F.size("reasons") == 0)).drop("reasons")
        whole.write.mode("overwrite").partitionBy("event_date").parquet(f"{path}/data/append={append_id}")
        checked.where(F.size("reasons") > 0).write.mode("overwrite").parquet(f"{path}/refused/append={append_id}")
        # counted from what was written, not from the rows as they came
        count = F.count(F.lit(1))
        taken = spark.read.schema(schema).parquet(f"{path}/data/append={append_id}").agg(count.alias("taken"))
        refused = spark.read.schema("reasons array<string>").parquet(f"{path}/refused/append={append_id}").agg(count.alias("refused"))
        counts = [(taken.first()[0], refused.first()[0])]
        spark.createDataFrame(counts, "taken long, refused long").coalesce(1).write.mode("overwrite").parquet(published)
    row = spark.read.schema("taken long, refused long").parquet(published).first()
    return row["taken"], row["refused"]


def _ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("taken long, refused long, append string").parquet(f"{path}/published").select("append")


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all published deliveries, with the day they are laid out by."""
    placed = T.StructType([*schema.fields, T.StructField("append", T.StringType()), T.StructField("event_date", T.DateType())])
    return spark.read.schema(placed).parquet(f"{path}/data").join(_ids(spark, path), "append", "left_semi")


def read_refused(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What published deliveries could not insert, with the reasons."""
    loose = [T.StructField(f.name, f.dataType) for f in schema.fields]
    placed = T.StructType([*loose, T.StructField("reasons", T.ArrayType(T.StringType())), T.StructField("append", T.StringType())])
    return spark.read.schema(placed).parquet(f"{path}/refused").join(_ids(spark, path), "append", "left_semi")


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a table laid out by day of the event."""
    with_event_date(df).write.mode("append").partitionBy("event_date").parquet(path)


def append_flags(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_features_csv(df: DataFrame, folder: str, as_of: date | str) -> str:
    """Features of a run, in a folder named by its date; returns the folder."""
    target = f"{folder.rstrip('/')}/features_{as_of}"
    df.write.mode("overwrite").option("header", True).csv(target)
    return target


def write_training_result(result: DataFrame, path: str) -> None:
    """Append the figures of one training run."""
    result.write.mode("append").parquet(path)
