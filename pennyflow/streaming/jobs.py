"""The streams: queued messages to the event log, to money movements and to fraud flags.

Every job runs until its input is used up (``availableNow``) and goes on from its checkpoint when it
is started again. Files of a batch are written under the batch's number, so a batch that is repeated
after a failure replaces its own rows and no others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pennyflow import constants as C
from pennyflow import schemas as S
from pennyflow.operators.ingest import decode_messages, rejected_payments, stamp_events, to_behaviour
from pennyflow.session import ROCKS_DB, STATE_STORE
from pennyflow.sources.tables import drop_folder, existing, numbered, with_event_date
from pennyflow.streaming.running import take_batch

T = "time_transaction_occurred"


def _start(df: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _put(df: DataFrame, folder: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/batch={batch}")


# --- event log ---------------------------------------------------------------------------


def ingest_stream(messages: DataFrame, out: str, checkpoint: str, source: str, now_ms: int) -> StreamingQuery:
    """Messages to stamped events, appended by day of the event; undecodable text goes to ``bad``.

    Late messages are simply appended to the day they belong to. The file sink commits each batch
    once, even if it is repeated.
    """
    decoded = decode_messages(messages)
    rows = with_event_date(stamp_events(decoded.where("decoded"), source, now_ms))
    return (
        rows.writeStream.format("parquet")
        .partitionBy("event_date")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def bad_message_stream(messages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """The messages that could not be decoded, as they came."""
    bad = decode_messages(messages).where("NOT decoded").select("raw")
    return (
        bad.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# --- money movements ---------------------------------------------------------------------


def behaviour_stream(messages: DataFrame, out: str, rejected: str, checkpoint: str, now_ms: int) -> StreamingQuery:
    """A second reader of the same messages: payments to ``out``, the others with their reason to
    ``rejected``."""
    events = decode_messages(messages).where("decoded")

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # read by both writes
        _put(to_behaviour(batch, now_ms), out, number)
        _put(rejected_payments(batch), rejected, number)
        batch.unpersist()

    return _start(events, checkpoint, write)


# --- fraud flags -------------------------------------------------------------------------


def fraud_stream(
    payments: DataFrame, state: str, flags: str, checkpoint: str, buckets: int = 64
) -> StreamingQuery:
    """After each batch of payments, check the users in it against all that is known of them.

    Flags of earlier batches count as cut-offs, those of the batch itself do not, so a repeated
    batch comes to the same flags. The newest processing time so far serves as "now". What is known
    is kept as running facts (see `running`): a batch reads the state of its users' buckets and no
    earlier payments or flags.
    """
    return _start(
        payments.select(*S.BEHAVIOUR.names),
        checkpoint,
        lambda batch, number: take_batch(batch, number, state, flags, buckets),
    )


class LastFlag(StatefulProcessor):
    """The newest flag time of a user and rule; told again whenever it grows."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(frame["created_at"].max()) for frame in rows)
        if not self.last.exists() or newest > self.last.get()[0]:
            self.last.update((newest,))
            yield pd.DataFrame({"user_id": [key[0]], "rule_label": [key[1]], "last_flag_time": [newest]})

    def close(self) -> None:
        pass


def last_flag_stream(flags: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep the last flag time per user and rule as a value in the state store, which is on disk (RocksDB) and
    is restored from the checkpoint. Each batch writes what it changed, and a reader takes the largest time;
    times only grow, so a repeated batch does no harm."""
    last = flags.select("user_id", "rule_label", "created_at").groupBy("user_id", "rule_label").transformWithStateInPandas(
        LastFlag(), "user_id string, rule_label string, last_flag_time long", "Update", "None"
    )
    conf = flags.sparkSession.conf
    given = conf.get(STATE_STORE, None)
    conf.set(STATE_STORE, ROCKS_DB)  # the only store that keyed custom state can use; a query keeps what it starts with
    try:
        return (
            last.writeStream.outputMode("update")
            .foreachBatch(lambda batch, number: _put(batch, out, number))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set(STATE_STORE, given) if given else conf.unset(STATE_STORE)


def newest_flag_times(spark: SparkSession, out: str) -> DataFrame:
    rows = spark.read.schema("user_id string, rule_label string, last_flag_time long").parquet(out)
    return rows.groupBy("user_id", "rule_label").agg(F.max("last_flag_time").alias("last_flag_time"))


# --- counts and duplicates ---------------------------------------------------------------


COUNTS = "start long, event_type string, rows long"


def count_batch(batch: DataFrame, number: int, out: str, size: str, fold: int) -> None:
    """Write the counts of one batch, and fold all counts so far into one folder after every `fold` batches.

    A fold reads the fold before it and the batches since, and only then drops what the fold before it held. So a
    fold that died or is repeated finds all it needs, and there are never more than two folds and 2 * `fold` batches.
    """
    spark = batch.sparkSession
    counts = batch.groupBy(F.window(F.timestamp_millis(F.col(T)), size), "event_type").agg(F.count(F.lit(1)).alias("rows"))
    _put(counts.select(F.unix_millis("window.start").alias("start"), "event_type", "rows"), f"{out}/batches", number)
    if (number + 1) % fold:
        return
    before = number - fold
    newest_windows(spark, out, number).write.mode("overwrite").parquet(f"{out}/folds/upto={number}")
    for folder, name, last in ((f"{out}/batches", "batch", before), (f"{out}/folds", "upto", before - 1)):
        for old in numbered(spark, folder, name):
            if old <= last:
                drop_folder(spark, f"{folder}/{name}={old}")


def events_per_window(events: DataFrame, out: str, checkpoint: str, size: str = "1 hour", fold: int = 20) -> StreamingQuery:
    """Rows per tumbling window and event type. Each batch writes its own counts and readers add them up, so
    nothing is kept between batches and a row counts however late it comes."""
    return _start(events, checkpoint, lambda batch, number: count_batch(batch, number, out, size, fold))


def newest_windows(spark: SparkSession, out: str, upto: int | None = None) -> DataFrame:
    """The counts of all batches, or of those up to a number: the newest fold before it and the batches since."""
    batches = [n for n in numbered(spark, f"{out}/batches", "batch") if upto is None or n <= upto]
    folds = [n for n in numbered(spark, f"{out}/folds", "upto") if upto is None or n < upto]
    paths = [f"{out}/folds/upto={n}" for n in folds[-1:]] + [f"{out}/batches/batch={n}" for n in batches if not folds or n > folds[-1]]
    if not paths:
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).parquet(*paths).groupBy("start", "event_type").agg(F.sum("rows").alias("rows"))


def deduplicated_stream(events: DataFrame, out: str, seen: str, checkpoint: str) -> StreamingQuery:
    """Each event once, however often and late it is delivered. Off unless asked for: the event log itself
    keeps repeated deliveries.

    The time is a part of what makes two events the same, so an event can only be repeated within its own hour.
    `seen` holds digests of the events by hour and batch: a batch reads the hours that it has events of, and no
    others, and nothing is kept in memory or in a state store between batches. A batch looks at those before it
    only and replaces its own folders, so a repeated batch comes to the same rows.
    """
    digest = F.md5(F.to_json(F.struct("user_id", "event_type", T, "context"), {"ignoreNullFields": "false"}))
    hour = (F.col(T) / C.HOUR_MS).cast("long")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.withColumns({"digest": digest, "hour": F.coalesce(hour, F.lit(-1))}).dropDuplicates(["digest"])
        hours = [r["hour"] for r in batch.select(F.coalesce(hour, F.lit(-1)).alias("hour")).distinct().collect()]
        folders = existing(spark, [f"{seen}/hour={h}" for h in hours])
        if folders:
            known = spark.read.schema("digest string, hour long, batch long").option("basePath", seen).parquet(*folders)
            fresh = fresh.join(known.where(F.col("batch") < number).select("digest"), "digest", "left_anti")
        _put(fresh.drop("digest", "hour"), out, number)
        # the batch's own digests, from the rows that were written
        written = spark.read.schema(batch.schema).parquet(f"{out}/batch={number}")
        own = written.select(digest.alias("digest"), F.coalesce(hour, F.lit(-1)).alias("hour"), F.lit(number).alias("batch"))
        own = own.hint("rebalance", "hour")
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour", "batch").parquet(seen)

    return _start(events, checkpoint, write)
