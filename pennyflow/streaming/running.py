"""Fraud facts kept up to date batch by batch, so that no batch reads the payments of earlier ones.

The state has four tables, each in folders of a batch and a bucket (a hash of the user):

- `rows`: payments of the last thirty days, as pairs of savings and withdrawals are counted over them;
- `days`: per user and day before that, counts and sums of savings after the user's cut-offs;
- `users`: per user the newest account and saving, and the five cut-offs;
- `marks`: after batch n, which batch holds each bucket, and the newest processing time so far.

A batch reads the buckets of its own users from where the mark of the batch before points, and writes those buckets
anew under its own number; all others stay where they are. The mark is written last. So a batch that is repeated starts
from the same mark and comes to the same rows, and one that died half-way has left nothing that anybody reads.

Why days are enough: a new cut-off is the processing time of its batch, and times only grow here ("now" is the newest
processing time so far). It lies after all days that are summed up, so it drops them whole; a cut-off from before a day
was summed up has been applied row by row. Late rows meet the cut-offs of the batch that brings them.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow import schemas as S
from pennyflow.functions.money import PER_CURRENCY, whole_currency
from pennyflow.operators.filters import after_cutoff, amount_above, transaction_is
from pennyflow.operators.pairs import matching_pairs
from pennyflow.plans.fraud import evaluate_rules, quick_withdrawal_cases
from pennyflow.timebox import day_start, days_before, months_before

USER, T = "user_id", "time_transaction_occurred"
CUTS = {label: f"cut_{i}" for i, label in enumerate(C.RULE_LABELS)}
ROWS = f"{USER} string, account_id string, transaction_type string, amount long, {T} long"
SUMS = ("very_large", "large", "saves", "saved")
TABLES = {
    "rows": ROWS,
    "days": f"{USER} string, day long, " + ", ".join(f"{c} long" for c in SUMS),
    "users": f"{USER} string, account struct<t: long, id: string>, newest struct<t: long, amount: long>, "
    + ", ".join(f"{c} long" for c in CUTS.values()),
}
MARK = "bucket long, batch long, now long"


def bucket_of(user: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("long")


# --- where the state is ------------------------------------------------------------------


def read_mark(spark: SparkSession, state: str, batch: int) -> tuple[dict[int, int], int | None]:
    """Which batch holds each bucket after `batch`, a row per bucket; and the newest processing time."""
    if batch < 0:
        return {}, None
    rows = spark.read.schema(MARK).parquet(f"{state}/marks/batch={batch}").collect()
    return {r["bucket"]: r["batch"] for r in rows if r["bucket"] is not None}, max((r["now"] for r in rows if r["now"] is not None), default=None)


def write_mark(spark: SparkSession, state: str, batch: int, holders: dict[int, int], now: int | None) -> None:
    rows = [(b, k, now) for b, k in sorted(holders.items())] or [(None, None, now)]
    spark.createDataFrame(rows, MARK).coalesce(1).write.mode("overwrite").parquet(f"{state}/marks/batch={batch}")


def read_state(spark: SparkSession, state: str, table: str, holders: dict[int, int], buckets: Iterable[int]) -> DataFrame:
    """The rows of a table in these buckets, each from the batch that holds it."""
    by_batch: dict[int, list[int]] = {}
    for bucket in buckets:
        if bucket in holders:
            by_batch.setdefault(holders[bucket], []).append(bucket)
    if not by_batch:
        return spark.createDataFrame([], TABLES[table])
    paths = [f"{state}/{table}/batch={batch}" for batch in by_batch]
    found = spark.read.schema(f"{TABLES[table]}, batch long, bucket long").option("basePath", f"{state}/{table}").parquet(*paths)
    held = [(F.col("batch") == batch) & F.col("bucket").isin(own) for batch, own in by_batch.items()]
    return found.where(held[0] if len(held) == 1 else F.array_contains(F.array(*held), True)).drop("batch", "bucket")


def write_state(df: DataFrame, state: str, table: str, batch: int, buckets: int) -> None:
    placed = df.withColumn("bucket", bucket_of(F.col(USER), buckets)).hint("rebalance", "bucket")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{state}/{table}/batch={batch}")


# --- facts -------------------------------------------------------------------------------


def _uncut(label: str, t: str = T) -> Column:
    return after_cutoff(F.col(CUTS[label]), t)


def summed_days(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Savings by user and day, after the cut-offs of the user."""
    saving = transaction_is(C.SAVING)
    after = saving & _uncut(C.RULE_ABOVE_AVERAGE)
    known = rows.join(users.select(USER, *CUTS.values()), USER, "left")
    return known.groupBy(USER, (F.col(T) - F.pmod(F.col(T), F.lit(C.DAY_MS))).alias("day")).agg(
        F.count_if(saving & amount_above(C.VERY_LARGE_SAVE) & _uncut(C.RULE_VERY_LARGE)).alias("very_large"),
        F.count_if(saving & amount_above(C.LARGE_SAVE) & _uncut(C.RULE_SEVERAL_LARGE)).alias("large"),
        F.count_if(after).alias("saves"),
        F.coalesce(F.sum(F.when(after, F.col("amount"))), F.lit(0).cast("long")).alias("saved"),
    )


def newest_of_users(known: DataFrame, fresh: DataFrame) -> DataFrame:
    """`users` with the accounts and savings of the fresh rows."""
    none = F.lit(None).cast("long")
    own = fresh.select(
        USER,
        F.struct(F.col(T).alias("t"), F.col("account_id").alias("id")).alias("account"),
        F.when(transaction_is(C.SAVING), F.struct(F.col(T).alias("t"), "amount")).alias("newest"),
        *[none.alias(c) for c in CUTS.values()],
    )
    return known.unionByName(own).groupBy(USER).agg(*[F.max(c).alias(c) for c in ("account", "newest", *CUTS.values())])


def running_facts(rows: DataFrame, days: DataFrame, users: DataFrame, as_of: date) -> DataFrame:
    """The six facts of the users in `users`, as `fraud_facts` has them over all their payments."""
    half_year = day_start(months_before(as_of, 6))
    saving = transaction_is(C.SAVING)
    # A day's sums hold while the cut-off lies before its end.
    holds = lambda label: _uncut(label, "day_end")
    counted = days.withColumn("day_end", F.col("day") + C.DAY_MS).join(users.select(USER, *CUTS.values()), USER)
    in_half = F.col("day") >= half_year
    old = counted.groupBy(USER).agg(
        F.sum(F.when(holds(C.RULE_VERY_LARGE), F.col("very_large"))).alias("very_large"),
        F.sum(F.when(in_half & holds(C.RULE_SEVERAL_LARGE), F.col("large"))).alias("large"),
        F.sum(F.when(in_half & holds(C.RULE_ABOVE_AVERAGE), F.col("saves"))).alias("saves"),
        F.sum(F.when(in_half & holds(C.RULE_ABOVE_AVERAGE), F.col("saved"))).alias("saved"),
    )
    known = rows.join(users.select(USER, *CUTS.values()), USER)
    recent = F.col(T) >= half_year
    new = known.groupBy(USER).agg(
        F.count_if(saving & amount_above(C.VERY_LARGE_SAVE) & _uncut(C.RULE_VERY_LARGE)).alias("very_large"),
        F.count_if(saving & amount_above(C.LARGE_SAVE) & recent & _uncut(C.RULE_SEVERAL_LARGE)).alias("large"),
        F.count_if(saving & recent & _uncut(C.RULE_ABOVE_AVERAGE)).alias("saves"),
        F.sum(F.when(saving & recent & _uncut(C.RULE_ABOVE_AVERAGE), F.col("amount"))).alias("saved"),
    )
    both = old.unionByName(new).groupBy(USER).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in SUMS])
    cases = quick_withdrawal_cases(as_of)
    month = known.where(F.col(T) >= day_start(days_before(as_of, 30)))
    pairs = matching_pairs(month, cases)
    pairs = pairs.groupBy(USER).agg(*[F.sum(F.when(F.col("case") == c.name, F.col("pairs"))).alias(c.name) for c in cases])
    zero = F.lit(0).cast("long")
    latest = F.when(_uncut(C.RULE_ABOVE_AVERAGE, "newest.t"), F.col("newest.amount"))
    average = F.when(F.col("saves") > 0, F.col("saved").cast("double") / F.col("saves")).otherwise(F.lit(0.0))
    return (
        users.join(both, USER, "left")
        .join(pairs, USER, "left")
        .select(
            USER,
            F.col("account.id").alias("account_id"),
            F.coalesce("very_large", zero).alias("saves_above_100k"),
            F.coalesce("large", zero).alias("saves_above_50k_6m"),
            whole_currency(latest).alias("latest_save"),
            (F.coalesce(average, F.lit(0.0)) / PER_CURRENCY * C.AVERAGE_MULTIPLIER).alias("average_save_6m_x10"),
            *[F.coalesce(F.col(c.name), zero).alias(c.name) for c in cases],
        )
    )


def take_batch(batch: DataFrame, number: int, state: str, flags: str, buckets: int) -> None:
    """Bring the state from batch `number` - 1 to `number` and write the flags of the batch's users."""
    spark = batch.sparkSession
    holders, before = read_mark(spark, state, number - 1)
    path = f"{flags}/batch={number}"
    names = [f.split()[0] for f in ROWS.split(", ")]
    batch = batch.persist()  # read by every step below
    touched = batch.agg(F.max("created_at"), F.collect_set(bucket_of(F.col(USER), buckets))).first()  # a number per bucket at most
    now, mine = max((t for t in (touched[0], before) if t is not None), default=None), sorted(touched[1])
    if not mine:  # later batches read this one's mark, and readers its folder of flags
        spark.createDataFrame([], S.FLAGS).write.mode("overwrite").parquet(path)
        write_mark(spark, state, number, holders, now)
        batch.unpersist()
        return
    as_of = datetime.fromtimestamp(now / 1000, timezone.utc).date()
    kept_from = day_start(days_before(as_of, 30))
    old = {table: read_state(spark, state, table, holders, mine) for table in TABLES}
    fresh = batch.select(*names)
    rows = old["rows"].unionByName(fresh)
    days = old["days"].unionByName(summed_days(rows.where(F.col(T) < kept_from), old["users"]))
    days = days.groupBy(USER, "day").agg(*[F.sum(c).alias(c) for c in SUMS])
    days = days.where((F.col("day") >= day_start(months_before(as_of, 6))) | (F.col("very_large") > 0))
    users = newest_of_users(old["users"], fresh)
    write_state(rows.where(F.col(T) >= kept_from), state, "rows", number, buckets)
    write_state(days, state, "days", number, buckets)
    # What has been written is read again, so that the facts do not repeat the steps above.
    stand = {b: number for b in mine}
    now_rows, now_days = (read_state(spark, state, table, stand, mine) for table in ("rows", "days"))
    asked = users.join(fresh.select(USER).distinct(), USER, "left_semi")
    found = evaluate_rules(running_facts(now_rows, now_days, asked, as_of), now)
    found.write.mode("overwrite").parquet(path)
    flagged = spark.read.schema(S.FLAGS).parquet(path)
    cut = flagged.groupBy(USER).agg(*[F.max(F.when(F.col("rule_label") == label, F.col("created_at"))).alias(f"new_{c}") for label, c in CUTS.items()])
    users = users.join(cut, USER, "left").select(USER, "account", "newest", *[F.greatest(c, f"new_{c}").alias(c) for c in CUTS.values()])
    write_state(users, state, "users", number, buckets)
    write_mark(spark, state, number, {**holders, **stand}, now)
    batch.unpersist()
