"""Times the headline queries over whole tables and prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pennyflow.catalog import QUERIES
from pennyflow.session import build_session

HEADLINE = (
    "drop_off_users",
    "drop_off_daily_avg",
    "daily_metrics",
    "users_offered_boosts",
    "quick_withdrawal_pairs",
    "fraud_flags",
    "withdraw_then_save",
    "message_open_rate",
    "cohort_monthly",
    "late_savers_by_cohort",
    "boost_dataset",
    "boost_training_set",
    "score_input",
    "to_behaviour",
    "flatten_export",
    "ingest_stream",
)


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/events.parquet").groupBy("event_type").count().collect()  # start up
    times = {}
    for name in HEADLINE:
        times[name] = round(run(spark, name, folder), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", folder)
    result = {
        "metric": "seconds for the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
