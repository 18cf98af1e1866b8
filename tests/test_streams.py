import base64
import json
import random
import shutil
from datetime import datetime, timezone

import pytest

from pennyflow import constants as C
from pennyflow import schemas as S
from pennyflow.plans.fraud import fraud_flags
from pennyflow.sources import tables
from pennyflow.sources.streams import read_event_stream, read_message_stream
from pennyflow.streaming import jobs, running
from pennyflow.timebox import day_start

DAY = C.DAY_MS
START = day_start("2024-01-10")


def message(user, event_type="SAVING_PAYMENT_SUCCESSFUL", t=START, context="{}"):
    row = {"user_id": user, "event_type": event_type, "time_transaction_occurred": t, "context": context}
    return base64.b64encode(json.dumps([row]).encode()).decode()


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))


def table(spark, path, schema):
    return sorted(tuple(r) for r in spark.read.schema(schema).parquet(str(path)).select(*schema.names).collect())


def test_ingest_goes_on_where_it_stopped(spark, tmp_path):
    put(tmp_path / "in", "1", [message("a"), message("b", t=START + DAY), "garbage"])

    def run():
        messages = read_message_stream(spark, str(tmp_path / "in"), files_per_batch=1)
        jobs.ingest_stream(messages, str(tmp_path / "log"), str(tmp_path / "cp"), "INTERNAL_SERVICES", 7).awaitTermination()
        jobs.bad_message_stream(messages, str(tmp_path / "bad"), str(tmp_path / "cp_bad")).awaitTermination()
        return table(spark, tmp_path / "log", S.EVENTS)

    assert [r[0] for r in run()] == ["a", "b"]
    put(tmp_path / "in", "2", [message("late", t=START - 9 * DAY), message("a")])  # late, and delivered again
    assert [r[0] for r in run()] == ["a", "a", "b", "late"]
    assert [r[0] for r in run()] == ["a", "a", "b", "late"]
    assert [r["raw"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["garbage"]
    assert {p.name for p in (tmp_path / "log").glob("event_date=*")} == {
        "event_date=2024-01-01",
        "event_date=2024-01-10",
        "event_date=2024-01-11",
    }


def test_payments_are_split_from_what_cannot_be_one(spark, tmp_path):
    good = '{"accountId":"a1","savedAmount":"1::WHOLE_CURRENCY::ZAR"}'
    lines = [message("a", context=good), message("b", "RANDOM", context=good), message("c"), message("d", "WITHDRAWAL_EVENT_CONFIRMED", context=good)]
    put(tmp_path / "in", "1", lines)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    jobs.behaviour_stream(read_message_stream(spark, str(tmp_path / "in")), out, bad, str(tmp_path / "cp"), 7).awaitTermination()
    assert [(r[0], r[2], r[3]) for r in table(spark, out, S.BEHAVIOUR)] == [("a", C.SAVING, 10_000), ("d", C.WITHDRAWAL, 10_000)]
    reasons = {r["user_id"]: r["reject_reason"] for r in spark.read.parquet(bad).collect()}
    assert reasons == {"b": "unsupported event type", "c": "no account"}


def test_fraud_stream_equals_batches(spark, payments, tmp_path):
    batches = [
        [("big", C.SAVING, 200_000, START), ("calm", C.SAVING, 1, START)],
        [("big", C.SAVING, 1, START + DAY), ("other", C.SAVING, 300_000, START + DAY)],
        [("big", C.SAVING, 150_000, START + 2 * DAY)],
    ]
    history, flags = str(tmp_path / "history"), str(tmp_path / "flags")
    known, given = [], spark.createDataFrame([], S.FLAGS)
    for i, moves in enumerate(batches):
        payments(moves).write.parquet(str(tmp_path / "in" / f"part={i}"))
        stream = spark.readStream.schema(S.BEHAVIOUR).parquet(str(tmp_path / "in" / "part=*"))
        jobs.fraud_stream(stream.select(*S.BEHAVIOUR.names), history, flags, str(tmp_path / "cp")).awaitTermination()
        known += moves
        now = max(m[3] for m in moves)
        users = [m[0] for m in moves]
        mine = payments([k for k in known if k[0] in users])
        fresh = fraud_flags(mine, given, f"2024-01-{10 + i}", now)
        given = spark.createDataFrame([tuple(r) for r in given.collect()] + [tuple(r) for r in fresh.collect()], S.FLAGS)
    got = table(spark, flags, S.FLAGS)
    assert got == sorted(tuple(r) for r in given.collect())
    by_user = sorted((r[0], r[2], r[5]) for r in got)
    # the first flag cuts off the first large save, the third save is flagged anew
    assert by_user == sorted([
        ("big", C.NOT_FLAGGED, START + DAY),
        ("big", C.RULE_VERY_LARGE, START),
        ("big", C.RULE_VERY_LARGE, START + 2 * DAY),
        ("calm", C.NOT_FLAGGED, START),
        ("other", C.RULE_VERY_LARGE, START + DAY),
    ])


def put_payments(spark, payments, folder, number, moves):
    payments(moves).coalesce(1).write.parquet(f"{folder}/part={number}")
    return spark.readStream.schema(S.BEHAVIOUR).parquet(f"{folder}/part=*").select(*S.BEHAVIOUR.names)


def flags_by_batches(spark, payments, batches):
    """Every batch judged over all payments so far, with the flags of earlier batches as cut-offs."""
    known, given, now = [], [], None
    for moves in batches:
        known += moves
        if not moves:
            continue
        now = max(max(m[3] for m in moves), now or 0)
        mine = payments([k for k in known if k[0] in {m[0] for m in moves}])
        earlier = spark.createDataFrame(given, S.FLAGS)
        given += [tuple(r) for r in fraud_flags(mine, earlier, datetime.fromtimestamp(now / 1000, timezone.utc).date(), now).collect()]
    return sorted(given)


def random_batches(n, seed):
    """Half a year and more of payments of few users, some of them late, with large savings and quick withdrawals."""
    rnd = random.Random(seed)
    batches = []
    for k in range(n):
        moves, day = [], START + k * 45 * DAY
        for _ in range(rnd.randrange(1, 30)):
            late = rnd.choice([0, 0, 0, 1, 40 * DAY, 200 * DAY])
            kind = rnd.choice([C.SAVING, C.SAVING, C.WITHDRAWAL])
            amount = rnd.choice([100, 100, 98, 60_000, 60_000, 120_000])
            moves.append((rnd.choice("abcd"), kind, amount, day - late - rnd.randrange(3 * DAY)))
        batches.append(moves)
    return batches


def test_running_facts_equal_whole_history(spark, payments, tmp_path):
    batches = random_batches(6, 5)
    batches.insert(3, [])
    state, flags, checkpoint = str(tmp_path / "state"), str(tmp_path / "flags"), str(tmp_path / "cp")
    for i, moves in enumerate(batches):
        stream = put_payments(spark, payments, tmp_path / "in", i, moves)
        jobs.fraud_stream(stream, state, flags, checkpoint, buckets=3).awaitTermination()
    got = table(spark, flags, S.FLAGS)
    assert got == flags_by_batches(spark, payments, batches)
    assert {r[2] for r in got} >= {C.RULE_VERY_LARGE, C.RULE_SEVERAL_LARGE, C.RULE_TWO_DAYS, C.NOT_FLAGGED}


def test_repeated_batch_changes_nothing_and_old_batches_are_not_read(spark, payments, tmp_path):
    batches = random_batches(4, 9)
    state, flags = str(tmp_path / "state"), str(tmp_path / "flags")
    for number, moves in enumerate(batches):
        running.take_batch(payments(moves), number, state, flags, 2)
        once = [table(spark, flags, S.FLAGS), *(sorted(map(str, spark.read.parquet(f"{state}/{t}/batch={number}").collect())) for t in running.TABLES)]
        running.take_batch(payments(moves), number, state, flags, 2)
        again = [table(spark, flags, S.FLAGS), *(sorted(map(str, spark.read.parquet(f"{state}/{t}/batch={number}").collect())) for t in running.TABLES)]
        assert once == again
        if number >= 2:  # all of an earlier batch may go; what still counts stands in later ones
            holders, _ = running.read_mark(spark, state, number)
            for old in set(range(number)) - set(holders.values()):
                for name in (*running.TABLES, "marks"):
                    shutil.rmtree(f"{state}/{name}/batch={old}", ignore_errors=True)
    assert table(spark, flags, S.FLAGS) == flags_by_batches(spark, payments, batches)


def test_fraud_stream_goes_on_after_an_empty_batch(spark, payments, tmp_path):
    history, flags = str(tmp_path / "history"), str(tmp_path / "flags")
    for i, moves in enumerate([[], [("big", C.SAVING, 200_000, START)]]):
        payments(moves).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={i}"))
        stream = spark.readStream.schema(S.BEHAVIOUR).parquet(str(tmp_path / "in" / "part=*"))
        jobs.fraud_stream(stream.select(*S.BEHAVIOUR.names), history, flags, str(tmp_path / "cp")).awaitTermination()
    assert [r[2] for r in table(spark, flags, S.FLAGS)] == [C.RULE_VERY_LARGE]


@pytest.fixture
def event_files(events, tmp_path):
    def write(*parts):
        for i, part in enumerate(parts):
            events(part).coalesce(1).write.mode("append").json(str(tmp_path / "events"))
        return str(tmp_path / "events")

    return write


def test_hourly_counts_take_late_rows(spark, event_files, tmp_path):
    folder = event_files([("a", "E", START), ("a", "E", START + 3_600_000)], [("b", "E", START + 5)])
    out = str(tmp_path / "counts")
    jobs.events_per_window(read_event_stream(spark, folder, 1), out, str(tmp_path / "cp")).awaitTermination()
    got = sorted(tuple(r) for r in jobs.newest_windows(spark, out).collect())
    assert got == [(START, "E", 2), (START + 3_600_000, "E", 1)]


def test_counts_are_folded(spark, events, tmp_path):
    """Few folders stay however many batches there were; a repeated batch or fold changes nothing."""
    out, want = str(tmp_path / "counts"), 0
    for number in range(9):
        batch = events([("a", "E", START + i * 3_600_000) for i in range(number % 3 + 1)])
        want += number % 3 + 1
        for _ in range(2 if number in (4, 5, 8) else 1):
            jobs.count_batch(batch, number, out, "1 hour", 3)
        assert sum(r["rows"] for r in jobs.newest_windows(spark, out).collect()) == want
        assert len(tables.numbered(spark, f"{out}/batches", "batch")) <= 6 and len(tables.numbered(spark, f"{out}/folds", "upto")) <= 2
    got = sorted(tuple(r) for r in jobs.newest_windows(spark, out).collect())
    assert got == [(START, "E", 9), (START + 3_600_000, "E", 6), (START + 7_200_000, "E", 3)]


def test_duplicates_within_and_across_batches(spark, event_files, tmp_path):
    row, other = ("a", "E", START), ("a", "E", START + 1)
    folder = event_files([row, row], [row, other])
    out = str(tmp_path / "unique")
    jobs.deduplicated_stream(read_event_stream(spark, folder, 1), out, str(tmp_path / "seen"), str(tmp_path / "cp")).awaitTermination()
    assert [r[2] for r in table(spark, out, S.EVENTS)] == [START, START + 1]


def test_rows_behind_all_others_are_kept(spark, event_files, tmp_path):
    late = ("b", "E", START - 500 * DAY)
    folder = event_files([("a", "E", START)], [("a", "E", START + 1)], [late], [late])
    out, unique = str(tmp_path / "counts"), str(tmp_path / "unique")
    jobs.events_per_window(read_event_stream(spark, folder, 1), out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(tuple(r) for r in jobs.newest_windows(spark, out).collect()) == [(late[2], "E", 2), (START, "E", 2)]
    jobs.deduplicated_stream(read_event_stream(spark, folder, 1), unique, str(tmp_path / "seen"), str(tmp_path / "cp2")).awaitTermination()
    assert [r[2] for r in table(spark, unique, S.EVENTS)] == [START, START + 1, late[2]]


def test_duplicates_over_any_delay(spark, event_files, tmp_path):
    """Every event comes up to three times, up to months apart; a batch opens the hours of its own events only."""
    rnd = random.Random(3)
    parts = [[] for _ in range(4)]
    for _ in range(60):
        row = (rnd.choice("abc"), rnd.choice(["E", "F"]), START + rnd.randrange(6) * 7 * DAY + rnd.randrange(4), "S", rnd.choice([None, "", "{}"]))
        for _ in range(rnd.randrange(1, 4)):
            rnd.choice(parts).append(row)
    folder, out, seen = event_files(*parts), str(tmp_path / "unique"), tmp_path / "seen"
    jobs.deduplicated_stream(read_event_stream(spark, folder, 1), out, str(seen), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.schema(S.EVENTS).parquet(out).select("user_id", "event_type", "time_transaction_occurred", "context")
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == sorted({(r[0], r[1], r[2], r[4]) for part in parts for r in part}, key=str)
    assert len(list(seen.glob("hour=*"))) == len({r[2] // C.HOUR_MS for part in parts for r in part})
    assert spark.read.parquet(str(seen)).count() == len(got)  # one digest an event, and no state beside


def test_last_flags_after_restarts(spark, tmp_path):
    rnd, rows = random.Random(8), []
    out, checkpoint = str(tmp_path / "last"), str(tmp_path / "cp")
    for part in range(3):
        fresh = [(rnd.choice("ab"), "acc", rnd.choice(C.RULE_LABELS[:2]), "r", "P", rnd.randrange(1000), 0) for _ in range(6)]
        rows += fresh
        spark.createDataFrame(fresh, S.FLAGS).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={part}"))
        stream = spark.readStream.schema(S.FLAGS).parquet(str(tmp_path / "in" / "part=*")).select(*S.FLAGS.names)
        jobs.last_flag_stream(stream, out, checkpoint).awaitTermination()
    newest = {}
    for r in rows:
        newest[r[0], r[2]] = max(r[5], newest.get((r[0], r[2]), 0))
    told = spark.read.schema("user_id string, rule_label string, last_flag_time long").parquet(out)
    assert {(r[0], r[1]): r[2] for r in jobs.newest_flag_times(spark, out).collect()} == newest
    # after a restart a value is told again only if it grew
    assert told.groupBy("user_id", "rule_label", "last_flag_time").count().where("count > 1").count() == 0


def test_shared_folder_is_the_clusters(spark):
    from pennyflow.session import CHECKPOINT_SETTING, shared_folder

    before = spark.conf.get(CHECKPOINT_SETTING, None)
    if before:
        assert shared_folder(spark, "x").startswith(before)
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
