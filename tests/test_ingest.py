import base64
import gzip
import json

import pytest
from pyspark.sql import functions as F

from pennyflow import schemas as S
from pennyflow.operators import ingest
from pennyflow.plans.metrics import users_by_event
from pennyflow.sources import export, tables
from pennyflow.timebox import Window, day_start

# An invented line of the app's export, shortened to what differs from null.
LINE = {name: None for name in S.EXPORT_FIELDS} | {
    "client_event_time": "2021-03-05 06:07:08.090000",
    "$insert_id": "insert-1",
    "$schema": 12,
    "app": 4711,
    "user_id": "user-one",
    "event_type": "USER_OPENED_APP",
    "is_attribution_event": False,
    "paying": None,
    "amplitude_id": 9001,
    "session_id": 1614924428090,
    "location_lat": 1.5,
    "city": "null",
    "processed_time": "left out",
}


def flatten(spark, *lines, now=7):
    text = spark.createDataFrame([(line if isinstance(line, str) else json.dumps(line),) for line in lines], "value string")
    parsed = ingest.parse_export(text)
    return ingest.flatten_export(parsed, now).collect(), [r[0] for r in ingest.bad_export_lines(parsed).collect()]


def test_export_line(spark):
    (row,), bad = flatten(spark, LINE)
    assert bad == []
    assert row.asDict() | {"context": None} == {
        "user_id": "user-one",
        "event_type": "USER_OPENED_APP",
        "time_transaction_occurred": 1614924428090,
        "source_of_event": "AMPLITUDE",
        "created_at": 7,
        "updated_at": 7,
        "context": None,
    }
    context = json.loads(row["context"])
    assert list(context) == [f.lstrip("$") for f in S.EXPORT_FIELDS] + ["reference_time", "event_properties"]
    assert context["paying"] is False and context["city"] is None and context["app"] == 4711
    assert context["reference_time"] == "2021-03-05 06:07:08.090000" and context["event_properties"] == []


def test_export_properties_keep_their_types(spark):
    line = LINE | {
        "user_properties": {"plan": "gold"},
        "event_properties": {"yes": True, "no": False, "text": "true", "n": 3, "null": None, "deep": {"a": [1]}},
        "groups": {},
    }
    (row,), _ = flatten(spark, line)
    got = [(p["property_type"], p["key"], p["value"]) for p in json.loads(row["context"])["event_properties"]]
    assert got == [
        ("event_properties", "yes", "True"),
        ("event_properties", "no", "False"),
        ("event_properties", "text", "true"),
        ("event_properties", "n", 3),
        ("event_properties", None, None),
        ("event_properties", "deep", {"a": [1]}),
        ("user_properties", "plan", "gold"),
    ]


def test_export_without_a_user_falls_back_to_the_device(spark):
    rows, _ = flatten(spark, LINE | {"user_id": None}, LINE | {"user_id": "null"})
    assert [r["user_id"] for r in rows] == ["9001"] * 2
    assert json.loads(rows[0]["context"])["user_id"] == "9001"


def test_bad_export_lines_do_not_stop_the_others(spark):
    rows, bad = flatten(spark, LINE, '{"user_id": "x', "null", "", LINE)
    assert len(rows) == 2 and sorted(bad) == ["", "null", '{"user_id": "x']


def test_no_line_is_lost_for_an_unusual_type(spark):
    odd = {"session_id": "null", "event_id": "null", "paying": "null", "app": "240", "location_lat": "null", "groups": "x"}
    rows, bad = flatten(spark, *[LINE | {k: v} for k, v in odd.items()], LINE | {"city": {"deep": [1]}}, "[1]")
    assert len(rows) == 7 and bad == ["[1]"]
    contexts = [json.loads(r["context"]) for r in rows]
    assert [contexts[0]["session_id"], contexts[1]["event_id"], contexts[4]["location_lat"]] == [None] * 3
    assert contexts[2]["paying"] is False and contexts[3]["app"] == "240" and contexts[6]["city"] == {"deep": [1]}


def test_load_refuses_too_many_bad_lines(spark, tmp_path):
    with gzip.open(tmp_path / "hour1.json.gz", "wt") as f:
        f.write("\n".join([json.dumps(LINE)] * 3 + ["{broken"] * 2))
    assert export.load_ndjson(spark, str(tmp_path / "*.json.gz"), max_bad=2).count() == 3
    with pytest.raises(export.TooManyBadRecords):
        export.load_ndjson(spark, str(tmp_path / "*.json.gz"), max_bad=1)


def test_export_round_trip_of_files(spark, tmp_path):
    with gzip.open(tmp_path / "hour1.json.gz", "wt") as f:
        f.write(json.dumps(LINE))
    source = str(tmp_path / "hour1.json.gz")
    kept = export.archive_raw(export.read_export(spark, source), str(tmp_path / "raw"), "2021-03-05")
    assert kept.endswith("day=20210305") and spark.read.text(kept).count() == 1
    rows = export.export_to_events(spark, source, 7)
    export.write_formatted_ndjson(rows, str(tmp_path / "formatted"))
    again = spark.read.schema(S.EVENTS).json(str(tmp_path / "formatted"))
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in rows.collect()]


def test_formatted_export_is_packed(spark, tmp_path):
    rows = spark.range(200).selectExpr("cast(id AS string) AS user_id", "repeat('same text ', 50) AS context", "cast(null AS string) AS empty")
    export.write_formatted_ndjson(rows.coalesce(1), str(tmp_path / "formatted"))
    files = list((tmp_path / "formatted").glob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < 200 * 500 / 10
    again = spark.read.schema(rows.schema).json(str(tmp_path / "formatted"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows.collect()))


def test_messages(spark):
    message = {"user_id": "u", "event_type": "E", "time_transaction_occurred": 5, "context": "{}"}
    encode = lambda x: base64.b64encode(x.encode()).decode()
    raw = [
        (encode(json.dumps([message])),),
        (encode(json.dumps([message, message | {"user_id": "v"}])),),
        (encode("not json"),),
        ("%%%",),
    ]
    rows = ingest.decode_messages(spark.createDataFrame(raw, "value string"))
    good = ingest.stamp_events(rows.where("decoded"), "INTERNAL_SERVICES", 9)
    assert good.columns == S.EVENTS.names
    assert sorted(tuple(r) for r in good.collect()) == [
        ("u", "E", 5, "INTERNAL_SERVICES", 9, 9, "{}"),
        ("u", "E", 5, "INTERNAL_SERVICES", 9, 9, "{}"),
        ("v", "E", 5, "INTERNAL_SERVICES", 9, 9, "{}"),
    ]
    assert {r["raw"] for r in rows.where("NOT decoded").collect()} == {raw[2][0], "%%%"}
    assert ingest.decode_messages(ingest.encode_messages(good)).where("decoded").count() == 3


def test_notifications(spark):
    rows = [("E", "u", 5, {"a": "b"}, "h"), ("E", "v", 6, None, "h")]
    got = ingest.normalise_notification(spark.createDataFrame(rows, S.NOTIFICATION)).collect()
    assert [tuple(r) for r in got] == [("u", "E", 5, '{"a":"b"}'), ("v", "E", 6, "")]


GOOD = '{"accountId":"a1","savedAmount":"100::WHOLE_CURRENCY::ZAR"}'


@pytest.mark.parametrize(
    "event_type, t, context, reason",
    [
        ("SAVING_PAYMENT_SUCCESSFUL", 1, GOOD, None),
        ("WITHDRAWAL_EVENT_CONFIRMED", 1, GOOD, None),
        ("SAVING_PAYMENT_SUCCESSFUL", None, GOOD, "no time"),
        ("SAVING_PAYMENT_SUCCESSFUL", 1, None, "no context"),
        ("SAVING_PAYMENT_SUCCESSFUL", 1, "", "no account"),
        ("SAVING_PAYMENT_SUCCESSFUL", 1, '{"savedAmount":"1::WHOLE_CENT::ZAR"}', "no account"),
        ("SAVING_PAYMENT_SUCCESSFUL", 1, '{"accountId":"a1"}', "no amount"),
        ("RANDOM_STRING", 1, GOOD, "unsupported event type"),
        ("SAVING_PAYMENT_SUCCESSFUL", 1, GOOD.replace("100", "much"), "unreadable amount"),
        ("SAVING_PAYMENT_SUCCESSFUL", 1, GOOD.replace("WHOLE_CURRENCY", "SHELLS"), "unreadable amount"),
    ],
)
def test_payments(spark, event_type, t, context, reason):
    df = spark.createDataFrame([("u", event_type, t, context)], S.MESSAGE)
    kept, rejected = ingest.to_behaviour(df, 9).collect(), ingest.rejected_payments(df).collect()
    assert [r["reject_reason"] for r in rejected] == ([reason] if reason else [])
    if reason is None:
        kind = "SAVING_EVENT" if event_type.startswith("SAVING") else "WITHDRAWAL"
        assert [tuple(r) for r in kept] == [("u", "a1", kind, 1_000_000, "HUNDREDTH_CENT", "ZAR", 1, 9, 9)]
    else:
        assert kept == []


def test_a_bad_payment_does_not_stop_the_others(spark):
    rows = [("u", "SAVING_PAYMENT_SUCCESSFUL", i, c) for i, c in enumerate([GOOD, "{}", GOOD])]
    assert ingest.to_behaviour(spark.createDataFrame(rows, S.MESSAGE), 9).count() == 2


def test_event_table_is_laid_out_and_pruned_by_day(spark, events, tmp_path, capsys):
    path = str(tmp_path / "log")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for day in days:
        tables.append_rows(events([("u", "USER_OPENED_APP", day_start(day) + 5, "AMPLITUDE")]), path)
    log = tables.read_events(spark, path)
    assert log.count() == 3
    report = users_by_event(log, "USER_OPENED_APP", Window.of_day("2024-01-02"))
    assert report.first()["users"] == 1
    capsys.readouterr()
    report.explain("formatted")
    plan = capsys.readouterr().out
    line = lambda word: next(x for x in plan.splitlines() if x.startswith(word))
    assert "isnotnull(event_date" in line("PartitionFilters")
    assert "EqualTo(event_type,USER_OPENED_APP)" in line("PushedFilters")
    assert "context" not in line("ReadSchema")


def test_other_tables(spark, events, payments, tmp_path):
    tables.append_rows(payments([("u", "SAVING_EVENT", 1, 5)]), str(tmp_path / "ub"))
    assert tables.read_behaviour(spark, str(tmp_path / "ub")).first()["amount"] == 10_000
    flag = spark.createDataFrame([("u", "a", "rule", "why", "PENDING_CONFIRMATION", 1, 1)], S.FLAGS)
    tables.append_flags(flag, str(tmp_path / "fl"))
    tables.append_flags(flag, str(tmp_path / "fl"))
    assert tables.read_flags(spark, str(tmp_path / "fl")).count() == 2
    folder = tables.write_features_csv(flag, str(tmp_path / "features"), "2024-01-05")
    assert folder.endswith("features_2024-01-05")
    assert spark.read.csv(folder, header=True).columns == flag.columns


def test_csv_event_log(spark, events, tmp_path):
    rows = events([("u", "E", 5, "AMPLITUDE", '{"a":"b, c","d":"e"}'), ("v", "E", 6)])
    rows.write.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    got = tables.read_events_csv(spark, str(tmp_path / "csv")).orderBy(F.col("user_id"))
    assert got.first()["context"] == '{"a":"b, c","d":"e"}'
    assert got.count() == 2


def test_a_delivery_is_appended_once(spark, events, tmp_path):
    path = str(tmp_path / "log")
    rows = events([("a", "E", day_start("2024-01-02")), ("b", "E", day_start("2024-01-03")), ("c", "E", -5)])
    loose = rows.withColumn("user_id", F.when(F.col("user_id") != "b", F.col("user_id")))
    assert tables.append_once(loose, path, "one", S.EVENTS) == (1, 2)
    assert tables.append_once(loose, path, "one", S.EVENTS) == (1, 2)  # delivered again
    # a delivery that died before it was published is not read, and is written anew
    loose.select(*S.EVENTS.names).write.parquet(f"{path}/data/append=two/event_date=2024-01-02")
    assert tables.read_appended(spark, path, S.EVENTS).count() == 1
    assert tables.append_once(rows.where("user_id = 'a'"), path, "two", S.EVENTS) == (1, 0)
    got = tables.read_appended(spark, path, S.EVENTS).select("user_id", "append", F.col("event_date").cast("string")).collect()
    assert sorted(map(tuple, got)) == [("a", "one", "2024-01-02"), ("a", "two", "2024-01-02")]
    reasons = {r["user_id"]: r["reasons"] for r in tables.read_refused(spark, path, S.EVENTS).collect()}
    assert reasons == {None: ["no user_id"], "c": ["time_transaction_occurred is not a time"]}
