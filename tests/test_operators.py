import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.operators import columns, pairs
from pennyflow.operators.filters import drop_top_users, top_users, within
from pennyflow.operators.pairs import Case, highest_match, matching_pairs
from pennyflow.operators.skew import lookup_join
from pennyflow.operators.timeline import Look, look_around
from pennyflow.plans.fraud import quick_withdrawals
from pennyflow.timebox import Window, day_start

HOUR = C.HOUR_MS


def crowd(seed, users=6, rows=300, span=3 * 60_000):
    """Events of a few users, one of whom has half of all; many share a millisecond or a minute."""
    rng = random.Random(seed)
    return [
        (
            "big" if rng.random() < 1 / 2 else f"u{rng.randrange(users)}",
            rng.choice("ask point other".split()),
            rng.choice([rng.randrange(span), rng.randrange(50), 60_000]),
        )
        for _ in range(rows)
    ]


LOOKS = [
    ("n_before", "count", "before", 0),
    ("n_after", "count", "after", 0),
    ("last", "max", "before", 0),
    ("first", "min", "before", -20_000),
    ("next", "min", "after", 0),
    ("next_later", "min", "after", 30_000),
    ("n_since", "count", "after", -25_000),
    ("n_until", "count", "before", 25_000),
]


@pytest.mark.parametrize("cell_ms", [7, 60_000, None])
def test_look_around_equals_brute_force(spark, cell_ms):
    rows = [(None if user == "u1" else user, kind, t) for user, kind, t in crowd(1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, user string, kind string, t long")
    value = F.when(F.col("kind") == "point", F.col("t"))
    looks = [Look(name, kind, value, side, offset) for name, kind, side, offset in LOOKS]
    out = look_around(df, ["user"], "t", looks, F.col("kind") == "ask", cell_ms)
    got = {r["id"]: tuple(r[look.name] for look in looks) for r in out.collect()}

    points = defaultdict(list)
    for user, kind, t in rows:
        if kind == "point":
            points[user].append(t)

    def expect(user, t):
        result = []
        for _, kind, side, offset in LOOKS:
            at = t + offset
            hits = [p for p in points[user] if (p < at if side == "before" else p > at)]
            result.append(
                len(hits) if kind == "count" else (min if kind == "min" else max)(hits, default=None)
            )
        return tuple(result)

    wanted = {i: expect(user, t) for i, (user, kind, t) in enumerate(rows) if kind == "ask"}
    assert got == wanted


def plan_of(df):
    df.collect()  # adaptive execution has chosen its joins after a run only
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_no_timeline_passes_the_driver(spark, payments):
    """Small tables would be broadcast, and packed large ones too."""
    rows = spark.createDataFrame(crowd(3), "user_id string, kind string, t long")
    looked = look_around(rows, ["user_id"], "t", [Look("n", "count", F.col("t"), "before")], F.col("kind") == "ask")
    assert "Broadcast" not in plan_of(looked)
    df = payments([("u", C.SAVING, 100, HOUR), ("u", C.WITHDRAWAL, 100, 2 * HOUR)])
    assert "BroadcastHashJoin" not in plan_of(matching_pairs(df, [Case("c", 48, F.lit(True))]))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_equals_join(spark, how):
    rows = spark.createDataFrame([(u, t) for u, _, t in crowd(2)], "user string, t long")
    table = spark.createDataFrame([("big", 1), ("u1", 2), ("u2", 3), ("absent", 4)], "user string, x int")
    got = lookup_join(rows.repartition(5), table, ["user"], how)
    wanted = rows.join(table, "user", how)
    assert got.columns == wanted.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, wanted.collect()))


def brute_pairs(rows, hours, strict=False):
    saves, withdrawals, counts = defaultdict(list), defaultdict(list), Counter()
    for user, kind, amount, t in rows:
        (saves if kind == C.SAVING else withdrawals)[user].append((int(amount * 10_000), t))
    for user, items in withdrawals.items():
        for w, at in items:
            for s, t in saves[user]:
                if s * 0.95 <= w <= s and at - t <= hours * HOUR and (not strict or at >= t):
                    counts[user] += 1
    return dict(counts)


@pytest.mark.parametrize(
    "withdrawn, hours, expected", [(98, 6, 1), (98, 1, 0), (30, 6, 0), (95, 6, 1), (94.99, 6, 0), (101, 6, 0)]
)
def test_pair_cases(payments, withdrawn, hours, expected):
    rows = [("u", C.SAVING, 100, HOUR), ("u", C.WITHDRAWAL, withdrawn, 5 * HOUR)]
    got = matching_pairs(payments(rows), [Case("c", hours, F.lit(True))]).collect()
    assert sum(r["pairs"] for r in got) == expected


@pytest.mark.parametrize("strict", [False, True])
def test_pairs_equal_brute_force(payments, strict):
    rng = random.Random(3)
    amount = lambda: rng.choice([0, 0.0001, 0.0007, 1, 100, 100 * rng.uniform(0.9, 1.05), 10 ** rng.uniform(-4, 7)])
    rows = [
        ("big" if rng.random() < 1 / 3 else f"u{rng.randrange(4)}", rng.choice([C.SAVING, C.WITHDRAWAL]), amount(), rng.randrange(100 * HOUR))
        for _ in range(250)
    ]
    df = payments(rows)
    cases = [Case("a", 48, F.lit(True)), Case("b", 6, F.col("time_transaction_occurred") > 50 * HOUR)]
    got = {(r["user_id"], r["case"]): r["pairs"] for r in matching_pairs(df, cases, strict).collect()}
    late = [r for r in rows if r[3] > 50 * HOUR]
    wanted = {(u, "a"): n for u, n in brute_pairs(rows, 48, strict).items()}
    wanted |= {(u, "b"): n for u, n in brute_pairs(late, 6, strict).items()}
    assert got == wanted


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("few", [0, 2])
def test_crowded_and_other_bands_count_the_same(payments, few, strict):
    rng = random.Random(5)
    amount = lambda: rng.choice([0, 0.0001, 1, 99, 100, 100 * rng.uniform(0.9, 1.05), 10 ** rng.uniform(-4, 7)])
    rows = [
        ("big" if rng.random() < 1 / 2 else f"u{rng.randrange(4)}", rng.choice([C.SAVING, C.WITHDRAWAL]), amount(), rng.randrange(100 * HOUR))
        for _ in range(250)
    ]
    got = matching_pairs(payments(rows), [Case("a", 48, F.lit(True))], strict, few).collect()
    assert {r["user_id"]: r["pairs"] for r in got} == brute_pairs(rows, 48, strict)


def test_only_crowded_bands_are_counted_by_blocks(payments, monkeypatch):
    """A withdrawal is some sixty rows under blocks; one that meets few savings is a row per band."""
    counted, seen = pairs._counted, []

    def watch(savings, withdrawals, *rest):
        seen.append((savings.count(), withdrawals.count()))
        return counted(savings, withdrawals, *rest)

    monkeypatch.setattr(pairs, "_counted", watch)
    rows = [(f"u{i}", C.SAVING, 30_000 + i, HOUR) for i in range(20)] + [(f"u{i}", C.WITHDRAWAL, 30_000 + i, 2 * HOUR) for i in range(20)]
    rows += [("big", C.SAVING, 5_000 + i, HOUR) for i in range(30)] + [("big", C.WITHDRAWAL, 5_000, 2 * HOUR)]
    got = matching_pairs(payments(rows), [Case("a", 48, F.lit(True))], few=10).collect()
    assert {r["user_id"]: r["pairs"] for r in got} == brute_pairs(rows, 48)
    savings, withdrawals = seen[0]
    assert savings == 30 and 1 <= withdrawals <= 2


def test_pairs_count_an_earlier_withdrawal_unless_strict(payments):
    as_of = "2024-01-30"
    t = day_start("2024-01-20")
    df = payments([("u", C.WITHDRAWAL, 100, t), ("u", C.SAVING, 100, t + 10 * 24 * HOUR - 1)])
    assert quick_withdrawals(df, 48, 30, as_of).first()["pairs"] == 1
    assert quick_withdrawals(df, 48, 30, as_of, strict=True).count() == 0


def test_highest_match(spark):
    rng = random.Random(4)
    amounts = [0, 1, 18, 19, 20, 94, 95, 96, 9_500, 9_499] + [rng.randrange(10**12) for _ in range(300)]
    df = spark.createDataFrame([(a,) for a in amounts], "a long").select("a", highest_match(F.col("a")).alias("h"))
    for a, h in df.collect():
        assert h * 0.95 <= a < (h + 1) * 0.95


def test_top_users(events):
    rows = [("a", "X", t) for t in range(5)] + [("c", "X", t) for t in range(3)] + [("b", "X", t) for t in range(3)] + [("d", "X", 1)]
    df = events(rows)
    assert [tuple(r) for r in top_users(df).collect()] == [("a", 5), ("b", 3)]
    assert {r["user_id"] for r in drop_top_users(df).collect()} == {"c", "d"}


def test_window_is_inclusive_and_leaves_out_the_last_moment(events):
    w = Window.of_day("2024-01-02")
    df = events([("a", "X", t) for t in (w.start - 1, w.start, w.end, w.end + 1, w.end + 999)])
    assert [r[0] for r in within(df, w).select("time_transaction_occurred").collect()] == [w.start, w.end]


def test_column_summaries(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (10, None), (None, "c")], "n long, s string")
    assert [tuple(r) for r in columns.value_counts(df, "s").collect()] == [("a", 2), ("b", 1), ("c", 1)]
    assert tuple(columns.distinct_and_null_count(df, "s").first()) == (3, 1)
    d = columns.describe_whole_numbers(df, "n").first()
    assert (d["count"], d["min"], d["q25"], d["q50"], d["q75"], d["max"]) == (4, 1, 1.75, 2.0, 4.0, 10)
    assert abs(d["mean"] - 3.75) < 1e-9 and abs(d["std"] - 4.193248541803041) < 1e-9
    one = columns.describe_whole_numbers(df.limit(1), "n").first()
    assert one["std"] is None and one["mean"] == 1.0


def test_first_and_last_skip_nulls(spark):
    df = spark.createDataFrame([("g", 1, None, 5), ("g", 2, "b", None), ("g", 3, None, 7)], "k string, t int, a string, n int")
    assert tuple(columns.first_per_group(df, ["k"], "t").first()) == ("g", 1, "b", 5)
    assert tuple(columns.last_per_group(df, ["k"], "t").first()) == ("g", 3, "b", 7)


def test_group_size(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, t int")
    got = sorted(tuple(r) for r in columns.with_group_size(df, ["k"]).collect())
    assert got == [("a", 1, 2), ("a", 2, 2), ("b", 3, 1)]
