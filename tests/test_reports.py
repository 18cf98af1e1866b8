import random

import pytest
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow import schemas as S
from pennyflow.plans import boosts, cohorts, fraud, funnel, metrics
from pennyflow.timebox import Window, day_start

DAY, HOUR, MINUTE = C.DAY_MS, C.HOUR_MS, 60_000
AS_OF = "2024-01-20"
TODAY = day_start(AS_OF)
YESTERDAY = TODAY - DAY


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- metrics -----------------------------------------------------------------------------


def test_empty_tables_give_zeros(events, payments):
    ev, ub = events([]), payments([])
    items = {r["metric_name"]: (r["metric_value"], r["display"]) for r in metrics.daily_metrics(ev, ub, AS_OF).collect()}
    assert len(items) == 11
    assert items["Total amount saved yesterday"] == (0.0, "R0.0")
    assert items["% who completed save"] == (0.0, "0.00")
    assert items["% of messages led to open"] == (0.0, "0%")
    assert items["% whose boosts expired"][0] == 0.0


def test_percentages_round_half_to_even(events, payments):
    log = [(f"m{i}", "MESSAGE_SENT", YESTERDAY + i) for i in range(8)]
    log += [("m0", "USER_OPENED_APP", YESTERDAY + HOUR, "AMPLITUDE")]  # 1 of 8: 12.5
    items = {r["metric_name"]: r["display"] for r in metrics.daily_metrics(events(log), payments([]), AS_OF).collect()}
    assert items["% of messages led to open"] == "12%"


def test_daily_list_is_in_order(events, payments):
    got = metrics.daily_metrics(events([]), payments([]), AS_OF).collect()
    assert [r["position"] for r in got] == list(range(1, 12))


def test_boost_ids_repeat(events):
    log = [("u1", "BOOST_EXPIRED", TODAY + 1, "INTERNAL_SERVICES", '{"boostId":"b1"}')] * 2
    log += [("u2", "BOOST_EXPIRED", TODAY + 2, "INTERNAL_SERVICES", '{"boostId":"b2"}')]
    # b1 is listed twice with one user each time, b2 once: 3 expired of 3
    assert metrics.pct_boosts_expired(events(log), AS_OF).first()["percent"] == 100.0


@pytest.mark.parametrize("match, users", [("literal", 2), ("key", 1)])
def test_boost_id_match(spark, events, match, users):
    log = [
        ("u1", "BOOST_EXPIRED", TODAY, "INTERNAL_SERVICES", '{"boostId":"b1"}'),
        ("u2", "BOOST_EXPIRED_LATE", TODAY, "INTERNAL_SERVICES", '{"boostId":"b12"}'),
        ("u3", "BOOST_EXPIRED", TODAY, "AMPLITUDE", '{"boostId":"b1"}'),
        ("u4", "BOOST_EXPIRED", TODAY, "INTERNAL_SERVICES", "b"),
    ]
    ids = spark.createDataFrame([("b1",), ("b1",), ("a-long-id-that-no-context-holds",), (None,)], "boost_id string")
    got = rows(metrics.users_offered_boosts(events(log), ids, AS_OF, match))
    assert got == [("a-long-id-that-no-context-holds", 1, 0), ("b1", 2, users)]


def test_ids_in_texts_equal_plain_search(spark):
    rnd = random.Random(6)
    some = lambda most: "".join(rnd.choice("ab1é") for _ in range(rnd.randrange(most)))
    for shortest in (1, 3, 8):
        ids = [some(9) + "x" * shortest for _ in range(40)] + ["", "nowhere-at-all"]
        texts = [some(60) + rnd.choice(ids) + some(20) for _ in range(80)] + ["", "x", None]
        held = metrics.ids_in_texts(
            spark.createDataFrame([(t,) for t in texts], "context string"), spark.createDataFrame([(i,) for i in ids], "boost_id string")
        )
        want = {(t, i) for t in texts if t for i in ids if i and i in t}
        assert want and sorted(map(tuple, held.collect())) == sorted(want)


def test_pieces_of_a_text_are_linear(spark):
    """One row per character, whatever lengths the ids have."""
    texts = spark.createDataFrame([("".join(f"{i:04d}" for i in range(500)),)], "context string")
    for lengths in ([6], range(6, 60)):
        ids = spark.createDataFrame([("9" * n,) for n in lengths], "boost_id string")
        size = ids.agg(F.min(F.length("boost_id"))).scalar()
        assert metrics._pieces(texts, "context", size, "context").count() <= 2000


def test_averages_count_empty_days(events, payments):
    log = [("a", "USER_OPENED_APP", YESTERDAY, "AMPLITUDE"), ("b", "USER_OPENED_APP", YESTERDAY + DAY - 500, "AMPLITUDE")]
    got = metrics.daily_avg_users_by_event(events(log), "USER_OPENED_APP", AS_OF, 4)
    assert got.first()[0] == 0.25  # b came in the last second, which belongs to no day
    got = metrics.daily_avg_users_by_transaction(payments([("a", C.SAVING, 1, YESTERDAY)]), C.SAVING, AS_OF, 2)
    assert got.first()[0] == 0.5


def test_ratio(spark):
    got = spark.createDataFrame([(2, 3), (3, 0)], "a int, b int").select(metrics.ratio(F.col("a"), F.col("b"))).collect()
    assert [round(r[0], 3) for r in got] == [0.667, 0.0]


def test_comparison_text(payments):
    w = Window.of_day("2024-01-19")
    one, both = ("a", C.SAVING, 1, YESTERDAY), ("b", C.WITHDRAWAL, 1, YESTERDAY)
    words = [metrics.compare_withdrew_saved(payments(r), w).first()[0] for r in ([one], [both], [one, both], [])]
    assert [next(x for x in ("LESS", "GREATER", "EQUAL") if x in t) for t in words] == ["LESS", "GREATER", "EQUAL", "EQUAL"]


# --- funnel ------------------------------------------------------------------------------

STEP = funnel.Step("A", ("B", "C"))


def test_drop_off(events):
    w = Window.of_day("2024-01-19")
    log = [
        ("stays", "A", YESTERDAY),
        ("moves", "A", YESTERDAY),
        ("moves", "C", YESTERDAY + 1),
        ("was there before", "B", 0),
        ("was there before", "A", YESTERDAY),
        ("moves later", "A", YESTERDAY),
        ("moves later", "B", TODAY),
        ("other day", "A", TODAY),
    ]
    assert rows(funnel.drop_off_users(events(log), STEP, w)) == [("moves later",), ("stays",)]
    stages = funnel.drop_off_by_stage(events(log), [STEP, funnel.Step("B", ("C",))], "2024-01-19")
    assert [r["drop_offs"] for r in stages.orderBy("position").collect()] == [2, 0]


def test_recovery(events):
    log = [
        ("back", "A", 5),
        ("back", "B", YESTERDAY),
        ("never left", "A", 5),
        ("never left", "B", 6),
        ("never left", "B", YESTERDAY),
        ("same day", "A", YESTERDAY),
        ("same day", "B", YESTERDAY + 1),
    ]
    assert rows(funnel.recovered_users(events(log), STEP, AS_OF)) == [("back",)]
    assert rows(funnel.recovered_users(events(log), STEP, AS_OF, start_ms=6)) == []
    assert rows(funnel.recovered_users(events(log), STEP, AS_OF, "literal")) == []
    with pytest.raises(ValueError):
        funnel.recovered_users(events(log), STEP, AS_OF, "guess")


def test_daily_average_adds_stages_of_one_step(events):
    log = [("u", "A", TODAY - i * DAY) for i in (1, 2)]
    steps = [funnel.Step("A", ("B",)), funnel.Step("X", ("B",))]
    assert rows(funnel.drop_off_daily_avg(events(log), steps, AS_OF, 2)) == [("A", 1.0), ("X", 0.0)]
    steps = [funnel.Step("A", ("B",)), funnel.Step("A", ("C",))]
    assert rows(funnel.drop_off_daily_avg(events(log), steps, AS_OF, 2)) == [("A", 2.0)]


def test_published_stages():
    assert len(funnel.Step.pairs(C.SAVING_STAGES)) == len(funnel.Step.pairs(C.ONBOARDING_STAGES)) == 4
    assert funnel.default_window("2024-01-05") == Window.of_days("2024-01-02", "2024-01-04")
    assert funnel.DEFAULT_STEPS[0].next_steps == ("ENTERED_REFERRAL_CODE", "USER_LOGGED_IN")


# --- fraud -------------------------------------------------------------------------------


def facts_of(spark, payments, moves, flags=(), **options):
    flag_rows = [(u, f"acc-{u}", label, "", "", t, t) for u, label, t in flags]
    return fraud.fraud_facts(payments(moves), spark.createDataFrame(flag_rows, S.FLAGS), AS_OF, **options)


def labels(facts):
    return {(r["user_id"], r["rule_label"]) for r in fraud.evaluate_rules(facts, 9).collect()}


MOVES = (
    [("huge", C.SAVING, 100_001, TODAY - 300 * DAY)]
    + [("three", C.SAVING, 60_000, TODAY - i * DAY) for i in (1, 2, 3)]
    + [("jump", C.SAVING, 1, TODAY - i * DAY) for i in range(2, 14)]
    + [("jump", C.SAVING, 1_000, TODAY - DAY)]
    + [("quick", C.SAVING, 100, TODAY - i * 2 * DAY) for i in (1, 2, 3, 4)]
    + [("quick", C.WITHDRAWAL, 100, TODAY - i * 2 * DAY + HOUR) for i in (1, 2, 3, 4)]
    + [("calm", C.SAVING, 100_000, TODAY - DAY)]
)


def test_rules(spark, payments):
    got = labels(facts_of(spark, payments, MOVES))
    assert got == {
        ("huge", C.RULE_VERY_LARGE),
        # no save in six months: the average is 0 and any earlier save is above it
        ("huge", C.RULE_ABOVE_AVERAGE),
        ("three", C.RULE_SEVERAL_LARGE),
        ("jump", C.RULE_ABOVE_AVERAGE),
        ("quick", C.RULE_TWO_DAYS),
        ("quick", C.RULE_ONE_DAY),
        ("calm", C.NOT_FLAGGED),
    }


def test_cutoffs_are_per_user_and_rule(spark, payments):
    flags = [
        ("huge", C.RULE_VERY_LARGE, TODAY - 300 * DAY),  # not strictly after: no longer counted
        ("three", C.RULE_SEVERAL_LARGE, TODAY - 3 * DAY),
        ("three", C.RULE_SEVERAL_LARGE, TODAY - 9 * DAY),
        ("quick", C.RULE_TWO_DAYS, TODAY - 5 * DAY),
        ("jump", C.RULE_VERY_LARGE, TODAY),  # another rule's flag
    ]
    got = labels(facts_of(spark, payments, MOVES, flags))
    assert got == {
        ("huge", C.RULE_ABOVE_AVERAGE),
        ("three", C.NOT_FLAGGED),
        ("jump", C.RULE_ABOVE_AVERAGE),
        ("quick", C.RULE_ONE_DAY),
        ("calm", C.NOT_FLAGGED),
    }


def test_facts(spark, payments):
    got = {r["user_id"]: r for r in facts_of(spark, payments, MOVES).collect()}
    assert got["jump"]["latest_save"] == 1_000.0
    assert abs(got["jump"]["average_save_6m_x10"] - 10 * 1012 / 13) < 1e-9
    assert (got["quick"]["within_48h_30d"], got["quick"]["within_24h_7d"]) == (10, 6)  # earlier withdrawals pair too
    strict = {r["user_id"]: r for r in facts_of(spark, payments, MOVES, strict=True).collect()}
    assert (strict["quick"]["within_48h_30d"], strict["quick"]["within_24h_7d"]) == (4, 3)


def test_experimental_rules_run_only_when_asked(spark, payments):
    rule = fraud.Rule("trial", "why", "latest_save", 0, experimental=True)
    facts = facts_of(spark, payments, [("u", C.SAVING, 1, TODAY - DAY)])
    assert [r["rule_label"] for r in fraud.evaluate_rules(facts, 9, (rule,)).collect()] == [C.NOT_FLAGGED]
    assert [r["rule_label"] for r in fraud.evaluate_rules(facts, 9, (rule,), experimental=True).collect()] == ["trial"]


# --- cohorts -----------------------------------------------------------------------------


def test_opens_and_saves_after(events):
    hour = TODAY - 30 * DAY
    log = [
        ("soon", "MESSAGE_SENT", hour + 5 * MINUTE),
        ("soon", "MESSAGE_SENT", hour + 6 * MINUTE),
        ("soon", "USER_OPENED_APP", hour + MINUTE),  # after the hour began, though before the message
        ("late", "MESSAGE_SENT", hour),
        ("late", "USER_OPENED_APP", hour + 48 * HOUR),
        ("never", "MESSAGE_SENT", hour),
        ("young", "MESSAGE_SENT", TODAY - DAY),
    ]
    got = rows(cohorts.message_app_open(events(log), AS_OF).select("user_id", "earliest_app_open"))
    assert got == [("never", None), ("soon", hour + MINUTE)]
    rate = cohorts.message_open_rate(events(log), AS_OF).first()
    assert (rate["messages"], rate["opens"], rate["open_rate"]) == (2, 1, 0.5)


def test_months_without_rows_are_kept(events, payments):
    at = [day_start(d) for d in ("2023-11-15", "2024-01-15")]
    log = [("a", C.ACCOUNT_CREATED, at[0]), ("a", C.ACCOUNT_CREATED, at[0]), ("b", C.ACCOUNT_CREATED, at[1])]
    ub = payments([("a", C.SAVING, 10, TODAY), ("a", C.SAVING, 20, TODAY), ("b", C.SAVING, 5, TODAY)])
    got = rows(cohorts.cohort_monthly(events(log), ub))
    assert got == [("2023-11-01", 60.0, 15.0), ("2023-12-01", 0.0, None), ("2024-01-01", 5.0, 5.0)]


def test_recency_edges(payments):
    days = [0, 15, 30, 31, 105, 120, 121]
    ub = payments([(f"u{d}", C.SAVING, 1, TODAY - d * DAY) for d in days])
    assert [r["users"] for r in cohorts.recency_buckets(ub, AS_OF).orderBy("position").collect()] == [2, 1, 0, 2]
    assert [r["users"] for r in cohorts.recency_histogram(ub, AS_OF).orderBy("position").collect()] == [1, 1, 2, 0, 0, 0, 0, 2]


def test_first_save_and_fourteen_days(events, payments):
    start = TODAY - 60 * DAY
    log = [("u", C.SAVE_SUCCEEDED, start), ("new", C.SAVE_SUCCEEDED, TODAY - DAY)]
    ub = payments([("u", C.SAVING, a, start + t) for a, t in ((1, 0), (2, 15 * DAY - 1), (4, 15 * DAY), (8, 20 * DAY))])
    got = cohorts.saves_after_14_days(events(log), ub, AS_OF).collect()
    assert [(r["user_id"], r["later_saves"], r["average_save"]) for r in got] == [("u", 2, 6.0)]


# --- offers ------------------------------------------------------------------------------


def offer(boost_id="b1", amount=10):
    return (
        f'{{"boostId":"{boost_id}","boostType":"GAME","boostCategory":"TAP_SCREEN","boostAmount":"{amount}",'
        '"boostUnit":"WHOLE_CURRENCY","statusConditions":{"REDEEMED":["save_greater_than #{50::WHOLE_CURRENCY::ZAR}"]}}'
    )


def log_of(user, offers=(), saves=(), redeems=()):
    out = [(user, C.BOOST_CREATED, TODAY + t, "INTERNAL_SERVICES", offer(*more)) for t, *more in offers]
    out += [(user, C.SAVE_SUCCEEDED, TODAY + t) for t in saves]
    return out + [(user, C.BOOST_REDEEMED, TODAY + t) for t in redeems]


def test_save_at_the_same_moment_is_neither_before_nor_after(events):
    log = log_of("u", [(0,)], saves=[0, -1, 48 * HOUR])
    got = boosts.boosts_with_saves(events(log)).first()
    assert (got["prior_save_count"], got["save_within_48"]) == (1, False)
    got = boosts.boosts_with_saves(events(log_of("u", [(0,)], saves=[48 * HOUR - 1]))).first()
    assert (got["prior_save_count"], got["save_within_48"]) == (0, True)


def test_training_row(events):
    log = log_of("u", [(0,)], saves=[-50 * HOUR, -30 * HOUR + 1, -30 * MINUTE, 30 * MINUTE, 25 * HOUR - 1], redeems=[-2 * HOUR])
    (row,) = boosts.boost_training_set(events(log), top_users=0).collect()
    assert row["boost_prior_saves"] == 2  # half an hour counts neither before nor after
    assert row["days_since_latest_save"] == 29 / 24 and row["days_since_first_save"] == 50 / 24
    assert row["has_prior_redeemed"] and not row["is_save_within_day"]
    assert row["boost_amount_whole_currency"] == 10.0


def test_training_leaves_out_what_lacks_a_side(events):
    log = (
        log_of("only before", [(0,)], saves=[-DAY])
        + log_of("only after", [(0,)], saves=[DAY])
        + log_of("redeemed later", [(0,)], saves=[-DAY, DAY], redeems=[DAY])
        + log_of("fine", [(0,)], saves=[-DAY, DAY])
    )
    got = boosts.boost_training_set(events(log), top_users=0).collect()
    assert [(r["user_id"], r["has_prior_redeemed"]) for r in got] == [("fine", False)]


def test_an_id_offered_twice_is_one_row(events):
    log = log_of("u", [(0, "b1", 10), (40 * HOUR, "b1", 20), (0, "b2", 30)], saves=[-HOUR, 10 * HOUR, 45 * HOUR])
    got = {r["boost_id"]: r for r in boosts.boost_training_set(events(log), top_users=0).collect()}
    assert got["b1"]["boost_prior_saves"] == 3  # one before the first offer, two before the second
    assert got["b1"]["boost_amount_whole_currency"] == 10.0
    assert got["b1"]["days_since_latest_save"] == 30 / 24
    assert got["b2"]["boost_prior_saves"] == 1


def test_busiest_pairs(events):
    log = log_of("a", [(0,)] * 2, saves=range(3)) + log_of("b", [(0,)] * 5) + log_of("c", saves=range(50)) + log_of("d", [(0,)])
    got = boosts.busiest_pair_users(events(log)).collect()
    assert [tuple(r) for r in got] == [("a", 6), ("b", 5)]


def test_cells_do_not_change_the_rows(events, monkeypatch):
    import random

    from pennyflow.operators import timeline

    rng = random.Random(5)
    log = []
    for u in "abcd":
        n = 40 if u == "a" else 12
        t = lambda: rng.randrange(-5 * DAY, 5 * DAY)
        log += log_of(u, [(t(), f"b{rng.randrange(3)}", rng.randrange(9)) for _ in range(n)], [t() for _ in range(n)], [t() for _ in range(n // 4)])
    ev = events(log)
    plain = rows(boosts.boost_training_set(ev, top_users=0))
    monkeypatch.setattr(timeline, "CELL_MS", 40 * DAY)
    assert plain and plain == rows(boosts.boost_training_set(ev, top_users=0))


def test_scoring_input(spark, events, payments):
    ub = payments([("u", C.SAVING, 1, TODAY - 50 * HOUR - 1), ("v", C.SAVING, 1, TODAY), ("u", C.SAVING, 1, TODAY - 99 * HOUR)])
    users = spark.createDataFrame([("u",), ("u",), ("nobody",)], "user_id string")
    (row,) = boosts.score_input(events(log_of("u", redeems=[1, 2])), ub, users, AS_OF, 5, "SIMPLE::ROUND_UP").collect()
    assert row["days_since_latest_save"] == 50 / 24 and row["boost_prior_saves"] == 2 and row["has_prior_redeemed"]
    assert row["boost_type_category_SIMPLE::ROUND_UP"] == 1 and row["boost_type_category_GAME::TAP_SCREEN"] == 0
    assert (row["day_of_week"], row["day_of_month"]) == (5, 20)


def test_condition_trees(spark):
    """Random nested trees over facts with nulls, against plain Python."""
    rnd = random.Random(11)
    facts = [(i, *(rnd.choice([None, 0, 1, 2, 3]) for _ in range(3))) for i in range(60)]
    df = spark.createDataFrame(facts, "i int, a int, b int, c int")
    compare = {
        ">": lambda x, y: x > y, ">=": lambda x, y: x >= y, "<": lambda x, y: x < y,
        "<=": lambda x, y: x <= y, "=": lambda x, y: x == y, "<>": lambda x, y: x != y,
    }

    def tree(depth):
        if depth and rnd.random() < 0.7:
            return {rnd.choice(["all", "any"]): [tree(depth - 1) for _ in range(rnd.randrange(4))]}
        value = rnd.randrange(4) if rnd.random() < 0.5 else {"fact": rnd.choice("abc")}
        return {"fact": rnd.choice("abc"), "is": rnd.choice(list(compare)), "value": value}

    def holds(t, row):
        if "all" in t:
            return all(holds(x, row) for x in t["all"])
        if "any" in t:
            return any(holds(x, row) for x in t["any"])
        x, y = row[t["fact"]], row[t["value"]["fact"]] if isinstance(t["value"], dict) else t["value"]
        return x is not None and y is not None and compare[t["is"]](x, y)

    trees = [tree(3) for _ in range(25)]
    got = df.select("*", *(fraud.condition(t).alias(f"t{n}") for n, t in enumerate(trees))).collect()
    assert all(row[f"t{n}"] == holds(t, row) for row in got for n, t in enumerate(trees))


def test_malformed_condition_is_an_error(spark):
    for tree in ({}, {"fact": "a", "is": "~", "value": 1}, {"all": [], "any": []}, {"fact": "a"}):
        with pytest.raises(ValueError):
            fraud.condition(tree)
