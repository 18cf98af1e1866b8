"""Targets, flow and selection against their definitions; odd rows."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from pennyflow.llm import mixing


def test_targets_share_the_excess():
    rnd = random.Random(3)
    for _ in range(300):
        sizes = {f"s{i}": rnd.choice([0, 1, 10, 500, 10_000]) for i in range(rnd.randrange(1, 8))}
        weights = {s: rnd.choice(mixing.WEIGHTS) for s in sizes}
        budget = rnd.choice([0.3, 1.5, 2.0, 5.0])
        found = mixing.targets(sizes, weights, budget)
        # As told: share by weight, cut at the most, share what is left among the others, again and again.
        left, open_, want = budget * sum(sizes.values()), set(sizes), {}
        while open_:
            share = left / sum(weights[s] for s in open_)
            above = {s for s in open_ if share * weights[s] > 2 * sizes[s]}
            for s in above or open_:
                want[s] = 2 * sizes[s] if above else share * weights[s]
            left -= sum(want[s] for s in above)
            open_ -= above or open_
        assert found == pytest.approx(want)


def flow_cost(supplies, used):
    return sum(min(u, w) + 3 * max(0, u - w) for u, (_, w) in zip(used, supplies))


def test_flow_is_largest_and_cheapest():
    rnd = random.Random(9)
    for _ in range(150):
        m = rnd.randrange(1, 4)
        supplies = [(tuple(sorted(rnd.sample(range(m), rnd.randrange(1, m + 1)))), rnd.randrange(3)) for _ in range(rnd.randrange(1, 4))]
        quotas = [rnd.randrange(5) for _ in range(m)]
        used, got = mixing.cheapest_flow(supplies, quotas)
        best = (0, 0)
        ways = [[x for x in itertools.product(range(2 * w + 1), repeat=len(s)) if sum(x) <= 2 * w] for s, w in supplies]
        for choice in itertools.product(*ways):
            to = [0] * m
            for (s, _), x in zip(supplies, choice):
                for j, v in zip(s, x):
                    to[j] += v
            if all(t <= q for t, q in zip(to, quotas)):
                total = sum(to)
                best = max(best, (total, -flow_cost(supplies, [sum(x) for x in choice])))
        assert (sum(got), -flow_cost(supplies, used)) == best and sum(used) == sum(got)
        assert all(g <= q for g, q in zip(got, quotas))


def test_sources_come_near_their_targets_and_runs_agree(spark):
    rnd = random.Random(1)
    rows = [(i, "w " * rnd.randrange(1, 60), rnd.choice(["a", "b", "b", "b", "c", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    first, plan = mixing.mix(df, F.array("source"))
    again, _ = mixing.mix(df.repartition(7), F.array("source"))
    key = ["doc_id", "taken"]
    assert sorted(first.select(key).collect()) == sorted(again.select(key).collect())
    assert first.where("taken > 2 * size or taken % size > 0").count() == 0
    sums = {r["s"]: r["t"] for r in first.groupBy(F.col("sources")[0].alias("s")).agg(F.sum("taken").alias("t")).collect()}
    for r in plan.collect():
        assert abs(sums[r["source"]] - r["target"]) <= 61 and r["routed"] == round(r["target"])
    assert sum(sums.values()) == pytest.approx(1.5 * sum(len(t.split()) for _, t, _ in rows), rel=0.01)


def test_overlapping_sources(spark):
    rows = [(i, "one two three", ["a"] if i % 3 == 0 else ["a", "b"] if i % 3 == 1 else ["b"]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id int, text string, of array<string>")
    taken, plan = mixing.mix(df, F.col("of"), weights={"a": 2, "b": 1}, budget=0.9)
    plan = {r["source"]: r for r in plan.collect()}
    assert plan["a"]["routed"] == round(plan["a"]["target"]) and plan["b"]["routed"] == round(plan["b"]["target"])
    total = taken.agg(F.sum("taken")).first()[0]
    assert abs(total - plan["a"]["routed"] - plan["b"]["routed"]) <= 9
    assert taken.where("taken > size").count() == 0  # nothing is repeated while unused words could serve


def test_odd_rows(odd, nothing):
    rows, plan = mixing.mix(odd, F.array("source"))
    assert rows.count() == odd.count() and rows.where("size = 0 and taken > 0").count() == 0
    assert {r["source"] for r in plan.collect()} == {"s", None}
    assert rows.where("doc_id = 4").first()["size"] == 10 and rows.where("doc_id = 8").first()["size"] == 2
    none, plan = mixing.mix(nothing, F.array("source"))
    assert none.count() == plan.count() == 0
    outside, _ = mixing.mix(odd, F.lit(None).cast("array<string>"))
    assert outside.count() == odd.count() and outside.where("taken > 0").count() == 0
