"""Per-user fraud facts, the rules over them and the flag rows they give.

The facts of all users come from one aggregation of the payments and one count of withdrawal/saving
pairs over the last thirty days, which reads the payments a few times more. Each rule has its own cut-off, the time of the
user's last flag for that rule; the five cut-offs are one small row per user.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.functions.money import PER_CURRENCY, whole_currency
from pennyflow.operators.filters import after_cutoff, amount_above, since, transaction_is
from pennyflow.operators.pairs import Case, matching_pairs
from pennyflow.operators.skew import lookup_join
from pennyflow.timebox import day_start, days_before, months_before

USER, T = "user_id", "time_transaction_occurred"
_CUT = {label: f"cut_{i}" for i, label in enumerate(C.RULE_LABELS)}


# --- facts -------------------------------------------------------------------------------


def last_flag_times(flags: DataFrame) -> DataFrame:
    """(user_id, rule_label, last_flag_time) by processing time."""
    return flags.groupBy(USER, "rule_label").agg(F.max("created_at").alias("last_flag_time"))


def cutoffs_per_user(flags: DataFrame) -> DataFrame:
    """One row per flagged user with a column per rule."""
    last = lambda label: F.max(F.when(F.col("rule_label") == label, F.col("created_at")))
    return flags.groupBy(USER).agg(*[last(label).alias(name) for label, name in _CUT.items()])


def _cut(label: str) -> Column:
    return F.col(_CUT[label])


def quick_withdrawal_cases(as_of: date | str, cut: bool = True) -> list[Case]:
    month, week = (F.col(T) >= day_start(days_before(as_of, n)) for n in (30, 7))
    allowed = (lambda label: after_cutoff(_cut(label))) if cut else (lambda label: F.lit(True))
    return [
        Case("within_48h_30d", 48, month & allowed(C.RULE_TWO_DAYS)),
        Case("within_24h_7d", 24, week & allowed(C.RULE_ONE_DAY)),
    ]


def quick_withdrawals(
    behaviour: DataFrame, hours: int, days: int, as_of: date | str, strict: bool = False
) -> DataFrame:
    """(user_id, pairs): matching withdrawals within ``hours`` of a saving, over ``days`` days."""
    recent = since(behaviour, day_start(days_before(as_of, days)))
    return matching_pairs(recent, [Case("asked", hours, F.lit(True))], strict).select(USER, "pairs")


def fraud_facts(
    behaviour: DataFrame,
    flags: DataFrame,
    as_of: date | str,
    strict: bool = False,
) -> DataFrame:
    """One row per user with the six facts; amounts in whole currency."""
    cutoffs = cutoffs_per_user(flags)
    half_year = F.col(T) >= day_start(months_before(as_of, 6))
    saving = transaction_is(C.SAVING)
    rows = lookup_join(
        behaviour.select(USER, "account_id", "transaction_type", "amount", T), cutoffs, [USER]
    )
    very_large = saving & amount_above(C.VERY_LARGE_SAVE) & after_cutoff(_cut(C.RULE_VERY_LARGE))
    large = saving & amount_above(C.LARGE_SAVE) & half_year & after_cutoff(_cut(C.RULE_SEVERAL_LARGE))
    uncut = saving & after_cutoff(_cut(C.RULE_ABOVE_AVERAGE))
    newest = F.struct(F.col(T), F.col("amount"))
    single = rows.groupBy(USER).agg(
        F.max_by("account_id", F.struct(F.col(T), F.col("account_id"))).alias("account_id"),
        F.count_if(very_large).alias("saves_above_100k"),
        F.count_if(large).alias("saves_above_50k_6m"),
        whole_currency(F.max(F.when(uncut, newest))["amount"]).alias("latest_save"),
        (
            F.coalesce(F.avg(F.when(uncut & half_year, F.col("amount"))), F.lit(0.0))
            / PER_CURRENCY
            * C.AVERAGE_MULTIPLIER
        ).alias("average_save_6m_x10"),
    )
    recent = since(behaviour, day_start(days_before(as_of, 30)))
    # a plain join: nothing relies on its partitions, so adaptive execution may split a large user
    recent = recent.select(USER, "transaction_type", "amount", T).join(cutoffs, USER, "left")
    cases = quick_withdrawal_cases(as_of)
    pairs = matching_pairs(recent, cases, strict)
    pair_counts = pairs.groupBy(USER).agg(
        *[F.sum(F.when(F.col("case") == c.name, F.col("pairs"))).alias(c.name) for c in cases]
    )
    zero = F.lit(0).cast("long")
    return single.join(pair_counts, USER, "left").withColumns(
        {c.name: F.coalesce(F.col(c.name), zero) for c in cases}
    )


# --- rules -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Flags a user when ``fact`` is above ``limit``, a number or another fact."""

    label: str
    reason: str
    fact: str
    limit: int | str
    inclusive: bool = False
    experimental: bool = False

    def fires(self) -> Column:
        limit = F.col(self.limit) if isinstance(self.limit, str) else F.lit(self.limit)
        fact = F.col(self.fact)
        return fact >= limit if self.inclusive else fact > limit


_COMPARE = {">": Column.__gt__, ">=": Column.__ge__, "<": Column.__lt__, "<=": Column.__le__, "=": Column.__eq__, "<>": Column.__ne__}


def condition(tree: Mapping) -> Column:
    """The truth of a condition tree, which is ``{"all": [...]}``, ``{"any": [...]}`` or one comparison.

    A comparison ``{"fact": name, "is": ">=", "value": x}`` holds a fact against a number, or against another fact where
    x is ``{"fact": name}``; with a null on a side it does not hold. No condition at all: "all" holds, "any" does not.
    """
    kind = set(tree)
    if kind == {"all"}:
        return reduce(Column.__and__, map(condition, tree["all"]), F.lit(True))
    if kind == {"any"}:
        return reduce(Column.__or__, map(condition, tree["any"]), F.lit(False))
    if kind != {"fact", "is", "value"} or tree["is"] not in _COMPARE:
        raise ValueError(f"not a condition: {tree}")
    value = tree["value"]
    other = F.col(value["fact"]) if isinstance(value, Mapping) else F.lit(value)
    return F.coalesce(_COMPARE[tree["is"]](F.col(tree["fact"]), other), F.lit(False))


@dataclass(frozen=True)
class TreeRule:
    """Flags a user when its condition tree holds; the tree may come as JSON text."""

    label: str
    reason: str
    tree: Mapping | str
    experimental: bool = False

    def fires(self) -> Column:
        return condition(json.loads(self.tree) if isinstance(self.tree, str) else self.tree)


# Labels, reasons and limits of the published rules.
RULES = (
    Rule(
        C.RULE_VERY_LARGE,
        "User has a saving_event greater than 100,000 rands",
        "saves_above_100k",
        0,
    ),
    Rule(
        C.RULE_SEVERAL_LARGE,
        "User has saving_event 50,000 rands 3 or more times in the last 6 months",
        "saves_above_50k_6m",
        3,
        inclusive=True,
    ),
    Rule(
        C.RULE_ABOVE_AVERAGE,
        "User's latest inward transfer > 10x past 6 month average transfer",
        "latest_save",
        "average_save_6m_x10",
    ),
    Rule(
        C.RULE_TWO_DAYS,
        "User has more than 3 instances within a 30 day cycle, of withdrawal of saving_event "
        "within 48 hours of saving_eventing",
        "within_48h_30d",
        3,
    ),
    Rule(
        C.RULE_ONE_DAY,
        "User has more than 1 instance within a 7 day cycle, of withdrawal instruction of "
        "saving_event transferred within 24 hours",
        "within_24h_7d",
        1,
    ),
)
NOT_FLAGGED_REASON = "User was not flagged by any of the rules"


def supported_rules(rules: tuple[Rule | TreeRule, ...] = RULES, experimental: bool = False) -> tuple[Rule | TreeRule, ...]:
    return tuple(r for r in rules if experimental or not r.experimental)


def evaluate_rules(
    facts: DataFrame, now_ms: int, rules: tuple[Rule | TreeRule, ...] = RULES, experimental: bool = False
) -> DataFrame:
    """Flag rows: one per user and rule that fires, or one saying that none did."""
    outcome = lambda label, reason: F.struct(
        F.lit(label).alias("rule_label"), F.lit(reason).alias("reason")
    )
    chosen = supported_rules(rules, experimental)
    fired = F.array_compact(F.array(*[F.when(r.fires(), outcome(r.label, r.reason)) for r in chosen]))
    none = F.array(outcome(C.NOT_FLAGGED, NOT_FLAGGED_REASON))
    return (
        facts.withColumn("o", F.explode(F.when(F.size(fired) > 0, fired).otherwise(none)))
        .select(USER, "account_id", "o.rule_label", "o.reason")
        .withColumns(
            {
                "accuracy": F.lit(C.ACCURACY_PENDING),
                "created_at": F.lit(now_ms).cast("long"),
                "updated_at": F.lit(now_ms).cast("long"),
            }
        )
    )


def fraud_flags(
    behaviour: DataFrame, flags: DataFrame, as_of: date | str, now_ms: int, **options
) -> DataFrame:
    return evaluate_rules(fraud_facts(behaviour, flags, as_of, **options), now_ms)
