"""Drop-off and recovery along event funnels.

A user dropped off a step when they did it in the window and did none of the next steps up to the
window's end. All steps and days of a report are answered by one ``groupBy(user_id)``: per step the
earliest next step, per step and day whether the step was done.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.operators.filters import event_in, event_is, in_window, up_to
from pennyflow.plans.metrics import flags_per_user
from pennyflow.timebox import Window, days_before

USER, T = "user_id", "time_transaction_occurred"


@dataclass(frozen=True)
class Step:
    before: str
    next_steps: tuple[str, ...]

    @classmethod
    def pairs(cls, stages: Sequence[tuple[str, str]]) -> list["Step"]:
        return [cls(step, (following,)) for step, following in stages]


DEFAULT_STEPS = [Step(before, following) for before, following in C.DEFAULT_FUNNEL]


def default_window(as_of: date | str) -> Window:
    return Window.of_days(days_before(as_of, 3), days_before(as_of, 1))


def _dropped(step: Step, window: Window) -> dict[str, Column]:
    return {
        "did": event_is(step.before) & in_window(window),
        "went_on": event_in(step.next_steps) & (F.col(T) <= window.end),
    }


def drop_off_users(events: DataFrame, step: Step, window: Window) -> DataFrame:
    users = flags_per_user(up_to(events, window.end), _dropped(step, window))
    return users.where(F.col("did") & ~F.col("went_on")).select(USER)


def _recovery_flags(step: Step, as_of: date | str, mode: str, start_ms: int | None) -> dict[str, Column]:
    yesterday = Window.of_day(days_before(as_of, 1))
    following, did = event_in(step.next_steps), event_is(step.before)
    if mode == "literal":
        # as published: no next step up to the end of the day on which one must have happened
        return {
            "recovered": following & in_window(yesterday),
            "did": did & in_window(yesterday),
            "went_on": following & (F.col(T) <= yesterday.end),
        }
    if mode == "intent":
        earlier = F.col(T) < yesterday.start
        since = earlier if start_ms is None else earlier & (F.col(T) >= start_ms)
        return {
            "recovered": following & in_window(yesterday),
            "did": did & since,
            "went_on": following & earlier,
        }
    raise ValueError(f"mode must be 'literal' or 'intent', not {mode!r}")


def recovered_users(
    events: DataFrame,
    step: Step,
    as_of: date | str,
    mode: str = "intent",
    start_ms: int | None = None,
) -> DataFrame:
    """Users that took the next step yesterday after having dropped off before.

    ``literal`` keeps the published condition, which no user can meet.
    """
    yesterday = Window.of_day(days_before(as_of, 1))
    users = flags_per_user(up_to(events, yesterday.end), _recovery_flags(step, as_of, mode, start_ms))
    return users.where(F.col("recovered") & F.col("did") & ~F.col("went_on")).select(USER)


def _counts(events: DataFrame, asked: list[tuple[Step, str, Window]]) -> DataFrame:
    """(position, step, next_steps, label, drop_offs) for each asked (step, label, window)."""
    nexts = sorted({step.next_steps for step, _, _ in asked})
    names = sorted({n for step, _, _ in asked for n in (step.before, *step.next_steps)})
    last = max(window.end for _, _, window in asked)
    first_next = {following: f"next_{i}" for i, following in enumerate(nexts)}
    users = (
        up_to(events, last)
        .where(event_in(names))
        .groupBy(USER)
        .agg(
            *[F.min(F.when(event_in(f), F.col(T))).alias(n) for f, n in first_next.items()],
            *[
                F.bool_or(event_is(step.before) & in_window(window)).alias(f"did_{i}")
                for i, (step, _, window) in enumerate(asked)
            ],
        )
    )

    def gone(i: int, step: Step, window: Window) -> Column:
        following = F.col(first_next[step.next_steps])
        return F.col(f"did_{i}") & (following.isNull() | (following > window.end))

    counts = users.agg(*[F.count_if(gone(i, s, w)).alias(f"n_{i}") for i, (s, _, w) in enumerate(asked)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(step.before).alias("step"),
            F.lit(",".join(step.next_steps)).alias("next_steps"),
            F.lit(label).alias("label"),
            F.col(f"n_{i}").alias("drop_offs"),
        )
        for i, (step, label, _) in enumerate(asked)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def drop_off_counts(
    events: DataFrame,
    steps: Sequence[Step],
    window: Window,
    as_of: date | str,
    recovery_mode: str = "literal",
) -> DataFrame:
    """Drop-offs of the window and recoveries of yesterday, per step."""
    dropped = _counts(events, [(s, "window", window) for s in steps]).drop("label")
    names = {}
    for i, step in enumerate(steps):
        for part, condition in _recovery_flags(step, as_of, recovery_mode, None).items():
            names[f"{part}_{i}"] = condition
    yesterday = Window.of_day(days_before(as_of, 1))
    users = flags_per_user(up_to(events, yesterday.end), names)
    back = lambda i: F.col(f"recovered_{i}") & F.col(f"did_{i}") & ~F.col(f"went_on_{i}")
    counts = users.agg(*[F.count_if(back(i)).alias(f"n_{i}") for i in range(len(steps))])
    rows = [
        F.struct(F.lit(i).alias("position"), F.col(f"n_{i}").alias("recoveries")) for i in range(len(steps))
    ]
    recovered = counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return dropped.join(recovered, "position")


def drop_off_by_stage(
    events: DataFrame, steps: Sequence[Step], day: date | str
) -> DataFrame:
    """Drop-offs of one day per stage, in funnel order."""
    counts = _counts(events, [(s, str(day), Window.of_day(day)) for s in steps])
    return counts.select("position", "step", "next_steps", "drop_offs")


def drop_off_daily_avg(
    events: DataFrame, steps: Sequence[Step], as_of: date | str, n: int = 3
) -> DataFrame:
    """Mean daily drop-offs per first step over the n days before ``as_of``.

    Stages that start at the same step are added together, as their published key is the step.
    """
    days = [days_before(as_of, i) for i in range(n, 0, -1)]
    asked = [(s, str(d), Window.of_day(d)) for s in steps for d in days]
    per_step = _counts(events, asked).groupBy("step").agg(F.sum("drop_offs").alias("total"))
    return per_step.select("step", (F.col("total") / F.lit(float(n))).alias("daily_average"))
