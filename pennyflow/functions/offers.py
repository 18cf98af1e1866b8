"""Fields of an offer ("boost") event, read from its JSON context."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pennyflow import constants as C
from pennyflow.functions.money import per_currency
from pennyflow.schemas import OFFER_CONTEXT


def parse_offer(context: Column) -> Column:
    return F.from_json(context, OFFER_CONTEXT)


def offer_fields(offer: Column) -> dict[str, Column]:
    amount = offer["boostAmount"].try_cast("long") / per_currency(offer["boostUnit"])
    return {
        "boost_id": offer["boostId"],
        "boost_type": offer["boostType"],
        "boost_category": offer["boostCategory"],
        "boost_amount": amount,
        "boost_type_category": F.concat_ws("::", offer["boostType"], offer["boostCategory"]),
    }


def save_requirement(offer: Column) -> dict[str, Column]:
    """What the user must save to win: kind and whole-currency threshold, null if nothing.

    Of several status lists with a save condition the last one counts, of several conditions in a
    list the first.
    """
    is_save = lambda c: F.exists(
        F.array(*[F.lit(s) for s in C.SAVE_CONDITIONS]), lambda s: F.startswith(c, s)
    )
    lists = F.transform(F.map_values(offer["statusConditions"]), lambda conds: F.filter(conds, is_save))
    clause = F.get(F.try_element_at(F.filter(lists, lambda m: F.size(m) > 0), F.lit(-1)), 0)
    # a clause without a space loses its last character, as in the data already produced
    kind = F.when(clause.contains(" "), F.substring_index(clause, " ", 1)).otherwise(
        F.substring(clause, F.lit(1), F.length(clause) - 1)
    )
    parameter = F.split(F.regexp_extract(clause, r"\{([^}]*)\}", 1), "::")
    threshold = F.get(parameter, 0).try_cast("long") / per_currency(F.get(parameter, 1))
    return {"save_type": kind, "save_amount": threshold}


def days_open(offer: Column) -> Column:
    return (offer["boostEndTime"] - offer["boostStartTime"]) / F.lit(float(C.DAY_MS))


def one_hot(column: Column, categories: tuple[str, ...] = C.OFFER_CATEGORIES) -> dict[str, Column]:
    """A 0/1 column for every category of the fixed list, also for those the data lacks."""
    return {f"boost_type_category_{c}": (column == c).cast("int") for c in categories}
