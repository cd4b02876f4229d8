"""Transaction types and code-to-label tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stakeline.params import BET, CORE_TYPES, REWARD, WINS

# Status codes and the labels each report gives them.
BET_STATUS = {"O": "1", "W": "2", "L": "3", "V": "3", "C": "2"}
MARKET_RESULT = {"O": "PENDING", "C": "CASHOUT", "W": "WON", "L": "LOST", "V": "CANCELLED"}
CORE_TYPE_PATTERN = "^(1|2|8|15)$"


def holds(predicate: Column) -> Column:
    """Two-valued logic: an unknown predicate counts as false."""
    return F.coalesce(predicate, F.lit(False))


def one_of(value: Column, allowed: Iterable) -> Column:
    return holds(value.isin(*allowed))


def none_of(value: Column, excluded: Iterable) -> Column:
    """Complement of ``one_of``: a null value is kept."""
    return ~one_of(value, excluded)


def matches_core_pattern(number: Column) -> Column:
    return holds(number.cast("string").rlike(CORE_TYPE_PATTERN))


def is_core(kind: Column) -> Column:
    return one_of(kind, CORE_TYPES)


def is_bet(kind: Column) -> Column:
    return holds(kind == BET)


def is_win(kind: Column) -> Column:
    return one_of(kind, WINS)


def is_reward(kind: Column) -> Column:
    return holds(kind == REWARD)


def is_paid_reward(kind: Column, amount: Column) -> Column:
    return holds((kind == REWARD) & (amount > 0))


def is_unpaid_reward(kind: Column, amount: Column) -> Column:
    return holds((kind == REWARD) & (amount == 0))


def label(code: Column, labels: dict[str, str], otherwise: str) -> Column:
    chain = F
    for value, text in labels.items():
        chain = chain.when(code == value, F.lit(text))
    return chain.otherwise(F.lit(otherwise))


def bet_type(total_play: Column) -> Column:
    return F.when(total_play == 1, "1").otherwise("2")


def bet_status(status: Column) -> Column:
    return label(status, BET_STATUS, "2")


def event_status(status: Column) -> Column:
    return label(status, {"O": "4"}, "5")


def market_result(status: Column) -> Column:
    return label(status, MARKET_RESULT, "SUSPENDED")


def is_cashout(status: Column) -> Column:
    return holds(status == "C")


def is_system_bet(flag: Column) -> Column:
    return holds(flag == 1)
