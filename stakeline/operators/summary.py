"""Per-session summary."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stakeline.functions.codes import (
    is_bet,
    is_paid_reward,
    is_reward,
    is_unpaid_reward,
    is_win,
    none_of,
)
from stakeline.functions.times import seconds_between
from stakeline.functions.values import floored_difference, json_list
from stakeline.params import CORE_TYPES

SESSION_KEYS = ("csn_customer_id", "sessionid", "csn_game_id")

AMOUNT = "amount_from_balance"
TYPE = "csn_cust_transaction_type_id"


def amount_type(df: DataFrame) -> T.DecimalType:
    """Decimal type that holds the amounts exactly: their own, or a wide one for other numbers.

    Floating point amounts count as the decimals they print as; more than ten places are an error.
    """
    kind = df.schema[AMOUNT].dataType
    if isinstance(kind, T.DecimalType):
        return kind
    if isinstance(kind, T.IntegralType):
        return T.DecimalType(20, 0)
    if isinstance(kind, T.FractionalType):
        return T.DecimalType(38, 10)
    raise TypeError(f"{AMOUNT} must be a number, not {kind.simpleString()}")


def exact_amount(df: DataFrame) -> Column:
    """The amount as ``amount_type`` has it, with all its digits."""
    kind, amount, money = df.schema[AMOUNT].dataType, F.col(AMOUNT), amount_type(df)
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return amount.cast(money)
    printed = amount.cast("string").cast(money)
    message = F.concat(amount.cast("string"), F.lit(f" does not fit {money.simpleString()}"))
    return F.when(printed.cast(kind) != amount, F.raise_error(message).cast(money)).otherwise(printed)


def sum_type(amounts: T.DecimalType) -> T.DecimalType:
    """Money type of sums: DECIMAL(18,2) for amounts in cents, else as wide as it gets."""
    if amounts.precision <= 18 and amounts.scale <= 2:
        return T.DecimalType(18, 2)
    return T.DecimalType(38, amounts.scale)


def exact_sum(column: str, amounts: T.DecimalType) -> Column:
    """Sum at the amounts' own scale, 0 for no amount; one too large is an error.

    Amounts of up to four places add up as 64-bit whole numbers, several times faster than
    decimals beyond 18 digits do.
    """
    if amounts.precision <= 18 and amounts.scale <= 4:
        units = F.sum((F.col(column) * 10**amounts.scale).cast("long"))
        unit = Decimal(1).scaleb(-amounts.scale)
        total = F.coalesce(units, F.lit(0)).cast("decimal(20,0)") * F.lit(unit)
    else:
        total = F.coalesce(F.sum(column), F.lit(0))
    return total.cast(sum_type(amounts))


def with_type_flags(df: DataFrame) -> DataFrame:
    """Adds 0/1 columns per transaction kind. An unknown amount is neither paid nor unpaid."""
    kind, amount = F.col(TYPE), F.col(AMOUNT)
    flags = {
        "is_aposta": is_bet(kind),
        "is_ganho": is_win(kind),
        "is_recompensa": is_reward(kind),
        "recompensa_paga": is_paid_reward(kind, amount),
        "recompensa_nao_paga": is_unpaid_reward(kind, amount),
    }
    return df.withColumns({name: flag.cast("int") for name, flag in flags.items()})


def with_masked_amounts(df: DataFrame) -> DataFrame:
    """Adds the amount per kind, 0 on other rows, and the id of paid rewards."""
    money, amount = amount_type(df), exact_amount(df)

    def masked(flag: str) -> Column:
        return F.when(F.col(flag) == 1, amount).otherwise(F.lit(0).cast(money))

    return df.withColumns(
        {
            "total_apostas": masked("is_aposta"),
            "total_ganhos": masked("is_ganho"),
            "total_recompensas": masked("is_recompensa"),
            "json_recompensas": F.when(
                F.col("recompensa_paga") == 1, F.col("customer_transaction_id").cast("string")
            ),
        }
    )


def session_summary(
    rows: DataFrame, rewards: bool = True, session: str = "sessionid"
) -> DataFrame:
    """Counts, money and time bounds per customer, session and game; money stays decimal.

    Grouping starts with the customer, so rows still partitioned by customer are not shuffled
    again. ``rewards`` adds the JSON list of paid reward ids in time order.
    """

    def count(flag: str) -> Column:
        return F.sum(flag)

    def money(column: str) -> Column:
        return exact_sum(column, amount_type(rows)).alias(column)

    measures = [
        count("is_aposta").alias("quantidade_apostas"),
        count("is_ganho").alias("quantidade_ganhos"),
        count("recompensa_paga").alias("quantidade_recompensas_pagas"),
        count("recompensa_nao_paga").alias("quantidade_recompensas_nao_pagas"),
        money("total_apostas"),
        money("total_ganhos"),
        money("total_recompensas"),
        F.min("transaction_date").alias("session_start"),
        F.max("transaction_date").alias("session_end"),
    ]
    if rewards:
        paid_ids = json_list(
            (F.col("transaction_date"), F.col("customer_transaction_id")),
            F.col("customer_transaction_id"),
            F.col("recompensa_paga") == 1,
        )
        measures.append(paid_ids.alias("quantidade_recompensas"))
    flagged = with_masked_amounts(with_type_flags(rows))
    return flagged.groupBy("csn_customer_id", session, "csn_game_id").agg(*measures)


def with_session_metrics(summary: DataFrame) -> DataFrame:
    """Adds duration, gain, loss and the result label.

    The label looks at gross wins: a session that lost more than it won is still ``ganho``.
    """
    won, staked = F.col("total_ganhos"), F.col("total_apostas")
    money = summary.schema["total_ganhos"].dataType
    return summary.withColumns(
        {
            "session_duration_seconds": seconds_between(
                F.col("session_start"), F.col("session_end")
            ),
            "ganhos_jogador": floored_difference(won, staked, money),
            "perda_jogador": floored_difference(staked, won, money),
            "result_session": F.when(won > 0, "ganho").otherwise("perda"),
        }
    )


def money_as_double(df: DataFrame) -> DataFrame:
    """Output form: decimals become doubles."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def other_types(df: DataFrame) -> DataFrame:
    """Rows whose type is not a core one; rows without a type are kept."""
    return df.where(none_of(F.col(TYPE), CORE_TYPES))


def other_types_output(rows: DataFrame) -> DataFrame:
    """Row-level output for non-core types of sessionized rows."""
    return other_types(rows).select(
        "csn_customer_id",
        "sessionid",
        F.col(TYPE).alias("type"),
        F.col(AMOUNT).alias("total_amount"),
    )
