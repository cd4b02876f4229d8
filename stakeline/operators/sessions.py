"""Sessionizing: previous row, new-session flag and reason, ordered session ids.

Two id rules exist side by side. The shared rule gives rows tied on (customer, time) one id;
the row rule counts flags row by row and starts above a stored maximum. Both number sessions
in (customer, time) order over all customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakeline.functions.times import seconds_between, within
from stakeline.operators.lanes import HotKeys, Lane, lanes, merge
from stakeline.operators.quality import drop_null_essentials
from stakeline.params import (
    DEFAULT_SKEW,
    FIRST_SESSION_ID,
    SESSION_GAP_SECONDS,
    SkewPolicy,
    TimeWindow,
)

CUSTOMER = ("csn_customer_id",)
# The id makes the order total: without it the previous row of tied rows is arbitrary. Rows that
# repeat an id are ordered by game, so rows equal in all three have equal flags in any order.
TIME_ORDER = ("transaction_date", "customer_transaction_id", "csn_game_id")

GAP = "dif_data_atual_com_anterior"
LOCAL = "customer_session"
SHIFT = "_shift"

# Reasons for a new session.
FIRST_ROW = "Data anterior vazia"
GAP_AND_GAME = "Passou 20 minutos, mas mudou de jogo"
GAP_ONLY = "Passou 20 minutos"
GAME_ONLY = "Mudou de jogo"
SAME_SESSION = "-"


def new_session(gap: float) -> Column:
    """First row of the customer, gap strictly longer, or another game."""
    return (
        F.col("anterior_data").isNull()
        | (F.col(GAP) > gap)
        | F.coalesce(F.col("csn_game_id") != F.col("anterior_game_id"), F.lit(False))
    )


def new_session_reason(gap: float) -> Column:
    late = F.col(GAP) > gap
    other_game = F.col("csn_game_id") != F.col("anterior_game_id")
    return (
        F.when(F.col("anterior_data").isNull(), FIRST_ROW)
        .when(late & other_game, GAP_AND_GAME)
        .when(late, GAP_ONLY)
        .when(other_game, GAME_ONLY)
        .otherwise(SAME_SESSION)
    )


def _with_previous(lane: Lane) -> Lane:
    seen = lane.previous(
        {"anterior_data": "transaction_date", "anterior_game_id": "csn_game_id"}
    )
    gap = seconds_between(F.col("anterior_data"), F.col("transaction_date"))
    return seen.with_df(seen.df.withColumn(GAP, gap))


def _flagged(lane: Lane, gap: float) -> Lane:
    seen = _with_previous(lane)
    return seen.with_df(
        seen.df.withColumns(
            {"nova_sessao": new_session(gap), "motivo_nova_sessao": new_session_reason(gap)}
        )
    )


def with_previous(txn: DataFrame, skew: SkewPolicy = DEFAULT_SKEW) -> DataFrame:
    """Adds the customer's previous time and game, and the gap in seconds."""
    return merge([_with_previous(lane).rows() for lane in lanes(txn, CUSTOMER, TIME_ORDER, skew)])


def flag_sessions(
    txn: DataFrame, gap: float = SESSION_GAP_SECONDS, skew: SkewPolicy = DEFAULT_SKEW
) -> DataFrame:
    """``with_previous`` plus the new-session flag and its reason."""
    return merge([_flagged(lane, gap).rows() for lane in lanes(txn, CUSTOMER, TIME_ORDER, skew)])


def running_total(df: DataFrame, key: str, value: str, out: str, bits=(20, 22)) -> DataFrame:
    """Adds the running sum of ``value`` in key order, for a table of one row per integer key.

    A running sum without PARTITION BY runs in a single task. Here it runs inside buckets of
    2^20 neighbouring ids, and the bucket sums are added up in the same way on two further
    levels. No task ever holds more than 2^22 rows, however the ids are spread. All uses of a
    level read the same shuffle, so the input is computed once.
    """
    if not bits:
        return df.withColumn(out, F.sum(value).over(Window.orderBy(key)))
    bucket, start = f"_bucket{len(bits)}", f"_start{len(bits)}"
    # Never null: the join then adds no null filter below the shuffle, and its two sides keep
    # reading the same one.
    number = F.coalesce(F.shiftright(key, bits[0]), F.lit(0))
    inside = df.withColumn(bucket, number).withColumn(
        "_inside", F.sum(value).over(Window.partitionBy(bucket).orderBy(key))
    )
    sums = inside.groupBy(bucket).agg(F.max("_inside").alias("_sum"))
    ends = running_total(sums, bucket, "_sum", "_end", bits[1:])
    starts = ends.select(bucket, (F.col("_end") - F.col("_sum")).alias(start))
    return inside.join(starts, bucket).select(
        *df.columns, (F.col(start) + F.col("_inside")).alias(out)
    )


def count_up(lane: Lane, shared_ties: bool) -> Lane:
    """Numbers the flagged sessions of each customer from 1, as ``customer_session``."""
    starts = F.col("nova_sessao").cast("long")
    return lane.running_sum(starts, LOCAL, "transaction_date" if shared_ties else None)


def customer_shift(totals: DataFrame, total: str) -> DataFrame:
    """Number of sessions of all smaller customer ids, from the number per customer."""
    upto = running_total(totals, CUSTOMER[0], total, "_upto")
    return upto.select(*CUSTOMER, (F.col("_upto") - F.col(total)).alias(SHIFT))


def shifted(df: DataFrame, out: str, base: int) -> DataFrame:
    """Turns the customer's own numbers into numbers over all customers, above ``base``."""
    number = F.col(LOCAL) + F.col(SHIFT) + F.lit(base)
    return df.withColumn(out, number).drop(LOCAL, SHIFT)


def flagged_lanes(
    txn: DataFrame, gap: float, skew: SkewPolicy, hot: HotKeys | None = None
) -> list[Lane]:
    return [_flagged(lane, gap) for lane in lanes(txn, CUSTOMER, TIME_ORDER, skew, hot)]


def number_sessions(
    txn: DataFrame,
    out: str,
    gap: float = SESSION_GAP_SECONDS,
    shared_ties: bool = True,
    base: int = 0,
    skew: SkewPolicy = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Flags sessions and numbers them over all customers, first id ``base`` + 1.

    Numbers count up within the customer first; then each customer is shifted by the number
    of sessions of all smaller customer ids. The shift joins on the partitioning the rows
    already have.
    """
    flagged = flagged_lanes(txn, gap, skew, hot)
    sessions = F.sum(F.col("nova_sessao").cast("long")).alias("_sessions")
    totals = merge([lane.df.groupBy(*CUSTOMER).agg(sessions) for lane in flagged])
    shift = customer_shift(totals, "_sessions")
    return merge(
        [
            shifted(count_up(lane, shared_ties).attach(shift).rows(), out, base)
            for lane in flagged
        ]
    )


def process_sessions(
    view: DataFrame,
    window: TimeWindow,
    gap: float = SESSION_GAP_SECONDS,
    skew: SkewPolicy = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Session table function: bounded, complete rows with lag columns, flag, reason and id.

    Sessions are cut at the window's ends. ``hot`` names customers known to be too large for a
    task, such as those found by an earlier run; without it they are looked for.
    """
    typed = drop_null_essentials(view.where(within(F.col("transaction_date"), window))).select(
        F.col("customer_transaction_id").cast("long").alias("customer_transaction_id"),
        F.col("csn_customer_id").cast("long").alias("csn_customer_id"),
        F.col("transaction_date").cast("timestamp_ntz").alias("transaction_date"),
        F.col("game_name").cast("string").alias("game_name"),
        F.col("tipo_name").cast("string").alias("tipo_name"),
        F.col("csn_game_id").cast("long").alias("csn_game_id"),
    )
    return number_sessions(typed, "id_sessao", gap, skew=skew, hot=hot).select(
        F.col("customer_transaction_id").alias("transaction_id"),
        "csn_customer_id",
        "transaction_date",
        "game_name",
        "tipo_name",
        "csn_game_id",
        GAP,
        "anterior_game_id",
        "anterior_data",
        "nova_sessao",
        "motivo_nova_sessao",
        "id_sessao",
    )


def session_table(
    view: DataFrame,
    window: TimeWindow,
    gap: float = SESSION_GAP_SECONDS,
    skew: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """The stored form of the session rows: ten columns, no names."""
    return process_sessions(view, window, gap, skew).select(
        F.col("transaction_id").alias("customer_transaction_id"),
        "csn_customer_id",
        "csn_game_id",
        "anterior_game_id",
        "transaction_date",
        "anterior_data",
        GAP,
        "nova_sessao",
        "id_sessao",
        "motivo_nova_sessao",
    )


def ledger_rows(ledger: DataFrame, window: TimeWindow) -> DataFrame:
    """Complete ledger rows of the window with the columns the summary needs."""
    bounded = ledger.where(within(F.col("transaction_date"), window))
    return drop_null_essentials(bounded).select(
        "customer_transaction_id",
        "csn_customer_id",
        "amount_from_balance",
        "transaction_date",
        "csn_game_id",
        "csn_cust_transaction_type_id",
        "current_balance",
    )


def frame_sessions(
    ledger: DataFrame,
    window: TimeWindow,
    start_id: int = FIRST_SESSION_ID,
    gap: float = SESSION_GAP_SECONDS,
    skew: SkewPolicy = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Ledger rows with ``sessionid`` by the row rule; the first id is ``start_id`` + 1.

    All transaction types take part in the gap test.
    """
    rows = ledger_rows(ledger, window)
    numbered = number_sessions(rows, "sessionid", gap, False, start_id, skew, hot)
    return numbered.select(*rows.columns, "nova_sessao", "sessionid")
