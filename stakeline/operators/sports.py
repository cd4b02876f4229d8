"""Sports-bet reports."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeline.functions import codes
from stakeline.functions.times import tz_shift, within
from stakeline.operators.asof import asof_last
from stakeline.operators.lanes import HotKeys, find_hot
from stakeline.operators.quality import distinct_ids
from stakeline.params import (
    DEFAULT_SKEW,
    SPORTS_FILTER_HOURS,
    SPORTS_REPORT_HOURS,
    SkewPolicy,
    TimeWindow,
)
from stakeline.sources.sinks import stage_table

MASTER = "sport_bet_master_id"


def sport_bet_ids(
    transactions: DataFrame,
    details: DataFrame,
    masters: DataFrame,
    selections: DataFrame,
    window: TimeWindow,
    hours: int = SPORTS_FILTER_HOURS,
) -> DataFrame:
    """Ids of bets transacted in the window (in shifted time) that have a header and a leg.

    The window's ends are shifted instead of the column, so the filter reaches the scan. Only
    existence matters: every side is reduced to distinct keys before it is shuffled, and the
    ids are made distinct before the later joins, which then share one partitioning.
    """
    back = timedelta(hours=hours)
    stored_time = TimeWindow(window.start - back, window.end - back)
    in_window = details.where(within(F.col("transaction_date"), stored_time))
    made = transactions.where(F.col(MASTER).isNotNull()).join(
        distinct_ids(in_window, "customer_transaction_id"), "customer_transaction_id", "left_semi"
    )
    return (
        distinct_ids(made, MASTER)
        .join(distinct_ids(masters, MASTER), MASTER, "left_semi")
        .join(distinct_ids(selections, MASTER), MASTER, "left_semi")
    )


def only_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose bet is among ``ids``."""
    return df.join(ids.select(MASTER), MASTER, "left_semi")


def id_range(ids: DataFrame) -> Column:
    """The range the stored ids span, as a condition on rows with an id.

    Rows outside it are skipped by the minimum and maximum of their row group. On the ids
    themselves it drops nothing, but tells Spark that they are a selection, so that it sends a Bloom
    filter of them to the scan of a long history; behind a stored table it cannot know.
    """
    low, high = ids.agg(F.min(MASTER), F.max(MASTER)).first()
    return F.lit(False) if low is None else F.col(MASTER).between(F.lit(low), F.lit(high))


def bets_with_login(
    bets: DataFrame,
    logins: DataFrame,
    skew: SkewPolicy = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Adds the address of the customer's latest login at or before the bet."""
    tiebreak = "log_id" if "log_id" in logins.columns else None
    return asof_last(
        bets,
        logins,
        "customer_id",
        "create_user_date",
        "date_time",
        "ip",
        "ip_address",
        tiebreak,
        skew,
        hot,
    )


def bets_report(
    bets: DataFrame,
    masters: DataFrame,
    customers: DataFrame,
    customer_details: DataFrame,
    logins: DataFrame,
    ids: DataFrame,
    skew: SkewPolicy = DEFAULT_SKEW,
    hours: int = SPORTS_REPORT_HOURS,
) -> DataFrame:
    """One row per bet with labels, amounts, login address and shifted times.

    A few days of bets meet a whole history of logins, so logins of other customers are dropped
    first. That partitions the logins as the bets are by then, and the lookup needs no shuffle
    of its own. The chosen bets are stored, as they are read three times.
    """
    chosen = stage_table(only_ids(bets, ids), "chosen_bets")
    bettors = distinct_ids(chosen, "customer_id")
    logins_of_bettors = logins.join(bettors, "customer_id", "left_semi")
    joined = (
        chosen.join(masters.select(MASTER, "initial_played_amount", "is_system_bet"), MASTER)
        .join(customers.select("customer_id"), "customer_id")
        .join(customer_details.select("customer_id"), "customer_id")
    )
    # Counted before the joins, which would be computed twice; customers without a bet are no
    # longer hot once their logins are dropped.
    active = chosen.select("customer_id").union(logins.select("customer_id"))
    hot = find_hot(active, ("customer_id",), skew).among(bettors)
    status = F.col("status")
    return bets_with_login(joined, logins_of_bettors, skew, hot).select(
        "customer_id",
        F.col(MASTER).alias("bet_master_id"),
        "ip_address",
        codes.bet_type(F.col("total_play")).alias("bet_type"),
        codes.bet_status(status).alias("bet_status"),
        F.col("bet_rate").alias("fixed_odds"),
        F.col("initial_played_amount").alias("bet_amount"),
        "return_amount",
        codes.is_cashout(status).alias("is_cashout"),
        codes.is_system_bet(F.col("is_system_bet")).alias("is_system_bet"),
        tz_shift(F.col("create_user_date"), hours).alias("bet_timestamp"),
        tz_shift(F.col("update_date"), hours).alias("update_timestamp"),
    )


def events_report(selections: DataFrame, ids: DataFrame) -> DataFrame:
    """The event of every bet leg."""
    return only_ids(selections, ids).select(
        F.col("fixture_id").alias("event_id"),
        F.col("sport_type_id").alias("sport_code"),
        F.col("league_name").alias("competition"),
        F.col("fixture_information").alias("event_name"),
        codes.event_status(F.col("status")).alias("event_status"),
        F.col("fixture_start_date").alias("event_start_date"),
    )


def markets_report(selections: DataFrame, ids: DataFrame) -> DataFrame:
    """The market of every bet leg."""
    return only_ids(selections, ids).select(
        F.col("sport_bet_detail_id").alias("market_id"),
        F.col("fixture_id").alias("event_id"),
        F.col(MASTER).alias("bet_master_id"),
        F.col("bet_type_name").alias("market_name"),
        F.lit("1").alias("market_type"),
        F.col("played_odd").alias("fixed_odds_market"),
        F.col("played_amount").alias("market_value"),
        codes.market_result(F.col("status")).alias("market_result"),
    )
