"""Keyed updates: filling in game ids and dimension attributes.

Spark's file tables are not updated in place; every update is a join that yields a new table.
The updating side is reduced to one row per key first, so no row multiplies and the outcome
does not depend on the order in which several matches are applied: the greatest value wins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeline.functions.codes import is_bet, is_core
from stakeline.functions.times import within
from stakeline.operators.lanes import HotKeys, all_present, find_hot, lanes, merge
from stakeline.params import DEFAULT_SKEW, SkewPolicy, TimeWindow

TYPE = "csn_cust_transaction_type_id"
KEY = ["csn_customer_id", "transaction_date"]
SPREAD = 4096


def bets_extract(
    bets: DataFrame, games: DataFrame, categories: DataFrame, window: TimeWindow
) -> DataFrame:
    """Bets played in the window with game name and category; bets lacking either drop out."""
    return (
        bets.where(within(F.col("played_date"), window))
        .join(games, "csn_game_id")
        .join(categories, F.col("csn_category_id") == F.col("category_id"))
        .select(
            "customer_id",
            "csn_game_id",
            "played_date",
            "update_date",
            "vendor_game_name",
            "csn_category_id",
            F.col("category_name").alias("csn_category_name"),
        )
    )


def _one_game_per_key(bets: DataFrame, time: str) -> DataFrame:
    keyed = bets.select(
        F.col("customer_id").alias(KEY[0]), F.col(time).alias(KEY[1]), F.col("csn_game_id")
    )
    return (
        keyed.where(all_present(KEY))
        .groupBy(*KEY)
        .agg(F.max("csn_game_id").alias("_game"), F.lit(True).alias("_matched"))
    )


def _set_game(df: DataFrame, game: Column, columns: list[str]) -> DataFrame:
    return df.withColumn("csn_game_id", game).select(*columns)


def update_overwrite(ledger: DataFrame, bets: DataFrame) -> DataFrame:
    """Bet rows take the game of the bet played at their time, even over a stored one."""
    joined = ledger.join(_one_game_per_key(bets, "played_date"), KEY, "left")
    applies = is_bet(F.col(TYPE)) & F.col("_matched").isNotNull()
    game = F.when(applies, F.col("_game")).otherwise(F.col("csn_game_id"))
    return _set_game(joined, game, ledger.columns)


def update_fill_null(ledger: DataFrame, bets: DataFrame) -> DataFrame:
    """Core rows without a game take that of the bet updated at their time."""
    joined = ledger.join(_one_game_per_key(bets, "update_date"), KEY, "left")
    found = F.when(is_core(F.col(TYPE)), F.col("_game"))
    return _set_game(joined, F.coalesce("csn_game_id", found), ledger.columns)


def fill_from_bets(ledger: DataFrame, bets: DataFrame) -> DataFrame:
    """``update_overwrite`` and then ``update_fill_null`` in one join.

    Both match the ledger on (customer, time), so the two times of each bet become two rows of
    one lookup table and the ledger is shuffled once. Bets must have a game, as those from
    ``bets_extract`` do.
    """
    return fill_from_lookup(ledger, bets_lookup(bets))


def bets_lookup(bets: DataFrame) -> DataFrame:
    """One row per customer and time: the games of bets played and of bets updated then."""
    no_game = F.lit(None).cast("long")
    sides = F.array(
        F.struct(
            F.col("played_date").alias("at"),
            F.col("csn_game_id").alias("played"),
            no_game.alias("updated"),
        ),
        F.struct(
            F.col("update_date").alias("at"),
            no_game.alias("played"),
            F.col("csn_game_id").alias("updated"),
        ),
    )
    return (
        bets.select(F.col("customer_id").alias(KEY[0]), F.inline(sides))
        .withColumnRenamed("at", KEY[1])
        .where(all_present(KEY))
        .groupBy(*KEY)
        .agg(F.max("played").alias("_played"), F.max("updated").alias("_updated"))
    )


def fill_from_lookup(ledger: DataFrame, lookup: DataFrame) -> DataFrame:
    """The join of ``fill_from_bets``."""
    joined = ledger.join(lookup, KEY, "left")
    game = F.coalesce(
        F.when(is_bet(F.col(TYPE)), F.col("_played")),
        F.col("csn_game_id"),
        F.when(is_core(F.col(TYPE)), F.col("_updated")),
    )
    return _set_game(joined, game, ledger.columns)


def _may_fill() -> Column:
    return is_core(F.col(TYPE)) & all_present(KEY)


def find_hot_histories(ledger: DataFrame, skew: SkewPolicy = DEFAULT_SKEW) -> HotKeys:
    """Customers and types with too many core rows for one task."""
    return find_hot(ledger.where(_may_fill()), (KEY[0], TYPE), skew)


def fill_forward(
    ledger: DataFrame,
    skew: SkewPolicy = DEFAULT_SKEW,
    hot: HotKeys | None = None,
    then: Callable[[DataFrame], DataFrame] = lambda part: part,
) -> DataFrame:
    """Core rows without a game take the latest game the customer had, strictly earlier, in a
    row of the same type; of several at that time the greatest.

    Rows without a game sort before those with one at the same time, so "earlier in the row
    order" is "strictly earlier in time" for them. Filled values are not passed on, which
    changes nothing: they equal the value they came from. ``then`` is a step before this one
    that fills games too; it is done after hot keys are split off.
    """
    # Rows that take no part are spread evenly instead of meeting under a null or other key.
    spread = F.when(_may_fill(), F.lit(0)).otherwise(
        1 + F.pmod(F.xxhash64("customer_transaction_id"), F.lit(SPREAD))
    )
    parts = [
        lane.last_before(F.col("csn_game_id"), "_earlier").rows()
        for lane in lanes(
            ledger.withColumn("_spread", spread),
            (KEY[0], TYPE, "_spread"),
            # The id cuts rows tied in the others into chunks too.
            (KEY[1], "csn_game_id", "customer_transaction_id"),
            skew,
            hot or find_hot_histories(ledger, skew),
            then,
        )
    ]
    earlier = F.when(F.col("_spread") == 0, F.col("_earlier"))
    return _set_game(merge(parts), F.coalesce("csn_game_id", earlier), ledger.columns)


def dim_lookup(
    games: DataFrame, categories: DataFrame, ids: DataFrame | None = None
) -> DataFrame:
    """Category (if any) and vendor name of games; with ``ids``, of those occurring there."""
    if ids is not None:
        games = games.join(ids.select("csn_game_id"), "csn_game_id", "left_semi")
    return (
        games.join(categories, F.col("csn_category_id") == F.col("category_id"), "left")
        .select(
            "csn_game_id",
            F.col("category_name").alias("game_category"),
            F.col("vendor_game_name").alias("vendor_name"),
        )
        .distinct()
    )


def update_attributes(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts take category and vendor name of their game, nulls included; facts without a
    dimension row keep theirs."""
    one_per_game = (
        dim.where(F.col("csn_game_id").isNotNull())
        .groupBy("csn_game_id")
        .agg(F.max(F.struct("vendor_name", "game_category")).alias("_dim"))
    )
    matched = F.col("_dim").isNotNull()
    return (
        fact.join(one_per_game, "csn_game_id", "left")
        .withColumns(
            {
                "category": F.when(matched, F.col("_dim.game_category")).otherwise(
                    F.col("category")
                ),
                "vendor_game_name": F.when(matched, F.col("_dim.vendor_name")).otherwise(
                    F.col("vendor_game_name")
                ),
            }
        )
        .select(*fact.columns)
    )
