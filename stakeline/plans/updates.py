"""Updates of stored tables: rewrite the folders an update touches, and only those.

A stored table is laid out in folders by day or by bucket of a key. The keys of an update tell the
folders it may touch; these are read, updated and staged (Spark refuses to overwrite what it
reads), and those in which a value differs from before replace theirs. All other folders keep
their files. The updates give the same result when repeated, so a run that broke off
between two folders is mended by running it again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeline.functions.times import business_day
from stakeline.operators.enrich import KEY, bets_lookup, fill_from_lookup, update_attributes
from stakeline.operators.quality import require_columns
from stakeline.sources.commits import LoadedTables
from stakeline.sources.sinks import DAY, replace_days, stage_table, staging

GAME = "csn_game_id"
BUCKET = "game_bucket"
ATTRIBUTES = ("category", "vendor_game_name")
_APPLIED = "applied_lookup"


def update_folders(
    spark: SparkSession,
    path: str,
    by: str,
    touched: DataFrame,
    change: Callable[[DataFrame], DataFrame],
    columns: tuple[str, ...],
) -> list:
    """Updates ``columns`` of the table at ``path`` in the folders ``touched``; returns those rewritten.

    ``touched`` has one column, values of the folder column ``by``; ``change`` gets the rows of
    these folders and returns them with all their columns. What comes to the driver is at most a
    value per folder.
    """
    values = [row[0] for row in touched.distinct().collect() if row[0] is not None]
    if not values:
        return []
    table = spark.read.parquet(path)
    before = {f"_before_{c}": F.col(c) for c in columns}
    with staging(spark):
        rows = change(table.where(F.col(by).isin(values)).withColumns(before))
        rows = stage_table(rows, "updated")
        differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_before_{c}")) for c in columns])
        rewritten = sorted(row[0] for row in rows.where(differs).select(by).distinct().collect())
        if rewritten:
            replaced = rows.where(F.col(by).isin(rewritten)).select(*table.columns)
            replace_days(replaced, path, by)
    return rewritten


def update_stored_games(spark: SparkSession, path: str, bets: DataFrame) -> list:
    """Both updates from bets (overwrite, then fill) on a ledger stored by business day.

    Bets match rows of their own time, so only the days of their times are touched. Returns the
    days rewritten.
    """
    with staging(spark):
        lookup = stage_table(bets_lookup(bets), "bets_lookup")
        days = lookup.select(business_day(F.col(KEY[1])))
        return update_folders(
            spark, path, DAY, days, lambda rows: fill_from_lookup(rows, lookup), (GAME,)
        )


def game_bucket(buckets: int) -> Column:
    """Folder of a game; rows without a game have one of their own, which no lookup touches."""
    number = F.pmod(F.xxhash64(GAME), F.lit(buckets)).cast("int")
    return F.when(F.col(GAME).isNull(), -1).otherwise(number)


def store_by_game(facts: DataFrame, path: str, buckets: int) -> None:
    """Facts in a folder per bucket of their game."""
    rows = require_columns(facts, ATTRIBUTES).withColumn(BUCKET, game_bucket(buckets))
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)


def apply_lookup(
    spark: SparkSession, path: str, dim: DataFrame, applied_root: str, buckets: int
) -> list[int]:
    """Brings facts stored by game up to a lookup, rewriting only buckets of games that changed.

    The lookup applied last is kept under ``applied_root``; a game changed if it was not in there
    or differs from it, nulls counting as a value. Games that left the lookup keep their
    attributes. Facts added since then have to come with theirs, as those of ``attach_dims_job``
    do. Returns the buckets rewritten.
    """
    log = LoadedTables(spark, applied_root)
    known = log.commits()
    with staging(spark):
        one_per_game = dim.where(F.col(GAME).isNotNull()).groupBy(GAME).agg(
            F.max(F.struct("vendor_name", "game_category")).alias("_new")
        )
        lookup = stage_table(one_per_game.select(GAME, "_new.*"), "lookup")
        changed, left_over = lookup, None
        if known:
            last = spark.read.schema(lookup.schema).parquet(
                f"{applied_root}/{_APPLIED}/{known[-1].load_id}"
            )
            same = [F.col(f"n.{c}").eqNullSafe(F.col(f"l.{c}")) for c in lookup.columns]
            changed = lookup.alias("n").join(
                last.alias("l"), reduce(lambda a, b: a & b, same), "left_anti"
            )
            left_over = last.join(lookup, GAME, "left_anti")
        changed = stage_table(changed, "changed")
        rewritten = update_folders(
            spark, path, BUCKET, changed.select(game_bucket(buckets)),
            lambda rows: update_attributes(rows, changed), ATTRIBUTES,
        )
        if not known or not changed.isEmpty():
            load = log.begin(uuid4().hex)
            load.write(lookup if left_over is None else lookup.unionByName(left_over), _APPLIED)
            load.publish()
    return rewritten
