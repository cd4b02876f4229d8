"""Checks and reports on a table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from stakeline.operators.lanes import HotKeys, all_present, find_hot, merge
from stakeline.params import DEFAULT_SKEW, ESSENTIALS, SkewPolicy


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The same table, or an error naming every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns must be created first: {missing}")
    return df


def drop_null_essentials(df: DataFrame, columns: Iterable[str] = ESSENTIALS) -> DataFrame:
    """Rows with every essential column."""
    return df.where(all_present(list(columns)))


def null_report(df: DataFrame, columns: Iterable[str] = ESSENTIALS) -> DataFrame:
    """One row: row count, nulls per column, and whether any column holds one."""
    columns = list(columns)
    counts = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]
    any_null = F.greatest(*[F.col(f"{c}_nulls") for c in columns], F.lit(0)) > 0
    return df.agg(F.count(F.lit(1)).alias("row_count"), *counts).withColumn("has_nulls", any_null)


def row_count(df: DataFrame, name: str) -> DataFrame:
    """One row naming the table and its number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same table, and its row count once it has been written; costs no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen


def has_rows(df: DataFrame) -> bool:
    """Reads only until the first row."""
    return not df.isEmpty()


def duplicate_report(
    df: DataFrame,
    keys: tuple[str, ...],
    skew: SkewPolicy = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """All rows whose key occurs more than once.

    Copies are counted by a window, except for hot keys: there counts are added up per task
    first and joined back, which AQE can split. ``hot`` may cover some of the key columns.
    """
    cold_rows, hot_rows = (hot or find_hot(df, keys, skew)).split(df)
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    repeated = cold_rows.withColumn("_copies", copies).where("_copies > 1").drop("_copies")
    if hot_rows is None:
        return repeated
    repeated_keys = hot_rows.groupBy(*keys).count().where("count > 1")
    return merge([repeated, hot_rows.join(repeated_keys, [*keys], "left_semi")])


def drilldown(df: DataFrame, customer: int) -> DataFrame:
    """Rows of one customer; the filter moves below windows keyed on the customer."""
    return df.where(F.col("csn_customer_id") == customer)


def first_per_group(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per group, the first in order.

    Spark keeps one row per group and task before the shuffle, so large groups do not move.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    """Unique non-null values of one column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def sort_transactions(df: DataFrame) -> DataFrame:
    """By customer, then time. The id as last key lets a busy customer span several tasks."""
    return df.orderBy("csn_customer_id", "transaction_date", "customer_transaction_id")


def sort_by_time(df: DataFrame) -> DataFrame:
    return df.orderBy("transaction_date", "customer_transaction_id")
