"""Two-way routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stakeline.functions.codes import holds, matches_core_pattern
from stakeline.operators.lanes import all_present
from stakeline.params import ESSENTIALS


def route(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where the predicate holds, and all others; unknown counts as not holding."""
    held = holds(predicate)
    return df.where(held), df.where(~held)


def route_types(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Core transaction types and all others."""
    return route(df, matches_core_pattern(F.col(column)))


def route_complete(df: DataFrame, columns=ESSENTIALS) -> tuple[DataFrame, DataFrame]:
    """Rows with every essential column, and rows lacking one."""
    return route(df, all_present(columns))
