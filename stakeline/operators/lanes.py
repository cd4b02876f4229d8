"""Ordered work per key that no hot key can overload.

A window over ``PARTITION BY key`` puts all rows of a key into one task. That is the right
plan for keys one task can hold. The few keys above that size are handled apart: their rows
are range-partitioned on (key, order), which cuts them into chunks of about equal size even
where all rows of a key carry the same time, and each chunk gets what the chunks before it
hand on (last value, running sum). What is handed on is one row per chunk and key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stakeline.params import SkewPolicy
from stakeline.sources.sinks import stage_table

CHUNK = "_chunk"
# Keys in a list that is sent to every task.
MOST_LISTED = 1_000_000
BEFORE = (Window.unboundedPreceding, -1)


def range_chunks(df: DataFrame, order: list[str], chunks: int) -> DataFrame:
    """Adds the number of the contiguous slice of the sort order a row lies in.

    The slice bounds come from a sample, so a second evaluation could cut elsewhere. Writing
    the rows to the shared folder pins the numbers for all later readers and for retries after
    a lost executor, and lets each reader fetch only its columns.
    """
    sliced = df.repartitionByRange(chunks, *order).withColumn(CHUNK, F.spark_partition_id())
    return stage_table(sliced, "chunks")


@dataclass(frozen=True)
class HotKeys:
    """Keys with more rows than one task should hold; at most rows / max_rows of them.

    ``rows`` is about how many rows they have in all, if that is known.
    """

    columns: tuple[str, ...]
    values: list[tuple]
    rows: float | None = None

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Rows of other keys (null keys among them), and rows of hot keys if there are any."""
        if not self.values:
            return df, None
        return self._join(df, "left_anti"), self.only(df)

    def only(self, df: DataFrame) -> DataFrame:
        """Rows of hot keys."""
        return self._join(df, "left_semi")

    def among(self, df: DataFrame) -> HotKeys:
        """Those of the keys that occur in ``df``."""
        if not self.values:
            return self
        found = self._listed(df).join(df, [*self.columns], "left_semi").collect()
        return replace(self, values=[tuple(row) for row in found])

    def _listed(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame(
            self.values, df.select(*self.columns).schema
        )

    def _join(self, df: DataFrame, how: str) -> DataFrame:
        listed = self._listed(df)
        # A caller's list may be of any length.
        listed = F.broadcast(listed) if len(self.values) <= MOST_LISTED else listed
        return df.join(listed, [*self.columns], how)


@dataclass(frozen=True)
class Lane:
    """Rows with keys and an order, whole per key, or cut into chunks if the keys are hot."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: HotKeys | None = None

    @property
    def chunked(self) -> bool:
        return self.hot is not None

    @property
    def _by(self) -> list[str]:
        return [*self.keys, CHUNK] if self.chunked else [*self.keys]

    def with_df(self, df: DataFrame) -> Lane:
        return replace(self, df=df)

    def rows(self) -> DataFrame:
        return self.df.drop(CHUNK)

    def previous(self, columns: dict[str, str]) -> Lane:
        """Adds columns of the key's row before, given as new name -> column."""
        in_order = Window.partitionBy(*self._by).orderBy(*self.order)
        near = {out: F.lag(column).over(in_order) for out, column in columns.items()}
        seen = self.with_df(self.df.withColumns(near))
        if not self.chunked:
            return seen
        tail = F.struct(*[F.col(c).alias(out) for out, c in columns.items()])
        # Only the first row of a chunk has no row before it in the chunk.
        first = F.row_number().over(in_order) == 1
        handed = seen.with_df(seen.df.withColumn("_first", first))._hand_on(tail)
        picked = {
            out: F.when(F.col("_first"), F.col(f"_from_before.{out}")).otherwise(F.col(out))
            for out in columns
        }
        return self.with_df(handed.withColumns(picked).drop("_from_before", "_first"))

    def last_before(self, value: Column, out: str) -> Lane:
        """Adds the latest non-null ``value`` among earlier rows of the key."""
        in_order = Window.partitionBy(*self._by).orderBy(*self.order)
        near = F.last(value, ignorenulls=True).over(in_order.rowsBetween(*BEFORE))
        seen = self.with_df(self.df.withColumn(out, near))
        if not self.chunked:
            return seen
        handed = seen._hand_on(value)
        return self.with_df(
            handed.withColumn(out, F.coalesce(out, "_from_before")).drop("_from_before")
        )

    def running_sum(self, value: Column, out: str, ties: str | None = None) -> Lane:
        """Adds the running sum of a non-negative ``value`` up to and with the row.

        ``ties`` names the leading order column: rows equal in it share the sum at their last.
        """
        window = Window.partitionBy(*self._by)
        in_order = (
            window.orderBy(ties).rangeBetween(Window.unboundedPreceding, Window.currentRow)
            if ties
            else window.orderBy(*self.order).rowsBetween(
                Window.unboundedPreceding, Window.currentRow
            )
        )
        summed = self.df.withColumn(out, F.sum(value).over(in_order))
        if not self.chunked:
            return self.with_df(summed)
        first = F.col(self.order[0])
        chunk_sums = summed.groupBy(*self._by).agg(
            F.max(out).alias("_sum"),
            F.min(out).alias("_lead_sum"),
            F.min(first).alias("_first"),
            F.max(first).alias("_last"),
        )
        by_chunk = self._chunks_of_key()
        same_start = Window.partitionBy(*self.keys, "_first").orderBy(CHUNK)
        # A run of equal times may go on into later chunks; what those add to it is the sum
        # of their leading runs that start at the same time.
        run_on = F.sum("_lead_sum").over(same_start.rowsBetween(0, Window.unboundedFollowing))
        handed_on = (
            chunk_sums.withColumn("_run_on", run_on)
            .withColumn(
                "_tie_extra",
                F.when(
                    F.lead("_first").over(by_chunk) == F.col("_last"),
                    F.lead("_run_on").over(by_chunk),
                ),
            )
            .withColumn("_sum_before", F.sum("_sum").over(by_chunk.rowsBetween(*BEFORE)))
            .select(*self._by, "_sum_before", "_tie_extra", "_last")
        )
        total = F.col(out) + F.coalesce("_sum_before", F.lit(0))
        if ties:
            total += F.when(first == F.col("_last"), F.coalesce("_tie_extra", F.lit(0))).otherwise(0)
        return self.with_df(
            self._give(summed, handed_on)
            .withColumn(out, total)
            .drop("_sum_before", "_tie_extra", "_last")
        )

    def attach(self, per_key: DataFrame) -> Lane:
        """Joins a table of one row per key."""
        if self.chunked:
            # Chunked rows stay where they are: one row per hot key is sent to them.
            per_key = self._sent(self.hot.only(per_key))
        return self.with_df(self.df.join(per_key, [*self.keys]))

    def _hand_on(self, value: Column) -> DataFrame:
        """Adds ``_from_before``: the last non-null ``value`` of the key's earlier chunks."""
        position = F.struct(*self.order, value.alias("value"))
        tails = self.df.groupBy(*self._by).agg(
            F.max(F.when(value.isNotNull(), position)).alias("_tail")
        )
        before = self._chunks_of_key().rowsBetween(*BEFORE)
        last = F.last(F.col("_tail.value"), ignorenulls=True).over(before)
        return self._give(self.df, tails.select(*self._by, last.alias("_from_before")))

    def _chunks_of_key(self):
        return Window.partitionBy(*self.keys).orderBy(CHUNK)

    def _give(self, df: DataFrame, handed_on: DataFrame) -> DataFrame:
        return df.join(self._sent(handed_on), self._by)

    def _sent(self, per_chunk: DataFrame) -> DataFrame:
        """Broadcasts one row per chunk and key: at most (chunks + hot keys) rows, both bounded by
        rows / max_rows. A caller's list of keys may be longer; its rows are shuffled instead."""
        return F.broadcast(per_chunk) if len(self.hot.values) <= MOST_LISTED else per_chunk


def all_present(columns: tuple[str, ...] | list[str]) -> Column:
    """No column is null, in the form that reaches the scan."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def find_hot(df: DataFrame, columns: tuple[str, ...], skew: SkewPolicy) -> HotKeys:
    """Counts keys on a sample. Runs at once, so pass the barest table that has the keys."""
    estimate = (F.count(F.lit(1)) / F.lit(skew.fraction)).alias("rows")
    found = (
        df.select(*columns)
        .where(all_present(columns))
        .sample(skew.fraction, seed=7)
        .groupBy(*columns)
        .agg(estimate)
        .where(F.col("rows") > skew.max_rows)
        .collect()
    )
    return HotKeys(
        columns, [tuple(row)[:-1] for row in found], sum(row["rows"] for row in found)
    )


def lanes(
    df: DataFrame,
    keys: tuple[str, ...],
    order: tuple[str, ...],
    skew: SkewPolicy,
    hot: HotKeys | None = None,
    then: Callable[[DataFrame], DataFrame] = lambda part: part,
) -> list[Lane]:
    """One lane of whole keys, and a chunked one where some keys are hot.

    ``hot`` may come from an earlier count, over some or all of the key columns. ``then`` is a
    step on rows that is done on each part after the split, so no part of it is done twice.
    """
    hot = hot or find_hot(df, keys, skew)
    cold_rows, hot_rows = hot.split(df)
    found = [Lane(then(cold_rows), keys, order)]
    if hot_rows is not None:
        if hot.rows is None:
            chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        else:
            chunks = max(2, ceil(2 * hot.rows / skew.max_rows))
        sliced = range_chunks(then(hot_rows), [*keys, *order], chunks)
        found.append(Lane(sliced, keys, order, hot))
    return found


def merge(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
