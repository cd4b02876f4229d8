"""As-of lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakeline.operators.lanes import HotKeys, find_hot, lanes, merge
from stakeline.params import DEFAULT_SKEW, SkewPolicy

SPREAD = 4096


def asof_last(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    value: str,
    out: str,
    tiebreak: str | None = None,
    skew: SkewPolicy = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Adds ``value`` of the key's latest right row at or before the left row's time.

    A null value on that row stays null. Rows of equal time are decided by ``tiebreak``, else
    by the value. Both sides are stacked and each left row looks back along the time order:
    one shuffle, and no pair of rows is ever formed.
    """
    hits = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key),
        F.col(right_time).alias("_at"),
        F.lit(0).alias("_side"),
        F.col(tiebreak or value).alias("_tie"),
        F.struct(F.col(value).alias("v")).alias("_hit"),
        F.lit(0).cast("long").alias("_spread"),
        # Ties that change no result; it cuts tied rows of a hot key into chunks too.
        F.xxhash64(*right.columns).alias("_last"),
    )
    # Left rows that cannot match are spread evenly instead of meeting under the null key.
    spread = F.when(F.col(key).isNotNull(), F.lit(0).cast("long")).otherwise(
        1 + F.pmod(F.xxhash64(*left.columns), F.lit(SPREAD))
    )
    asked = left.withColumns(
        {
            "_at": F.col(left_time),
            "_side": F.lit(1),
            "_spread": spread,
            "_last": F.xxhash64(*left.columns),
        }
    )
    stacked = asked.unionByName(hits, allowMissingColumns=True)
    if hot is None:
        hot = find_hot(left.select(key).union(right.select(key)), (key,), skew)
    order = ("_at", "_side", "_tie", "_last")
    # Right rows come first among equal times, which makes "at or before" inclusive.
    found = merge(
        [
            lane.last_before(F.col("_hit"), "_found").rows()
            for lane in lanes(stacked, (key, "_spread"), order, skew, hot)
        ]
    )
    return found.where(F.col("_side") == 1).select(
        *left.columns, F.col("_found.v").alias(out)
    )
