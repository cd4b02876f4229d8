"""Time expressions on zone-less timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from stakeline.params import DAY_START_HOUR, TimeWindow

SECONDS_MASK = "yyyy-MM-dd HH:mm:ss"


def ntz(value: datetime | str) -> Column:
    """Zone-less literal, so a comparison leaves the column bare and reaches the scan."""
    return F.lit(str(value)).cast("timestamp_ntz")


def parse_timestamp(text: Column, mask: str = SECONDS_MASK) -> Column:
    return F.to_timestamp_ntz(text, F.lit(mask))


def within(ts: Column, window: TimeWindow) -> Column:
    """Closed range test. An end of 05:59:59 leaves out 05:59:59.5."""
    return ts.between(ntz(window.start), ntz(window.end))


def seconds_between(earlier: Column, later: Column) -> Column:
    """Elapsed wall-clock seconds with microsecond fraction; independent of the session zone."""
    return (later - earlier).cast("interval second").cast("decimal(18,6)").cast("double")


def tz_shift(ts: Column, hours: int) -> Column:
    """Move a zone-less timestamp by a fixed, signed number of hours."""
    return ts + F.make_dt_interval(hours=F.lit(hours))


def business_day(ts: Column) -> Column:
    """Date of the business day a time falls in."""
    return tz_shift(ts, -DAY_START_HOUR).cast("date")
