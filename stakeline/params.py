"""Parameters shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

# Transaction type codes of the ledger.
BET = 1
WINS = (2, 8)
REWARD = 15
CORE_TYPES = (1, 2, 8, 15)

# Session rule and the id used when no session was stored yet.
SESSION_GAP_SECONDS = 1200
FIRST_SESSION_ID = 23888517

# Columns a transaction must have to take part in a session.
ESSENTIALS = ("transaction_date", "csn_customer_id", "csn_game_id")

# Hours added to stored times in the sports filter and the sports reports.
SPORTS_FILTER_HOURS = -6
SPORTS_REPORT_HOURS = -3

# Fixed value: hour at which a business day starts.
DAY_START_HOUR = 6

MASK = "%Y-%m-%d %H:%M:%S"

# Names and fallbacks of the window's text parameters.
START_NAME, END_NAME = "data_inicio", "data_fim"
DEFAULT_START, DEFAULT_END = "2024-01-01 00:00:00", "2024-12-31 23:59:59"


@dataclass(frozen=True)
class TimeWindow:
    """Closed time range: rows at ``start`` and at ``end`` both belong to it."""

    start: datetime
    end: datetime

    @classmethod
    def of(cls, start: str, end: str) -> TimeWindow:
        return cls(datetime.strptime(start, MASK), datetime.strptime(end, MASK))

    @classmethod
    def from_variables(
        cls,
        variables: Mapping[str, str],
        start_name: str = START_NAME,
        end_name: str = END_NAME,
        default_start: str = DEFAULT_START,
        default_end: str = DEFAULT_END,
    ) -> TimeWindow:
        """Named text parameters, each with a fallback."""
        return cls.of(
            variables.get(start_name, default_start), variables.get(end_name, default_end)
        )


@dataclass(frozen=True)
class SkewPolicy:
    """When a key is too large for one task.

    ``max_rows`` is what one task sorts comfortably; keys above it are cut into chunks.
    Keys are counted on a sample that holds about ``sample_rows`` rows of such a key, so the
    count costs one narrow scan and next to no shuffle. At most rows / max_rows keys qualify.
    """

    max_rows: int = 20_000_000
    sample_rows: int = 1_000

    @property
    def fraction(self) -> float:
        return min(1.0, self.sample_rows / self.max_rows)


DEFAULT_SKEW = SkewPolicy()
