"""Parameters of the reports, as plain Python values that become column literals.

Every report takes its dates as arguments; nothing reads the current date, so a
run can be repeated.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


def _plus_months(day: dt.date, months: int) -> dt.date:
    """Calendar month arithmetic that clips to the last day of a shorter month."""
    index = day.year * 12 + (day.month - 1) + months
    year, month = divmod(index, 12)
    first_of_next = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last_day = (first_of_next - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(day.day, last_day))


@dataclass(frozen=True)
class DateWindow:
    """Half-open date range ``[start, end)``."""

    start: dt.date
    end: dt.date

    @classmethod
    def between(cls, start: str, end: str) -> "DateWindow":
        return cls(dt.date.fromisoformat(start), dt.date.fromisoformat(end))

    @classmethod
    def last_12_months(cls, as_of: str) -> "DateWindow":
        """One year back from ``as_of`` up to and including ``as_of``."""
        day = dt.date.fromisoformat(as_of)
        return cls(_plus_months(day, -12), day + dt.timedelta(days=1))

    @classmethod
    def since(cls, start: str, as_of: str) -> "DateWindow":
        """From ``start`` up to and including ``as_of``."""
        return cls(dt.date.fromisoformat(start), dt.date.fromisoformat(as_of) + dt.timedelta(days=1))


@dataclass(frozen=True)
class Payment:
    """What counts as a paid registration."""

    currency: str = "EUR"
    paid_status: int = 1
