"""Measures on money and counts.

Money is exact: prices are decimals with two places, and quotients are rounded
half away from zero from an exact decimal, never from a double.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
TOTAL = "decimal(22,2)"
SQUARES = "decimal(38,4)"


def conversion_pct(part: str, whole: str, on_zero: int | None = None) -> Column:
    """``100 * part / whole`` to two places. A zero ``whole`` gives ``on_zero``."""
    quotient = f"CAST({part} AS decimal(20,0)) * 100 / nullif(CAST({whole} AS decimal(20,0)), 0)"
    pct = f"CAST(round({quotient}, 2) AS decimal(20,2))"
    return F.expr(pct if on_zero is None else f"coalesce({pct}, CAST({on_zero} AS decimal(20,2)))")


def mean_ticket(total: str, count: str) -> str:
    """SQL text of the mean to two places; NULL for a zero count."""
    quotient = f"CAST({total} AS {TOTAL}) / nullif(CAST({count} AS decimal(20,0)), 0)"
    return f"CAST(round({quotient}, 2) AS {TOTAL})"


def pop_stddev(count: str, total: str, total_of_squares: str) -> str:
    """SQL text of the population standard deviation to two places, from sums that add up over groups.

    In whole cents, with the mean ``q = s div n`` and the rest ``r = s - q * n``, the squares about ``q`` add up to
    ``d = sum(x^2) - q * (s + r)``, and the variance is ``(d * n - r^2) / n^2``. ``d`` and ``r`` are exact and no
    step is larger than the sum of squares, so one formula serves all sizes; it meets a root halfway between two
    cents exactly where ``d * n`` fits a double's 53 bits.
    """
    n, s = f"CAST({count} AS decimal(19,0))", f"CAST({total} * 100 AS decimal(25,0))"
    q = f"CAST({s} div nullif({n}, 0) AS decimal(13,0))"
    r = f"CAST({s} - {q} * {n} AS decimal(19,0))"
    d = f"CAST(CAST({total_of_squares} * 10000 AS decimal(38,0)) - {q} * CAST({s} + {r} AS decimal(25,0)) AS double)"
    wide = f"CAST({count} AS double)"
    spread = f"greatest({d} * {wide} - CAST({r} AS double) * CAST({r} AS double), 0D)"
    return f"CAST(CAST(round(sqrt({spread}) / nullif({wide}, 0D), 0) AS decimal(22,0)) / 100 AS {TOTAL})"


def price_tiers(mean: str, stddev: str, lowest: str) -> dict[str, Column]:
    """Floor, target and premium price from already rounded statistics."""
    mean, stddev, lowest = (f"coalesce(CAST({c} AS {TOTAL}), 0)" for c in (mean, stddev, lowest))
    tiers = {
        "suggested_price_floor_EUR": f"greatest({mean} - 0.50 * {stddev}, {lowest})",
        "suggested_price_target_EUR": mean,
        "suggested_price_premium_EUR": f"{mean} + 0.75 * {stddev}",
    }
    return {name: F.expr(f"CAST(round({price}, 2) AS {TOTAL})") for name, price in tiers.items()}


def age_as_of(birthday: Column, day: dt.date) -> Column:
    """Completed years; NULL stays NULL. Born 29 Feb, a year completes on 1 March."""
    return F.timestamp_diff("YEAR", birthday.cast("timestamp_ntz"), F.lit(day).cast("timestamp_ntz"))


def thousands(amount: Column) -> Column:
    """``1,235``: half rounds away from zero."""
    return F.format_number(F.round(amount, 0), 0)
