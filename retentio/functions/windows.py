"""Date windows. Pure Python on an explicit ``as_of`` date.

Every window is a function of "today"; queries never call ``current_date()``.
On the 1st of a month the reports cover the previous full month.
"""

from __future__ import annotations

import calendar
import datetime as dt
from fractions import Fraction
from typing import NamedTuple


def first_of_month(d: dt.date) -> dt.date:
    return d.replace(day=1)


def last_of_month(d: dt.date) -> dt.date:
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


def add_months(d: dt.date, n: int) -> dt.date:
    """Calendar month shift that clips to the month end (like ``add_months``)."""
    m = d.year * 12 + d.month - 1 + n
    y, m = divmod(m, 12)
    last = calendar.monthrange(y, m + 1)[1]
    return dt.date(y, m + 1, min(d.day, last))


class MonthWindows(NamedTuple):
    itm: dt.date  # first day of the current month
    ftm: dt.date  # last day of the current month
    ilm: dt.date  # first day of the previous month
    flm: dt.date  # last day of the previous month


def month_windows(as_of: dt.date) -> MonthWindows:
    """Current and last month; on day 1 both move one month back."""
    ref = as_of - dt.timedelta(days=1) if as_of.day == 1 else as_of
    itm = first_of_month(ref)
    ftm = as_of - dt.timedelta(days=1) if as_of.day == 1 else last_of_month(as_of)
    flm = itm - dt.timedelta(days=1)
    ilm = first_of_month(flm)
    return MonthWindows(itm, ftm, ilm, flm)


def three_month_window(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Day 1: first of (yesterday - 2 months) .. yesterday; else first of (today - 2 months) .. month end."""
    if as_of.day == 1:
        y = as_of - dt.timedelta(days=1)
        return first_of_month(add_months(y, -2)), y
    return first_of_month(add_months(as_of, -2)), last_of_month(as_of)


def n_month_start(as_of: dt.date, n: int) -> dt.date:
    """Start of an n-month window: first of (today - n) on day 1, else first of (today - (n - 1))."""
    return first_of_month(add_months(as_of, -n if as_of.day == 1 else -(n - 1)))


def last_complete_week(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Monday..Sunday of the latest week that ended on or before ``as_of``."""
    fin = as_of - dt.timedelta(days=(as_of.weekday() + 1) % 7)
    return fin - dt.timedelta(days=6), fin


def run_rate(as_of: dt.date, fri: float = 1.4, sat: float = 1.4, sun: float = 1.4) -> float:
    """D20 driver-side scalar: weighted share of the month elapsed before ``as_of``.

    Day 1 -> 1; nothing elapsed -> 0.01. The distributed form of the same rule
    lives in ``retentio.operators.boards.run_rate_frame``.
    """
    if as_of.day == 1:
        return 1.0
    # exact arithmetic: the ratio is rounded once, like a division of two sums
    weights = [Fraction(1)] * 4 + [Fraction(str(fri)), Fraction(str(sat)), Fraction(str(sun))]
    days = calendar.monthrange(as_of.year, as_of.month)[1]
    total = sum(weights[dt.date(as_of.year, as_of.month, d).weekday()] for d in range(1, days + 1))
    done = sum(weights[dt.date(as_of.year, as_of.month, d).weekday()] for d in range(1, as_of.day))
    return 0.01 if done == 0 else float(done / total)
