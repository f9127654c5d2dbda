"""Named periods, resolved against an explicit ``as_of`` date.

A period becomes a half-open range of literal dates on the raw date column, so
that it reaches the scan as a pushed filter.  ``end`` is ``None`` where a period
is open above: "this month" and "last N days" also count later-dated rows.

Weeks start on Monday.  "last N months" are the N complete months before the
month of ``as_of``.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def month_start(day: dt.date, offset: int = 0) -> dt.date:
    """First day of the month ``offset`` months away from the month of ``day``."""
    months = day.year * 12 + day.month - 1 + offset
    return dt.date(months // 12, months % 12 + 1, 1)


def months_before(as_of: dt.date, n: int) -> list[dt.date]:
    """First days of the ``n`` complete months before the month of ``as_of``."""
    return [month_start(as_of, -i) for i in range(n, 0, -1)]


@dataclass(frozen=True)
class Period:
    start: dt.date
    end: dt.date | None = None

    def contains(self, column: str) -> Column:
        inside = f"{column} >= DATE '{self.start}'"
        if self.end is not None:
            inside += f" AND {column} < DATE '{self.end}'"
        return F.expr(inside)


def hull(*periods: Period) -> Period:
    """Smallest single range that holds all the periods."""
    ends = [p.end for p in periods]
    return Period(min(p.start for p in periods), None if None in ends else max(ends))


def resolve(period: str | Period, as_of: dt.date | str) -> Period:
    """Turn a period name into its date range."""
    if isinstance(period, Period):
        return period
    today = as_date(as_of)
    monday = today - dt.timedelta(days=today.weekday())
    week = dt.timedelta(days=7)
    fixed = {
        "this_month": Period(month_start(today)),
        "last_month": Period(month_start(today, -1), month_start(today)),
        "same_month_last_year": Period(month_start(today, -12), month_start(today, -11)),
        "this_year": Period(dt.date(today.year, 1, 1), dt.date(today.year + 1, 1, 1)),
        "this_week": Period(monday, monday + week),
        "last_week": Period(monday - week, monday),
        "all": Period(dt.date(1, 1, 1)),
    }
    if period in fixed:
        return fixed[period]
    counted = re.fullmatch(r"last_(\d+)_(days|months)", period)
    if counted is None:
        raise ValueError(f"unknown period: {period!r}")
    n = int(counted.group(1))
    if counted.group(2) == "days":
        return Period(today - dt.timedelta(days=n))
    return Period(month_start(today, -n), month_start(today))


def in_period(column: str, period: str | Period, as_of: dt.date | str) -> Column:
    return resolve(period, as_of).contains(column)
