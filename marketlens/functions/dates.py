"""Date keys, period predicates and boundary-counting date differences.

SQL ``DATEDIFF(unit, a, b)`` counts unit *boundaries crossed*, unlike Spark's
``timestampdiff`` which counts whole elapsed units (Jan-31 -> Feb-1 is 1 month boundary,
0 whole months).  The helpers below implement the boundary form with plain arithmetic.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def as_date_lit(d) -> Column:
    """A date as a column; None is the current date."""
    if d is None:
        return F.current_date()
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def date_key(d) -> Column:
    """``yyyyMMdd`` integer key."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def days_between(a, b) -> Column:
    """DAY boundaries from ``a`` to ``b`` (``b - a`` in calendar days, time of day ignored)."""
    return F.datediff(F.to_date(_c(b)), F.to_date(_c(a)))


def months_between_boundary(a, b) -> Column:
    a, b = _c(a), _c(b)
    return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))


def quarters_between_boundary(a, b) -> Column:
    a, b = _c(a), _c(b)
    return (F.year(b) * 4 + F.quarter(b)) - (F.year(a) * 4 + F.quarter(a))


def hours_between_boundary(a, b) -> Column:
    """HOUR boundaries: calendar days x 24 plus the hour-of-day difference (zone independent)."""
    a, b = _c(a), _c(b)
    return (days_between(a, b).cast("long") * 24 + (F.hour(b) - F.hour(a))).cast("long")


def minutes_between_boundary(a, b) -> Column:
    """MINUTE boundaries: hour boundaries x 60 plus the minute difference."""
    a, b = _c(a), _c(b)
    return (hours_between_boundary(a, b) * 60 + (F.minute(b) - F.minute(a))).cast("long")


def weeks_between_boundary(a, b) -> Column:
    """WEEK boundaries with Sunday as first day of week: whole weeks between the Sundays
    on or before each date."""
    a, b = F.to_date(_c(a)), F.to_date(_c(b))
    sa = F.date_sub(a, F.dayofweek(a) - 1)
    sb = F.date_sub(b, F.dayofweek(b) - 1)
    return (F.datediff(sb, sa) / 7).cast("int")


def sunday_week_of_year(d) -> Column:
    """``DATEPART(WEEK, d)`` with weeks starting Sunday and week 1 holding Jan 1."""
    d = F.to_date(_c(d))
    jan1 = F.trunc(d, "year")
    return (F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7) + 1).cast("int")


def in_last_days(col, as_of, days: int, include_as_of: bool = True) -> Column:
    """``col >= as_of - days`` (open-ended form) or ``as_of - days <= col < as_of`` (closed)."""
    c = _c(col)
    start = F.date_sub(as_date_lit(as_of), days)
    if include_as_of:
        return c >= start
    return (c >= start) & (c < as_date_lit(as_of))


def in_window(col, as_of, start_days_ago: int, end_days_ago: int) -> Column:
    """``as_of - start <= col < as_of - end`` (e.g. previous period 60..30 days ago)."""
    c = _c(col)
    a = as_date_lit(as_of)
    return (c >= F.date_sub(a, start_days_ago)) & (c < F.date_sub(a, end_days_ago))
