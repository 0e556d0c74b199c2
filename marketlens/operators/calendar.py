"""Date spine and calendar dimension.

The spine spans MIN..MAX of a fact's date column: a one-row aggregate exploded with
``sequence`` (no numbers table, no 2048-day cap).  Its size is the number of days in the
range - bounded by the calendar, not by data volume - so joining it to facts by date is a
broadcast hash join.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date_lit, date_key, sunday_week_of_year


def date_spine(fact: DataFrame, col: str = "date") -> DataFrame:
    bounds = fact.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("date"))


def _flag(cond) -> "F.Column":
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


CALENDAR = """
date_id date day_name day_of_week day_of_month day_of_year is_weekday week_of_year
iso_week_of_year week_start_date week_end_date month_number month_name month_name_short month_start_date month_end_date
quarter_number quarter_name quarter_start_date quarter_end_date year year_start_date year_end_date fiscal_year
fiscal_quarter year_month year_quarter year_month_sort is_today is_yesterday is_last_7_days is_last_30_days
is_current_month is_previous_month is_current_year is_previous_year days_ago
""".split()


def calendar_columns(d: Column, as_of: _dt.date | None) -> dict[str, Column]:
    """Calendar attributes as functions of a date column; relative flags are evaluated at ``as_of`` (None: today).

    Weeks start on Sunday (``day_of_week`` 1 = Sunday); ``week_of_year`` counts Sunday-start
    weeks with week 1 holding January 1; ``iso_week_of_year`` is the ISO week; the fiscal
    calendar equals the calendar one; ``year_quarter`` reads ``yyyy-Q<n>``."""
    a = as_date_lit(as_of)
    dow = F.dayofweek(d)
    q = F.quarter(d)
    y = F.year(d)
    prev_month = F.add_months(a, -1)
    cols = [
        date_key(d), d,
        F.date_format(d, "EEEE"), dow, F.dayofmonth(d),
        F.dayofyear(d), _flag(~dow.isin(1, 7)),
        sunday_week_of_year(d), F.weekofyear(d),
        F.date_sub(d, dow - 1), F.date_add(d, 7 - dow),
        F.month(d), F.date_format(d, "MMMM"),
        F.substring(F.date_format(d, "MMMM"), 1, 3),
        F.trunc(d, "month"), F.last_day(d),
        q, F.concat(F.lit("Q"), q.cast("string")),
        F.make_date(y, (q - 1) * 3 + 1, F.lit(1)),
        F.last_day(F.make_date(y, q * 3, F.lit(1))),
        y, F.make_date(y, F.lit(1), F.lit(1)),
        F.make_date(y, F.lit(12), F.lit(31)),
        y, q,
        F.date_format(d, "yyyy-MM"),
        F.concat(y.cast("string"), F.lit("-Q"), q.cast("string")),
        F.date_format(d, "yyyy-MM"),
        _flag(d == a), _flag(d == F.date_sub(a, 1)),
        _flag((d >= F.date_sub(a, 7)) & (d < a)),
        _flag((d >= F.date_sub(a, 30)) & (d < a)),
        _flag((y == F.year(a)) & (F.month(d) == F.month(a))),
        _flag((y == F.year(prev_month)) & (F.month(d) == F.month(prev_month))),
        _flag(y == F.year(a)), _flag(y == F.year(a) - 1),
        F.datediff(a, d),
    ]
    return dict(zip(CALENDAR, cols, strict=True))


def date_dimension(spine: DataFrame, as_of: _dt.date | None) -> DataFrame:
    """One calendar row per spine date."""
    cols = calendar_columns(F.col("date"), as_of)
    return spine.select(*[c.alias(n) for n, c in cols.items()])
