"""Column-level helpers (pure expressions; everything stays inside whole-stage codegen)."""
from .kpi import change_pct, dec, ratio, share_pct, safe_div, sum_if, avg_if, count_if, count_distinct_if, min_if, max_if
from .rules import rules
from .text import concat_safe, left
from .dates import (
    date_key, days_between, months_between_boundary, hours_between_boundary, minutes_between_boundary,
    weeks_between_boundary, quarters_between_boundary, sunday_week_of_year, in_last_days, in_window,
)

__all__ = [
    "change_pct", "dec", "ratio", "share_pct", "safe_div", "sum_if", "avg_if", "count_if", "count_distinct_if", "min_if",
    "max_if", "rules", "concat_safe", "left", "date_key", "days_between", "months_between_boundary",
    "hours_between_boundary", "minutes_between_boundary", "weeks_between_boundary", "quarters_between_boundary",
    "sunday_week_of_year", "in_last_days", "in_window",
]
