"""Calendar-driven dashboard queries: date dimension, weekly/monthly comparisons, weekday profile.

Week, month and weekday are functions of the fact's date, so the period queries compute them on the
fact (no calendar join, the fact is read once), filter to the look-back window first, aggregate at
the period grain, and only then window per account/campaign.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from ..functions.dates import as_date_lit
from ..operators.calendar import calendar_columns, date_dimension as _calendar, date_spine
from ..operators.windows import lag_change_pct, lag_of
from ..sources.catalog import Tables
from . import search_ads as sa


def date_dimension(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Calendar over the account_stats date range."""
    return _calendar(date_spine(t["account_stats"]), as_of)


def _on_calendar(fact: DataFrame, as_of, cols: list[str]) -> DataFrame:
    attributes = calendar_columns(F.col("date"), as_of)
    return fact.where(F.col("date").isNotNull()).withColumns({c: attributes[c] for c in cols})


def _period_kpis(prefix: str) -> list:
    return [
        ratio(f"{prefix}_clicks", f"{prefix}_impressions", "100.0", (10, 4)).alias(f"{prefix}_ctr"),
        ratio(f"{prefix}_spend", f"{prefix}_clicks", None, (18, 4)).alias(f"{prefix}_cpc"),
        ratio(f"{prefix}_conversions", f"{prefix}_clicks", "100.0", (10, 4)).alias(f"{prefix}_conversion_rate"),
        ratio(f"{prefix}_revenue", f"{prefix}_spend", None, (10, 4)).alias(f"{prefix}_roas"),
    ]


def _period_sums(prefix: str) -> list:
    return [F.sum("spend").alias(f"{prefix}_spend"), F.sum("impressions").alias(f"{prefix}_impressions"),
            F.sum("clicks").alias(f"{prefix}_clicks"), F.sum("conversions").alias(f"{prefix}_conversions"),
            F.sum("conversions_value").alias(f"{prefix}_revenue")]


def q_weekly_wow_yoy(t: Tables, as_of: _dt.date | None = None, weeks: int = 12, long_range: bool = False) -> DataFrame:
    """Weekly account totals over the last ``weeks`` weeks with LAG 1 (week over week) and
    LAG 52 (same week last year; NULL unless 52 earlier weekly rows exist in the window)."""
    if long_range:
        t = _LongRange(t)
    a = sa.account_performance(t).filter(F.col("date") >= F.date_sub(as_of_lit(as_of), 7 * weeks))
    keys = ["year", "week_of_year", "week_start_date", "week_end_date", "account_name"]
    w = _on_calendar(a, as_of, keys[:4]).groupBy(*keys).agg(*_period_sums("weekly"))
    p, o = ["account_name"], ["year", "week_of_year"]
    return w.select(
        *keys, "weekly_spend", "weekly_impressions", "weekly_clicks", "weekly_conversions", "weekly_revenue",
        lag_of(p, o, "weekly_spend", 1).alias("previous_week_spend"),
        lag_of(p, o, "weekly_conversions", 1).alias("previous_week_conversions"),
        lag_of(p, o, "weekly_spend", 52).alias("same_week_ly_spend"),
        lag_of(p, o, "weekly_conversions", 52).alias("same_week_ly_conversions"),
        lag_change_pct(p, o, "weekly_spend", 1).alias("spend_wow_change_pct"),
        lag_change_pct(p, o, "weekly_conversions", 1).alias("conversions_wow_change_pct"),
        *_period_kpis("weekly")).orderBy(F.desc("year"), F.desc("week_of_year"), "account_name")


def q_monthly_mom_yoy(t: Tables, as_of: _dt.date | None = None, months: int = 13, long_range: bool = False) -> DataFrame:
    """Monthly account totals over the last ``months`` months with LAG 1 and LAG 12."""
    if long_range:
        t = _LongRange(t)
    a = sa.account_performance(t).filter(F.col("date") >= F.add_months(as_of_lit(as_of), -months))
    keys = ["year", "month_number", "month_name", "year_month", "account_name"]
    m = _on_calendar(a, as_of, keys[:4]).groupBy(*keys).agg(*_period_sums("monthly"))
    p, o = ["account_name"], ["year", "month_number"]
    return m.select(
        *keys, "monthly_spend", "monthly_impressions", "monthly_clicks", "monthly_conversions", "monthly_revenue",
        lag_of(p, o, "monthly_spend", 1).alias("previous_month_spend"),
        lag_of(p, o, "monthly_conversions", 1).alias("previous_month_conversions"),
        lag_of(p, o, "monthly_spend", 12).alias("same_month_ly_spend"),
        lag_of(p, o, "monthly_conversions", 12).alias("same_month_ly_conversions"),
        lag_change_pct(p, o, "monthly_spend", 1).alias("spend_mom_change_pct"),
        lag_change_pct(p, o, "monthly_spend", 12).alias("spend_yoy_change_pct"),
        *_period_kpis("monthly")).orderBy(F.desc("year"), F.desc("month_number"), "account_name")


def q_day_of_week(t: Tables, as_of: _dt.date | None = None, days: int = 90) -> DataFrame:
    """Campaign performance by weekday over the last ``days`` days, with each weekday's cost
    per conversion compared to the campaign's average across weekdays."""
    from pyspark.sql import Window
    from ..functions import rules
    c = sa.campaign_performance(t).filter(F.col("date") >= F.date_sub(as_of_lit(as_of), days))
    keys = ["day_name", "day_of_week", "campaign_name", "account_name"]
    g = _on_calendar(c, as_of, ["day_name", "day_of_week"]).groupBy(*keys).agg(
        F.count_distinct("date").alias("days_in_analysis"),
        F.sum("spend").alias("total_spend"), F.avg("spend").alias("avg_daily_spend"),
        F.sum("impressions").alias("total_impressions"), F.avg("impressions").alias("avg_daily_impressions"),
        F.sum("clicks").alias("total_clicks"), F.avg("clicks").alias("avg_daily_clicks"),
        F.sum("conversions").alias("total_conversions"), F.avg("conversions").alias("avg_daily_conversions"),
        F.sum("conversions_value").alias("_value"))
    cpa = F.col("total_spend") / F.col("total_conversions")
    has = F.col("total_conversions") > 0
    camp_avg = F.avg(F.when(F.col("total_conversions") != 0, cpa)).over(Window.partitionBy("campaign_name"))
    return g.select(
        *keys, "days_in_analysis", "total_spend", "avg_daily_spend", "total_impressions", "avg_daily_impressions",
        "total_clicks", "avg_daily_clicks", "total_conversions", "avg_daily_conversions",
        ratio("total_clicks", "total_impressions", "100.0", (10, 4)).alias("ctr_percent"),
        ratio("total_spend", "total_clicks", None, (18, 4)).alias("avg_cpc"),
        ratio("total_conversions", "total_clicks", "100.0", (10, 4)).alias("conversion_rate"),
        ratio("total_spend", "total_conversions", None, (18, 4)).alias("cost_per_conversion"),
        ratio("_value", "total_spend", None, (10, 4)).alias("roas"),
        rules([(has & (cpa < camp_avg), "Above Average"), (has, "Below Average")], "No Conversions")
        .alias("day_performance")).orderBy("campaign_name", "day_of_week", "account_name")


def as_of_lit(as_of):
    return as_date_lit(as_of)


class _LongRange(Tables):
    """View of a Tables whose ``account_stats`` is the long-range (1995-2001) variant."""

    def __init__(self, base: Tables):
        super().__init__(base.spark)
        self._base = base

    def __getitem__(self, name: str) -> DataFrame:
        if name == "account_stats" and self._base.has("account_stats_long"):
            return self._base["account_stats_long"]
        return self._base[name]


def q_weekly_wow_yoy_long(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Weekly comparison over the long-range fixture (52-week LAG populated)."""
    return q_weekly_wow_yoy(t, as_of, weeks=60, long_range=True)


def q_monthly_mom_yoy_long(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Monthly comparison over the long-range fixture (12-month LAG populated)."""
    return q_monthly_mom_yoy(t, as_of, months=13, long_range=True)
