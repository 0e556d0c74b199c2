"""Search-ads dashboard queries: executive metrics, daily trend, campaign matrix, budget
pacing and conversion funnel."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import change_pct, dec, ratio, rules
from ..functions.dates import as_date_lit, in_last_days, in_window
from ..operators.ranks import global_ranks
from ..operators.shares import with_group_aggs
from ..sources.catalog import Tables
from . import search_ads as sa
from .time_periods import date_dimension


def q_executive_metrics(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Per account: last 30 days (open-ended) against the 30 days before, in one pass."""
    ap = sa.account_performance(t).filter(in_last_days("date", as_of, 60))
    cur = in_last_days("date", as_of, 30)
    prev = in_window("date", as_of, 60, 30)

    def s(cond, c):
        return F.sum(F.when(cond, F.col(c)).otherwise(F.lit(0)))

    g = ap.groupBy("account_name", "currency_code").agg(
        s(cur, "spend").alias("current_spend"), s(cur, "impressions").alias("current_impressions"),
        s(cur, "clicks").alias("current_clicks"), s(cur, "conversions").alias("current_conversions"),
        s(cur, "conversions_value").alias("current_revenue"),
        s(prev, "spend").alias("previous_spend"), s(prev, "conversions").alias("previous_conversions"))
    return g.select(
        "*", change_pct("current_spend", "previous_spend").alias("spend_change_pct"),
        ratio("current_clicks", "current_impressions", "100.0", (10, 4)).alias("current_ctr"),
        ratio("current_spend", "current_clicks", None, (18, 4)).alias("current_cpc"),
        ratio("current_conversions", "current_clicks", "100.0", (10, 4)).alias("current_conversion_rate"),
        ratio("current_revenue", "current_spend", None, (10, 4)).alias("current_roas"))


def q_daily_trend(t: Tables, as_of: _dt.date | None = None, days: int = 90) -> DataFrame:
    """Gap-filled daily series over [as_of - days, as_of): calendar LEFT JOIN daily totals,
    with running totals.  Facts are summed per date before the join; the running total is an
    ordered window over at most ``days`` rows."""
    a = as_date_lit(as_of)
    cal = date_dimension(t, as_of).filter((F.col("date") >= F.date_sub(a, days)) & (F.col("date") < a)) \
        .select("date", "day_name", "week_of_year", "month_name", "year_month")
    daily = sa.account_performance(t).filter((F.col("date") >= F.date_sub(a, days)) & (F.col("date") < a)) \
        .groupBy("date").agg(F.sum("spend").alias("_spend"), F.sum("impressions").alias("_imp"),
                             F.sum("clicks").alias("_clicks"), F.sum("conversions").alias("_conv"),
                             F.sum("conversions_value").alias("_rev"))
    g = cal.join(daily, "date", "left")
    run = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero_l = F.lit(0).cast("long")
    return g.select(
        "date", "day_name", "week_of_year", "month_name", "year_month",
        F.coalesce("_spend", F.lit(0)).alias("daily_spend"), F.coalesce("_imp", zero_l).alias("daily_impressions"),
        F.coalesce("_clicks", zero_l).alias("daily_clicks"), F.coalesce("_conv", F.lit(0)).alias("daily_conversions"),
        F.coalesce("_rev", F.lit(0)).alias("daily_revenue"),
        ratio("_clicks", "_imp", "100.0", (10, 4), guard=F.coalesce("_imp", zero_l) > 0).alias("daily_ctr"),
        ratio("_spend", "_clicks", None, (18, 4), guard=F.coalesce("_clicks", zero_l) > 0).alias("daily_cpc"),
        ratio("_conv", "_clicks", "100.0", (10, 4), guard=F.coalesce("_clicks", zero_l) > 0)
        .alias("daily_conversion_rate"),
        F.sum("_spend").over(run).alias("cumulative_spend"),
        F.sum("_conv").over(run).alias("cumulative_conversions"),
    ).orderBy("date")


def q_campaign_matrix(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Campaign efficiency score against the all-campaign averages (one-row aggregate joined
    back), BCG-style quadrant, and whole-result percent ranks."""
    cp = sa.campaign_performance(t).filter(in_last_days("date", as_of, 30))
    g = cp.groupBy("campaign_name", "campaign_status", "advertising_channel_type").agg(
        F.sum("spend").alias("total_spend"), F.sum("impressions").alias("_imp"), F.sum("clicks").alias("total_clicks"),
        F.sum("conversions").alias("total_conversions"), F.sum("conversions_value").alias("total_conversions_value"))
    g = g.select(
        "campaign_name", "campaign_status", "advertising_channel_type", "total_spend", "total_clicks",
        "total_conversions", "total_conversions_value",
        ratio("total_clicks", "_imp", "100.0", (10, 4)).alias("ctr_percent"),
        ratio("total_spend", "total_clicks", None, (18, 4)).alias("avg_cpc"),
        ratio("total_conversions", "total_clicks", "100.0", (10, 4)).alias("conversion_rate_percent"),
        ratio("total_spend", "total_conversions", None, (18, 4), default=999999).alias("cost_per_conversion"),
        ratio("total_conversions_value", "total_spend", None, (10, 4)).alias("roas"),
    ).filter(F.col("total_spend") > 0)
    g = with_group_aggs(g, [], {"_avg_cvr": F.avg("conversion_rate_percent"), "_avg_roas": F.avg("roas"),
                                "_avg_cpa": F.avg("cost_per_conversion")})
    cvr, roas, cpa = F.col("conversion_rate_percent"), F.col("roas"), F.col("cost_per_conversion")
    a_cvr, a_roas, a_cpa = F.col("_avg_cvr"), F.col("_avg_roas"), F.col("_avg_cpa")
    score = (F.try_divide(cvr, F.nullif(a_cvr, F.lit(0))) + F.try_divide(roas, F.nullif(a_roas, F.lit(0)))
             + (F.lit(1) - F.try_divide(cpa, F.nullif(a_cpa, F.lit(1))))) / F.lit(3) * F.lit(100)
    g = g.select(
        "campaign_name", "campaign_status", "advertising_channel_type", "total_spend", "total_clicks",
        "total_conversions", "total_conversions_value", "ctr_percent", "avg_cpc", "conversion_rate_percent",
        "cost_per_conversion", "roas",
        F.when((F.col("total_conversions") > 0) & (F.col("total_spend") > 0), score).otherwise(F.lit(0))
        .cast("decimal(10,2)").alias("efficiency_score"),
        rules([((cvr >= a_cvr) & (roas >= a_roas), "Stars (High CVR, High ROAS)"),
               ((cvr >= a_cvr) & (roas < a_roas), "Question Marks (High CVR, Low ROAS)"),
               ((cvr < a_cvr) & (roas >= a_roas), "Cash Cows (Low CVR, High ROAS)")],
              "Dogs (Low CVR, Low ROAS)").alias("performance_quadrant"))
    return global_ranks(g, {"conversions_percentile": ("percent", [("total_conversions", True)]),
                            "roas_percentile": ("percent", [("roas", True)]),
                            "efficiency_percentile": ("percent", [("cost_per_conversion", False)])})


def q_budget_pacing(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Budget utilisation of the last 30 days per (campaign name, daily budget)."""
    cp = sa.campaign_performance(t).filter(in_last_days("date", as_of, 30) & (F.col("budget_amount") > 0)) \
        .select("campaign_name", F.col("budget_amount").alias("daily_budget"), "date", "spend", "conversions")
    b, sp = F.col("daily_budget"), F.col("spend")
    near, over, under = sp >= b * dec("0.9"), sp >= b, sp < b * dec("0.5")
    g = cp.groupBy("campaign_name", "daily_budget").agg(
        F.sum("spend").alias("total_spend_30d"), F.avg("spend").alias("avg_daily_spend"),
        F.count_distinct("date").alias("days_with_data"),
        F.count(F.when(near, 1)).alias("days_near_budget"), F.count(F.when(over, 1)).alias("days_at_or_over_budget"),
        F.count(F.when(under, 1)).alias("days_underspending"),
        F.avg(F.when(near, F.col("conversions"))).alias("avg_conversions_high_spend"),
        F.avg(F.when(under, F.col("conversions"))).alias("avg_conversions_low_spend"))
    util = ratio("total_spend_30d", F.col("daily_budget") * F.col("days_with_data"), "100", (10, 2),
                 guard=F.lit(True))
    g = g.withColumn("budget_utilization_pct", util)
    u = F.col("budget_utilization_pct")
    return g.select(
        "campaign_name", "daily_budget", (b * dec("30.4")).alias("estimated_monthly_budget"), "total_spend_30d",
        "avg_daily_spend", "budget_utilization_pct", "days_with_data", "days_near_budget", "days_at_or_over_budget",
        "days_underspending", "avg_conversions_high_spend", "avg_conversions_low_spend",
        rules([(u > 95, "Consider increasing budget"), (u < 50, "Budget underutilized - check targeting/bids")],
              "Budget pacing is healthy").alias("budget_recommendation"),
    ).orderBy(F.col("budget_utilization_pct").desc())


def q_conversion_funnel(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Impressions -> clicks -> conversions drop-off per campaign, ordered by spend."""
    cp = sa.campaign_performance(t).filter(in_last_days("date", as_of, 30))
    g = cp.groupBy("account_name", "campaign_name").agg(
        F.sum("impressions").alias("stage_1_impressions"), F.sum("clicks").alias("stage_2_clicks"),
        F.sum("conversions").alias("stage_3_conversions"), F.sum("conversions_value").alias("_value"),
        F.sum("spend").alias("_spend")).filter(F.col("stage_1_impressions") > 0)
    imp, clk, conv = F.col("stage_1_impressions"), F.col("stage_2_clicks"), F.col("stage_3_conversions")
    return g.orderBy(F.col("_spend").desc()).select(
        "account_name", "campaign_name", "stage_1_impressions", "stage_2_clicks", "stage_3_conversions",
        ratio(imp - clk, imp, "100", (10, 2), guard=imp > 0).alias("impressions_to_clicks_dropoff_pct"),
        ratio(clk - conv, clk, "100", (10, 2), guard=clk > 0).alias("clicks_to_conversions_dropoff_pct"),
        ratio(conv, imp, "100.0", (10, 6)).alias("overall_conversion_rate_pct"),
        ratio("_value", imp, "1000", (18, 4)).alias("value_per_1000_impressions"),
        ratio("_value", clk, None, (18, 4)).alias("value_per_click"))
