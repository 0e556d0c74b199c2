"""Oracle SQL: search-ads dashboard queries."""
from __future__ import annotations

from .adapters import with_tables
from .kit import change_pct, ratio, xavg
from .search_ads import ACCOUNT_PERFORMANCE_BODY, CAMPAIGN_PERFORMANCE_BODY
from .time_periods import calendar_body

A = "DATE '2024-04-30'"
_AP = with_tables("account_stats", "account_history").rstrip() + f",\nap AS ({ACCOUNT_PERFORMANCE_BODY})\n"
_CP = with_tables("campaign_stats", "campaign_history", "account_history", "account_stats").rstrip() + \
    f",\ncp AS ({CAMPAIGN_PERFORMANCE_BODY})\n"
CUR = f"date >= {A} - 30"
PREV = f"date >= {A} - 60 AND date < {A} - 30"


def s(cond: str, c: str, typ: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN {c} ELSE 0 END) AS {typ})"


SQL: dict[str, str] = {
    "q_executive_metrics": _AP + f"""
SELECT *, {change_pct('current_spend', 'previous_spend', 2)} AS spend_change_pct,
  {ratio('current_clicks * 100', 'current_impressions', 4, 10)} AS current_ctr,
  {ratio('current_spend', 'current_clicks', 4, 18, ns=2)} AS current_cpc,
  {ratio('current_conversions * 100', 'current_clicks', 4, 10, ns=6)} AS current_conversion_rate,
  {ratio('current_revenue', 'current_spend', 4, 10, ns=6, ds=2)} AS current_roas
FROM (SELECT account_name, currency_code,
  {s(CUR, 'spend', 'DECIMAL(28,2)')} AS current_spend, {s(CUR, 'impressions', 'BIGINT')} AS current_impressions,
  {s(CUR, 'clicks', 'BIGINT')} AS current_clicks, {s(CUR, 'conversions', 'DECIMAL(28,6)')} AS current_conversions,
  {s(CUR, 'conversions_value', 'DECIMAL(28,6)')} AS current_revenue,
  {s(PREV, 'spend', 'DECIMAL(28,2)')} AS previous_spend, {s(PREV, 'conversions', 'DECIMAL(28,6)')} AS previous_conversions
  FROM ap WHERE date >= {A} - 60 GROUP BY account_name, currency_code)""",
    "q_daily_trend": _AP.rstrip() + f""",
cal AS ({calendar_body('account_stats', A)}),
g AS (SELECT d.date, d.day_name, d.week_of_year, d.month_name, d.year_month,
        CAST(SUM(a.spend) AS DECIMAL(28,2)) AS _spend, CAST(SUM(a.impressions) AS BIGINT) AS _imp,
        CAST(SUM(a.clicks) AS BIGINT) AS _clicks, CAST(SUM(a.conversions) AS DECIMAL(28,6)) AS _conv,
        CAST(SUM(a.conversions_value) AS DECIMAL(28,6)) AS _rev
      FROM cal d LEFT JOIN ap a ON d.date = a.date
      WHERE d.date >= {A} - 90 AND d.date < {A}
      GROUP BY d.date, d.day_name, d.week_of_year, d.month_name, d.year_month)
SELECT date, day_name, week_of_year, month_name, year_month, COALESCE(_spend, 0) AS daily_spend,
  COALESCE(_imp, 0) AS daily_impressions, COALESCE(_clicks, 0) AS daily_clicks, COALESCE(_conv, 0) AS daily_conversions,
  COALESCE(_rev, 0) AS daily_revenue,
  {ratio('_clicks * 100', '_imp', 4, 10, guard='COALESCE(_imp, 0) > 0')} AS daily_ctr,
  {ratio('_spend', '_clicks', 4, 18, ns=2, guard='COALESCE(_clicks, 0) > 0')} AS daily_cpc,
  {ratio('_conv * 100', '_clicks', 4, 10, ns=6, guard='COALESCE(_clicks, 0) > 0')} AS daily_conversion_rate,
  CAST(SUM(_spend) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,2)) AS cumulative_spend,
  CAST(SUM(_conv) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,6)) AS cumulative_conversions
FROM g""",
    "q_campaign_matrix": _CP.rstrip() + f""",
c AS (SELECT campaign_name, campaign_status, advertising_channel_type, CAST(SUM(spend) AS DECIMAL(28,2)) AS total_spend,
        CAST(SUM(clicks) AS BIGINT) AS total_clicks, CAST(SUM(conversions) AS DECIMAL(28,6)) AS total_conversions,
        CAST(SUM(conversions_value) AS DECIMAL(28,6)) AS total_conversions_value,
        {ratio('SUM(clicks) * 100', 'SUM(impressions)', 4, 10)} AS ctr_percent,
        {ratio('SUM(spend)', 'SUM(clicks)', 4, 18, ns=2)} AS avg_cpc,
        {ratio('SUM(conversions) * 100', 'SUM(clicks)', 4, 10, ns=6)} AS conversion_rate_percent,
        {ratio('SUM(spend)', 'SUM(conversions)', 4, 18, ns=2, ds=6, default='999999')} AS cost_per_conversion,
        {ratio('SUM(conversions_value)', 'SUM(spend)', 4, 10, ns=6, ds=2)} AS roas
      FROM cp WHERE {CUR} GROUP BY campaign_name, campaign_status, advertising_channel_type),
f AS (SELECT *, {xavg('conversion_rate_percent', 4, '()', 14)} AS a_cvr, {xavg('roas', 4, '()', 14)} AS a_roas,
        {xavg('cost_per_conversion', 4, '()', 22)} AS a_cpa FROM c WHERE total_spend > 0)
SELECT campaign_name, campaign_status, advertising_channel_type, total_spend, total_clicks, total_conversions,
  total_conversions_value, ctr_percent, avg_cpc, conversion_rate_percent, cost_per_conversion, roas,
  CAST(CASE WHEN total_conversions > 0 AND total_spend > 0 THEN
    ((conversion_rate_percent / NULLIF(a_cvr, 0)) + (roas / NULLIF(a_roas, 0)) + (1 - cost_per_conversion / NULLIF(a_cpa, 1))) / 3 * 100
    ELSE 0 END AS DECIMAL(10,2)) AS efficiency_score,
  CASE WHEN conversion_rate_percent >= a_cvr AND roas >= a_roas THEN 'Stars (High CVR, High ROAS)'
       WHEN conversion_rate_percent >= a_cvr AND roas < a_roas THEN 'Question Marks (High CVR, Low ROAS)'
       WHEN conversion_rate_percent < a_cvr AND roas >= a_roas THEN 'Cash Cows (Low CVR, High ROAS)'
       ELSE 'Dogs (Low CVR, Low ROAS)' END AS performance_quadrant,
  PERCENT_RANK() OVER (ORDER BY total_conversions ASC NULLS FIRST) AS conversions_percentile,
  PERCENT_RANK() OVER (ORDER BY roas ASC NULLS FIRST) AS roas_percentile,
  PERCENT_RANK() OVER (ORDER BY cost_per_conversion DESC NULLS LAST) AS efficiency_percentile
FROM f""",
    "q_budget_pacing": _CP.rstrip() + f""",
db AS (SELECT campaign_id, campaign_name, budget_amount AS daily_budget, date, spend, impressions, clicks, conversions
       FROM cp WHERE {CUR} AND budget_amount > 0),
g AS (SELECT campaign_name, daily_budget, CAST(daily_budget * 30.4 AS DECIMAL(22,7)) AS estimated_monthly_budget,
        CAST(SUM(spend) AS DECIMAL(28,2)) AS total_spend_30d, {xavg('spend', 2, prec=22)} AS avg_daily_spend,
        COUNT(DISTINCT date) AS days_with_data,
        COUNT(CASE WHEN spend >= daily_budget * 0.9 THEN 1 END) AS days_near_budget,
        COUNT(CASE WHEN spend >= daily_budget THEN 1 END) AS days_at_or_over_budget,
        COUNT(CASE WHEN spend < daily_budget * 0.5 THEN 1 END) AS days_underspending,
        {xavg('CASE WHEN spend >= daily_budget * 0.9 THEN conversions END', 6, prec=22)} AS avg_conversions_high_spend,
        {xavg('CASE WHEN spend < daily_budget * 0.5 THEN conversions END', 6, prec=22)} AS avg_conversions_low_spend
      FROM db GROUP BY campaign_name, daily_budget),
u AS (SELECT *, {ratio('total_spend_30d * 100', 'daily_budget * days_with_data', 2, 10, ns=2, ds=6, guard='true')} AS budget_utilization_pct FROM g)
SELECT campaign_name, daily_budget, estimated_monthly_budget, total_spend_30d, avg_daily_spend, budget_utilization_pct,
  days_with_data, days_near_budget, days_at_or_over_budget, days_underspending, avg_conversions_high_spend,
  avg_conversions_low_spend,
  CASE WHEN budget_utilization_pct > 95 THEN 'Consider increasing budget'
       WHEN budget_utilization_pct < 50 THEN 'Budget underutilized - check targeting/bids'
       ELSE 'Budget pacing is healthy' END AS budget_recommendation
FROM u ORDER BY budget_utilization_pct DESC""",
    "q_conversion_funnel": _CP.rstrip() + f""",
g AS (SELECT account_name, campaign_name, CAST(SUM(impressions) AS BIGINT) AS stage_1_impressions,
        CAST(SUM(clicks) AS BIGINT) AS stage_2_clicks, CAST(SUM(conversions) AS DECIMAL(28,6)) AS stage_3_conversions,
        CAST(SUM(conversions_value) AS DECIMAL(28,6)) AS _value, SUM(spend) AS _spend
      FROM cp WHERE {CUR} GROUP BY account_name, campaign_name HAVING SUM(impressions) > 0)
SELECT account_name, campaign_name, stage_1_impressions, stage_2_clicks, stage_3_conversions,
  {ratio('(stage_1_impressions - stage_2_clicks) * 100', 'stage_1_impressions', 2, 10)} AS impressions_to_clicks_dropoff_pct,
  {ratio('(stage_2_clicks - stage_3_conversions) * 100', 'stage_2_clicks', 2, 10, ns=6)} AS clicks_to_conversions_dropoff_pct,
  {ratio('stage_3_conversions * 100', 'stage_1_impressions', 6, 10, ns=6)} AS overall_conversion_rate_pct,
  {ratio('_value * 1000', 'stage_1_impressions', 4, 18, ns=6)} AS value_per_1000_impressions,
  {ratio('_value', 'stage_2_clicks', 4, 18, ns=6)} AS value_per_click
FROM g ORDER BY _spend DESC""",
}
