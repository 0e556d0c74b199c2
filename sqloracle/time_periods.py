"""Oracle SQL: calendar and time-period queries."""
from __future__ import annotations

from .adapters import with_tables
from .kit import change_pct, date_key, ratio, xavg
from .search_ads import ACCOUNT_PERFORMANCE_BODY, CAMPAIGN_PERFORMANCE_BODY

ADS = "DATE '2024-04-30'"
LONG = "DATE '2001-08-01'"


def calendar_body(src: str, as_of: str) -> str:
    d, a = "date", as_of
    dow = "(dayofweek(date) + 1)"
    q = "quarter(date)"
    y = "year(date)"
    pm = f"({a} - INTERVAL 1 MONTH)"
    return f"""
SELECT {date_key(d)} AS date_id, date, dayname(date) AS day_name, CAST({dow} AS INTEGER) AS day_of_week,
  CAST(dayofmonth(date) AS INTEGER) AS day_of_month, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
  CASE WHEN {dow} IN (1, 7) THEN 0 ELSE 1 END AS is_weekday,
  CAST(floor((dayofyear(date) + dayofweek(date_trunc('year', date)) + 1 - 2) / 7) + 1 AS INTEGER) AS week_of_year,
  CAST(weekofyear(date) AS INTEGER) AS iso_week_of_year,
  CAST(date - CAST({dow} - 1 AS INTEGER) AS DATE) AS week_start_date, CAST(date + CAST(7 - {dow} AS INTEGER) AS DATE) AS week_end_date,
  CAST(month(date) AS INTEGER) AS month_number, monthname(date) AS month_name, left(monthname(date), 3) AS month_name_short,
  make_date({y}, month(date), 1) AS month_start_date, last_day(date) AS month_end_date,
  CAST({q} AS INTEGER) AS quarter_number, 'Q' || CAST({q} AS VARCHAR) AS quarter_name,
  make_date({y}, ({q} - 1) * 3 + 1, 1) AS quarter_start_date, last_day(make_date({y}, {q} * 3, 1)) AS quarter_end_date,
  CAST({y} AS INTEGER) AS year, make_date({y}, 1, 1) AS year_start_date, make_date({y}, 12, 31) AS year_end_date,
  CAST({y} AS INTEGER) AS fiscal_year, CAST({q} AS INTEGER) AS fiscal_quarter,
  strftime(date, '%Y-%m') AS year_month, CAST({y} AS VARCHAR) || '-Q' || CAST({q} AS VARCHAR) AS year_quarter,
  strftime(date, '%Y-%m') AS year_month_sort,
  CASE WHEN date = {a} THEN 1 ELSE 0 END AS is_today, CASE WHEN date = {a} - 1 THEN 1 ELSE 0 END AS is_yesterday,
  CASE WHEN date >= {a} - 7 AND date < {a} THEN 1 ELSE 0 END AS is_last_7_days,
  CASE WHEN date >= {a} - 30 AND date < {a} THEN 1 ELSE 0 END AS is_last_30_days,
  CASE WHEN {y} = year({a}) AND month(date) = month({a}) THEN 1 ELSE 0 END AS is_current_month,
  CASE WHEN {y} = year({pm}) AND month(date) = month({pm}) THEN 1 ELSE 0 END AS is_previous_month,
  CASE WHEN {y} = year({a}) THEN 1 ELSE 0 END AS is_current_year,
  CASE WHEN {y} = year({a}) - 1 THEN 1 ELSE 0 END AS is_previous_year,
  CAST(date_diff('day', date, {a}) AS INTEGER) AS days_ago
FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM {src})"""


def _psums(p: str) -> str:
    return (f"CAST(SUM(a.spend) AS DECIMAL(28,2)) AS {p}_spend, CAST(SUM(a.impressions) AS BIGINT) AS {p}_impressions, "
            f"CAST(SUM(a.clicks) AS BIGINT) AS {p}_clicks, CAST(SUM(a.conversions) AS DECIMAL(28,6)) AS {p}_conversions, "
            f"CAST(SUM(a.conversions_value) AS DECIMAL(28,6)) AS {p}_revenue")


def _pkpis(p: str) -> str:
    return (f"{ratio(f'{p}_clicks * 100', f'{p}_impressions', 4, 10)} AS {p}_ctr, "
            f"{ratio(f'{p}_spend', f'{p}_clicks', 4, 18, ns=2)} AS {p}_cpc, "
            f"{ratio(f'{p}_conversions * 100', f'{p}_clicks', 4, 10, ns=6)} AS {p}_conversion_rate, "
            f"{ratio(f'{p}_revenue', f'{p}_spend', 4, 10, ns=6, ds=2)} AS {p}_roas")


def weekly(as_of: str, weeks: int, long: bool) -> str:
    st = "account_stats_long" if long else "account_stats"
    body = ACCOUNT_PERFORMANCE_BODY.replace("FROM account_stats a", f"FROM {st} a")
    w = "OVER (PARTITION BY account_name ORDER BY year, week_of_year)"
    lag = lambda c, n: f"LAG({c}, {n}) {w}"
    return with_tables(st, "account_history").rstrip() + f""",
ap AS ({body}),
cal AS ({calendar_body(st, as_of)}),
wm AS (SELECT d.year, d.week_of_year, d.week_start_date, d.week_end_date, a.account_name, {_psums('weekly')}
       FROM cal d JOIN ap a ON d.date = a.date WHERE d.date >= {as_of} - {7 * weeks}
       GROUP BY d.year, d.week_of_year, d.week_start_date, d.week_end_date, a.account_name)
SELECT year, week_of_year, week_start_date, week_end_date, account_name, weekly_spend, weekly_impressions, weekly_clicks,
  weekly_conversions, weekly_revenue,
  {lag('weekly_spend', 1)} AS previous_week_spend, {lag('weekly_conversions', 1)} AS previous_week_conversions,
  {lag('weekly_spend', 52)} AS same_week_ly_spend, {lag('weekly_conversions', 52)} AS same_week_ly_conversions,
  {change_pct('weekly_spend', lag('weekly_spend', 1), 2)} AS spend_wow_change_pct,
  {change_pct('weekly_conversions', lag('weekly_conversions', 1), 6)} AS conversions_wow_change_pct,
  {_pkpis('weekly')}
FROM wm"""


def monthly(as_of: str, months: int, long: bool) -> str:
    st = "account_stats_long" if long else "account_stats"
    body = ACCOUNT_PERFORMANCE_BODY.replace("FROM account_stats a", f"FROM {st} a")
    w = "OVER (PARTITION BY account_name ORDER BY year, month_number)"
    lag = lambda c, n: f"LAG({c}, {n}) {w}"
    return with_tables(st, "account_history").rstrip() + f""",
ap AS ({body}),
cal AS ({calendar_body(st, as_of)}),
mm AS (SELECT d.year, d.month_number, d.month_name, d.year_month, a.account_name, {_psums('monthly')}
       FROM cal d JOIN ap a ON d.date = a.date WHERE d.date >= CAST({as_of} - INTERVAL {months} MONTH AS DATE)
       GROUP BY d.year, d.month_number, d.month_name, d.year_month, a.account_name)
SELECT year, month_number, month_name, year_month, account_name, monthly_spend, monthly_impressions, monthly_clicks,
  monthly_conversions, monthly_revenue,
  {lag('monthly_spend', 1)} AS previous_month_spend, {lag('monthly_conversions', 1)} AS previous_month_conversions,
  {lag('monthly_spend', 12)} AS same_month_ly_spend, {lag('monthly_conversions', 12)} AS same_month_ly_conversions,
  {change_pct('monthly_spend', lag('monthly_spend', 1), 2)} AS spend_mom_change_pct,
  {change_pct('monthly_spend', lag('monthly_spend', 12), 2)} AS spend_yoy_change_pct,
  {_pkpis('monthly')}
FROM mm"""


SQL: dict[str, str] = {
    "date_dimension": with_tables("account_stats") + calendar_body("account_stats", ADS),
    "q_weekly_wow_yoy": weekly(ADS, 12, False),
    "q_monthly_mom_yoy": monthly(ADS, 13, False),
    "q_weekly_wow_yoy_long": weekly(LONG, 60, True),
    "q_monthly_mom_yoy_long": monthly(LONG, 13, True),
    "q_day_of_week": with_tables("campaign_stats", "campaign_history", "account_history", "account_stats").rstrip() + f""",
cp AS ({CAMPAIGN_PERFORMANCE_BODY}),
cal AS ({calendar_body('account_stats', ADS)}),
g AS (SELECT d.day_name, d.day_of_week, c.campaign_name, c.account_name, COUNT(DISTINCT d.date) AS days_in_analysis,
        CAST(SUM(c.spend) AS DECIMAL(28,2)) AS total_spend, {xavg('c.spend', 2, prec=22)} AS avg_daily_spend,
        CAST(SUM(c.impressions) AS BIGINT) AS total_impressions, AVG(c.impressions) AS avg_daily_impressions,
        CAST(SUM(c.clicks) AS BIGINT) AS total_clicks, AVG(c.clicks) AS avg_daily_clicks,
        CAST(SUM(c.conversions) AS DECIMAL(28,6)) AS total_conversions, {xavg('c.conversions', 6, prec=22)} AS avg_daily_conversions,
        CAST(SUM(c.conversions_value) AS DECIMAL(28,6)) AS _value
      FROM cal d JOIN cp c ON d.date = c.date WHERE d.date >= {ADS} - 90
      GROUP BY d.day_name, d.day_of_week, c.campaign_name, c.account_name)
SELECT day_name, day_of_week, campaign_name, account_name, days_in_analysis, total_spend, avg_daily_spend,
  total_impressions, avg_daily_impressions, total_clicks, avg_daily_clicks, total_conversions, avg_daily_conversions,
  {ratio('total_clicks * 100', 'total_impressions', 4, 10)} AS ctr_percent,
  {ratio('total_spend', 'total_clicks', 4, 18, ns=2)} AS avg_cpc,
  {ratio('total_conversions * 100', 'total_clicks', 4, 10, ns=6)} AS conversion_rate,
  {ratio('total_spend', 'total_conversions', 4, 18, ns=2, ds=6)} AS cost_per_conversion,
  {ratio('_value', 'total_spend', 4, 10, ns=6, ds=2)} AS roas,
  CASE WHEN total_conversions > 0 AND total_spend / total_conversions <
            AVG(total_spend / NULLIF(total_conversions, 0)) OVER (PARTITION BY campaign_name) THEN 'Above Average'
       WHEN total_conversions > 0 THEN 'Below Average' ELSE 'No Conversions' END AS day_performance
FROM g""",
}
