"""Oracle SQL: documented recommendations (benchmarks, alerts, velocity, RLS, cross-platform, hourly)."""
from __future__ import annotations

from . import engagements, search_ads, social_ads
from .adapters import with_tables
from .crm_dashboards import views
from .kit import ratio


def _wrap(name: str, sql: str) -> str:
    return f"WITH {name} AS (\n{sql}\n)\n"


def flags(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in exprs.items()) + ", " + \
        " + ".join(f"CAST({e} AS INTEGER)" for e in exprs.values()) + " AS benchmarks_met"


SQL: dict[str, str] = {
    "q_kpi_benchmarks_search": _wrap("s", search_ads.SQL["campaign_performance_summary"]) + f"""
SELECT campaign_id, campaign_name, advertising_channel_type, account_name, avg_ctr, avg_conversion_rate, avg_roas,
  {flags({'ctr_ok': "avg_ctr > CASE WHEN advertising_channel_type = 'DISPLAY' THEN 0.5 ELSE 2 END",
          'conversion_rate_ok': 'avg_conversion_rate > 3', 'roas_ok': 'avg_roas > 4'})}
FROM s""",
    "q_kpi_benchmarks_social": _wrap("s", social_ads.SQL["fb_campaign_performance_summary"]) + f"""
SELECT campaign_id, campaign_name, account_name, avg_ctr, avg_frequency, avg_roas, avg_cpp,
  {flags({'ctr_ok': 'avg_ctr > 1', 'frequency_ok': 'avg_frequency BETWEEN 1.5 AND 3', 'frequency_fatigue': 'avg_frequency > 8',
          'roas_ok': 'avg_roas > 3', 'cpp_ok': 'avg_cpp BETWEEN 8 AND 20'})}
FROM s""",
    "q_email_deliverability_alerts": views(ep="email_performance") + f"""
SELECT campaign_id, campaign_name, delivery_rate, unique_open_rate, unique_click_rate, click_to_open_rate, bounce_rate,
  unsubscribe_rate, spam_complaint_rate,
  {flags({'delivery_ok': 'delivery_rate > 95', 'open_rate_ok': 'unique_open_rate > 20', 'click_rate_ok': 'unique_click_rate > 3',
          'click_to_open_ok': 'click_to_open_rate > 10', 'bounce_ok': 'bounce_rate < 2', 'unsubscribe_ok': 'unsubscribe_rate < 0.5',
          'spam_ok': 'spam_complaint_rate < 0.01'})},
  bounce_rate > 2 AS bounce_alert
FROM ep WHERE sent_count > 0""",
    "q_deal_velocity": views(dpv="deal_performance") + f"""
SELECT deal_id, deal_name, owner_id, owner_name, weighted_amount, days_in_pipeline,
  {ratio('weighted_amount', 'days_in_pipeline', 2, 18, ns=8, default='NULL')} AS deal_velocity
FROM dpv WHERE deal_status = 'Open'""",
    "q_deal_benchmarks": views(d="deal_owner_performance") + f"""
SELECT owner_id, owner_name, win_rate, avg_days_to_close_won,
  {flags({'win_rate_ok': 'win_rate > 25', 'days_to_close_ok': 'avg_days_to_close_won < 60.0'})}
FROM d""",
    "q_rls_campaign_performance": _wrap("cp", search_ads.SQL["campaign_performance"]) + f""",
acct AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY _fivetran_synced DESC) AS rn
   FROM ({with_tables('account_history')} SELECT * FROM account_history)) WHERE rn = 1 AND currency_code = 'USD')
SELECT * FROM cp WHERE account_id IN (SELECT account_id FROM acct)""",
    "q_cross_platform_daily": _wrap("ap", search_ads.SQL["account_performance"]).rstrip() + f""",
fa AS ({social_ads.SQL['fb_account_performance']}),
ct AS ({with_tables('contact')} SELECT * FROM contact WHERE _fivetran_deleted = false),
u AS (SELECT date, CAST(spend AS DECIMAL(28,2)) AS search_spend, CAST(NULL AS DECIMAL(28,2)) AS social_spend, CAST(NULL AS BIGINT) AS new_contacts FROM ap
  UNION ALL SELECT date, NULL, CAST(spend AS DECIMAL(28,2)), NULL FROM fa
  UNION ALL SELECT CAST(created_at AS DATE), NULL, NULL, 1 FROM ct)
SELECT date, CAST(SUM(search_spend) AS DECIMAL(38,2)) AS search_spend, CAST(SUM(social_spend) AS DECIMAL(38,2)) AS social_spend,
  CAST(SUM(new_contacts) AS BIGINT) AS new_contacts
FROM u GROUP BY date""",
    "q_hour_of_day": with_tables("engagement") + """
SELECT CAST(hour(timestamp) AS INTEGER) AS hour_of_day, type AS engagement_type, COUNT(*) AS engagement_count,
  COUNT(DISTINCT owner_id) AS active_owners
FROM engagement WHERE _fivetran_deleted = false AND timestamp IS NOT NULL GROUP BY hour(timestamp), type""",
}

SQL["q_campaign_summary_sliced"] = f"""SELECT * FROM ({search_ads.SQL['campaign_performance_summary']})
WHERE advertising_channel_type IN ('SEARCH', 'DISPLAY') AND active_days >= 1 AND total_spend >= 10"""


SQL["q_sliced_executive"] = f"""SELECT account_id, account_name, COUNT(*) AS row_count, CAST(SUM(spend) AS DECIMAL(28,2)) AS spend, CAST(SUM(clicks) AS BIGINT) AS clicks,
  CAST(SUM(conversions) AS DECIMAL(28,6)) AS conversions FROM ({search_ads.SQL['account_performance']})
WHERE date BETWEEN DATE '2024-03-01' AND DATE '2024-03-31' AND account_id IN (0, 1, 2) GROUP BY ALL"""
SQL["q_sliced_keywords"] = f"""SELECT campaign_id, keyword_match_type, COUNT(*) AS row_count, CAST(SUM(spend) AS DECIMAL(28,2)) AS spend, CAST(SUM(clicks) AS BIGINT) AS clicks,
  CAST(SUM(conversions) AS DECIMAL(28,6)) AS conversions FROM ({search_ads.SQL['keyword_performance']})
WHERE keyword_match_type IN ('EXACT', 'PHRASE') AND campaign_id BETWEEN 0 AND 19 GROUP BY ALL"""
SQL["q_sliced_lifecycle"] = views(v="contact_performance") + """SELECT owner_id, lifecycle_stage, COUNT(*) AS row_count, CAST(SUM(total_revenue) AS DECIMAL(28,2)) AS total_revenue,
  CAST(SUM(total_engagements) AS BIGINT) AS total_engagements FROM v WHERE lifecycle_stage IN ('customer', 'opportunity') GROUP BY ALL"""
SQL["q_sliced_activity"] = f"""SELECT owner_id, engagement_type, COUNT(*) AS row_count, CAST(SUM(call_duration_ms) AS BIGINT) AS call_duration_ms
FROM ({engagements.SQL['engagement_performance']}) WHERE engagement_type IN ('CALL', 'MEETING') AND owner_id BETWEEN 3 AND 12
  AND engagement_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY ALL"""
