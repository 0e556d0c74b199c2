"""Oracle SQL: semantic-model measures and report data queries."""
from __future__ import annotations

from . import search_ads, time_periods
from .adapters import with_tables
from .crm_dashboards import views
from .kit import xavg

A = "DATE '2024-01-31'"


def div(a: str, b: str) -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


def _sum(col: str, typ: str) -> str:
    return f"CAST(SUM({col}) AS {typ}) AS {col}"


SQL: dict[str, str] = {
    "m_contact_measures": views(cpv="contact_performance") + f"""
SELECT COUNT(*) AS total_contacts, COUNT(CASE WHEN lifecycle_stage = 'customer' THEN 1 END) AS total_customers,
  CAST(SUM(total_revenue) AS DECIMAL(28,2)) AS total_contact_revenue,
  COUNT(CASE WHEN created_at >= CAST({A} - 30 AS TIMESTAMP) THEN 1 END) AS new_contacts_30d,
  {div("COUNT(CASE WHEN lifecycle_stage = 'customer' THEN 1 END)", 'COUNT(*)')} * 100 AS customer_conversion_rate
FROM cpv""",
    "m_deal_measures": views(dpv="deal_performance") + f"""
SELECT COUNT(*) AS total_deals, COUNT(CASE WHEN deal_status = 'Open' THEN 1 END) AS open_deals,
  COUNT(CASE WHEN is_closed_won = true THEN 1 END) AS won_deals,
  COUNT(CASE WHEN is_closed = true AND NOT is_closed_won THEN 1 END) AS lost_deals,
  CAST(SUM(CASE WHEN deal_status = 'Open' THEN amount END) AS DECIMAL(28,2)) AS pipeline_value,
  CAST(SUM(CASE WHEN deal_status = 'Open' THEN weighted_amount END) AS DECIMAL(38,8)) AS weighted_pipeline,
  CAST(SUM(CASE WHEN is_closed_won = true THEN amount END) AS DECIMAL(28,2)) AS closed_won_revenue,
  AVG(actual_days_to_close) AS avg_days_to_close,
  {div('COUNT(CASE WHEN is_closed_won = true THEN 1 END)', 'COUNT(CASE WHEN is_closed = true THEN 1 END)')} * 100 AS deal_win_rate,
  {div("SUM(CASE WHEN deal_status = 'Open' THEN amount END)", "COUNT(CASE WHEN deal_status = 'Open' THEN 1 END)")} AS avg_deal_size
FROM dpv""",
    "m_email_measures": views(ep="email_performance") + f"""
SELECT {xavg('unique_open_rate', 2, prec=14)} AS avg_open_rate, {xavg('unique_click_rate', 2, prec=14)} AS avg_click_rate,
  {xavg('delivery_rate', 2, prec=14)} AS avg_delivery_rate, CAST(SUM(sent_count) AS BIGINT) AS total_emails_sent
FROM ep""",
    "m_engagement_measures": views(eds="engagement_daily_summary") + """
SELECT CAST(SUM(total_engagements) AS BIGINT) AS total_engagements, CAST(SUM(total_calls) AS BIGINT) AS total_calls,
  CAST(SUM(total_meetings) AS BIGINT) AS total_meetings, CAST(SUM(total_emails) AS BIGINT) AS total_crm_emails,
  CAST(SUM(unique_contacts_engaged) AS BIGINT) AS contacts_engaged, CAST(SUM(unique_companies_engaged) AS BIGINT) AS companies_engaged
FROM eds""",
    "m_ads_daily_measures": with_tables("account_stats", "account_history").rstrip() + f""",
ap AS ({search_ads.ACCOUNT_PERFORMANCE_BODY}),
cal AS ({time_periods.calendar_body('account_stats', "DATE '2024-04-30'")}),
d AS (SELECT cal.date, CAST(SUM(ap.spend) AS DECIMAL(28,2)) AS total_spend, SUM(ap.clicks) AS _clicks,
        SUM(ap.impressions) AS _imp, SUM(ap.conversions_value) AS _value
      FROM cal LEFT JOIN ap ON cal.date = ap.date GROUP BY cal.date)
SELECT d.date, d.total_spend, {div('d._clicks', 'd._imp')} * 100 AS ctr_pct, {div('d._value', 'd.total_spend')} AS roas,
  p.total_spend AS previous_period_spend,
  {div('COALESCE(d.total_spend, 0) - COALESCE(p.total_spend, 0)', 'p.total_spend')} * 100 AS spend_change_pct
FROM d LEFT JOIN d p ON d.date = p.date + 30""",
    "rq_stage_counts": views(lf="contact_lifecycle_funnel") + """
SELECT stage_display_name, CAST(SUM(contact_count) AS BIGINT) AS contact_count FROM lf GROUP BY stage_display_name""",
    "rq_engagement_line": views(eds="engagement_daily_summary") + """
SELECT engagement_date, CAST(SUM(total_engagements) AS BIGINT) AS total_engagements FROM eds GROUP BY engagement_date""",
    "rq_contacts_by_lifecycle": views(cpv="contact_performance") + """
SELECT lifecycle_stage_display, COUNT(*) AS total_contacts FROM cpv GROUP BY lifecycle_stage_display""",
    "rq_contacts_by_source": views(cpv="contact_performance") + """
SELECT hs_analytics_source, COUNT(*) AS total_contacts FROM cpv GROUP BY hs_analytics_source""",
    "rq_contact_owner_table": views(cpv="contact_performance") + """
SELECT owner_name, CAST(SUM(total_engagements) AS BIGINT) AS total_engagements,
  CAST(SUM(total_revenue) AS DECIMAL(28,2)) AS total_revenue FROM cpv GROUP BY owner_name""",
    "rq_pipeline_funnel": views(ps="deal_pipeline_summary") + """
SELECT stage_label, CAST(SUM(total_value) AS DECIMAL(38,2)) AS total_value FROM ps GROUP BY stage_label""",
    "rq_owner_deals_table": views(d="deal_owner_performance") + f"""
SELECT owner_name, CAST(SUM(total_deals) AS BIGINT) AS total_deals, CAST(SUM(closed_won_revenue) AS DECIMAL(38,2)) AS closed_won_revenue,
  {xavg('win_rate', 2, prec=14)} AS win_rate FROM d GROUP BY owner_name""",
    "rq_deal_table": views(dpv="deal_performance") + """
SELECT deal_name, deal_health_status, owner_name, CAST(SUM(amount) AS DECIMAL(28,2)) AS amount FROM dpv
GROUP BY deal_name, deal_health_status, owner_name""",
    "rq_email_table": views(ep="email_performance") + f"""
SELECT campaign_name, performance_tier, CAST(SUM(sent_count) AS BIGINT) AS sent_count,
  {xavg('unique_open_rate', 2, prec=14)} AS unique_open_rate, {xavg('unique_click_rate', 2, prec=14)} AS unique_click_rate
FROM ep GROUP BY campaign_name, performance_tier""",
    "rq_sent_by_tier": views(ep="email_performance") + """
SELECT performance_tier, CAST(SUM(sent_count) AS BIGINT) AS total_emails_sent FROM ep GROUP BY performance_tier""",
    "rq_engagement_by_weekday": views(eds="engagement_daily_summary") + """
SELECT day_of_week, CAST(SUM(total_engagements) AS BIGINT) AS total_engagements FROM eds GROUP BY day_of_week""",
    "rq_owner_engagement_table": views(eo="engagement_owner_summary") + """
SELECT owner_name, CAST(SUM(total_engagements) AS BIGINT) AS total_engagements, CAST(SUM(total_calls) AS BIGINT) AS total_calls,
  CAST(SUM(total_meetings) AS BIGINT) AS total_meetings FROM eo GROUP BY owner_name""",
}

SQL["m_spend_time_intelligence"] = with_tables("account_stats_long", "account_history").rstrip() + f""",
ap AS ({search_ads.ACCOUNT_PERFORMANCE_BODY.replace('FROM account_stats a', 'FROM account_stats_long a')}),
d AS (SELECT date, CAST(SUM(spend) AS DECIMAL(28,2)) AS total_spend FROM ap GROUP BY date)
SELECT d.date, d.total_spend, w.total_spend AS spend_wow, m.total_spend AS spend_mom, y.total_spend AS spend_yoy,
  {div('d.total_spend - w.total_spend', 'w.total_spend')} * 100 AS spend_wow_change_pct,
  {div('d.total_spend - m.total_spend', 'm.total_spend')} * 100 AS spend_mom_change_pct,
  {div('d.total_spend - y.total_spend', 'y.total_spend')} * 100 AS spend_yoy_change_pct
FROM d
LEFT JOIN d w ON w.date = d.date - 7
LEFT JOIN d m ON m.date = CAST(d.date - INTERVAL 1 MONTH AS DATE)
LEFT JOIN d y ON y.date = CAST(d.date - INTERVAL 12 MONTH AS DATE)"""

SQL["m_contact_measures_by_stage"] = views(cpv="contact_performance") + f"""
SELECT g.*, c.total_customers, {div('c.total_customers', 'g.total_contacts')} * 100 AS customer_conversion_rate
FROM (SELECT lifecycle_stage, COUNT(*) AS total_contacts, CAST(SUM(total_revenue) AS DECIMAL(28,2)) AS total_contact_revenue,
    COUNT(*) FILTER (created_at >= CAST({A} - 30 AS TIMESTAMP)) AS new_contacts_30d FROM cpv GROUP BY lifecycle_stage) g,
  (SELECT COUNT(*) AS total_customers FROM cpv WHERE lifecycle_stage = 'customer') c"""

SQL["m_deal_measures_by_status"] = views(dpv="deal_performance") + f"""
SELECT g.* EXCLUDE (closed), coalesce(o.n, 0) AS open_deals, o.v AS pipeline_value, o.w AS weighted_pipeline,
  {div('g.won_deals', 'g.closed')} * 100 AS deal_win_rate, {div('o.v', 'coalesce(o.n, 0)')} AS avg_deal_size
FROM (SELECT deal_status, owner_id, COUNT(*) AS total_deals, COUNT(*) FILTER (is_closed_won) AS won_deals,
    COUNT(*) FILTER (is_closed AND NOT is_closed_won) AS lost_deals, COUNT(*) FILTER (is_closed) AS closed,
    CAST(SUM(amount) FILTER (is_closed_won) AS DECIMAL(28,2)) AS closed_won_revenue, AVG(actual_days_to_close) AS avg_days_to_close
  FROM dpv GROUP BY deal_status, owner_id) g
LEFT JOIN (SELECT owner_id, COUNT(*) FILTER (deal_status = 'Open') AS n, CAST(SUM(amount) FILTER (deal_status = 'Open') AS DECIMAL(28,2)) AS v,
    CAST(SUM(weighted_amount) FILTER (deal_status = 'Open') AS DECIMAL(38,8)) AS w FROM dpv GROUP BY owner_id) o
  ON g.owner_id IS NOT DISTINCT FROM o.owner_id"""

SQL["rq_contacts_by_company_health"] = views(cpv="contact_performance", cov="company_performance") + """
SELECT cov.account_health_status AS company_health, COUNT(*) AS total_contacts, CAST(SUM(cpv.total_revenue) AS DECIMAL(28,2)) AS total_contact_revenue
FROM cpv LEFT JOIN cov ON cpv.associated_company_id = cov.company_id GROUP BY cov.account_health_status"""

SQL["rq_deals_of_winning_owners"] = views(dpv="deal_performance", dov="deal_owner_performance") + """
SELECT deal_status, CAST(SUM(amount) AS DECIMAL(28,2)) AS amount, CAST(SUM(weighted_amount) AS DECIMAL(38,8)) AS weighted_amount
FROM dpv WHERE owner_id IN (SELECT owner_id FROM dov WHERE win_rate >= 40) GROUP BY deal_status"""


# Every measure over the rows that the axis leaves once the measure's own filters have replaced it (o: deal_status, w: is_closed_won, c: is_closed).
SQL["m_deal_measures_by_closed"] = views(dpv="deal_performance") + f"""
, axis AS (SELECT DISTINCT is_closed AS c, is_closed_won AS w FROM dpv),
own AS (SELECT is_closed AS c, is_closed_won AS w, COUNT(*) AS total_deals, AVG(actual_days_to_close) AS avg_days_to_close,
    COUNT(*) FILTER (deal_status = 'Open') AS open_deals, CAST(SUM(amount) FILTER (deal_status = 'Open') AS DECIMAL(28,2)) AS pipeline_value,
    CAST(SUM(weighted_amount) FILTER (deal_status = 'Open') AS DECIMAL(38,8)) AS weighted_pipeline FROM dpv GROUP BY ALL),
won AS (SELECT is_closed AS c, COUNT(*) AS n, CAST(SUM(amount) AS DECIMAL(28,2)) AS v FROM dpv WHERE is_closed_won GROUP BY 1),
shut AS (SELECT is_closed_won AS w, COUNT(*) AS n FROM dpv WHERE is_closed GROUP BY 1),
whole AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (is_closed AND NOT is_closed_won) AS lost FROM dpv),
freed AS (SELECT is_closed_won AS w, COUNT(*) AS n FROM dpv WHERE deal_status = 'Open' GROUP BY 1)
SELECT a.c AS is_closed, a.w AS is_closed_won, own.total_deals, own.open_deals, coalesce(won.n, 0) AS won_deals, whole.lost AS lost_deals,
  own.pipeline_value, own.weighted_pipeline, won.v AS closed_won_revenue, own.avg_days_to_close,
  {div('coalesce(won.n, 0)', 'coalesce(shut.n, 0)')} * 100 AS deal_win_rate, {div('own.pipeline_value', 'own.open_deals')} AS avg_deal_size,
  {div('own.total_deals', 'whole.n')} * 100 AS pct_of_deals, coalesce(freed.n, 0) AS open_deals_any_closed
FROM axis a JOIN own ON a.c IS NOT DISTINCT FROM own.c AND a.w IS NOT DISTINCT FROM own.w
LEFT JOIN won ON a.c IS NOT DISTINCT FROM won.c LEFT JOIN shut ON a.w IS NOT DISTINCT FROM shut.w
LEFT JOIN freed ON a.w IS NOT DISTINCT FROM freed.w, whole"""

SQL["rq_forecast_of_winning_owners"] = views(f="deal_forecast", dov="deal_owner_performance") + """
SELECT forecast_period, CAST(SUM(deal_count) AS BIGINT) AS deal_count, CAST(SUM(pipeline_value) AS DECIMAL(38,2)) AS pipeline_value,
  CAST(SUM(weighted_pipeline) AS DECIMAL(38,8)) AS weighted_pipeline
FROM f WHERE owner_id IN (SELECT owner_id FROM dov WHERE win_rate >= 40) GROUP BY forecast_period"""


SQL["rq_companies_by_status"] = views(v="company_performance") + f"""
SELECT customer_status, CAST(SUM(total_revenue) AS DECIMAL(28,2)) AS total_revenue, {', '.join(_sum(c, 'BIGINT') for c in ('total_deals', 'won_deals', 'total_engagements'))},
  CAST(SUM(pipeline_value) AS DECIMAL(38,2)) AS pipeline_value, CAST(SUM(total_lifetime_value) AS DECIMAL(38,2)) AS total_lifetime_value FROM v GROUP BY 1"""

SQL["rq_forecast_by_period"] = views(v="deal_forecast") + f"""
SELECT forecast_period, {_sum('deal_count', 'BIGINT')}, CAST(SUM(pipeline_value) AS DECIMAL(38,2)) AS pipeline_value, CAST(SUM(weighted_pipeline) AS DECIMAL(38,8)) AS weighted_pipeline,
  {xavg('avg_probability', 6, prec=20)} AS avg_probability, {xavg('avg_deal_size', 6, prec=26)} AS avg_deal_size FROM v GROUP BY 1"""

SQL["rq_deals_by_status"] = views(v="deal_performance") + f"""
SELECT deal_status, CAST(SUM(amount) AS DECIMAL(28,2)) AS amount, CAST(SUM(weighted_amount) AS DECIMAL(38,8)) AS weighted_amount,
  COUNT(*) FILTER (is_closed) AS is_closed, COUNT(*) FILTER (is_closed_won) AS is_closed_won, {_sum('total_engagements', 'BIGINT')},
  AVG(deal_age_days) AS deal_age_days, AVG(actual_days_to_close) AS actual_days_to_close FROM v GROUP BY 1"""


_MEASURE = {"total_spend": "{0}.s", "total_clicks": "{0}.k", "ctr_pct": div("{0}.k", "{0}.i") + " * 100", "roas": div("{0}.v", "{0}.s")}
_AGO = {"wow": "d.date - 7", "mom": "CAST(d.date - INTERVAL 1 MONTH AS DATE)", "yoy": "CAST(d.date - INTERVAL 12 MONTH AS DATE)"}


def _then(tag: str, name: str) -> str:
    return f"CASE WHEN {tag}.date IS NOT NULL THEN {_MEASURE[name].format(tag)} END"


SQL["m_ads_time_intelligence"] = with_tables("account_stats_long", "account_history").rstrip() + f""",
ap AS ({search_ads.ACCOUNT_PERFORMANCE_BODY.replace('FROM account_stats a', 'FROM account_stats_long a')}),
d AS (SELECT date, CAST(SUM(spend) AS DECIMAL(28,2)) AS s, CAST(SUM(clicks) AS BIGINT) AS k, SUM(impressions) AS i, SUM(conversions_value) AS v FROM ap GROUP BY date)
SELECT d.date, {', '.join(f"{m.format('d')} AS {n}" for n, m in _MEASURE.items())},
  {', '.join(f"{_then(t, n)} AS {n}_{t}, {div(f'({m.format(chr(100))}) - ({_then(t, n)})', _then(t, n))} * 100 AS {n}_{t}_change_pct" for n, m in _MEASURE.items() for t in _AGO)}
FROM d {' '.join(f'LEFT JOIN d {t} ON {t}.date = {ago}' for t, ago in _AGO.items())}"""
