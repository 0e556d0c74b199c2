"""Oracle SQL: social-ads marts."""
from __future__ import annotations

from .adapters import with_tables
from .kit import change_pct, date_key, ratio, xavg
from .search_ads import share

A = "DATE '2024-04-30'"
CUR30 = f"date >= {A} - 30"


def latest(table: str, key: str) -> str:
    return (f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY _fivetran_synced DESC) AS rn "
            f"FROM {table} WHERE COALESCE(_fivetran_deleted, false) = false) WHERE rn = 1)")


def rollup(keys: str) -> str:
    return (f"(SELECT {keys}, date, SUM(spend) AS spend, CAST(SUM(impressions) AS BIGINT) AS impressions, "
            f"CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(reach) AS BIGINT) AS reach, "
            f"CAST(SUM(actions) AS DECIMAL(28,6)) AS actions, CAST(SUM(action_values) AS DECIMAL(28,6)) AS action_values, "
            f"MAX(_fivetran_synced) AS _fivetran_synced FROM fb_basic_ad GROUP BY {keys}, date)")


def row_block(a: str, acts_typ: str = "DECIMAL(28,6)", budget: str | None = None) -> str:
    acts, vals = f"COALESCE({a}.actions, 0)", f"COALESCE({a}.action_values, 0)"
    out = [
        f"CAST({a}.spend AS DECIMAL(18,2)) AS spend", f"{a}.impressions", f"{a}.clicks", f"{a}.reach",
        f"{ratio(f'{a}.impressions', f'{a}.reach', 4, 10)} AS frequency",
        f"CAST({acts} AS {acts_typ}) AS total_actions", f"CAST({vals} AS {acts_typ}) AS total_action_value",
        f"{ratio(f'{a}.clicks * 100', f'{a}.impressions', 4, 10)} AS ctr_percent",
        f"{ratio(f'{a}.clicks * 100', f'{a}.reach', 4, 10)} AS unique_ctr_percent",
        f"{ratio(f'{a}.spend', f'{a}.clicks', 4, 18, ns=6)} AS avg_cpc",
        f"{ratio(f'{a}.spend', f'{a}.actions', 4, 18, ns=6, ds=6, guard=f'{acts} > 0')} AS cost_per_action",
        f"{ratio(vals, f'{a}.spend', 4, 10, ns=6, ds=6)} AS roas",
        f"{ratio(f'{a}.spend * 1000', f'{a}.impressions', 4, 18, ns=6)} AS avg_cpm",
        f"{ratio(f'{a}.spend * 1000', f'{a}.reach', 4, 18, ns=6)} AS cpp",
    ]
    if budget:
        out.append(f"{ratio(f'{a}.spend * 100', budget, 2, 10, ns=6, ds=6)} AS budget_utilization_percent")
    return ",\n  ".join(out)


def sums() -> str:
    return ("CAST(SUM(spend) AS DECIMAL(28,2)) AS total_spend, CAST(SUM(impressions) AS BIGINT) AS total_impressions, "
            "CAST(SUM(clicks) AS BIGINT) AS total_clicks, CAST(SUM(reach) AS BIGINT) AS total_reach, "
            "CAST(SUM(total_actions) AS DECIMAL(38,6)) AS total_actions, "
            "CAST(SUM(total_action_value) AS DECIMAL(38,6)) AS total_action_value")


def resums() -> str:
    return ("CAST(SUM(total_spend) AS DECIMAL(38,2)) AS total_spend, CAST(SUM(total_impressions) AS BIGINT) AS total_impressions, "
            "CAST(SUM(total_clicks) AS BIGINT) AS total_clicks, CAST(SUM(total_reach) AS BIGINT) AS total_reach, "
            "CAST(SUM(total_actions) AS DECIMAL(38,6)) AS total_actions, "
            "CAST(SUM(total_action_value) AS DECIMAL(38,6)) AS total_action_value")


def tk(names: dict) -> str:
    f = {
        "frequency": ratio("total_impressions", "total_reach", 4, 10),
        "ctr": ratio("total_clicks * 100", "total_impressions", 4, 10),
        "cpc": ratio("total_spend", "total_clicks", 4, 18, ns=2),
        "cpa": ratio("total_spend", "total_actions", 4, 18, ns=2, ds=6),
        "roas": ratio("total_action_value", "total_spend", 4, 10, ns=6, ds=2),
        "cpp": ratio("total_spend * 1000", "total_reach", 4, 18, ns=2),
    }
    return ", ".join(f"{f[k]} AS {v}" for k, v in names.items())


_T = ("fb_basic_ad", "fb_account_history", "fb_campaign_history", "fb_adset_history", "fb_ad_history",
      "fb_creative_history")
W = with_tables(*_T).rstrip()

ACCOUNT_BODY = f"""SELECT a.account_id, a.date, {date_key('a.date')} AS date_id, ah.name AS account_name,
  ah.currency AS currency_code, ah.timezone_name AS account_timezone, ah.account_status, {row_block('a')},
  a._fivetran_synced AS last_synced_at
FROM {rollup('account_id')} a LEFT JOIN {latest('fb_account_history', 'account_id')} ah ON a.account_id = ah.account_id"""

CAMPAIGN_BODY = f"""SELECT c.campaign_id, c.account_id, c.date, {date_key('c.date')} AS date_id, ch.name AS campaign_name,
  ch.status AS campaign_status, ch.objective AS campaign_objective, ch.daily_budget, ch.lifetime_budget,
  ah.name AS account_name, ah.currency AS currency_code, {row_block('c', budget='ch.daily_budget')},
  c._fivetran_synced AS last_synced_at
FROM {rollup('campaign_id, account_id')} c
LEFT JOIN {latest('fb_campaign_history', 'campaign_id')} ch ON c.campaign_id = ch.campaign_id
LEFT JOIN {latest('fb_account_history', 'account_id')} ah ON c.account_id = ah.account_id"""

ADSET_BODY = f"""SELECT ads.adset_id, ads.campaign_id, ads.account_id, ads.date, {date_key('ads.date')} AS date_id,
  adsh.name AS adset_name, adsh.status AS adset_status, adsh.optimization_goal, adsh.bid_amount,
  adsh.targeting AS targeting_spec, ch.name AS campaign_name, ch.status AS campaign_status,
  ch.objective AS campaign_objective, ah.name AS account_name, ah.currency AS currency_code, {row_block('ads')},
  CASE WHEN COALESCE(ads.actions, 0) > 0 AND adsh.bid_amount > 0 THEN
    CAST({ratio('ads.spend - adsh.bid_amount * ads.actions', 'ads.actions', 4, 18, ns=12, ds=6, guard='true')} AS DECIMAL(18,4))
  END AS cpa_vs_bid_variance,
  ads._fivetran_synced AS last_synced_at
FROM {rollup('adset_id, campaign_id, account_id')} ads
LEFT JOIN {latest('fb_adset_history', 'adset_id')} adsh ON ads.adset_id = adsh.adset_id
LEFT JOIN {latest('fb_campaign_history', 'campaign_id')} ch ON ads.campaign_id = ch.campaign_id
LEFT JOIN {latest('fb_account_history', 'account_id')} ah ON ads.account_id = ah.account_id"""

AD_BODY = f"""SELECT a.ad_id, a.adset_id, a.campaign_id, a.account_id, a.date, {date_key('a.date')} AS date_id,
  adh.name AS ad_name, adh.status AS ad_status, adh.creative_id, ch.name AS creative_name, ch.title AS creative_title,
  ch.body AS creative_body, ch.call_to_action_type, ch.object_type AS creative_type, adsh.name AS adset_name,
  camph.name AS campaign_name, camph.objective AS campaign_objective, ah.name AS account_name,
  ah.currency AS currency_code, {row_block('a', acts_typ='DECIMAL(18,6)')},
  CASE WHEN ch.object_type = 'PHOTO' THEN 'Image' WHEN ch.object_type = 'LINK' THEN 'Link'
       WHEN ch.object_type = 'VIDEO' THEN 'Video' WHEN ch.object_type = 'STATUS' THEN 'Status'
       WHEN ch.object_type = 'OFFER' THEN 'Offer' ELSE COALESCE(ch.object_type, 'Unknown') END AS creative_type_label,
  a._fivetran_synced AS last_synced_at
FROM fb_basic_ad a
LEFT JOIN {latest('fb_ad_history', 'ad_id')} adh ON a.ad_id = adh.ad_id
LEFT JOIN {latest('fb_creative_history', 'creative_id')} ch ON adh.creative_id = ch.creative_id
LEFT JOIN {latest('fb_adset_history', 'adset_id')} adsh ON a.adset_id = adsh.adset_id
LEFT JOIN {latest('fb_campaign_history', 'campaign_id')} camph ON a.campaign_id = camph.campaign_id
LEFT JOIN {latest('fb_account_history', 'account_id')} ah ON a.account_id = ah.account_id"""


def period(base: str, key: str, metrics: list[tuple[str, str]], extra: str = "") -> str:
    cols = ", ".join(f"CAST(SUM({m}) AS {typ}) AS {m}" for m, typ in metrics)
    return (f"cp AS (SELECT {key}, {cols}{extra} FROM {base} WHERE date >= {A} - 30 AND date < {A} GROUP BY {key}),\n"
            f"pp AS (SELECT {key}, {cols} FROM {base} WHERE date >= {A} - 60 AND date < {A} - 30 GROUP BY {key})")


_M = [("spend", "DECIMAL(28,2)"), ("impressions", "BIGINT"), ("clicks", "BIGINT"), ("reach", "BIGINT"),
      ("total_actions", "DECIMAL(38,6)"), ("total_action_value", "DECIMAL(38,6)")]

CE_ATTRS = ("ad_id, ad_name, ad_status, creative_id, creative_name, creative_title, creative_body, call_to_action_type, "
            "creative_type_label, adset_name, campaign_name, campaign_objective, account_name, currency_code")

CREATIVE_EFFECTIVENESS = f"""
agg AS (SELECT {CE_ATTRS}, {sums()}, COUNT(DISTINCT date) AS active_days FROM adp WHERE {CUR30} GROUP BY {CE_ATTRS}),
f AS (SELECT * FROM agg WHERE total_impressions > 0),
ce AS (SELECT ad_id, ad_name, ad_status, creative_id, creative_name, creative_type_label, call_to_action_type, adset_name,
  campaign_name, campaign_objective, account_name, currency_code,
  left(COALESCE(creative_title, ''), 100) AS creative_title_preview, left(COALESCE(creative_body, ''), 150) AS creative_body_preview,
  total_spend, total_impressions, total_clicks, total_reach, total_actions, total_action_value, active_days,
  {tk({'frequency': 'avg_frequency', 'ctr': 'ctr_percent', 'cpc': 'avg_cpc', 'cpa': 'cost_per_action', 'roas': 'roas'})},
  CAST(DENSE_RANK() OVER (PARTITION BY adset_name ORDER BY total_clicks DESC) AS INTEGER) AS clicks_rank_in_adset,
  CAST(DENSE_RANK() OVER (PARTITION BY adset_name ORDER BY total_actions DESC) AS INTEGER) AS actions_rank_in_adset,
  CAST(DENSE_RANK() OVER (PARTITION BY adset_name ORDER BY CASE WHEN total_impressions > 0 THEN total_clicks * 1.0 / total_impressions ELSE 0 END DESC) AS INTEGER) AS ctr_rank_in_adset,
  CASE WHEN total_actions >= 10 AND (CASE WHEN total_spend > 0 THEN total_action_value / total_spend ELSE 0 END) >= 2 THEN 'Top Performer'
       WHEN total_actions >= 5 AND (CASE WHEN total_impressions > 0 THEN total_clicks * 100.0 / total_impressions ELSE 0 END) >=
            AVG(CASE WHEN total_impressions > 0 THEN total_clicks * 100.0 / total_impressions ELSE 0 END) OVER () THEN 'Above Average'
       WHEN total_clicks > 0 AND total_actions = 0 THEN 'Clicks but No Actions'
       WHEN total_impressions > 0 AND total_clicks = 0 THEN 'Impressions but No Clicks'
       ELSE 'Developing' END AS performance_tier,
  CASE WHEN total_reach > 0 AND (total_impressions * 1.0 / total_reach) > 8 THEN 'High frequency - audience may be fatigued'
       WHEN total_impressions > 0 AND (total_clicks * 100.0 / total_impressions) < 0.5 THEN 'Low CTR - test new creative'
       WHEN total_clicks > 0 AND total_actions = 0 THEN 'Good clicks but no conversions - check landing page'
       WHEN total_actions > 0 AND total_spend > 0 AND (total_action_value / total_spend) < 1 THEN 'ROAS below 1 - optimize or pause'
       ELSE 'Performance acceptable' END AS optimization_suggestion
FROM f)"""

DRILL_KEYS = ("account_id, account_name, campaign_id, campaign_name, campaign_status, campaign_objective, adset_id, "
              "adset_name, adset_status, optimization_goal, currency_code")

ADSET_DRILLDOWN = f"""
agg AS (SELECT {DRILL_KEYS}, {sums()}, MIN(date) AS first_date, MAX(date) AS last_date, COUNT(DISTINCT date) AS active_days
        FROM asp WHERE {CUR30} GROUP BY {DRILL_KEYS}),
dd AS (SELECT concat(COALESCE(account_name, ''), ' > ', COALESCE(campaign_name, ''), ' > ', COALESCE(adset_name, '')) AS full_hierarchy_path,
  {DRILL_KEYS}, total_spend, total_impressions, total_clicks, total_reach, total_actions, total_action_value,
  {tk({'frequency': 'avg_frequency', 'ctr': 'ctr_percent', 'cpc': 'avg_cpc', 'cpa': 'cost_per_action', 'roas': 'roas'})},
  {share('total_spend', 'SUM(total_spend) OVER (PARTITION BY campaign_id)', 2, 2)} AS pct_of_campaign_spend,
  {share('total_clicks', 'SUM(total_clicks) OVER (PARTITION BY campaign_id)', 0, 0)} AS pct_of_campaign_clicks,
  {share('total_reach', 'SUM(total_reach) OVER (PARTITION BY campaign_id)', 0, 0)} AS pct_of_campaign_reach,
  {share('total_actions', 'SUM(total_actions) OVER (PARTITION BY campaign_id)', 6, 6)} AS pct_of_campaign_actions,
  CAST(DENSE_RANK() OVER (PARTITION BY campaign_id ORDER BY total_spend DESC) AS INTEGER) AS spend_rank_in_campaign,
  CAST(DENSE_RANK() OVER (PARTITION BY campaign_id ORDER BY total_actions DESC) AS INTEGER) AS actions_rank_in_campaign,
  CAST(DENSE_RANK() OVER (PARTITION BY campaign_id ORDER BY total_reach DESC) AS INTEGER) AS reach_rank_in_campaign,
  CASE WHEN total_actions > 0 AND (total_spend / total_actions) <
            AVG(CASE WHEN total_actions > 0 THEN total_spend / total_actions END) OVER (PARTITION BY campaign_id)
       THEN 'Above Average (Efficient Targeting)' WHEN total_actions > 0 THEN 'Below Average' ELSE 'No Actions' END AS targeting_effectiveness,
  CASE WHEN total_reach > 0 AND (total_impressions * 1.0 / total_reach) > 10 THEN 'High Frequency - Consider expanding audience'
       WHEN total_reach > 0 AND (total_impressions * 1.0 / total_reach) > 5 THEN 'Moderate Frequency - Monitor for fatigue'
       WHEN total_reach > 0 THEN 'Healthy Frequency' ELSE 'No Reach Data' END AS frequency_health,
  first_date, last_date, active_days
FROM agg)"""

SUMMARY = f"""
s AS (SELECT campaign_id, campaign_name, campaign_status, campaign_objective, account_name, currency_code, {sums()},
        MIN(date) AS first_date, MAX(date) AS last_date, COUNT(DISTINCT date) AS active_days
      FROM cpf WHERE {CUR30}
      GROUP BY campaign_id, campaign_name, campaign_status, campaign_objective, account_name, currency_code)"""

SQL: dict[str, str] = {
    "fb_account_performance": with_tables(*_T) + ACCOUNT_BODY,
    "fb_account_performance_summary": W + f""",
apf AS ({ACCOUNT_BODY}),
{period('apf', 'account_id', _M, ", MIN(date) AS period_start, MAX(date) AS period_end, COUNT(DISTINCT date) AS days_in_period")}
SELECT cp.account_id, ah.name AS account_name, ah.currency AS currency_code, cp.spend AS current_spend,
  cp.impressions AS current_impressions, cp.clicks AS current_clicks, cp.reach AS current_reach,
  cp.total_actions AS current_actions, cp.total_action_value AS current_action_value,
  {ratio('cp.clicks * 100', 'cp.impressions', 4, 10)} AS current_ctr,
  {ratio('cp.spend', 'cp.clicks', 4, 18, ns=2)} AS current_cpc,
  {ratio('cp.impressions', 'cp.reach', 4, 10)} AS current_frequency,
  {ratio('cp.spend', 'cp.total_actions', 4, 18, ns=2, ds=6)} AS current_cost_per_action,
  {ratio('cp.total_action_value', 'cp.spend', 4, 10, ns=6, ds=2)} AS current_roas,
  COALESCE(pp.spend, 0) AS previous_spend, COALESCE(pp.impressions, 0) AS previous_impressions,
  COALESCE(pp.clicks, 0) AS previous_clicks, COALESCE(pp.reach, 0) AS previous_reach,
  COALESCE(pp.total_actions, 0) AS previous_actions,
  {change_pct('cp.spend', 'COALESCE(pp.spend, 0)', 2)} AS spend_change_percent,
  {change_pct('cp.impressions', 'COALESCE(pp.impressions, 0)', 0)} AS impressions_change_percent,
  {change_pct('cp.reach', 'COALESCE(pp.reach, 0)', 0)} AS reach_change_percent,
  {change_pct('cp.total_actions', 'COALESCE(pp.total_actions, 0)', 6)} AS actions_change_percent,
  cp.period_start, cp.period_end, cp.days_in_period
FROM cp LEFT JOIN pp ON cp.account_id = pp.account_id
LEFT JOIN {latest('fb_account_history', 'account_id')} ah ON cp.account_id = ah.account_id""",
    "fb_campaign_performance": with_tables(*_T) + CAMPAIGN_BODY,
    "fb_campaign_trend_analysis": W + f""",
cpf AS ({CAMPAIGN_BODY})
SELECT campaign_id, date, campaign_name, campaign_status, campaign_objective, spend, impressions, clicks, reach,
  total_actions, total_action_value, ctr_percent, avg_cpc, frequency, roas,
  {xavg('spend', 2, '(PARTITION BY campaign_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 22)} AS spend_7day_ma,
  AVG(impressions) OVER (PARTITION BY campaign_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS impressions_7day_ma,
  AVG(reach) OVER (PARTITION BY campaign_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS reach_7day_ma,
  {xavg('total_actions', 6, '(PARTITION BY campaign_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 32)} AS actions_7day_ma,
  {xavg('ctr_percent', 4, '(PARTITION BY campaign_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 14)} AS ctr_7day_ma,
  {xavg('frequency', 4, '(PARTITION BY campaign_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 14)} AS frequency_7day_ma,
  {xavg('spend', 2, '(PARTITION BY campaign_id ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)', 22)} AS spend_30day_ma,
  AVG(impressions) OVER (PARTITION BY campaign_id ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS impressions_30day_ma,
  {xavg('total_actions', 6, '(PARTITION BY campaign_id ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)', 32)} AS actions_30day_ma,
  LAG(spend, 7) OVER (PARTITION BY campaign_id ORDER BY date) AS spend_last_week,
  LAG(reach, 7) OVER (PARTITION BY campaign_id ORDER BY date) AS reach_last_week,
  LAG(total_actions, 7) OVER (PARTITION BY campaign_id ORDER BY date) AS actions_last_week,
  {change_pct('spend', 'LAG(spend, 7) OVER (PARTITION BY campaign_id ORDER BY date)', 2)} AS spend_wow_change_percent,
  {change_pct('reach', 'LAG(reach, 7) OVER (PARTITION BY campaign_id ORDER BY date)', 0)} AS reach_wow_change_percent,
  CAST(SUM(spend) OVER (PARTITION BY campaign_id, year(date), month(date) ORDER BY date) AS DECIMAL(28,2)) AS mtd_spend,
  CAST(SUM(total_actions) OVER (PARTITION BY campaign_id, year(date), month(date) ORDER BY date) AS DECIMAL(38,6)) AS mtd_actions,
  CAST(DENSE_RANK() OVER (PARTITION BY date ORDER BY spend DESC) AS INTEGER) AS daily_spend_rank,
  CAST(DENSE_RANK() OVER (PARTITION BY date ORDER BY total_actions DESC) AS INTEGER) AS daily_actions_rank,
  CAST(DENSE_RANK() OVER (PARTITION BY date ORDER BY reach DESC) AS INTEGER) AS daily_reach_rank
FROM cpf""",
    "fb_campaign_performance_summary": W + f""",
cpf AS ({CAMPAIGN_BODY}),{SUMMARY}
SELECT campaign_id, campaign_name, campaign_status, campaign_objective, account_name, currency_code, total_spend,
  total_impressions, total_clicks, total_reach, total_actions, total_action_value,
  {tk({'frequency': 'avg_frequency', 'ctr': 'avg_ctr', 'cpc': 'avg_cpc', 'cpa': 'avg_cost_per_action', 'roas': 'avg_roas', 'cpp': 'avg_cpp'})},
  first_date, last_date, active_days
FROM s""",
    "fb_campaign_objective_analysis": W + f""",
cpf AS ({CAMPAIGN_BODY}),{SUMMARY},
g AS (SELECT campaign_objective, account_name, COUNT(DISTINCT campaign_id) AS campaign_count, {resums()}
      FROM s GROUP BY campaign_objective, account_name)
SELECT campaign_objective, account_name, campaign_count, total_spend, total_impressions, total_clicks, total_reach,
  total_actions, total_action_value,
  {ratio('total_spend', 'campaign_count', 2, 18, ns=2, guard='campaign_count <> 0', default='NULL')} AS avg_spend_per_campaign,
  {ratio('total_actions', 'campaign_count', 2, 10, ns=6, guard='campaign_count <> 0', default='NULL')} AS avg_actions_per_campaign,
  {tk({'ctr': 'ctr_percent', 'cpc': 'avg_cpc', 'cpa': 'cost_per_action', 'roas': 'roas', 'frequency': 'avg_frequency'})},
  {share('total_spend', 'SUM(total_spend) OVER ()', 2, 2)} AS pct_of_total_spend,
  {share('total_actions', 'SUM(total_actions) OVER ()', 6, 6)} AS pct_of_total_actions
FROM g""",
    "fb_adset_performance": with_tables(*_T) + ADSET_BODY,
    "fb_adset_drilldown": W + f""",
asp AS ({ADSET_BODY}),{ADSET_DRILLDOWN}
SELECT * FROM dd""",
    "fb_adset_performance_summary": W + f""",
asp AS ({ADSET_BODY}),
{period('asp', 'adset_id', _M[:5])}
SELECT a.adset_id, a.adset_name, a.adset_status, a.optimization_goal, a.campaign_name, a.account_name,
  cp.spend AS current_spend, cp.impressions AS current_impressions, cp.clicks AS current_clicks,
  cp.reach AS current_reach, cp.total_actions AS current_actions,
  {ratio('cp.impressions', 'cp.reach', 4, 10)} AS current_frequency,
  COALESCE(pp.spend, 0) AS previous_spend, COALESCE(pp.reach, 0) AS previous_reach,
  COALESCE(pp.total_actions, 0) AS previous_actions,
  {change_pct('cp.spend', 'COALESCE(pp.spend, 0)', 2)} AS spend_change_percent,
  {change_pct('cp.reach', 'COALESCE(pp.reach, 0)', 0)} AS reach_change_percent,
  {change_pct('cp.total_actions', 'COALESCE(pp.total_actions, 0)', 6)} AS actions_change_percent
FROM (SELECT DISTINCT adset_id, adset_name, adset_status, optimization_goal, campaign_name, account_name FROM asp) a
JOIN cp ON a.adset_id = cp.adset_id LEFT JOIN pp ON a.adset_id = pp.adset_id""",
    "fb_adset_optimization_goal_analysis": W + f""",
asp AS ({ADSET_BODY}),{ADSET_DRILLDOWN},
g AS (SELECT optimization_goal, campaign_objective, COUNT(DISTINCT adset_id) AS adset_count, {resums()}
      FROM dd GROUP BY optimization_goal, campaign_objective)
SELECT *, {tk({'ctr': 'avg_ctr', 'cpc': 'avg_cpc', 'cpa': 'avg_cost_per_action', 'roas': 'avg_roas', 'frequency': 'avg_frequency'})}
FROM g""",
    "fb_ad_performance": with_tables(*_T) + AD_BODY,
    "fb_ad_creative_effectiveness": W + f""",
adp AS ({AD_BODY}),{CREATIVE_EFFECTIVENESS}
SELECT * FROM ce""",
    "fb_ad_creative_type_comparison": W + f""",
adp AS ({AD_BODY}),{CREATIVE_EFFECTIVENESS},
g AS (SELECT creative_type_label, call_to_action_type, account_name, COUNT(DISTINCT ad_id) AS ad_count,
        COUNT(DISTINCT adset_name) AS adsets_with_type, COUNT(DISTINCT campaign_name) AS campaigns_with_type, {resums()}
      FROM ce GROUP BY creative_type_label, call_to_action_type, account_name)
SELECT creative_type_label, call_to_action_type, account_name, ad_count, adsets_with_type, campaigns_with_type,
  total_spend, total_impressions, total_clicks, total_reach, total_actions, total_action_value,
  {ratio('total_spend', 'ad_count', 2, 18, ns=2, guard='ad_count <> 0', default='NULL')} AS avg_spend_per_ad,
  {ratio('total_actions', 'ad_count', 2, 10, ns=6, guard='ad_count <> 0', default='NULL')} AS avg_actions_per_ad,
  {tk({'frequency': 'avg_frequency', 'ctr': 'ctr_percent', 'cpc': 'avg_cpc', 'cpa': 'cost_per_action', 'roas': 'roas'})}
FROM g""",
    "fb_ad_cta_analysis": W + f""",
adp AS ({AD_BODY}),{CREATIVE_EFFECTIVENESS},
g AS (SELECT call_to_action_type, campaign_objective, COUNT(DISTINCT ad_id) AS ad_count,
        CAST(SUM(total_spend) AS DECIMAL(38,2)) AS total_spend, CAST(SUM(total_impressions) AS BIGINT) AS total_impressions,
        CAST(SUM(total_clicks) AS BIGINT) AS total_clicks, CAST(SUM(total_actions) AS DECIMAL(38,6)) AS total_actions,
        CAST(SUM(total_action_value) AS DECIMAL(38,6)) AS total_action_value
      FROM ce WHERE call_to_action_type IS NOT NULL GROUP BY call_to_action_type, campaign_objective)
SELECT *, {tk({'ctr': 'avg_ctr', 'cpc': 'avg_cpc', 'cpa': 'avg_cost_per_action', 'roas': 'avg_roas'})},
  CAST(DENSE_RANK() OVER (ORDER BY CASE WHEN total_impressions > 0 THEN total_clicks * 1.0 / total_impressions ELSE 0 END DESC) AS INTEGER) AS ctr_rank,
  CAST(DENSE_RANK() OVER (ORDER BY CASE WHEN total_clicks > 0 THEN CAST(total_actions AS DOUBLE) / CAST(total_clicks AS DOUBLE) ELSE 0 END DESC) AS INTEGER) AS conversion_rate_rank
FROM g""",
}


def _ins_base(where: str, extra: str) -> str:
    return f"""SELECT a.ad_id, a.adset_id, a.campaign_id, a.account_id, a.date, {date_key('a.date')} AS date_id, {extra}
  adh.name AS ad_name, adsh.name AS adset_name, ch.name AS campaign_name, ch.objective AS campaign_objective,
  ah.name AS account_name, ah.currency AS currency_code, CAST(a.spend AS DECIMAL(18,2)) AS spend, a.impressions, a.clicks,
  a.reach, COALESCE(a.actions, 0) AS total_actions, COALESCE(a.action_values, 0) AS total_action_value,
  {ratio('a.clicks * 100', 'a.impressions', 4, 10)} AS ctr_percent,
  {ratio('a.spend', 'a.clicks', 4, 18, ns=6)} AS avg_cpc,
  {ratio('a.spend', 'a.actions', 4, 18, ns=6, ds=6, guard='COALESCE(a.actions, 0) > 0')} AS cost_per_action,
  {ratio('COALESCE(a.action_values, 0)', 'a.spend', 4, 10, ns=6, ds=6)} AS roas,
  {{cpm}}a._fivetran_synced AS last_synced_at
FROM fb_basic_ad a
LEFT JOIN {latest('fb_ad_history', 'ad_id')} adh ON a.ad_id = adh.ad_id
LEFT JOIN {latest('fb_adset_history', 'adset_id')} adsh ON a.adset_id = adsh.adset_id
LEFT JOIN {latest('fb_campaign_history', 'campaign_id')} ch ON a.campaign_id = ch.campaign_id
LEFT JOIN {latest('fb_account_history', 'account_id')} ah ON a.account_id = ah.account_id
WHERE {where}"""


def _s(c: str, typ: str) -> str:
    return f"CAST(SUM(CASE WHEN date >= {A} - 30 THEN {c} ELSE 0 END) AS {typ})"


SQL.update({
    "fb_insights_demographics": with_tables(*_T) + _ins_base(
        "a.age IS NOT NULL OR a.gender IS NOT NULL", "a.age AS age_range, a.gender,").replace("{cpm}", ""),
    "fb_insights_placements": with_tables(*_T) + _ins_base(
        "a.publisher_platform IS NOT NULL OR a.platform_position IS NOT NULL",
        "a.publisher_platform, a.platform_position, a.impression_device, a.device_platform, "
        "concat(COALESCE(a.publisher_platform, 'Unknown'), ' - ', COALESCE(a.platform_position, 'Unknown')) AS placement_label,"
    ).replace("{cpm}", f"{ratio('a.spend * 1000', 'a.impressions', 4, 18, ns=6)} AS avg_cpm, "),
    "q_fb_executive": W + f""",
apf AS ({ACCOUNT_BODY})
SELECT account_name, currency_code, {_s('spend', 'DECIMAL(28,2)')} AS current_spend,
  {_s('impressions', 'BIGINT')} AS current_impressions, {_s('reach', 'BIGINT')} AS current_reach,
  {_s('total_actions', 'DECIMAL(38,6)')} AS current_actions
FROM apf WHERE date >= {A} - 60 GROUP BY account_name, currency_code""",
    "q_fb_daily_trend": W + f""",
apf AS ({ACCOUNT_BODY})
SELECT date, dayname(date) AS day_name, CAST(SUM(spend) AS DECIMAL(28,2)) AS daily_spend,
  CAST(SUM(impressions) AS BIGINT) AS daily_impressions, CAST(SUM(reach) AS BIGINT) AS daily_reach,
  CAST(SUM(total_actions) AS DECIMAL(38,6)) AS daily_actions,
  {ratio('SUM(clicks) * 100', 'SUM(impressions)', 4, 10)} AS daily_ctr
FROM apf WHERE date >= {A} - 90 GROUP BY date ORDER BY date""",
    "q_fb_campaign_matrix": W + f""",
cpf AS ({CAMPAIGN_BODY}),{SUMMARY}
SELECT campaign_name, campaign_status, campaign_objective, total_spend, total_reach, total_actions, total_action_value,
  {tk({'ctr': 'avg_ctr', 'cpc': 'avg_cpc', 'cpa': 'avg_cost_per_action', 'roas': 'avg_roas', 'frequency': 'avg_frequency'})}
FROM s WHERE total_spend > 0""",
    "q_fb_adset_overview": W + f""",
asp AS ({ADSET_BODY}),{ADSET_DRILLDOWN}
SELECT adset_name, campaign_name, optimization_goal, total_spend, total_reach, total_actions, avg_frequency,
  ctr_percent, cost_per_action, roas FROM dd WHERE total_spend > 0""",
    "q_fb_creative": W + f""",
adp AS ({AD_BODY}),{CREATIVE_EFFECTIVENESS}
SELECT ad_name, creative_type_label, call_to_action_type, total_spend, total_clicks, total_actions, ctr_percent,
  cost_per_action, roas FROM ce WHERE total_impressions > 100""",
})


def _bd(src_sql: str, keys: str) -> str:
    return f"""g AS (SELECT {keys}, CAST(SUM(spend) AS DECIMAL(28,2)) AS total_spend, CAST(SUM(impressions) AS BIGINT) AS total_impressions,
    CAST(SUM(clicks) AS BIGINT) AS total_clicks, CAST(SUM(reach) AS BIGINT) AS total_reach,
    CAST(SUM(total_actions) AS DECIMAL(28,6)) AS total_actions, CAST(SUM(total_action_value) AS DECIMAL(28,6)) AS total_action_value
  FROM ({src_sql}) GROUP BY {keys}),
b AS (SELECT *, {tk({'ctr': 'avg_ctr', 'cpa': 'avg_cost_per_action', 'roas': 'avg_roas'})},
    {ratio('total_spend * 1000', 'total_impressions', 4, 18, ns=2)} AS avg_cpm FROM g)"""


_DEMO = SQL["fb_insights_demographics"]
_PLACE = SQL["fb_insights_placements"]
_DEMO_SUMMARY = f"""WITH {_bd(_DEMO, 'age_range, gender')}
SELECT *, CAST(DENSE_RANK() OVER (ORDER BY CASE WHEN total_actions > 0 THEN avg_cost_per_action END ASC NULLS FIRST) AS INTEGER) AS cost_efficiency_rank
FROM b"""
_PLACE_SUMMARY = f"""WITH {_bd(_PLACE, 'publisher_platform, platform_position')}
SELECT publisher_platform, platform_position, total_spend, total_impressions, total_clicks, total_reach, total_actions,
  total_action_value, avg_ctr, avg_cost_per_action, avg_roas, avg_cpm,
  CASE WHEN total_actions = 0 THEN 'No conversions - review placement'
       WHEN avg_cost_per_action <= {ratio('SUM(total_spend) OVER ()', 'SUM(total_actions) OVER ()', 4, 18, ns=2, ds=6)} THEN 'Scale placement'
       ELSE 'Optimize or reduce spend' END AS placement_recommendation
FROM b"""

SQL.update({
    "fb_demographic_summary": _DEMO_SUMMARY,
    "fb_placement_summary": _PLACE_SUMMARY,
    "fb_device_performance": f"WITH {_bd(_PLACE, 'impression_device, device_platform')} SELECT * FROM b",
    "fb_age_gender_matrix": f"""SELECT age_range,
  CAST(SUM(CASE WHEN gender = 'male' THEN spend END) AS DECIMAL(28,2)) AS male_spend,
  CAST(SUM(CASE WHEN gender = 'female' THEN spend END) AS DECIMAL(28,2)) AS female_spend,
  CAST(SUM(CASE WHEN gender = 'unknown' THEN spend END) AS DECIMAL(28,2)) AS unknown_spend,
  CAST(SUM(spend) FILTER (WHERE gender IS NULL OR gender NOT IN ('male', 'female', 'unknown')) AS DECIMAL(28,2)) AS other_spend
FROM ({_DEMO}) GROUP BY age_range""",
    "q_fb_demographic": f"""SELECT age_range, gender, total_spend, total_actions, avg_ctr, avg_cost_per_action, avg_roas,
  cost_efficiency_rank FROM ({_DEMO_SUMMARY})""",
    "q_fb_placement": f"""SELECT publisher_platform, platform_position, total_spend, total_impressions, total_actions, avg_ctr,
  avg_cpm, avg_cost_per_action, placement_recommendation FROM ({_PLACE_SUMMARY})""",
})
