"""Oracle SQL: search-ads marts."""
from __future__ import annotations

from .adapters import with_tables
from .kit import change_pct, date_key, ratio, xavg, xdiv as xdiv_

ADS_AS_OF = "DATE '2024-04-30'"


def latest(table: str, key: str, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return (f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY _fivetran_synced DESC) AS rn "
            f"FROM {table}{w}) WHERE rn = 1)")


def kpis(spend, imp, clicks, conv, value, s_spend, s_conv, s_value, names=None):
    n = {"ctr": "ctr_percent", "cpc": "avg_cpc", "cvr": "conversion_rate_percent",
         "cpa": "cost_per_conversion", "roas": "roas", "cpm": "avg_cpm"}
    n.update(names or {})
    out = [
        (n["ctr"], ratio(f"{clicks} * 100", imp, 4, 10)),
        (n["cpc"], ratio(spend, clicks, 4, 18, ns=s_spend)),
        (n["cvr"], ratio(f"{conv} * 100", clicks, 4, 10, ns=s_conv)),
        (n["cpa"], ratio(spend, conv, 4, 18, ns=s_spend, ds=s_conv)),
        (n["roas"], ratio(value, spend, 4, 10, ns=s_value, ds=s_spend)),
        (n["cpm"], ratio(f"{spend} * 1000", imp, 4, 18, ns=s_spend)),
    ]
    return ",\n  ".join(f"{e} AS {k}" for k, e in out if k)


CAMPAIGN_PERFORMANCE_BODY = f"""
SELECT c.campaign_id, c.account_id, c.date, {date_key('c.date')} AS date_id,
  ch.name AS campaign_name, ch.status AS campaign_status, ch.advertising_channel_type,
  ch.advertising_channel_sub_type, ch.bidding_strategy_type, ch.start_date AS campaign_start_date,
  ch.end_date AS campaign_end_date, ch.budget_amount, ch.budget_period,
  ah.descriptive_name AS account_name, ah.currency_code,
  CAST(c.spend AS DECIMAL(18,2)) AS spend, c.impressions, c.clicks,
  CAST(COALESCE(c.conversions, 0) AS DECIMAL(18,6)) AS conversions,
  CAST(COALESCE(c.conversions_value, 0) AS DECIMAL(18,6)) AS conversions_value,
  CAST(COALESCE(c.view_through_conversions, 0) AS DECIMAL(18,6)) AS view_through_conversions,
  COALESCE(c.video_views, 0) AS video_views,
  COALESCE(c.video_quartile_p25_rate, 0) AS video_quartile_25_rate,
  COALESCE(c.video_quartile_p50_rate, 0) AS video_quartile_50_rate,
  COALESCE(c.video_quartile_p75_rate, 0) AS video_quartile_75_rate,
  COALESCE(c.video_quartile_p100_rate, 0) AS video_quartile_100_rate,
  COALESCE(c.interactions, 0) AS interactions,
  COALESCE(c.interaction_event_types, '') AS interaction_event_types,
  {kpis('c.spend', 'c.impressions', 'c.clicks', 'COALESCE(c.conversions, 0)', 'COALESCE(c.conversions_value, 0)', 6, 6, 6)},
  {ratio('c.spend * 100', 'ch.budget_amount', 2, 10, ns=6, ds=6)} AS budget_utilization_percent,
  c._fivetran_synced AS last_synced_at
FROM campaign_stats c
LEFT JOIN {latest('campaign_history', 'campaign_id')} ch ON c.campaign_id = ch.campaign_id
LEFT JOIN {latest('account_history', 'account_id')} ah ON c.account_id = ah.account_id
"""

_CP_TABLES = ("campaign_stats", "campaign_history", "account_history")


def _with_cp(extra: str = "") -> str:
    return with_tables(*_CP_TABLES).rstrip() + f",\ncampaign_performance AS ({CAMPAIGN_PERFORMANCE_BODY})" + extra


W = "(PARTITION BY campaign_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
L7 = "LAG({c}, 7) OVER (PARTITION BY campaign_id ORDER BY date)"
MTD = "(PARTITION BY campaign_id, year(date), month(date) ORDER BY date)"

SQL: dict[str, str] = {
    "campaign_performance": with_tables(*_CP_TABLES) + CAMPAIGN_PERFORMANCE_BODY,
    "campaign_performance_summary": _with_cp() + f"""
SELECT campaign_id, campaign_name, campaign_status, advertising_channel_type, account_name, currency_code,
  total_spend, total_impressions, total_clicks, total_conversions, total_conversions_value,
  {kpis('total_spend', 'total_impressions', 'total_clicks', 'total_conversions', 'total_conversions_value', 2, 6, 6,
        names={'ctr': 'avg_ctr', 'cpc': 'avg_cpc', 'cvr': 'avg_conversion_rate', 'cpa': 'avg_cost_per_conversion',
               'roas': 'avg_roas', 'cpm': None})},
  first_date, last_date, active_days
FROM (
  SELECT campaign_id, campaign_name, campaign_status, advertising_channel_type, account_name, currency_code,
    CAST(SUM(spend) AS DECIMAL(28,2)) AS total_spend, CAST(SUM(impressions) AS BIGINT) AS total_impressions,
    CAST(SUM(clicks) AS BIGINT) AS total_clicks, CAST(SUM(conversions) AS DECIMAL(28,6)) AS total_conversions,
    CAST(SUM(conversions_value) AS DECIMAL(28,6)) AS total_conversions_value,
    MIN(date) AS first_date, MAX(date) AS last_date, COUNT(DISTINCT date) AS active_days
  FROM campaign_performance
  WHERE date >= {ADS_AS_OF} - 30
  GROUP BY campaign_id, campaign_name, campaign_status, advertising_channel_type, account_name, currency_code
)""",
    "campaign_trend_analysis": _with_cp() + f"""
SELECT campaign_id, date, campaign_name, campaign_status, advertising_channel_type, spend, impressions, clicks,
  conversions, conversions_value, ctr_percent, avg_cpc, conversion_rate_percent, roas,
  {xavg('spend', 2, W.format(n=6), prec=22)} AS spend_7day_ma,
  AVG(impressions) OVER {W.format(n=6)} AS impressions_7day_ma,
  AVG(clicks) OVER {W.format(n=6)} AS clicks_7day_ma,
  {xavg('conversions', 6, W.format(n=6), prec=22)} AS conversions_7day_ma,
  {xavg('ctr_percent', 4, W.format(n=6), prec=14)} AS ctr_7day_ma,
  {xavg('spend', 2, W.format(n=29), prec=22)} AS spend_30day_ma,
  AVG(impressions) OVER {W.format(n=29)} AS impressions_30day_ma,
  {xavg('conversions', 6, W.format(n=29), prec=22)} AS conversions_30day_ma,
  {L7.format(c='spend')} AS spend_last_week,
  {L7.format(c='clicks')} AS clicks_last_week,
  {L7.format(c='conversions')} AS conversions_last_week,
  {change_pct('spend', L7.format(c='spend'), 2)} AS spend_wow_change_percent,
  {change_pct('clicks', L7.format(c='clicks'), 0)} AS clicks_wow_change_percent,
  CAST(SUM(spend) OVER {MTD} AS DECIMAL(28,2)) AS mtd_spend,
  CAST(SUM(conversions) OVER {MTD} AS DECIMAL(28,6)) AS mtd_conversions,
  CAST(DENSE_RANK() OVER (PARTITION BY date ORDER BY spend DESC) AS INTEGER) AS daily_spend_rank,
  CAST(DENSE_RANK() OVER (PARTITION BY date ORDER BY conversions DESC) AS INTEGER) AS daily_conversions_rank
FROM campaign_performance""",
}


def micros(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(38,0)) * 0.000001 AS DECIMAL(30,9))"


def share(num: str, den: str, ns: int, ds: int) -> str:
    return ratio(f"{num} * 100", den, 2, 10, ns=ns, ds=ds, guard=f"({den}) <> 0", default="NULL")


def sums(prefix: str = "total_") -> str:
    return (f"CAST(SUM(spend) AS DECIMAL(28,2)) AS {prefix}spend, CAST(SUM(impressions) AS BIGINT) AS {prefix}impressions, "
            f"CAST(SUM(clicks) AS BIGINT) AS {prefix}clicks, CAST(SUM(conversions) AS DECIMAL(28,6)) AS {prefix}conversions, "
            f"CAST(SUM(conversions_value) AS DECIMAL(28,6)) AS {prefix}conversions_value")


def tkpis(names: dict | None = None, sp=2, cv=6, vl=6, p="total_") -> str:
    n = {"cpm": None}
    n.update(names or {})
    return kpis(f"{p}spend", f"{p}impressions", f"{p}clicks", f"{p}conversions", f"{p}conversions_value", sp, cv, vl, n)


STD_NAMES = {"ctr": "ctr_percent", "cpc": "avg_cpc", "cvr": "conversion_rate_percent", "cpa": "cost_per_conversion",
             "roas": "roas"}

_RAW = ("CAST({a}.spend AS DECIMAL(18,2)) AS spend, {a}.impressions, {a}.clicks, "
        "CAST(COALESCE({a}.conversions, 0) AS DECIMAL(18,6)) AS conversions, "
        "CAST(COALESCE({a}.conversions_value, 0) AS DECIMAL(18,6)) AS conversions_value")


def _rowkpis(a: str, names=None) -> str:
    return kpis(f"{a}.spend", f"{a}.impressions", f"{a}.clicks", f"COALESCE({a}.conversions, 0)",
                f"COALESCE({a}.conversions_value, 0)", 6, 6, 6, names)


ACCOUNT_PERFORMANCE_BODY = f"""
SELECT a.account_id, a.date, {date_key('a.date')} AS date_id, ah.descriptive_name AS account_name, ah.currency_code,
  ah.time_zone AS account_timezone, {_RAW.format(a='a')},
  CAST(COALESCE(a.view_through_conversions, 0) AS DECIMAL(18,6)) AS view_through_conversions,
  {_rowkpis('a')},
  {ratio('a.clicks * 1000', 'a.impressions', 4, 10)} AS engagement_rate,
  a._fivetran_synced AS last_synced_at
FROM account_stats a LEFT JOIN {latest('account_history', 'account_id')} ah ON a.account_id = ah.account_id"""

AD_GROUP_PERFORMANCE_BODY = f"""
SELECT ag.ad_group_id, ag.campaign_id, ag.account_id, ag.date, {date_key('ag.date')} AS date_id,
  agh.name AS ad_group_name, agh.status AS ad_group_status, agh.type AS ad_group_type,
  {micros('agh.cpc_bid_micros')} AS cpc_bid, {micros('agh.cpm_bid_micros')} AS cpm_bid,
  {micros('agh.target_cpa_micros')} AS target_cpa, {micros('agh.effective_target_cpa_micros')} AS effective_target_cpa,
  agh.effective_target_roas, ch.name AS campaign_name, ch.status AS campaign_status, ch.advertising_channel_type,
  ah.descriptive_name AS account_name, ah.currency_code, {_RAW.format(a='ag')},
  CAST(COALESCE(ag.view_through_conversions, 0) AS DECIMAL(18,6)) AS view_through_conversions,
  COALESCE(ag.interactions, 0) AS interactions,
  {_rowkpis('ag')},
  CASE WHEN COALESCE(ag.conversions, 0) > 0 AND agh.target_cpa_micros > 0 THEN
    {xdiv_('ag.spend - CAST(agh.target_cpa_micros AS DECIMAL(38,0)) * 0.000001 * ag.conversions', 'ag.conversions', 4, 12, 6, 18)}
  END AS cpa_vs_target_variance,
  ag._fivetran_synced AS last_synced_at
FROM ad_group_stats ag
LEFT JOIN {latest('ad_group_history', 'ad_group_id')} agh ON ag.ad_group_id = agh.ad_group_id
LEFT JOIN {latest('campaign_history', 'campaign_id')} ch ON ag.campaign_id = ch.campaign_id
LEFT JOIN {latest('account_history', 'account_id')} ah ON ag.account_id = ah.account_id"""

KEYWORD_PERFORMANCE_BODY = f"""
SELECT k.criterion_id AS keyword_id, k.ad_group_id, k.campaign_id, k.account_id, k.date, {date_key('k.date')} AS date_id,
  kh.keyword_text, kh.keyword_match_type, kh.status AS keyword_status, kh.system_serving_status, kh.approval_status,
  kh.quality_score, kh.creative_quality_score, kh.post_click_quality_score, kh.search_predicted_ctr,
  {micros('kh.cpc_bid_micros')} AS cpc_bid, {micros('kh.effective_cpc_bid_micros')} AS effective_cpc_bid,
  kh.final_url_suffix, agh.name AS ad_group_name, ch.name AS campaign_name, ah.descriptive_name AS account_name,
  ah.currency_code, {_RAW.format(a='k')},
  COALESCE(k.search_impression_share, 0) AS search_impression_share,
  COALESCE(k.search_top_impression_share, 0) AS search_top_impression_share,
  COALESCE(k.search_absolute_top_impression_share, 0) AS search_absolute_top_impression_share,
  COALESCE(k.search_rank_lost_impression_share, 0) AS search_rank_lost_impression_share,
  COALESCE(k.search_budget_lost_impression_share, 0) AS search_budget_lost_impression_share,
  {_rowkpis('k', {'cpm': None})},
  CASE WHEN kh.quality_score >= 7 THEN 'High (7-10)' WHEN kh.quality_score >= 4 THEN 'Medium (4-6)'
       WHEN kh.quality_score >= 1 THEN 'Low (1-3)' ELSE 'Not Available' END AS quality_score_category,
  k._fivetran_synced AS last_synced_at
FROM keyword_stats k
LEFT JOIN {latest('ad_group_criterion_history', 'criterion_id', "type = 'KEYWORD'")} kh ON k.criterion_id = kh.criterion_id
LEFT JOIN {latest('ad_group_history', 'ad_group_id')} agh ON k.ad_group_id = agh.ad_group_id
LEFT JOIN {latest('campaign_history', 'campaign_id')} ch ON k.campaign_id = ch.campaign_id
LEFT JOIN {latest('account_history', 'account_id')} ah ON k.account_id = ah.account_id"""

_AD_TEXT = ("responsive_search_ad_headlines, responsive_search_ad_descriptions, responsive_search_ad_path1, "
            "responsive_search_ad_path2, expanded_text_ad_headline_part1, expanded_text_ad_headline_part2, "
            "expanded_text_ad_headline_part3, expanded_text_ad_description, expanded_text_ad_description2, "
            "expanded_text_ad_path1, expanded_text_ad_path2, display_url, final_urls, final_mobile_urls")

AD_PERFORMANCE_BODY = f"""
SELECT a.ad_id, a.ad_group_id, a.campaign_id, a.account_id, a.date, {date_key('a.date')} AS date_id,
  adh.type AS ad_type, adh.status AS ad_status, adh.device_preference, {', '.join('adh.' + c.strip() for c in _AD_TEXT.split(','))},
  adh.ad_strength, agh.name AS ad_group_name, ch.name AS campaign_name, ch.advertising_channel_type,
  ah.descriptive_name AS account_name, ah.currency_code, {_RAW.format(a='a')},
  COALESCE(a.interactions, 0) AS interactions, COALESCE(a.video_views, 0) AS video_views,
  COALESCE(a.video_quartile_p100_rate, 0) AS video_completion_rate,
  {_rowkpis('a', {'cpm': None})},
  CASE WHEN adh.ad_strength = 'EXCELLENT' THEN 'Excellent' WHEN adh.ad_strength = 'GOOD' THEN 'Good'
       WHEN adh.ad_strength = 'AVERAGE' THEN 'Average' WHEN adh.ad_strength = 'POOR' THEN 'Poor'
       WHEN adh.ad_strength = 'UNSPECIFIED' OR adh.ad_strength IS NULL THEN 'Not Applicable'
       ELSE adh.ad_strength END AS ad_strength_label,
  a._fivetran_synced AS last_synced_at
FROM ad_stats a
LEFT JOIN {latest('ad_history', 'ad_id')} adh ON a.ad_id = adh.ad_id
LEFT JOIN {latest('ad_group_history', 'ad_group_id')} agh ON a.ad_group_id = agh.ad_group_id
LEFT JOIN {latest('campaign_history', 'campaign_id')} ch ON a.campaign_id = ch.campaign_id
LEFT JOIN {latest('account_history', 'account_id')} ah ON a.account_id = ah.account_id"""


def _with(body_name: str, body: str, tables: tuple) -> str:
    return with_tables(*tables).rstrip() + f",\n{body_name} AS ({body})\n"


_AP = ("account_stats", "account_history")
_AGP = ("ad_group_stats", "ad_group_history", "campaign_history", "account_history")
_KWP = ("keyword_stats", "ad_group_criterion_history", "ad_group_history", "campaign_history", "account_history")
_ADP = ("ad_stats", "ad_history", "ad_group_history", "campaign_history", "account_history")
CUR30 = f"date >= {ADS_AS_OF} - 30"

_KW_ATTRS = ("keyword_id, keyword_text, keyword_match_type, keyword_status, quality_score, quality_score_category, "
             "ad_group_name, campaign_name, account_name, currency_code")

_AD_ATTRS = ("ad_id, ad_type, ad_status, ad_strength_label, ad_group_name, campaign_name, account_name, currency_code, "
             "advertising_channel_type, responsive_search_ad_headlines, responsive_search_ad_descriptions, "
             "expanded_text_ad_headline_part1, expanded_text_ad_headline_part2, expanded_text_ad_description, final_urls")

_SUMCOLS = "total_spend, total_impressions, total_clicks, total_conversions, total_conversions_value"


def _resum() -> str:
    return (f"CAST(SUM(total_spend) AS DECIMAL(38,2)) AS total_spend, CAST(SUM(total_impressions) AS BIGINT) AS total_impressions, "
            f"CAST(SUM(total_clicks) AS BIGINT) AS total_clicks, CAST(SUM(total_conversions) AS DECIMAL(38,6)) AS total_conversions, "
            f"CAST(SUM(total_conversions_value) AS DECIMAL(38,6)) AS total_conversions_value")


SQL.update({
    "account_performance": with_tables(*_AP) + ACCOUNT_PERFORMANCE_BODY,
    "account_performance_summary": _with("ap", ACCOUNT_PERFORMANCE_BODY, _AP) + f""",
cp AS (SELECT account_id, {sums()}, MIN(date) AS period_start, MAX(date) AS period_end,
         COUNT(DISTINCT date) AS days_in_period
       FROM ap WHERE date >= {ADS_AS_OF} - 30 AND date < {ADS_AS_OF} GROUP BY account_id),
pp AS (SELECT account_id, {sums()} FROM ap WHERE date >= {ADS_AS_OF} - 60 AND date < {ADS_AS_OF} - 30 GROUP BY account_id)
SELECT cp.account_id, ah.descriptive_name AS account_name, ah.currency_code,
  cp.total_spend AS current_spend, cp.total_impressions AS current_impressions, cp.total_clicks AS current_clicks,
  cp.total_conversions AS current_conversions, cp.total_conversions_value AS current_conversions_value,
  {kpis('cp.total_spend', 'cp.total_impressions', 'cp.total_clicks', 'cp.total_conversions', 'cp.total_conversions_value', 2, 6, 6,
        {'ctr': 'current_ctr', 'cpc': 'current_cpc', 'cvr': 'current_conversion_rate', 'cpa': 'current_cost_per_conversion',
         'roas': 'current_roas', 'cpm': None})},
  COALESCE(pp.total_spend, 0) AS previous_spend, COALESCE(pp.total_impressions, 0) AS previous_impressions,
  COALESCE(pp.total_clicks, 0) AS previous_clicks, COALESCE(pp.total_conversions, 0) AS previous_conversions,
  {change_pct('cp.total_spend', 'COALESCE(pp.total_spend, 0)', 2)} AS spend_change_percent,
  {change_pct('cp.total_impressions', 'COALESCE(pp.total_impressions, 0)', 0)} AS impressions_change_percent,
  {change_pct('cp.total_clicks', 'COALESCE(pp.total_clicks, 0)', 0)} AS clicks_change_percent,
  {change_pct('cp.total_conversions', 'COALESCE(pp.total_conversions, 0)', 6)} AS conversions_change_percent,
  cp.period_start, cp.period_end, cp.days_in_period
FROM cp LEFT JOIN pp ON cp.account_id = pp.account_id
LEFT JOIN {latest('account_history', 'account_id')} ah ON cp.account_id = ah.account_id""",
    "ad_group_performance": with_tables(*_AGP) + AD_GROUP_PERFORMANCE_BODY,
    "ad_group_drilldown": _with("agp", AD_GROUP_PERFORMANCE_BODY, _AGP) + f""",
agg AS (SELECT account_id, account_name, campaign_id, campaign_name, campaign_status, advertising_channel_type,
          ad_group_id, ad_group_name, ad_group_status, ad_group_type, currency_code, {sums()},
          MIN(date) AS first_date, MAX(date) AS last_date, COUNT(DISTINCT date) AS active_days
        FROM agp WHERE {CUR30}
        GROUP BY account_id, account_name, campaign_id, campaign_name, campaign_status, advertising_channel_type,
          ad_group_id, ad_group_name, ad_group_status, ad_group_type, currency_code)
SELECT concat(COALESCE(account_name, ''), ' > ', COALESCE(campaign_name, ''), ' > ', COALESCE(ad_group_name, '')) AS full_hierarchy_path,
  account_id, account_name, campaign_id, campaign_name, campaign_status, advertising_channel_type, ad_group_id,
  ad_group_name, ad_group_status, ad_group_type, currency_code, {_SUMCOLS},
  {tkpis(STD_NAMES)},
  {share('total_spend', 'SUM(total_spend) OVER (PARTITION BY campaign_id)', 2, 2)} AS pct_of_campaign_spend,
  {share('total_clicks', 'SUM(total_clicks) OVER (PARTITION BY campaign_id)', 0, 0)} AS pct_of_campaign_clicks,
  {share('total_conversions', 'SUM(total_conversions) OVER (PARTITION BY campaign_id)', 6, 6)} AS pct_of_campaign_conversions,
  CAST(DENSE_RANK() OVER (PARTITION BY campaign_id ORDER BY total_spend DESC) AS INTEGER) AS spend_rank_in_campaign,
  CAST(DENSE_RANK() OVER (PARTITION BY campaign_id ORDER BY total_conversions DESC) AS INTEGER) AS conversions_rank_in_campaign,
  CASE WHEN total_conversions > 0 AND (total_spend / total_conversions) <
            AVG(CASE WHEN total_conversions > 0 THEN total_spend / total_conversions END) OVER (PARTITION BY campaign_id)
       THEN 'Above Average' WHEN total_conversions > 0 THEN 'Below Average' ELSE 'No Conversions' END AS performance_indicator,
  first_date, last_date, active_days
FROM agg""",
    "ad_group_performance_summary": _with("agp", AD_GROUP_PERFORMANCE_BODY, _AGP) + f""",
cp AS (SELECT ad_group_id, {sums()} FROM agp WHERE date >= {ADS_AS_OF} - 30 AND date < {ADS_AS_OF} GROUP BY ad_group_id),
pp AS (SELECT ad_group_id, {sums()} FROM agp WHERE date >= {ADS_AS_OF} - 60 AND date < {ADS_AS_OF} - 30 GROUP BY ad_group_id)
SELECT agp2.ad_group_id, agp2.ad_group_name, agp2.ad_group_status, agp2.campaign_name, agp2.account_name,
  cp.total_spend AS current_spend, cp.total_impressions AS current_impressions, cp.total_clicks AS current_clicks,
  cp.total_conversions AS current_conversions, COALESCE(pp.total_spend, 0) AS previous_spend,
  COALESCE(pp.total_conversions, 0) AS previous_conversions,
  {change_pct('cp.total_spend', 'COALESCE(pp.total_spend, 0)', 2)} AS spend_change_percent,
  {change_pct('cp.total_conversions', 'COALESCE(pp.total_conversions, 0)', 6)} AS conversions_change_percent
FROM (SELECT DISTINCT ad_group_id, ad_group_name, ad_group_status, campaign_name, account_name FROM agp) agp2
JOIN cp ON agp2.ad_group_id = cp.ad_group_id LEFT JOIN pp ON agp2.ad_group_id = pp.ad_group_id""",
    "keyword_performance": with_tables(*_KWP) + KEYWORD_PERFORMANCE_BODY,
    "keyword_top_performers": _with("kp", KEYWORD_PERFORMANCE_BODY, _KWP) + f""",
agg AS (SELECT {_KW_ATTRS}, {sums()}, {xavg('search_impression_share', 6, prec=14)} AS avg_impression_share
        FROM kp WHERE {CUR30} GROUP BY {_KW_ATTRS})
SELECT {_KW_ATTRS}, {_SUMCOLS}, {tkpis(STD_NAMES)}, avg_impression_share,
  CAST(DENSE_RANK() OVER (ORDER BY total_conversions DESC) AS INTEGER) AS conversions_rank,
  CAST(DENSE_RANK() OVER (ORDER BY total_spend DESC) AS INTEGER) AS spend_rank,
  CAST(DENSE_RANK() OVER (ORDER BY CASE WHEN total_spend > 0 THEN total_conversions_value / total_spend ELSE 0 END DESC) AS INTEGER) AS roas_rank,
  CAST(DENSE_RANK() OVER (ORDER BY CASE WHEN total_conversions > 0 THEN total_spend / total_conversions ELSE 999999 END ASC) AS INTEGER) AS efficiency_rank,
  CASE WHEN total_conversions >= 10 AND (CASE WHEN total_spend > 0 THEN total_conversions_value / total_spend ELSE 0 END) >= 2 THEN 'Star Performer'
       WHEN total_conversions >= 5 AND (CASE WHEN total_spend > 0 THEN total_conversions_value / total_spend ELSE 0 END) >= 1 THEN 'Strong Performer'
       WHEN total_clicks >= 100 AND total_conversions < 2 THEN 'High Traffic, Low Conversion'
       WHEN total_impressions >= 1000 AND total_clicks < 10 THEN 'Low CTR'
       WHEN total_spend > 0 AND total_conversions = 0 THEN 'Spending, No Conversions'
       ELSE 'Developing' END AS performance_classification
FROM agg WHERE total_impressions > 0""",
    "keyword_quality_score_analysis": _with("kp", KEYWORD_PERFORMANCE_BODY, _KWP) + f""",
agg AS (SELECT keyword_id, keyword_text, keyword_match_type, keyword_status, quality_score, quality_score_category,
          creative_quality_score, post_click_quality_score, search_predicted_ctr, ad_group_name, campaign_name,
          account_name, CAST(SUM(spend) AS DECIMAL(28,2)) AS total_spend, CAST(SUM(impressions) AS BIGINT) AS total_impressions,
          CAST(SUM(clicks) AS BIGINT) AS total_clicks, CAST(SUM(conversions) AS DECIMAL(28,6)) AS total_conversions
        FROM kp WHERE {CUR30} AND quality_score IS NOT NULL
        GROUP BY keyword_id, keyword_text, keyword_match_type, keyword_status, quality_score, quality_score_category,
          creative_quality_score, post_click_quality_score, search_predicted_ctr, ad_group_name, campaign_name, account_name)
SELECT keyword_id, keyword_text, keyword_match_type, keyword_status, quality_score, quality_score_category,
  creative_quality_score, post_click_quality_score, search_predicted_ctr, ad_group_name, campaign_name, account_name,
  total_spend, total_impressions, total_clicks, total_conversions,
  {ratio('total_clicks * 100', 'total_impressions', 4, 10)} AS ctr_percent,
  {ratio('total_spend', 'total_clicks', 4, 18, ns=2)} AS avg_cpc,
  {ratio('total_conversions * 100', 'total_clicks', 4, 10, ns=6)} AS conversion_rate_percent,
  CASE WHEN quality_score < 4 THEN 'Critical - Needs Immediate Attention'
       WHEN quality_score < 7 THEN 'Moderate - Room for Improvement' ELSE 'Good - Maintain Current Strategy' END AS qs_action_priority,
  CASE WHEN creative_quality_score = 'BELOW_AVERAGE' THEN 'Improve ad relevance'
       WHEN creative_quality_score = 'AVERAGE' THEN 'Test new ad copy' ELSE 'Ad creative is strong' END AS creative_recommendation,
  CASE WHEN post_click_quality_score = 'BELOW_AVERAGE' THEN 'Improve landing page experience'
       WHEN post_click_quality_score = 'AVERAGE' THEN 'Optimize landing page' ELSE 'Landing page is effective' END AS landing_page_recommendation,
  CASE WHEN search_predicted_ctr = 'BELOW_AVERAGE' THEN 'Improve expected CTR'
       WHEN search_predicted_ctr = 'AVERAGE' THEN 'Test more compelling ad copy' ELSE 'CTR expectations are good' END AS ctr_recommendation,
  {ratio('total_spend * 0.2', 'total_clicks', 4, 18, ns=3, guard='quality_score < 7 AND total_clicks > 0')} AS estimated_cpc_savings_potential
FROM agg""",
    "keyword_match_type_analysis": _with("kp", KEYWORD_PERFORMANCE_BODY, _KWP) + f""",
kw AS (SELECT keyword_id, keyword_match_type, quality_score, campaign_name, account_name, {sums()}
       FROM kp WHERE {CUR30} GROUP BY keyword_id, keyword_match_type, quality_score, campaign_name, account_name),
g AS (SELECT keyword_match_type, campaign_name, account_name, COUNT(DISTINCT keyword_id) AS keyword_count, {_resum()},
        {xavg('CAST(quality_score AS DECIMAL(10,2))', 2, prec=14)} AS avg_quality_score
      FROM kw GROUP BY keyword_match_type, campaign_name, account_name)
SELECT *, {tkpis(STD_NAMES)} FROM g""",
    "ad_performance": with_tables(*_ADP) + AD_PERFORMANCE_BODY,
    "ad_copy_effectiveness": _with("adp", AD_PERFORMANCE_BODY, _ADP) + f""",
agg AS (SELECT {_AD_ATTRS}, {sums()}, COUNT(DISTINCT date) AS active_days FROM adp WHERE {CUR30} GROUP BY {_AD_ATTRS}),
f AS (SELECT * FROM agg WHERE total_impressions > 0)
SELECT ad_id, ad_type, ad_status, ad_strength_label, ad_group_name, campaign_name, account_name, currency_code,
  advertising_channel_type,
  CASE WHEN ad_type = 'RESPONSIVE_SEARCH_AD' THEN left(COALESCE(responsive_search_ad_headlines, ''), 100)
       ELSE concat(COALESCE(expanded_text_ad_headline_part1, ''), ' | ', COALESCE(expanded_text_ad_headline_part2, '')) END AS ad_headline_preview,
  CASE WHEN ad_type = 'RESPONSIVE_SEARCH_AD' THEN left(COALESCE(responsive_search_ad_descriptions, ''), 100)
       ELSE COALESCE(expanded_text_ad_description, '') END AS ad_description_preview,
  final_urls AS landing_page_url, {_SUMCOLS}, active_days, {tkpis(STD_NAMES)},
  CAST(DENSE_RANK() OVER (PARTITION BY ad_group_name ORDER BY total_clicks DESC) AS INTEGER) AS clicks_rank_in_ad_group,
  CAST(DENSE_RANK() OVER (PARTITION BY ad_group_name ORDER BY total_conversions DESC) AS INTEGER) AS conversions_rank_in_ad_group,
  CAST(DENSE_RANK() OVER (PARTITION BY ad_group_name ORDER BY CASE WHEN total_impressions > 0 THEN total_clicks * 1.0 / total_impressions ELSE 0 END DESC) AS INTEGER) AS ctr_rank_in_ad_group,
  CASE WHEN total_conversions >= 5 AND (CASE WHEN total_spend > 0 THEN total_conversions_value / total_spend ELSE 0 END) >= 2 THEN 'Top Performer'
       WHEN total_conversions >= 2 AND (CASE WHEN total_impressions > 0 THEN total_clicks * 100.0 / total_impressions ELSE 0 END) >=
            AVG(CASE WHEN total_impressions > 0 THEN total_clicks * 100.0 / total_impressions ELSE 0 END) OVER () THEN 'Above Average'
       WHEN total_clicks > 0 AND total_conversions = 0 THEN 'Clicks but No Conversions'
       WHEN total_impressions > 0 AND total_clicks = 0 THEN 'Impressions but No Clicks'
       ELSE 'Developing' END AS performance_tier,
  CASE WHEN ad_strength_label IN ('Poor', 'Average') AND ad_type = 'RESPONSIVE_SEARCH_AD' THEN 'Improve ad strength'
       WHEN ad_strength_label = 'Excellent' AND total_conversions < 2 THEN 'Strong ad, low conversions - check targeting'
       ELSE 'No action needed' END AS optimization_suggestion
FROM f""",
    "ad_strength_analysis": _with("adp", AD_PERFORMANCE_BODY, _ADP) + f""",
ads AS (SELECT ad_id, ad_type, ad_strength_label, campaign_name, account_name, {sums()}
        FROM adp WHERE {CUR30} GROUP BY ad_id, ad_type, ad_strength_label, campaign_name, account_name),
g AS (SELECT ad_strength_label, ad_type, campaign_name, account_name, COUNT(DISTINCT ad_id) AS ad_count, {_resum()}
      FROM ads GROUP BY ad_strength_label, ad_type, campaign_name, account_name)
SELECT ad_strength_label, ad_type, campaign_name, account_name, ad_count, {_SUMCOLS},
  {tkpis({'ctr': 'avg_ctr_percent', 'cpc': 'avg_cpc', 'cvr': 'avg_conversion_rate', 'cpa': None, 'roas': 'avg_roas'})},
  {share('ad_count', 'SUM(ad_count) OVER ()', 0, 0)} AS pct_of_total_ads,
  {share('total_spend', 'SUM(total_spend) OVER ()', 2, 2)} AS pct_of_total_spend
FROM g""",
    "ad_type_comparison": _with("adp", AD_PERFORMANCE_BODY, _ADP) + f""",
ads AS (SELECT ad_id, ad_type, ad_group_name, campaign_name, account_name, {sums()}
        FROM adp WHERE {CUR30} GROUP BY ad_id, ad_type, ad_group_name, campaign_name, account_name),
g AS (SELECT ad_type, account_name, COUNT(DISTINCT ad_id) AS ad_count, COUNT(DISTINCT ad_group_name) AS ad_groups_with_type,
        COUNT(DISTINCT campaign_name) AS campaigns_with_type, {_resum()}
      FROM ads GROUP BY ad_type, account_name)
SELECT ad_type, account_name, ad_count, ad_groups_with_type, campaigns_with_type, {_SUMCOLS},
  {ratio('total_spend', 'ad_count', 2, 18, ns=2, guard='ad_count <> 0', default='NULL')} AS avg_spend_per_ad,
  {ratio('total_conversions', 'ad_count', 2, 10, ns=6, guard='ad_count <> 0', default='NULL')} AS avg_conversions_per_ad,
  {tkpis(STD_NAMES)}
FROM g""",
})

SQL["q_top_keywords"] = f"SELECT * FROM ({SQL['keyword_top_performers']}) ORDER BY conversions_rank, spend_rank, keyword_id, keyword_text, keyword_match_type, keyword_status, quality_score, ad_group_name, campaign_name, account_name LIMIT 10"
