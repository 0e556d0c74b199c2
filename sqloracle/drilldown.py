"""Oracle SQL: relationship filters over several hops, the ads hierarchy, distinct counts over ranges, marts over deliveries."""
from __future__ import annotations

from .adapters import with_tables
from .kit import ratio
from .search_ads import ADS_AS_OF, kpis, latest

CRM = "DATE '2024-01-31'"
_EUR = f"(SELECT account_id FROM {latest('account_history', 'account_id')} WHERE currency_code = '{{}}')"

SQL: dict[str, str] = {
    "rq_ad_groups_of_accounts": with_tables("ad_group_stats", "campaign_stats", "account_stats", "ad_group_history", "campaign_history", "account_history") + f"""
SELECT s.ad_group_id, g.name AS ad_group_name, c.name AS campaign_name, CAST(SUM(CAST(s.spend AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_spend,
  CAST(SUM(s.clicks) AS BIGINT) AS total_clicks, CAST(SUM(coalesce(s.conversions, 0)) AS DECIMAL(28,6)) AS total_conversions
FROM ad_group_stats s LEFT JOIN {latest('ad_group_history', 'ad_group_id')} g ON s.ad_group_id = g.ad_group_id
LEFT JOIN {latest('campaign_history', 'campaign_id')} c ON s.campaign_id = c.campaign_id
WHERE s.campaign_id IN (SELECT campaign_id FROM campaign_stats WHERE account_id IN {_EUR.format('EUR')})
GROUP BY ALL""",
    "rq_campaigns_of_quarter": with_tables("campaign_stats", "account_stats", "campaign_history", "account_history") + f"""
SELECT s.campaign_id, c.name AS campaign_name, CAST(SUM(CAST(s.spend AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_spend,
  CAST(SUM(s.impressions) AS BIGINT) AS total_impressions
FROM campaign_stats s LEFT JOIN {latest('campaign_history', 'campaign_id')} c ON s.campaign_id = c.campaign_id
WHERE quarter(s.date) = 1 AND s.account_id IN {_EUR.format('USD')} GROUP BY ALL""",
    "q_ad_hierarchy": with_tables("ad_group_stats", "ad_group_history", "campaign_history", "account_history") + f"""
, f AS (SELECT * FROM ad_group_stats WHERE date >= {ADS_AS_OF} - 30 AND date < {ADS_AS_OF}),
lv AS (
  SELECT 0 AS level, NULL::BIGINT AS a, NULL::BIGINT AS c, NULL::BIGINT AS g, * FROM (SELECT sum(spend) s, sum(impressions) i, sum(clicks) k, sum(conversions) n, sum(conversions_value) v FROM f)
  UNION ALL SELECT 1, account_id, NULL, NULL, sum(spend), sum(impressions), sum(clicks), sum(conversions), sum(conversions_value) FROM f GROUP BY account_id
  UNION ALL SELECT 2, account_id, campaign_id, NULL, sum(spend), sum(impressions), sum(clicks), sum(conversions), sum(conversions_value) FROM f GROUP BY account_id, campaign_id
  UNION ALL SELECT 3, account_id, campaign_id, ad_group_id, sum(spend), sum(impressions), sum(clicks), sum(conversions), sum(conversions_value) FROM f GROUP BY ALL
)
SELECT CAST(l.level AS INTEGER) AS level, l.a AS account_id, l.c AS campaign_id, l.g AS ad_group_id, ah.descriptive_name AS account_name, ch.name AS campaign_name,
  gh.name AS ad_group_name, CAST(l.s AS DECIMAL(28,6)) AS total_spend, CAST(l.i AS BIGINT) AS total_impressions, CAST(l.k AS BIGINT) AS total_clicks,
  CAST(l.n AS DECIMAL(28,6)) AS total_conversions, CAST(l.v AS DECIMAL(28,6)) AS total_conversions_value,
  {kpis('l.s', 'l.i', 'l.k', 'l.n', 'l.v', 6, 6, 6, names={'cpm': None})},
  {ratio('l.s * 100', 'p.s', 2, 10, ns=6, ds=6, guard='p.s <> 0', default='NULL')} AS pct_of_parent_spend
FROM lv l LEFT JOIN lv p ON p.level = l.level - 1 AND (p.level < 1 OR p.a IS NOT DISTINCT FROM l.a) AND (p.level < 2 OR p.c IS NOT DISTINCT FROM l.c)
LEFT JOIN {latest('account_history', 'account_id')} ah ON l.a = ah.account_id LEFT JOIN {latest('campaign_history', 'campaign_id')} ch ON l.c = ch.campaign_id
LEFT JOIN {latest('ad_group_history', 'ad_group_id')} gh ON l.g = gh.ad_group_id
WHERE (SELECT count(*) FROM f) > 0""",
    "q_contacts_engaged_ranges": with_tables("engagement", "engagement_contact") + f"""
, m AS (SELECT CAST(e.timestamp AS DATE) AS d, b.contact_id FROM engagement e JOIN engagement_contact b ON e.engagement_id = b.engagement_id
  WHERE e._fivetran_deleted = false AND e.timestamp IS NOT NULL)
SELECT 'last ' || n || ' days' AS period, count(DISTINCT contact_id) AS contacts_engaged FROM m, (VALUES (7), (30), (90)) r(n)
WHERE d >= {CRM} - CAST(n AS INTEGER) AND d < {CRM} GROUP BY n
UNION ALL SELECT strftime(d, '%Y-%m'), count(DISTINCT contact_id) FROM m GROUP BY 1""",
    "q_imported_campaign_days": with_tables("campaign_stats") + "SELECT campaign_id, date, impressions, clicks, spend FROM campaign_stats",
    "q_maintained_channel_days": with_tables("campaign_stats", "campaign_history") + f"""
SELECT s.date, h.advertising_channel_type, h.name, count(*) AS row_count, CAST(sum(s.impressions) AS BIGINT) AS impressions,
  CAST(sum(s.clicks) AS BIGINT) AS clicks, CAST(sum(s.spend) AS DECIMAL(38,6)) AS spend
FROM campaign_stats s LEFT JOIN {latest('campaign_history', 'campaign_id')} h ON s.campaign_id = h.campaign_id GROUP BY ALL""",
}
