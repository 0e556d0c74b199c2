"""Oracle SQL: primitive-family queries."""
from __future__ import annotations

from .adapters import with_tables
from .crm import days, hours, weeks
from .kit import ratio, xavg

A = "DATE '2024-04-30'"


def _latest(table: str, where: str = "") -> str:
    w = f"WHERE {where}" if where else ""
    return (f"SELECT campaign_id, name, _fivetran_synced, _fivetran_deleted FROM (SELECT *, ROW_NUMBER() OVER "
            f"(PARTITION BY campaign_id ORDER BY _fivetran_synced DESC) AS rn FROM {table} {w}) WHERE rn = 1")


SQL: dict[str, str] = {
    "p_latest_by_key_search": with_tables("campaign_history") + _latest("campaign_history"),
    "p_latest_by_key_social": with_tables("fb_campaign_history") + _latest(
        "fb_campaign_history", "COALESCE(_fivetran_deleted, false) = false"),
    "p_datediff_boundaries": with_tables("deal") + f"""
SELECT deal_id, {days('create_date', 'close_date')} AS days, {weeks('create_date', 'close_date')} AS weeks,
  CAST((year(close_date) * 12 + month(close_date)) - (year(create_date) * 12 + month(create_date)) AS INTEGER) AS months,
  CAST((year(close_date) * 4 + quarter(close_date)) - (year(create_date) * 4 + quarter(create_date)) AS INTEGER) AS quarters,
  {hours('create_date', 'CAST(close_date AS TIMESTAMP)')} AS hours,
  ({hours('create_date', 'CAST(close_date AS TIMESTAMP)')} * 60 + minute(CAST(close_date AS TIMESTAMP)) - minute(create_date)) AS minutes,
  CAST(floor((dayofyear(create_date) + dayofweek(date_trunc('year', create_date)) + 1 - 2) / 7) + 1 AS INTEGER) AS week_of_year,
  CAST(weekofyear(create_date) AS INTEGER) AS iso_week
FROM deal WHERE _fivetran_deleted = false AND close_date IS NOT NULL""",
    "p_global_ranks": with_tables("deal") + """
SELECT deal_id, amount, close_date,
  CAST(DENSE_RANK() OVER (ORDER BY amount DESC NULLS LAST) AS INTEGER) AS amount_dense_rank,
  CAST(RANK() OVER (ORDER BY amount DESC NULLS LAST) AS INTEGER) AS amount_rank,
  PERCENT_RANK() OVER (ORDER BY close_date ASC NULLS FIRST) AS close_percent_rank
FROM deal WHERE _fivetran_deleted = false""",
    "p_row_windows": with_tables("account_stats") + """
SELECT account_id, date, impressions,
  AVG(impressions) OVER (PARTITION BY account_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS impressions_7_ma,
  LAG(clicks, 1) OVER (PARTITION BY account_id ORDER BY date) AS clicks_prev,
  CAST(SUM(clicks) OVER (PARTITION BY account_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS clicks_running
FROM account_stats""",
}

SQL["p_shares"] = with_tables("campaign_stats") + f"""
SELECT campaign_id, account_id, impressions,
  {ratio('impressions * 100', 'SUM(impressions) OVER ()', 2, 10, guard='SUM(impressions) OVER () <> 0', default='NULL')} AS pct_of_total,
  {ratio('impressions * 100', 'SUM(impressions) OVER (PARTITION BY account_id)', 2, 10, guard='SUM(impressions) OVER (PARTITION BY account_id) <> 0', default='NULL')} AS pct_of_account
FROM (SELECT campaign_id, account_id, CAST(SUM(impressions) AS BIGINT) AS impressions FROM campaign_stats
      WHERE date >= {A} - 30 GROUP BY campaign_id, account_id)"""


SQL["p_scan_windows"] = with_tables("deal") + f"""
SELECT deal_id, close_date, amount, row_number() OVER w AS position,
  CAST(SUM(amount) OVER (w ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,2)) AS amount_so_far,
  {xavg('amount', 2, '(ORDER BY close_date NULLS FIRST, deal_id ROWS 4 PRECEDING)', 22)} AS amount_5_ma,
  LAG(amount) OVER w AS amount_before, LAG(close_date, 3) OVER w AS date_3_before
FROM deal WHERE _fivetran_deleted = false WINDOW w AS (ORDER BY close_date NULLS FIRST, deal_id)"""
