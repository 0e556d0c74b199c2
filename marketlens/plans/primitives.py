"""One query per primitive family, each exercising a single operator on the driver data, so a
failing primitive is visible on its own (the named marts compose several)."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import share_pct
from ..functions.dates import (days_between, hours_between_boundary, minutes_between_boundary,
                               months_between_boundary, quarters_between_boundary, sunday_week_of_year,
                               weeks_between_boundary)
from ..operators.latest import latest_by_key, not_deleted
from ..operators.ranks import global_ranks
from ..operators.scan import look_back, running_totals
from ..operators.shares import with_group_aggs
from ..operators.windows import lag_of, moving_avg, running_total
from ..sources.catalog import Tables
from .crm import live


def p_latest_by_key_search(t: Tables) -> DataFrame:
    """Latest history row per key with no delete rule (search-ads convention)."""
    return latest_by_key(t["campaign_history"], "campaign_id").select(
        "campaign_id", "name", "_fivetran_synced", "_fivetran_deleted")


def p_latest_by_key_social(t: Tables) -> DataFrame:
    """Latest non-deleted history row per key, NULL flag kept (social convention)."""
    return latest_by_key(t["fb_campaign_history"], "campaign_id", where=not_deleted(lenient=True)).select(
        "campaign_id", "name", "_fivetran_synced", "_fivetran_deleted")


def p_datediff_boundaries(t: Tables) -> DataFrame:
    """Boundary-counting DATEDIFF for every unit, Sunday and ISO weeks, on deal create/close."""
    d = live(t, "deal").filter(F.col("close_date").isNotNull())
    c, e = F.col("create_date"), F.col("close_date").cast("timestamp_ntz")
    return d.select("deal_id", days_between(c, e).alias("days"), weeks_between_boundary(c, e).alias("weeks"),
                    months_between_boundary(c, e).alias("months"), quarters_between_boundary(c, e).alias("quarters"),
                    hours_between_boundary(c, e).alias("hours"), minutes_between_boundary(c, e).alias("minutes"),
                    sunday_week_of_year(c).alias("week_of_year"), F.weekofyear(c).alias("iso_week"))


def p_global_ranks(t: Tables) -> DataFrame:
    """Whole-result DENSE_RANK / RANK / PERCENT_RANK of every deal (parallel ranks)."""
    d = live(t, "deal").select("deal_id", "amount", "close_date")
    return global_ranks(d, {"amount_dense_rank": ("dense", [("amount", False)]),
                            "amount_rank": ("rank", [("amount", False)]),
                            "close_percent_rank": ("percent", [("close_date", True)])})


def p_shares(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Share of total (scalar-subquery total) and share within the parent (grouped total joined back)."""
    from ..functions.dates import in_last_days
    c = t["campaign_stats"].filter(in_last_days("date", as_of, 30)).groupBy("campaign_id", "account_id") \
        .agg(F.sum("impressions").alias("impressions"))
    c = with_group_aggs(c, [], {"_all": F.sum("impressions")})
    c = with_group_aggs(c, ["account_id"], {"_acct": F.sum("impressions")})
    return c.select("campaign_id", "account_id", "impressions", share_pct("impressions", "_all").alias("pct_of_total"),
                    share_pct("impressions", F.col("_acct")).alias("pct_of_account"))


def p_row_windows(t: Tables) -> DataFrame:
    """Row-frame moving average, LAG and ROWS running total per entity by date."""
    a = t["account_stats"].select("account_id", "date", "impressions", "clicks")
    p, o = ["account_id"], ["date"]
    return a.select("account_id", "date", "impressions", moving_avg(p, o, "impressions", 7).alias("impressions_7_ma"),
                    lag_of(p, o, "clicks", 1).alias("clicks_prev"),
                    running_total(p, o, "clicks", frame="rows").alias("clicks_running"))


def p_scan_windows(t: Tables) -> DataFrame:
    """ROW_NUMBER, ROWS running total, moving average and LAG over all deals in one order, without partition and without a one-task window."""
    d = live(t, "deal").select("deal_id", "close_date", "amount")
    d = running_totals(d, [("close_date", True), ("deal_id", True)], {"amount_so_far": "amount"}, "position")
    return look_back(d, "position", {"amount_5_ma": ("amount", 5)}, {"amount_before": ("amount", 1), "date_3_before": ("close_date", 3)}, chunk_rows=1000)
