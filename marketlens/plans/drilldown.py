"""Report pages that need whole hierarchies or ranges: the account > campaign > ad group matrix, contacts engaged over any range."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import share_pct
from ..functions.dates import as_date_lit, in_last_days
from ..operators.dims import attach
from ..operators.distincts import distinct_count, distinct_state
from ..operators.hierarchy import drill_down
from ..operators.latest import latest_by_key
from ..sources.catalog import Tables
from .crm import live
from .engagements import BRIDGES
from .search_ads import _std_kpis

HIERARCHY = ["account_id", "campaign_id", "ad_group_id"]
METRICS = {f"total_{m}": m for m in ["spend", "impressions", "clicks", "conversions", "conversions_value"]}


def q_ad_hierarchy(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Drill-down matrix of the last 30 days: total, accounts, campaigns and ad groups with their share of the parent's spend."""
    facts = t["ad_group_stats"].where(in_last_days("date", as_of, 30)).select(*HIERARCHY, *METRICS.values())
    m = drill_down(facts, HIERARCHY, METRICS, parents=["total_spend"])
    for table, key, column, name in [("account_history", "account_id", "descriptive_name", "account_name"),
                                     ("campaign_history", "campaign_id", "name", "campaign_name"),
                                     ("ad_group_history", "ad_group_id", "name", "ad_group_name")]:
        m = attach(m, latest_by_key(t[table], key), key, {column: name})
    k = _std_kpis(*METRICS, names={"cpm": None})
    return m.select("level", *HIERARCHY, "account_name", "campaign_name", "ad_group_name", *METRICS, *[v.alias(n) for n, v in k.items()],
                    share_pct("total_spend", "parent_total_spend").alias("pct_of_parent_spend"))


def engaged_members(t: Tables, kind: str = "contact") -> DataFrame:
    """The daily mart's mergeable state: which contacts (companies, deals) were engaged on each day, as bitmaps."""
    table, member = BRIDGES[kind]
    days = live(t, "engagement").where(F.col("timestamp").isNotNull()).select("engagement_id", F.to_date("timestamp").alias("engagement_date"))
    bridge = t[table].select("engagement_id", F.col(member).cast("long").alias("member"))
    return distinct_state(bridge.join(days, "engagement_id"), ["engagement_date"], "member")


def q_contacts_engaged_ranges(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Distinct contacts engaged in several ranges at once, from the daily state alone: the last 7, 30 and 90 days and each month."""
    state, day = engaged_members(t), F.col("engagement_date")
    a = as_date_lit(as_of)
    last = F.array(*[F.when((day >= F.date_sub(a, n)) & (day < a), F.lit(f"last {n} days")) for n in (7, 30, 90)])
    ranges = F.array_append(last, F.date_format(day, "yyyy-MM"))
    rows = state.select("*", F.explode(F.array_compact(ranges)).alias("period"))
    return distinct_count(rows, ["period"], "contacts_engaged")
