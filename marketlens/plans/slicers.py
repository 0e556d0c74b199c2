"""Report slicer sets: named combinations of slicers, each over the view that its page reads.

Slicers on columns that the source tables have (dates, ids) are pushed to them through ``Sliced`` and prune the scan before any join or
aggregate; slicers on looked-up attributes apply to the view's rows. A page then groups by the columns it shows.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from inspect import signature

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import Sliced, Tables, slice_rows
from . import crm, email, engagements, search_ads


@dataclass(frozen=True)
class SlicerSet:
    """``rows`` plans the view; ``slicers`` maps a slicer's name to the view's column; ``source`` names those that the source tables carry
    under the same column, ``sums`` what the page adds up."""
    rows: Callable[..., DataFrame]
    slicers: Mapping[str, str]
    source: Sequence[str]
    sums: Sequence[str]


#: Fixed: the recommended slicer combinations.
SLICER_SETS = {
    "executive": SlicerSet(search_ads.account_performance, {"date": "date", "account": "account_id"}, ["date", "account"], ["spend", "clicks", "conversions"]),
    "campaign": SlicerSet(search_ads.campaign_performance, {"campaign": "campaign_id", "date": "date"}, ["campaign", "date"], ["spend", "clicks", "conversions"]),
    "drill_down": SlicerSet(search_ads.ad_group_performance, {"ad_group": "ad_group_id", "campaign": "campaign_id", "date": "date"},
                            ["ad_group", "campaign", "date"], ["spend", "clicks", "conversions"]),
    "keywords": SlicerSet(search_ads.keyword_performance, {"match_type": "keyword_match_type", "campaign": "campaign_id"}, [], ["spend", "clicks", "conversions"]),
    "ads": SlicerSet(search_ads.ad_performance, {"ad_type": "ad_type", "campaign": "campaign_id"}, [], ["spend", "clicks", "conversions"]),
    "sales_rep": SlicerSet(engagements.engagement_performance, {"date": "engagement_date", "owner": "owner_id"}, [], ["call_duration_ms"]),
    "lifecycle": SlicerSet(crm.contact_performance, {"stage": "lifecycle_stage", "owner": "owner_id"}, [], ["total_revenue", "total_engagements"]),
    "deal_funnel": SlicerSet(crm.deal_performance, {"pipeline": "pipeline_id", "stage": "stage_label", "date": "close_date"}, [], ["amount", "weighted_amount"]),
    "email": SlicerSet(email.email_performance, {"campaign": "campaign_name", "date": "first_sent_at"}, [], ["sent_count", "unique_opens", "unique_clicks"]),
    "activity": SlicerSet(engagements.engagement_performance, {"type": "engagement_type", "owner": "owner_id", "date": "engagement_date"}, [], ["call_duration_ms"]),
}


def sliced_rows(t: Tables, name: str, values: Mapping[str, object], as_of=None) -> DataFrame:
    """The rows of a set's view under slicer values: value, list of values or (low, high); slicers not given let all rows pass."""
    chosen = SLICER_SETS[name]
    unknown = set(values) - set(chosen.slicers)
    if unknown:
        raise ValueError(f"slicer set {name} has no slicer {', '.join(sorted(unknown))}")
    early = {chosen.slicers[k]: v for k, v in values.items() if k in chosen.source}
    late = {chosen.slicers[k]: v for k, v in values.items() if k not in chosen.source}
    tables = Sliced(t, early) if early else t
    rows = chosen.rows(tables, as_of) if "as_of" in signature(chosen.rows).parameters else chosen.rows(tables)
    # history tables carry ids but no stats dates: the view's own columns are sliced as well, which costs nothing on sliced scans
    return slice_rows(rows, {**early, **late})


def page(t: Tables, name: str, by: Sequence[str], values: Mapping[str, object], as_of=None) -> DataFrame:
    rows = sliced_rows(t, name, values, as_of)
    return rows.groupBy(*by).agg(F.count("*").alias("row_count"), *[F.sum(c).alias(c) for c in SLICER_SETS[name].sums])


def q_sliced_executive(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Accounts 0 to 2 in March 2024, sliced at the scan."""
    return page(t, "executive", ["account_id", "account_name"], {"date": (_dt.date(2024, 3, 1), _dt.date(2024, 3, 31)), "account": [0, 1, 2]})


def q_sliced_keywords(t: Tables) -> DataFrame:
    """Exact and phrase keywords of the first campaigns, the hot one among them."""
    return page(t, "keywords", ["campaign_id", "keyword_match_type"], {"match_type": ["EXACT", "PHRASE"], "campaign": (0, 19)})


def q_sliced_lifecycle(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Customers and opportunities by owner."""
    return page(t, "lifecycle", ["owner_id", "lifecycle_stage"], {"stage": ["customer", "opportunity"]}, as_of)


def q_sliced_activity(t: Tables) -> DataFrame:
    """Calls and meetings of owners 3 to 12 in January 2024, by owner and type."""
    return page(t, "activity", ["owner_id", "engagement_type"], {"type": ["CALL", "MEETING"], "owner": (3, 12), "date": (_dt.date(2024, 1, 1), _dt.date(2024, 1, 31))})
