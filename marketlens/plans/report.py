"""Report data queries: the aggregation behind each visual of the dashboard pages.

A visual groups by its category columns and aggregates its value columns with the model's
default summarisation (``DEFAULT_SUMMARY``) or evaluates a measure.  Rendering is not built.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import Tables
from . import crm, email, engagements
from .measures import contact_measures, evaluate
from .model import RELATIONSHIPS

def _rules(sums: str, averages: str = "") -> dict[str, str]:
    return {**dict.fromkeys(sums.split(), "sum"), **dict.fromkeys(averages.split(), "average")}


#: Fixed: how the semantic model summarises each imported column; all others are only grouped by.
DEFAULT_SUMMARY: dict[str, dict[str, str]] = {
    "CompanyPerformance": _rules("total_revenue total_deals won_deals pipeline_value total_engagements total_lifetime_value"),
    "ContactLifecycleFunnel": _rules("contact_count new_contacts_30d new_contacts_90d total_revenue", "avg_revenue"),
    "ContactPerformance": _rules("total_revenue total_engagements"),
    "DealForecast": _rules("deal_count pipeline_value weighted_pipeline", "avg_probability avg_deal_size"),
    "DealOwnerPerformance": _rules("total_deals won_deals lost_deals open_deals closed_won_revenue pipeline_value", "win_rate avg_won_deal_size avg_days_to_close_won"),
    "DealPerformance": _rules("amount weighted_amount is_closed is_closed_won total_engagements", "deal_age_days actual_days_to_close"),
    "DealPipelineSummary": _rules("deal_count total_value weighted_value", "probability avg_deal_size"),
    "EmailPerformance": _rules("sent_count delivered_count unique_opens total_opens unique_clicks total_clicks bounce_count",
                               "delivery_rate unique_open_rate unique_click_rate click_to_open_rate"),
    "EngagementDailySummary": _rules("total_engagements total_calls total_meetings total_emails total_notes total_tasks unique_contacts_engaged "
                                     "unique_companies_engaged unique_deals_engaged"),
    "EngagementOwnerSummary": _rules("total_engagements total_calls total_meetings total_emails engagements_30d calls_30d meetings_30d unique_contacts_engaged "
                                     "unique_companies_engaged"),
}

_AGG = {"sum": F.sum, "average": F.avg}


def summarize(df: DataFrame, table: str, by: Sequence[str], values: Sequence[str] | None = None) -> DataFrame:
    """Group by ``by`` and aggregate each value column (all that the model summarises, unless given) with its default summarisation."""
    rules = DEFAULT_SUMMARY[table]
    # flags add up as 0 and 1
    number = {f.name: F.col(f.name).cast("int") if f.dataType.typeName() == "boolean" else F.col(f.name) for f in df.schema.fields}
    return df.groupBy(*by).agg(*[_AGG[rules[v]](number[v]).alias(v) for v in (rules if values is None else values)])


def _measure(df: DataFrame, by: Sequence[str], names: Mapping[str, str], as_of) -> DataFrame:
    base, derived = contact_measures(as_of)
    out = evaluate(df, base, by, derived)
    return out.select(*by, *[F.col(k).alias(v) for k, v in names.items()])


def rq_stage_counts(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return summarize(crm.contact_lifecycle_funnel(t, as_of), "ContactLifecycleFunnel", ["stage_display_name"],
                     ["contact_count"])


def rq_engagement_line(t: Tables) -> DataFrame:
    return summarize(engagements.engagement_daily_summary(t), "EngagementDailySummary", ["engagement_date"],
                     ["total_engagements"])


def rq_contacts_by_lifecycle(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return _measure(crm.contact_performance(t, as_of), ["lifecycle_stage_display"], {"total_contacts": "total_contacts"},
                    as_of)


def rq_contacts_by_source(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return _measure(crm.contact_performance(t, as_of), ["hs_analytics_source"], {"total_contacts": "total_contacts"},
                    as_of)


def rq_contact_owner_table(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return summarize(crm.contact_performance(t, as_of), "ContactPerformance", ["owner_name"],
                     ["total_engagements", "total_revenue"])


def rq_pipeline_funnel(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return summarize(crm.deal_pipeline_summary(t, as_of), "DealPipelineSummary", ["stage_label"], ["total_value"])


def rq_owner_deals_table(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return summarize(crm.deal_owner_performance(t, as_of), "DealOwnerPerformance", ["owner_name"],
                     ["total_deals", "closed_won_revenue", "win_rate"])


def rq_deal_table(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return summarize(crm.deal_performance(t, as_of), "DealPerformance", ["deal_name", "deal_health_status", "owner_name"],
                     ["amount"])


def rq_email_table(t: Tables) -> DataFrame:
    return summarize(email.email_performance(t), "EmailPerformance", ["campaign_name", "performance_tier"],
                     ["sent_count", "unique_open_rate", "unique_click_rate"])


def rq_sent_by_tier(t: Tables) -> DataFrame:
    return email.email_performance(t).groupBy("performance_tier").agg(F.sum("sent_count").alias("total_emails_sent"))


def rq_engagement_by_weekday(t: Tables) -> DataFrame:
    return summarize(engagements.engagement_daily_summary(t), "EngagementDailySummary", ["day_of_week"],
                     ["total_engagements"])


def rq_owner_engagement_table(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return summarize(engagements.engagement_owner_summary(t, as_of), "EngagementOwnerSummary", ["owner_name"],
                     ["total_engagements", "total_calls", "total_meetings"])


def across(many: DataFrame, one: DataFrame, relationship: str, columns: Mapping[str, str], slicers: Mapping[str, object] | None = None) -> DataFrame:
    """Bring columns of the one side to the many side, and let filters set on the one side reach it.

    Without ``slicers`` rows of no partner stay (the model's blank row); a filter on the one side
    leaves only rows whose partner passes it."""
    from ..operators.dims import attach
    from ..sources.catalog import slice_rows
    edge = next(r for r in RELATIONSHIPS if r.name == relationship)
    chosen = slice_rows(one, slicers) if slicers else one
    return attach(many, chosen, {edge.column: edge.key}, columns, "inner" if slicers else "left")


def rq_contacts_by_company_health(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Contact measures by the health of the related company (ContactToCompany)."""
    rows = across(crm.contact_performance(t, as_of), crm.company_performance(t, as_of), "ContactToCompany",
                  {"account_health_status": "company_health"})
    return _measure(rows, ["company_health"], {"total_contacts": "total_contacts", "total_contact_revenue": "total_contact_revenue"}, as_of)


def rq_deals_of_winning_owners(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Deals by status, filtered from the other side of DealToOwnerPerformance: owners with a win rate of 40 or more."""
    rows = across(crm.deal_performance(t, as_of), crm.deal_owner_performance(t, as_of).where(F.col("owner_id").isNotNull()),
                  "DealToOwnerPerformance", {}, {"win_rate": (40, None)})
    return summarize(rows, "DealPerformance", ["deal_status"], ["amount", "weighted_amount"])


def rq_companies_by_status(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return summarize(crm.company_performance(t, as_of), "CompanyPerformance", ["customer_status"])


def rq_forecast_by_period(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return summarize(crm.deal_forecast(t, as_of), "DealForecast", ["forecast_period"])


def rq_deals_by_status(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return summarize(crm.deal_performance(t, as_of), "DealPerformance", ["deal_status"])
