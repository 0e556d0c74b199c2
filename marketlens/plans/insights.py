"""Documented recommendations without SQL in the source: benchmark / alert flags, deal
velocity, row-level security, cross-platform daily view, hour-of-day profile."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dec, ratio
from ..sources.catalog import Tables
from . import crm, email, search_ads, social_ads

# ---- fixed values: KPI "good benchmark" thresholds as documented for the dashboards (percent
# values are in percent units; ROAS is a ratio; CPM/CPP are currency per thousand)
SEARCH_CTR_MIN = {"SEARCH": "2", "DISPLAY": "0.5"}
SEARCH_CONVERSION_RATE_MIN = "3"
SEARCH_ROAS_MIN = "4"
SOCIAL_CTR_MIN = "1"
SOCIAL_UNIQUE_CTR_MIN = "2"
SOCIAL_FREQUENCY_RANGE = ("1.5", "3")
SOCIAL_FREQUENCY_MAX = "8"
SOCIAL_ROAS_MIN = "3"
SOCIAL_CPP_RANGE = ("8", "20")
DEAL_WIN_RATE_MIN = "25"
DEAL_DAYS_TO_CLOSE_MAX = "60"
EMAIL_DELIVERY_RATE_MIN = "95"
EMAIL_UNIQUE_OPEN_RATE_MIN = "20"
EMAIL_UNIQUE_CLICK_RATE_MIN = "3"
EMAIL_CLICK_TO_OPEN_MIN = "10"
EMAIL_BOUNCE_RATE_MAX = "2"
EMAIL_UNSUBSCRIBE_RATE_MAX = "0.5"
EMAIL_SPAM_RATE_MAX = "0.01"


def threshold_flags(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Add one boolean per rule plus ``benchmarks_met`` (count of true flags)."""
    out = df.withColumns(flags)
    met = sum(F.col(n).cast("int") for n in flags)
    return out.withColumn("benchmarks_met", met)


def q_kpi_benchmarks_search(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    s = search_ads.campaign_performance_summary(t, as_of)
    ch = F.col("advertising_channel_type")
    ctr_min = F.when(ch == "DISPLAY", dec(SEARCH_CTR_MIN["DISPLAY"])).otherwise(dec(SEARCH_CTR_MIN["SEARCH"]))
    return threshold_flags(s.select("campaign_id", "campaign_name", "advertising_channel_type", "account_name",
                                    "avg_ctr", "avg_conversion_rate", "avg_roas"), {
        "ctr_ok": F.col("avg_ctr") > ctr_min,
        "conversion_rate_ok": F.col("avg_conversion_rate") > dec(SEARCH_CONVERSION_RATE_MIN),
        "roas_ok": F.col("avg_roas") > dec(SEARCH_ROAS_MIN)})


def q_kpi_benchmarks_social(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    s = social_ads.fb_campaign_performance_summary(t, as_of)
    f = F.col("avg_frequency")
    return threshold_flags(s.select("campaign_id", "campaign_name", "account_name", "avg_ctr", "avg_frequency",
                                    "avg_roas", "avg_cpp"), {
        "ctr_ok": F.col("avg_ctr") > dec(SOCIAL_CTR_MIN),
        "frequency_ok": f.between(dec(SOCIAL_FREQUENCY_RANGE[0]), dec(SOCIAL_FREQUENCY_RANGE[1])),
        "frequency_fatigue": f > dec(SOCIAL_FREQUENCY_MAX),
        "roas_ok": F.col("avg_roas") > dec(SOCIAL_ROAS_MIN),
        "cpp_ok": F.col("avg_cpp").between(dec(SOCIAL_CPP_RANGE[0]), dec(SOCIAL_CPP_RANGE[1]))})


def q_email_deliverability_alerts(t: Tables) -> DataFrame:
    """Email benchmark flags; ``bounce_alert`` is the documented >2 % bounce-rate alert."""
    e = email.email_performance(t).filter(F.col("sent_count") > 0)
    out = threshold_flags(e.select("campaign_id", "campaign_name", "delivery_rate", "unique_open_rate",
                                   "unique_click_rate", "click_to_open_rate", "bounce_rate", "unsubscribe_rate",
                                   "spam_complaint_rate"), {
        "delivery_ok": F.col("delivery_rate") > dec(EMAIL_DELIVERY_RATE_MIN),
        "open_rate_ok": F.col("unique_open_rate") > dec(EMAIL_UNIQUE_OPEN_RATE_MIN),
        "click_rate_ok": F.col("unique_click_rate") > dec(EMAIL_UNIQUE_CLICK_RATE_MIN),
        "click_to_open_ok": F.col("click_to_open_rate") > dec(EMAIL_CLICK_TO_OPEN_MIN),
        "bounce_ok": F.col("bounce_rate") < dec(EMAIL_BOUNCE_RATE_MAX),
        "unsubscribe_ok": F.col("unsubscribe_rate") < dec(EMAIL_UNSUBSCRIBE_RATE_MAX),
        "spam_ok": F.col("spam_complaint_rate") < dec(EMAIL_SPAM_RATE_MAX)})
    return out.withColumn("bounce_alert", F.col("bounce_rate") > dec(EMAIL_BOUNCE_RATE_MAX))


def q_deal_velocity(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Deal velocity = weighted pipeline / days in pipeline, per open deal."""
    d = crm.deal_performance(t, as_of).filter(F.col("deal_status") == "Open")
    days = F.col("days_in_pipeline")
    return d.select("deal_id", "deal_name", "owner_id", "owner_name", "weighted_amount", "days_in_pipeline",
                    ratio("weighted_amount", days, None, (18, 2), default=None, guard=days > 0).alias("deal_velocity"))


def q_deal_benchmarks(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    o = crm.deal_owner_performance(t, as_of)
    return threshold_flags(o.select("owner_id", "owner_name", "win_rate", "avg_days_to_close_won"), {
        "win_rate_ok": F.col("win_rate") > dec(DEAL_WIN_RATE_MIN),
        "days_to_close_ok": F.col("avg_days_to_close_won") < F.lit(float(DEAL_DAYS_TO_CLOSE_MAX))})


def restrict_to(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Row-level security: keep rows whose ``key`` is in ``allowed`` (LEFT SEMI join; the
    allowed-key set is deduplicated by the join itself, no rows of ``df`` are duplicated)."""
    return df.join(allowed.select(key), key, "left_semi")


def q_rls_campaign_performance(t: Tables) -> DataFrame:
    """Campaign daily performance restricted to the accounts of one tenant (accounts whose
    latest record is in USD), the account-level row security the model recommends."""
    from ..operators.latest import latest_by_key
    accounts = latest_by_key(t["account_history"], "account_id").filter(F.col("currency_code") == "USD")
    return restrict_to(search_ads.campaign_performance(t), accounts, "account_id")


def q_campaign_summary_sliced(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Campaign summary under report slicers: two channel types, at least one day active, spend from 10 up."""
    from ..sources.catalog import slice_rows
    return slice_rows(search_ads.campaign_performance_summary(t, as_of),
                      {"advertising_channel_type": ["SEARCH", "DISPLAY"], "active_days": (1, None), "total_spend": (10, None)})


def q_cross_platform_daily(t: Tables) -> DataFrame:
    """Per day: search spend, social spend and new CRM contacts side by side.

    The three per-day aggregates are stacked (UNION ALL by name) and summed per date in one
    aggregation instead of two full outer joins."""
    def part(df: DataFrame, date: Column, **metrics: Column) -> DataFrame:
        cols = {"search_spend": F.lit(None).cast("decimal(28,2)"), "social_spend": F.lit(None).cast("decimal(28,2)"),
                "new_contacts": F.lit(None).cast("long")}
        cols.update(metrics)
        return df.select(date.alias("date"), *[c.alias(n) for n, c in cols.items()])

    s = part(search_ads.account_performance(t), F.col("date"), search_spend=F.col("spend").cast("decimal(28,2)"))
    f = part(social_ads.fb_account_performance(t), F.col("date"), social_spend=F.col("spend").cast("decimal(28,2)"))
    c = part(crm.live(t, "contact"), F.to_date("created_at"), new_contacts=F.lit(1).cast("long"))
    u = s.unionByName(f).unionByName(c)
    return u.groupBy("date").agg(F.sum("search_spend").alias("search_spend"),
                                 F.sum("social_spend").alias("social_spend"),
                                 F.sum("new_contacts").alias("new_contacts"))


def hour_of_day_profile(df: DataFrame, ts: str, metrics: dict[str, Column], by: tuple = ()) -> DataFrame:
    """Aggregate any timestamped fact by hour of day (and optional extra keys)."""
    return df.filter(F.col(ts).isNotNull()).groupBy(F.hour(ts).alias("hour_of_day"), *by) \
        .agg(*[c.alias(n) for n, c in metrics.items()])


def q_hour_of_day(t: Tables) -> DataFrame:
    """Hour-of-day profile of CRM engagements by type (the hourly-grained fact available)."""
    e = crm.live(t, "engagement")
    return hour_of_day_profile(e, "timestamp", {"engagement_count": F.count(F.lit(1)),
                                                "active_owners": F.count_distinct("owner_id")},
                               by=(F.col("type").alias("engagement_type"),))
