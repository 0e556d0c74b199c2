"""CRM email marts.

``email_event`` is the big fact (one row per event, ``event_id`` unique).  Distinct counts
over ``event_id`` are plain conditional counts; distinct counts over ``recipient`` (or over
campaigns per recipient) are done in two exact steps - dedupe to (group, type, recipient)
with per-row partial counts, then conditional sums/counts per group - instead of several
COUNT(DISTINCT) that Spark would Expand into one copy of the input per distinct column.
Both steps are partial/final hash aggregations; a campaign holding a third of all events is
spread across recipients in the first shuffle and pre-aggregated map-side in the second.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_key, ratio, rules
from ..functions.dates import as_date_lit, hours_between_boundary
from ..sources.catalog import Tables
from .crm import live

EVENT_TYPES = {"SENT": "sent_count", "DELIVERED": "delivered_count", "OPEN": "open_count", "CLICK": "click_count",
               "BOUNCE": "bounce_count", "UNSUBSCRIBED": "unsubscribe_count", "SPAMREPORT": "spam_report_count",
               "DROPPED": "dropped_count", "DEFERRED": "deferred_count", "FORWARD": "forward_count",
               "PRINT": "print_count"}
UNIQUE_TYPES = {"SENT": "unique_recipients", "OPEN": "unique_opens", "CLICK": "unique_clicks",
                "BOUNCE": "unique_bounces", "UNSUBSCRIBED": "unique_unsubscribes"}


def _by_recipient(ev: DataFrame, keys: list[str]) -> DataFrame:
    """Step 1: one row per (keys, type, recipient) with event counts by device and time range."""
    dev = F.col("device_type")
    return ev.groupBy(*keys, "type", "recipient").agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(dev == "MOBILE", 1)).alias("_n_mobile"),
        F.count(F.when(dev == "DESKTOP", 1)).alias("_n_desktop"), F.count(F.when(dev == "TABLET", 1)).alias("_n_tablet"),
        F.min("created_at").alias("_t_min"), F.max("created_at").alias("_t_max"))


def _n(typ: str, col: str = "_n"):
    return F.sum(F.when(F.col("type") == typ, F.col(col)))


def _uniq(typ: str):
    return F.count(F.when((F.col("type") == typ) & F.col("recipient").isNotNull(), 1))


def _campaigns(t: Tables) -> DataFrame:
    return live(t, "email_campaign")


def email_performance(t: Tables) -> DataFrame:
    ev = t["email_event"].filter(F.col("email_campaign_id").isNotNull())
    s1 = _by_recipient(ev, ["email_campaign_id"])
    ty = F.col("type")
    em = s1.groupBy("email_campaign_id").agg(
        *[_n(k).alias(v) for k, v in EVENT_TYPES.items()],
        *[_uniq(k).alias(v) for k, v in UNIQUE_TYPES.items()],
        F.min(F.when(ty == "SENT", F.col("_t_min"))).alias("first_sent_at"),
        F.max(F.when(ty == "SENT", F.col("_t_max"))).alias("last_sent_at"),
        F.min(F.when(ty == "OPEN", F.col("_t_min"))).alias("first_open_at"),
        F.max(F.when(ty == "OPEN", F.col("_t_max"))).alias("last_open_at"),
        _n("OPEN", "_n_mobile").alias("mobile_opens"), _n("OPEN", "_n_desktop").alias("desktop_opens"),
        _n("OPEN", "_n_tablet").alias("tablet_opens"))
    ec = _campaigns(t)
    f = ec.join(em, ec["campaign_id"] == em["email_campaign_id"], "left")
    z = F.lit(0).cast("long")
    co = lambda c: F.coalesce(F.col(c), z)
    sent, dlv, uo, opens = co("sent_count"), co("delivered_count"), co("unique_opens"), co("open_count")
    uc, clicks = co("unique_clicks"), co("click_count")

    def rate(num, den, scale=2):
        return ratio(num, den, "100.0", (10, scale))

    open_rate = F.when(dlv > 0, F.col("unique_opens") * F.lit(100) / F.col("delivered_count")).otherwise(F.lit(0))
    return f.select(
        "campaign_id", F.col("name").alias("campaign_name"), F.col("subject").alias("email_subject"),
        F.col("type").alias("campaign_type"), "app_name", "content_id",
        F.coalesce("num_included", F.lit(0)).alias("num_included"), F.coalesce("num_queued", F.lit(0)).alias("num_queued"),
        sent.alias("sent_count"), dlv.alias("delivered_count"), opens.alias("total_opens"), clicks.alias("total_clicks"),
        *[co(v).alias(v) for v in ["bounce_count", "unsubscribe_count", "spam_report_count", "dropped_count",
                                   "deferred_count", "forward_count", "print_count"]],
        *[co(v).alias(v) for v in UNIQUE_TYPES.values()],
        rate(dlv, sent).alias("delivery_rate"), rate(co("bounce_count"), sent).alias("bounce_rate"),
        rate(uo, dlv).alias("unique_open_rate"), rate(opens, dlv).alias("total_open_rate"),
        rate(uc, dlv).alias("unique_click_rate"), rate(clicks, dlv).alias("total_click_rate"),
        rate(uc, uo).alias("click_to_open_rate"), rate(co("unsubscribe_count"), dlv).alias("unsubscribe_rate"),
        rate(co("spam_report_count"), dlv, 4).alias("spam_complaint_rate"),
        ratio(opens, uo, "1.0", (10, 2)).alias("avg_opens_per_recipient"),
        ratio(clicks, uc, "1.0", (10, 2)).alias("avg_clicks_per_clicker"),
        co("mobile_opens").alias("mobile_opens"), co("desktop_opens").alias("desktop_opens"),
        co("tablet_opens").alias("tablet_opens"),
        rate(co("mobile_opens"), opens).alias("mobile_open_pct"), rate(co("desktop_opens"), opens).alias("desktop_open_pct"),
        "first_sent_at", "last_sent_at", "first_open_at", "last_open_at",
        date_key("first_sent_at").alias("first_sent_date_id"),
        hours_between_boundary("first_sent_at", "first_open_at").alias("hours_to_first_open"),
        rules([(open_rate >= 30, "Excellent"), (open_rate >= 20, "Good"), (open_rate >= 10, "Average")],
              "Needs Improvement").alias("performance_tier"),
        F.col("_fivetran_synced").alias("last_synced_at"))


def email_daily_metrics(t: Tables) -> DataFrame:
    """Per day x campaign.  The day key is derived from the grouped date."""
    ev = t["email_event"].filter(F.col("created_at").isNotNull()).withColumn("event_date", F.to_date("created_at"))
    s1 = _by_recipient(ev, ["event_date", "email_campaign_id"])
    g = s1.groupBy("event_date", "email_campaign_id").agg(
        *[_n(k).alias(EVENT_TYPES[k]) for k in ["SENT", "DELIVERED", "OPEN", "CLICK", "BOUNCE", "UNSUBSCRIBED"]],
        _uniq("OPEN").alias("unique_opens"), _uniq("CLICK").alias("unique_clicks"),
        _n("OPEN", "_n_mobile").alias("mobile_opens"), _n("OPEN", "_n_desktop").alias("desktop_opens"))
    ec = _campaigns(t).select(F.col("campaign_id").alias("_cid"), F.col("name").alias("campaign_name"))
    g = g.join(ec, g["email_campaign_id"] == ec["_cid"], "left").drop("_cid")
    z = F.lit(0).cast("long")
    cnt = ["sent_count", "delivered_count", "open_count", "click_count", "bounce_count", "unsubscribe_count",
           "unique_opens", "unique_clicks", "mobile_opens", "desktop_opens"]
    return g.select("event_date", date_key("event_date").alias("date_id"), "email_campaign_id", "campaign_name",
                    *[F.coalesce(c, z).alias(c) for c in cnt])


def email_bounce_analysis(t: Tables) -> DataFrame:
    ev = t["email_event"].filter(F.col("type") == "BOUNCE")
    b = t["email_event_bounce"].select(F.col("event_id").alias("_bid"), F.col("category").alias("_cat"),
                                       F.col("status").alias("_status"), F.col("response").alias("_resp"))
    ev = ev.join(b, ev["event_id"] == b["_bid"], "left")
    g = ev.groupBy("email_campaign_id",
                   F.coalesce("bounce_category", "_cat", F.lit("Unknown")).alias("bounce_category"),
                   F.coalesce("_status", F.lit("Unknown")).alias("bounce_status")).agg(
        F.count(F.lit(1)).alias("bounce_count"), F.count_distinct("recipient").alias("unique_bounced_recipients"),
        F.max("_resp").alias("sample_response"))
    ec = _campaigns(t).select(F.col("campaign_id").alias("_cid"), F.col("name").alias("campaign_name"))
    g = g.join(ec, g["email_campaign_id"] == ec["_cid"], "left")
    return g.select("email_campaign_id", "campaign_name", "bounce_category", "bounce_status", "bounce_count",
                    "unique_bounced_recipients", "sample_response")


def email_link_performance(t: Tables) -> DataFrame:
    ev = t["email_event"].filter(F.col("type") == "CLICK")
    c = t["email_event_click"].select(F.col("event_id").alias("_eid"), F.col("url").alias("_curl"))
    ev = ev.join(c, ev["event_id"] == c["_eid"], "left").filter(F.col("_curl").isNotNull() | F.col("url").isNotNull())
    dev = F.col("device_type")
    g = ev.groupBy("email_campaign_id", F.coalesce("_curl", "url").alias("click_url")).agg(
        F.count(F.lit(1)).alias("total_clicks"), F.count_distinct("recipient").alias("unique_clickers"),
        F.min("created_at").alias("first_click_at"), F.max("created_at").alias("last_click_at"),
        F.count(F.when(dev == "MOBILE", 1)).alias("mobile_clicks"),
        F.count(F.when(dev == "DESKTOP", 1)).alias("desktop_clicks"),
        F.max("location_country").alias("top_click_country"))
    ec = _campaigns(t).select(F.col("campaign_id").alias("_cid"), F.col("name").alias("campaign_name"))
    g = g.join(ec, g["email_campaign_id"] == ec["_cid"], "left")
    return g.select("email_campaign_id", "campaign_name", "click_url", "total_clicks", "unique_clickers",
                    "first_click_at", "last_click_at", "mobile_clicks", "desktop_clicks", "top_click_country")


def email_engagement_by_time(t: Tables) -> DataFrame:
    ev = t["email_event"].filter(F.col("type").isin("OPEN", "CLICK") & F.col("created_at").isNotNull())
    ts = F.col("created_at")
    slot = ["hour_of_day", "day_of_week", "day_of_week_num", "event_type"]
    ev = ev.select(F.hour(ts).alias("hour_of_day"), F.date_format(ts, "EEEE").alias("day_of_week"),
                   F.dayofweek(ts).alias("day_of_week_num"), F.col("type").alias("event_type"), "recipient", "email_campaign_id")
    # distinct counts in two steps over one row per (slot, recipient, campaign): no Expand over events
    s1 = ev.groupBy(*slot, "recipient", "email_campaign_id").agg(F.count(F.lit(1)).alias("_n"))
    people = s1.groupBy(*slot, "recipient").agg(F.sum("_n").alias("_n")).groupBy(*slot).agg(
        F.sum("_n").alias("event_count"), F.count("recipient").alias("unique_recipients"))
    camps = s1.groupBy(*slot, "email_campaign_id").agg(F.lit(1)).groupBy(*slot).agg(F.count("email_campaign_id").alias("campaign_count"))
    return people.join(camps, slot).select(*slot, "event_count", "unique_recipients", "campaign_count")


def email_recipient_engagement(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Per recipient, via (recipient, campaign) partial aggregates: campaign-distinct counts
    become counts of step-1 rows, event counts become sums."""
    ev = t["email_event"].filter(F.col("recipient").isNotNull())
    ty, dev, ts = F.col("type"), F.col("device_type"), F.col("created_at")
    s1 = ev.groupBy("recipient", "email_campaign_id").agg(
        F.count(F.when(ty == "SENT", 1)).alias("_sent"), F.count(F.when(ty == "OPEN", 1)).alias("_open"),
        F.count(F.when(ty == "CLICK", 1)).alias("_click"),
        F.count(F.when((ty == "OPEN") & (dev == "MOBILE"), 1)).alias("_om"),
        F.count(F.when((ty == "OPEN") & (dev == "DESKTOP"), 1)).alias("_od"),
        F.min(F.when(ty == "SENT", ts)).alias("_fs"), F.max(F.when(ty == "SENT", ts)).alias("_ls"),
        F.max(F.when(ty == "OPEN", ts)).alias("_lo"), F.max(F.when(ty == "CLICK", ts)).alias("_lc"))
    cid = F.col("email_campaign_id")
    g = s1.groupBy("recipient").agg(
        F.count(cid).alias("campaigns_received"), F.count(F.when(F.col("_sent") > 0, cid)).alias("campaigns_sent"),
        F.count(F.when(F.col("_open") > 0, cid)).alias("campaigns_opened"),
        F.count(F.when(F.col("_click") > 0, cid)).alias("campaigns_clicked"),
        F.sum("_sent").alias("total_emails_sent"), F.sum("_open").alias("total_opens"),
        F.sum("_click").alias("total_clicks"), F.min("_fs").alias("first_email_sent"),
        F.max("_ls").alias("last_email_sent"), F.max("_lo").alias("last_open"), F.max("_lc").alias("last_click"),
        F.sum("_om").alias("_om"), F.sum("_od").alias("_od"))
    d30 = F.date_sub(as_date_lit(as_of), 30).cast("timestamp_ntz")
    d90 = F.date_sub(as_date_lit(as_of), 90).cast("timestamp_ntz")
    om, od = F.col("_om"), F.col("_od")
    return g.select(
        F.col("recipient").alias("email_address"), "campaigns_received", "campaigns_sent", "campaigns_opened",
        "campaigns_clicked", "total_emails_sent", "total_opens", "total_clicks",
        ratio("campaigns_opened", "campaigns_sent", "100.0", (10, 2)).alias("campaign_open_rate"),
        ratio("campaigns_clicked", "campaigns_sent", "100.0", (10, 2)).alias("campaign_click_rate"),
        "first_email_sent", "last_email_sent", "last_open", "last_click",
        rules([(F.col("last_click") >= d30, "Highly Engaged"), (F.col("last_open") >= d30, "Engaged"),
               (F.col("last_open") >= d90, "Somewhat Engaged"), (F.col("total_opens") > 0, "Previously Engaged")],
              "Never Engaged").alias("engagement_status"),
        rules([(om > od, "Mobile"), (od > om, "Desktop")], "Mixed/Unknown").alias("preferred_device"))
