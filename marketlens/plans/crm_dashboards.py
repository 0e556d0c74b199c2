"""CRM dashboard queries (executive summary, pipeline health, risk, forecast, funnel, trends,
leaderboards, ABM insights, source attribution, cross-channel summary).

One-row aggregates are combined as scalar subqueries (each a single struct value), not as
cross joins.  Whole-result windows are used only where the input is
bounded by construction (lifecycle stages, <= 31 days); owner / source rankings use the
size-checked global rank operator.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import change_pct, dec, ratio, rules, share_pct
from ..functions.dates import as_date_lit
from ..operators.ranks import global_dense_ranks
from ..operators.shares import with_group_aggs
from ..sources.catalog import Tables
from . import crm, email, engagements
from .crm import since


def _one_row_join(*frames: DataFrame) -> DataFrame:
    """Side-by-side combination of one-row aggregates: the first stays a frame, the others are
    read as scalar subqueries (one struct each)."""
    out = frames[0]
    for f in frames[1:]:
        s = f.select(F.struct(*f.columns).alias("_s")).scalar()
        out = out.select("*", *[s.getField(c).alias(c) for c in f.columns])
    return out


def _recent_daily(t: Tables, as_of) -> DataFrame:
    return engagements.engagement_daily_summary(t).filter(F.col("engagement_date") >= F.date_sub(as_date_lit(as_of), 30))


_ENTITIES = {"contact": "contact_id", "company": "company_id", "deal": "deal_id"}


def _live_pairs(t: Tables, which: Sequence[str]) -> DataFrame:
    """(_w, _member) of the bridge pairs whose engagement and entity are both live: the bridges stacked with a tag, and met once with
    the live engagements and once with all live entities, stacked alike.  The bridge key is unique, so the pairs of an entity
    kind equal SUM over live entities of their engagement counts."""
    entities = None
    for w in which:
        e = crm.live(t, w).select(F.lit(w).alias("_w"), F.col(_ENTITIES[w]).cast("long").alias("_member"))
        entities = e if entities is None else entities.unionByName(e)
    pairs = engagements._tagged_bridges(t, which).join(crm.live(t, "engagement").select("engagement_id"), "engagement_id", "left_semi")
    return pairs.select("_w", "_member").join(entities, ["_w", "_member"], "left_semi")


def _deal_core(t: Tables) -> DataFrame:
    """The deal columns the executive and cross-channel summaries read (status, amount, weighted
    amount, closing days) - only the stage lookup is joined, not the name dimensions."""
    d = crm._with_stage(crm.live(t, "deal"), t, {"probability": "_stage_prob"})
    closed, won = F.col("is_closed"), F.col("is_closed_won")
    status = rules([(won == True, "Won"), ((closed == True) & (won == False), "Lost")], "Open")  # noqa: E712
    weighted = F.coalesce(F.col("hs_projected_amount"),
                          F.col("amount") * F.coalesce(F.col("_stage_prob"), F.col("hs_deal_stage_probability"),
                                                       F.lit(0)) / F.lit(100))
    return d.select("deal_id", "create_date", status.alias("deal_status"),
                    F.coalesce(closed, F.lit(False)).alias("is_closed"), F.coalesce(won, F.lit(False)).alias("is_closed_won"),
                    F.coalesce("amount", F.lit(0)).alias("amount"), weighted.alias("weighted_amount"),
                    F.when(closed == True, F.col("days_to_close")).alias("actual_days_to_close"))  # noqa: E712


def _recent_engagements(t: Tables, as_of) -> DataFrame:
    """Live engagements of the last 30 days (the rows behind the recent daily-summary rows)."""
    d = F.to_date("timestamp")
    return crm.live(t, "engagement").filter(F.col("timestamp").isNotNull() & (d >= F.date_sub(as_date_lit(as_of), 30))) \
        .select("engagement_id", "type", d.alias("engagement_date"))


def _scalar(df: DataFrame, agg) -> "F.Column":
    return df.agg(agg).scalar()


def q_crm_executive(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Contact, deal and recent-engagement KPIs in one row.  Computed from the base tables: the
    summed per-entity engagement counts are live bridge-pair counts and the per-day distinct
    members are distinct (day, member) pairs, so no full mart with its name joins is built."""
    c = crm.live(t, "contact")
    st = F.col("lifecycle_stage")
    pairs = _scalar(_live_pairs(t, ["contact"]), F.count(F.lit(1)))
    cm = c.agg(F.count(F.lit(1)).alias("total_contacts"),
               F.count(F.when(since("created_at", as_of, 30), 1)).alias("new_contacts_30d"),
               F.count(F.when(st == "customer", 1)).alias("total_customers"),
               F.count(F.when(st.isin("opportunity", "salesqualifiedlead"), 1)).alias("sales_qualified"),
               F.count(F.when(st == "marketingqualifiedlead", 1)).alias("marketing_qualified"),
               F.sum(F.coalesce("total_revenue", F.lit(0))).alias("total_contact_revenue"))
    cm = cm.withColumn("avg_engagements_per_contact",
                       F.when(F.col("total_contacts") > 0, pairs.cast("double") / F.col("total_contacts").cast("double")))
    dp = _deal_core(t)
    is_open, won = F.col("deal_status") == "Open", F.col("is_closed_won") == True  # noqa: E712
    closed = F.col("is_closed") == True  # noqa: E712
    dm = dp.agg(F.count(F.lit(1)).alias("total_deals"), F.count(F.when(is_open, 1)).alias("open_deals"),
                F.count(F.when(won, 1)).alias("won_deals"), F.count(F.when(closed & ~won, 1)).alias("lost_deals"),
                F.count(F.when(closed, 1)).alias("_closed"),
                F.sum(F.when(won, F.col("amount")).otherwise(F.lit(0))).alias("closed_won_revenue"),
                F.sum(F.when(is_open, F.col("amount")).otherwise(F.lit(0))).alias("pipeline_value"),
                F.sum(F.when(is_open, F.col("weighted_amount")).otherwise(F.lit(0))).alias("weighted_pipeline"),
                F.avg(F.when(won, F.col("actual_days_to_close"))).alias("avg_days_to_close"))
    re = _recent_engagements(t, as_of)
    ty = F.col("type")
    em = re.agg(F.sum(F.lit(1)).alias("total_engagements_30d"),
                F.sum(F.when(ty == "CALL", 1).otherwise(0)).alias("total_calls_30d"),
                F.sum(F.when(ty == "MEETING", 1).otherwise(0)).alias("total_meetings_30d"),
                F.sum(F.when(ty == "EMAIL", 1).otherwise(0)).alias("total_emails_30d"))
    names = {"contact": "contacts_engaged_30d", "company": "companies_engaged_30d", "deal": "deals_engaged_30d"}
    met = engagements._tagged_bridges(t, list(names)).join(re.select("engagement_id", "engagement_date"), "engagement_id")
    met = met.select("engagement_date", "_w", "_member").distinct()
    members = _scalar(met, F.struct(*[F.count(F.when(F.col("_w") == w, F.col("_member"))).alias(n) for w, n in names.items()]))
    em = em.select("*", *[F.when(F.col("total_engagements_30d").isNotNull(), members.getField(n)).cast("long").alias(n) for n in names.values()])
    j = _one_row_join(cm, dm, em)
    tc, od = F.col("total_contacts"), F.col("open_deals")
    return j.select(
        "total_contacts", "new_contacts_30d", "total_customers", "sales_qualified", "marketing_qualified",
        "total_contact_revenue", "avg_engagements_per_contact", "total_deals", "open_deals", "won_deals", "lost_deals",
        "closed_won_revenue", "pipeline_value", "weighted_pipeline", "avg_days_to_close",
        ratio("won_deals", "_closed", "100.0", (10, 2)).alias("win_rate"),
        F.col("total_engagements_30d").cast("long").alias("total_engagements_30d"),
        F.col("total_calls_30d").cast("long").alias("total_calls_30d"),
        F.col("total_meetings_30d").cast("long").alias("total_meetings_30d"),
        F.col("total_emails_30d").cast("long").alias("total_emails_30d"), "contacts_engaged_30d",
        "companies_engaged_30d", "deals_engaged_30d",
        ratio("total_customers", tc, "100.0", (10, 2)).alias("customer_conversion_rate"),
        ratio("total_contact_revenue", tc, None, (18, 2)).alias("revenue_per_contact"),
        ratio("pipeline_value", od, None, (18, 2)).alias("avg_deal_size"))


def q_pipeline_health(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    ps = crm.deal_pipeline_summary(t, as_of).filter(F.col("is_closed") == False)  # noqa: E712
    w = Window.partitionBy("pipeline_id").orderBy("display_order")  # default RANGE frame: peers included
    age = F.col("avg_age_days")
    open_ = F.col("is_closed") == False  # noqa: E712
    return ps.select(
        "pipeline_name", "stage_label", "display_order", F.col("probability").alias("stage_probability"),
        "deal_count", "total_value", "weighted_value", "avg_deal_size", "avg_age_days", "pct_of_pipeline_count",
        "pct_of_pipeline_value",
        rules([((age > 60) & open_, "Stagnant"), ((age > 30) & open_, "Slowing")], "Healthy").alias("stage_health"),
        F.sum("deal_count").over(w).alias("cumulative_deals"), F.sum("total_value").over(w).alias("cumulative_value"),
        "pipeline_id").orderBy("pipeline_id", "display_order").drop("pipeline_id")


def q_deals_at_risk(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    d = crm.deal_performance(t, as_of)
    hs, cs = F.col("deal_health_status"), F.col("close_date_status")
    d = d.filter((F.col("deal_status") == "Open")
                 & (hs.isin("Stale", "At Risk", "Needs Attention", "No Engagement") | (cs == "Overdue")))
    te = F.col("total_engagements")
    score = rules([(hs == "Stale", 100), (hs == "At Risk", 75), (hs == "Needs Attention", 50), (cs == "Overdue", 80),
                   (te == 0, 90)], 25)
    action = rules([(te == 0, "Schedule initial meeting"), (hs == "Stale", "Re-engage immediately"),
                    (hs == "At Risk", "Follow up this week"), (cs == "Overdue", "Update close date and re-qualify"),
                    (hs == "Needs Attention", "Schedule follow-up")], "Continue nurturing")
    return d.select("deal_id", "deal_name", "owner_name", "company_name", "pipeline_name", "stage_label", "amount",
                    "weighted_amount", "deal_age_days", "days_since_last_engagement", "close_date",
                    "close_date_status", "deal_health_status", "total_engagements", "total_meetings", "total_calls",
                    score.alias("risk_score"), action.alias("recommended_action")) \
        .orderBy(F.col("risk_score").desc(), F.col("amount").desc())


_PERIOD_ORDER = ["This Month", "Next Month", "This Quarter", "Next Quarter"]


def q_sales_forecast(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Forecast rows are unique per (owner, period), so the SQL's GROUP BY over every column is
    row-wise; commit / best case / pipeline-only split on the average probability."""
    f = crm.deal_forecast(t, as_of)
    p, pv = F.col("avg_probability"), F.col("pipeline_value")
    zero = F.lit(0)
    # five period values: totals as a grouped aggregate joined back, not a window with five tasks
    f = with_group_aggs(f, ["forecast_period"], {"_period_total": F.sum("pipeline_value")})
    fp = F.col("forecast_period")
    order = rules([(fp == v, i + 1) for i, v in enumerate(_PERIOD_ORDER)], 5)
    return f.select(
        "owner_name", "forecast_period", "deal_count", "pipeline_value", "weighted_pipeline", "avg_probability",
        "avg_deal_size", F.when(p >= 75, pv).otherwise(zero).alias("commit_value"),
        F.when((p >= 50) & (p < 75), pv).otherwise(zero).alias("best_case_value"),
        F.when(p < 50, pv).otherwise(zero).alias("pipeline_only_value"),
        share_pct("pipeline_value", F.col("_period_total")).alias("pct_of_period"), order.alias("_o")) \
        .orderBy("_o", F.col("weighted_pipeline").desc()).drop("_o")


def q_contact_funnel(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Stage-over-stage conversion along the lifecycle (at most a handful of stage rows).

    Several stages share order 7; LAG uses a deterministic tie-break (display name, raw stage)
    while the cumulative count keeps the SQL's peer semantics (RANGE frame on stage_order)."""
    f = crm.contact_lifecycle_funnel(t, as_of)
    lag_w = Window.orderBy(F.col("stage_order").desc(), "stage_display_name", "lifecycle_stage")
    cum_w = Window.orderBy(F.col("stage_order").desc())
    prev = F.lag("contact_count").over(lag_w)
    return f.select(
        "stage_display_name", "stage_order", "contact_count", "new_contacts_30d", "new_contacts_90d", "total_revenue",
        "avg_revenue", "pct_of_total", prev.alias("prev_stage_count"),
        ratio("contact_count", prev, "100.0", (10, 2), default=None, guard=prev > 0).alias("stage_conversion_rate"),
        F.sum("contact_count").over(cum_w).alias("cumulative_contacts")).orderBy("stage_order")


def q_engagement_trend(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Last 30 days of the daily summary with 7-row moving averages and week-over-week change
    (an ordered window over at most 31 rows)."""
    d = _recent_daily(t, as_of)
    w = Window.orderBy("engagement_date")
    ma = w.rowsBetween(-6, 0)
    one = dec("1.0")
    prev = F.lag("total_engagements", 7).over(w)
    return d.select(
        "engagement_date", "date_id", "day_of_week", "day_of_week_num", "total_engagements", "total_calls",
        "total_meetings", "total_emails", "total_notes", "total_tasks", "unique_contacts_engaged",
        "unique_companies_engaged", "unique_deals_engaged", "total_call_minutes", "avg_call_minutes",
        "meetings_completed", "meetings_scheduled", "meetings_canceled", "meetings_no_show", "tasks_completed",
        "tasks_pending",
        F.avg(F.col("total_engagements") * one).over(ma).alias("engagements_7d_ma"),
        F.avg(F.col("total_calls") * one).over(ma).alias("calls_7d_ma"),
        F.avg(F.col("total_meetings") * one).over(ma).alias("meetings_7d_ma"),
        prev.alias("engagements_1w_ago"), change_pct("total_engagements", prev).alias("engagement_wow_change_pct")
    ).orderBy("engagement_date")


def q_email_dashboard(t: Tables) -> DataFrame:
    e = email.email_performance(t).filter(F.col("sent_count") > 0)
    e = with_group_aggs(e, [], {"avg_open_rate_all": F.avg("unique_open_rate"),
                                "avg_click_rate_all": F.avg("unique_click_rate")})
    return e.select(
        "campaign_name", "email_subject", "campaign_type", "first_sent_at", "sent_count", "delivered_count",
        "unique_recipients", "unique_opens", "total_opens", "unique_clicks", "total_clicks", "bounce_count",
        "unsubscribe_count", "spam_report_count", "delivery_rate", "unique_open_rate", "unique_click_rate",
        "click_to_open_rate", "bounce_rate", "unsubscribe_rate", "performance_tier", "mobile_open_pct",
        "desktop_open_pct", "avg_open_rate_all", "avg_click_rate_all",
        (F.col("unique_open_rate") - F.col("avg_open_rate_all")).alias("open_rate_vs_avg"),
        (F.col("unique_click_rate") - F.col("avg_click_rate_all")).alias("click_rate_vs_avg")
    ).orderBy(F.col("first_sent_at").desc())


def q_owner_leaderboard(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    d = crm.deal_owner_performance(t, as_of)
    e = engagements.engagement_owner_summary(t, as_of).select(
        F.col("owner_id").alias("_e_owner"), "total_engagements", "engagements_30d", "total_calls", "total_meetings",
        "completed_meetings", "meeting_completion_rate", "unique_contacts_engaged", "unique_companies_engaged",
        "total_call_minutes")
    j = d.join(e, d["owner_id"] == e["_e_owner"], "left")
    z = F.lit(0)
    j = j.select(
        "owner_name", "owner_email", "total_deals", "won_deals", "lost_deals", "open_deals", "win_rate",
        "closed_won_revenue", "pipeline_value", "avg_won_deal_size", "avg_days_to_close_won", "new_deals_30d",
        "won_deals_30d", "won_revenue_30d",
        F.coalesce("total_engagements", z.cast("long")).alias("total_engagements"),
        F.coalesce("engagements_30d", z.cast("long")).alias("engagements_30d"),
        F.coalesce("total_calls", z.cast("long")).alias("total_calls"),
        F.coalesce("total_meetings", z.cast("long")).alias("total_meetings"),
        F.coalesce("completed_meetings", z.cast("long")).alias("completed_meetings"),
        F.coalesce("meeting_completion_rate", z).alias("meeting_completion_rate"),
        F.coalesce("unique_contacts_engaged", z.cast("long")).alias("contacts_engaged"),
        F.coalesce("unique_companies_engaged", z.cast("long")).alias("companies_engaged"),
        F.coalesce("total_call_minutes", z).alias("total_call_minutes"))
    j = global_dense_ranks(j, {"revenue_rank": [("closed_won_revenue", False)], "deals_won_rank": [("won_deals", False)],
                               "win_rate_rank": [("win_rate", False)], "engagement_rank": [("total_engagements", False)]})
    composite = (F.col("revenue_rank") * dec("0.4") + F.col("deals_won_rank") * dec("0.2")
                 + F.col("win_rate_rank") * dec("0.2") + F.col("engagement_rank") * dec("0.2"))
    return j.withColumn("composite_rank", composite.cast("decimal(10,2)")).orderBy(F.col("closed_won_revenue").desc())


def q_company_insights(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    c = crm.company_performance(t, as_of).filter((F.col("calculated_contact_count") > 0) | (F.col("total_deals") > 0))
    cs, pv, hs = F.col("customer_status"), F.col("pipeline_value"), F.col("account_health_status")
    tier = rules([((cs == "Customer") & (pv > 0), 1), ((pv > 0) & (F.col("engagements_last_30_days") > 0), 2),
                  (pv > 0, 3), (F.col("sales_qualified_contacts") > 0, 4)], 5)
    action = rules([((cs == "Customer") & (pv > 0), "Drive expansion deal"), (cs == "Customer", "Maintain relationship"),
                    (hs == "Highly Active", "Advance to close"), (hs.isin("Active", "Warm"), "Continue engagement"),
                    (pv > 0, "Re-engage stakeholders")], "Initial outreach needed")
    return c.select(
        "company_name", "domain", "industry", "company_type", "location", "owner_name", "lifecycle_stage",
        "calculated_contact_count", "customer_contacts", "sales_qualified_contacts", "total_deals", "won_deals",
        "open_deals", "closed_won_revenue", "pipeline_value", "deal_win_rate", "total_engagements",
        "engagements_last_30_days", "engagements_last_90_days", "account_health_status", "customer_status",
        "total_lifetime_value", tier.alias("priority_tier"), action.alias("recommended_action")
    ).orderBy(F.col("total_lifetime_value").desc(), F.col("pipeline_value").desc())


def q_source_attribution(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    s = crm.contact_source_performance(t, as_of).filter(F.col("total_contacts") >= 10)
    s = s.select(
        "acquisition_source", "source_detail_1", "source_detail_2", "total_contacts", "new_contacts_30d",
        "leads_subscribers", "marketing_qualified", "sales_qualified", "customers", "customer_conversion_rate",
        "sales_qualified_rate", "total_revenue", "avg_revenue_per_contact", "revenue_per_contact", "avg_page_views",
        "avg_visits", "avg_deals_per_contact",
        ratio("total_revenue", "total_contacts", None, (22, 6)).alias("revenue_efficiency"))
    s = global_dense_ranks(s, {"revenue_rank": [("total_revenue", False)],
                               "conversion_rank": [("customer_conversion_rate", False)],
                               "volume_rank": [("total_contacts", False)]})
    return s.orderBy(F.col("total_revenue").desc())


def q_cross_channel(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Five channel summaries from one aggregation: every record, live bridge pair and won amount is a row that
    adds to its channel, read from the base tables without any mart or name join."""
    zero = F.lit(0)

    def adds(df: DataFrame, channel: Column, records=zero, new=zero, activities=zero, revenue=zero) -> DataFrame:
        return df.select(channel.alias("channel"), records.cast("long").alias("total_records"), new.cast("long").alias("new_30d"),
                         activities.cast("long").alias("total_activities"), revenue.cast("decimal(28,2)").alias("total_revenue"))

    def recent(col: str) -> Column:
        return F.coalesce(since(col, as_of, 30), F.lit(False)).cast("int")

    one, company, deal = F.lit(1), crm.live(t, "company"), crm.live(t, "deal")
    is_won, amount = F.col("is_closed_won") == True, F.coalesce("amount", zero)  # noqa: E712
    of_live = deal.where(is_won & F.col("associated_company_id").isNotNull()).join(
        company.select(F.col("company_id").alias("associated_company_id")), "associated_company_id", "left_semi")
    tag = F.col("_w")
    sent = t["email_event"].filter((F.col("type") == "SENT") & F.col("email_campaign_id").isNotNull()) \
        .groupBy(F.col("email_campaign_id").alias("campaign_id")).agg(F.count(one).alias("_sent"), F.min("created_at").alias("_first"))
    campaigns = crm.live(t, "email_campaign").select("campaign_id").join(sent, "campaign_id", "left")
    rows = [
        adds(crm.live(t, "contact"), F.lit("Contacts"), one, recent("created_at"), revenue=F.coalesce("total_revenue", zero)),
        adds(company, F.lit("Companies"), one, recent("created_at"), revenue=F.coalesce("total_revenue", zero)),
        adds(of_live, F.lit("Companies"), revenue=amount),
        adds(deal, F.lit("Deals"), one, recent("create_date"), revenue=F.when(is_won, amount).otherwise(zero)),
        adds(_live_pairs(t, list(_ENTITIES)), F.when(tag == "contact", "Contacts").when(tag == "company", "Companies").otherwise("Deals"), activities=one),
        adds(campaigns, F.lit("Email Campaigns"), one, recent("_first"), F.coalesce("_sent", zero)),
        adds(_recent_engagements(t, as_of), F.lit("Engagements"), one, one, one),
        # a channel without rows counts none and sums to NULL; engagements are summed daily counts
        t.spark.sql("SELECT channel, n AS total_records, n AS new_30d, CAST(NULL AS BIGINT) AS total_activities, CAST(r AS DECIMAL(28,2)) AS total_revenue FROM VALUES "
                    "('Contacts', 0L, NULL), ('Companies', 0L, NULL), ('Deals', 0L, NULL), ('Email Campaigns', 0L, 0), ('Engagements', NULL, 0) AS v(channel, n, r)")]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.groupBy("channel").agg(F.sum("total_records").alias("total_records"), F.sum("new_30d").alias("new_30d"), F.sum("total_activities").alias("total_activities"),
                                      F.sum("total_revenue").cast("decimal(38,2)").alias("total_revenue"))
