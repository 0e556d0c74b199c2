"""CRM marts: contacts, companies and deals.

Entity tables are current-state (one row per id) with a strict soft-delete rule
(``_fivetran_deleted = 0``, NULL flags excluded).  Per-entity engagement counts go through
the association bridges; the bridge key (engagement, entity) is unique, so distinct
engagement counts are plain conditional counts (no Expand).  Every pre-aggregate is keyed by
the entity id and joined once (no fan-out).
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import concat_safe, date_key, ratio, rules, share_pct
from ..functions.dates import as_date_lit, days_between, months_between_boundary, weeks_between_boundary
from ..operators.shares import with_group_aggs
from ..sources.catalog import Tables

ENGAGEMENT_TYPES = ["CALL", "MEETING", "EMAIL", "NOTE", "TASK"]


def live(t: Tables, name: str) -> DataFrame:
    """Rows not soft-deleted (strict: a NULL flag is not 0 and is dropped)."""
    return t[name].filter(F.col("_fivetran_deleted") == F.lit(False))


def owners(t: Tables) -> DataFrame:
    o = live(t, "owner")
    return o.select("owner_id", concat_safe("first_name", F.lit(" "), "last_name").alias("owner_name"),
                    F.col("email").alias("owner_email"))


def with_owner(df: DataFrame, t: Tables, cols=("owner_name", "owner_email")) -> DataFrame:
    o = owners(t).select(F.col("owner_id").alias("_o_id"), *cols)
    out = df.join(o, df["owner_id"] == o["_o_id"], "left").drop("_o_id")
    if "owner_name" in cols:  # CONCAT of two NULLs is ' ' (owner missing)
        out = out.withColumn("owner_name", F.coalesce("owner_name", F.lit(" ")))
    return out


def since(col: str, as_of, days: int) -> Column:
    """``col >= as_of - days`` with as_of at midnight."""
    return F.col(col) >= F.date_sub(as_date_lit(as_of), days).cast("timestamp_ntz")


def engagement_rollup(t: Tables, bridge: str, key: str, as_of, recency: bool = True) -> DataFrame:
    """Per entity: engagements by type, first/last time and 30/90-day counts through a bridge."""
    e = live(t, "engagement").select("engagement_id", "type", "timestamp")
    b = t[bridge].select("engagement_id", key).join(e, "engagement_id")
    aggs = [F.count(F.lit(1)).alias("total_engagements")]
    names = {"CALL": "total_calls", "MEETING": "total_meetings", "EMAIL": "total_emails", "NOTE": "total_notes",
             "TASK": "total_tasks"}
    aggs += [F.count(F.when(F.col("type") == ty, 1)).alias(n) for ty, n in names.items()]
    aggs += [F.max("timestamp").alias("last_engagement_date"), F.min("timestamp").alias("first_engagement_date")]
    if recency:
        aggs += [F.count(F.when(since("timestamp", as_of, 30), 1)).alias("engagements_last_30_days"),
                 F.count(F.when(since("timestamp", as_of, 90), 1)).alias("engagements_last_90_days")]
    return b.groupBy(key).agg(*aggs)


_STAGE_LABELS = [("customer", "Customer"), ("opportunity", "Opportunity"), ("salesqualifiedlead", "SQL"),
                 ("marketingqualifiedlead", "MQL"), ("lead", "Lead"), ("subscriber", "Subscriber")]


def lifecycle_display(col: str, other) -> Column:
    c = F.col(col)
    return rules([(c == k, v) for k, v in _STAGE_LABELS], other)


def lifecycle_order(col: str) -> Column:
    c = F.col(col)
    return rules([(c == k, i + 1) for i, (k, _) in enumerate(_STAGE_LABELS)], 7)


def _per_month(total: Column, months: Column) -> Column:
    return F.when(months > 0, ratio(total, months, "1.0", (10, 2), guard=F.lit(True))) \
        .otherwise(total).cast("decimal(10,2)")


_ENG_COLS = ["total_engagements", "total_calls", "total_meetings", "total_emails", "total_notes", "total_tasks"]


# --------------------------------------------------------------------------- contacts
def contact_performance(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    a = as_date_lit(as_of)
    c = live(t, "contact")
    ce = engagement_rollup(t, "engagement_contact", "contact_id", as_of)
    comp = live(t, "company").select(F.col("company_id").alias("_cid"), F.col("name").alias("associated_company_name"),
                                     F.col("industry").alias("associated_company_industry"),
                                     F.col("domain").alias("associated_company_domain"))
    f = with_owner(c, t).join(comp, c["associated_company_id"] == comp["_cid"], "left").drop("_cid") \
        .join(ce, "contact_id", "left")
    total = F.coalesce(F.col("total_engagements"), F.lit(0).cast("long"))
    visits = F.coalesce(F.col("hs_analytics_num_visits"), F.lit(0))
    e30, e90, etot = F.col("engagements_last_30_days"), F.col("engagements_last_90_days"), F.col("total_engagements")
    rev = F.coalesce(F.col("total_revenue"), F.lit(0))
    return f.select(
        "contact_id", "email", concat_safe("first_name", F.lit(" "), "last_name").alias("full_name"), "first_name",
        "last_name", "phone", F.col("company").alias("contact_company"), "job_title", "lifecycle_stage",
        "lead_status", "owner_id", "owner_name", "owner_email", "associated_company_id", "associated_company_name",
        "associated_company_industry", "associated_company_domain", "created_at", "updated_at",
        "last_activity_date", "last_contacted", date_key("created_at").alias("created_date_id"),
        days_between("created_at", a).alias("contact_age_days"),
        days_between("last_activity_date", a).alias("days_since_last_activity"),
        days_between("last_contacted", a).alias("days_since_last_contacted"),
        F.coalesce("num_associated_deals", F.lit(0)).alias("num_associated_deals"), rev.alias("total_revenue"),
        "hs_analytics_source", "hs_analytics_source_data_1", "hs_analytics_source_data_2", "hs_analytics_first_url",
        F.coalesce("hs_analytics_num_page_views", F.lit(0)).alias("total_page_views"), visits.alias("total_visits"),
        F.coalesce("hs_analytics_num_event_completions", F.lit(0)).alias("total_event_completions"),
        ratio("hs_analytics_num_page_views", "hs_analytics_num_visits", "1.0", (10, 2), guard=visits > 0)
        .alias("avg_pages_per_visit"),
        F.coalesce("hs_email_optout", F.lit(False)).alias("is_email_opted_out"),
        F.coalesce("hs_email_bounce", F.lit(False)).alias("has_email_bounced"),
        F.coalesce("hs_email_quarantined", F.lit(False)).alias("is_email_quarantined"),
        *[F.coalesce(c_, F.lit(0).cast("long")).alias(c_) for c_ in _ENG_COLS],
        "last_engagement_date", "first_engagement_date",
        F.coalesce(e30, F.lit(0).cast("long")).alias("engagements_last_30_days"),
        F.coalesce(e90, F.lit(0).cast("long")).alias("engagements_last_90_days"),
        _per_month(total, months_between_boundary("created_at", a)).alias("engagements_per_month"),
        lifecycle_display("lifecycle_stage", F.coalesce(F.col("lifecycle_stage"), F.lit("Unknown")))
        .alias("lifecycle_stage_display"),
        rules([(e30 > 0, "Active"), (e90 > 0, "Warm"), (etot > 0, "Cold")], "No Engagements").alias("engagement_status"),
        ratio(rev, "total_engagements", None, (18, 2), guard=total > 0).alias("revenue_per_engagement"),
        F.col("_fivetran_synced").alias("last_synced_at"))


def contact_lifecycle_funnel(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    c = live(t, "contact")
    g = c.groupBy("lifecycle_stage").agg(
        F.count(F.lit(1)).alias("contact_count"),
        F.count(F.when(since("created_at", as_of, 30), 1)).alias("new_contacts_30d"),
        F.count(F.when(since("created_at", as_of, 90), 1)).alias("new_contacts_90d"),
        F.sum(F.coalesce("total_revenue", F.lit(0))).alias("total_revenue"),
        F.avg(F.coalesce("total_revenue", F.lit(0))).alias("avg_revenue"),
        F.avg(F.coalesce("hs_analytics_num_page_views", F.lit(0))).alias("avg_page_views"),
        F.avg(F.coalesce("hs_analytics_num_visits", F.lit(0))).alias("avg_visits"))
    g = with_group_aggs(g, [], {"_all": F.sum("contact_count")})
    return g.select(
        F.coalesce("lifecycle_stage", F.lit("Unknown")).alias("lifecycle_stage"),
        lifecycle_order("lifecycle_stage").alias("stage_order"),
        lifecycle_display("lifecycle_stage", "Other").alias("stage_display_name"),
        "contact_count", "new_contacts_30d", "new_contacts_90d", "total_revenue", "avg_revenue", "avg_page_views",
        "avg_visits", share_pct("contact_count", "_all").alias("pct_of_total"))


def contact_source_performance(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    c = live(t, "contact")
    st = F.col("lifecycle_stage")
    n = F.count(F.lit(1))
    rev = F.coalesce("total_revenue", F.lit(0))
    g = c.groupBy("hs_analytics_source", "hs_analytics_source_data_1", "hs_analytics_source_data_2").agg(
        n.alias("total_contacts"), F.count(F.when(since("created_at", as_of, 30), 1)).alias("new_contacts_30d"),
        F.count(F.when(st == "customer", 1)).alias("customers"),
        F.count(F.when(st.isin("opportunity", "salesqualifiedlead"), 1)).alias("sales_qualified"),
        F.count(F.when(st == "marketingqualifiedlead", 1)).alias("marketing_qualified"),
        F.count(F.when(st.isin("lead", "subscriber"), 1)).alias("leads_subscribers"),
        F.count(F.when(st.isin("customer", "opportunity", "salesqualifiedlead"), 1)).alias("_sq_all"),
        F.sum(rev).alias("total_revenue"), F.avg(rev).alias("avg_revenue_per_contact"),
        F.avg(F.coalesce("hs_analytics_num_page_views", F.lit(0))).alias("avg_page_views"),
        F.avg(F.coalesce("hs_analytics_num_visits", F.lit(0))).alias("avg_visits"),
        F.sum(F.coalesce("num_associated_deals", F.lit(0))).alias("total_deals"),
        F.avg(F.coalesce("num_associated_deals", F.lit(0))).alias("avg_deals_per_contact"))
    tc = F.col("total_contacts")
    return g.select(
        F.coalesce("hs_analytics_source", F.lit("Unknown")).alias("acquisition_source"),
        F.col("hs_analytics_source_data_1").alias("source_detail_1"),
        F.col("hs_analytics_source_data_2").alias("source_detail_2"),
        "total_contacts", "new_contacts_30d", "customers", "sales_qualified", "marketing_qualified",
        "leads_subscribers",
        ratio("customers", tc, "100.0", (10, 2)).alias("customer_conversion_rate"),
        ratio("_sq_all", tc, "100.0", (10, 2)).alias("sales_qualified_rate"),
        "total_revenue", "avg_revenue_per_contact",
        ratio("total_revenue", tc, None, (22, 6)).alias("revenue_per_contact"),
        "avg_page_views", "avg_visits", "total_deals", "avg_deals_per_contact")


def contact_owner_performance(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    a = as_date_lit(as_of)
    c = live(t, "contact").filter(F.col("owner_id").isNotNull())
    st = F.col("lifecycle_stage")
    g = c.groupBy("owner_id").agg(
        F.count(F.lit(1)).alias("total_contacts"),
        F.count(F.when(since("created_at", as_of, 30), 1)).alias("new_contacts_30d"),
        F.count(F.when(st == "customer", 1)).alias("customers"),
        F.count(F.when(st == "opportunity", 1)).alias("opportunities"),
        F.count(F.when(st == "salesqualifiedlead", 1)).alias("sqls"),
        F.count(F.when(st == "marketingqualifiedlead", 1)).alias("mqls"),
        F.sum(F.coalesce("total_revenue", F.lit(0))).alias("total_revenue"),
        F.avg(F.coalesce("total_revenue", F.lit(0))).alias("avg_revenue_per_contact"),
        F.sum(F.coalesce("num_associated_deals", F.lit(0))).alias("total_deals"),
        F.avg(F.coalesce("num_associated_deals", F.lit(0))).alias("avg_deals_per_contact"),
        F.count(F.when(F.col("last_activity_date") >= F.date_sub(a, 30), 1)).alias("active_contacts_30d"),
        F.avg(days_between("last_contacted", a)).alias("avg_days_since_last_contact"))
    g = with_owner(g, t)
    return g.select("owner_id", "owner_name", "owner_email", "total_contacts", "new_contacts_30d", "customers",
                    "opportunities", "sqls", "mqls",
                    ratio("customers", "total_contacts", "100.0", (10, 2)).alias("customer_conversion_rate"),
                    "total_revenue", "avg_revenue_per_contact", "total_deals", "avg_deals_per_contact",
                    "active_contacts_30d", "avg_days_since_last_contact")


# --------------------------------------------------------------------------- companies
def company_performance(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    a = as_date_lit(as_of)
    c = live(t, "company")
    ce = engagement_rollup(t, "engagement_company", "company_id", as_of)
    ct = live(t, "contact").filter(F.col("associated_company_id").isNotNull())
    st = F.col("lifecycle_stage")
    cc = ct.groupBy(F.col("associated_company_id").alias("company_id")).agg(
        F.count(F.lit(1)).alias("contact_count"), F.count(F.when(st == "customer", 1)).alias("customer_contacts"),
        F.count(F.when(st.isin("opportunity", "salesqualifiedlead"), 1)).alias("sales_qualified_contacts"),
        F.count(F.when(st == "marketingqualifiedlead", 1)).alias("mql_contacts"),
        F.sum(F.coalesce("total_revenue", F.lit(0))).alias("contact_total_revenue"))
    dl = live(t, "deal").filter(F.col("associated_company_id").isNotNull())
    won, closed = F.col("is_closed_won") == True, F.col("is_closed")  # noqa: E712
    amt = F.coalesce("amount", F.lit(0))
    cd = dl.groupBy(F.col("associated_company_id").alias("company_id")).agg(
        F.count(F.lit(1)).alias("total_deals"), F.count(F.when(won, 1)).alias("won_deals"),
        F.count(F.when((closed == True) & (F.col("is_closed_won") == False), 1)).alias("lost_deals"),  # noqa: E712
        F.count(F.when(closed == False, 1)).alias("open_deals"),  # noqa: E712
        F.sum(F.when(won, amt).otherwise(F.lit(0))).alias("closed_won_revenue"),
        F.sum(F.when(closed == False, amt).otherwise(F.lit(0))).alias("pipeline_value"),  # noqa: E712
        F.avg(F.when(won, F.col("amount"))).alias("avg_won_deal_size"),
        F.avg(F.when(won, F.col("days_to_close"))).alias("avg_days_to_close"))
    f = with_owner(c, t).join(ce, "company_id", "left").join(cc, "company_id", "left").join(cd, "company_id", "left")
    z = F.lit(0).cast("long")
    co = lambda n: F.coalesce(F.col(n), z)
    city, state, country = F.col("city"), F.col("state"), F.col("country")
    location = F.concat(
        F.coalesce(city, F.lit("")), F.when(city.isNotNull() & state.isNotNull(), F.lit(", ")).otherwise(F.lit("")),
        F.coalesce(state, F.lit("")),
        F.when((city.isNotNull() | state.isNotNull()) & country.isNotNull(), F.lit(", ")).otherwise(F.lit("")),
        F.coalesce(country, F.lit("")))
    rev = F.coalesce("total_revenue", F.lit(0))
    cwr = F.coalesce("closed_won_revenue", F.lit(0))
    e30, e90 = co("engagements_last_30_days"), co("engagements_last_90_days")
    return f.select(
        "company_id", F.col("name").alias("company_name"), "domain", "industry", F.col("type").alias("company_type"),
        "phone", "city", "state", "country", "postal_code", location.alias("location"), "owner_id", "owner_name",
        "owner_email", "lifecycle_stage", "lead_status", "num_employees", "annual_revenue", rev.alias("total_revenue"),
        "created_at", "updated_at", "last_activity_date", "last_contacted",
        date_key("created_at").alias("created_date_id"), days_between("created_at", a).alias("company_age_days"),
        days_between("last_activity_date", a).alias("days_since_last_activity"), "hs_analytics_source",
        F.coalesce("hs_analytics_num_page_views", F.lit(0)).alias("total_page_views"),
        F.coalesce("hs_analytics_num_visits", F.lit(0)).alias("total_visits"),
        F.coalesce("num_associated_contacts", F.lit(0)).alias("num_associated_contacts"),
        F.coalesce("num_associated_deals", F.lit(0)).alias("num_associated_deals"),
        co("contact_count").alias("calculated_contact_count"), co("customer_contacts").alias("customer_contacts"),
        co("sales_qualified_contacts").alias("sales_qualified_contacts"), co("mql_contacts").alias("mql_contacts"),
        F.coalesce("contact_total_revenue", F.lit(0)).alias("contact_attributed_revenue"),
        co("total_deals").alias("total_deals"), co("won_deals").alias("won_deals"), co("lost_deals").alias("lost_deals"),
        co("open_deals").alias("open_deals"), cwr.alias("closed_won_revenue"),
        F.coalesce("pipeline_value", F.lit(0)).alias("pipeline_value"), "avg_won_deal_size", "avg_days_to_close",
        ratio(co("won_deals"), "total_deals", "100.0", (10, 2), guard=co("total_deals") > 0).alias("deal_win_rate"),
        *[co(c_).alias(c_) for c_ in _ENG_COLS], "last_engagement_date", "first_engagement_date",
        e30.alias("engagements_last_30_days"), e90.alias("engagements_last_90_days"),
        _per_month(co("total_engagements"), months_between_boundary("created_at", a)).alias("engagements_per_month"),
        rules([((e30 > 0) & (co("open_deals") > 0), "Highly Active"), (e30 > 0, "Active"), (e90 > 0, "Warm"),
               (co("total_engagements") > 0, "Cold")], "No Engagement").alias("account_health_status"),
        rules([(F.col("lifecycle_stage") == "customer", "Customer"), (co("won_deals") > 0, "Customer (by deals)")],
              "Prospect").alias("customer_status"),
        (rev + cwr).alias("total_lifetime_value"), F.col("_fivetran_synced").alias("last_synced_at"))


def _company_counts(as_of) -> list:
    st = F.col("lifecycle_stage")
    return [F.count(F.lit(1)).alias("total_companies"),
            F.count(F.when(since("created_at", as_of, 30), 1)).alias("new_companies_30d"),
            F.count(F.when(since("created_at", as_of, 90), 1)).alias("new_companies_90d"),
            F.count(F.when(st == "customer", 1)).alias("customers"),
            F.count(F.when(st.isin("opportunity", "salesqualifiedlead"), 1)).alias("sales_qualified"),
            F.count(F.when(st == "marketingqualifiedlead", 1)).alias("marketing_qualified")]


def company_industry_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    c = live(t, "company")
    co = lambda n: F.coalesce(F.col(n), F.lit(0))
    g = c.groupBy("industry").agg(
        *_company_counts(as_of), F.sum(co("total_revenue")).alias("total_revenue"),
        F.avg(co("total_revenue")).alias("avg_revenue_per_company"),
        F.sum(co("annual_revenue")).alias("total_annual_revenue"), F.avg(co("annual_revenue")).alias("avg_annual_revenue"),
        F.sum(co("num_associated_contacts")).alias("total_contacts"),
        F.avg(co("num_associated_contacts")).alias("avg_contacts_per_company"),
        F.sum(co("num_associated_deals")).alias("total_deals"), F.avg(co("num_associated_deals")).alias("avg_deals_per_company"),
        F.avg(co("hs_analytics_num_page_views")).alias("avg_page_views"),
        F.avg(co("hs_analytics_num_visits")).alias("avg_visits"))
    return g.select(
        F.coalesce("industry", F.lit("Unknown")).alias("industry"), "total_companies", "new_companies_30d",
        "new_companies_90d", "customers", "sales_qualified", "marketing_qualified",
        ratio("customers", "total_companies", "100.0", (10, 2)).alias("customer_conversion_rate"),
        "total_revenue", "avg_revenue_per_company", "total_annual_revenue", "avg_annual_revenue", "total_contacts",
        "avg_contacts_per_company", "total_deals", "avg_deals_per_company", "avg_page_views", "avg_visits")


def company_geography_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    c = live(t, "company")
    st = F.col("lifecycle_stage")
    co = lambda n: F.coalesce(F.col(n), F.lit(0))
    g = c.groupBy("country", "state", "city").agg(
        F.count(F.lit(1)).alias("total_companies"), F.count(F.when(st == "customer", 1)).alias("customers"),
        F.count(F.when(st.isin("opportunity", "salesqualifiedlead"), 1)).alias("sales_qualified"),
        F.sum(co("total_revenue")).alias("total_revenue"), F.avg(co("total_revenue")).alias("avg_revenue_per_company"),
        F.sum(co("num_associated_deals")).alias("total_deals"))
    g = with_group_aggs(g, [], {"_all": F.sum("total_companies")})
    return g.select(*[F.coalesce(x, F.lit("Unknown")).alias(x) for x in ["country", "state", "city"]],
                    "total_companies", "customers", "sales_qualified", "total_revenue", "avg_revenue_per_company",
                    "total_deals", share_pct("total_companies", "_all").alias("pct_of_total"))


def company_owner_performance(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    a = as_date_lit(as_of)
    c = live(t, "company").filter(F.col("owner_id").isNotNull())
    co = lambda n: F.coalesce(F.col(n), F.lit(0))
    cnt = _company_counts(as_of)
    g = c.groupBy("owner_id").agg(
        cnt[0], cnt[1], *cnt[3:], F.sum(co("total_revenue")).alias("total_revenue"),
        F.avg(co("total_revenue")).alias("avg_revenue_per_company"),
        F.sum(co("num_associated_contacts")).alias("total_contacts"),
        F.sum(co("num_associated_deals")).alias("total_deals"),
        F.count(F.when(F.col("last_activity_date") >= F.date_sub(a, 30), 1)).alias("active_companies_30d"),
        F.avg(days_between("last_contacted", a)).alias("avg_days_since_last_contact"))
    g = with_owner(g, t)
    return g.select("owner_id", "owner_name", "owner_email", "total_companies", "new_companies_30d", "customers",
                    "sales_qualified", "marketing_qualified",
                    ratio("customers", "total_companies", "100.0", (10, 2)).alias("customer_conversion_rate"),
                    "total_revenue", "avg_revenue_per_company", "total_contacts", "total_deals",
                    "active_companies_30d", "avg_days_since_last_contact")


# --------------------------------------------------------------------------- deals
def _stages(t: Tables, live_only: bool = True) -> DataFrame:
    return (live(t, "deal_stage") if live_only else t["deal_stage"])


def _with_stage(d: DataFrame, t: Tables, cols: dict) -> DataFrame:
    """LEFT JOIN deal_stage on (pipeline_stage_id, pipeline_id) with the delete rule in the ON clause."""
    ds = _stages(t).select(F.col("stage_id").alias("_s_id"), F.col("pipeline_id").alias("_p_id"),
                           *[F.col(k).alias(v) for k, v in cols.items()])
    cond = (d["pipeline_stage_id"] == ds["_s_id"]) & (d["pipeline_id"] == ds["_p_id"])
    return d.join(ds, cond, "left").drop("_s_id", "_p_id")


def _with_pipeline(d: DataFrame, t: Tables, col: str = "pipeline_name") -> DataFrame:
    dp = live(t, "deal_pipeline").select(F.col("pipeline_id").alias("_pp_id"), F.col("label").alias(col))
    return d.join(dp, d["pipeline_id"] == dp["_pp_id"], "left").drop("_pp_id")


def deal_performance(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    a = as_date_lit(as_of)
    d = live(t, "deal")
    de = engagement_rollup(t, "engagement_deal", "deal_id", as_of, recency=False)
    d = _with_pipeline(d, t)
    d = _with_stage(d, t, {"label": "stage_label", "display_order": "stage_order", "probability": "_stage_prob"})
    d = with_owner(d, t)
    comp = live(t, "company").select(F.col("company_id").alias("_cid"), F.col("name").alias("company_name"),
                                     F.col("industry").alias("company_industry"))
    con = live(t, "contact").select(F.col("contact_id").alias("_ctid"),
                                    concat_safe("first_name", F.lit(" "), "last_name").alias("contact_name"),
                                    F.col("email").alias("contact_email"))
    d = d.join(comp, d["associated_company_id"] == comp["_cid"], "left").drop("_cid")
    d = d.join(con, d["associated_contact_id"] == con["_ctid"], "left").drop("_ctid") \
        .withColumn("contact_name", F.coalesce("contact_name", F.lit(" ")))
    d = d.join(de, "deal_id", "left")
    closed, won = F.col("is_closed"), F.col("is_closed_won")
    prob = F.coalesce(F.col("_stage_prob"), F.col("hs_deal_stage_probability"))
    weighted = F.coalesce(F.col("hs_projected_amount"),
                          F.col("amount") * F.coalesce(F.col("_stage_prob"), F.col("hs_deal_stage_probability"),
                                                       F.lit(0)) / F.lit(100))
    last_eng = F.col("last_engagement_date")
    since_eng = days_between(last_eng, a)
    total = F.coalesce(F.col("total_engagements"), F.lit(0).cast("long"))
    weeks = weeks_between_boundary("create_date", a)
    close = F.col("close_date")
    return d.select(
        "deal_id", "deal_name", "deal_type", "pipeline_id", "pipeline_name", "pipeline_stage_id", "deal_stage",
        "stage_label", "stage_order", prob.alias("stage_probability"),
        F.coalesce(closed, F.lit(False)).alias("is_closed"), F.coalesce(won, F.lit(False)).alias("is_closed_won"),
        rules([(won == True, "Won"), ((closed == True) & (won == False), "Lost")], "Open").alias("deal_status"),  # noqa: E712
        F.coalesce("amount", F.lit(0)).alias("amount"), "deal_currency_code", weighted.alias("weighted_amount"),
        F.coalesce("hs_acv", F.lit(0)).alias("acv"), F.coalesce("hs_arr", F.lit(0)).alias("arr"),
        F.coalesce("hs_mrr", F.lit(0)).alias("mrr"), F.coalesce("hs_tcv", F.lit(0)).alias("tcv"),
        "create_date", "close_date", date_key("create_date").alias("create_date_id"),
        date_key("close_date").alias("close_date_id"),
        F.coalesce(F.col("days_to_close"), days_between("create_date", F.coalesce(close, a))).alias("days_in_pipeline"),
        F.when(closed == True, F.col("days_to_close")).alias("actual_days_to_close"),  # noqa: E712
        days_between("create_date", a).alias("deal_age_days"),
        F.when((closed == False) & close.isNotNull(), days_between(a, close)).alias("days_until_close"),  # noqa: E712
        rules([(closed == True, "Closed"), (close.isNull(), "No Close Date"), (close < a, "Overdue"),  # noqa: E712
               (close <= F.date_add(a, 7), "Closing This Week"), (close <= F.date_add(a, 30), "Closing This Month"),
               (close <= F.date_add(a, 90), "Closing This Quarter")], "Future").alias("close_date_status"),
        "owner_id", "owner_name", "owner_email", "associated_company_id", "company_name", "company_industry",
        "associated_contact_id", "contact_name", "contact_email", "hs_analytics_source",
        *[F.coalesce(c_, F.lit(0).cast("long")).alias(c_) for c_ in _ENG_COLS],
        "last_engagement_date", "first_engagement_date", since_eng.alias("days_since_last_engagement"),
        _per_month(total, weeks).alias("engagements_per_week"),
        F.coalesce("num_contacted_notes", F.lit(0)).alias("num_contacted_notes"),
        F.coalesce("num_notes", F.lit(0)).alias("num_notes"),
        rules([(closed == True, "Closed"), (last_eng.isNull(), "No Engagement"), (since_eng <= 7, "Healthy"),  # noqa: E712
               (since_eng <= 14, "Needs Attention"), (since_eng <= 30, "At Risk")], "Stale").alias("deal_health_status"),
        F.col("_fivetran_synced").alias("last_synced_at"))


def deal_pipeline_summary(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    from pyspark.sql import Window
    a = as_date_lit(as_of)
    d = _with_stage(_with_pipeline(live(t, "deal"), t), t, {
        "label": "stage_label", "display_order": "display_order", "probability": "probability",
        "is_closed": "_st_closed", "is_closed_won": "_st_won"})
    keys = ["pipeline_id", "pipeline_stage_id", "pipeline_name", "stage_label", "display_order", "probability",
            "_st_closed", "_st_won"]
    amt = F.coalesce("amount", F.lit(0))
    g = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("deal_count"), F.sum(amt).alias("total_value"), F.avg(amt).alias("avg_deal_size"),
        F.sum(amt * F.coalesce("probability", F.lit(0)) / F.lit(100)).alias("weighted_value"),
        F.avg(days_between("create_date", a)).alias("avg_age_days"))
    pw = Window.partitionBy("pipeline_id")
    return g.select(
        "pipeline_id", "pipeline_name", "pipeline_stage_id", "stage_label", "display_order", "probability",
        F.coalesce("_st_closed", F.lit(False)).alias("is_closed"), F.coalesce("_st_won", F.lit(False)).alias("is_closed_won"),
        "deal_count", "total_value", "avg_deal_size", "weighted_value", "avg_age_days",
        share_pct("deal_count", F.sum("deal_count").over(pw)).alias("pct_of_pipeline_count"),
        share_pct("total_value", F.sum("total_value").over(pw)).alias("pct_of_pipeline_value"))


def deal_stage_conversion(t: Tables) -> DataFrame:
    """Stage transitions from the stage history: the previous stage per deal comes from a LAG
    over (deal, timestamp); transitions are aggregated per (pipeline, from, to) before the
    stage labels are attached."""
    from pyspark.sql import Window
    from ..functions.dates import hours_between_boundary
    h = t["deal_stage_history"].select("deal_id", "stage_id", "pipeline_id", "timestamp")
    w = Window.partitionBy("deal_id").orderBy("timestamp", "stage_id")
    h = h.select("*", F.lag("stage_id").over(w).alias("prev_stage_id"), F.lag("timestamp").over(w).alias("prev_ts"))
    hrs = hours_between_boundary("prev_ts", "timestamp")
    dys = days_between("prev_ts", "timestamp")
    st = h.filter(F.col("prev_stage_id").isNotNull()).groupBy(
        "pipeline_id", F.col("prev_stage_id").alias("from_stage_id"), F.col("stage_id").alias("to_stage_id")).agg(
        F.count(F.lit(1)).alias("transition_count"), F.avg(hrs).alias("avg_hours_in_stage"),
        F.avg(dys).alias("avg_days_in_stage"), F.min(dys).alias("min_days_in_stage"),
        F.max(dys).alias("max_days_in_stage"))
    st = _with_pipeline(st, t)
    stages = t["deal_stage"]  # no delete filter on the stage lookups here, as in the SQL

    def side(prefix):
        return stages.select(F.col("stage_id").alias(f"_{prefix}_s"), F.col("pipeline_id").alias(f"_{prefix}_p"),
                             F.col("label").alias(f"{prefix}_stage_label"),
                             F.col("display_order").alias(f"{prefix}_stage_order"),
                             F.col("is_closed").alias(f"_{prefix}_closed"), F.col("is_closed_won").alias(f"_{prefix}_won"))

    fr, to = side("from"), side("to")
    st = st.join(fr, (st["from_stage_id"] == fr["_from_s"]) & (st["pipeline_id"] == fr["_from_p"]), "left")
    st = st.join(to, (st["to_stage_id"] == to["_to_s"]) & (st["pipeline_id"] == to["_to_p"]), "left")
    fo, tord = F.col("from_stage_order"), F.col("to_stage_order")
    return st.select(
        "pipeline_id", "pipeline_name", "from_stage_id", "from_stage_label", "from_stage_order", "to_stage_id",
        "to_stage_label", "to_stage_order", "transition_count", "avg_hours_in_stage", "avg_days_in_stage",
        "min_days_in_stage", "max_days_in_stage",
        rules([(F.col("_to_won") == True, "Won"), (F.col("_to_closed") == True, "Lost"),  # noqa: E712
               (tord > fo, "Forward"), (tord < fo, "Backward")], "Same Level").alias("transition_type"))


def deal_owner_performance(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    a = as_date_lit(as_of)
    d = live(t, "deal").filter(F.col("owner_id").isNotNull())
    closed, won = F.col("is_closed"), F.col("is_closed_won")
    is_won, is_lost, is_open = won == True, (closed == True) & (won == False), closed == False  # noqa: E712
    amt = F.coalesce("amount", F.lit(0))
    close30 = F.col("close_date") >= F.date_sub(a, 30)
    close90 = F.col("close_date") >= F.date_sub(a, 90)
    g = d.groupBy("owner_id").agg(
        F.count(F.lit(1)).alias("total_deals"), F.count(F.when(is_won, 1)).alias("won_deals"),
        F.count(F.when(is_lost, 1)).alias("lost_deals"), F.count(F.when(is_open, 1)).alias("open_deals"),
        F.count(F.when(closed == True, 1)).alias("_closed"),  # noqa: E712
        F.sum(F.when(is_won, amt).otherwise(F.lit(0))).alias("closed_won_revenue"),
        F.sum(F.when(is_open, amt).otherwise(F.lit(0))).alias("pipeline_value"),
        F.avg(F.when(is_won, F.col("amount"))).alias("avg_won_deal_size"),
        F.avg(F.when(is_open, F.col("amount"))).alias("avg_open_deal_size"),
        F.avg(F.when(is_won, F.col("days_to_close"))).alias("avg_days_to_close_won"),
        F.avg(F.when(is_lost, F.col("days_to_close"))).alias("avg_days_to_close_lost"),
        F.count(F.when(since("create_date", as_of, 30), 1)).alias("new_deals_30d"),
        F.count(F.when(is_won & close30, 1)).alias("won_deals_30d"),
        F.sum(F.when(is_won & close30, amt).otherwise(F.lit(0))).alias("won_revenue_30d"),
        F.count(F.when(since("create_date", as_of, 90), 1)).alias("new_deals_90d"),
        F.count(F.when(is_won & close90, 1)).alias("won_deals_90d"),
        F.sum(F.when(is_won & close90, amt).otherwise(F.lit(0))).alias("won_revenue_90d"))
    g = with_owner(g, t)
    return g.select(
        "owner_id", "owner_name", "owner_email", "total_deals", "won_deals", "lost_deals", "open_deals",
        ratio("won_deals", "_closed", "100.0", (10, 2)).alias("win_rate"), "closed_won_revenue", "pipeline_value",
        "avg_won_deal_size", "avg_open_deal_size", "avg_days_to_close_won", "avg_days_to_close_lost", "new_deals_30d",
        "won_deals_30d", "won_revenue_30d", "new_deals_90d", "won_deals_90d", "won_revenue_90d")


def forecast_period(close: Column, as_of) -> Column:
    """This Month / Next Month / This Quarter / Next Quarter / Future (first match wins)."""
    a = as_date_lit(as_of)
    m0 = F.trunc(a, "month")
    m1 = F.add_months(m0, 1)
    q0 = F.trunc(a, "quarter")
    q1 = F.add_months(q0, 3)
    q2 = F.add_months(q0, 6)
    return rules([(close.between(m0, F.last_day(a)), "This Month"),
                  (close.between(m1, F.last_day(F.add_months(a, 1))), "Next Month"),
                  (close.between(q0, F.date_sub(q1, 1)), "This Quarter"),
                  (close.between(q1, F.date_sub(q2, 1)), "Next Quarter")], "Future")


def deal_forecast(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    d = live(t, "deal").filter((F.col("is_closed") == False) & F.col("close_date").isNotNull())  # noqa: E712
    d = _with_stage(d, t, {"probability": "_stage_prob"})
    prob = F.coalesce(F.col("_stage_prob"), F.col("hs_deal_stage_probability"), F.lit(50).cast("decimal(5,2)"))
    amt = F.coalesce("amount", F.lit(0))
    fp = d.select("owner_id", forecast_period(F.col("close_date"), as_of).alias("forecast_period"), "deal_id",
                  amt.alias("amount"), prob.alias("probability"), (amt * prob / F.lit(100)).alias("weighted_amount"))
    g = fp.groupBy("owner_id", "forecast_period").agg(
        F.count(F.lit(1)).alias("deal_count"), F.sum("amount").alias("pipeline_value"),
        F.sum("weighted_amount").alias("weighted_pipeline"), F.avg("probability").alias("avg_probability"),
        F.avg("amount").alias("avg_deal_size"))
    g = with_owner(g, t, cols=("owner_name",))
    return g.select("owner_id", "owner_name", "forecast_period", "deal_count", "pipeline_value", "weighted_pipeline",
                    "avg_probability", "avg_deal_size")
