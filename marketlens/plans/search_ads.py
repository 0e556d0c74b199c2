"""Search-ads marts: account / campaign / ad group / keyword / ad performance views.

Base marts are one row per (entity, date) with the latest history attributes attached;
analyses filter the base to a period first, aggregate at the entity grain and only then
attach descriptive attributes.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_key, dec, in_last_days, ratio, rules, share_pct
from ..operators.dims import attach
from ..operators.latest import latest_by_key
from ..operators.periods import period_compare
from ..operators.windows import lag_change_pct, lag_of, moving_avg, running_total
from ..sources.catalog import Tables


def _std_kpis(spend="spend", impressions="impressions", clicks="clicks", conversions="conversions",
              value="conversions_value", names=None) -> dict:
    """The shared KPI block (ctr, cpc, conversion rate, cost per conversion, roas, cpm)."""
    n = {"ctr": "ctr_percent", "cpc": "avg_cpc", "cvr": "conversion_rate_percent",
         "cpa": "cost_per_conversion", "roas": "roas", "cpm": "avg_cpm"}
    n.update(names or {})
    out = {
        n["ctr"]: ratio(clicks, impressions, "100.0", (10, 4)),
        n["cpc"]: ratio(spend, clicks, None, (18, 4)),
        n["cvr"]: ratio(conversions, clicks, "100.0", (10, 4)),
        n["cpa"]: ratio(spend, conversions, None, (18, 4)),
        n["roas"]: ratio(value, spend, None, (10, 4)),
        n["cpm"]: ratio(spend, impressions, "1000.0", (18, 4)),
    }
    return {k: v for k, v in out.items() if k}


# --------------------------------------------------------------------------- campaign
def campaign_performance(t: Tables) -> DataFrame:
    """One row per (campaign, date): latest campaign and account attributes, raw metrics with
    NULL-to-0 defaults, per-day KPIs and daily budget utilisation."""
    c = t["campaign_stats"]
    ch = latest_by_key(t["campaign_history"], "campaign_id")
    ah = latest_by_key(t["account_history"], "account_id")
    f = attach(c, ch, "campaign_id", {
        "name": "campaign_name", "status": "campaign_status", "advertising_channel_type": "advertising_channel_type",
        "advertising_channel_sub_type": "advertising_channel_sub_type",
        "bidding_strategy_type": "bidding_strategy_type", "start_date": "campaign_start_date",
        "end_date": "campaign_end_date", "budget_amount": "budget_amount", "budget_period": "budget_period"})
    f = attach(f, ah, "account_id", {"descriptive_name": "account_name", "currency_code": "currency_code"})
    conv = F.coalesce(F.col("conversions"), F.lit(0))
    value = F.coalesce(F.col("conversions_value"), F.lit(0))
    z6 = F.lit(0).cast("decimal(10,6)")
    f = f.select(
        "campaign_id", "account_id", "date", date_key("date").alias("date_id"),
        "campaign_name", "campaign_status", "advertising_channel_type", "advertising_channel_sub_type",
        "bidding_strategy_type", "campaign_start_date", "campaign_end_date", "budget_amount", "budget_period",
        "account_name", "currency_code",
        F.col("spend").cast("decimal(18,2)").alias("spend"), "impressions", "clicks",
        conv.cast("decimal(18,6)").alias("conversions"), value.cast("decimal(18,6)").alias("conversions_value"),
        F.coalesce("view_through_conversions", F.lit(0)).cast("decimal(18,6)").alias("view_through_conversions"),
        F.coalesce("video_views", F.lit(0).cast("long")).alias("video_views"),
        F.coalesce("video_quartile_p25_rate", z6).alias("video_quartile_25_rate"),
        F.coalesce("video_quartile_p50_rate", z6).alias("video_quartile_50_rate"),
        F.coalesce("video_quartile_p75_rate", z6).alias("video_quartile_75_rate"),
        F.coalesce("video_quartile_p100_rate", z6).alias("video_quartile_100_rate"),
        F.coalesce("interactions", F.lit(0).cast("long")).alias("interactions"),
        F.coalesce("interaction_event_types", F.lit("")).alias("interaction_event_types"),
        # KPIs use the raw stats (spend before its 2-decimal rounding)
        *[v.alias(k) for k, v in _std_kpis(conversions=conv, value=value).items()],
        ratio("spend", "budget_amount", "100.0", (10, 2)).alias("budget_utilization_percent"),
        F.col("_fivetran_synced").alias("last_synced_at"),
    )
    return f


def campaign_trend_analysis(t: Tables) -> DataFrame:
    """7/30-row moving averages, LAG-7 week-over-week, month-to-date running sums and daily
    ranks per campaign.  All per-campaign features share one window spec (one shuffle/sort);
    the two daily ranks share the per-date spec."""
    cp = campaign_performance(t).select(
        "campaign_id", "date", "campaign_name", "campaign_status", "advertising_channel_type", "spend",
        "impressions", "clicks", "conversions", "conversions_value", "ctr_percent", "avg_cpc",
        "conversion_rate_percent", "roas")
    from ..operators.ranks import dense_ranks_within
    # a date holding a third of all campaign-days is split into buckets
    cp = dense_ranks_within(cp, ["date"], {"daily_spend_rank": [("spend", False)],
                                           "daily_conversions_rank": [("conversions", False)]})
    p, o = ["campaign_id"], ["date"]
    mtd_p = ["campaign_id", F.year("date"), F.month("date")]
    return cp.select(
        "campaign_id", "date", "campaign_name", "campaign_status", "advertising_channel_type", "spend",
        "impressions", "clicks", "conversions", "conversions_value", "ctr_percent", "avg_cpc",
        "conversion_rate_percent", "roas",
        moving_avg(p, o, "spend", 7).alias("spend_7day_ma"),
        moving_avg(p, o, "impressions", 7).alias("impressions_7day_ma"),
        moving_avg(p, o, "clicks", 7).alias("clicks_7day_ma"),
        moving_avg(p, o, "conversions", 7).alias("conversions_7day_ma"),
        moving_avg(p, o, "ctr_percent", 7).alias("ctr_7day_ma"),
        moving_avg(p, o, "spend", 30).alias("spend_30day_ma"),
        moving_avg(p, o, "impressions", 30).alias("impressions_30day_ma"),
        moving_avg(p, o, "conversions", 30).alias("conversions_30day_ma"),
        lag_of(p, o, "spend", 7).alias("spend_last_week"),
        lag_of(p, o, "clicks", 7).alias("clicks_last_week"),
        lag_of(p, o, "conversions", 7).alias("conversions_last_week"),
        lag_change_pct(p, o, "spend", 7).alias("spend_wow_change_percent"),
        lag_change_pct(p, o, "clicks", 7).alias("clicks_wow_change_percent"),
        running_total(mtd_p, o, "spend").alias("mtd_spend"),
        running_total(mtd_p, o, "conversions").alias("mtd_conversions"),
        "daily_spend_rank", "daily_conversions_rank",
    )


def campaign_performance_summary(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Last-30-days totals and KPIs per campaign (open-ended period: includes as_of and later)."""
    cp = campaign_performance(t).filter(in_last_days("date", as_of, 30))
    g = cp.groupBy("campaign_id", "campaign_name", "campaign_status", "advertising_channel_type",
                   "account_name", "currency_code").agg(
        F.sum("spend").alias("total_spend"), F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"), F.sum("conversions").alias("total_conversions"),
        F.sum("conversions_value").alias("total_conversions_value"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count_distinct("date").alias("active_days"))
    k = _std_kpis("total_spend", "total_impressions", "total_clicks", "total_conversions", "total_conversions_value",
                  names={"ctr": "avg_ctr", "cpc": "avg_cpc", "cvr": "avg_conversion_rate",
                         "cpa": "avg_cost_per_conversion", "roas": "avg_roas", "cpm": None})
    return g.select("campaign_id", "campaign_name", "campaign_status", "advertising_channel_type", "account_name",
                    "currency_code", "total_spend", "total_impressions", "total_clicks", "total_conversions",
                    "total_conversions_value", *[v.alias(n) for n, v in k.items()],
                    "first_date", "last_date", "active_days")


# --------------------------------------------------------------------------- shared pieces
def micros(col: str):
    """``micros / 1000000.0`` as an exact decimal."""
    return (F.col(col) / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(30,9)")


def _latest_names(t: Tables):
    return (latest_by_key(t["ad_group_history"], "ad_group_id"), latest_by_key(t["campaign_history"], "campaign_id"),
            latest_by_key(t["account_history"], "account_id"))


def _totals(prefix: str = "total_") -> list:
    return [F.sum("spend").alias(f"{prefix}spend"), F.sum("impressions").alias(f"{prefix}impressions"),
            F.sum("clicks").alias(f"{prefix}clicks"), F.sum("conversions").alias(f"{prefix}conversions"),
            F.sum("conversions_value").alias(f"{prefix}conversions_value")]


def _total_kpis(names=None, prefix="total_"):
    k = _std_kpis(f"{prefix}spend", f"{prefix}impressions", f"{prefix}clicks", f"{prefix}conversions",
                  f"{prefix}conversions_value", names=dict({"cpm": None}, **(names or {})))
    return [v.alias(n) for n, v in k.items()]


# --------------------------------------------------------------------------- account
def account_performance(t: Tables) -> DataFrame:
    a = t["account_stats"]
    ah = latest_by_key(t["account_history"], "account_id")
    f = attach(a, ah, "account_id", {"descriptive_name": "account_name", "currency_code": "currency_code",
                                     "time_zone": "account_timezone"})
    conv = F.coalesce(F.col("conversions"), F.lit(0))
    return f.select(
        "account_id", "date", date_key("date").alias("date_id"), "account_name", "currency_code", "account_timezone",
        F.col("spend").cast("decimal(18,2)").alias("spend"), "impressions", "clicks",
        conv.cast("decimal(18,6)").alias("conversions"),
        F.coalesce("conversions_value", F.lit(0)).cast("decimal(18,6)").alias("conversions_value"),
        F.coalesce("view_through_conversions", F.lit(0)).cast("decimal(18,6)").alias("view_through_conversions"),
        *[v.alias(k) for k, v in _std_kpis(conversions=conv,
                                           value=F.coalesce(F.col("conversions_value"), F.lit(0))).items()],
        ratio("clicks", "impressions", "1000.0", (10, 4)).alias("engagement_rate"),
        F.col("_fivetran_synced").alias("last_synced_at"),
    )


def account_performance_summary(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Current 30 days (excluding as_of) vs the 30 days before, per account."""
    from ..functions import change_pct
    ap = account_performance(t)
    m = ["spend", "impressions", "clicks", "conversions", "conversions_value"]
    p = period_compare(ap, "account_id", as_of, m)
    ah = latest_by_key(t["account_history"], "account_id")
    p = attach(p, ah, "account_id", {"descriptive_name": "account_name", "currency_code": "currency_code"})
    k = _std_kpis("cur_spend", "cur_impressions", "cur_clicks", "cur_conversions", "cur_conversions_value",
                  names={"ctr": "current_ctr", "cpc": "current_cpc", "cvr": "current_conversion_rate",
                         "cpa": "current_cost_per_conversion", "roas": "current_roas", "cpm": None})
    prev = {x: F.coalesce(F.col(f"prev_{x}"), F.lit(0)) for x in m}
    return p.select(
        "account_id", "account_name", "currency_code",
        *[F.col(f"cur_{x}").alias(f"current_{x}") for x in m],
        *[v.alias(n) for n, v in k.items()],
        *[prev[x].alias(f"previous_{x}") for x in ["spend", "impressions", "clicks", "conversions"]],
        *[change_pct(f"cur_{x}", prev[x]).alias(f"{x}_change_percent")
          for x in ["spend", "impressions", "clicks", "conversions"]],
        "period_start", "period_end", "days_in_period")


# --------------------------------------------------------------------------- ad group
def ad_group_performance(t: Tables) -> DataFrame:
    ag = t["ad_group_stats"]
    agh, ch, ah = _latest_names(t)
    f = attach(ag, agh, "ad_group_id", {
        "name": "ad_group_name", "status": "ad_group_status", "type": "ad_group_type",
        "cpc_bid_micros": "_cpc_bid_micros", "cpm_bid_micros": "_cpm_bid_micros",
        "target_cpa_micros": "_target_cpa_micros", "effective_target_cpa_micros": "_eff_target_cpa_micros",
        "effective_target_roas": "effective_target_roas"})
    f = attach(f, ch, "campaign_id", {"name": "campaign_name", "status": "campaign_status",
                                      "advertising_channel_type": "advertising_channel_type"})
    f = attach(f, ah, "account_id", {"descriptive_name": "account_name", "currency_code": "currency_code"})
    conv = F.coalesce(F.col("conversions"), F.lit(0))
    target = micros("_target_cpa_micros")
    return f.select(
        "ad_group_id", "campaign_id", "account_id", "date", date_key("date").alias("date_id"),
        "ad_group_name", "ad_group_status", "ad_group_type",
        micros("_cpc_bid_micros").alias("cpc_bid"), micros("_cpm_bid_micros").alias("cpm_bid"),
        target.alias("target_cpa"), micros("_eff_target_cpa_micros").alias("effective_target_cpa"),
        "effective_target_roas", "campaign_name", "campaign_status", "advertising_channel_type", "account_name",
        "currency_code",
        F.col("spend").cast("decimal(18,2)").alias("spend"), "impressions", "clicks",
        conv.cast("decimal(18,6)").alias("conversions"),
        F.coalesce("conversions_value", F.lit(0)).cast("decimal(18,6)").alias("conversions_value"),
        F.coalesce("view_through_conversions", F.lit(0)).cast("decimal(18,6)").alias("view_through_conversions"),
        F.coalesce("interactions", F.lit(0).cast("long")).alias("interactions"),
        *[v.alias(k) for k, v in _std_kpis(conversions=conv,
                                           value=F.coalesce(F.col("conversions_value"), F.lit(0))).items()],
        F.when((conv > 0) & (F.col("_target_cpa_micros") > 0),
               (F.col("spend") / conv - target)).cast("decimal(18,4)").alias("cpa_vs_target_variance"),
        F.col("_fivetran_synced").alias("last_synced_at"),
    )


def ad_group_drilldown(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Last-30-days per ad group: hierarchy path, share of and rank within its campaign, and
    cost-per-conversion against the campaign average."""
    from ..functions import concat_safe
    keys = ["account_id", "account_name", "campaign_id", "campaign_name", "campaign_status",
            "advertising_channel_type", "ad_group_id", "ad_group_name", "ad_group_status", "ad_group_type",
            "currency_code"]
    # 30-day totals per (ad group, campaign, account) first, then one attribute lookup per ad group
    per_group = _period_by_ids(t["ad_group_stats"], ["ad_group_id", "campaign_id", "account_id"], as_of,
                               {"first": F.col("date"), "last": F.col("date")})
    agh, ch, ah = _latest_names(t)
    g = attach(per_group, agh, "ad_group_id", {"name": "ad_group_name", "status": "ad_group_status",
                                               "type": "ad_group_type"})
    g = attach(g, ch, "campaign_id", {"name": "campaign_name", "status": "campaign_status",
                                      "advertising_channel_type": "advertising_channel_type"})
    g = attach(g, ah, "account_id", {"descriptive_name": "account_name", "currency_code": "currency_code"})
    g = g.withColumns({"first_date": F.col("_min_first"), "last_date": F.col("_max_last"),
                       "active_days": F.col("_days")})
    from ..operators.ranks import dense_ranks_within
    from ..operators.shares import with_group_aggs
    cpa = F.col("total_spend") / F.col("total_conversions")
    has_conv = F.col("total_conversions") > 0
    # campaign totals / average: partial+final group aggregates joined back (a campaign holding a
    # third of all ad groups is combined map-side); in-campaign ranks: size-checked partitioned ranks
    g = with_group_aggs(g, ["campaign_id"], {"_camp_spend": F.sum("total_spend"), "_camp_clicks": F.sum("total_clicks"),
                                            "_camp_conv": F.sum("total_conversions"),
                                            "_camp_avg_cpa": F.avg(F.when(has_conv, cpa))})
    g = dense_ranks_within(g, ["campaign_id"], {"spend_rank_in_campaign": [("total_spend", False)],
                                                "conversions_rank_in_campaign": [("total_conversions", False)]})

    return g.select(
        concat_safe("account_name", F.lit(" > "), "campaign_name", F.lit(" > "), "ad_group_name")
        .alias("full_hierarchy_path"),
        *keys, "total_spend", "total_impressions", "total_clicks", "total_conversions", "total_conversions_value",
        *_total_kpis(names={"ctr": "ctr_percent", "cpc": "avg_cpc", "cvr": "conversion_rate_percent",
                            "cpa": "cost_per_conversion", "roas": "roas"}),
        share_pct("total_spend", "_camp_spend").alias("pct_of_campaign_spend"),
        share_pct("total_clicks", "_camp_clicks").alias("pct_of_campaign_clicks"),
        share_pct("total_conversions", "_camp_conv").alias("pct_of_campaign_conversions"),
        "spend_rank_in_campaign", "conversions_rank_in_campaign",
        rules([(has_conv & (cpa < F.col("_camp_avg_cpa")), "Above Average"), (has_conv, "Below Average")],
              "No Conversions").alias("performance_indicator"),
        "first_date", "last_date", "active_days",
    )


def ad_group_performance_summary(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Period comparison per ad group joined to its distinct attribute rows.

    The attribute rows are derived from the distinct (ad group, campaign, account) keys of the
    stats - not from every daily row - and the names attached to those few keys."""
    from ..functions import change_pct
    stats = t["ad_group_stats"]
    agh, ch, ah = _latest_names(t)
    ids = stats.select("ad_group_id", "campaign_id", "account_id").distinct()
    attrs = attach(attach(attach(ids, agh, "ad_group_id", {"name": "ad_group_name", "status": "ad_group_status"}),
                          ch, "campaign_id", {"name": "campaign_name"}),
                   ah, "account_id", {"descriptive_name": "account_name"}) \
        .select("ad_group_id", "ad_group_name", "ad_group_status", "campaign_name", "account_name").distinct()
    base = stats.select("ad_group_id", "date", F.col("spend").cast("decimal(18,2)").alias("spend"), "impressions",
                        "clicks", F.coalesce("conversions", F.lit(0)).cast("decimal(18,6)").alias("conversions"))
    p = period_compare(base, "ad_group_id", as_of, ["spend", "impressions", "clicks", "conversions"])
    prev_spend = F.coalesce(F.col("prev_spend"), F.lit(0))
    prev_conv = F.coalesce(F.col("prev_conversions"), F.lit(0))
    return attrs.join(p, "ad_group_id", "inner").select(
        "ad_group_id", "ad_group_name", "ad_group_status", "campaign_name", "account_name",
        F.col("cur_spend").alias("current_spend"), F.col("cur_impressions").alias("current_impressions"),
        F.col("cur_clicks").alias("current_clicks"), F.col("cur_conversions").alias("current_conversions"),
        prev_spend.alias("previous_spend"), prev_conv.alias("previous_conversions"),
        change_pct("cur_spend", prev_spend).alias("spend_change_percent"),
        change_pct("cur_conversions", prev_conv).alias("conversions_change_percent"))


# --------------------------------------------------------------------------- keywords
def quality_score_category(qs):
    q = F.col(qs)
    return rules([(q >= 7, "High (7-10)"), (q >= 4, "Medium (4-6)"), (q >= 1, "Low (1-3)")], "Not Available")


def _keyword_attrs(df: DataFrame, t: Tables) -> DataFrame:
    """Attach latest keyword (KEYWORD criteria only), ad group, campaign and account attributes to
    any frame carrying (criterion_id, ad_group_id, campaign_id, account_id)."""
    kh = latest_by_key(t["ad_group_criterion_history"], "criterion_id", where=F.col("type") == "KEYWORD")
    agh, ch, ah = _latest_names(t)
    f = attach(df, kh, "criterion_id", {
        "keyword_text": "keyword_text", "keyword_match_type": "keyword_match_type", "status": "keyword_status",
        "system_serving_status": "system_serving_status", "approval_status": "approval_status",
        "quality_score": "quality_score", "creative_quality_score": "creative_quality_score",
        "post_click_quality_score": "post_click_quality_score", "search_predicted_ctr": "search_predicted_ctr",
        "cpc_bid_micros": "_cpc", "effective_cpc_bid_micros": "_ecpc", "final_url_suffix": "final_url_suffix"}, grows=True)
    f = attach(f, agh, "ad_group_id", {"name": "ad_group_name"}, grows=True)
    f = attach(f, ch, "campaign_id", {"name": "campaign_name"})
    f = attach(f, ah, "account_id", {"descriptive_name": "account_name", "currency_code": "currency_code"})
    return f.withColumn("quality_score_category", quality_score_category("quality_score"))


def keyword_performance(t: Tables) -> DataFrame:
    f = _keyword_attrs(t["keyword_stats"], t)
    conv = F.coalesce(F.col("conversions"), F.lit(0))
    z = F.lit(0).cast("decimal(10,6)")
    kpis = _std_kpis(conversions=conv, value=F.coalesce(F.col("conversions_value"), F.lit(0)), names={"cpm": None})
    return f.select(
        F.col("criterion_id").alias("keyword_id"), "ad_group_id", "campaign_id", "account_id", "date",
        date_key("date").alias("date_id"), "keyword_text", "keyword_match_type", "keyword_status",
        "system_serving_status", "approval_status", "quality_score", "creative_quality_score",
        "post_click_quality_score", "search_predicted_ctr", micros("_cpc").alias("cpc_bid"),
        micros("_ecpc").alias("effective_cpc_bid"), "final_url_suffix", "ad_group_name", "campaign_name",
        "account_name", "currency_code",
        F.col("spend").cast("decimal(18,2)").alias("spend"), "impressions", "clicks",
        conv.cast("decimal(18,6)").alias("conversions"),
        F.coalesce("conversions_value", F.lit(0)).cast("decimal(18,6)").alias("conversions_value"),
        *[F.coalesce(c, z).alias(c) for c in ["search_impression_share", "search_top_impression_share",
                                              "search_absolute_top_impression_share",
                                              "search_rank_lost_impression_share",
                                              "search_budget_lost_impression_share"]],
        *[v.alias(n) for n, v in kpis.items()],
        "quality_score_category",
        F.col("_fivetran_synced").alias("last_synced_at"),
    )


_ID_SUMS = ["spend", "impressions", "clicks", "conversions", "conversions_value"]


def _period_by_ids(stats: DataFrame, ids: list[str], as_of, extra: dict | None = None) -> DataFrame:
    """Last-30-day totals per entity id, summing the base view's per-row values (spend rounded to
    cents, NULL conversions as 0) so the result equals aggregating the base view.  Done before any
    dimension is attached: dimensions then join one row per entity instead of one per day."""
    base = stats.filter(in_last_days("date", as_of, 30)).select(
        *ids, "date", F.col("spend").cast("decimal(18,2)").alias("spend"), "impressions", "clicks",
        F.coalesce("conversions", F.lit(0)).cast("decimal(18,6)").alias("conversions"),
        F.coalesce("conversions_value", F.lit(0)).cast("decimal(18,6)").alias("conversions_value"),
        *[c.alias(n) for n, c in (extra or {}).items()])
    sums = {n: c for n, c in (extra or {}).items() if n not in ("first", "last")}
    return base.groupBy(*ids).agg(*[F.sum(m).alias(f"total_{m}") for m in _ID_SUMS],
                                  *[F.sum(n).alias(f"_sum_{n}") for n in sums],
                                  F.min("date").alias("_min_first"), F.max("date").alias("_max_last"),
                                  F.count(F.lit(1)).alias("_rows"), F.count_distinct("date").alias("_days"))


def _regroup(df: DataFrame, keys: list[str], extra: list[str] = ()) -> DataFrame:
    """Re-aggregate per-entity totals by the (name-based) grouping of the source view; exact for
    sums, averages are carried as (sum, rows)."""
    types = {"spend": "decimal(28,2)", "impressions": "long", "clicks": "long", "conversions": "decimal(28,6)",
             "conversions_value": "decimal(28,6)"}
    return df.groupBy(*keys).agg(*[F.sum(f"total_{m}").cast(types[m]).alias(f"total_{m}") for m in _ID_SUMS],
                                 *[F.sum(f"_sum_{n}").alias(f"_sum_{n}") for n in extra],
                                 F.sum("_rows").alias("_rows"))


_KW_ATTRS = ["keyword_id", "keyword_text", "keyword_match_type", "keyword_status", "quality_score",
             "quality_score_category", "ad_group_name", "campaign_name", "account_name", "currency_code"]


def keyword_top_performers(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Last-30-days keywords with activity, four global dense ranks and a performance class.

    The ranks are whole-result ranks; they are computed with the parallel bucketed rank
    (``operators.ranks``) rather than a single-partition window."""
    from ..operators.ranks import global_dense_ranks
    share = {"share": F.coalesce("search_impression_share", F.lit(0).cast("decimal(10,6)"))}
    per_kw = _period_by_ids(t["keyword_stats"], ["criterion_id", "ad_group_id", "campaign_id", "account_id"], as_of,
                            share)
    g = _regroup(_keyword_attrs(per_kw, t).withColumnRenamed("criterion_id", "keyword_id"), _KW_ATTRS, ["share"])
    g = g.withColumn("avg_impression_share", ratio("_sum_share", "_rows", None, (14, 10), default=None))
    g = g.filter(F.col("total_impressions") > 0)
    roas_key = F.when(F.col("total_spend") > 0, F.col("total_conversions_value") / F.col("total_spend")) \
        .otherwise(F.lit(0))
    eff_key = F.when(F.col("total_conversions") > 0, F.col("total_spend") / F.col("total_conversions")) \
        .otherwise(F.lit(999999))
    g = g.withColumns({"_roas_key": roas_key, "_eff_key": eff_key})
    g = global_dense_ranks(g, {"conversions_rank": [("total_conversions", False)],
                               "spend_rank": [("total_spend", False)],
                               "roas_rank": [("_roas_key", False)],
                               "efficiency_rank": [("_eff_key", True)]})
    conv, roas = F.col("total_conversions"), F.col("_roas_key")
    cls = rules([
        ((conv >= 10) & (roas >= 2), "Star Performer"),
        ((conv >= 5) & (roas >= 1), "Strong Performer"),
        ((F.col("total_clicks") >= 100) & (conv < 2), "High Traffic, Low Conversion"),
        ((F.col("total_impressions") >= 1000) & (F.col("total_clicks") < 10), "Low CTR"),
        ((F.col("total_spend") > 0) & (conv == 0), "Spending, No Conversions"),
    ], "Developing")
    return g.select(*_KW_ATTRS, "total_spend", "total_impressions", "total_clicks", "total_conversions",
                    "total_conversions_value",
                    *_total_kpis(names={"ctr": "ctr_percent", "cpc": "avg_cpc", "cvr": "conversion_rate_percent",
                                        "cpa": "cost_per_conversion", "roas": "roas"}),
                    "avg_impression_share", "conversions_rank", "spend_rank", "roas_rank", "efficiency_rank",
                    cls.alias("performance_classification"))


def keyword_quality_score_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    attrs = ["keyword_id", "keyword_text", "keyword_match_type", "keyword_status", "quality_score",
             "quality_score_category", "creative_quality_score", "post_click_quality_score", "search_predicted_ctr",
             "ad_group_name", "campaign_name", "account_name"]
    per_kw = _period_by_ids(t["keyword_stats"], ["criterion_id", "ad_group_id", "campaign_id", "account_id"], as_of)
    kw = _keyword_attrs(per_kw, t).withColumnRenamed("criterion_id", "keyword_id") \
        .filter(F.col("quality_score").isNotNull())
    g = _regroup(kw, attrs).drop("total_conversions_value")
    qs = F.col("quality_score")

    def advice(col, below, average, good):
        c = F.col(col)
        return rules([(c == "BELOW_AVERAGE", below), (c == "AVERAGE", average)], good)

    return g.select(
        *attrs, "total_spend", "total_impressions", "total_clicks", "total_conversions",
        ratio("total_clicks", "total_impressions", "100.0", (10, 4)).alias("ctr_percent"),
        ratio("total_spend", "total_clicks", None, (18, 4)).alias("avg_cpc"),
        ratio("total_conversions", "total_clicks", "100.0", (10, 4)).alias("conversion_rate_percent"),
        rules([(qs < 4, "Critical - Needs Immediate Attention"), (qs < 7, "Moderate - Room for Improvement")],
              "Good - Maintain Current Strategy").alias("qs_action_priority"),
        advice("creative_quality_score", "Improve ad relevance", "Test new ad copy", "Ad creative is strong")
        .alias("creative_recommendation"),
        advice("post_click_quality_score", "Improve landing page experience", "Optimize landing page",
               "Landing page is effective").alias("landing_page_recommendation"),
        advice("search_predicted_ctr", "Improve expected CTR", "Test more compelling ad copy",
               "CTR expectations are good").alias("ctr_recommendation"),
        F.when((qs < 7) & (F.col("total_clicks") > 0),
               (F.col("total_spend") / F.col("total_clicks")) * dec("0.2"))
        .otherwise(F.lit(0)).cast("decimal(18,4)").alias("estimated_cpc_savings_potential"),
    )


def keyword_match_type_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    per_kw = _period_by_ids(t["keyword_stats"], ["criterion_id", "ad_group_id", "campaign_id", "account_id"], as_of)
    kw = _regroup(_keyword_attrs(per_kw, t).withColumnRenamed("criterion_id", "keyword_id"),
                  ["keyword_id", "keyword_match_type", "quality_score", "campaign_name", "account_name"])
    g = kw.groupBy("keyword_match_type", "campaign_name", "account_name").agg(
        F.count_distinct("keyword_id").alias("keyword_count"),
        *[F.sum(f"total_{m}").alias(f"total_{m}") for m in
          ["spend", "impressions", "clicks", "conversions", "conversions_value"]],
        F.avg(F.col("quality_score").cast("decimal(10,2)")).alias("avg_quality_score"))
    return g.select("*", *_total_kpis(names={"ctr": "ctr_percent", "cpc": "avg_cpc", "cvr": "conversion_rate_percent",
                                             "cpa": "cost_per_conversion", "roas": "roas"}))


# --------------------------------------------------------------------------- ads
def ad_strength_label(col: str = "ad_strength"):
    s = F.col(col)
    return rules([(s == "EXCELLENT", "Excellent"), (s == "GOOD", "Good"), (s == "AVERAGE", "Average"),
                  (s == "POOR", "Poor"), ((s == "UNSPECIFIED") | s.isNull(), "Not Applicable")], s)


_AD_TEXT = ["responsive_search_ad_headlines", "responsive_search_ad_descriptions", "responsive_search_ad_path1",
            "responsive_search_ad_path2", "expanded_text_ad_headline_part1", "expanded_text_ad_headline_part2",
            "expanded_text_ad_headline_part3", "expanded_text_ad_description", "expanded_text_ad_description2",
            "expanded_text_ad_path1", "expanded_text_ad_path2", "display_url", "final_urls", "final_mobile_urls"]


def _ad_attrs(df: DataFrame, t: Tables) -> DataFrame:
    """Attach latest ad, ad group, campaign and account attributes (and the strength label) to any
    frame carrying (ad_id, ad_group_id, campaign_id, account_id)."""
    adh = latest_by_key(t["ad_history"], "ad_id")
    agh, ch, ah = _latest_names(t)
    f = attach(df, adh, "ad_id", {"type": "ad_type", "status": "ad_status", "device_preference": "device_preference",
                                  **{c: c for c in _AD_TEXT}, "ad_strength": "ad_strength"})
    f = attach(f, agh, "ad_group_id", {"name": "ad_group_name"})
    f = attach(f, ch, "campaign_id", {"name": "campaign_name", "advertising_channel_type": "advertising_channel_type"})
    f = attach(f, ah, "account_id", {"descriptive_name": "account_name", "currency_code": "currency_code"})
    return f.withColumn("ad_strength_label", ad_strength_label())


def ad_performance(t: Tables) -> DataFrame:
    f = _ad_attrs(t["ad_stats"], t)
    conv = F.coalesce(F.col("conversions"), F.lit(0))
    kpis = _std_kpis(conversions=conv, value=F.coalesce(F.col("conversions_value"), F.lit(0)), names={"cpm": None})
    return f.select(
        "ad_id", "ad_group_id", "campaign_id", "account_id", "date", date_key("date").alias("date_id"),
        "ad_type", "ad_status", "device_preference", *_AD_TEXT[:11], "display_url", "final_urls",
        "final_mobile_urls", "ad_strength", "ad_group_name", "campaign_name", "advertising_channel_type",
        "account_name", "currency_code",
        F.col("spend").cast("decimal(18,2)").alias("spend"), "impressions", "clicks",
        conv.cast("decimal(18,6)").alias("conversions"),
        F.coalesce("conversions_value", F.lit(0)).cast("decimal(18,6)").alias("conversions_value"),
        F.coalesce("interactions", F.lit(0).cast("long")).alias("interactions"),
        F.coalesce("video_views", F.lit(0).cast("long")).alias("video_views"),
        F.coalesce("video_quartile_p100_rate", F.lit(0).cast("decimal(10,6)")).alias("video_completion_rate"),
        *[v.alias(n) for n, v in kpis.items()],
        "ad_strength_label",
        F.col("_fivetran_synced").alias("last_synced_at"),
    )


_AD_IDS = ["ad_id", "ad_group_id", "campaign_id", "account_id"]


def _ads_by_id(t: Tables, as_of) -> DataFrame:
    return _ad_attrs(_period_by_ids(t["ad_stats"], _AD_IDS, as_of), t)


def ad_copy_effectiveness(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Last-30-days per ad: copy previews, ranks inside the ad group, tier against the global
    average CTR (a one-row aggregate broadcast back, not an un-partitioned window)."""
    from ..functions import concat_safe, left
    from ..operators.shares import with_group_aggs
    attrs = ["ad_id", "ad_type", "ad_status", "ad_strength_label", "ad_group_name", "campaign_name", "account_name",
             "currency_code", "advertising_channel_type", "responsive_search_ad_headlines",
             "responsive_search_ad_descriptions", "expanded_text_ad_headline_part1",
             "expanded_text_ad_headline_part2", "expanded_text_ad_description", "final_urls"]
    # per-ad totals first; active days are exact because an ad id belongs to one ad group
    g = _ads_by_id(t, as_of).groupBy(*attrs).agg(
        *[F.sum(f"total_{m}").cast(tp).alias(f"total_{m}") for m, tp in
          [("spend", "decimal(28,2)"), ("impressions", "long"), ("clicks", "long"), ("conversions", "decimal(28,6)"),
           ("conversions_value", "decimal(28,6)")]],
        F.sum("_days").alias("active_days")).filter(F.col("total_impressions") > 0)
    imp, clicks, conv = F.col("total_impressions"), F.col("total_clicks"), F.col("total_conversions")
    ctr_raw = F.when(imp > 0, clicks * F.lit(100).cast("decimal(3,0)") / imp).otherwise(F.lit(0))
    g = g.withColumn("_ctr_raw", ctr_raw)
    g = with_group_aggs(g, [], {"_avg_ctr": F.avg("_ctr_raw")})
    roas_raw = F.when(F.col("total_spend") > 0, F.col("total_conversions_value") / F.col("total_spend")) \
        .otherwise(F.lit(0))
    rsa = F.col("ad_type") == "RESPONSIVE_SEARCH_AD"
    tier = rules([
        ((conv >= 5) & (roas_raw >= 2), "Top Performer"),
        ((conv >= 2) & (F.col("_ctr_raw") >= F.col("_avg_ctr")), "Above Average"),
        ((clicks > 0) & (conv == 0), "Clicks but No Conversions"),
        ((imp > 0) & (clicks == 0), "Impressions but No Clicks"),
    ], "Developing")
    label = F.col("ad_strength_label")
    suggestion = rules([
        (label.isin("Poor", "Average") & rsa, "Improve ad strength"),
        ((label == "Excellent") & (conv < 2), "Strong ad, low conversions - check targeting"),
    ], "No action needed")
    from ..operators.ranks import dense_ranks_within
    g = g.withColumn("_ctr_key", F.when(imp > 0, clicks / imp).otherwise(F.lit(0)))
    # ranks inside an ad-group *name* (NULL names form one group): size-checked partitioned ranks
    g = dense_ranks_within(g, ["ad_group_name"], {
        "clicks_rank_in_ad_group": [("total_clicks", False)],
        "conversions_rank_in_ad_group": [("total_conversions", False)],
        "ctr_rank_in_ad_group": [("_ctr_key", False)]})
    return g.select(
        "ad_id", "ad_type", "ad_status", "ad_strength_label", "ad_group_name", "campaign_name", "account_name",
        "currency_code", "advertising_channel_type",
        F.when(rsa, left(F.coalesce("responsive_search_ad_headlines", F.lit("")), 100))
        .otherwise(concat_safe("expanded_text_ad_headline_part1", F.lit(" | "), "expanded_text_ad_headline_part2"))
        .alias("ad_headline_preview"),
        F.when(rsa, left(F.coalesce("responsive_search_ad_descriptions", F.lit("")), 100))
        .otherwise(F.coalesce("expanded_text_ad_description", F.lit(""))).alias("ad_description_preview"),
        F.col("final_urls").alias("landing_page_url"),
        "total_spend", "total_impressions", "total_clicks", "total_conversions", "total_conversions_value",
        "active_days",
        *_total_kpis(names={"ctr": "ctr_percent", "cpc": "avg_cpc", "cvr": "conversion_rate_percent",
                            "cpa": "cost_per_conversion", "roas": "roas"}),
        "clicks_rank_in_ad_group", "conversions_rank_in_ad_group", "ctr_rank_in_ad_group",
        tier.alias("performance_tier"), suggestion.alias("optimization_suggestion"),
    )


def _ads_30d(t: Tables, as_of, keys: list[str]) -> DataFrame:
    return _regroup(_ads_by_id(t, as_of), keys)


def ad_strength_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    from ..operators.shares import with_group_aggs
    ads = _ads_30d(t, as_of, ["ad_id", "ad_type", "ad_strength_label", "campaign_name", "account_name"])
    g = ads.groupBy("ad_strength_label", "ad_type", "campaign_name", "account_name").agg(
        F.count_distinct("ad_id").alias("ad_count"),
        *[F.sum(f"total_{m}").alias(f"total_{m}") for m in
          ["spend", "impressions", "clicks", "conversions", "conversions_value"]])
    g = with_group_aggs(g, [], {"_all_ads": F.sum("ad_count"), "_all_spend": F.sum("total_spend")})
    return g.select(
        "ad_strength_label", "ad_type", "campaign_name", "account_name", "ad_count", "total_spend",
        "total_impressions", "total_clicks", "total_conversions", "total_conversions_value",
        *_total_kpis(names={"ctr": "avg_ctr_percent", "cpc": "avg_cpc", "cvr": "avg_conversion_rate", "cpa": None,
                            "roas": "avg_roas"}),
        share_pct("ad_count", "_all_ads").alias("pct_of_total_ads"),
        share_pct("total_spend", "_all_spend").alias("pct_of_total_spend"),
    )


def ad_type_comparison(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    ads = _ads_30d(t, as_of, ["ad_id", "ad_type", "ad_group_name", "campaign_name", "account_name"])
    n_ads = F.count_distinct("ad_id")
    g = ads.groupBy("ad_type", "account_name").agg(
        n_ads.alias("ad_count"), F.count_distinct("ad_group_name").alias("ad_groups_with_type"),
        F.count_distinct("campaign_name").alias("campaigns_with_type"),
        *[F.sum(f"total_{m}").alias(f"total_{m}") for m in
          ["spend", "impressions", "clicks", "conversions", "conversions_value"]])
    return g.select(
        "ad_type", "account_name", "ad_count", "ad_groups_with_type", "campaigns_with_type", "total_spend",
        "total_impressions", "total_clicks", "total_conversions", "total_conversions_value",
        ratio("total_spend", "ad_count", None, (18, 2), None, F.col("ad_count") != 0).alias("avg_spend_per_ad"),
        ratio("total_conversions", "ad_count", None, (10, 2), None, F.col("ad_count") != 0)
        .alias("avg_conversions_per_ad"),
        *_total_kpis(names={"ctr": "ctr_percent", "cpc": "avg_cpc", "cvr": "conversion_rate_percent",
                            "cpa": "cost_per_conversion", "roas": "roas"}),
    )


def q_top_keywords(t: Tables, as_of: _dt.date | None = None, k: int = 10) -> DataFrame:
    """Top-k keyword report (the documented TOP 10): exactly k rows, by conversion rank; ties go to
    the higher spend, then to the smaller names."""
    from ..operators.ranks import top_n
    order = [("conversions_rank", True), ("spend_rank", True), *[(c, True) for c in _KW_ATTRS]]
    return top_n(keyword_top_performers(t, as_of), order, k)
