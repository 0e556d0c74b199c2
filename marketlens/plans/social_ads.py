"""Social-ads marts.

The only fact is ad-level daily ``fb_basic_ad``; account / campaign / ad set marts roll it
up (partial + final hash aggregation) before attaching the latest non-deleted history rows.
History lookups use the lenient soft-delete rule (a NULL flag counts as not deleted) applied
*before* ranking, so a deleted latest version falls back to the previous one.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import change_pct, concat_safe, date_key, in_last_days, left, ratio, rules, share_pct
from ..operators.dims import attach
from ..operators.latest import latest_by_key, not_deleted
from ..operators.ranks import global_dense_ranks
from ..operators.shares import with_group_aggs
from ..operators.windows import lag_change_pct, lag_of, moving_avg, running_total
from ..sources.catalog import Tables
from ..operators.periods import period_compare

_METRICS = ["spend", "impressions", "clicks", "reach", "actions", "action_values"]


def _latest(t: Tables, name: str, key: str) -> DataFrame:
    return latest_by_key(t[f"fb_{name}"], key, where=not_deleted(lenient=True))


def _rollup(t: Tables, keys: list[str]) -> DataFrame:
    return t["fb_basic_ad"].groupBy(*keys, "date").agg(
        *[F.sum(m).alias(m) for m in _METRICS], F.max("_fivetran_synced").alias("_fivetran_synced"))


def _row_block(budget: str | None = None) -> list:
    """Raw metrics + per-row KPIs of the social base marts."""
    acts = F.coalesce(F.col("actions"), F.lit(0))
    vals = F.coalesce(F.col("action_values"), F.lit(0))
    out = [
        F.col("spend").cast("decimal(18,2)").alias("spend"), "impressions", "clicks", "reach",
        ratio("impressions", "reach", "1.0", (10, 4)).alias("frequency"),
        acts.alias("total_actions"), vals.alias("total_action_value"),
        ratio("clicks", "impressions", "100.0", (10, 4)).alias("ctr_percent"),
        ratio("clicks", "reach", "100.0", (10, 4)).alias("unique_ctr_percent"),
        ratio("spend", "clicks", None, (18, 4)).alias("avg_cpc"),
        ratio("spend", "actions", None, (18, 4), guard=acts > 0).alias("cost_per_action"),
        ratio(vals, "spend", None, (10, 4)).alias("roas"),
        ratio("spend", "impressions", "1000.0", (18, 4)).alias("avg_cpm"),
        ratio("spend", "reach", "1000.0", (18, 4)).alias("cpp"),
    ]
    if budget:
        out.append(ratio("spend", budget, "100.0", (10, 2)).alias("budget_utilization_percent"))
    return out


def _totals() -> list:
    return [F.sum("spend").alias("total_spend"), F.sum("impressions").alias("total_impressions"),
            F.sum("clicks").alias("total_clicks"), F.sum("reach").alias("total_reach"),
            F.sum("total_actions").alias("total_actions"), F.sum("total_action_value").alias("total_action_value")]


def _resum() -> list:
    return [F.sum(f"total_{m}").alias(f"total_{m}") for m in
            ["spend", "impressions", "clicks", "reach", "actions", "action_value"]]


def _total_kpis(names: dict) -> list:
    f = {
        "frequency": ratio("total_impressions", "total_reach", "1.0", (10, 4)),
        "ctr": ratio("total_clicks", "total_impressions", "100.0", (10, 4)),
        "cpc": ratio("total_spend", "total_clicks", None, (18, 4)),
        "cpa": ratio("total_spend", "total_actions", None, (18, 4)),
        "roas": ratio("total_action_value", "total_spend", None, (10, 4)),
        "cpp": ratio("total_spend", "total_reach", "1000.0", (18, 4)),
    }
    return [f[k].alias(v) for k, v in names.items()]


# --------------------------------------------------------------------------- account
def fb_account_performance(t: Tables) -> DataFrame:
    a = _rollup(t, ["account_id"])
    a = attach(a, _latest(t, "account_history", "account_id"), "account_id",
               {"name": "account_name", "currency": "currency_code", "timezone_name": "account_timezone",
                "account_status": "account_status"})
    return a.select("account_id", "date", date_key("date").alias("date_id"), "account_name", "currency_code",
                    "account_timezone", "account_status", *_row_block(),
                    F.col("_fivetran_synced").alias("last_synced_at"))


def fb_account_performance_summary(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    base = fb_account_performance(t)
    m = ["spend", "impressions", "clicks", "reach", "total_actions", "total_action_value"]
    p = period_compare(base, "account_id", as_of, m)
    p = attach(p, _latest(t, "account_history", "account_id"), "account_id",
               {"name": "account_name", "currency": "currency_code"})
    prev = {x: F.coalesce(F.col(f"prev_{x}"), F.lit(0)) for x in m}
    cur = {x: F.col(f"cur_{x}") for x in m}
    return p.select(
        "account_id", "account_name", "currency_code",
        cur["spend"].alias("current_spend"), cur["impressions"].alias("current_impressions"),
        cur["clicks"].alias("current_clicks"), cur["reach"].alias("current_reach"),
        cur["total_actions"].alias("current_actions"), cur["total_action_value"].alias("current_action_value"),
        ratio(cur["clicks"], cur["impressions"], "100.0", (10, 4)).alias("current_ctr"),
        ratio(cur["spend"], cur["clicks"], None, (18, 4)).alias("current_cpc"),
        ratio(cur["impressions"], cur["reach"], "1.0", (10, 4)).alias("current_frequency"),
        ratio(cur["spend"], cur["total_actions"], None, (18, 4)).alias("current_cost_per_action"),
        ratio(cur["total_action_value"], cur["spend"], None, (10, 4)).alias("current_roas"),
        prev["spend"].alias("previous_spend"), prev["impressions"].alias("previous_impressions"),
        prev["clicks"].alias("previous_clicks"), prev["reach"].alias("previous_reach"),
        prev["total_actions"].alias("previous_actions"),
        change_pct(cur["spend"], prev["spend"]).alias("spend_change_percent"),
        change_pct(cur["impressions"], prev["impressions"]).alias("impressions_change_percent"),
        change_pct(cur["reach"], prev["reach"]).alias("reach_change_percent"),
        change_pct(cur["total_actions"], prev["total_actions"]).alias("actions_change_percent"),
        "period_start", "period_end", "days_in_period")


# --------------------------------------------------------------------------- campaign
def fb_campaign_performance(t: Tables) -> DataFrame:
    c = _rollup(t, ["campaign_id", "account_id"])
    c = attach(c, _latest(t, "campaign_history", "campaign_id"), "campaign_id", {
        "name": "campaign_name", "status": "campaign_status", "objective": "campaign_objective",
        "daily_budget": "daily_budget", "lifetime_budget": "lifetime_budget"})
    c = attach(c, _latest(t, "account_history", "account_id"), "account_id",
               {"name": "account_name", "currency": "currency_code"})
    return c.select("campaign_id", "account_id", "date", date_key("date").alias("date_id"), "campaign_name",
                    "campaign_status", "campaign_objective", "daily_budget", "lifetime_budget", "account_name",
                    "currency_code", *_row_block("daily_budget"), F.col("_fivetran_synced").alias("last_synced_at"))


def fb_campaign_trend_analysis(t: Tables) -> DataFrame:
    cp = fb_campaign_performance(t).select(
        "campaign_id", "date", "campaign_name", "campaign_status", "campaign_objective", "spend", "impressions",
        "clicks", "reach", "total_actions", "total_action_value", "ctr_percent", "avg_cpc", "frequency", "roas")
    from ..operators.ranks import dense_ranks_within
    cp = dense_ranks_within(cp, ["date"], {"daily_spend_rank": [("spend", False)],
                                           "daily_actions_rank": [("total_actions", False)],
                                           "daily_reach_rank": [("reach", False)]})
    p, o = ["campaign_id"], ["date"]
    mtd = ["campaign_id", F.year("date"), F.month("date")]
    return cp.select(
        "campaign_id", "date", "campaign_name", "campaign_status", "campaign_objective", "spend", "impressions",
        "clicks", "reach", "total_actions", "total_action_value", "ctr_percent", "avg_cpc", "frequency", "roas",
        moving_avg(p, o, "spend", 7).alias("spend_7day_ma"), moving_avg(p, o, "impressions", 7).alias("impressions_7day_ma"),
        moving_avg(p, o, "reach", 7).alias("reach_7day_ma"), moving_avg(p, o, "total_actions", 7).alias("actions_7day_ma"),
        moving_avg(p, o, "ctr_percent", 7).alias("ctr_7day_ma"), moving_avg(p, o, "frequency", 7).alias("frequency_7day_ma"),
        moving_avg(p, o, "spend", 30).alias("spend_30day_ma"),
        moving_avg(p, o, "impressions", 30).alias("impressions_30day_ma"),
        moving_avg(p, o, "total_actions", 30).alias("actions_30day_ma"),
        lag_of(p, o, "spend", 7).alias("spend_last_week"), lag_of(p, o, "reach", 7).alias("reach_last_week"),
        lag_of(p, o, "total_actions", 7).alias("actions_last_week"),
        lag_change_pct(p, o, "spend", 7).alias("spend_wow_change_percent"),
        lag_change_pct(p, o, "reach", 7).alias("reach_wow_change_percent"),
        running_total(mtd, o, "spend").alias("mtd_spend"), running_total(mtd, o, "total_actions").alias("mtd_actions"),
        "daily_spend_rank", "daily_actions_rank", "daily_reach_rank")


def fb_campaign_performance_summary(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    keys = ["campaign_id", "campaign_name", "campaign_status", "campaign_objective", "account_name", "currency_code"]
    g = fb_campaign_performance(t).filter(in_last_days("date", as_of, 30)).groupBy(*keys).agg(
        *_totals(), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count_distinct("date").alias("active_days"))
    return g.select(*keys, "total_spend", "total_impressions", "total_clicks", "total_reach", "total_actions",
                    "total_action_value",
                    *_total_kpis({"frequency": "avg_frequency", "ctr": "avg_ctr", "cpc": "avg_cpc",
                                  "cpa": "avg_cost_per_action", "roas": "avg_roas", "cpp": "avg_cpp"}),
                    "first_date", "last_date", "active_days")


def fb_campaign_objective_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    s = fb_campaign_performance_summary(t, as_of)
    n = F.count_distinct("campaign_id")
    g = s.groupBy("campaign_objective", "account_name").agg(n.alias("campaign_count"), *_resum())
    g = with_group_aggs(g, [], {"_all_spend": F.sum("total_spend"), "_all_actions": F.sum("total_actions")})
    cc = F.col("campaign_count")
    return g.select(
        "campaign_objective", "account_name", "campaign_count", "total_spend", "total_impressions", "total_clicks",
        "total_reach", "total_actions", "total_action_value",
        ratio("total_spend", cc, None, (18, 2), None, cc != 0).alias("avg_spend_per_campaign"),
        ratio("total_actions", cc, None, (10, 2), None, cc != 0).alias("avg_actions_per_campaign"),
        *_total_kpis({"ctr": "ctr_percent", "cpc": "avg_cpc", "cpa": "cost_per_action", "roas": "roas",
                      "frequency": "avg_frequency"}),
        share_pct("total_spend", "_all_spend").alias("pct_of_total_spend"),
        share_pct("total_actions", "_all_actions").alias("pct_of_total_actions"))


# --------------------------------------------------------------------------- ad set
def _adset_attrs(df: DataFrame, t: Tables) -> DataFrame:
    df = attach(df, _latest(t, "adset_history", "adset_id"), "adset_id", {
        "name": "adset_name", "status": "adset_status", "optimization_goal": "optimization_goal",
        "bid_amount": "bid_amount", "targeting": "targeting_spec"})
    df = attach(df, _latest(t, "campaign_history", "campaign_id"), "campaign_id",
                {"name": "campaign_name", "status": "campaign_status", "objective": "campaign_objective"})
    return attach(df, _latest(t, "account_history", "account_id"), "account_id",
                  {"name": "account_name", "currency": "currency_code"})


def fb_adset_performance(t: Tables) -> DataFrame:
    a = _adset_attrs(_rollup(t, ["adset_id", "campaign_id", "account_id"]), t)
    acts = F.coalesce(F.col("actions"), F.lit(0))
    return a.select(
        "adset_id", "campaign_id", "account_id", "date", date_key("date").alias("date_id"), "adset_name",
        "adset_status", "optimization_goal", "bid_amount", "targeting_spec", "campaign_name", "campaign_status",
        "campaign_objective", "account_name", "currency_code", *_row_block(),
        F.when((acts > 0) & (F.col("bid_amount") > 0), F.col("spend") / F.col("actions") - F.col("bid_amount"))
        .cast("decimal(18,4)").alias("cpa_vs_bid_variance"),
        F.col("_fivetran_synced").alias("last_synced_at"))


def fb_adset_drilldown(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    keys = ["account_id", "account_name", "campaign_id", "campaign_name", "campaign_status", "campaign_objective",
            "adset_id", "adset_name", "adset_status", "optimization_goal", "currency_code"]
    # 30-day totals per (ad set, campaign, account) over the daily roll-up (spend rounded per ad
    # set and day, as the view does), then one attribute lookup per ad set; the grouping contains
    # the ids, so this equals grouping the daily view rows
    daily = _rollup(t, ["adset_id", "campaign_id", "account_id"]).filter(in_last_days("date", as_of, 30))
    per_set = daily.groupBy("adset_id", "campaign_id", "account_id").agg(
        F.sum(F.col("spend").cast("decimal(18,2)")).alias("total_spend"), F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"), F.sum("reach").alias("total_reach"),
        F.sum(F.coalesce("actions", F.lit(0))).alias("total_actions"),
        F.sum(F.coalesce("action_values", F.lit(0))).alias("total_action_value"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.lit(1)).alias("active_days"))
    g = _adset_attrs(per_set, t).select(*keys, *[c for c in per_set.columns if c not in keys])
    from ..operators.ranks import dense_ranks_within
    acts, reach, imp = F.col("total_actions"), F.col("total_reach"), F.col("total_impressions")
    cpa = F.col("total_spend") / acts
    freq = imp / reach
    # campaign totals / average as group aggregates joined back; in-campaign ranks size-checked
    g = with_group_aggs(g, ["campaign_id"], {**{f"_camp_{m}": F.sum(f"total_{m}") for m in
                                               ["spend", "clicks", "reach", "actions"]},
                                            "_camp_avg_cpa": F.avg(F.when(acts > 0, cpa))})
    g = dense_ranks_within(g, ["campaign_id"], {"spend_rank_in_campaign": [("total_spend", False)],
                                                "actions_rank_in_campaign": [("total_actions", False)],
                                                "reach_rank_in_campaign": [("total_reach", False)]})
    return g.select(
        concat_safe("account_name", F.lit(" > "), "campaign_name", F.lit(" > "), "adset_name")
        .alias("full_hierarchy_path"),
        *keys, "total_spend", "total_impressions", "total_clicks", "total_reach", "total_actions", "total_action_value",
        *_total_kpis({"frequency": "avg_frequency", "ctr": "ctr_percent", "cpc": "avg_cpc", "cpa": "cost_per_action",
                      "roas": "roas"}),
        *[share_pct(f"total_{m}", f"_camp_{m}").alias(f"pct_of_campaign_{m}")
          for m in ["spend", "clicks", "reach", "actions"]],
        "spend_rank_in_campaign", "actions_rank_in_campaign", "reach_rank_in_campaign",
        rules([((acts > 0) & (cpa < F.col("_camp_avg_cpa")), "Above Average (Efficient Targeting)"),
               (acts > 0, "Below Average")], "No Actions").alias("targeting_effectiveness"),
        rules([((reach > 0) & (freq > 10), "High Frequency - Consider expanding audience"),
               ((reach > 0) & (freq > 5), "Moderate Frequency - Monitor for fatigue"),
               (reach > 0, "Healthy Frequency")], "No Reach Data").alias("frequency_health"),
        "first_date", "last_date", "active_days")


def fb_adset_performance_summary(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Period comparison per ad set joined to distinct attribute rows (derived from the
    distinct hierarchy keys of the fact, names attached to those keys only)."""
    ids = t["fb_basic_ad"].select("adset_id", "campaign_id", "account_id").distinct()
    attrs = _adset_attrs(ids, t).select("adset_id", "adset_name", "adset_status", "optimization_goal",
                                        "campaign_name", "account_name").distinct()
    base = _rollup(t, ["adset_id"]).select(
        "adset_id", "date", F.col("spend").cast("decimal(18,2)").alias("spend"), "impressions", "clicks", "reach",
        F.coalesce(F.col("actions"), F.lit(0)).alias("total_actions"))
    m = ["spend", "impressions", "clicks", "reach", "total_actions"]
    p = period_compare(base, "adset_id", as_of, m)
    prev = {x: F.coalesce(F.col(f"prev_{x}"), F.lit(0)) for x in m}
    cur = {x: F.col(f"cur_{x}") for x in m}
    return attrs.join(p, "adset_id", "inner").select(
        "adset_id", "adset_name", "adset_status", "optimization_goal", "campaign_name", "account_name",
        cur["spend"].alias("current_spend"), cur["impressions"].alias("current_impressions"),
        cur["clicks"].alias("current_clicks"), cur["reach"].alias("current_reach"),
        cur["total_actions"].alias("current_actions"),
        ratio(cur["impressions"], cur["reach"], "1.0", (10, 4)).alias("current_frequency"),
        prev["spend"].alias("previous_spend"), prev["reach"].alias("previous_reach"),
        prev["total_actions"].alias("previous_actions"),
        change_pct(cur["spend"], prev["spend"]).alias("spend_change_percent"),
        change_pct(cur["reach"], prev["reach"]).alias("reach_change_percent"),
        change_pct(cur["total_actions"], prev["total_actions"]).alias("actions_change_percent"))


def fb_adset_optimization_goal_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    d = fb_adset_drilldown(t, as_of)
    g = d.groupBy("optimization_goal", "campaign_objective").agg(
        F.count_distinct("adset_id").alias("adset_count"), *_resum())
    return g.select("*", *_total_kpis({"ctr": "avg_ctr", "cpc": "avg_cpc", "cpa": "avg_cost_per_action",
                                       "roas": "avg_roas", "frequency": "avg_frequency"}))


# --------------------------------------------------------------------------- ad
def creative_type_label(col: str = "creative_type"):
    o = F.col(col)
    return rules([(o == "PHOTO", "Image"), (o == "LINK", "Link"), (o == "VIDEO", "Video"), (o == "STATUS", "Status"),
                  (o == "OFFER", "Offer")], F.coalesce(o, F.lit("Unknown")))


def _fb_ad_attrs(a: DataFrame, t: Tables) -> DataFrame:
    """Latest ad -> creative (chained through the ad), ad set, campaign and account attributes for
    any frame carrying (ad_id, adset_id, campaign_id, account_id)."""
    a = attach(a, _latest(t, "ad_history", "ad_id"), "ad_id",
               {"name": "ad_name", "status": "ad_status", "creative_id": "creative_id"})
    # chained dimension: the creative is reached through the ad's latest version
    a = attach(a, _latest(t, "creative_history", "creative_id"), "creative_id", {
        "name": "creative_name", "title": "creative_title", "body": "creative_body",
        "call_to_action_type": "call_to_action_type", "object_type": "creative_type"})
    a = attach(a, _latest(t, "adset_history", "adset_id"), "adset_id", {"name": "adset_name"})
    a = attach(a, _latest(t, "campaign_history", "campaign_id"), "campaign_id",
               {"name": "campaign_name", "objective": "campaign_objective"})
    a = attach(a, _latest(t, "account_history", "account_id"), "account_id",
               {"name": "account_name", "currency": "currency_code"})
    return a.withColumn("creative_type_label", creative_type_label())


def fb_ad_performance(t: Tables) -> DataFrame:
    a = _fb_ad_attrs(t["fb_basic_ad"], t)
    return a.select(
        "ad_id", "adset_id", "campaign_id", "account_id", "date", date_key("date").alias("date_id"), "ad_name",
        "ad_status", "creative_id", "creative_name", "creative_title", "creative_body", "call_to_action_type",
        "creative_type", "adset_name", "campaign_name", "campaign_objective", "account_name", "currency_code",
        *_row_block(), "creative_type_label",
        F.col("_fivetran_synced").alias("last_synced_at"))


def fb_ad_creative_effectiveness(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    attrs = ["ad_id", "ad_name", "ad_status", "creative_id", "creative_name", "creative_title", "creative_body",
             "call_to_action_type", "creative_type_label", "adset_name", "campaign_name", "campaign_objective",
             "account_name", "currency_code"]
    # 30-day totals per ad id first (the view's per-row values: spend in cents, NULL actions as 0),
    # then one attribute lookup per ad instead of one per ad and day
    ids = ["ad_id", "adset_id", "campaign_id", "account_id"]
    per_ad = t["fb_basic_ad"].filter(in_last_days("date", as_of, 30)).groupBy(*ids).agg(
        F.sum(F.col("spend").cast("decimal(18,2)")).alias("_spend"), F.sum("impressions").alias("_imp"),
        F.sum("clicks").alias("_clicks"), F.sum("reach").alias("_reach"),
        F.sum(F.coalesce("actions", F.lit(0))).alias("_acts"), F.sum(F.coalesce("action_values", F.lit(0))).alias("_vals"),
        F.count_distinct("date").alias("_days"))
    typed = {"_spend": ("total_spend", "decimal(28,2)"), "_imp": ("total_impressions", "long"),
             "_clicks": ("total_clicks", "long"), "_reach": ("total_reach", "long"),
             "_acts": ("total_actions", "decimal(28,6)"), "_vals": ("total_action_value", "decimal(28,6)")}
    g = _fb_ad_attrs(per_ad, t).groupBy(*attrs).agg(
        *[F.sum(k).cast(tp).alias(n) for k, (n, tp) in typed.items()],
        F.sum("_days").alias("active_days")).filter(F.col("total_impressions") > 0)
    imp, clk, acts = F.col("total_impressions"), F.col("total_clicks"), F.col("total_actions")
    sp, val, reach = F.col("total_spend"), F.col("total_action_value"), F.col("total_reach")
    ctr_raw = F.when(imp > 0, clk * F.lit(100).cast("decimal(3,0)") / imp).otherwise(F.lit(0))
    g = with_group_aggs(g.withColumn("_ctr_raw", ctr_raw), [], {"_avg_ctr": F.avg("_ctr_raw")})
    roas_raw = F.when(sp > 0, val / sp).otherwise(F.lit(0))
    tier = rules([((acts >= 10) & (roas_raw >= 2), "Top Performer"),
                  ((acts >= 5) & (F.col("_ctr_raw") >= F.col("_avg_ctr")), "Above Average"),
                  ((clk > 0) & (acts == 0), "Clicks but No Actions"),
                  ((imp > 0) & (clk == 0), "Impressions but No Clicks")], "Developing")
    suggestion = rules([
        ((reach > 0) & (imp / reach > 8), "High frequency - audience may be fatigued"),
        ((imp > 0) & (clk * F.lit(100).cast("decimal(3,0)") / imp < F.lit(0.5).cast("decimal(2,1)")),
         "Low CTR - test new creative"),
        ((clk > 0) & (acts == 0), "Good clicks but no conversions - check landing page"),
        ((acts > 0) & (sp > 0) & (val / sp < 1), "ROAS below 1 - optimize or pause")], "Performance acceptable")
    from ..operators.ranks import dense_ranks_within
    g = g.withColumn("_ctr_key", F.when(imp > 0, clk / imp).otherwise(F.lit(0)))
    g = dense_ranks_within(g, ["adset_name"], {"clicks_rank_in_adset": [("total_clicks", False)],
                                               "actions_rank_in_adset": [("total_actions", False)],
                                               "ctr_rank_in_adset": [("_ctr_key", False)]})
    return g.select(
        "ad_id", "ad_name", "ad_status", "creative_id", "creative_name", "creative_type_label", "call_to_action_type",
        "adset_name", "campaign_name", "campaign_objective", "account_name", "currency_code",
        left(F.coalesce("creative_title", F.lit("")), 100).alias("creative_title_preview"),
        left(F.coalesce("creative_body", F.lit("")), 150).alias("creative_body_preview"),
        "total_spend", "total_impressions", "total_clicks", "total_reach", "total_actions", "total_action_value",
        "active_days",
        *_total_kpis({"frequency": "avg_frequency", "ctr": "ctr_percent", "cpc": "avg_cpc", "cpa": "cost_per_action",
                      "roas": "roas"}),
        "clicks_rank_in_adset", "actions_rank_in_adset", "ctr_rank_in_adset",
        tier.alias("performance_tier"), suggestion.alias("optimization_suggestion"))


def fb_ad_creative_type_comparison(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    c = fb_ad_creative_effectiveness(t, as_of)
    g = c.groupBy("creative_type_label", "call_to_action_type", "account_name").agg(
        F.count_distinct("ad_id").alias("ad_count"), F.count_distinct("adset_name").alias("adsets_with_type"),
        F.count_distinct("campaign_name").alias("campaigns_with_type"), *_resum())
    n = F.col("ad_count")
    return g.select(
        "creative_type_label", "call_to_action_type", "account_name", "ad_count", "adsets_with_type",
        "campaigns_with_type", "total_spend", "total_impressions", "total_clicks", "total_reach", "total_actions",
        "total_action_value",
        ratio("total_spend", n, None, (18, 2), None, n != 0).alias("avg_spend_per_ad"),
        ratio("total_actions", n, None, (10, 2), None, n != 0).alias("avg_actions_per_ad"),
        *_total_kpis({"frequency": "avg_frequency", "ctr": "ctr_percent", "cpc": "avg_cpc", "cpa": "cost_per_action",
                      "roas": "roas"}))


def fb_ad_cta_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    c = fb_ad_creative_effectiveness(t, as_of).filter(F.col("call_to_action_type").isNotNull())
    g = c.groupBy("call_to_action_type", "campaign_objective").agg(
        F.count_distinct("ad_id").alias("ad_count"), F.sum("total_spend").alias("total_spend"),
        F.sum("total_impressions").alias("total_impressions"), F.sum("total_clicks").alias("total_clicks"),
        F.sum("total_actions").alias("total_actions"), F.sum("total_action_value").alias("total_action_value"))
    imp, clk, acts = F.col("total_impressions"), F.col("total_clicks"), F.col("total_actions")
    g = g.select(
        "*", *_total_kpis({"ctr": "avg_ctr", "cpc": "avg_cpc", "cpa": "avg_cost_per_action", "roas": "avg_roas"}),
        F.when(imp > 0, clk / imp).otherwise(F.lit(0)).alias("_ctr_key"),
        F.when(clk > 0, acts.cast("double") / clk.cast("double")).otherwise(F.lit(0.0)).alias("_cvr_key"))
    g = global_dense_ranks(g, {"ctr_rank": [("_ctr_key", False)], "conversion_rate_rank": [("_cvr_key", False)]})
    return g.drop("_ctr_key", "_cvr_key")


# --------------------------------------------------------------------------- insight templates
def _insights_base(t: Tables) -> DataFrame:
    a = t["fb_basic_ad"]
    a = attach(a, _latest(t, "ad_history", "ad_id"), "ad_id", {"name": "ad_name"})
    a = attach(a, _latest(t, "adset_history", "adset_id"), "adset_id", {"name": "adset_name"})
    a = attach(a, _latest(t, "campaign_history", "campaign_id"), "campaign_id",
               {"name": "campaign_name", "objective": "campaign_objective"})
    return attach(a, _latest(t, "account_history", "account_id"), "account_id",
                  {"name": "account_name", "currency": "currency_code"})


def _insight_kpis() -> list:
    acts = F.coalesce(F.col("actions"), F.lit(0))
    vals = F.coalesce(F.col("action_values"), F.lit(0))
    return [F.col("spend").cast("decimal(18,2)").alias("spend"), "impressions", "clicks", "reach",
            acts.alias("total_actions"), vals.alias("total_action_value"),
            ratio("clicks", "impressions", "100.0", (10, 4)).alias("ctr_percent"),
            ratio("spend", "clicks", None, (18, 4)).alias("avg_cpc"),
            ratio("spend", "actions", None, (18, 4), guard=acts > 0).alias("cost_per_action"),
            ratio(vals, "spend", None, (10, 4)).alias("roas")]


def fb_insights_demographics(t: Tables) -> DataFrame:
    """Ad x date x age x gender (template view; needs the optional breakdown columns)."""
    a = _insights_base(t).filter(F.col("age").isNotNull() | F.col("gender").isNotNull())
    return a.select("ad_id", "adset_id", "campaign_id", "account_id", "date", date_key("date").alias("date_id"),
                    F.col("age").alias("age_range"), "gender", "ad_name", "adset_name", "campaign_name",
                    "campaign_objective", "account_name", "currency_code", *_insight_kpis(),
                    F.col("_fivetran_synced").alias("last_synced_at"))


def fb_insights_placements(t: Tables) -> DataFrame:
    """Ad x date x placement / device (template view; needs the optional breakdown columns)."""
    a = _insights_base(t).filter(F.col("publisher_platform").isNotNull() | F.col("platform_position").isNotNull())
    return a.select("ad_id", "adset_id", "campaign_id", "account_id", "date", date_key("date").alias("date_id"),
                    "publisher_platform", "platform_position", "impression_device", "device_platform",
                    F.concat(F.coalesce("publisher_platform", F.lit("Unknown")), F.lit(" - "),
                             F.coalesce("platform_position", F.lit("Unknown"))).alias("placement_label"),
                    "ad_name", "adset_name", "campaign_name", "campaign_objective", "account_name", "currency_code",
                    *_insight_kpis(), ratio("spend", "impressions", "1000.0", (18, 4)).alias("avg_cpm"),
                    F.col("_fivetran_synced").alias("last_synced_at"))


# --------------------------------------------------------------------------- dashboard queries
def q_fb_executive(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    a = fb_account_performance(t).filter(in_last_days("date", as_of, 60))
    cur = in_last_days("date", as_of, 30)

    def s(c):
        return F.sum(F.when(cur, F.col(c)).otherwise(F.lit(0)))

    return a.groupBy("account_name", "currency_code").agg(
        s("spend").alias("current_spend"), s("impressions").alias("current_impressions"),
        s("reach").alias("current_reach"), s("total_actions").alias("current_actions"))


def q_fb_daily_trend(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    a = fb_account_performance(t).filter(in_last_days("date", as_of, 90))
    g = a.groupBy("date").agg(F.sum("spend").alias("daily_spend"), F.sum("impressions").alias("daily_impressions"),
                              F.sum("reach").alias("daily_reach"), F.sum("total_actions").alias("daily_actions"),
                              F.sum("clicks").alias("_clicks"))
    return g.select("date", F.date_format("date", "EEEE").alias("day_name"), "daily_spend", "daily_impressions",
                    "daily_reach", "daily_actions",
                    ratio("_clicks", "daily_impressions", "100.0", (10, 4)).alias("daily_ctr")).orderBy("date")


def q_fb_campaign_matrix(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return fb_campaign_performance_summary(t, as_of).filter(F.col("total_spend") > 0).select(
        "campaign_name", "campaign_status", "campaign_objective", "total_spend", "total_reach", "total_actions",
        "total_action_value", "avg_ctr", "avg_cpc", "avg_cost_per_action", "avg_roas", "avg_frequency")


def q_fb_adset_overview(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return fb_adset_drilldown(t, as_of).filter(F.col("total_spend") > 0).select(
        "adset_name", "campaign_name", "optimization_goal", "total_spend", "total_reach", "total_actions",
        "avg_frequency", "ctr_percent", "cost_per_action", "roas")


def q_fb_creative(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    return fb_ad_creative_effectiveness(t, as_of).filter(F.col("total_impressions") > 100).select(
        "ad_name", "creative_type_label", "call_to_action_type", "total_spend", "total_clicks", "total_actions",
        "ctr_percent", "cost_per_action", "roas")


# --------------------------------------------------------------------------- breakdown summaries
# The source only names these views (bodies elided); definitions here: aggregate the breakdown
# template rows by the breakdown keys with the standard social KPIs.
def _breakdown(df: DataFrame, keys: list[str]) -> DataFrame:
    g = df.groupBy(*keys).agg(
        F.sum("spend").alias("total_spend"), F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"), F.sum("reach").alias("total_reach"),
        F.sum("total_actions").alias("total_actions"), F.sum("total_action_value").alias("total_action_value"))
    return g.select("*", *_total_kpis({"ctr": "avg_ctr", "cpa": "avg_cost_per_action", "roas": "avg_roas"}),
                    ratio("total_spend", "total_impressions", "1000.0", (18, 4)).alias("avg_cpm"))


def fb_demographic_summary(t: Tables) -> DataFrame:
    """Age x gender totals with a cost-efficiency rank (cheapest cost per action = 1; groups
    without actions rank last)."""
    g = _breakdown(fb_insights_demographics(t), ["age_range", "gender"])
    key = F.when(F.col("total_actions") > 0, F.col("avg_cost_per_action"))
    g = global_dense_ranks(g.withColumn("_cpa_key", key), {"cost_efficiency_rank": [("_cpa_key", True)]})
    return g.drop("_cpa_key")


def fb_placement_summary(t: Tables) -> DataFrame:
    """Platform x position totals; recommendation compares each placement's cost per action
    with the all-placement cost per action (one-row aggregate joined back)."""
    g = _breakdown(fb_insights_placements(t), ["publisher_platform", "platform_position"])
    g = with_group_aggs(g, [], {"_all_spend": F.sum("total_spend"), "_all_actions": F.sum("total_actions")})
    overall = ratio("_all_spend", "_all_actions", None, (18, 4))
    rec = rules([(F.col("total_actions") == 0, "No conversions - review placement"),
                 (F.col("avg_cost_per_action") <= overall, "Scale placement")], "Optimize or reduce spend")
    return g.withColumn("placement_recommendation", rec).drop("_all_spend", "_all_actions")


def fb_device_performance(t: Tables) -> DataFrame:
    return _breakdown(fb_insights_placements(t), ["impression_device", "device_platform"])


GENDERS = ["male", "female", "unknown"]


def fb_age_gender_matrix(t: Tables) -> DataFrame:
    """Spend by age (rows) x gender (columns): the platform's fixed set, and one column for any other
    or no gender, so that the columns add up to the age's spend."""
    d = fb_insights_demographics(t)
    listed = F.coalesce(F.col("gender").isin(GENDERS), F.lit(False))
    return d.groupBy("age_range").agg(*[F.sum(F.when(F.col("gender") == g, F.col("spend"))).alias(f"{g}_spend") for g in GENDERS],
                                      F.sum(F.when(~listed, F.col("spend"))).alias("other_spend"))


def q_fb_demographic(t: Tables) -> DataFrame:
    return fb_demographic_summary(t).select("age_range", "gender", "total_spend", "total_actions", "avg_ctr",
                                            "avg_cost_per_action", "avg_roas", "cost_efficiency_rank")


def q_fb_placement(t: Tables) -> DataFrame:
    return fb_placement_summary(t).select("publisher_platform", "platform_position", "total_spend",
                                          "total_impressions", "total_actions", "avg_ctr", "avg_cpm",
                                          "avg_cost_per_action", "placement_recommendation")
