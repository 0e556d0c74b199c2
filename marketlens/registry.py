"""Name -> plan registry (one key per named analytic and per primitive family)."""
from __future__ import annotations

from collections.abc import Callable
from functools import partial, update_wrapper
from inspect import signature

from pyspark.sql import DataFrame

from .plans import search_ads as sa
from .plans import time_periods as tp
from .plans import search_dashboards as sd
from .plans import social_ads as fb
from .plans import crm
from .plans import email
from .plans import engagements as eng
from .plans import crm_dashboards as cd
from .plans import measures as ms
from .plans import report as rq
from .plans import insights as ins
from .plans import primitives as pr
from .plans import model as md
from .plans import drilldown as dd
from .plans import deliveries as dv
from .plans import slicers as sl
from .sources.catalog import Tables
from .sources.roles import ADS_AS_OF, CRM_AS_OF, LONG_AS_OF

#: Plans default to the current date; the driver's tables end at fixed dates, bound here and only here.
_ADS_MODULES = {m.__name__ for m in (sa, tp, sd, fb, pr)}
_ADS_PLANS = {"m_ads_daily_measures", "q_kpi_benchmarks_search", "q_kpi_benchmarks_social", "q_campaign_summary_sliced",
              "rq_campaigns_of_quarter", "q_ad_hierarchy", "q_sliced_executive"}
_LONG_PLANS = {"q_weekly_wow_yoy_long", "q_monthly_mom_yoy_long"}


def _dated(name: str, fn: Callable[..., DataFrame]) -> Callable[[Tables], DataFrame]:
    if "as_of" not in signature(fn).parameters:
        return fn
    ads = fn.__module__ in _ADS_MODULES or name in _ADS_PLANS
    return update_wrapper(partial(fn, as_of=LONG_AS_OF if name in _LONG_PLANS else ADS_AS_OF if ads else CRM_AS_OF), fn)


_PLANS: dict[str, Callable[..., DataFrame]] = {
    "campaign_performance": sa.campaign_performance,
    "campaign_performance_summary": sa.campaign_performance_summary,
    "campaign_trend_analysis": sa.campaign_trend_analysis,
    "account_performance": sa.account_performance,
    "account_performance_summary": sa.account_performance_summary,
    "ad_group_performance": sa.ad_group_performance,
    "ad_group_drilldown": sa.ad_group_drilldown,
    "ad_group_performance_summary": sa.ad_group_performance_summary,
    "keyword_performance": sa.keyword_performance,
    "keyword_top_performers": sa.keyword_top_performers,
    "keyword_quality_score_analysis": sa.keyword_quality_score_analysis,
    "keyword_match_type_analysis": sa.keyword_match_type_analysis,
    "ad_performance": sa.ad_performance,
    "ad_copy_effectiveness": sa.ad_copy_effectiveness,
    "ad_strength_analysis": sa.ad_strength_analysis,
    "ad_type_comparison": sa.ad_type_comparison,
    "date_dimension": tp.date_dimension,
    "q_weekly_wow_yoy": tp.q_weekly_wow_yoy,
    "q_monthly_mom_yoy": tp.q_monthly_mom_yoy,
    "q_weekly_wow_yoy_long": tp.q_weekly_wow_yoy_long,
    "q_monthly_mom_yoy_long": tp.q_monthly_mom_yoy_long,
    "q_day_of_week": tp.q_day_of_week,
    "q_executive_metrics": sd.q_executive_metrics,
    "q_daily_trend": sd.q_daily_trend,
    "q_campaign_matrix": sd.q_campaign_matrix,
    "q_budget_pacing": sd.q_budget_pacing,
    "q_conversion_funnel": sd.q_conversion_funnel,
    "fb_account_performance": fb.fb_account_performance,
    "fb_account_performance_summary": fb.fb_account_performance_summary,
    "fb_campaign_performance": fb.fb_campaign_performance,
    "fb_campaign_trend_analysis": fb.fb_campaign_trend_analysis,
    "fb_campaign_performance_summary": fb.fb_campaign_performance_summary,
    "fb_campaign_objective_analysis": fb.fb_campaign_objective_analysis,
    "fb_adset_performance": fb.fb_adset_performance,
    "fb_adset_drilldown": fb.fb_adset_drilldown,
    "fb_adset_performance_summary": fb.fb_adset_performance_summary,
    "fb_adset_optimization_goal_analysis": fb.fb_adset_optimization_goal_analysis,
    "fb_ad_performance": fb.fb_ad_performance,
    "fb_ad_creative_effectiveness": fb.fb_ad_creative_effectiveness,
    "fb_ad_creative_type_comparison": fb.fb_ad_creative_type_comparison,
    "fb_ad_cta_analysis": fb.fb_ad_cta_analysis,
    "fb_insights_demographics": fb.fb_insights_demographics,
    "fb_insights_placements": fb.fb_insights_placements,
    "q_fb_executive": fb.q_fb_executive,
    "q_fb_daily_trend": fb.q_fb_daily_trend,
    "q_fb_campaign_matrix": fb.q_fb_campaign_matrix,
    "q_fb_adset_overview": fb.q_fb_adset_overview,
    "q_fb_creative": fb.q_fb_creative,
    "contact_performance": crm.contact_performance,
    "contact_lifecycle_funnel": crm.contact_lifecycle_funnel,
    "contact_source_performance": crm.contact_source_performance,
    "contact_owner_performance": crm.contact_owner_performance,
    "company_performance": crm.company_performance,
    "company_industry_analysis": crm.company_industry_analysis,
    "company_geography_analysis": crm.company_geography_analysis,
    "company_owner_performance": crm.company_owner_performance,
    "deal_performance": crm.deal_performance,
    "deal_pipeline_summary": crm.deal_pipeline_summary,
    "deal_stage_conversion": crm.deal_stage_conversion,
    "deal_owner_performance": crm.deal_owner_performance,
    "deal_forecast": crm.deal_forecast,
    "email_performance": email.email_performance,
    "email_daily_metrics": email.email_daily_metrics,
    "email_bounce_analysis": email.email_bounce_analysis,
    "email_link_performance": email.email_link_performance,
    "email_engagement_by_time": email.email_engagement_by_time,
    "email_recipient_engagement": email.email_recipient_engagement,
    "engagement_performance": eng.engagement_performance,
    "engagement_daily_summary": eng.engagement_daily_summary,
    "engagement_owner_summary": eng.engagement_owner_summary,
    "engagement_type_analysis": eng.engagement_type_analysis,
    "call_analysis": eng.call_analysis,
    "meeting_analysis": eng.meeting_analysis,
    "engagement_daily_summary_dedup": eng.engagement_daily_summary_dedup,
    "engagement_owner_summary_dedup": eng.engagement_owner_summary_dedup,
    "engagement_type_analysis_dedup": eng.engagement_type_analysis_dedup,
    "call_analysis_dedup": eng.call_analysis_dedup,
    "meeting_analysis_dedup": eng.meeting_analysis_dedup,
    "q_crm_executive": cd.q_crm_executive,
    "q_pipeline_health": cd.q_pipeline_health,
    "q_deals_at_risk": cd.q_deals_at_risk,
    "q_sales_forecast": cd.q_sales_forecast,
    "q_contact_funnel": cd.q_contact_funnel,
    "q_engagement_trend": cd.q_engagement_trend,
    "q_email_dashboard": cd.q_email_dashboard,
    "q_owner_leaderboard": cd.q_owner_leaderboard,
    "q_company_insights": cd.q_company_insights,
    "q_source_attribution": cd.q_source_attribution,
    "q_cross_channel": cd.q_cross_channel,
    "m_contact_measures": ms.m_contact_measures,
    "m_deal_measures": ms.m_deal_measures,
    "m_contact_measures_by_stage": ms.m_contact_measures_by_stage,
    "m_deal_measures_by_status": ms.m_deal_measures_by_status,
    "m_email_measures": ms.m_email_measures,
    "m_engagement_measures": ms.m_engagement_measures,
    "m_ads_daily_measures": ms.m_ads_daily_measures,
    "m_spend_time_intelligence": ms.m_spend_time_intelligence,
    "m_ads_time_intelligence": ms.m_ads_time_intelligence,
    "rq_stage_counts": rq.rq_stage_counts,
    "rq_engagement_line": rq.rq_engagement_line,
    "rq_contacts_by_lifecycle": rq.rq_contacts_by_lifecycle,
    "rq_contacts_by_company_health": rq.rq_contacts_by_company_health,
    "rq_deals_of_winning_owners": rq.rq_deals_of_winning_owners,
    "rq_contacts_by_source": rq.rq_contacts_by_source,
    "rq_contact_owner_table": rq.rq_contact_owner_table,
    "rq_pipeline_funnel": rq.rq_pipeline_funnel,
    "rq_owner_deals_table": rq.rq_owner_deals_table,
    "rq_deal_table": rq.rq_deal_table,
    "rq_email_table": rq.rq_email_table,
    "rq_sent_by_tier": rq.rq_sent_by_tier,
    "rq_engagement_by_weekday": rq.rq_engagement_by_weekday,
    "rq_owner_engagement_table": rq.rq_owner_engagement_table,
    "q_kpi_benchmarks_search": ins.q_kpi_benchmarks_search,
    "q_kpi_benchmarks_social": ins.q_kpi_benchmarks_social,
    "q_email_deliverability_alerts": ins.q_email_deliverability_alerts,
    "q_deal_velocity": ins.q_deal_velocity,
    "q_deal_benchmarks": ins.q_deal_benchmarks,
    "q_rls_campaign_performance": ins.q_rls_campaign_performance,
    "q_campaign_summary_sliced": ins.q_campaign_summary_sliced,
    "q_cross_platform_daily": ins.q_cross_platform_daily,
    "q_hour_of_day": ins.q_hour_of_day,
    "fb_demographic_summary": fb.fb_demographic_summary,
    "fb_placement_summary": fb.fb_placement_summary,
    "fb_device_performance": fb.fb_device_performance,
    "fb_age_gender_matrix": fb.fb_age_gender_matrix,
    "q_fb_demographic": fb.q_fb_demographic,
    "q_fb_placement": fb.q_fb_placement,
    "q_top_keywords": sa.q_top_keywords,
    "p_latest_by_key_search": pr.p_latest_by_key_search,
    "p_latest_by_key_social": pr.p_latest_by_key_social,
    "p_datediff_boundaries": pr.p_datediff_boundaries,
    "p_global_ranks": pr.p_global_ranks,
    "p_shares": pr.p_shares,
    "p_row_windows": pr.p_row_windows,
    "p_scan_windows": pr.p_scan_windows,
    "m_deal_measures_by_closed": ms.m_deal_measures_by_closed,
    "rq_ad_groups_of_accounts": md.rq_ad_groups_of_accounts,
    "rq_campaigns_of_quarter": md.rq_campaigns_of_quarter,
    "rq_forecast_of_winning_owners": md.rq_forecast_of_winning_owners,
    "q_sliced_executive": sl.q_sliced_executive,
    "q_sliced_keywords": sl.q_sliced_keywords,
    "q_sliced_lifecycle": sl.q_sliced_lifecycle,
    "q_sliced_activity": sl.q_sliced_activity,
    "rq_companies_by_status": rq.rq_companies_by_status,
    "rq_forecast_by_period": rq.rq_forecast_by_period,
    "rq_deals_by_status": rq.rq_deals_by_status,
    "q_imported_campaign_days": dv.q_imported_campaign_days,
    "q_maintained_channel_days": dv.q_maintained_channel_days,
    "q_ad_hierarchy": dd.q_ad_hierarchy,
    "q_contacts_engaged_ranges": dd.q_contacts_engaged_ranges,
}

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {name: _dated(name, fn) for name, fn in _PLANS.items()}
