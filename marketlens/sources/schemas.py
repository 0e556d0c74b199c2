"""Declared schemas of the synced source tables (search ads, social ads, CRM).

Names drop the schema prefix; the social tables carry ``fb_`` to keep them apart from
the search-ads tables of the same name.  Money is decimal, counts are long, sync
timestamps are zone-less.
"""
from __future__ import annotations

from pyspark.sql import types as T

L, I, S, B, D = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.DateType()
TS = T.TimestampNTZType()
M6 = T.DecimalType(18, 6)   # spend / conversions
M2 = T.DecimalType(18, 2)   # CRM amounts
R6 = T.DecimalType(10, 6)   # rates / shares
P2 = T.DecimalType(5, 2)    # probabilities 0..100


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


def _hist(*cols) -> T.StructType:
    return _st(*cols, ("_fivetran_synced", TS), ("_fivetran_deleted", B))


def _tbl(*cols) -> T.StructType:
    return _st(*cols, ("_fivetran_synced", TS))


_METRICS = [("spend", M6), ("impressions", L), ("clicks", L), ("conversions", M6), ("conversions_value", M6)]

SCHEMAS: dict[str, T.StructType] = {
    # ---- search ads
    "account_history": _hist(("account_id", L), ("descriptive_name", S), ("currency_code", S), ("time_zone", S),
                             ("auto_tagging_enabled", B), ("manager", B), ("test_account", B)),
    "account_stats": _tbl(("account_id", L), ("date", D), *_METRICS, ("view_through_conversions", M6),
                          ("interactions", L), ("interaction_event_types", S)),
    "campaign_history": _hist(("campaign_id", L), ("account_id", L), ("name", S), ("status", S),
                              ("advertising_channel_type", S), ("advertising_channel_sub_type", S),
                              ("bidding_strategy_type", S), ("start_date", D), ("end_date", D), ("budget_amount", M6),
                              ("budget_period", S), ("serving_status", S), ("ad_serving_optimization_status", S)),
    "campaign_stats": _tbl(("campaign_id", L), ("account_id", L), ("date", D), *_METRICS,
                           ("view_through_conversions", M6), ("video_views", L), ("video_quartile_p25_rate", R6),
                           ("video_quartile_p50_rate", R6), ("video_quartile_p75_rate", R6),
                           ("video_quartile_p100_rate", R6), ("interactions", L), ("interaction_event_types", S)),
    "ad_group_history": _hist(("ad_group_id", L), ("campaign_id", L), ("name", S), ("status", S), ("type", S),
                              ("cpc_bid_micros", L), ("cpm_bid_micros", L), ("target_cpa_micros", L),
                              ("effective_target_cpa_micros", L), ("effective_target_roas", R6)),
    "ad_group_stats": _tbl(("ad_group_id", L), ("campaign_id", L), ("account_id", L), ("date", D), *_METRICS,
                           ("view_through_conversions", M6), ("interactions", L)),
    "ad_history": _hist(("ad_id", L), ("ad_group_id", L), ("type", S), ("status", S), ("device_preference", S),
                        ("ad_strength", S), ("display_url", S), ("final_urls", S), ("final_mobile_urls", S),
                        ("responsive_search_ad_headlines", S), ("responsive_search_ad_descriptions", S),
                        ("responsive_search_ad_path1", S), ("responsive_search_ad_path2", S),
                        ("expanded_text_ad_headline_part1", S), ("expanded_text_ad_headline_part2", S),
                        ("expanded_text_ad_headline_part3", S), ("expanded_text_ad_description", S),
                        ("expanded_text_ad_description2", S), ("expanded_text_ad_path1", S),
                        ("expanded_text_ad_path2", S)),
    "ad_stats": _tbl(("ad_id", L), ("ad_group_id", L), ("campaign_id", L), ("account_id", L), ("date", D), *_METRICS,
                     ("interactions", L), ("video_views", L), ("video_quartile_p100_rate", R6)),
    "ad_group_criterion_history": _hist(("criterion_id", L), ("ad_group_id", L), ("type", S), ("status", S),
                                        ("keyword_text", S), ("keyword_match_type", S), ("system_serving_status", S),
                                        ("approval_status", S), ("quality_score", I), ("creative_quality_score", S),
                                        ("post_click_quality_score", S), ("search_predicted_ctr", S),
                                        ("cpc_bid_micros", L), ("effective_cpc_bid_micros", L),
                                        ("final_url_suffix", S)),
    "keyword_stats": _tbl(("criterion_id", L), ("ad_group_id", L), ("campaign_id", L), ("account_id", L), ("date", D),
                          *_METRICS, ("search_impression_share", R6), ("search_top_impression_share", R6),
                          ("search_absolute_top_impression_share", R6), ("search_rank_lost_impression_share", R6),
                          ("search_budget_lost_impression_share", R6)),
    # ---- social ads
    "fb_basic_ad": _tbl(("ad_id", L), ("adset_id", L), ("campaign_id", L), ("account_id", L), ("date", D),
                        ("spend", M6), ("impressions", L), ("clicks", L), ("reach", L), ("actions", M6),
                        ("action_values", M6), ("age", S), ("gender", S), ("publisher_platform", S),
                        ("platform_position", S), ("impression_device", S), ("device_platform", S)),
    "fb_account_history": _hist(("account_id", L), ("name", S), ("account_status", S), ("currency", S),
                                ("timezone_name", S)),
    "fb_campaign_history": _hist(("campaign_id", L), ("account_id", L), ("name", S), ("status", S), ("objective", S),
                                 ("daily_budget", M6), ("lifetime_budget", M6)),
    "fb_adset_history": _hist(("adset_id", L), ("name", S), ("status", S), ("targeting", S),
                              ("optimization_goal", S), ("bid_amount", M6)),
    "fb_ad_history": _hist(("ad_id", L), ("name", S), ("status", S), ("creative_id", L)),
    "fb_creative_history": _hist(("creative_id", L), ("name", S), ("title", S), ("body", S),
                                 ("call_to_action_type", S), ("object_type", S)),
    # ---- CRM
    "owner": _tbl(("owner_id", L), ("email", S), ("first_name", S), ("last_name", S), ("type", S),
                  ("created_at", TS), ("updated_at", TS), ("_fivetran_deleted", B)),
    "company": _tbl(("company_id", L), ("name", S), ("domain", S), ("industry", S), ("type", S), ("phone", S),
                    ("city", S), ("state", S), ("country", S), ("postal_code", S), ("owner_id", L),
                    ("lifecycle_stage", S), ("lead_status", S), ("num_employees", S), ("annual_revenue", M2),
                    ("total_revenue", M2), ("num_associated_contacts", I), ("num_associated_deals", I),
                    ("created_at", TS), ("updated_at", TS), ("last_activity_date", D), ("last_contacted", TS),
                    ("hs_analytics_source", S), ("hs_analytics_num_page_views", I),
                    ("hs_analytics_num_visits", I), ("_fivetran_deleted", B)),
    "contact": _tbl(("contact_id", L), ("email", S), ("first_name", S), ("last_name", S), ("phone", S),
                    ("company", S), ("job_title", S), ("lifecycle_stage", S), ("lead_status", S), ("owner_id", L),
                    ("associated_company_id", L), ("created_at", TS), ("updated_at", TS),
                    ("last_activity_date", D), ("last_contacted", TS), ("num_associated_deals", I),
                    ("total_revenue", M2), ("hs_analytics_source", S), ("hs_analytics_source_data_1", S),
                    ("hs_analytics_source_data_2", S), ("hs_analytics_first_url", S),
                    ("hs_analytics_num_page_views", I), ("hs_analytics_num_visits", I),
                    ("hs_analytics_num_event_completions", I), ("hs_email_optout", B), ("hs_email_bounce", B),
                    ("hs_email_quarantined", B), ("_fivetran_deleted", B)),
    "deal": _tbl(("deal_id", L), ("deal_name", S), ("pipeline_id", S), ("pipeline_stage_id", S), ("deal_stage", S),
                 ("deal_type", S), ("amount", M2), ("deal_currency_code", S), ("close_date", D), ("create_date", TS),
                 ("owner_id", L), ("associated_company_id", L), ("associated_contact_id", L), ("is_closed", B),
                 ("is_closed_won", B), ("days_to_close", I), ("hs_analytics_source", S),
                 ("hs_deal_stage_probability", P2), ("hs_projected_amount", M2), ("hs_acv", M2), ("hs_arr", M2),
                 ("hs_mrr", M2), ("hs_tcv", M2), ("num_contacted_notes", I), ("num_notes", I), ("_fivetran_deleted", B)),
    "deal_stage": _tbl(("stage_id", S), ("pipeline_id", S), ("label", S), ("display_order", I), ("probability", P2),
                       ("is_closed", B), ("is_closed_won", B), ("created_at", TS), ("updated_at", TS),
                       ("_fivetran_deleted", B)),
    "deal_pipeline": _tbl(("pipeline_id", S), ("label", S), ("display_order", I), ("created_at", TS),
                          ("updated_at", TS), ("_fivetran_deleted", B)),
    "deal_stage_history": _tbl(("deal_id", L), ("stage_id", S), ("timestamp", TS), ("pipeline_id", S),
                               ("source", S), ("source_id", S)),
    "email_campaign": _tbl(("campaign_id", L), ("app_id", L), ("app_name", S), ("content_id", L), ("subject", S),
                           ("name", S), ("type", S), ("num_included", I), ("num_queued", I), ("_fivetran_deleted", B)),
    "email_event": _tbl(("event_id", S), ("email_campaign_id", L), ("recipient", S), ("type", S),
                        ("created_at", TS), ("sent_by_created_at", TS), ("app_id", L), ("portal_id", L),
                        ("browser_name", S), ("browser_version", S), ("device_type", S), ("location_city", S),
                        ("location_state", S), ("location_country", S), ("url", S), ("link_id", L),
                        ("user_agent", S), ("ip_address", S), ("duration", I), ("response", S),
                        ("bounce_category", S), ("drop_reason", S), ("drop_message", S), ("subscription_id", L),
                        ("caused_by_event_id", S)),
    "contact_list": _tbl(("contact_list_id", L), ("name", S), ("dynamic", B), ("created_at", TS), ("updated_at", TS),
                         ("list_size", I), ("_fivetran_deleted", B)),
    "contact_list_member": _tbl(("contact_id", L), ("contact_list_id", L), ("added_at", TS), ("_fivetran_deleted", B)),
    "email_event_sent": _tbl(("event_id", S), ("from_email", S), ("bcc", S), ("cc", S), ("reply_to", S), ("subject", S)),
    "email_event_open": _tbl(("event_id", S), ("browser", S), ("ip_address", S), ("location", S), ("user_agent", S),
                             ("duration", I)),
    "engagement_note": _tbl(("engagement_id", L), ("body", S)),
    "email_event_bounce": _tbl(("event_id", S), ("category", S), ("response", S), ("status", S)),
    "email_event_click": _tbl(("event_id", S), ("url", S), ("browser", S), ("ip_address", S), ("location", S),
                              ("user_agent", S)),
    "engagement": _tbl(("engagement_id", L), ("type", S), ("created_at", TS), ("last_updated", TS),
                       ("timestamp", TS), ("owner_id", L), ("portal_id", L), ("active", B), ("_fivetran_deleted", B)),
    "engagement_contact": _tbl(("engagement_id", L), ("contact_id", L)),
    "engagement_company": _tbl(("engagement_id", L), ("company_id", L)),
    "engagement_deal": _tbl(("engagement_id", L), ("deal_id", L)),
    "engagement_call": _tbl(("engagement_id", L), ("body", S), ("disposition", S), ("duration_milliseconds", L),
                            ("external_account_id", S), ("external_id", S), ("from_number", S), ("to_number", S),
                            ("recording_url", S), ("status", S)),
    "engagement_meeting": _tbl(("engagement_id", L), ("body", S), ("title", S), ("start_time", TS),
                               ("end_time", TS), ("internal_meeting_notes", S), ("external_url", S),
                               ("meeting_outcome", S)),
    "engagement_email": _tbl(("engagement_id", L), ("body", S), ("subject", S), ("from_email", S),
                             ("from_first_name", S), ("from_last_name", S), ("to_email", S), ("cc_email", S),
                             ("bcc_email", S), ("sender_email", S), ("tracker_key", S)),
    "engagement_task": _tbl(("engagement_id", L), ("body", S), ("subject", S), ("status", S),
                            ("for_object_type", S), ("task_type", S), ("priority", S), ("completion_date", TS)),
}

#: Columns that a source may lack (NULL then): the optional social breakdowns. All others are required.
OPTIONAL: dict[str, frozenset[str]] = {
    "fb_basic_ad": frozenset({"age", "gender", "publisher_platform", "platform_position", "impression_device",
                              "device_platform"}),
}
