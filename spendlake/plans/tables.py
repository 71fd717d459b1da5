"""The eight tables of the lake: five daily fact tables and three dimension tables."""

from __future__ import annotations

from spendlake.plans.spec import TableSpec

# ---------------------------------------------------------------------------
# Field names, column names, kinds and column order are the
# reporting service's and the tables' own, so they are listed as they are.
# ---------------------------------------------------------------------------

METRICS = (
    ("spend", "spend", "double"),
    ("impressions", "impressions", "bigint"),
    ("clicks", "clicks", "bigint"),
    ("reach", "reach", "bigint"),
    ("frequency", "frequency", "double"),
    ("cpc", "cpc", "double"),
    ("cpm", "cpm", "double"),
    ("ctr", "ctr", "double"),
    ("inline_link_clicks", "inline_link_clicks", "bigint"),
    ("inline_post_engagement", "inline_post_engagement", "bigint"),
    ("actions", "actions_json", "json"),
    ("video_play_actions", "video_play_actions_json", "json"),
    ("video_p25_watched_actions", "video_p25_watched_actions_json", "json"),
    ("video_p50_watched_actions", "video_p50_watched_actions_json", "json"),
    ("video_p75_watched_actions", "video_p75_watched_actions_json", "json"),
    ("video_p100_watched_actions", "video_p100_watched_actions_json", "json"),
)

AD_IDENTITY = (
    ("ad_id", "ad_id", "string"),
    ("ad_name", "ad_name", "string"),
    ("adset_id", "ad_set_id", "string"),
    ("adset_name", "ad_set_name", "string"),
    ("campaign_id", "campaign_id", "string"),
    ("campaign_name", "campaign_name", "string"),
)

AD_SET_IDENTITY = (
    ("adset_id", "ad_set_id", "string"),
    ("adset_name", "ad_set_name", "string"),
    ("campaign_id", "campaign_id", "string"),
    ("campaign_name", "campaign_name", "string"),
)

CAMPAIGN_IDENTITY = (
    ("campaign_id", "campaign_id", "string"),
    ("campaign_name", "campaign_name", "string"),
    ("objective", "objective", "string"),
)

STAT_DATE = (("date_start", "stat_date", "date"),)
MARKET = (("comscore_market", "market", "string"),)
AGE_GENDER = (("age", "age", "string"), ("gender", "gender", "string"))

CAMPAIGN_FIELDS = (
    ("id", "campaign_id", "string"),
    ("adlabels", "adlabels_json", "json"),
    ("bid_strategy", "bid_strategy", "string"),
    ("boosted_object_id", "boosted_object_id", "string"),
    ("brand_lift_studies", "brand_lift_studies_json", "json"),
    ("budget_rebalance_flag", "budget_rebalance_flag", "boolean"),
    ("budget_remaining", "budget_remaining", "double"),
    ("buying_type", "buying_type", "string"),
    ("campaign_group_active_time", "campaign_group_active_time", "string"),
    ("can_create_brand_lift_study", "can_create_brand_lift_study", "boolean"),
    ("can_use_spend_cap", "can_use_spend_cap", "boolean"),
    ("configured_status", "configured_status", "string"),
    ("created_time", "created_time", "timestamp"),
    ("daily_budget", "daily_budget", "double"),
    ("effective_status", "effective_status", "string"),
    ("has_secondary_skadnetwork_reporting", "has_secondary_skadnetwork_reporting", "boolean"),
    ("is_adset_budget_sharing_enabled", "is_adset_budget_sharing_enabled", "boolean"),
    ("is_budget_schedule_enabled", "is_budget_schedule_enabled", "boolean"),
    ("is_reels_trending_ads_enabled", "is_reels_trending_ads_enabled", "boolean"),
    ("is_skadnetwork_attribution", "is_skadnetwork_attribution", "boolean"),
    ("issues_info", "issues_info_json", "json"),
    ("last_budget_toggling_time", "last_budget_toggling_time", "timestamp"),
    ("lifetime_budget", "lifetime_budget", "double"),
    ("name", "name", "string"),
    ("objective", "objective", "string"),
    ("pacing_type", "pacing_type_json", "json"),
    ("primary_attribution", "primary_attribution", "string"),
    ("promoted_object", "promoted_object_json", "json"),
    ("smart_promotion_type", "smart_promotion_type", "string"),
    ("source_campaign", "source_campaign_json", "json"),
    ("source_campaign_id", "source_campaign_id", "string"),
    ("special_ad_categories", "special_ad_categories_json", "json"),
    ("special_ad_category", "special_ad_category", "string"),
    ("special_ad_category_country", "special_ad_category_country_json", "json"),
    ("spend_cap", "spend_cap", "double"),
    ("start_time", "start_time", "timestamp"),
    ("status", "status", "string"),
    ("stop_time", "stop_time", "timestamp"),
    ("topline_id", "topline_id", "string"),
    ("updated_time", "updated_time", "timestamp"),
)

AD_SET_FIELDS = (
    ("id", "ad_set_id", "string"),
    ("adlabels", "adlabels_json", "json"),
    ("adset_schedule", "adset_schedule_json", "json"),
    ("asset_feed_id", "asset_feed_id", "string"),
    ("attribution_spec", "attribution_spec_json", "json"),
    ("bid_adjustments", "bid_adjustments_json", "json"),
    ("bid_amount", "bid_amount", "bigint"),
    ("bid_constraints", "bid_constraints_json", "json"),
    ("bid_info", "bid_info_json", "json"),
    ("bid_strategy", "bid_strategy", "string"),
    ("billing_event", "billing_event", "string"),
    ("brand_safety_config", "brand_safety_config_json", "json"),
    ("budget_remaining", "budget_remaining", "double"),
    ("campaign", "campaign_json", "json"),
    ("campaign_active_time", "campaign_active_time", "string"),
    ("campaign_attribution", "campaign_attribution", "string"),
    ("campaign_id", "campaign_id", "string"),
    ("configured_status", "configured_status", "string"),
    ("created_time", "created_time", "timestamp"),
    ("creative_sequence", "creative_sequence_json", "json"),
    ("daily_budget", "daily_budget", "double"),
    ("daily_min_spend_target", "daily_min_spend_target", "double"),
    ("daily_spend_cap", "daily_spend_cap", "double"),
    ("destination_type", "destination_type", "string"),
    ("dsa_beneficiary", "dsa_beneficiary", "string"),
    ("dsa_payor", "dsa_payor", "string"),
    ("effective_status", "effective_status", "string"),
    ("end_time", "end_time", "timestamp"),
    ("frequency_control_specs", "frequency_control_specs_json", "json"),
    ("instagram_user_id", "instagram_user_id", "string"),
    ("is_dynamic_creative", "is_dynamic_creative", "boolean"),
    ("is_incremental_attribution_enabled", "is_incremental_attribution_enabled", "boolean"),
    ("issues_info", "issues_info_json", "json"),
    ("learning_stage_info", "learning_stage_info_json", "json"),
    ("lifetime_budget", "lifetime_budget", "double"),
    ("lifetime_imps", "lifetime_imps", "bigint"),
    ("lifetime_min_spend_target", "lifetime_min_spend_target", "double"),
    ("lifetime_spend_cap", "lifetime_spend_cap", "double"),
    ("min_budget_spend_percentage", "min_budget_spend_percentage", "double"),
    ("multi_optimization_goal_weight", "multi_optimization_goal_weight", "string"),
    ("name", "name", "string"),
    ("optimization_goal", "optimization_goal", "string"),
    ("optimization_sub_event", "optimization_sub_event", "string"),
    ("pacing_type", "pacing_type_json", "json"),
    ("promoted_object", "promoted_object_json", "json"),
    ("recommendations", "recommendations_json", "json"),
    ("recurring_budget_semantics", "recurring_budget_semantics", "boolean"),
    ("regional_regulated_categories", "regional_regulated_categories_json", "json"),
    ("regional_regulation_identities", "regional_regulation_identities_json", "json"),
    ("review_feedback", "review_feedback", "string"),
    ("rf_prediction_id", "rf_prediction_id", "string"),
    ("source_adset", "source_adset_json", "json"),
    ("source_adset_id", "source_adset_id", "string"),
    ("start_time", "start_time", "timestamp"),
    ("status", "status", "string"),
    ("targeting", "targeting_json", "json"),
    ("targeting_optimization_types", "targeting_optimization_types_json", "json"),
    ("time_based_ad_rotation_id_blocks", "time_based_ad_rotation_id_blocks_json", "json"),
    ("time_based_ad_rotation_intervals", "time_based_ad_rotation_intervals_json", "json"),
    ("updated_time", "updated_time", "timestamp"),
    ("use_new_app_click", "use_new_app_click", "boolean"),
    ("value_rule_set_id", "value_rule_set_id", "string"),
)

AD_FIELDS = (
    ("id", "ad_id", "string"),
    ("ad_active_time", "ad_active_time", "string"),
    ("ad_review_feedback", "ad_review_feedback_json", "json"),
    ("ad_schedule_end_time", "ad_schedule_end_time", "timestamp"),
    ("ad_schedule_start_time", "ad_schedule_start_time", "timestamp"),
    ("adlabels", "adlabels_json", "json"),
    ("adset", "adset_json", "json"),
    ("adset_id", "ad_set_id", "string"),
    ("bid_amount", "bid_amount", "bigint"),
    ("bid_info", "bid_info_json", "json"),
    ("bid_type", "bid_type", "string"),
    ("campaign", "campaign_json", "json"),
    ("campaign_id", "campaign_id", "string"),
    ("configured_status", "configured_status", "string"),
    ("conversion_domain", "conversion_domain", "string"),
    ("conversion_specs", "conversion_specs_json", "json"),
    ("created_time", "created_time", "timestamp"),
    ("creative", "creative_json", "json"),
    ("creative_asset_groups_spec", "creative_asset_groups_spec_json", "json"),
    ("demolink_hash", "demolink_hash", "string"),
    ("display_sequence", "display_sequence", "bigint"),
    ("effective_status", "effective_status", "string"),
    ("engagement_audience", "engagement_audience", "boolean"),
    ("failed_delivery_checks", "failed_delivery_checks_json", "json"),
    ("is_autobid", "is_autobid", "boolean"),
    ("last_updated_by_app_id", "last_updated_by_app_id", "string"),
    ("name", "name", "string"),
    ("preview_shareable_link", "preview_shareable_link", "string"),
    ("priority", "priority", "bigint"),
    ("recommendations", "recommendations_json", "json"),
    ("source_ad", "source_ad_json", "json"),
    ("source_ad_id", "source_ad_id", "string"),
    ("status", "status", "string"),
    ("updated_time", "updated_time", "timestamp"),
)

# ---------------------------------------------------------------------------
# Tables
# ---------------------------------------------------------------------------

AD_DAILY = TableSpec.of(
    "ad_daily",
    AD_IDENTITY + STAT_DATE + METRICS,
    keys=("ad_account_id", "ad_id", "stat_date"),
    day_of="stat_date",
    level="ad",
)
AD_SET_DAILY = TableSpec.of(
    "ad_set_daily",
    AD_SET_IDENTITY + STAT_DATE + METRICS,
    keys=("ad_account_id", "ad_set_id", "stat_date"),
    day_of="stat_date",
    level="adset",
)
CAMPAIGN_DAILY = TableSpec.of(
    "campaign_daily",
    CAMPAIGN_IDENTITY + STAT_DATE + METRICS,
    keys=("ad_account_id", "campaign_id", "stat_date"),
    day_of="stat_date",
    level="campaign",
)
AD_MARKET_DAILY = TableSpec.of(
    "ad_market_daily",
    AD_IDENTITY + MARKET + STAT_DATE + METRICS,
    keys=("ad_account_id", "ad_id", "market", "stat_date"),
    day_of="stat_date",
    level="ad",
    breakdowns=("comscore_market",),
)
AD_AGE_GENDER_DAILY = TableSpec.of(
    "ad_age_gender_daily",
    AD_IDENTITY + AGE_GENDER + STAT_DATE + METRICS,
    keys=("ad_account_id", "ad_id", "age", "gender", "stat_date"),
    day_of="stat_date",
    level="ad",
    breakdowns=("age", "gender"),
)

CAMPAIGNS = TableSpec.of("campaigns", CAMPAIGN_FIELDS, keys=("ad_account_id", "campaign_id"), day_of="created_time")
AD_SETS = TableSpec.of("ad_sets", AD_SET_FIELDS, keys=("ad_account_id", "ad_set_id"), day_of="created_time")
ADS = TableSpec.of("ads", AD_FIELDS, keys=("ad_account_id", "ad_id"), day_of="created_time")

FACTS = {t.name: t for t in (AD_DAILY, AD_SET_DAILY, CAMPAIGN_DAILY, AD_MARKET_DAILY, AD_AGE_GENDER_DAILY)}
DIMENSIONS = {t.name: t for t in (CAMPAIGNS, AD_SETS, ADS)}
