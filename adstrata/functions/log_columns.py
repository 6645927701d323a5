"""Column names of the event log that the operators know by heart."""

from __future__ import annotations

# The account hierarchy from top to bottom.
HIERARCHY = [
    "advertiser_id",
    "sub_advertiser_id",
    "line_item_id",
    "campaign_id",
    "nativead_id",
]

# Columns stored in micro currency units.
MICRO_COLUMNS = [
    "cost",
    "line_item_conversion_revenue_deduped",
    "advertiser_conversion_revenue_deduped",
    "campaign_conversion_revenue",
    "cost_usd",
    "stats_revenue",
    "stats_profit",
    "ltconv_revenue",
    "stats_tp_cpm_cost",
    "stats_tp_cpc_cost",
    "en_pl_margin",
]

# Log columns that are measures. Every other column of the log is a dimension.
METRICS = [
    "addon_cost",
    "addon_price",
    "arrival_rate_score",
    "bid_floor",
    "bid_price_prered",
    "conversion_optimization_weight",
    "email_estimated_price",
    "en_ad_inc",
    "en_ad_sa_a",
    "en_ad_sa_c",
    "en_ad_sa_d",
    "en_ad_sa_n",
    "en_ad_sa_v",
    "en_ad_tp_a",
    "en_ad_tp_c",
    "en_ad_tp_d",
    "en_ad_tp_n",
    "en_ad_tp_v",
    "en_adv_b2b",
    "en_adv_brow",
    "en_adv_kwr",
    "en_adv_lal",
    "en_adv_lalx",
    "en_adv_pcai",
    "en_aud_xdevice",
    "en_eng",
    "en_ga",
    "en_meas_bl",
    "en_meas_dco",
    "en_meas_fpda",
    "en_meas_frd_a",
    "en_meas_frd_c",
    "en_meas_frd_d",
    "en_meas_frd_n",
    "en_meas_frd_v",
    "en_meas_fta",
    "en_meas_hc",
    "en_meas_inc_rc",
    "en_meas_saf_a",
    "en_meas_saf_c",
    "en_meas_saf_d",
    "en_meas_saf_n",
    "en_meas_saf_v",
    "en_meas_view_a",
    "en_meas_view_c",
    "en_meas_view_d",
    "en_meas_view_n",
    "en_meas_view_v",
    "en_ml_baseline",
    "en_ml_opt",
    "en_mng_marg",
    "en_perf_goal",
    "en_pl_marg_pg",
    "en_pl_margin",
    "en_std_appfig",
    "en_std_crm",
    "en_std_demo",
    "en_std_device",
    "en_std_drt",
    "en_std_georad",
    "en_std_int",
    "en_std_ip",
    "en_std_isp",
    "en_std_lang",
    "en_std_rt",
    "en_std_tac_w",
    "en_tp",
    "has_engage_wall",
    "has_key_phrase",
    "page_score",
    "pred_score",
    "projected_lt_footfall_conv",
    "promised_cost",
    "advertiser_conversion_revenue_deduped",
    "advertiser_has_conversion_deduped",
    "advertiser_has_secondary_conversion_deduped",
    "bid_price",
    "bid_reduction",
    "campaign_conversion_revenue",
    "campaign_pacing",
    "click_time_diff",
    "cost",
    "cost_usd",
    "en_std_cat",
    "has_click",
    "has_conv",
    "has_engagement",
    "has_footfall_conv",
    "has_lt_footfall_conv",
    "has_ltconv",
    "stats_50v_2s_ias",
    "has_s_ltconv",
    "has_secondary_conversion",
    "has_won",
    "imp_multiplier",
    "imp_time_diff",
    "line_item_conversion_revenue_deduped",
    "stats_click_time",
    "stats_cpm_cost",
    "stats_engage_click",
    "stats_engage_cost",
    "stats_engage_cpm",
    "stats_engage_imp",
    "stats_fraud_ias",
    "stats_imp_time",
    "stats_measure_ias",
    "line_item_has_conversion_deduped",
    "line_item_has_secondary_conversion_deduped",
    "stats_moat_non_measure",
    "stats_page_time_120s",
    "line_item_unique_imp",
    "ltconv_revenue",
    "stats_page_time_300s",
    "stats_page_time_30s",
    "stats_page_time_5s",
    "stats_page_time_60s",
    "stats_page_time_900s",
    "stats_page_view",
    "margin",
    "margin_adjusted",
    "projected_footfall_conv",
    "stats_acomp_0",
    "stats_acomp_25",
    "stats_acomp_50",
    "stats_acomp_75",
    "stats_acomp_95",
    "stats_b_cost",
    "stats_moat_inview",
    "stats_moat_measure",
    "stats_page_time_15s",
    "stats_page_time_1s",
    "stats_profit",
    "stats_revenue",
    "stats_ssp_revenue",
    "stats_tp_cpc_cost",
    "stats_tp_cpm_cost",
    "stats_vcomp_0",
    "usd_to_local_exchange_rate",
    "stats_vcomp_25",
    "stats_vcomp_50",
    "stats_vcomp_75",
    "stats_vcomp_95",
    "sub_advertiser_unique_imp",
    "total_time_on_site",
    "unique_imp",
    "view_50v_2s",
    "view_m",
    "win_bid_time_diff",
    "viewability",
    "win_price_prered",
    "win_price",
]
