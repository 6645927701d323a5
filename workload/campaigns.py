"""Daily campaign queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.operators import campaign_daily, paths
from adstrata.plans import reports
from workload.paths import path_steps
from workload.views import Inputs, check_sql

QUERIES = {}
CHECKS = {}
NOW = "2024-01-30 22:00:00"


def query(function):
    QUERIES[function.__name__] = function
    return function


def _quality(i: Inputs) -> DataFrame:
    return reports.daily_quality_report(
        i.stg_marketing_events, i.dim_campaigns, i.fct_campaign_daily_delivery
    )


@query
def campaign_quality(i: Inputs) -> DataFrame:
    return _quality(i)


@query
def campaign_pacing(i: Inputs) -> DataFrame:
    days = paths.with_campaign(
        campaign_daily.daily_delivery(i.fct_campaign_daily_delivery),
        paths.clean_campaigns(i.dim_campaigns),
        "budget_amount",
        "campaign_start_date",
        "campaign_end_date",
    )
    return campaign_daily.with_pacing(days).select(
        "campaign_id",
        "activity_date",
        F.col("cumulative_media_cost").cast("double").alias("cumulative_media_cost"),
        "flight_day_count",
        "elapsed_flight_day_count",
        "expected_budget_progress",
        "actual_budget_progress",
        "has_budget_pacing_gap",
    )


@query
def campaign_delivery_rollup(i: Inputs) -> DataFrame:
    days = campaign_daily.daily_delivery(i.fct_campaign_daily_delivery)
    return days.withColumn("media_cost", F.col("media_cost").cast("double"))


@query
def campaign_conversion_summary(i: Inputs) -> DataFrame:
    return campaign_daily.daily_conversions(
        paths.conversion_paths(i.stg_marketing_events, i.dim_campaigns)
    )


@query
def campaign_daily_avg(i: Inputs) -> DataFrame:
    days = campaign_daily.daily_averages(i.fct_campaign_daily_delivery)
    return days.withColumns({n: F.round(n, 6) for n in ("daily_ctr", "daily_conversion_rate")})


@query
def campaign_budget_status(i: Inputs) -> DataFrame:
    goals = paths.clean_campaigns(i.dim_campaigns).select(
        "campaign_id",
        (F.col("budget_amount") / F.lit(30.0)).alias("daily_budget"),
        F.length("campaign_name").cast("bigint").alias("goal_impressions"),
    )
    days = campaign_daily.daily_averages(i.fct_campaign_daily_delivery).join(goals, "campaign_id", "left")
    return campaign_daily.budget_report(days).select(
        "campaign_id",
        "activity_date",
        "daily_impressions",
        "daily_spend",
        "spend_per_impression",
        "goal_attainment_pct",
        "budget_status",
    )


@query
def campaign_conv_gap(i: Inputs) -> DataFrame:
    model = paths.conversion_paths(i.stg_marketing_events, i.dim_campaigns)
    return campaign_daily.conversion_gaps(model, i.fct_campaign_daily_delivery)


@query
def campaign_conv_gap_over_5(i: Inputs) -> DataFrame:
    model = paths.conversion_paths(i.stg_marketing_events, i.dim_campaigns)
    return campaign_daily.conversion_gaps(model, i.fct_campaign_daily_delivery, min_gap=5)


@query
def campaign_dq_flag(i: Inputs) -> DataFrame:
    rows = i.fct_campaign_daily_delivery.select(
        "activity_date",
        "campaign_id",
        "line_item_id",
        "last_data_sync",
        F.col("impressions").alias("daily_impressions"),
        F.nullif("media_cost", F.lit(0)).cast("double").alias("daily_spend"),
        F.try_divide("conversions", "impressions").alias("daily_conversion_rate"),
    )
    return campaign_daily.data_quality_flags(rows, NOW).drop("daily_spend", "daily_conversion_rate")


_DELIVERY = """
select activity_date, cast(campaign_id as varchar) as campaign_id, cast(line_item_id as varchar) as line_item_id,
       coalesce(trim(supply_inventory_type), 'Unknown') as supply, coalesce(trim(device_type), 'Unknown') as device,
       impressions, clicks, conversions, reach_count, media_cost
from fct_campaign_daily_delivery where activity_date is not null
"""

_DAYS = """
select activity_date, campaign_id, cast(sum(impressions) as bigint) as impressions,
       cast(sum(clicks) as bigint) as clicks, cast(sum(conversions) as bigint) as platform_conversions,
       cast(sum(reach_count) as bigint) as reach_count, cast(sum(media_cost) as double) as media_cost,
       count(distinct line_item_id) as line_item_count,
       string_agg(distinct supply, ' / ' order by supply) as supply_inventory_type_list,
       string_agg(distinct device, ' / ' order by device) as device_type_list
from delivery group by activity_date, campaign_id
"""

_CAMPAIGNS = """
select campaign_id, coalesce(trim(campaign_name), 'Unnamed Campaign') as campaign_name,
       coalesce(trim(account_id), 'No Account') as account_id, coalesce(trim(channel), 'Unknown') as channel,
       coalesce(trim(campaign_type), 'Unknown') as campaign_type, coalesce(trim(status), 'Unknown') as campaign_status,
       coalesce(trim(primary_goal), 'No Goal') as primary_goal, cast(primary_goal_amount as double) as primary_goal_amount,
       coalesce(cast(budget_amount as double), 0) as budget_amount,
       start_date as campaign_start_date, end_date as campaign_end_date
from dim_campaigns where not coalesce(is_deleted, false)
"""

_CONVERSION_DAYS = """
select conversion_date as activity_date, campaign_id, count(distinct conversion_event_id) as deduped_conversion_count,
       cast(sum(cast(conversion_value as decimal(38,6))) as double) as deduped_conversion_value,
       avg(hours_from_first_impression_to_conversion) as avg_hours_from_first_impression_to_conversion,
       count(*) filter (has_click_before_conversion) as click_path_conversion_count,
       count(*) filter (has_impression_before_conversion and not has_click_before_conversion) as view_path_conversion_count
from paths group by conversion_date, campaign_id
"""

_PACED = """
select d.*, c.* exclude (campaign_id),
       cast(sum(cast(d.media_cost as decimal(28,6))) over (partition by d.campaign_id order by d.activity_date
            rows between unbounded preceding and current row) as double) as cumulative_media_cost,
       case when campaign_end_date is not null and campaign_start_date is not null then
            greatest(date_diff('day', campaign_start_date, campaign_end_date) + 1, 1) end as flight_day_count,
       case when campaign_end_date is not null and campaign_start_date is not null then
            greatest(date_diff('day', campaign_start_date, least(d.activity_date, campaign_end_date)) + 1, 0) end
            as elapsed_flight_day_count
from days d left join clean_campaigns c on c.campaign_id = d.campaign_id
"""

_PROGRESS = """
select *, elapsed_flight_day_count / flight_day_count as expected_budget_progress,
       cumulative_media_cost / nullif(budget_amount, 0) as actual_budget_progress
from paced
"""

_GAPS = """
select *, abs(actual_budget_progress - expected_budget_progress) > 0.20 as has_budget_pacing_gap from progress
"""

_FLAGS = """
select g.* exclude (flight_day_count, elapsed_flight_day_count),
       coalesce(v.deduped_conversion_count, 0) as deduped_conversion_count,
       coalesce(v.deduped_conversion_value, 0) as deduped_conversion_value,
       v.avg_hours_from_first_impression_to_conversion,
       coalesce(v.click_path_conversion_count, 0) as click_path_conversion_count,
       coalesce(v.view_path_conversion_count, 0) as view_path_conversion_count,
       clicks / nullif(impressions, 0) as click_through_rate,
       coalesce(v.deduped_conversion_count, 0) / nullif(clicks, 0) as click_to_conversion_rate,
       media_cost / nullif(v.deduped_conversion_count, 0) as cost_per_deduped_conversion,
       impressions / nullif(reach_count, 0) as average_frequency,
       coalesce(primary_goal, 'No Goal') = 'No Goal' as has_missing_primary_goal,
       impressions > 0 and media_cost = 0 as has_delivery_without_spend,
       impressions = 0 and media_cost > 0 as has_spend_without_delivery,
       clicks / nullif(impressions, 0) > 0.30 as has_unusually_high_click_through_rate,
       platform_conversions <> coalesce(v.deduped_conversion_count, 0) as has_conversion_count_gap
from gaps g left join conversion_days v on v.campaign_id = g.campaign_id and v.activity_date = g.activity_date
"""

_DAY_STEPS = {"delivery": _DELIVERY, "days": _DAYS}
_PACING_STEPS = {
    **_DAY_STEPS,
    "clean_campaigns": _CAMPAIGNS,
    "paced": _PACED,
    "progress": _PROGRESS,
    "gaps": _GAPS,
}

CHECKS["campaign_delivery_rollup"] = check_sql("select * from days", **_DAY_STEPS)
CHECKS["campaign_pacing"] = check_sql(
    """select campaign_id, activity_date, cumulative_media_cost, flight_day_count, elapsed_flight_day_count,
              expected_budget_progress, actual_budget_progress, has_budget_pacing_gap from gaps""",
    **_PACING_STEPS,
)
CHECKS["campaign_conversion_summary"] = check_sql(
    "select * from conversion_days", **path_steps(60), conversion_days=_CONVERSION_DAYS
)
# Labels for missing names, points per flag, notes and their order.
CHECKS["campaign_quality"] = check_sql(
    """select * replace (coalesce(campaign_name, 'Unknown Campaign') as campaign_name,
                         coalesce(account_id, 'No Account') as account_id, coalesce(channel, 'Unknown') as channel,
                         coalesce(campaign_type, 'Unknown') as campaign_type,
                         coalesce(campaign_status, 'Unknown') as campaign_status,
                         coalesce(primary_goal, 'No Goal') as primary_goal),
              100 - (case when has_missing_primary_goal then 20 else 0 end)
                  - (case when has_delivery_without_spend then 20 else 0 end)
                  - (case when has_spend_without_delivery then 20 else 0 end)
                  - (case when has_unusually_high_click_through_rate then 10 else 0 end)
                  - (case when has_conversion_count_gap then 15 else 0 end)
                  - (case when has_budget_pacing_gap then 15 else 0 end) as reporting_health_score,
              case when has_missing_primary_goal then 'Missing goal'
                   when has_delivery_without_spend then 'Delivery without spend'
                   when has_spend_without_delivery then 'Spend without delivery'
                   when has_conversion_count_gap then 'Conversion count gap'
                   when has_budget_pacing_gap then 'Budget pacing gap'
                   when has_unusually_high_click_through_rate then 'Rate outlier'
                   else 'Looks clean' end as primary_health_note,
              case when has_missing_primary_goal then 1 when has_delivery_without_spend then 2
                   when has_spend_without_delivery then 3 when has_conversion_count_gap then 4
                   when has_budget_pacing_gap then 5 when has_unusually_high_click_through_rate then 6
                   else 999 end as primary_health_note_sort
       from flags""",
    **path_steps(60),
    conversion_days=_CONVERSION_DAYS,
    **_PACING_STEPS,
    flags=_FLAGS,
)
_AVERAGES = """
select activity_date, campaign_id, cast(sum(impressions) as bigint) as daily_impressions,
       cast(sum(clicks) as bigint) as daily_clicks, cast(sum(conversions) as bigint) as daily_conversions,
       cast(sum(media_cost) as double) as daily_spend, round(avg(clicks / nullif(impressions, 0)), 6) as daily_ctr,
       round(avg(conversions / nullif(clicks, 0)), 6) as daily_conversion_rate
from delivery group by activity_date, campaign_id
"""
CHECKS["campaign_daily_avg"] = check_sql(_AVERAGES, delivery=_DELIVERY)
CHECKS["campaign_budget_status"] = check_sql(
    """select a.campaign_id, activity_date, daily_impressions, daily_spend,
              daily_spend / nullif(length(campaign_name), 0) as spend_per_impression,
              round(daily_impressions / nullif(length(campaign_name), 0), 2) as goal_attainment_pct,
              case when daily_spend > budget_amount / 30 * 1.1 then 'overrun'
                   when daily_spend < budget_amount / 30 * 0.9 then 'underspent' else 'on_track' end as budget_status
       from averages a left join clean_campaigns c on c.campaign_id = a.campaign_id""",
    delivery=_DELIVERY,
    averages=_AVERAGES,
    clean_campaigns=_CAMPAIGNS,
)
_GAP_ROWS = """
select campaign_id, activity_date, unique_conversions, total_conversion_value, conversions,
       abs(unique_conversions - conversions) as conversion_discrepancy
from (select v.campaign_id, v.activity_date, deduped_conversion_count as unique_conversions,
             deduped_conversion_value as total_conversion_value, d.conversions
      from conversion_days v left join delivery d
        on d.campaign_id = v.campaign_id and d.activity_date = v.activity_date)
"""
for _name, _limit in (("campaign_conv_gap", 0), ("campaign_conv_gap_over_5", 5)):
    CHECKS[_name] = check_sql(
        f"select * from gap_rows where conversion_discrepancy > {_limit}",
        **path_steps(60),
        conversion_days=_CONVERSION_DAYS,
        delivery=_DELIVERY,
        gap_rows=_GAP_ROWS,
    )
CHECKS["campaign_dq_flag"] = check_sql(
    f"""select activity_date, campaign_id, line_item_id, last_data_sync, impressions as daily_impressions,
               case when impressions = 0 then 'no_delivery' when nullif(media_cost, 0) is null then 'missing_cost_data'
                    when conversions / nullif(impressions, 0) > 0.5 then 'suspicious_high_rate'
                    when last_data_sync < timestamp '{NOW}' - interval 4 hour then 'stale_data'
                    else 'healthy' end as data_quality_flag
        from fct_campaign_daily_delivery"""
)
