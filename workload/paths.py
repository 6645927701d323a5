"""Conversion path queries."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.operators import paths
from adstrata.operators.timeline import busy_keys
from adstrata.plans import path_model
from adstrata.session import shared_folder
from workload.views import Inputs, check_sql

# The second run of the incremental model begins here; some events of these days come with it.
SECOND_RUN = date(2024, 1, 20)
LATE_DAYS = [date(2024, 1, 17), date(2024, 1, 18)]

QUERIES = {}
CHECKS = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumn("pre_conversion_media_cost", F.round("pre_conversion_media_cost", 6))


@query
def path_dedup(i: Inputs) -> DataFrame:
    return paths.dedup_conversions(paths.clean_events(i.stg_marketing_events))


@query
def path_conversion(i: Inputs) -> DataFrame:
    return _typed(paths.conversion_paths(i.stg_marketing_events, i.dim_campaigns))


@query
def path_conversion_10d(i: Inputs) -> DataFrame:
    """A short lookback, so that touches leave the range again."""
    return _typed(paths.conversion_paths(i.stg_marketing_events, i.dim_campaigns, lookback_days=10))


@query
def path_conversion_hot(i: Inputs) -> DataFrame:
    """One user owns a third of the events and is cut into hours."""
    user = F.when(_third("event_id"), "BUSY").otherwise(F.col("anonymous_user_id"))
    events = i.stg_marketing_events.withColumn("anonymous_user_id", user)
    busy = busy_keys(events.select("anonymous_user_id"), ["anonymous_user_id"], min_rows=BUSY_ROWS)
    return _typed(paths.conversion_paths(events, i.dim_campaigns, lookback_days=10, busy=busy))


@query
def path_incremental(i: Inputs) -> DataFrame:
    """Two runs, the second with ten more days and late events of two earlier ones: as the full model."""
    root = f"{shared_folder(i.spark)}/paths-{uuid.uuid4().hex}"
    events = i.stg_marketing_events.withColumn("event_date", F.col("event_at").cast("date"))
    events = events.where("event_date is not null")
    late = F.col("event_date").isin(LATE_DAYS) & _third("event_id")
    first = (F.col("event_date") < F.lit(SECOND_RUN)) & ~late
    for run, added in (("r1", first), ("r2", ~first)):
        rows = events.where(added)
        rows.write.mode("append").partitionBy("event_date").parquet(f"{root}/log")
        changed = [row[0] for row in rows.select("event_date").distinct().collect()]
        path_model.update(i.spark.read.parquet(f"{root}/log"), i.dim_campaigns, root, run, changed, lookback_days=10)
    return _typed(path_model.read_paths(i.spark, root))


@query
def path_latest_row(i: Inputs) -> DataFrame:
    events = i.stg_marketing_events.select("anonymous_user_id", "campaign_id", "event_id", "created_at")
    return paths.latest_rows(events, ["anonymous_user_id", "campaign_id"], "created_at", "event_id")


@query
def path_running(i: Inputs) -> DataFrame:
    events = i.events_k.select("user_id", "event_id", "ts", "event_type")
    return paths.running_conversions(
        events, "user_id", "ts", "event_id", F.col("event_type") == "purchase"
    )


# The user that gets a third of the events, and the rows from which users are cut in these queries.
BUSY_USER = 7
BUSY_ROWS = 100


def _third(event: str) -> Column:
    return F.regexp_extract(F.col(event).cast("string"), "([0-9])$", 1).isin("0", "3", "6")


@query
def path_running_hot(i: Inputs) -> DataFrame:
    """One user owns a third of the events and is spread over ranges."""
    events = i.events_k.select("user_id", "event_id", "ts", "event_type")
    user = F.when(_third("event_id"), BUSY_USER).otherwise(F.col("user_id"))
    events = events.withColumn("user_id", user)
    return paths.running_conversions(
        events, "user_id", "ts", "event_id", F.col("event_type") == "purchase"
    )


@query
def path_velocity(i: Inputs) -> DataFrame:
    joined = i.touchpoints.join(i.opportunities.select("opportunity_id", "close_date"), "opportunity_id")
    return paths.conversion_velocity(joined, "touch_date", "close_date").select(
        "touchpoint_id", "opportunity_id", "days_to_conversion", "conversion_velocity"
    )


CLEAN_EVENTS = """
select event_id, anonymous_user_id, auction_id, campaign_id, creative_id, conversion_tracker_id, order_id,
       conversion_event_id, event_at, cast(event_at as date) as event_date,
       coalesce(trim(supply_inventory_type), 'Unknown') as supply_inventory_type,
       coalesce(trim(device_type), 'Unknown') as device_type,
       coalesce(cost_micros, 0) / 1000000 as media_cost, coalesce(conversion_value, 0) as conversion_value,
       coalesce(lower(trim(conversion_count_type)), 'multiple') as conversion_count_type,
       lower(trim(event_type)) = 'impression' as has_impression,
       lower(trim(event_type)) = 'click' as has_click,
       lower(trim(event_type)) = 'conversion' as has_conversion
from stg_marketing_events where event_at is not null and not coalesce(is_test_event, false)
"""

CONVERSIONS = """
select event_id as source_event_id, coalesce(conversion_event_id, event_id) as conversion_event_id,
       anonymous_user_id, auction_id, campaign_id, conversion_tracker_id, order_id,
       event_at as conversion_at, event_date as conversion_date, conversion_value, conversion_count_type
from clean_events where has_conversion
qualify conversion_count_type <> 'once' or row_number() over (
    partition by anonymous_user_id, conversion_tracker_id, coalesce(order_id, conversion_event_id, event_id)
    order by event_at, event_id) = 1
"""

ROLLUP = """
select c.conversion_event_id, c.anonymous_user_id, c.conversion_tracker_id, c.campaign_id, c.conversion_at,
       c.conversion_date, max(c.conversion_value) as conversion_value,
       min(case when e.has_impression then e.event_at end) as first_impression_at,
       max(case when e.has_impression then e.event_at end) as last_impression_at,
       min(case when e.has_click then e.event_at end) as first_click_at,
       max(case when e.has_click then e.event_at end) as last_click_at,
       count(distinct case when e.has_impression then e.event_id end) as impression_touch_count,
       count(distinct case when e.has_click then e.event_id end) as click_touch_count,
       count(distinct e.campaign_id) as touched_campaign_count,
       count(distinct e.creative_id) as touched_creative_count,
       round(coalesce(sum(e.media_cost), 0), 6) as pre_conversion_media_cost,
       string_agg(distinct coalesce(e.supply_inventory_type, 'Unknown'), ' / '
                  order by coalesce(e.supply_inventory_type, 'Unknown')) as supply_inventory_type_list,
       string_agg(distinct coalesce(e.device_type, 'Unknown'), ' / '
                  order by coalesce(e.device_type, 'Unknown')) as device_type_list
from conversions c left join clean_events e
  on e.anonymous_user_id = c.anonymous_user_id and e.event_at <= c.conversion_at
 and e.event_at >= c.conversion_at - interval {days} day and (e.has_impression or e.has_click)
group by all
"""

_ELAPSED_HOURS = "date_sub('hour', first_impression_at, conversion_at)"
_ELAPSED_DAYS = "date_sub('day', first_impression_at, conversion_at)"

PATHS = f"""
select r.*,
       coalesce(trim(d.campaign_name), case when d.campaign_id is null then 'Unknown Campaign' else 'Unnamed Campaign' end) as campaign_name,
       coalesce(trim(d.account_id), 'No Account') as account_id, coalesce(trim(d.channel), 'Unknown') as channel,
       coalesce(trim(d.campaign_type), 'Unknown') as campaign_type,
       coalesce(trim(d.primary_goal), 'No Goal') as primary_goal, coalesce(trim(d.status), 'Unknown') as campaign_status,
       {_ELAPSED_HOURS} as hours_from_first_impression_to_conversion,
       date_sub('hour', first_click_at, conversion_at) as hours_from_first_click_to_conversion,
       impression_touch_count > 0 as has_impression_before_conversion,
       click_touch_count > 0 as has_click_before_conversion,
       case when click_touch_count > 0 then 'Click path' when impression_touch_count > 0 then 'View path'
            else 'Conversion only' end as conversion_path_type,
       case when first_impression_at is null then 'No prior impression'
            when {_ELAPSED_HOURS} < 24 then '< 1 day' when {_ELAPSED_DAYS} <= 5 then '1-5 days'
            when {_ELAPSED_DAYS} <= 10 then '6-10 days' when {_ELAPSED_DAYS} <= 20 then '11-20 days'
            when {_ELAPSED_DAYS} <= 30 then '21-30 days' else '> 30 days' end as impression_to_conversion_bucket
from rollup r left join dim_campaigns d on d.campaign_id = r.campaign_id and not coalesce(d.is_deleted, false)
"""


def path_steps(days: int) -> dict[str, str]:
    return {
        "clean_events": CLEAN_EVENTS,
        "conversions": CONVERSIONS,
        "rollup": ROLLUP.format(days=days),
        "paths": PATHS,
    }


CHECKS["path_dedup"] = check_sql(
    "select * from conversions", clean_events=CLEAN_EVENTS, conversions=CONVERSIONS
)
CHECKS["path_conversion"] = check_sql("select * from paths", **path_steps(60))
CHECKS["path_conversion_10d"] = check_sql("select * from paths", **path_steps(10))
CHECKS["path_incremental"] = CHECKS["path_conversion_10d"]
CHECKS["path_conversion_hot"] = check_sql(
    "select * from paths",
    hot_events="""
select * replace (case when right(cast(event_id as varchar), 1) in ('0', '3', '6') then 'BUSY'
                       else anonymous_user_id end as anonymous_user_id)
from stg_marketing_events
""",
    **{**path_steps(10), "clean_events": CLEAN_EVENTS.replace("stg_marketing_events", "hot_events")},
)
CHECKS["path_latest_row"] = check_sql(
    """select anonymous_user_id, campaign_id, event_id, created_at from stg_marketing_events
       qualify row_number() over (partition by anonymous_user_id, campaign_id
                                  order by created_at desc, event_id desc) = 1"""
)
CHECKS["path_running"] = check_sql(
    """select user_id, event_id, ts, event_type,
              row_number() over (partition by user_id order by ts, event_id) as touch_order,
              cast(sum(case when event_type = 'purchase' then 1 else 0 end) over (
                  partition by user_id order by ts, event_id
                  rows between unbounded preceding and current row) as bigint) as cumulative_conversions
       from events_k"""
)
CHECKS["path_running_hot"] = check_sql(
    f"""select user_id, event_id, ts, event_type,
               row_number() over (partition by user_id order by ts, event_id) as touch_order,
               cast(sum(case when event_type = 'purchase' then 1 else 0 end) over (
                   partition by user_id order by ts, event_id
                   rows between unbounded preceding and current row) as bigint) as cumulative_conversions
        from hot""",
    hot=f"""
select case when right(cast(event_id as varchar), 1) in ('0', '3', '6') then {BUSY_USER} else user_id end as user_id,
       event_id, ts, event_type
from events_k
""",
)
CHECKS["path_velocity"] = check_sql(
    """select touchpoint_id, opportunity_id, days_to_conversion,
              case when days_to_conversion <= 7 then 'fast' when days_to_conversion <= 30 then 'standard'
                   when days_to_conversion <= 90 then 'extended' else 'long_tail' end as conversion_velocity
       from (select touchpoint_id, t.opportunity_id, date_diff('day', touch_date, close_date) as days_to_conversion
             from touchpoints t join opportunities o on t.opportunity_id = o.opportunity_id)"""
)
