"""Views that derive the inputs of the operators from the given tables.

The SQL runs unchanged on Spark and DuckDB: queries build DataFrames from it, the check SQL
gets it as common table expressions. Every view reads whole tables. Names of views and columns are
fixed values: they are what the operators' inputs are called.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events".split()

AS_OF = "2024-01-31"
ORDERS_AS_OF = "2001-12-31"

VIEWS: dict[str, str] = {}

VIEWS["events_k"] = """
select event_id, ts, user_id, event_type, value,
       cast(regexp_extract(props, '([0-9]+)', 1) as int) as k
from events
"""

# --- deals and touches -----------------------------------------------------------------

VIEWS["opportunities"] = """
select cast(o_orderkey as string) as opportunity_id, cast(o_custkey as string) as account_id,
       case o_orderstatus when 'F' then 'Closed Won' when 'P' then 'Closed Lost' else 'Open' end as stage_name,
       cast(o_orderdate as date) as created_at,
       case when o_orderstatus = 'O' then null else cast(o_orderdate + interval 330 day as date) end as close_date,
       cast(o_totalprice as decimal(18,2)) as amount
from orders
"""

VIEWS["touchpoints"] = """
select 'T' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as touchpoint_id,
       case when l_partkey % 89 = 0 then 'missing' else cast(l_orderkey as string) end as opportunity_id,
       case when l_partkey % 97 = 0 then 'wrong' else cast(o_custkey as string) end as account_id,
       'C' || (l_suppkey % 5) as campaign_id,
       case when l_partkey % 83 = 0 then null else p_type end as campaign_type,
       case when l_partkey % 79 = 0 then null else l_returnflag end as channel,
       case when l_partkey % 73 = 0 then null
            else cast(o_orderdate + (l_partkey % 14) * interval 30 day as date) end as touch_date
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
"""

# --- monitored tables ------------------------------------------------------------------

VIEWS["accounts"] = """
select cast(c_custkey as string) as account_id,
       case when c_custkey % 101 = 5 then null else c_name end as account_name,
       c_mktsegment as segment, c_nationkey as region_id, date'2001-12-30' as updated_at
from customer
"""

VIEWS["crm_opportunities"] = """
select cast(case when o_orderkey % 211 = 5 then o_orderkey - 1 else o_orderkey end as string) as opportunity_id,
       case when o_orderkey % 97 = 12 then null when o_orderkey % 103 = 7 then 'ghost'
            else cast(o_custkey as string) end as account_id,
       case when o_orderkey % 53 = 3 then 'Bad Stage' when o_orderkey % 59 = 3 then null
            else o_orderpriority end as stage_name,
       case when o_orderkey % 89 = 25 then null else cast(o_totalprice as decimal(18,2)) end as amount_reporting,
       cast(o_orderdate as date) as updated_at
from orders
"""

VIEWS["revenue_source"] = """
select opportunity_id,
       coalesce(amount_reporting, 0) + case when cast(opportunity_id as bigint) % 61 = 8 then 250 else 0 end as amount_source
from crm_opportunities
"""

VIEWS["row_count_history"] = """
select 'events' as table_name, cast(ts as date) as snapshot_date,
       cast(sum(case when cast(ts as date) = date'2024-01-30' and k % 3 = 0 then 0 else 1 end) as bigint) as row_count
from events_k group by cast(ts as date)
union all
select event_type as table_name, cast(ts as date) as snapshot_date, cast(count(*) as bigint) as row_count
from events_k group by event_type, cast(ts as date)
"""

# --- event log and statistics ----------------------------------------------------------

VIEWS["event_log"] = """
select 'A' || event_id as auction_id, ts as request_time, cast(user_id % 4 as int) as cluster,
       user_id % 40 as advertiser_id, k % 5 as sub_advertiser_id, k % 30 as line_item_id,
       k % 50 as campaign_id, k as nativead_id, 'U' || user_id as uniq_imp_id,
       md5('D' || user_id) as request_duid_sha256,
       case when user_id % 17 = 0 then null when user_id % 13 = 0 then ''
            else md5('D' || (user_id - 40)) end as most_associated_duid_sha256,
       'seg' || (k % 60) as matched_cseg_and_rt,
       case when k % 6 = 0 then null else 'deal' || (k % 30) end as deal_id,
       500 + k % 30 as dma, k % 9 as network_id,
       case when event_type in ('purchase', 'signup') then k % 7 end as conv_tracker_id,
       case k % 3 when 0 then 'Display' when 1 then 'CTV' else 'Audio' end as supply_inventory_type,
       case k % 2 when 0 then 'Mobile' else 'Desktop' end as device_type,
       case k % 4 when 0 then 'FR' when 1 then 'CA' else 'US' end as country, k % 5 > 1 as has_consent,
       '10.0.' || (user_id % 200) || '.' || k as ip_address,
       cast(round(value * 1000000) as bigint) as cost,
       case when event_type = 'view' then 1 else 0 end as has_won,
       case when event_type = 'click' then 1 else 0 end as has_click,
       case when event_type = 'purchase' then 1 else 0 end as has_conv,
       case when event_type = 'signup' then 1 else 0 end as has_ltconv
from events_k
"""

# Advertiser 11 is booked under another id, so it has no statistics of its own.
VIEWS["campaign_daily_stats"] = """
select case when advertiser_id = 11 then 911 else advertiser_id end as user_id,
       date_trunc('hour', request_time) as cached_hour,
       sum(cast(cost as decimal(18,0)) * case when advertiser_id % 7 = 0 then cast(1.02 as decimal(3,2))
                                             else cast(1.00 as decimal(3,2)) end) as cost,
       cast(sum(has_won) as bigint) as imp, cast(sum(has_click) as bigint) as click,
       cast(sum(has_conv) + (case when advertiser_id % 5 = 0 then 1 else 0 end) as bigint) as conv,
       cast(sum(has_ltconv) + (case when advertiser_id % 5 = 0 then 1 else 0 end) as bigint) as ltc,
       cast(case when advertiser_id % 5 = 0 then 1 else 0 end as bigint) as skan_conv
from event_log
group by advertiser_id, date_trunc('hour', request_time)
"""

# --- identity --------------------------------------------------------------------------

# Every twelve customers stand for one device; every fifth of them names a second identity.
VIEWS["identity_edges"] = """
select 'L' || (cast(floor(c_custkey / 12) as bigint) + case when c_custkey % 5 = 0 then 1 else 0 end) as luid,
       md5('D' || cast(floor(c_custkey / 12) as bigint)) as duid
from customer
"""

VIEWS["synthetic_keys"] = """
select 'L' || cast(floor(c_custkey / 16) as bigint) as encryptedluid,
       case when c_custkey % 16 = 5 then null else 'K' || (c_custkey % 7) end as synthetic_key
from customer
"""

# --- account hierarchy and names -------------------------------------------------------

VIEWS["native_ads"] = "select p_partkey as id, p_name as name from part"

VIEWS["campaigns_native_ads"] = """
select p_partkey as native_ad_id, p_partkey % 50 as campaign_id from part
"""

VIEWS["campaigns"] = """
select p_partkey as id, p_name as name, p_type as type, p_partkey % 30 as line_item_id,
       p_partkey % 5 as sub_advertiser_id, p_partkey % 5 as user_id
from part
"""

VIEWS["line_items"] = "select n_nationkey as id, n_name as name, n_regionkey as user_id from nation"

VIEWS["sub_advertisers"] = "select r_regionkey as id, r_name as name from region"

VIEWS["users"] = """
select r_regionkey as id, r_name as company_name,
       case r_regionkey % 3 when 0 then 'Eastern Time' when 1 then 'London' else 'Nowhere' end as timezone
from region
"""

VIEWS["utc_adjust"] = """
select case when r_regionkey = 0 then 'Eastern Time' when r_regionkey = 1 then 'London'
            else 'Zone ' || r_regionkey end as timezone,
       case when r_regionkey = 0 then 'America/New_York' when r_regionkey = 1 then 'Europe/London'
            else 'UTC' end as RS_timezone
from region
"""

VIEWS["custom_segments"] = """
select n_nationkey as id, 'seg' || n_nationkey as identifier, n_name as name,
       case when n_nationkey % 4 = 2 then null else 'Display ' || n_name end as display_name
from nation
"""

VIEWS["rt_segments"] = "select 'seg' || (25 + n_nationkey) as id, n_name as name from nation"

VIEWS["dma_names"] = "select 500 + n_nationkey as DMA_Adjust, 'DMA ' || n_name as DMA_Name from nation"

VIEWS["ad_networks"] = "select r_regionkey as id, 'Network ' || r_name as company_name from region"

VIEWS["conversion_trackers"] = "select r_regionkey as id, 'Tracker ' || r_name as name from region"

VIEWS["programmatic_deals"] = "select 'deal' || n_nationkey as deal_id, n_name as name from nation"

VIEWS["inventory_byod_deals"] = "select 'deal' || (r_regionkey * 3 + 1) as deal_id from region"

# --- marketing events, campaigns and delivery ------------------------------------------

VIEWS["stg_marketing_events"] = """
select cast(event_id as string) as event_id, 'U' || user_id as anonymous_user_id, 'A' || event_id as auction_id,
       cast(k % 20 as string) as campaign_id, 'L' || (k % 40) as line_item_id, 'R' || k as creative_id,
       case event_type when 'purchase' then 'TP' when 'signup' then 'TS' end as conversion_tracker_id,
       cast(null as string) as conversion_event_id,
       case when event_type = 'signup' then 'O' || (k % 5) end as order_id,
       case when k = 77 then null else ts end as event_at,
       case event_type when 'view' then ' Impression ' when 'click' then 'CLICK'
            when 'error' then 'error' else 'conversion' end as event_type,
       case k % 4 when 0 then null when 1 then ' Display ' when 2 then 'CTV' else 'Audio' end as supply_inventory_type,
       case k % 3 when 0 then 'Mobile' when 1 then 'Desktop' end as device_type,
       cast(null as string) as country, 'R' || (k % 3) as region, cast(null as string) as city,
       value * 1000000 as cost_micros, value as conversion_value,
       case when event_type = 'signup' then 'Once' end as conversion_count_type,
       cast(null as boolean) as has_impression, cast(null as boolean) as has_click,
       cast(null as boolean) as has_conversion, k = 50 as is_test_event,
       ts + (k % 3) * interval 1 hour as created_at
from events_k
"""

VIEWS["dim_campaigns"] = """
select case when p_partkey = 19 then 'X19' else cast(p_partkey as string) end as campaign_id,
       ' ' || p_name || ' ' as campaign_name, p_brand as account_id,
       p_type as channel, case when p_size % 4 = 0 then null else 'CT' || (p_size % 3) end as campaign_type,
       'Active' as status, case when p_partkey % 6 = 0 then null else 'CPA' end as primary_goal,
       p_retailprice as primary_goal_amount,
       case when p_partkey % 9 = 0 then 0.0 else p_retailprice * 5 end as budget_amount,
       date'2024-01-01' as start_date,
       case when p_partkey % 8 = 3 then null else date'2024-01-25' end as end_date,
       p_partkey = 7 as is_deleted
from part
"""

VIEWS["fct_campaign_daily_delivery"] = """
select cast(ts as date) as activity_date, k % 20 as campaign_id, k % 40 as line_item_id,
       case k % 4 when 0 then null when 1 then ' Display ' when 2 then 'CTV' else 'Audio' end as supply_inventory_type,
       case k % 3 when 0 then 'Mobile' when 1 then 'Desktop' end as device_type,
       cast(sum(case when event_type = 'view' then 1 else 0 end) as bigint) as impressions,
       cast(sum(case when event_type = 'click' then 1 else 0 end) as bigint) as clicks,
       cast(sum(case when event_type = 'purchase' then 1 else 0 end) as bigint) as conversions,
       count(distinct user_id) as reach_count,
       sum(cast(case when k % 20 = 4 then 0 else value end as decimal(18,2))) as media_cost,
       max(ts) as last_data_sync
from events_k
group by cast(ts as date), k % 20, k % 40, k % 4, k % 3
"""


@cache
def needed(sql: str) -> tuple[str, ...]:
    """Views a statement refers to, in the order they have to be defined."""
    order: list[str] = []
    for name in re.findall(r"\b(?:from|join)\s+(\w+)", sql):
        if name in VIEWS:
            order += [n for n in (*needed(VIEWS[name]), name) if n not in order]
    return tuple(order)


class Inputs:
    """The views over one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            elif name in VIEWS:
                sql = VIEWS[name]
                used = set(re.findall(r"\b(?:from|join)\s+(\w+)", sql))
                frames = {used_name: getattr(self, used_name) for used_name in used}
                named = re.sub(r"\b(from|join)\s+(\w+)", r"\1 {\2}", sql)
                frame = self.spark.sql(named, **frames)
            else:
                raise AttributeError(name)
            self._frames[name] = frame
        return self._frames[name]


def check_sql(body: str, **steps: str) -> str:
    """DuckDB statement: the views it needs, the given steps, then the body."""
    clauses = [f"{name} as ({VIEWS[name]})" for name in needed(" ".join([*steps.values(), body]))]
    clauses += [f"{name} as ({sql})" for name, sql in steps.items()]
    return f"with {', '.join(clauses)} {body}" if clauses else body
