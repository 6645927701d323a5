"""Log extraction and identity queries."""

from __future__ import annotations

import functools
import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.functions.privacy import PrivacyRules, censor
from adstrata.functions.times import local_trunc, pull_window, time_text, to_local
from adstrata.operators import identity, keys, logextract
from adstrata.plans import delivery, reports
from adstrata.session import shared_folder
from adstrata.sources import readers
from workload.views import Inputs, check_sql

QUERIES = {}
CHECKS = {}
ZONE = "America/New_York"

REPORT_COLUMNS = [
    "has_won",
    "cost",
    "request_time",
    "request_date",
    "request_hour",
    "auction_id",
    "campaign_id",
    "nativead_id",
    "matched_cseg_and_rt",
    "dma",
    "conv_tracker_id",
    "network_id",
    "deal_id",
    "no_such_column",
]
EXPORT_REQUEST_COLUMNS = [
    "request_time",
    "auction_id",
    "nativead_id",
    "matched_cseg_and_rt",
    "supply_inventory_type",
    "device_type",
    "request_duid_sha256",
    "most_associated_duid_sha256",
    "has_won",
    "has_click",
    "cost",
]


def query(function):
    QUERIES[function.__name__] = function
    return function


def _hierarchy(i: Inputs) -> logextract.Hierarchy:
    return logextract.Hierarchy(
        native_ads=i.native_ads,
        campaigns_native_ads=i.campaigns_native_ads,
        campaigns=i.campaigns,
        line_items=i.line_items,
        sub_advertisers=i.sub_advertisers,
        users=i.users,
    )


def _lookups(i: Inputs) -> logextract.Lookups:
    return logextract.Lookups(
        custom_segments=i.custom_segments,
        rt_segments=i.rt_segments,
        dma=i.dma_names,
        trackers=i.conversion_trackers,
        networks=i.ad_networks,
        deals=i.programmatic_deals,
        byod_deals=i.inventory_byod_deals,
    )


def _request(**changes) -> logextract.LogRequest:
    settings = {
        "columns": REPORT_COLUMNS,
        "start": "2024-01-01 00:00:00",
        "end": "2024-02-01 00:00:00",
        "zone": ZONE,
        **changes,
    }
    return logextract.LogRequest(**settings)


@query
def lld_name_map(i: Inputs) -> DataFrame:
    return logextract.name_map(_hierarchy(i), "nativead_id")


@query
def lld_name_map_line_item(i: Inputs) -> DataFrame:
    return logextract.name_map(_hierarchy(i), "line_item_id")


@query
def lld_name_map_account(i: Inputs) -> DataFrame:
    return logextract.name_map(_hierarchy(i), "advertiser_id")


@query
def lld_audience(i: Inputs) -> DataFrame:
    return logextract.audience_names(i.custom_segments, i.rt_segments)


@query
def lld_report(i: Inputs) -> DataFrame:
    request = _request(
        expressions=["case when device_type = 'Mobile' then 'M' else 'D' end as device_code"],
        renames="auction_id:event_id, broken, absent:gone, campaign_name:ad_group_name",
    )
    return logextract.build_report(i.event_log, request, _hierarchy(i), _lookups(i))


@query
def lld_report_hot(i: Inputs) -> DataFrame:
    """Over the lookups of a log where one deal and creative hold a third of the rows, and blank deals another."""
    last = F.substring("auction_id", -1, 1)
    hot, blank = last.isin("0", "3", "6"), last.isin("1", "4", "7")
    events = i.event_log.withColumns({
        "deal_id": F.when(hot, F.lit("deal4")).when(blank, F.when(last == "4", F.lit(""))).otherwise(F.col("deal_id")),
        "nativead_id": F.when(hot, F.lit(7)).otherwise(F.col("nativead_id")),
    })
    return logextract.build_report(events, _request(), _hierarchy(i), _lookups(i), balance=True)


@query
def lld_report_line_item(i: Inputs) -> DataFrame:
    """Names join on the lowest level that was asked for."""
    request = _request(columns=["auction_id", "line_item_id", "has_click"])
    return logextract.build_report(i.event_log, request, _hierarchy(i), _lookups(i))


@query
def lld_report_retargeting(i: Inputs) -> DataFrame:
    """Only retargeting segments and deals are known; blank deal ids are empty text."""
    request = _request(columns=["auction_id", "matched_cseg_and_rt", "deal_id"])
    lookups = logextract.Lookups(rt_segments=i.rt_segments, deals=i.programmatic_deals)
    return logextract.build_report(i.event_log, request, None, lookups)


@query
def lld_report_allowed(i: Inputs) -> DataFrame:
    """Dimensions that were not released drop out of a request."""
    request = _request(
        columns=["auction_id", "ip_address", "request_date", "has_won", "device_type"],
        allowed=["auction_id", "device_type"],
    )
    return logextract.build_report(i.event_log, request, None, logextract.Lookups())


PULL_COLUMNS = ["auction_id", "request_time", "has_won"]


def _pulled(i: Inputs, output_exists: bool) -> DataFrame:
    """What a run on the tenth of January pulls; one event comes in the last second of the day."""
    late = i.spark.range(1).select(
        F.lit("LATE").alias("auction_id"),
        # 23:59:59.5 on the ninth in New York
        F.lit("2024-01-10 04:59:59.5").cast("timestamp_ntz").alias("request_time"),
        F.lit(1).alias("has_won"),
    )
    log = i.event_log.select("auction_id", F.col("request_time").cast("timestamp_ntz"), "has_won").union(late)
    start, end = pull_window(date(2024, 1, 10), date(2024, 1, 3), output_exists)
    return logextract.pull(log, _request(columns=PULL_COLUMNS, start=start, end=end))


@query
def lld_pull_initial(i: Inputs) -> DataFrame:
    return _pulled(i, output_exists=False)


@query
def lld_pull_daily(i: Inputs) -> DataFrame:
    return _pulled(i, output_exists=True)


@query
def lld_pull_from_output(i: Inputs) -> DataFrame:
    """Three runs into one folder, the last one repeated: a sample, everything so far, then one day."""
    folder = f"{shared_folder(i.spark)}/client-{uuid.uuid4().hex}"
    request = _request(columns=PULL_COLUMNS)
    days = {"sample": date(2024, 1, 10), "initial": date(2024, 1, 10), "daily": date(2024, 1, 11), "again": date(2024, 1, 11)}
    runs = {
        name: delivery.deliver_due(i.event_log, request, folder, day, date(2024, 1, 3)).target
        for name, day in days.items()
    }
    schema = "auction_id string, request_time string, has_won double"
    targets = {target: name for name, target in reversed(runs.items())}
    parts = [
        readers.delimited(i.spark, target, schema).withColumn("run", F.lit(name)) for target, name in targets.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def lld_filter(i: Inputs) -> DataFrame:
    """Delivered events of two sub-advertisers in a local week."""
    request = _request(
        columns=["auction_id", "sub_advertiser_id", "has_won", "has_click", "has_conv"],
        start="2024-01-08",
        end="2024-01-15",
        level="sub_advertiser_id",
        ids=[1, 3],
        events_only=True,
    )
    return logextract.pull(i.event_log, request)


@query
def lld_agg(i: Inputs) -> DataFrame:
    group = ["advertiser_id", "campaign_id", "line_item_id", "nativead_id", "request_duid_sha256"]
    return logextract.performance_totals(i.event_log, group)


@query
def lld_performance(i: Inputs) -> DataFrame:
    """Totals of the delivered events of a local month per line item and device."""
    request = _request(columns=[], events_only=True)
    return reports.performance_report(i.event_log, ["line_item_id", "device_type"], request)


@query
def lld_performance_sample(i: Inputs) -> DataFrame:
    group = ["advertiser_id", "line_item_id", "request_duid_sha256"]
    return reports.performance_report(i.event_log, group, _request(columns=[]), sample=True)


@query
def lld_device_totals(i: Inputs) -> DataFrame:
    group = ["request_duid_sha256", "most_associated_duid_sha256", "campaign_id"]
    return logextract.performance_totals(i.event_log, group)


@query
def lld_zone(i: Inputs) -> DataFrame:
    return logextract.account_zone(i.users, i.utc_adjust)


@query
def lld_localtime(i: Inputs) -> DataFrame:
    """Each account's rows in its own zone, the zone being a column."""
    zones = logextract.account_zone(i.users, i.utc_adjust)
    log = i.event_log.select("auction_id", "request_time", F.col("sub_advertiser_id").alias("account_id"))
    zoned = log.join(zones, "account_id", "left")
    return zoned.select(
        "auction_id",
        "account_id",
        "zone",
        to_local("request_time", F.col("zone")).alias("local_time"),
        local_trunc("hour", "request_time", F.col("zone")).alias("local_hour"),
        local_trunc("day", "request_time", F.col("zone")).alias("local_day"),
    )


@query
def lld_string_table(i: Inputs) -> DataFrame:
    return logextract.text_columns(
        i.event_log.select("auction_id", "advertiser_id", "deal_id", "conv_tracker_id", "has_won")
    )


@query
def lld_sample(i: Inputs) -> DataFrame:
    rows = i.event_log.select("auction_id", "request_time", "cost")
    return logextract.sample_rows(rows, ["request_time", "auction_id"])


@query
def lld_pii(i: Inputs) -> DataFrame:
    rules = PrivacyRules(
        restricted_regions=frozenset({"FR", "CA"}),
        hidden_in_restricted=("dma", "request_duid_sha256"),
        hashed=("request_duid_sha256", "uniq_imp_id"),
        needs_consent=("ip_address",),
    )
    rows = i.event_log.select(
        "auction_id", "country", "has_consent", "dma", "request_duid_sha256", "uniq_imp_id", "ip_address"
    )
    return censor(rows, rules)


@query
def lld_timefmt(i: Inputs) -> DataFrame:
    micros = F.unix_micros(F.col("request_time").cast("timestamp"))
    mostly = F.date_format("request_time", "yyyy-MM-dd HH:mm:ss")
    rows = i.event_log.select(
        "auction_id",
        "request_time",
        F.col("request_time").cast("date").alias("visit_date"),
        F.when(F.col("has_won") == 0, mostly).otherwise(F.lit("n/a")).alias("click_time"),
        F.when(F.col("has_won") == 1, mostly).otherwise(F.lit("n/a")).alias("imp_time"),
        micros.alias("stats_imp_time"),
        F.lit("x").alias("lifetime"),
    )
    return time_text(rows)


def _edges(i: Inputs) -> DataFrame:
    """Edges as the graph files hold them, nested and untrimmed, flattened again."""
    nested = i.identity_edges.select(
        "luid",
        F.array(
            F.struct(F.col("duid").alias("id")), F.struct(F.concat(F.lit(" "), "duid").alias("id"))
        ).alias("duids"),
    )
    return identity.flatten_graph(nested)


def _crosswalk(i: Inputs) -> DataFrame:
    return identity.clean_crosswalk(i.synthetic_keys, "encryptedluid", "synthetic_key")


def _resolved(i: Inputs, restrict: bool = False) -> identity.Stitched:
    log = i.event_log.select("auction_id", "request_duid_sha256", "most_associated_duid_sha256")
    return identity.resolve(log, _edges(i), _crosswalk(i), restrict=restrict)


@query
def identity_edges_flat(i: Inputs) -> DataFrame:
    return identity.restrict_edges(_edges(i), identity.device_ids(i.event_log))


@query
def identity_pick(i: Inputs) -> DataFrame:
    return identity.pick_luids(_edges(i))


@query
def identity_key_pick(i: Inputs) -> DataFrame:
    luids = identity.pick_luids(_edges(i))
    return identity.pick_synthetic_keys(keys.matched(_crosswalk(i), luids, ["luid"]))


@query
def identity_match(i: Inputs) -> DataFrame:
    return _resolved(i).rows


@query
def identity_match_restricted(i: Inputs) -> DataFrame:
    """Graph and crosswalk cut down first; the rows are the same."""
    return _resolved(i, restrict=True).rows


@query
def identity_fill(i: Inputs) -> DataFrame:
    return identity.fill_alerts(_resolved(i).rates)


@query
def identity_export(i: Inputs) -> DataFrame:
    request = _request(columns=EXPORT_REQUEST_COLUMNS, events_only=True)
    return reports.identity_delivery(
        i.event_log, request, _hierarchy(i), _lookups(i), _edges(i), _crosswalk(i)
    ).rows


_CHAIN = """
select c.user_id as account_id, u.company_name as account_name, c.sub_advertiser_id as advertiser_id, s.name as advertiser_name,
       c.line_item_id as campaign_group_id, l.name as campaign_group_name, c.id as campaign_id, c.name as campaign_name,
       c.type as campaign_type, n.id as creative_id, n.name as creative_name
from native_ads n join campaigns_native_ads b on b.native_ad_id = n.id join campaigns c on c.id = b.campaign_id
join line_items l on l.id = c.line_item_id join sub_advertisers s on s.id = c.sub_advertiser_id
join users u on u.id = c.user_id
"""
_AUDIENCE = """
select id as auid_id, identifier as matched_cseg_and_rt, coalesce(display_name, name) as audience from custom_segments
union all select null, id, name from rt_segments
"""
_LOCAL = f"request_time at time zone 'UTC' at time zone '{ZONE}'"
_IN_JANUARY = f"{_LOCAL} >= timestamp '2024-01-01' and {_LOCAL} < timestamp '2024-02-01'"

CHECKS["lld_name_map"] = check_sql("select distinct * from chain", chain=_CHAIN)
CHECKS["lld_name_map_line_item"] = check_sql(
    """select distinct account_id, account_name, advertiser_id, advertiser_name, campaign_group_id, campaign_group_name
       from chain""",
    chain=_CHAIN,
)
CHECKS["lld_name_map_account"] = check_sql(
    "select distinct account_id, account_name from chain", chain=_CHAIN
)
CHECKS["lld_audience"] = check_sql(_AUDIENCE)
CHECKS["lld_report"] = check_sql(
    f"""select {_LOCAL} as request_time, cast(date_trunc('day', {_LOCAL}) as timestamp) as request_date,
               date_trunc('hour', {_LOCAL}) as request_hour, auction_id as event_id, e.campaign_id, nativead_id,
               e.matched_cseg_and_rt, cast(e.dma as varchar) as dma, cast(conv_tracker_id as varchar) as conv_tracker_id,
               cast(network_id as varchar) as network_id,
               case when e.deal_id in (select deal_id from inventory_byod_deals) then e.deal_id else '' end as deal_id,
               cast(has_won as double) as has_won, cast(cost as double) / 1000000 as cost,
               case when device_type = 'Mobile' then 'M' else 'D' end as device_code,
               h.account_id, h.account_name, h.advertiser_id, h.advertiser_name, h.campaign_group_id,
               h.campaign_group_name, h.campaign_name as ad_group_name, h.campaign_type, h.creative_id, h.creative_name,
               a.auid_id, a.audience, DMA_Name as dma_name, t.name as conversion_name,
               w.company_name as network_name, p.name as deal_name
        from event_log e left join chain h on h.creative_id = e.nativead_id
        left join audience a on a.matched_cseg_and_rt = e.matched_cseg_and_rt
        left join dma_names on DMA_Adjust = e.dma left join conversion_trackers t on t.id = e.conv_tracker_id
        left join ad_networks w on w.id = e.network_id left join programmatic_deals p on p.deal_id = e.deal_id
        where {_IN_JANUARY}""",
    chain=_CHAIN,
    audience=_AUDIENCE,
)
CHECKS["lld_report_hot"] = check_sql(
    f"""select {_LOCAL} as request_time, cast(date_trunc('day', {_LOCAL}) as timestamp) as request_date,
               date_trunc('hour', {_LOCAL}) as request_hour, auction_id, e.campaign_id, nativead_id,
               e.matched_cseg_and_rt, cast(e.dma as varchar) as dma, cast(conv_tracker_id as varchar) as conv_tracker_id,
               cast(network_id as varchar) as network_id,
               case when e.deal_id in (select deal_id from inventory_byod_deals) then e.deal_id else '' end as deal_id,
               cast(has_won as double) as has_won, cast(cost as double) / 1000000 as cost,
               h.account_id, h.account_name, h.advertiser_id, h.advertiser_name, h.campaign_group_id,
               h.campaign_group_name, h.campaign_name, h.campaign_type, h.creative_id, h.creative_name,
               a.auid_id, a.audience, DMA_Name as dma_name, t.name as conversion_name,
               w.company_name as network_name, p.name as deal_name
        from hot_log e left join chain h on h.creative_id = e.nativead_id
        left join audience a on a.matched_cseg_and_rt = e.matched_cseg_and_rt
        left join dma_names on DMA_Adjust = e.dma left join conversion_trackers t on t.id = e.conv_tracker_id
        left join ad_networks w on w.id = e.network_id left join programmatic_deals p on p.deal_id = e.deal_id
        where {_IN_JANUARY}""",
    chain=_CHAIN,
    audience=_AUDIENCE,
    hot_log="""
        select * replace (
            case when right(auction_id, 1) in ('0', '3', '6') then 'deal4' when right(auction_id, 1) = '4' then ''
                 when right(auction_id, 1) in ('1', '7') then null else deal_id end as deal_id,
            case when right(auction_id, 1) in ('0', '3', '6') then 7 else nativead_id end as nativead_id)
        from event_log""",
)
CHECKS["lld_report_line_item"] = check_sql(
    f"""select auction_id, line_item_id, cast(has_click as double) as has_click, h.*
        from event_log left join (select distinct account_id, account_name, advertiser_id, advertiser_name,
                                         campaign_group_id, campaign_group_name from chain) h
          on h.campaign_group_id = line_item_id where {_IN_JANUARY}""",
    chain=_CHAIN,
)
CHECKS["lld_report_retargeting"] = check_sql(
    f"""select auction_id, e.matched_cseg_and_rt, coalesce(e.deal_id, '') as deal_id, r.name as audience,
               p.name as deal_name
        from event_log e left join rt_segments r on r.id = e.matched_cseg_and_rt
        left join programmatic_deals p on p.deal_id = e.deal_id where {_IN_JANUARY}"""
)
CHECKS["lld_report_allowed"] = check_sql(
    f"""select auction_id, cast(date_trunc('day', {_LOCAL}) as timestamp) as request_date,
               cast(has_won as double) as has_won, device_type
        from event_log where {_IN_JANUARY}"""
)
_LATE = """
select auction_id, request_time, has_won from event_log
union all select 'LATE', timestamp '2024-01-10 04:59:59.5', 1
"""
for _name, _first in (("lld_pull_initial", "2024-01-03"), ("lld_pull_daily", "2024-01-09")):
    CHECKS[_name] = check_sql(
        f"""select auction_id, {_LOCAL} as request_time, cast(has_won as double) as has_won from late
            where {_LOCAL} >= timestamp '{_first}' and {_LOCAL} < timestamp '2024-01-10'""",
        late=_LATE,
    )
_RUN = f"""select auction_id, strftime({_LOCAL}, '%Y-%m-%d %H:%M:%S') as request_time,
       cast(has_won as double) as has_won, '{{run}}' as run
from event_log where {_LOCAL} >= timestamp '{{first}}' and {_LOCAL} < timestamp '{{end}}'"""
CHECKS["lld_pull_from_output"] = check_sql(
    f"""(select * from ({_RUN.format(run="sample", first="2024-01-03", end="2024-01-10")})
         order by request_time, auction_id limit 20)
        union all {_RUN.format(run="initial", first="2024-01-03", end="2024-01-10")}
        union all {_RUN.format(run="daily", first="2024-01-10", end="2024-01-11")}"""
)
CHECKS["lld_filter"] = check_sql(
    f"""select auction_id, sub_advertiser_id, cast(has_won as double) as has_won, cast(has_click as double) as has_click,
               cast(has_conv as double) as has_conv
        from event_log where sub_advertiser_id in (1, 3) and (has_won = 1 or has_click = 1 or has_conv = 1)
          and {_LOCAL} >= timestamp '2024-01-08' and {_LOCAL} < timestamp '2024-01-15'"""
)
_TOTALS = """
sum(cost) / 1000000 as cost_usd, cast(sum(has_won) as bigint) as impressions, cast(sum(has_click) as bigint) as clicks,
cast(sum(has_conv) as bigint) as conversions, cast(sum(has_ltconv) as bigint) as lt_conversions, count(*) as event_count
"""
CHECKS["lld_agg"] = check_sql(
    f"""select advertiser_id, campaign_id, line_item_id, nativead_id, request_duid_sha256, {_TOTALS}
        from event_log group by all"""
)
CHECKS["lld_performance"] = check_sql(
    f"""select line_item_id, device_type, {_TOTALS} from event_log
        where {_IN_JANUARY} and (has_won = 1 or has_click = 1 or has_conv = 1) group by line_item_id, device_type"""
)
CHECKS["lld_performance_sample"] = check_sql(
    f"""select advertiser_id, line_item_id, request_duid_sha256, {_TOTALS} from event_log where {_IN_JANUARY}
        group by 1, 2, 3 order by 1, 2, 3 limit 100"""
)
CHECKS["lld_device_totals"] = check_sql(
    f"""select request_duid_sha256, most_associated_duid_sha256, campaign_id, {_TOTALS}
        from event_log group by all"""
)
_ZONES = """
select id as account_id, coalesce(RS_timezone, 'UTC') as zone
from users u left join utc_adjust z on z.timezone = u.timezone
"""
CHECKS["lld_zone"] = check_sql(_ZONES)
CHECKS["lld_localtime"] = check_sql(
    """select auction_id, sub_advertiser_id as account_id, zone, request_time at time zone 'UTC' at time zone zone as local_time,
              date_trunc('hour', request_time at time zone 'UTC' at time zone zone) as local_hour,
              cast(date_trunc('day', request_time at time zone 'UTC' at time zone zone) as timestamp) as local_day
       from event_log left join zones on account_id = sub_advertiser_id""",
    zones=_ZONES,
)
CHECKS["lld_string_table"] = check_sql(
    """select auction_id, cast(advertiser_id as varchar) as advertiser_id, coalesce(deal_id, '') as deal_id,
              coalesce(cast(conv_tracker_id as varchar), '') as conv_tracker_id, cast(has_won as varchar) as has_won
       from event_log"""
)
CHECKS["lld_sample"] = check_sql(
    "select auction_id, request_time, cost from event_log order by request_time, auction_id limit 20"
)
CHECKS["lld_pii"] = check_sql(
    """select auction_id, country, has_consent, case when country not in ('FR', 'CA') then dma end as dma,
              case when country not in ('FR', 'CA') then sha256(request_duid_sha256) end as request_duid_sha256,
              sha256(uniq_imp_id) as uniq_imp_id, case when has_consent then ip_address end as ip_address
       from event_log"""
)
_TEXT = "strftime(request_time, '%Y-%m-%d %H:%M:%S')"
CHECKS["lld_timefmt"] = check_sql(
    f"""select auction_id, {_TEXT} as request_time, strftime(request_time, '%Y-%m-%d') || ' 00:00:00' as visit_date,
               case when has_won = 0 then {_TEXT} end as click_time,
               case when has_won = 1 then {_TEXT} else 'n/a' end as imp_time, {_TEXT} as stats_imp_time,
               'x' as lifetime from event_log"""
)
_DIRECTORY_STEPS = {
    "edges": "select distinct trim(luid) as luid, trim(duid) as duid from identity_edges",
    "luids": """
select duid, luid from edges
qualify row_number() over (partition by duid order by md5('42|' || duid || '|' || luid), luid) = 1
""",
    "pairs": """
select distinct encryptedluid as luid, synthetic_key from synthetic_keys
where encryptedluid is not null and synthetic_key is not null
""",
    "client_keys": """
select luid, synthetic_key from pairs
qualify row_number() over (partition by luid order by md5('42|' || luid || '|' || synthetic_key), synthetic_key) = 1
""",
}
_MATCH = """
select e.*, coalesce(a.luid, b.luid) as matched_luid, y.synthetic_key,
       case when a.luid is not null then 'request_duid_sha256'
            when b.luid is not null then 'most_associated_duid_sha256' end as luid_match_source
from (select auction_id, request_duid_sha256, most_associated_duid_sha256 from event_log) e
left join luids a on a.duid = e.request_duid_sha256
left join luids b on b.duid = e.most_associated_duid_sha256
left join client_keys y on y.luid = coalesce(a.luid, b.luid)
"""
CHECKS["identity_edges_flat"] = check_sql(
    """select luid, duid from edges where duid in (
           select request_duid_sha256 from event_log union select most_associated_duid_sha256 from event_log
           where most_associated_duid_sha256 is not null)""",
    edges=_DIRECTORY_STEPS["edges"],
)
CHECKS["identity_pick"] = check_sql("select * from luids", **_DIRECTORY_STEPS)
CHECKS["identity_key_pick"] = check_sql(
    "select * from client_keys where luid in (select luid from luids)", **_DIRECTORY_STEPS
)
CHECKS["identity_match"] = check_sql(_MATCH, **_DIRECTORY_STEPS)
CHECKS["identity_match_restricted"] = CHECKS["identity_match"]
CHECKS["identity_fill"] = check_sql(
    """select *, luid_fill_rate < 0.75 as luid_fill_alert, key_fill_rate < 0.65 as key_fill_alert from (
           select count(*) as total_rows, count(matched_luid) as rows_with_luid,
                  count(*) - count(matched_luid) as rows_without_luid, count(synthetic_key) as rows_with_key,
                  count(matched_luid) / count(*) as luid_fill_rate, count(synthetic_key) / count(*) as key_fill_rate
           from matches)""",
    **_DIRECTORY_STEPS,
    matches=_MATCH,
)
CHECKS["identity_export"] = check_sql(
    f"""select m.synthetic_key as client_key, h.campaign_group_id as campaign_id, h.campaign_group_name as campaign_name,
               h.campaign_id as ad_group_id, h.campaign_name as ad_group_name, h.advertiser_id, h.advertiser_name,
               supply_inventory_type as media_type, e.matched_cseg_and_rt as audience_id, audience as audience_name,
               h.creative_id, h.creative_name, device_type,
               case when has_click = 1 then 'click' when has_won = 1 then 'impression' end as event_type,
               e.auction_id as event_id, cast(cost as double) / 1000000 as total_cost, {_LOCAL} as "timestamp"
        from event_log e join matches m on m.auction_id = e.auction_id
        left join chain h on h.creative_id = e.nativead_id
        left join audience a on a.matched_cseg_and_rt = e.matched_cseg_and_rt
        where (has_won = 1 or has_click = 1 or has_conv = 1) and {_IN_JANUARY}""",
    **_DIRECTORY_STEPS,
    matches=_MATCH,
    chain=_CHAIN,
    audience=_AUDIENCE,
)
