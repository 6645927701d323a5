"""Sources and sinks: each query writes to a fresh folder and returns what it reads back."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.operators import reconcile
from adstrata.session import shared_folder
from adstrata.sources import readers, writers
from workload.monitoring import RECON_STEPS
from workload.views import Inputs, check_sql

QUERIES = {}
CHECKS = {}
DAY = date(2024, 1, 30)
ZONE = "America/New_York"


def query(function):
    QUERIES[function.__name__] = function
    return function


def _folder(i: Inputs) -> str:
    """A new folder in the place all executors can reach."""
    return f"{shared_folder(i.spark)}/storage-{uuid.uuid4().hex}"


_DEAL_SCHEMA = "opportunity_id string, account_id string, stage_name string, created_at date, close_date date, amount decimal(18,2)"


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("amount").cast("double"))


@query
def store_csv(i: Inputs) -> DataFrame:
    path = writers.deliver(i.opportunities, "csv", _folder(i))
    return _typed(readers.delimited(i.spark, path, _DEAL_SCHEMA))


@query
def store_psv_gz(i: Inputs) -> DataFrame:
    path = writers.deliver(i.opportunities, "psv_gz", _folder(i), prefix="deals", day=DAY)
    return _typed(readers.delimited(i.spark, path, _DEAL_SCHEMA, "|"))


@query
def store_single_file(i: Inputs) -> DataFrame:
    """A small delivery under its dated name; part files, as all deliveries."""
    path = writers.psv_gz(i.nation, _folder(i), "nations", DAY)
    schema = "n_nationkey int, n_name string, n_regionkey int"
    return readers.delimited(i.spark, path, schema, "|")


@query
def store_parquet(i: Inputs) -> DataFrame:
    path = writers.deliver(i.opportunities, "parquet", _folder(i))
    return _typed(readers.dimension(i.spark, path))


@query
def store_string_table(i: Inputs) -> DataFrame:
    path = writers.deliver(i.opportunities, "string_table", _folder(i))
    return readers.dimension(i.spark, path)


@query
def store_crosswalk(i: Inputs) -> DataFrame:
    path = writers.write_files(i.synthetic_keys, _folder(i), "psv", compress=True)
    pairs = readers.crosswalk(i.spark, path, "encryptedluid", "synthetic_key")
    return pairs.dropna().distinct()


@query
def store_nested_graph(i: Inputs) -> DataFrame:
    nested = i.identity_edges.select("luid", F.array(F.struct(F.col("duid").alias("id"))).alias("duids"))
    path = writers.write_files(nested, _folder(i), "parquet")
    return readers.identity_graph(i.spark, path).select("luid", F.explode("duids.id").alias("duid"))


@query
def store_evolving(i: Inputs) -> DataFrame:
    """The second load brings a new column."""
    path = _folder(i)
    events = i.events_k.select("event_id", "user_id", "event_type")
    writers.append_evolving(events.where("event_type = 'view'").drop("event_type"), path)
    writers.append_evolving(events.where("event_type <> 'view'"), path)
    return writers.read_evolving(i.spark, path)


@query
def store_append_twice(i: Inputs) -> DataFrame:
    """Three runs, the second one repeated with a new column: no row is doubled."""
    path = _folder(i)
    events = i.events_k.select("event_id", "user_id", "event_type")
    for run, kind in (("r1", "view"), ("r2", "click"), ("r3", "purchase"), ("r2", "click")):
        rows = events.where(F.col("event_type") == kind)
        writers.append_run(rows if run == "r3" else rows.drop("event_type"), path, run)
    return writers.read_evolving(i.spark, path).select("event_id", "user_id", "event_type", "run_id")


@query
def store_audit(i: Inputs) -> DataFrame:
    """All dates, then one date again: the rerun replaces that date only."""
    path = _folder(i)
    compared = reconcile.compare_advertisers(
        reconcile.log_totals(i.event_log), reconcile.stats_totals(i.campaign_daily_stats)
    )
    writers.audit_by_date(compared, path)
    rerun = reconcile.compare_advertisers(
        reconcile.log_totals(i.event_log, DAY), reconcile.stats_totals(i.campaign_daily_stats, DAY)
    )
    writers.audit_by_date(rerun, path)
    stored = i.spark.read.parquet(path)
    return stored.select("date", "cluster", "advertiser_id", "rs_imps", "automation_flag")


@query
def store_log_day(i: Inputs) -> DataFrame:
    path = writers.event_log_by_day(_log(i), _folder(i))
    return readers.event_day(i.spark, path, DAY)


@query
def store_log_range(i: Inputs) -> DataFrame:
    path = writers.event_log_by_day(_log(i), _folder(i))
    return readers.event_range(i.spark, path, datetime(2024, 1, 5, 6), datetime(2024, 1, 20, 18, 30))


@query
def store_log_local_days(i: Inputs) -> DataFrame:
    path = writers.event_log_by_day(_log(i), _folder(i))
    return readers.local_days(i.spark, path, date(2024, 1, 5), date(2024, 1, 20), ZONE)


@query
def store_latest_snapshot(i: Inputs) -> DataFrame:
    """Three snapshots a day; hour 16 is larger than hour 8 as a number, not as text."""
    path = _folder(i)
    at = F.col("request_time")
    hourly = _log(i).select(
        "*",
        F.year(at).alias("year"),
        F.month(at).alias("month"),
        F.dayofmonth(at).alias("day"),
        (F.hour(at) - F.hour(at) % 8).alias("hour"),
    )
    hourly.repartition("year", "month", "day", "hour").write.partitionBy(
        "year", "month", "day", "hour"
    ).parquet(path)
    return readers.latest_snapshot(i.spark, path)


@query
def store_report_table(i: Inputs) -> DataFrame:
    """A report table that is replaced once and then appended to, with text times."""
    path = _folder(i)
    name = f"report_{uuid.uuid4().hex}"
    half = F.col("advertiser_id") % 2 == 0
    writers.append_or_overwrite(_log(i), name, mode="overwrite", path=path)
    writers.append_or_overwrite(_log(i).where(half), name, mode="overwrite", path=path)
    writers.append_or_overwrite(_log(i).where(~half), name, path=path)
    return i.spark.table(name)


@query
def store_model_table(i: Inputs) -> DataFrame:
    """A table and a view of the same rows."""
    name = f"model_{uuid.uuid4().hex}"
    writers.as_table(_log(i), name, path=_folder(i))
    view = writers.as_view(_log(i), f"{name}_view")
    return i.spark.table(name).join(i.spark.table(view).select("auction_id"), "auction_id", "left_semi")


@query
def store_verify(i: Inputs) -> DataFrame:
    path = writers.write_files(i.opportunities, _folder(i), "parquet")
    return writers.verify(i.opportunities, i.spark.read.parquet(path))


def _log(i: Inputs) -> DataFrame:
    return i.event_log.select("auction_id", "request_time", "advertiser_id", "cost")


_DEALS = """
select opportunity_id, account_id, stage_name, created_at, close_date, cast(amount as double) as amount
from opportunities
"""
_LOG = "auction_id, request_time, advertiser_id, cost"

for _name in ("store_csv", "store_psv_gz", "store_parquet"):
    CHECKS[_name] = check_sql(_DEALS)
CHECKS["store_string_table"] = check_sql(
    """select opportunity_id, account_id, stage_name, cast(created_at as varchar) as created_at,
              coalesce(cast(close_date as varchar), '') as close_date, cast(amount as varchar) as amount
       from opportunities"""
)
CHECKS["store_crosswalk"] = check_sql(
    "select distinct encryptedluid, synthetic_key from synthetic_keys where synthetic_key is not null"
)
CHECKS["store_nested_graph"] = check_sql("select luid, duid from identity_edges")
CHECKS["store_evolving"] = check_sql(
    "select event_id, user_id, nullif(event_type, 'view') as event_type from events_k"
)
CHECKS["store_append_twice"] = check_sql(
    """select event_id, user_id, case when event_type = 'purchase' then event_type end as event_type,
              case event_type when 'view' then 'r1' when 'click' then 'r2' else 'r3' end as run_id
       from events_k where event_type in ('view', 'click', 'purchase')"""
)
CHECKS["store_audit"] = check_sql(
    "select date, cluster, advertiser_id, rs_imps, automation_flag from comparison", **RECON_STEPS
)
CHECKS["store_log_day"] = check_sql(
    f"""select {_LOG}, cast(request_time as date) as event_date from event_log
        where cast(request_time as date) = date '{DAY}'"""
)
CHECKS["store_log_range"] = check_sql(
    f"""select {_LOG}, cast(request_time as date) as event_date from event_log
        where request_time >= timestamp '2024-01-05 06:00:00' and request_time < timestamp '2024-01-20 18:30:00'"""
)
CHECKS["store_log_local_days"] = check_sql(
    f"""select {_LOG}, cast(request_time as date) as event_date from event_log
        where cast(request_time at time zone 'UTC' at time zone '{ZONE}' as date)
              between date '2024-01-05' and date '2024-01-20'"""
)
CHECKS["store_latest_snapshot"] = check_sql(
    f"""select {_LOG} from event_log
        where cast(request_time as date) = (select max(cast(request_time as date)) from event_log)
          and hour(request_time) // 8 = (select max(hour(request_time)) // 8 from event_log
                                         where cast(request_time as date) = (select max(cast(request_time as date)) from event_log))"""
)
CHECKS["store_report_table"] = check_sql(
    """select auction_id, strftime(request_time, '%Y-%m-%d %H:%M:%S') as request_time, advertiser_id, cost
       from event_log"""
)
CHECKS["store_model_table"] = check_sql(f"select {_LOG} from event_log")
CHECKS["store_single_file"] = "select n_nationkey, n_name, n_regionkey from nation"
CHECKS["store_verify"] = check_sql(
    """select count(*) as rows_written, count(*) as rows_found, true as is_complete from opportunities"""
)
