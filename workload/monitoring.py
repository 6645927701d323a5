"""Table health and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.operators import health, keys, reconcile
from adstrata.plans import reports
from workload.views import ORDERS_AS_OF, Inputs, check_sql

QUERIES = {}
CHECKS = {}
STAGES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
ACCOUNT_FIELDS = ["account_id", "account_name", "segment", "updated_at"]
DEAL_FIELDS = ["opportunity_id", "account_id", "stage_name", "amount_reporting", "updated_at"]


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def health_required(i: Inputs) -> DataFrame:
    return health.combine(
        health.required_fields(i.accounts, "accounts", [*ACCOUNT_FIELDS, "owner"]),
        health.required_fields(i.crm_opportunities, "opportunities", DEAL_FIELDS),
    )


@query
def health_duplicates(i: Inputs) -> DataFrame:
    return health.combine(
        health.duplicate_key(i.accounts, "accounts", "account_id"),
        health.duplicate_key(i.crm_opportunities, "opportunities", "opportunity_id"),
    )


@query
def health_composite_unique(i: Inputs) -> DataFrame:
    delivery = i.fct_campaign_daily_delivery
    return health.combine(
        health.duplicate_key(delivery, "delivery_by_day", ["activity_date", "campaign_id"]),
        health.duplicate_key(
            delivery,
            "delivery",
            ["activity_date", "campaign_id", "line_item_id", "supply_inventory_type", "device_type"],
        ),
    )


@query
def health_freshness(i: Inputs) -> DataFrame:
    return health.combine(
        health.freshness(i.accounts, "accounts", "updated_at", 2, ORDERS_AS_OF),
        health.freshness(i.crm_opportunities, "opportunities", "updated_at", 2, ORDERS_AS_OF),
    )


@query
def health_valid_values(i: Inputs) -> DataFrame:
    return health.valid_values(i.crm_opportunities, "opportunities", "stage_name", STAGES)


@query
def health_invalid_values(i: Inputs) -> DataFrame:
    return health.invalid_values(i.crm_opportunities, "stage_name", STAGES)


@query
def health_revenue(i: Inputs) -> DataFrame:
    return health.revenue_reconciliation(i.crm_opportunities, i.revenue_source)


@query
def health_mismatch_rows(i: Inputs) -> DataFrame:
    rows = health.revenue_mismatches(i.crm_opportunities, i.revenue_source)
    return rows.select(
        "opportunity_id",
        "account_id",
        "source_rows",
        *[
            F.col(n).cast("double").alias(n)
            for n in ("amount_reporting", "amount_source", "revenue_difference")
        ],
    )


@query
def health_top_mismatches(i: Inputs) -> DataFrame:
    rows = health.revenue_mismatches(i.crm_opportunities, i.revenue_source)
    return health.largest_mismatches(rows).select(
        "opportunity_id", F.col("revenue_difference").cast("double").alias("revenue_difference")
    )


@query
def health_revenue_strict(i: Inputs) -> DataFrame:
    return health.revenue_reconciliation_strict(
        i.crm_opportunities,
        i.revenue_source,
        "opportunity_id",
        "opportunity_id",
        "amount_reporting",
        "amount_source",
    )


@query
def health_row_drop(i: Inputs) -> DataFrame:
    return health.row_count_drop(i.row_count_history)


@query
def health_ref_integrity(i: Inputs) -> DataFrame:
    return health.combine(
        health.referential_integrity(
            i.crm_opportunities, i.accounts, "opportunities", "account_id"
        ),
        health.referential_integrity(
            i.fct_campaign_daily_delivery.select(F.col("campaign_id").cast("string").alias("campaign_id")),
            i.dim_campaigns,
            "delivery",
            "campaign_id",
        ),
    )


def _profiles(i: Inputs) -> DataFrame:
    return health.missing_profile(i.accounts, "accounts").unionByName(
        health.missing_profile(i.crm_opportunities, "opportunities")
    )


@query
def health_missing_profile(i: Inputs) -> DataFrame:
    return _profiles(i).withColumn("missing_pct", F.round("missing_pct", 6))


@query
def health_missing(i: Inputs) -> DataFrame:
    return health.missing_values(_profiles(i))


@query
def health_row_delta(i: Inputs) -> DataFrame:
    deals = i.crm_opportunities
    deduped = keys.keep_first(deals, ["opportunity_id"], ["account_id"])
    per_account = deals.groupBy("account_id").agg(F.count(F.lit(1)).alias("deals"))
    return health.combine(
        health.row_delta(deals, deduped, "deduplicated"),
        health.row_delta(deals, per_account, "per_account"),
    )


@query
def health_rows_preserved(i: Inputs) -> DataFrame:
    deals = i.crm_opportunities
    named = deals.join(i.accounts.select("account_id", "account_name"), "account_id", "left")
    doubled = deals.join(i.revenue_source, "opportunity_id", "left")
    return health.combine(
        health.rows_preserved(deals, named, "with_names"),
        health.rows_preserved(deals, doubled, "with_source"),
    )


def _all_checks(i: Inputs) -> DataFrame:
    return reports.reporting_health(
        i.accounts,
        i.crm_opportunities,
        i.revenue_source,
        i.row_count_history,
        STAGES,
        ORDERS_AS_OF,
    )


@query
def health_report(i: Inputs) -> DataFrame:
    return _all_checks(i)


@query
def health_score(i: Inputs) -> DataFrame:
    return health.health_score(_all_checks(i))


@query
def health_severity(i: Inputs) -> DataFrame:
    return health.with_severity(_all_checks(i)).select("check_name", "table_name", "status", "severity")


@query
def recon_clusters(i: Inputs) -> DataFrame:
    """The log arrives as one frame per cluster and is stacked again."""
    log = i.event_log
    frames = {str(n): log.where(F.col("cluster") == n).drop("cluster") for n in range(4)}
    return reconcile.log_totals(reconcile.cluster_log(frames))


@query
def recon_advertiser(i: Inputs) -> DataFrame:
    return reports.advertiser_check(i.event_log, i.campaign_daily_stats)


@query
def recon_stats_denominator(i: Inputs) -> DataFrame:
    """Percentages relate to the statistics, over all clusters of an advertiser."""
    return reconcile.compare_advertisers(
        reconcile.log_totals(i.event_log),
        reconcile.stats_totals(i.campaign_daily_stats),
        denominator="stats",
        sum_clusters=True,
    )


@query
def recon_summary(i: Inputs) -> DataFrame:
    return reconcile.comparison_summary(recon_advertiser(i))


@query
def recon_clean_advertisers(i: Inputs) -> DataFrame:
    return reconcile.clean_advertisers(recon_advertiser(i))


def _check_row(check: str, table: str, failed: str, detail: str, source: str) -> str:
    return f"""
select '{check}' as check_name, '{table}' as table_name, case when n = 0 then 'pass' else 'fail' end as status,
       cast(n as bigint) as failed_rows, {detail} as detail from (select {failed} as n from {source})
"""


def _null_row(table: str, source: str, field: str) -> str:
    return _check_row(
        "required_field_not_null",
        table,
        f"count(*) filter ({field} is null)",
        f"'{field} has ' || n || ' missing value(s).'",
        source,
    )


def _duplicate_row(table: str, source: str, key: str) -> str:
    return _check_row(
        "duplicate_primary_key",
        table,
        "coalesce(sum(c), 0)",
        f"'{key} has ' || n || ' duplicated row(s).'",
        f"(select count(*) as c from {source} group by {key}) where c > 1",
    )


def _fresh_row(table: str, source: str) -> str:
    age = f"date_diff('day', max(updated_at), date'{ORDERS_AS_OF}')"
    return f"""
select 'freshness' as check_name, '{table}' as table_name, case when {age} <= 2 then 'pass' else 'fail' end as status,
       case when {age} <= 2 then 0 else count(*) end as failed_rows,
       'Newest record is ' || {age} || ' day(s) old.' as detail from {source}
"""


_STAGE_LIST = ", ".join(f"'{s}'" for s in STAGES)
_VALID_ROW = f"""
select 'valid_values' as check_name, 'opportunities' as table_name, case when n = 0 then 'pass' else 'fail' end as status,
       n as failed_rows, 'stage_name has ' || n || ' invalid row(s) of ' || kinds || ' value(s).' as detail
from (select count(*) as n, count(distinct coalesce('=' || stage_name, '')) as kinds
      from crm_opportunities where stage_name is null or stage_name not in ({_STAGE_LIST}))
"""
_MISMATCHES = """
select o.opportunity_id, coalesce(o.amount_reporting, 0) as amount_reporting,
       coalesce(r.amount_source, 0) as amount_source,
       coalesce(o.amount_reporting, 0) - coalesce(r.amount_source, 0) as revenue_difference
from crm_opportunities o left join revenue_source r on o.opportunity_id = r.opportunity_id
where abs(coalesce(o.amount_reporting, 0) - coalesce(r.amount_source, 0)) > 1
"""
_REVENUE_ROW = _check_row(
    "revenue_reconciliation", "opportunities", "count(*)", "n || ' revenue mismatches found.'", "mismatches"
)
_DROP_ROWS = """
select 'row_count_drop' as check_name, table_name, case when d <= 0.2 then 'pass' else 'fail' end as status,
       case when d <= 0.2 then 0 else row_count end as failed_rows,
       'Row count changed by ' || printf('%.1f', d * 100) || '%' as detail
from (select *, coalesce((prev - row_count) / nullif(prev, 0), 0) as d from (
        select *, lag(row_count) over (partition by table_name order by snapshot_date) as prev,
               row_number() over (partition by table_name order by snapshot_date desc) as newest
        from row_count_history)
      where newest = 1)
"""
_REPORT = " union all ".join(
    [
        *[_null_row("accounts", "accounts", f) for f in ACCOUNT_FIELDS],
        *[_null_row("opportunities", "crm_opportunities", f) for f in DEAL_FIELDS],
        _duplicate_row("accounts", "accounts", "account_id"),
        _duplicate_row("opportunities", "crm_opportunities", "opportunity_id"),
        _fresh_row("accounts", "accounts"),
        _fresh_row("opportunities", "crm_opportunities"),
        _VALID_ROW,
        _REVENUE_ROW,
        _DROP_ROWS,
    ]
)
_MISSING_OWNER = """
select 'required_field_exists' as check_name, 'accounts' as table_name, 'fail' as status, count(*) as failed_rows,
       'owner is missing.' as detail from accounts
"""

CHECKS["health_required"] = check_sql(
    " union all ".join(
        [
            *[_null_row("accounts", "accounts", f) for f in ACCOUNT_FIELDS],
            _MISSING_OWNER,
            *[_null_row("opportunities", "crm_opportunities", f) for f in DEAL_FIELDS],
        ]
    )
)
CHECKS["health_duplicates"] = check_sql(
    " union all ".join(
        [
            _duplicate_row("accounts", "accounts", "account_id"),
            _duplicate_row("opportunities", "crm_opportunities", "opportunity_id"),
        ]
    )
)
CHECKS["health_composite_unique"] = check_sql(
    " union all ".join(
        [
            _duplicate_row("delivery_by_day", "fct_campaign_daily_delivery", "activity_date, campaign_id"),
            _duplicate_row(
                "delivery",
                "fct_campaign_daily_delivery",
                "activity_date, campaign_id, line_item_id, supply_inventory_type, device_type",
            ),
        ]
    )
)
CHECKS["health_freshness"] = check_sql(
    _fresh_row("accounts", "accounts") + " union all " + _fresh_row("opportunities", "crm_opportunities")
)
CHECKS["health_valid_values"] = check_sql(_VALID_ROW)
CHECKS["health_invalid_values"] = check_sql(
    f"""select stage_name as "value", count(*) as "rows" from crm_opportunities
        where stage_name is null or stage_name not in ({_STAGE_LIST}) group by stage_name"""
)
CHECKS["health_revenue"] = check_sql(_REVENUE_ROW, mismatches=_MISMATCHES)
CHECKS["health_mismatch_rows"] = check_sql(
    """select o.opportunity_id, account_id, coalesce(n, 1) as source_rows,
              cast(coalesce(amount_reporting, 0) as double) as amount_reporting,
              cast(coalesce(amount_source, 0) as double) as amount_source,
              cast(coalesce(amount_reporting, 0) - coalesce(amount_source, 0) as double) as revenue_difference
       from crm_opportunities o left join (
            select opportunity_id, amount_source, count(*) as n from revenue_source group by all) r
         on r.opportunity_id = o.opportunity_id
       where abs(coalesce(amount_reporting, 0) - coalesce(amount_source, 0)) > 1""",
)
CHECKS["health_top_mismatches"] = check_sql(
    """select o.opportunity_id,
              cast(coalesce(amount_reporting, 0) - coalesce(amount_source, 0) as double) as revenue_difference
       from crm_opportunities o left join (select distinct opportunity_id, amount_source from revenue_source) r
         on r.opportunity_id = o.opportunity_id
       where abs(coalesce(amount_reporting, 0) - coalesce(amount_source, 0)) > 1
       order by abs(coalesce(amount_reporting, 0) - coalesce(amount_source, 0)) desc, o.opportunity_id,
                coalesce(amount_reporting, 0), coalesce(amount_source, 0) limit 20"""
)
CHECKS["health_revenue_strict"] = check_sql(
    """select 'reconciliation' as check_name, 'revenue' as table_name,
              case when count(*) = 0 then 'pass' else 'fail' end as status, count(*) as failed_rows,
              case when count(*) = 0 then '' else
                  'Revenue mismatch: $' || printf('%.2f', cast(sum(d) as double)) || ' across ' || count(*) || ' records' end as detail
       from (select abs(o.amount_reporting - r.amount_source) as d
             from crm_opportunities o join revenue_source r on o.opportunity_id = r.opportunity_id)
       where d > 0.01"""
)
CHECKS["health_row_drop"] = check_sql(_DROP_ROWS)


def _orphan_row(table: str, source: str, key: str, parent: str) -> str:
    return f"""
select 'referential_integrity' as check_name, '{table}' as table_name,
       case when count(*) = 0 then 'pass' else 'fail' end as status, count(*) as failed_rows,
       case when count(*) = 0 then '' else 'Found ' || count(*) || ' {table} with non-existent {key}' end as detail
from {source} c where not exists (select 1 from {parent} p where p.{key} = cast(c.{key} as varchar))
"""


CHECKS["health_ref_integrity"] = check_sql(
    _orphan_row("opportunities", "crm_opportunities", "account_id", "accounts")
    + " union all "
    + _orphan_row("delivery", "fct_campaign_daily_delivery", "campaign_id", "dim_campaigns")
)
_PROFILE = " union all ".join(
    f"""select '{table}' as table_name, '{column}' as column_name,
               count(*) filter ({column} is null) as missing_count,
               round(count(*) filter ({column} is null) / count(*) * 100, 6) as missing_pct from {source}"""
    for table, source, columns in (
        ("accounts", "accounts", ["account_id", "account_name", "segment", "region_id", "updated_at"]),
        ("opportunities", "crm_opportunities", DEAL_FIELDS),
    )
    for column in columns
)
CHECKS["health_missing_profile"] = check_sql(_PROFILE)
CHECKS["health_missing"] = check_sql(
    """select 'missing_values' as check_name, 'structural' as table_name,
              case when sum(missing_count) = 0 then 'pass' else 'fail' end as status,
              cast(sum(missing_count) as bigint) as failed_rows,
              case when sum(missing_count) = 0 then '' else
                  'Found missing values in ' || count(*) filter (missing_count > 0) || ' column(s)' end as detail
       from profile""",
    profile=_PROFILE,
)


def _delta_row(check: str, table: str, after: str, limit: float) -> str:
    return f"""
select '{check}' as check_name, '{table}' as table_name,
       case when abs(a - b) / b <= {limit} then 'pass' else 'fail' end as status,
       case when abs(a - b) / b <= {limit} then 0 else abs(a - b) end as failed_rows,
       'Row count changed by ' || printf('%.1f', abs(a - b) / b * 100) || '%' as detail
from (select (select count(*) from crm_opportunities) as b, ({after}) as a)
"""


CHECKS["health_row_delta"] = check_sql(
    _delta_row(
        "row_count_delta", "deduplicated", "select count(distinct opportunity_id) from crm_opportunities", 0.05
    )
    + " union all "
    + _delta_row(
        "row_count_delta",
        "per_account",
        "select count(*) from (select distinct account_id from crm_opportunities)",
        0.05,
    )
)
CHECKS["health_rows_preserved"] = check_sql(
    _delta_row("rows_preserved", "with_names", "select count(*) from crm_opportunities", 0.0)
    + " union all "
    + _delta_row(
        "rows_preserved",
        "with_source",
        "select count(*) from crm_opportunities o join revenue_source r on o.opportunity_id = r.opportunity_id",
        0.0,
    )
)
CHECKS["health_report"] = check_sql(_REPORT, mismatches=_MISMATCHES)
CHECKS["health_score"] = check_sql(
    """select count(*) as total_checks, count(*) filter (status = 'pass') as passed_checks,
              count(*) filter (status = 'fail') as failed_checks,
              round(count(*) filter (status = 'pass') / count(*) * 100, 1) as health_score,
              string_agg(distinct case when status = 'fail' then table_name || '.' || check_name end, ', '
                         order by case when status = 'fail' then table_name || '.' || check_name end) as failed_list
       from report""",
    mismatches=_MISMATCHES,
    report=_REPORT,
)
CHECKS["health_severity"] = check_sql(
    """select check_name, table_name, status,
              case when status = 'fail' then case
                   when check_name in ('required_field_not_null', 'required_field_exists', 'freshness') then 'WARNING'
                   when check_name in ('duplicate_primary_key', 'valid_values', 'revenue_reconciliation') then 'CRITICAL'
              end end as severity
       from report""",
    mismatches=_MISMATCHES,
    report=_REPORT,
)

_LOG_TOTALS = """
select cast(request_time as date) as date, cluster, advertiser_id, sum(cost) / 1000000 as rs_cost,
       cast(sum(has_won) as bigint) as rs_imps, cast(sum(has_click) as bigint) as rs_click,
       cast(sum(has_conv) as bigint) as rs_conv, cast(sum(has_ltconv) as bigint) as rs_ltconv
from event_log group by all
"""
_STATS_TOTALS = """
select date, advertiser_id, stats_cost, stats_imps, stats_click,
       case when skans > 0 then greatest(stats_conv - skans, 0) else stats_conv end as stats_conv,
       case when skans > 0 then greatest(stats_ltconv - skans, 0) else stats_ltconv end as stats_ltconv
from (select cast(cached_hour as date) as date, user_id as advertiser_id,
             cast(sum(cost) as double) / 1000000 as stats_cost, cast(sum(imp) as bigint) as stats_imps,
             cast(sum(click) as bigint) as stats_click, cast(sum(conv) as bigint) as stats_conv,
             cast(sum(ltc) as bigint) as stats_ltconv, cast(sum(skan_conv) as bigint) as skans
      from campaign_daily_stats group by all)
"""
_METRICS = ["cost", "imps", "click", "conv", "ltconv"]


def _comparison(base: str) -> str:
    diffs = ", ".join(f"round_even(cast(stats_{m} - rs_{m} as double), 4) as {m}_diff" for m in _METRICS)
    percs = ", ".join(f"round_even({m}_diff / nullif({base}_{m}, 0) * 100, 4) as {m}_perc" for m in _METRICS)
    flag = " or ".join(
        f"coalesce(abs({m}_perc) > 0.5, false) or coalesce({base}_{m} = 0 and {m}_diff <> 0, false)"
        for m in _METRICS
    )
    return f"""
select *, {flag} as automation_flag, stats_imps is null as missing_in_stats
from (select *, {percs} from (
        select l.*, s.* exclude (date, advertiser_id), {diffs} from totals l
        left join stats s on s.date = l.date and s.advertiser_id = l.advertiser_id))
"""


RECON_STEPS = {"totals": _LOG_TOTALS, "stats": _STATS_TOTALS, "comparison": _comparison("rs")}
CHECKS["recon_clusters"] = check_sql(
    "select * replace (cast(cluster as varchar) as cluster) from totals", totals=_LOG_TOTALS
)
CHECKS["recon_advertiser"] = check_sql("select * from comparison", **RECON_STEPS)
CHECKS["recon_stats_denominator"] = check_sql(
    "select * from comparison",
    cluster_totals=_LOG_TOTALS,
    totals="""
select date, advertiser_id, 'all' as cluster, cast(sum(cast(rs_cost as decimal(28,6))) as double) as rs_cost,
       cast(sum(rs_imps) as bigint) as rs_imps, cast(sum(rs_click) as bigint) as rs_click,
       cast(sum(rs_conv) as bigint) as rs_conv, cast(sum(rs_ltconv) as bigint) as rs_ltconv
from cluster_totals group by date, advertiser_id
""",
    stats=_STATS_TOTALS,
    comparison=_comparison("stats"),
)
CHECKS["recon_summary"] = check_sql(
    "select date, bool_or(automation_flag) as automation_flag, count(*) filter (automation_flag) as flagged_rows, "
    + ", ".join(f"max(abs({m}_{kind})) as max_{m}_{kind}" for m in _METRICS for kind in ("diff", "perc"))
    + " from comparison group by date",
    **RECON_STEPS,
)
CHECKS["recon_clean_advertisers"] = check_sql(
    "select date, cluster, advertiser_id from comparison where not automation_flag", **RECON_STEPS
)
