"""Reach and frequency queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.functions.times import local_trunc
from adstrata.operators import reach, reach_bitmaps
from workload.views import Inputs, check_sql

QUERIES = {}
CHECKS = {}
ZONE = "America/New_York"
GROUP = ["cg_id", "cg_name"]
EXACT = list(range(1, 11))

WINDOWS = [
    reach.LabelledWindow(date(2024, 1, 1), date(2024, 1, 8), "Week 1"),
    reach.LabelledWindow(date(2024, 1, 8), date(2024, 1, 15), "Week 2"),
    reach.LabelledWindow(date(2024, 1, 15), date(2024, 1, 22), "Week 3"),
    reach.LabelledWindow(date(2024, 1, 22), date(2024, 1, 31), "Week 4"),
    reach.LabelledWindow(date(2024, 1, 1), date(2024, 1, 31), "Total"),
]


def query(function):
    QUERIES[function.__name__] = function
    return function


def _log(i: Inputs) -> DataFrame:
    log = i.event_log.select(
        "line_item_id",
        "campaign_id",
        "uniq_imp_id",
        "has_won",
        local_trunc("day", "request_time", ZONE).alias("local_date"),
    )
    return reach.with_line_item_names(log, i.line_items)


def _won(i: Inputs) -> DataFrame:
    return _log(i).where(F.col("has_won") > 0)


@query
def reach_summary(i: Inputs) -> DataFrame:
    return reach.reach_summary(_won(i), GROUP)


@query
def reach_user_freq(i: Inputs) -> DataFrame:
    return reach.user_frequency(_log(i), GROUP)


@query
def reach_histogram(i: Inputs) -> DataFrame:
    return reach.frequency_histogram(reach.user_frequency(_won(i), GROUP), GROUP)


@query
def reach_cumulative(i: Inputs) -> DataFrame:
    return reach.cumulative_distribution(reach.user_frequency(_won(i), GROUP), GROUP)


@query
def reach_exact(i: Inputs) -> DataFrame:
    return reach.exact_distribution(reach.user_frequency(_won(i), GROUP), GROUP, EXACT)


@query
def reach_exact_counts(i: Inputs) -> DataFrame:
    """Every count that occurs, in long form."""
    return reach.exact_counts(reach.user_frequency(_won(i), GROUP), GROUP)


@query
def reach_exact_few(i: Inputs) -> DataFrame:
    """Two listed counts; the users of all others are in the last column."""
    return reach.exact_distribution(reach.user_frequency(_won(i), GROUP), GROUP, [1, 3])


@query
def reach_windows(i: Inputs) -> DataFrame:
    return reach.windowed_distribution(_won(i), GROUP, "local_date", WINDOWS)


@query
def reach_bitmap(i: Inputs) -> DataFrame:
    """Exact reach of all windows from daily bitmaps of users."""
    days = reach_bitmaps.user_days(_won(i), GROUP, "local_date")
    bitmaps = reach_bitmaps.daily_bitmaps(days, reach_bitmaps.number_users(days), GROUP)
    return reach_bitmaps.reach_of_windows(bitmaps, GROUP, WINDOWS)


@query
def reach_trailing(i: Inputs) -> DataFrame:
    return reach.trailing_distribution(_won(i), GROUP, "local_date", days=14, thresholds=range(1, 6))


@query
def reach_report(i: Inputs) -> DataFrame:
    frequency = reach.user_frequency(_won(i), GROUP)
    return reach.campaign_report(frequency, ["cg_id"], EXACT, name="cg_name")


@query
def reach_weekly(i: Inputs) -> DataFrame:
    return reach.weekly_report(_won(i), GROUP, "local_date", EXACT)


@query
def reach_alerts(i: Inputs) -> DataFrame:
    frequency = reach.user_frequency(_log(i), GROUP)
    distribution = reach.cumulative_distribution(frequency, GROUP, reach.SHORT_THRESHOLDS)
    return reach.saturation_alerts(distribution, max_average=1.2, min_reach=1000)


_LOG = f"""
select line_item_id, n.id as cg_id, n.name as cg_name, uniq_imp_id, has_won,
       cast(date_trunc('day', request_time at time zone 'UTC' at time zone '{ZONE}') as timestamp) as local_date
from event_log left join line_items n on n.id = line_item_id
"""
_WON = "select * from log where has_won > 0"
_FREQ = """
select cg_id, cg_name, uniq_imp_id, cast(sum(has_won) as bigint) as imps from {source}
where cg_id is not null and cg_name is not null group by all
"""
_BASE = "count(*) as reach, cast(sum(imps) as bigint) as impressions, sum(imps) / count(*) as avg_imp_per_user"


def _plus(thresholds) -> str:
    return ", ".join(f'count(*) filter (imps >= {k}) as "{k}+"' for k in thresholds)


def _times(counts) -> str:
    listed = ", ".join(map(str, counts))
    exact = ", ".join(f'count(*) filter (imps = {n}) as "{n}x"' for n in counts)
    return f'{exact}, count(*) filter (coalesce(imps not in ({listed}), true)) as other_x'


_STEPS = {"log": _LOG, "won": _WON, "freq": _FREQ.format(source="won")}

CHECKS["reach_summary"] = check_sql(
    """select cg_id, cg_name, count(distinct uniq_imp_id) as reach, cast(sum(has_won) as bigint) as impressions,
              count(*) / count(distinct uniq_imp_id) as frequency
       from won where cg_name is not null group by cg_id, cg_name""",
    log=_LOG,
    won=_WON,
)
CHECKS["reach_user_freq"] = check_sql("select * from freq", log=_LOG, freq=_FREQ.format(source="log"))
CHECKS["reach_histogram"] = check_sql(
    "select cg_id, cg_name, imps, count(*) as users from freq group by all", **_STEPS
)
CHECKS["reach_cumulative"] = check_sql(
    f"select cg_id, cg_name, {_BASE}, {_plus(range(1, 51))} from freq group by cg_id, cg_name", **_STEPS
)
CHECKS["reach_exact"] = check_sql(
    f"select cg_id, cg_name, {_BASE}, {_times(EXACT)} from freq group by cg_id, cg_name", **_STEPS
)
CHECKS["reach_exact_few"] = check_sql(
    f"select cg_id, cg_name, {_BASE}, {_times([1, 3])} from freq group by cg_id, cg_name", **_STEPS
)
CHECKS["reach_exact_counts"] = check_sql(
    """select cg_id, cg_name, imps, count(*) as users,
              cast(sum(count(*)) over (partition by cg_id, cg_name) as bigint) as reach,
              cast(sum(imps * count(*)) over (partition by cg_id, cg_name) as bigint) as impressions,
              sum(imps * count(*)) over (partition by cg_id, cg_name)
                / sum(count(*)) over (partition by cg_id, cg_name) as avg_imp_per_user
       from freq group by cg_id, cg_name, imps""",
    **_STEPS,
)
_WINDOW_ROWS = " union all ".join(
    f"select date '{w.start}' as s, date '{w.end}' as e, '{w.label}' as label" for w in WINDOWS
)
CHECKS["reach_windows"] = check_sql(
    f'select cg_id, cg_name, "window", {_BASE}, {_plus(range(1, 51))} from freq group by cg_id, cg_name, "window"',
    log=_LOG,
    won=_WON,
    windows=_WINDOW_ROWS,
    freq="""
select cg_id, cg_name, label as "window", uniq_imp_id, sum(has_won) as imps
from won join windows on local_date >= s and local_date < e where cg_name is not null group by all
""",
)
CHECKS["reach_bitmap"] = check_sql(
    """select cg_id, cg_name, label as "window", count(distinct uniq_imp_id) as reach,
              cast(sum(has_won) as bigint) as impressions
       from won join windows on local_date >= s and local_date < e
       where cg_name is not null and uniq_imp_id is not null group by all""",
    log=_LOG,
    won=_WON,
    windows=_WINDOW_ROWS,
)
CHECKS["reach_trailing"] = check_sql(
    f"select cg_id, cg_name, {_BASE}, {_plus(range(1, 6))} from freq group by cg_id, cg_name",
    log=_LOG,
    won=_WON,
    recent="""
select * from won where local_date < (select max(local_date) from won)
  and local_date >= (select max(local_date) from won) - interval 14 day
""",
    freq=_FREQ.format(source="recent"),
)
_REPORT = (
    "count(*) as reach, cast(sum(imps) as bigint) as total_impressions, "
    f"round(sum(imps) / count(*), 2) as avg_frequency, {_times(EXACT)}, {_plus(reach.SHORT_THRESHOLDS)}"
)
CHECKS["reach_report"] = check_sql(
    f"select cg_id, min(cg_name) as cg_name, {_REPORT} from freq group by cg_id", **_STEPS
)
CHECKS["reach_weekly"] = check_sql(
    f"select iso_year, week, cg_id, cg_name, {_REPORT} from freq group by iso_year, week, cg_id, cg_name",
    log=_LOG,
    won=_WON,
    freq="""
select cast(isoyear(local_date) as int) as iso_year, cast(weekofyear(local_date) as int) as week, cg_id, cg_name, uniq_imp_id, sum(has_won) as imps
from won where cg_name is not null group by all
""",
)
CHECKS["reach_alerts"] = check_sql(
    """select *, 'avg_frequency' as alert, 'WARNING' as level from dist where impressions / reach > 1.2
       union all select *, 'frequent_users', 'WARNING' from dist where "10+" / reach >= 0.5
       union all select *, 'low_reach', 'INFO' from dist where reach < 1000""",
    log=_LOG,
    freq=_FREQ.format(source="log"),
    dist=f"select cg_id, cg_name, {_BASE}, {_plus(reach.SHORT_THRESHOLDS)} from freq group by cg_id, cg_name",
)
