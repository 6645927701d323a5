"""Attribution queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.operators import attribution, keys, touch_quality
from adstrata.plans import reports
from workload.views import ORDERS_AS_OF, Inputs, check_sql

QUERIES = {}
CHECKS = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _cleaned(i: Inputs) -> tuple[DataFrame, DataFrame]:
    return (
        touch_quality.clean_opportunities(i.opportunities),
        touch_quality.clean_touchpoints(i.touchpoints),
    )


def _fact(i: Inputs, keep: list[str] | None = None, deal_credit: bool = False) -> DataFrame:
    return attribution.touchpoint_fact(*_cleaned(i), as_of=ORDERS_AS_OF, keep=keep, deal_credit=deal_credit)


def _as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("amount").cast("double"))


@query
def attr_quality_flags(i: Inputs) -> DataFrame:
    return touch_quality.touchpoint_issues(*_cleaned(i))


@query
def attr_issue_counts(i: Inputs) -> DataFrame:
    return touch_quality.issue_counts(attr_quality_flags(i))


@query
def attr_orphans(i: Inputs) -> DataFrame:
    orphans = keys.unmatched(i.touchpoints, i.opportunities, ["opportunity_id"])
    return orphans.select("touchpoint_id", "opportunity_id", "account_id")


@query
def attr_matched(i: Inputs) -> DataFrame:
    found = keys.matched(i.touchpoints, i.opportunities, ["opportunity_id"])
    return found.select("touchpoint_id", "opportunity_id", "account_id")


@query
def attr_validated(i: Inputs) -> DataFrame:
    return touch_quality.validate_touchpoints(i.opportunities, i.touchpoints).valid


@query
def attr_anomalies(i: Inputs) -> DataFrame:
    return touch_quality.validate_touchpoints(i.opportunities, i.touchpoints).anomalies


@query
def attr_clean_fact(i: Inputs) -> DataFrame:
    return _as_double(_fact(i))


# The deal that gets a third of all touches in the hot query, half of them without a date.
HOT_DEAL = "select min(opportunity_id) as opportunity_id, min_by(account_id, opportunity_id) as account_id from opportunities where close_date is null"
HOT_TOUCHES = f"""
select touchpoint_id, campaign_id, campaign_type, channel,
       case when hot then deal.opportunity_id else t.opportunity_id end as opportunity_id,
       case when hot then deal.account_id else t.account_id end as account_id,
       case when hot and right(touchpoint_id, 1) in ('1', '3', '5', '7', '9') then null else touch_date end as touch_date
from (select *, substring(touchpoint_id, length(touchpoint_id) - 1, 1) in ('0', '3', '6') as hot from touchpoints) t
     left join ({HOT_DEAL}) deal on t.hot
"""


@query
def attr_fact_hot(i: Inputs) -> DataFrame:
    """One open deal owns a third of the touches, many of them without a date."""
    deals, touches = _cleaned(i)
    hot = i.opportunities.where("close_date is null").agg(
        F.min("opportunity_id").alias("hot_deal"), F.min_by("account_id", "opportunity_id").alias("hot_account")
    )
    name = F.col("touchpoint_id")
    is_hot = F.substring(name, -2, 1).isin("0", "3", "6")
    touches = (
        touches.withColumn("_one", is_hot).join(F.broadcast(hot.withColumn("_one", F.lit(True))), "_one", "left")  # one row
        .withColumns({
            "opportunity_id": F.when(is_hot, F.col("hot_deal")).otherwise(F.col("opportunity_id")),
            "account_id": F.when(is_hot, F.col("hot_account")).otherwise(F.col("account_id")),
            "touch_date": F.when(~(is_hot & F.substring(name, -1, 1).isin("1", "3", "5", "7", "9")), F.col("touch_date")),
        }).drop("_one", "hot_deal", "hot_account")
    )
    fact = attribution.touchpoint_fact(deals, touches, as_of=ORDERS_AS_OF)
    return fact.select("touchpoint_id", "opportunity_id", "touch_date", "touch_sequence", "touch_count", "is_first_touch", "is_last_touch")


@query
def attr_won_fact(i: Inputs) -> DataFrame:
    """Only deals that were won take part."""
    fact = attribution.touchpoint_fact(*_cleaned(i), as_of=ORDERS_AS_OF, stages=["Closed Won"])
    return fact.select("touchpoint_id", "opportunity_id", "touch_sequence", "touch_count")


@query
def attr_influence(i: Inputs) -> DataFrame:
    influence = attribution.assign_influence(_fact(i)).select(
        "touchpoint_id",
        "opportunity_id",
        "first_touch_influence",
        "last_touch_influence",
        "even_touch_influence",
        "position_weight",
        "weighted_influence",
    )
    return _rounded(influence, "even_touch_influence", "position_weight", "weighted_influence")


@query
def attr_influence_unnamed(i: Inputs) -> DataFrame:
    """Some touches have no id; the credit of a deal still adds up to its value."""
    deals, touches = _cleaned(i)
    nameless = F.regexp_extract("touchpoint_id", "([0-9])$", 1).isin("1", "5")
    touches = touches.withColumn("touchpoint_id", F.when(~nameless, F.col("touchpoint_id")))
    fact = attribution.touchpoint_fact(deals, touches, as_of=ORDERS_AS_OF)
    return (
        attribution.assign_influence(fact)
        .groupBy("opportunity_id")
        .agg(
            F.count(F.lit(1)).alias("touch_rows"),
            F.round(F.max("position_weight"), 6).alias("largest_weight"),
            F.round(F.sum("weighted_influence"), 2).alias("credited"),
            F.round(F.max(F.col("amount").cast("double")), 2).alias("amount"),
        )
    )


@query
def attr_summary(i: Inputs) -> DataFrame:
    return reports.attribution_report(i.opportunities, i.touchpoints, ORDERS_AS_OF).summary


@query
def attr_top8(i: Inputs) -> DataFrame:
    return attribution.top_campaigns(attr_summary(i))


@query
def attr_long_models(i: Inputs) -> DataFrame:
    long = attribution.attribution_by_model(_fact(i))
    return _rounded(_as_double(long), "allocated_revenue")


@query
def attr_normalized(i: Inputs) -> DataFrame:
    fact = _fact(i, attribution.CREDITED, deal_credit=True)
    scaled = attribution.normalise_allocations(attribution.attribution_by_model(fact))
    return _rounded(_as_double(scaled), "allocated_revenue")


@query
def attr_allocation_errors(i: Inputs) -> DataFrame:
    """Unscaled U-shaped credit of two-touch deals misses a fifth of the deal value."""
    errors = attribution.allocation_errors(attribution.attribution_by_model(_fact(i, attribution.CREDITED)))
    return _rounded(errors, "allocated_revenue")


@query
def attr_channel_model(i: Inputs) -> DataFrame:
    by_channel = reports.channel_attribution(i.opportunities, i.touchpoints, ORDERS_AS_OF)
    return by_channel.withColumn("allocated_revenue", F.round("allocated_revenue", 2))


_TOUCHES = """
select touchpoint_id, opportunity_id, account_id, campaign_id,
       coalesce(campaign_type, 'Unknown') as campaign_type,
       coalesce(channel, 'Unknown') as channel, touch_date
from touchpoints
"""

_FLAGGED = """
select t.*, case
         when t.touch_date > o.close_date then 'touch_after_close'
         when t.touch_date is null then 'missing_touch_date'
         when t.campaign_type = 'Unknown' then 'missing_campaign_type'
         when o.account_id is not null and t.account_id is distinct from o.account_id then 'account_mismatch'
         when o.account_id is null then 'opportunity_not_found'
         when count(*) over (partition by t.opportunity_id, t.account_id, campaign_id, channel, touch_date) > 1
           then 'duplicate_touchpoint' end as issue_type
from clean_touches t left join opportunities o on t.opportunity_id = o.opportunity_id
"""

_FACT_ROWS = """
select t.*, o.created_at, o.close_date, o.stage_name, o.amount,
       row_number() over (partition by t.opportunity_id, t.account_id, t.campaign_id, t.channel, t.touch_date
                          order by t.touchpoint_id) as copy
from {touches} t join opportunities o on t.opportunity_id = o.opportunity_id and t.account_id = o.account_id
where (o.close_date is null or t.touch_date <= o.close_date) {stages}
"""

_FACT = """
select touchpoint_id, opportunity_id, account_id, campaign_id, campaign_type, channel, touch_date,
       created_at, close_date, stage_name, cast(amount as double) as amount,
       row_number() over (partition by opportunity_id order by touch_date nulls last, touchpoint_id) as touch_sequence,
       count(touchpoint_id) over (partition by opportunity_id) as touch_count,
       count(*) over (partition by opportunity_id) as touch_rows
from fact_rows where copy = 1
"""

_POSITIONED = f"""
select *, touch_sequence = 1 as is_first_touch, touch_sequence = touch_count as is_last_touch,
       date_diff('day', touch_date, coalesce(close_date, date'{ORDERS_AS_OF}')) as days_before_close_or_today
from fact
"""

_WEIGHTED = """
select *, case when touch_count = 1 then 1.0 when is_first_touch or is_last_touch then 0.4
               else 0.2 / greatest(touch_count - 2, 1) end as raw_weight
from positioned
"""

_INFLUENCE = """
select *, case when is_first_touch then amount else 0 end as first_touch_influence,
       case when is_last_touch then amount else 0 end as last_touch_influence,
       amount / touch_count as even_touch_influence,
       raw_weight / sum(raw_weight) over (partition by opportunity_id) as position_weight
from weighted
"""

_SUMMARY = """
select campaign_type, channel, count(touchpoint_id) as touchpoints,
       count(distinct opportunity_id) as opportunities,
       cast(sum(cast(first_touch_influence as decimal(38,6))) as double) as first_touch_pipeline,
       cast(sum(cast(last_touch_influence as decimal(38,6))) as double) as last_touch_pipeline,
       cast(sum(cast(even_touch_influence as decimal(38,6))) as double) as even_touch_pipeline,
       cast(sum(cast(amount * position_weight as decimal(38,6))) as double) as weighted_pipeline
from influence group by campaign_type, channel
"""

_LONG = """
select touchpoint_id, opportunity_id, campaign_id, channel, amount, 'FIRST_TOUCH' as model, amount as allocated_revenue
from weighted where is_first_touch
union all
select touchpoint_id, opportunity_id, campaign_id, channel, amount, 'LAST_TOUCH', amount
from weighted where is_last_touch
union all
select touchpoint_id, opportunity_id, campaign_id, channel, amount, 'EVEN_SPLIT', amount / touch_count from weighted
union all
select touchpoint_id, opportunity_id, campaign_id, channel, amount, 'POSITION_WEIGHTED', amount * raw_weight
from weighted
"""

_FACT_STEPS = {
    "clean_touches": _TOUCHES,
    "fact_rows": _FACT_ROWS.format(touches="clean_touches", stages=""),
    "fact": _FACT,
    "positioned": _POSITIONED,
    "weighted": _WEIGHTED,
}
_WON_STEPS = {
    "clean_touches": _TOUCHES,
    "fact_rows": _FACT_ROWS.format(touches="clean_touches", stages="and o.stage_name = 'Closed Won'"),
    "fact": _FACT,
}

_SPLIT_STEPS = {
    "found": """
select t.*, o.account_id as deal_account, o.close_date
from touchpoints t join opportunities o on t.opportunity_id = o.opportunity_id
""",
    "same_account": "select * from found where account_id = deal_account",
    "in_time": "select * from same_account where touch_date <= close_date",
    "numbered": """
select *, row_number() over (partition by opportunity_id, campaign_id, touch_date order by touchpoint_id) as copy,
       count(*) over (partition by opportunity_id, campaign_id, touch_date) as copies
from in_time
""",
}
_T = "touchpoint_id, opportunity_id, account_id, campaign_id, campaign_type, channel, touch_date"

CHECKS["attr_quality_flags"] = check_sql(
    f"select {_T}, issue_type from flagged where issue_type is not null",
    clean_touches=_TOUCHES,
    flagged=_FLAGGED,
)
CHECKS["attr_issue_counts"] = check_sql(
    "select issue_type, count(*) as touchpoints from flagged where issue_type is not null group by issue_type",
    clean_touches=_TOUCHES,
    flagged=_FLAGGED,
)
CHECKS["attr_influence_unnamed"] = check_sql(
    """select opportunity_id, count(*) as touch_rows, round(max(position_weight), 6) as largest_weight,
              round(sum(amount * position_weight), 2) as credited, round(max(amount), 2) as amount
       from influence group by opportunity_id""",
    **{
        **_FACT_STEPS,
        "clean_touches": _TOUCHES.replace(
            "select touchpoint_id,",
            "select case when right(touchpoint_id, 1) not in ('1', '5') then touchpoint_id end as touchpoint_id,",
        ),
        "influence": _INFLUENCE,
    },
)
CHECKS["attr_orphans"] = check_sql(
    """select touchpoint_id, opportunity_id, account_id from touchpoints
       where opportunity_id not in (select opportunity_id from opportunities)"""
)
CHECKS["attr_matched"] = check_sql(
    """select touchpoint_id, opportunity_id, account_id from touchpoints
       where opportunity_id in (select opportunity_id from opportunities)"""
)
CHECKS["attr_validated"] = check_sql(f"select {_T} from numbered where copy = 1", **_SPLIT_STEPS)
CHECKS["attr_anomalies"] = check_sql(
    f"""select {_T}, 'opportunity_not_found' as anomaly_type from touchpoints
        where opportunity_id not in (select opportunity_id from opportunities)
        union all select {_T}, 'account_mismatch' from found where account_id is distinct from deal_account
        union all select {_T}, 'missing_campaign_type' from same_account where campaign_type is null
        union all select {_T}, 'touch_after_close' from same_account where touch_date > close_date
        union all select {_T}, 'duplicate_touchpoint' from numbered where copies > 1""",
    **_SPLIT_STEPS,
)
CHECKS["attr_clean_fact"] = check_sql("select * exclude (raw_weight) from weighted", **_FACT_STEPS)
CHECKS["attr_won_fact"] = check_sql(
    "select touchpoint_id, opportunity_id, touch_sequence, touch_count from fact", **_WON_STEPS
)
CHECKS["attr_fact_hot"] = check_sql(
    """select touchpoint_id, opportunity_id, touch_date, touch_sequence, touch_count, is_first_touch, is_last_touch
       from positioned""",
    hot_touches=HOT_TOUCHES,
    clean_touches=_TOUCHES.replace("touchpoints", "hot_touches"),
    fact_rows=_FACT_ROWS.format(touches="clean_touches", stages=""),
    fact=_FACT,
    positioned=_POSITIONED,
)
CHECKS["attr_influence"] = check_sql(
    """select touchpoint_id, opportunity_id, first_touch_influence, last_touch_influence,
              round(even_touch_influence, 6) as even_touch_influence,
              round(position_weight, 6) as position_weight,
              round(amount * position_weight, 6) as weighted_influence
       from influence""",
    **_FACT_STEPS,
    influence=_INFLUENCE,
)
CHECKS["attr_summary"] = check_sql("select * from summary", **_FACT_STEPS, influence=_INFLUENCE, summary=_SUMMARY)
CHECKS["attr_top8"] = check_sql(
    "select * from summary order by weighted_pipeline desc, campaign_type, channel limit 8",
    **_FACT_STEPS,
    influence=_INFLUENCE,
    summary=_SUMMARY,
)
CHECKS["attr_long_models"] = check_sql(
    "select * replace (round(allocated_revenue, 6) as allocated_revenue) from long_rows",
    **_FACT_STEPS,
    long_rows=_LONG,
)
CHECKS["attr_normalized"] = check_sql(
    """select * replace (round(allocated_revenue * amount
                / sum(allocated_revenue) over (partition by opportunity_id, model), 6) as allocated_revenue)
       from long_rows""",
    **_FACT_STEPS,
    long_rows=_LONG,
)
CHECKS["attr_allocation_errors"] = check_sql(
    """select opportunity_id, model, round(sum(allocated_revenue), 6) as allocated_revenue, max(amount) as amount
       from long_rows group by opportunity_id, model
       having abs(sum(allocated_revenue) - max(amount)) >= 0.01""",
    **_FACT_STEPS,
    long_rows=_LONG,
)
CHECKS["attr_channel_model"] = check_sql(
    """select channel, model, round(cast(sum(cast(share as decimal(38,6))) as double), 2) as allocated_revenue
       from (select channel, model, allocated_revenue * amount
                    / sum(allocated_revenue) over (partition by opportunity_id, model) as share
             from long_rows)
       group by channel, model""",
    **_SPLIT_STEPS,
    valid=f"select {_T} from numbered where copy = 1",
    fact_rows=_FACT_ROWS.format(touches="valid", stages=""),
    fact=_FACT,
    positioned=_POSITIONED,
    weighted=_WEIGHTED,
    long_rows=_LONG,
)
