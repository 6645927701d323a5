"""Multi-touch revenue attribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.functions.scalars import ColumnLike, as_column, days_between, exact_sum, ratio, whole_units
from adstrata.operators import keys
from adstrata.operators.timeline import order_by_ranges
from adstrata.operators.touch_quality import BUSINESS_KEY

# Shares of the first touch, the last touch and all touches in between.
FIRST_SHARE = 0.4
LAST_SHARE = 0.4
MIDDLE_SHARE = 0.2

# What places a touch in its deal.
_PLACING = ["touchpoint_id", "opportunity_id", "touch_date", "close_date"]
# What credit by model needs besides.
CREDITED = ["campaign_id", "channel", "amount"]

# Columns of a fact: the credit of the whole deal under each model.
DEAL_CREDIT = {
    "FIRST_TOUCH": "_deal_first_touch",
    "LAST_TOUCH": "_deal_last_touch",
    "EVEN_SPLIT": "_deal_even_split",
    "POSITION_WEIGHTED": "_deal_position_weighted",
}
# Digits behind the point in sums of credit.
CREDIT_SCALE = 12


def touchpoint_fact(
    opportunities: DataFrame,
    touchpoints: DataFrame,
    as_of: str,
    stages: Sequence[str] | None = None,
    keep: Sequence[str] | None = None,
    deal_credit: bool = False,
) -> DataFrame:
    """Valid touches of each deal in order, with their position in the deal.

    Inputs are cleaned. A touch counts when account and deal agree and the deal is open or
    closed no earlier than the touch. Repeated business keys keep the smallest id. ``stages``
    restricts the deals; by default all stages take part. Ages of open deals end at ``as_of``.
    Touches without a date come last in their deal. Rows are sorted and written on the way: ``keep``
    names the columns of touches and deals that are needed besides those that place a touch in its deal.
    ``deal_credit`` adds the ``DEAL_CREDIT`` columns, from which ``normalise_allocations`` can scale in place.
    """
    deals = opportunities.select(
        "opportunity_id", "account_id", "created_at", "close_date", "stage_name", "amount"
    )
    if stages is not None:
        deals = deals.where(F.col("stage_name").isin(list(stages)))
    if keep is not None:
        touchpoints = touchpoints.select(_deciding(touchpoints.columns, keep))
    open_or_before_close = F.col("close_date").isNull() | (F.col("touch_date") <= F.col("close_date"))
    joined = touchpoints.join(deals, ["opportunity_id", "account_id"]).where(open_or_before_close)
    fact = keys.keep_first(joined, BUSINESS_KEY, ["touchpoint_id"])
    if keep is not None:
        fact = fact.select([c for c in fact.columns if c in {*_PLACING, *keep}])

    is_first = F.col("touch_sequence") == 1
    is_last = F.col("touch_sequence") == F.col("touch_count")
    credit_sums = {
        DEAL_CREDIT[model]: F.sum(credit.cast(f"decimal(38,{CREDIT_SCALE})"))
        for model, credit in credits_by_model(is_first, is_last).items()
        if deal_credit
    }
    fact = order_by_ranges(
        fact,
        ["opportunity_id"],
        [F.col("touch_date").asc_nulls_last(), F.col("touchpoint_id").asc_nulls_last()],
        sequence="touch_sequence",
        totals={"touch_count": F.count("touchpoint_id"), "touch_rows": F.count(F.lit(1))},
        later=credit_sums,
    )
    return fact.withColumns(
        {
            "is_first_touch": is_first,
            "is_last_touch": is_last,
            "days_before_close_or_today": _age_in_days(fact, as_of),
            **{name: F.col(name).cast("double") for name in credit_sums},
        }
    )


def _deciding(columns: Sequence[str], keep: Sequence[str]) -> list[str]:
    """The columns of touches that are kept or may decide which of equal ones is.

    Of touches with one business key and id the smallest stays, compared column by column: what comes
    behind the last kept column decides between rows that look the same.
    """
    fixed = {*_PLACING, *BUSINESS_KEY}
    others = [name for name in columns if name not in fixed]
    while others and others[-1] not in keep:
        others.pop()
    return [name for name in columns if name in fixed or name in others]


def _age_in_days(fact: DataFrame, as_of: str) -> Column:
    end = F.coalesce(F.col("close_date"), F.lit(as_of).cast("timestamp_ntz"))
    if isinstance(fact.schema["touch_date"].dataType, T.DateType):
        return days_between("touch_date", end.cast("date"))
    return whole_units("DAY", F.col("touch_date"), end)


def position_weight(
    normalised: bool, is_first: ColumnLike = "is_first_touch", is_last: ColumnLike = "is_last_touch"
) -> Column:
    """U-shaped weight of a touch. Two touches split 0.4/0.4, or 0.5/0.5 when normalised.

    Touches without an id are rows like others but are not in the touch count, so the weights of a
    deal need not add up to 1. Their total follows from the rows and the count: the first row, the
    row at the place of the count, and all others.
    """
    count = F.col("touch_count")
    is_first, is_last = as_column(is_first), as_column(is_last)
    at_edge = is_first | is_last
    middle = F.lit(MIDDLE_SHARE) / F.greatest(count - 2, F.lit(1))
    weight = (
        F.when(count == 1, F.lit(1.0))
        .when(at_edge, F.when(is_first, FIRST_SHARE).otherwise(LAST_SHARE))
        .otherwise(middle)
    )
    if not normalised:
        return weight
    rows = F.col("touch_rows")
    last = F.when(count >= 2, 1).otherwise(0)
    total = F.when(count == 1, rows.cast("double")).otherwise(
        F.lit(FIRST_SHARE) + last * F.lit(LAST_SHARE) + (rows - 1 - last) * middle
    )
    return weight / total


def assign_influence(fact: DataFrame) -> DataFrame:
    """Deal value credited to each touch under the four models, side by side."""
    amount = F.col("amount").cast("double")
    return fact.withColumns(
        {
            "first_touch_influence": F.when(F.col("is_first_touch"), amount).otherwise(F.lit(0.0)),
            "last_touch_influence": F.when(F.col("is_last_touch"), amount).otherwise(F.lit(0.0)),
            "even_touch_influence": ratio(amount, "touch_count"),
            "position_weight": position_weight(normalised=True),
            "weighted_influence": amount * position_weight(normalised=True),
        }
    )


def influence_summary(influence: DataFrame) -> DataFrame:
    """Credit per campaign type and channel, largest weighted credit first."""
    return (
        influence.groupBy("campaign_type", "channel")
        .agg(
            F.count("touchpoint_id").alias("touchpoints"),
            F.countDistinct("opportunity_id").alias("opportunities"),
            exact_sum("first_touch_influence").alias("first_touch_pipeline"),
            exact_sum("last_touch_influence").alias("last_touch_pipeline"),
            exact_sum("even_touch_influence").alias("even_touch_pipeline"),
            exact_sum("weighted_influence").alias("weighted_pipeline"),
        )
        .orderBy(F.desc("weighted_pipeline"), "campaign_type", "channel")
    )


def top_campaigns(summary: DataFrame, n: int = 8) -> DataFrame:
    return keys.top_rows(summary, "weighted_pipeline", n, "campaign_type", "channel")


def credits_by_model(
    is_first: ColumnLike = "is_first_touch", is_last: ColumnLike = "is_last_touch"
) -> dict[str, Column]:
    """What each model credits a touch with, null for none; position weights are not normalised."""
    amount = F.col("amount").cast("double")
    return {
        "FIRST_TOUCH": F.when(as_column(is_first), amount),
        "LAST_TOUCH": F.when(as_column(is_last), amount),
        "EVEN_SPLIT": ratio(amount, "touch_count"),
        "POSITION_WEIGHTED": amount * position_weight(False, is_first, is_last),
    }


def attribution_by_model(fact: DataFrame) -> DataFrame:
    """One row per touch and model that credits it; position weights are not normalised.

    Rows of a fact with ``DEAL_CREDIT`` bring the credit of their deal and model along, as ``_allocated``.
    """
    totalled = set(DEAL_CREDIT.values()) <= set(fact.columns)
    rows = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                credit.alias("allocated_revenue"),
                *([F.col(DEAL_CREDIT[model]).alias("_allocated")] if totalled else []),
            )
            for model, credit in credits_by_model().items()
        ]
    )
    return (
        fact.select(
            "touchpoint_id",
            "opportunity_id",
            "campaign_id",
            "channel",
            "amount",
            F.explode(rows).alias("_credit"),
        )
        .select("*", "_credit.*")
        .where(F.col("allocated_revenue").isNotNull())
        .drop("_credit")
    )


def normalise_allocations(attribution: DataFrame) -> DataFrame:
    """Scale the credit of each deal and model so that it adds up to the deal value.

    Where rows bring the credit of the whole deal along (``DEAL_CREDIT``) none of them moves; otherwise
    they are joined with the sums of the given rows.
    """
    key = ["opportunity_id", "model"]
    if "_allocated" not in attribution.columns:
        totals = attribution.groupBy(*key).agg(
            exact_sum("allocated_revenue", CREDIT_SCALE).alias("_allocated")
        )
        attribution = attribution.join(totals, key)
    scaled = F.col("allocated_revenue") * F.col("amount").cast("double") / F.col("_allocated")
    return (
        attribution.withColumn(
            "allocated_revenue",
            F.when(F.col("_allocated") > 0, scaled).otherwise(F.col("allocated_revenue")),
        )
        .select(*key, *[name for name in attribution.columns if name not in {*key, "_allocated"}])
    )


def allocation_errors(attribution: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Deals and models whose credit does not add up to the deal value."""
    return (
        attribution.groupBy("opportunity_id", "model")
        .agg(
            exact_sum("allocated_revenue", CREDIT_SCALE).alias("allocated_revenue"),
            F.max("amount").cast("double").alias("amount"),
        )
        .where(F.abs(F.col("allocated_revenue") - F.col("amount")) >= tolerance)
    )


def revenue_by_channel(attribution: DataFrame) -> DataFrame:
    return attribution.groupBy("channel", "model").agg(
        exact_sum("allocated_revenue").alias("allocated_revenue")
    )
