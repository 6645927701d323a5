"""Daily campaign delivery: rollup, conversion context, pacing and health flags."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adstrata.functions.labels import budget_status, delivery_data_flag, first_match, penalty_score
from adstrata.functions.scalars import (
    days_between,
    exact_sum,
    joined_list,
    nonzero,
    ratio,
    strict_greatest,
    strict_least,
    trimmed_or,
)
from adstrata.operators.paths import clean_campaigns, with_campaign

_DAY_KEY = ["campaign_id", "activity_date"]

# Flag, weight in the score, position in the order of notes, note.
HEALTH_FLAGS = [
    ("has_missing_primary_goal", 20, 1, "Missing goal"),
    ("has_delivery_without_spend", 20, 2, "Delivery without spend"),
    ("has_spend_without_delivery", 20, 3, "Spend without delivery"),
    ("has_conversion_count_gap", 15, 4, "Conversion count gap"),
    ("has_budget_pacing_gap", 15, 5, "Budget pacing gap"),
    ("has_unusually_high_click_through_rate", 10, 6, "Rate outlier"),
]
PACING_TOLERANCE = 0.20
HIGH_CLICK_RATE = 0.30


def clean_delivery(delivery: DataFrame) -> DataFrame:
    counts = ("impressions", "clicks", "conversions", "reach_count")
    return delivery.where(F.col("activity_date").isNotNull()).select(
        F.col("activity_date").cast("date").alias("activity_date"),
        F.col("campaign_id").cast("string").alias("campaign_id"),
        F.col("line_item_id").cast("string").alias("line_item_id"),
        trimmed_or("supply_inventory_type", "Unknown").alias("supply_inventory_type"),
        trimmed_or("device_type", "Unknown").alias("device_type"),
        *[F.coalesce(F.col(n).try_cast("bigint"), F.lit(0).cast("bigint")).alias(n) for n in counts],
        F.coalesce(F.col("media_cost").try_cast("decimal(28,6)"), F.lit(0)).alias("media_cost"),
    )


def daily_delivery(delivery: DataFrame) -> DataFrame:
    """Delivery per campaign and day. Reach adds up slice reach, so it is not deduplicated."""
    return (
        clean_delivery(delivery)
        .groupBy(*_DAY_KEY)
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.sum("conversions").alias("platform_conversions"),
            F.sum("reach_count").alias("reach_count"),
            F.sum("media_cost").alias("media_cost"),
            F.countDistinct("line_item_id").alias("line_item_count"),
            joined_list("supply_inventory_type").alias("supply_inventory_type_list"),
            joined_list("device_type").alias("device_type_list"),
        )
    )


def daily_conversions(paths: DataFrame) -> DataFrame:
    """Deduplicated conversions per campaign and day."""
    click = F.col("has_click_before_conversion")
    return paths.groupBy("campaign_id", F.col("conversion_date").alias("activity_date")).agg(
        F.countDistinct("conversion_event_id").alias("deduped_conversion_count"),
        exact_sum("conversion_value").alias("deduped_conversion_value"),
        F.avg("hours_from_first_impression_to_conversion").alias(
            "avg_hours_from_first_impression_to_conversion"
        ),
        F.count_if(click).alias("click_path_conversion_count"),
        F.count_if(F.col("has_impression_before_conversion") & ~click).alias(
            "view_path_conversion_count"
        ),
    )


def with_pacing(days: DataFrame) -> DataFrame:
    """Spend so far and the share of flight and budget used, per campaign and day.

    Needs one row per campaign and day, so a campaign's window holds one row per calendar day.
    Without an end date there is no expected progress.
    """
    start, end = F.col("campaign_start_date"), F.col("campaign_end_date")
    so_far = (
        Window.partitionBy("campaign_id")
        .orderBy("activity_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    flight = strict_greatest(days_between(start, end) + 1, F.lit(1).cast("bigint"))
    elapsed = strict_greatest(
        days_between(start, strict_least("activity_date", end)) + 1, F.lit(0).cast("bigint")
    )
    paced = days.withColumns(
        {
            "cumulative_media_cost": F.sum("media_cost").over(so_far),
            "flight_day_count": flight,
            "elapsed_flight_day_count": elapsed,
        }
    )
    expected = ratio("elapsed_flight_day_count", "flight_day_count")
    actual = ratio("cumulative_media_cost", nonzero("budget_amount"))
    return paced.withColumns(
        {
            "expected_budget_progress": expected,
            "actual_budget_progress": actual,
            "has_budget_pacing_gap": F.abs(actual - expected) > PACING_TOLERANCE,
        }
    )


def campaign_quality(
    delivery: DataFrame,
    campaigns: DataFrame,
    paths: DataFrame,
    updated_at: datetime | None = None,
) -> DataFrame:
    """One row per campaign and day with rates, pacing, health flags, score and note.

    Delivery and conversions are aggregated to the day before they meet. Conversions on days
    without delivery do not appear.
    """
    days = daily_delivery(delivery).join(daily_conversions(paths), _DAY_KEY, "left")
    days = with_campaign(
        days,
        clean_campaigns(campaigns),
        "primary_goal_amount",
        "budget_amount",
        "campaign_start_date",
        "campaign_end_date",
    ).fillna(
        0,
        [
            "deduped_conversion_count",
            "deduped_conversion_value",
            "click_path_conversion_count",
            "view_path_conversion_count",
        ],
    )
    impressions, cost = F.col("impressions"), F.col("media_cost")
    rates = with_pacing(days).withColumns(
        {
            "click_through_rate": ratio("clicks", impressions),
            "click_to_conversion_rate": ratio("deduped_conversion_count", "clicks"),
            "cost_per_deduped_conversion": ratio(cost, "deduped_conversion_count"),
            "average_frequency": ratio(impressions, "reach_count"),
        }
    )
    flagged = rates.withColumns(
        {
            "has_missing_primary_goal": F.col("primary_goal") == "No Goal",
            "has_delivery_without_spend": (impressions > 0) & (cost == 0),
            "has_spend_without_delivery": (impressions == 0) & (cost > 0),
            "has_unusually_high_click_through_rate": F.col("click_through_rate") > HIGH_CLICK_RATE,
            "has_conversion_count_gap": F.col("platform_conversions")
            != F.col("deduped_conversion_count"),
        }
    )
    scored = flagged.withColumns(
        {
            "reporting_health_score": penalty_score([(F.col(f), w) for f, w, _, _ in HEALTH_FLAGS]),
            "primary_health_note": first_match(
                [(F.col(f), note) for f, _, _, note in HEALTH_FLAGS], "Looks clean"
            ),
            "primary_health_note_sort": first_match(
                [(F.col(f), position) for f, _, position, _ in HEALTH_FLAGS], 999
            ),
            "media_cost": cost.cast("double"),
            "cumulative_media_cost": F.col("cumulative_media_cost").cast("double"),
        }
    ).drop("flight_day_count", "elapsed_flight_day_count")
    if updated_at is None:
        return scored
    return scored.withColumn("updated_timestamp", F.lit(updated_at).cast("timestamp_ntz"))


def daily_averages(delivery: DataFrame) -> DataFrame:
    """Daily totals with the mean of the per-row click and conversion rates."""
    rows = clean_delivery(delivery).withColumns(
        {
            "_ctr": ratio("clicks", "impressions"),
            "_conversion_rate": ratio("conversions", "clicks"),
        }
    )
    return rows.groupBy(*_DAY_KEY).agg(
        F.sum("impressions").alias("daily_impressions"),
        F.sum("clicks").alias("daily_clicks"),
        F.sum("conversions").alias("daily_conversions"),
        F.sum("media_cost").cast("double").alias("daily_spend"),
        F.avg(F.col("_ctr").cast("decimal(18,9)")).cast("double").alias("daily_ctr"),
        F.avg(F.col("_conversion_rate").cast("decimal(18,9)")).cast("double").alias(
            "daily_conversion_rate"
        ),
    )


def budget_report(
    days: DataFrame, goal_impressions: str = "goal_impressions", daily_budget: str = "daily_budget"
) -> DataFrame:
    """Spend per planned impression, goal attainment and budget status of daily rows."""
    goal = nonzero(goal_impressions)
    spend = F.col("daily_spend")
    return days.withColumns(
        {
            "spend_per_impression": ratio(spend, goal),
            "goal_attainment_pct": F.round(ratio("daily_impressions", goal), 2),
            "budget_status": budget_status(spend, F.col(daily_budget)),
        }
    )


def data_quality_flags(days: DataFrame, now: str, last_sync: str = "last_data_sync") -> DataFrame:
    """One data quality label per daily row, as of ``now``."""
    return days.withColumn(
        "data_quality_flag",
        delivery_data_flag(
            F.col("daily_impressions"),
            F.col("daily_spend"),
            F.col("daily_conversion_rate"),
            F.col(last_sync),
            F.lit(now).cast("timestamp_ntz"),
        ),
    )


def conversion_gaps(paths: DataFrame, delivery: DataFrame, min_gap: int = 0) -> DataFrame:
    """Campaign days whose event-level and reported conversions differ by more than ``min_gap``.

    Reported rows stay as they are: a day delivered in several slices is compared per slice.
    """
    event_level = paths.groupBy(
        "campaign_id", F.col("conversion_date").alias("activity_date")
    ).agg(
        F.countDistinct("conversion_event_id").alias("unique_conversions"),
        exact_sum("conversion_value").alias("total_conversion_value"),
    )
    reported = clean_delivery(delivery).select(*_DAY_KEY, "conversions")
    gap = F.abs(F.col("unique_conversions") - F.col("conversions"))
    return (
        event_level.join(reported, _DAY_KEY, "left")
        .withColumn("conversion_discrepancy", gap)
        .where(F.col("conversion_discrepancy") > min_gap)
    )
