"""Conversion paths: deduplicated conversions with the touches that came before them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.functions.labels import first_match, velocity_band
from adstrata.functions.scalars import (
    MICROS,
    days_between,
    true_only,
    trimmed_or,
    whole_units,
)
from adstrata.operators.keys import keep_first
from adstrata.operators.timeline import (
    DAY_US,
    HOUR_US,
    Lookback,
    busy_keys,
    lookback_rollup,
    order_by_ranges,
)

_ID_COLUMNS = [
    "event_id",
    "anonymous_user_id",
    "auction_id",
    "campaign_id",
    "line_item_id",
    "creative_id",
    "conversion_tracker_id",
    "conversion_event_id",
    "order_id",
]

# The grain of the path table.
_PATH_KEY = [
    "conversion_event_id",
    "anonymous_user_id",
    "conversion_tracker_id",
    "campaign_id",
    "conversion_at",
    "conversion_date",
]

_CAMPAIGN_DEFAULTS = {
    "campaign_name": "Unknown Campaign",
    "account_id": "No Account",
    "channel": "Unknown",
    "campaign_type": "Unknown",
    "primary_goal": "No Goal",
    "campaign_status": "Unknown",
}


def clean_events(events: DataFrame) -> DataFrame:
    """Live events with typed ids, normalised labels and filled flags."""
    live = events.where(F.col("event_at").isNotNull() & ~true_only("is_test_event"))
    kind = F.lower(F.trim("event_type"))
    return live.select(
        *[F.col(name).cast("string").alias(name) for name in _ID_COLUMNS],
        F.col("event_at").cast("timestamp_ntz").alias("event_at"),
        F.col("event_at").cast("date").alias("event_date"),
        kind.alias("event_type"),
        *[
            trimmed_or(name, "Unknown").alias(name)
            for name in ("supply_inventory_type", "device_type", "country", "region", "city")
        ],
        F.col("cost_micros").try_cast("double").alias("cost_micros"),
        F.col("conversion_value").try_cast("double").alias("conversion_value"),
        F.coalesce(F.lower(F.trim("conversion_count_type")), F.lit("multiple")).alias(
            "conversion_count_type"
        ),
        F.coalesce("has_impression", kind == "impression").alias("has_impression"),
        F.coalesce("has_click", kind == "click").alias("has_click"),
        F.coalesce("has_conversion", kind == "conversion").alias("has_conversion"),
    )


def clean_campaigns(campaigns: DataFrame) -> DataFrame:
    """Campaigns that are not deleted, with defaults for missing labels."""
    return campaigns.where(~true_only("is_deleted")).select(
        F.col("campaign_id").cast("string").alias("campaign_id"),
        trimmed_or("campaign_name", "Unnamed Campaign").alias("campaign_name"),
        trimmed_or("account_id", "No Account").alias("account_id"),
        trimmed_or("channel", "Unknown").alias("channel"),
        trimmed_or("campaign_type", "Unknown").alias("campaign_type"),
        trimmed_or("primary_goal", "No Goal").alias("primary_goal"),
        trimmed_or("status", "Unknown").alias("campaign_status"),
        F.col("primary_goal_amount").try_cast("double").alias("primary_goal_amount"),
        F.coalesce(F.col("budget_amount").try_cast("double"), F.lit(0.0)).alias("budget_amount"),
        F.col("start_date").cast("date").alias("campaign_start_date"),
        F.col("end_date").cast("date").alias("campaign_end_date"),
    )


def with_campaign(df: DataFrame, campaigns: DataFrame, *extra: str) -> DataFrame:
    """Left join campaign labels, with defaults where the campaign is unknown."""
    labels = campaigns.select("campaign_id", *_CAMPAIGN_DEFAULTS, *extra)
    return df.join(labels, "campaign_id", "left").withColumns(
        {name: F.coalesce(F.col(name), F.lit(text)) for name, text in _CAMPAIGN_DEFAULTS.items()}
    )


def dedup_conversions(events: DataFrame) -> DataFrame:
    """Conversions, where trackers that count once keep the earliest per user, tracker and order.

    ``events`` are cleaned. The earliest conversion of a group may itself belong to a
    tracker that counts every conversion; then no "once" row of the group is kept.
    """
    conversions = events.where("has_conversion").select(
        F.col("event_id").alias("source_event_id"),
        F.coalesce("conversion_event_id", "event_id").alias("conversion_event_id"),
        "anonymous_user_id",
        "auction_id",
        "campaign_id",
        "conversion_tracker_id",
        "order_id",
        F.col("event_at").alias("conversion_at"),
        F.col("event_date").alias("conversion_date"),
        F.coalesce("conversion_value", F.lit(0.0)).alias("conversion_value"),
        "conversion_count_type",
        F.coalesce("order_id", "conversion_event_id", "event_id").alias("_counted_as"),
    )
    counts_once = F.col("conversion_count_type") == "once"
    earliest = keep_first(
        conversions,
        ["anonymous_user_id", "conversion_tracker_id", "_counted_as"],
        ["conversion_at", "source_event_id"],
    )
    return (
        conversions.where(~counts_once)
        .unionByName(earliest.where(counts_once))
        .drop("_counted_as")
    )


def path_rollup(
    events: DataFrame,
    conversions: DataFrame,
    lookback_days: int = 60,
    busy: DataFrame | None = None,
) -> DataFrame:
    """One row per conversion with its touch history.

    A touch is an impression or click of the same user in the lookback before the conversion,
    both ends included. ``busy`` users, by default found by counting, are cut into hours.
    """
    if busy is None:
        busy = busy_keys(events.select("anonymous_user_id"), ["anonymous_user_id"])
    touches = events.where(F.col("has_impression") | F.col("has_click"))
    cost = F.coalesce(F.col("cost_micros"), F.lit(0.0)) / F.lit(float(MICROS))
    impression = true_only("has_impression")
    click = true_only("has_click")
    # Rows that agree in the whole key are one path; each of them would add the touch cost.
    grouped = conversions.groupBy(*_PATH_KEY).agg(
        F.max("conversion_value").alias("conversion_value"), F.count(F.lit(1)).alias("_copies")
    )
    rolled = lookback_rollup(
        grouped,
        touches.withColumnRenamed("campaign_id", "touch_campaign_id"),
        key="anonymous_user_id",
        probe_at="conversion_at",
        touch_at="event_at",
        collect=Lookback(
            sums={"touch_cost": cost},
            distinct={
                "impression_touch_count": F.when(impression, F.col("event_id")),
                "click_touch_count": F.when(click, F.col("event_id")),
                "touched_campaign_count": F.col("touch_campaign_id"),
                "touched_creative_count": F.col("creative_id"),
            },
            edges={"impression_at": impression, "click_at": click},
            lists={
                "supply_inventory_type_list": F.col("supply_inventory_type"),
                "device_type_list": F.col("device_type"),
            },
        ),
        lookback_us=lookback_days * DAY_US,
        busy=busy,
        bucket_us=HOUR_US,
    )
    return rolled.withColumn(
        "pre_conversion_media_cost", F.col("touch_cost") * F.col("_copies")
    ).drop("touch_cost", "_copies")


def _time_band(conversion_at: Column, first_at: Column) -> Column:
    days = whole_units("DAY", first_at, conversion_at)
    # Upper bounds in whole days and their names.
    bands = [(5, "1-5 days"), (10, "6-10 days"), (20, "11-20 days"), (30, "21-30 days")]
    return first_match(
        [
            (first_at.isNull(), "No prior impression"),
            (whole_units("HOUR", first_at, conversion_at) < 24, "< 1 day"),
            *[(days <= limit, name) for limit, name in bands],
        ],
        "> 30 days",
    )


def classify_paths(rollup: DataFrame) -> DataFrame:
    """Elapsed hours, path type and time band of each conversion."""
    clicks = F.col("click_touch_count") > 0
    impressions = F.col("impression_touch_count") > 0
    at = F.col("conversion_at")
    return rollup.withColumns(
        {
            "hours_from_first_impression_to_conversion": whole_units("HOUR", "first_impression_at", at),
            "hours_from_first_click_to_conversion": whole_units("HOUR", "first_click_at", at),
            "has_impression_before_conversion": impressions,
            "has_click_before_conversion": clicks,
            "conversion_path_type": first_match(
                [(clicks, "Click path"), (impressions, "View path")], "Conversion only"
            ),
            "impression_to_conversion_bucket": _time_band(at, F.col("first_impression_at")),
        }
    )


def conversion_paths(
    events: DataFrame,
    campaigns: DataFrame,
    lookback_days: int = 60,
    updated_at: datetime | None = None,
    busy: DataFrame | None = None,
) -> DataFrame:
    """The path model from raw events and campaigns.

    ``updated_at`` adds the run time as a column. ``busy`` users are found by counting if not given.
    """
    cleaned = clean_events(events)
    rollup = path_rollup(cleaned, dedup_conversions(cleaned), lookback_days, busy=busy)
    paths = with_campaign(classify_paths(rollup), clean_campaigns(campaigns))
    if updated_at is None:
        return paths
    return paths.withColumn("updated_timestamp", F.lit(updated_at).cast("timestamp_ntz"))


def latest_rows(df: DataFrame, keys: list[str], created_at: str, *ties: str) -> DataFrame:
    """The row created last per key."""
    return keep_first(df, keys, [created_at, *ties], descending=True)


def running_conversions(
    df: DataFrame,
    key: str,
    event_at: str,
    event_id: str,
    has_conversion: Column,
) -> DataFrame:
    """Touch order and conversions so far, per key in time order."""
    return order_by_ranges(
        df,
        [key],
        [F.col(event_at), F.col(event_id)],
        sequence="touch_order",
        running={"cumulative_conversions": has_conversion.cast("bigint")},
    )


def conversion_velocity(df: DataFrame, event_at: str, close_at: str) -> DataFrame:
    """Days from an event to the close of its deal and the speed band."""
    days = days_between(event_at, close_at)
    return df.withColumns({"days_to_conversion": days, "conversion_velocity": velocity_band(days)})
