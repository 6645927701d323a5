"""Cleaning and quality rules for marketing touchpoints."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.functions.labels import first_match
from adstrata.functions.scalars import true_only
from adstrata.operators import keys

UNKNOWN = "Unknown"

# The fields that make two touchpoints the same event.
BUSINESS_KEY = ["opportunity_id", "account_id", "campaign_id", "channel", "touch_date"]
VALIDATOR_KEY = ["opportunity_id", "campaign_id", "touch_date"]

TOUCH_COLUMNS = [
    "touchpoint_id",
    "opportunity_id",
    "account_id",
    "campaign_id",
    "campaign_type",
    "channel",
    "touch_date",
]


def _as_time(df: DataFrame, *names: str) -> dict[str, Column]:
    """Text columns become timestamps (unreadable text: null), typed ones stay."""
    types = {field.name: field.dataType for field in df.schema.fields}
    return {
        name: F.try_to_timestamp(F.col(name)).cast("timestamp_ntz")
        for name in names
        if isinstance(types.get(name), T.StringType)
    }


def clean_opportunities(opportunities: DataFrame) -> DataFrame:
    return opportunities.withColumns(_as_time(opportunities, "created_at", "close_date"))


def clean_touchpoints(touchpoints: DataFrame) -> DataFrame:
    changes = _as_time(touchpoints, "touch_date")
    for name in ("campaign_type", "channel"):
        changes[name] = F.coalesce(F.col(name), F.lit(UNKNOWN))
    return touchpoints.withColumns(changes)


def touchpoint_issues(opportunities: DataFrame, touchpoints: DataFrame) -> DataFrame:
    """Touchpoints with the one rule they break that weighs most.

    Inputs are cleaned. A late touch outweighs a missing date, then a missing type, an
    account that differs, an unknown opportunity; a repeated business key counts only for
    touches without another issue.
    """
    deals = opportunities.select(
        F.col("opportunity_id"),
        F.col("account_id").alias("deal_account"),
        F.col("close_date").alias("deal_close"),
    )
    # A deal listed twice doubles its touches, which makes each of them repeated.
    listed_twice = keys.repeated_keys(deals, ["opportunity_id"]).select(
        "opportunity_id", F.lit(True).alias("deal_repeated")
    )
    joined = (
        keys.flag_repeated(touchpoints, BUSINESS_KEY, "touch_repeated")
        .join(deals, "opportunity_id", "left")
        .join(listed_twice, "opportunity_id", "left")
    )
    has_deal = F.col("deal_account").isNotNull()
    issue = first_match(
        [
            (F.col("touch_date") > F.col("deal_close"), "touch_after_close"),
            (F.col("touch_date").isNull(), "missing_touch_date"),
            (F.col("campaign_type") == UNKNOWN, "missing_campaign_type"),
            (has_deal & ~F.col("account_id").eqNullSafe(F.col("deal_account")), "account_mismatch"),
            (~has_deal, "opportunity_not_found"),
            (F.col("touch_repeated") | F.col("deal_repeated"), "duplicate_touchpoint"),
        ]
    )
    return (
        joined.withColumn("issue_type", issue)
        .where(F.col("issue_type").isNotNull())
        .select(*TOUCH_COLUMNS, "issue_type")
    )


def issue_counts(issues: DataFrame) -> DataFrame:
    return (
        issues.groupBy("issue_type")
        .agg(F.count(F.lit(1)).alias("touchpoints"))
        .orderBy("issue_type")
    )


@dataclass(frozen=True)
class Validated:
    """Touchpoints that pass, and one row per anomaly found."""

    valid: DataFrame
    anomalies: DataFrame


def validate_touchpoints(opportunities: DataFrame, touchpoints: DataFrame) -> Validated:
    """Split touchpoints step by step: each step sees only what the steps before let through.

    Orphans, then touches of another account, leave the stream. A missing campaign type is
    recorded and stays. Only touches up to the close date go on, so a touch without a date or
    of an open deal leaves silently, a late one is recorded. Repeated touches are all
    recorded and one stays. A touch may be recorded under several types.
    """
    touchpoints = touchpoints.withColumns(_as_time(touchpoints, "touch_date"))
    deals = clean_opportunities(opportunities).select(
        F.col("opportunity_id"),
        F.col("account_id").alias("deal_account"),
        F.col("close_date").alias("deal_close"),
        F.lit(True).alias("deal_found"),
    )
    joined = touchpoints.join(deals, "opportunity_id", "left")
    found = F.col("deal_found").isNotNull()
    same_account = found & true_only(F.col("account_id") == F.col("deal_account"))
    in_time = same_account & true_only(F.col("touch_date") <= F.col("deal_close"))
    judged = joined.select(
        *TOUCH_COLUMNS,
        in_time.alias("_in_time"),
        F.array_compact(
            F.array(
                F.when(~found, F.lit("opportunity_not_found")),
                F.when(found & ~same_account, F.lit("account_mismatch")),
                F.when(same_account & F.col("campaign_type").isNull(), F.lit("missing_campaign_type")),
                F.when(
                    same_account & true_only(F.col("touch_date") > F.col("deal_close")),
                    F.lit("touch_after_close"),
                ),
            )
        ).alias("_types"),
    )
    passing = judged.where("_in_time").select(*TOUCH_COLUMNS)
    # One stream of rows for all types: touches are joined with their deals once for it, once for the keys.
    repeated = keys.repeated_keys(passing, VALIDATOR_KEY).select(
        *[F.col(name).alias(f"_k_{name}") for name in VALIDATOR_KEY], F.lit(True).alias("_repeated")
    )
    same = F.col("_in_time")
    for name in VALIDATOR_KEY:
        same = same & F.col(name).eqNullSafe(F.col(f"_k_{name}"))
    duplicate = F.when(F.col("_repeated"), F.lit("duplicate_touchpoint"))
    recorded = (
        judged.where(F.col("_in_time") | (F.size("_types") > 0))
        .join(repeated, same, "left")
        .select(*TOUCH_COLUMNS, F.explode(F.array_compact(F.array_append("_types", duplicate))).alias("anomaly_type"))
    )
    return Validated(
        valid=keys.keep_first(passing, VALIDATOR_KEY, ["touchpoint_id"]),
        anomalies=recorded,
    )
