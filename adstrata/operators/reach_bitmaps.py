"""Exact reach of any range of days from bitmaps of users, without a new pass over the log.

Users get dense numbers. Per group and day, the users of each stretch of 32,768 numbers are one exact
bitmap, so a day of a group is a few kilobytes for each stretch in which it has users. Ranges of days are
the union of their bitmaps; reach is the number of bits set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstrata.functions.scalars import number_or_zero
from adstrata.operators.reach import LabelledWindow, in_windows, require_columns
from adstrata.operators.timeline import order_by_ranges
from adstrata.sources.scratch import written


def user_days(
    df: DataFrame, group: Sequence[str], day: str, user: str = "uniq_imp_id", impression: str = "has_won"
) -> DataFrame:
    """Impressions per group, day and user: the only pass over the log. Rows without a group, day or user are left out."""
    require_columns(df, [*group, day, user, impression])
    narrow = df.select(*group, F.col(day).alias("day"), F.col(user).alias("user"), number_or_zero(impression, "bigint").alias("_imps"))
    narrow = narrow.dropna(subset=[*group, "day", "user"])
    return written(narrow.groupBy(*group, "day", "user").agg(F.sum("_imps").alias("imps")), "user-days")


def number_users(users: DataFrame, ranges: int | None = None) -> DataFrame:
    """``user`` and ``number``, from 1 without gaps, in the order of users; spread over ranges."""
    distinct = users.select("user").where(F.col("user").isNotNull()).distinct().withColumn("_all", F.lit(0))
    return order_by_ranges(distinct, ["_all"], [F.col("user")], sequence="number", ranges=ranges).select("user", "number")


def daily_bitmaps(days: DataFrame, numbers: DataFrame, group: Sequence[str]) -> DataFrame:
    """``bits`` of users and ``imps`` per group, day and ``bucket`` of user numbers."""
    return (
        days.join(numbers, "user")
        .groupBy(*group, "day", F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"), F.sum("imps").alias("imps"))
    )


def reach_of_windows(bitmaps: DataFrame, group: Sequence[str], windows: Sequence[LabelledWindow]) -> DataFrame:
    """``reach`` and ``impressions`` per group and labelled window; windows without users have no row."""
    keyed = [*group, "window"]
    merged = in_windows(bitmaps, "day", windows).groupBy(*keyed, "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.sum("imps").alias("imps")
    )
    return merged.groupBy(*keyed).agg(
        F.sum(F.bitmap_count("bits")).alias("reach"), F.sum("imps").alias("impressions")
    )
