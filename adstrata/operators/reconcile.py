"""Reconciliation of event-log totals with a statistics system, per advertiser."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.functions.scalars import floored_at_zero, true_only
from adstrata.operators.keys import tagged_union

# Log flag columns and statistics columns behind each metric.
LOG_METRICS = {
    "cost": "cost",
    "imps": "has_won",
    "click": "has_click",
    "conv": "has_conv",
    "ltconv": "has_ltconv",
}
STATS_METRICS = {
    "cost": "cost",
    "imps": "imp",
    "click": "click",
    "conv": "conv",
    "ltconv": "ltc",
}
THRESHOLD_PCT = 0.5


def _micros_total(column: str) -> Column:
    """Sum of micro units in whole units; the sum itself is exact."""
    total = F.sum(F.col(column).cast("decimal(28,6)"))
    return total.cast("double") / F.lit(1_000_000.0)


def cluster_log(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One log from the frames of several clusters, marked with ``cluster``."""
    return tagged_union(frames, "cluster")


def _within_day(df: DataFrame, time: str, day: date) -> DataFrame:
    """Rows of one UTC day, as a range of the stored column, which reaches the scan."""
    start = F.lit(day).cast("timestamp_ntz")
    return df.where((F.col(time) >= start) & (F.col(time) < start + F.expr("INTERVAL 1 DAY")))


def log_totals(log: DataFrame, day: date | None = None) -> DataFrame:
    """Totals per date, cluster and advertiser. ``day`` restricts the scan to one UTC day."""
    if day is not None:
        log = _within_day(log, "request_time", day)
    dated = log.withColumn("date", F.col("request_time").cast("date"))
    return dated.groupBy("date", "cluster", "advertiser_id").agg(
        _micros_total("cost").alias("rs_cost"),
        *[
            F.sum(source).alias(f"rs_{metric}")
            for metric, source in LOG_METRICS.items()
            if metric != "cost"
        ],
    )


def stats_totals(stats: DataFrame, day: date | None = None) -> DataFrame:
    """Totals per date and advertiser from hourly statistics.

    Conversions reported through SKAN are missing in the logs, so they are taken off the
    conversion counts, down to 0.
    """
    if day is not None:
        stats = _within_day(stats, "cached_hour", day)
    dated = stats.withColumn("date", F.col("cached_hour").cast("date"))
    totals = dated.groupBy("date", F.col("user_id").alias("advertiser_id")).agg(
        _micros_total("cost").alias("stats_cost"),
        *[
            F.sum(source).alias(f"stats_{metric}")
            for metric, source in STATS_METRICS.items()
            if metric != "cost"
        ],
        F.sum("skan_conv").alias("skans"),
    )
    skans = F.col("skans")
    return totals.withColumns(
        {
            f"stats_{metric}": F.when(
                skans > 0, floored_at_zero(F.col(f"stats_{metric}") - skans)
            ).otherwise(F.col(f"stats_{metric}"))
            for metric in ("conv", "ltconv")
        }
    ).drop("skans")


def compare_advertisers(
    log: DataFrame,
    stats: DataFrame,
    threshold_pct: float = THRESHOLD_PCT,
    denominator: str = "log",
    sum_clusters: bool = False,
) -> DataFrame:
    """Differences per date, cluster and advertiser, with a flag for any metric out of range.

    ``log`` and ``stats`` are totals. The percentage relates to the log value, or to the
    statistics value with ``denominator="stats"``. A difference against 0 is out of range.
    Advertisers without statistics keep null differences and are not flagged, but marked.
    ``sum_clusters`` compares the total over clusters instead of each cluster.
    """
    if denominator not in ("log", "stats"):
        raise ValueError(f"Unknown denominator: {denominator}")
    if sum_clusters:
        log = log.groupBy("date", "advertiser_id").agg(
            F.lit("all").alias("cluster"),
            F.sum(F.col("rs_cost").cast("decimal(28,6)")).cast("double").alias("rs_cost"),
            *[F.sum(f"rs_{m}").alias(f"rs_{m}") for m in LOG_METRICS if m != "cost"],
        )
    known = stats.withColumn("_known", F.lit(True))
    joined = log.join(known, ["date", "advertiser_id"], "left")

    differences = {
        f"{m}_diff": F.bround((F.col(f"stats_{m}") - F.col(f"rs_{m}")).cast("double"), 4)
        for m in LOG_METRICS
    }
    side = "rs" if denominator == "log" else "stats"
    shares: dict[str, Column] = {}
    out_of_range = F.lit(False)
    for metric in LOG_METRICS:
        diff = F.col(f"{metric}_diff")
        base = F.col(f"{side}_{metric}").cast("double")
        share = F.bround(F.try_divide(diff, base) * 100, 4)
        shares[f"{metric}_perc"] = share
        beyond = (F.abs(share) > threshold_pct) | ((base == 0) & (diff != 0))
        out_of_range = out_of_range | true_only(beyond)
    return (
        joined.withColumns(differences)
        .withColumns(
            {
                **shares,
                "automation_flag": out_of_range,
                "missing_in_stats": F.col("_known").isNull(),
            }
        )
        .drop("_known")
    )


def comparison_summary(comparison: DataFrame) -> DataFrame:
    """Per date: any flag, flagged rows and the largest difference and percentage per metric."""
    largest = [
        F.max(F.abs(F.col(f"{metric}_{kind}"))).alias(f"max_{metric}_{kind}")
        for metric in LOG_METRICS
        for kind in ("diff", "perc")
    ]
    return comparison.groupBy("date").agg(
        F.bool_or("automation_flag").alias("automation_flag"),
        F.count_if("automation_flag").alias("flagged_rows"),
        *largest,
    )


def clean_advertisers(comparison: DataFrame) -> DataFrame:
    """Date, cluster and advertiser of all rows within range."""
    return comparison.where(~F.col("automation_flag")).select("date", "cluster", "advertiser_id")
