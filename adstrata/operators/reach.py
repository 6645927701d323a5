"""Reach and frequency of campaigns.

Everything starts from impressions per (group, user). Spark shuffles those on group and user,
so a group with very many users is spread; the step to the group is a plain aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstrata.functions.scalars import number_or_zero, ratio
from adstrata.operators.keys import left_wins_join

# Default thresholds of the cumulative table and of the short report.
THRESHOLDS = tuple(range(1, 51))
SHORT_THRESHOLDS = (1, 5, 10, 20, 50)


@dataclass(frozen=True)
class LabelledWindow:
    """Half-open window ``[start, end)`` of local days."""

    start: date
    end: date
    label: str


def with_line_item_names(log: DataFrame, line_items: DataFrame, key: str = "line_item_id") -> DataFrame:
    """Add group id and name to log rows; unknown line items get a null name."""
    names = line_items.select(
        F.col("id").alias("cg_id"), F.col("name").alias("cg_name")
    ).distinct()
    return left_wins_join(log, names, key, "cg_id")


def _grouped(df: DataFrame, group: Sequence[str], user: str) -> DataFrame:
    """Rows with a complete group and a user; the others belong to no group."""
    complete = F.col(user).isNotNull()
    for name in group:
        complete = complete & F.col(name).isNotNull()
    return df.where(complete)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise KeyError(f"missing required columns: {missing}")
    return df


def user_frequency(
    df: DataFrame, group: Sequence[str], user: str = "uniq_imp_id", impression: str = "has_won"
) -> DataFrame:
    """Impressions per group and user; unreadable impression values count as 0."""
    require_columns(df, [*group, user, impression])
    return (
        _grouped(df, group, user)
        .groupBy(*group, user)
        .agg(F.sum(number_or_zero(impression, "bigint")).alias("imps"))
    )


def reach_summary(
    df: DataFrame, group: Sequence[str], user: str = "uniq_imp_id", impression: str = "has_won"
) -> DataFrame:
    """Distinct users, impressions and log rows per user."""
    return (
        df.where(_all_present(group))
        .groupBy(*group)
        .agg(
            F.countDistinct(user).alias("reach"),
            F.sum(number_or_zero(impression, "bigint")).alias("impressions"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .withColumn("frequency", ratio("_rows", "reach"))
        .drop("_rows")
        .orderBy(F.desc_nulls_last("frequency"), *group)
    )


def _all_present(group: Sequence[str]) -> Column:
    present = F.lit(True)
    for name in group:
        present = present & F.col(name).isNotNull()
    return present


def frequency_histogram(frequency: DataFrame, group: Sequence[str]) -> DataFrame:
    """Users per number of impressions, in long form."""
    return _histogram(frequency, group).orderBy(*group, "imps")


def _histogram(frequency: DataFrame, group: Sequence[str], *labels: Column) -> DataFrame:
    return frequency.groupBy(*group, "imps").agg(F.count(F.lit(1)).alias("users"), *labels)


def _users(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("users")).otherwise(F.lit(0)))


def _base() -> list[Column]:
    return [
        F.sum("users").alias("reach"),
        F.sum(F.col("imps") * F.col("users")).alias("impressions"),
    ]


def _at_least(thresholds: Sequence[int]) -> list[Column]:
    return [_users(F.col("imps") >= k).alias(f"{k}+") for k in thresholds]


def _exactly(counts: Sequence[int]) -> list[Column]:
    """Users of each listed count, and of all others, so that the columns add up to the reach."""
    listed = F.coalesce(F.col("imps").isin(list(counts)), F.lit(False))
    return [*[_users(F.col("imps") == n).alias(f"{n}x") for n in counts], _users(~listed).alias("other_x")]


def cumulative_distribution(
    frequency: DataFrame, group: Sequence[str], thresholds: Sequence[int] = THRESHOLDS
) -> DataFrame:
    """Reach and the users with at least k impressions for every threshold, highest average first.

    The many conditions run over the histogram, which has few rows, not over the users.
    """
    return (
        _histogram(frequency, group)
        .groupBy(*group)
        .agg(*_base(), *_at_least(thresholds))
        .withColumn("avg_imp_per_user", ratio("impressions", "reach"))
        .orderBy(F.desc("avg_imp_per_user"), *group)
    )


def exact_distribution(
    frequency: DataFrame, group: Sequence[str], counts: Sequence[int]
) -> DataFrame:
    """Reach and the users with exactly n impressions for the listed counts, highest average first.

    The counts are given, which keeps the columns fixed; ``other_x`` has the users of all other
    counts. ``exact_counts`` has a row for every count that occurs.
    """
    return (
        _histogram(frequency, group)
        .groupBy(*group)
        .agg(*_base(), *_exactly(counts))
        .withColumn("avg_imp_per_user", ratio("impressions", "reach"))
        .orderBy(F.desc("avg_imp_per_user"), *group)
    )


def exact_counts(frequency: DataFrame, group: Sequence[str]) -> DataFrame:
    """Users for every number of impressions that occurs, beside reach and average of the group."""
    histogram = _histogram(frequency, group)
    # One row for each group and count: far fewer than users.
    whole = Window.partitionBy(*group)
    return (
        histogram.select(
            *group,
            "imps",
            "users",
            F.sum("users").over(whole).alias("reach"),
            F.sum(F.col("imps") * F.col("users")).over(whole).alias("impressions"),
        )
        .withColumn("avg_imp_per_user", ratio("impressions", "reach"))
        .orderBy(F.desc("avg_imp_per_user"), *group, "imps")
    )


def in_windows(df: DataFrame, time: str, windows: Sequence[LabelledWindow]) -> DataFrame:
    """One row per log row and window it falls into, marked with ``window``.

    The windows are a short literal list, so rows are matched and multiplied in place,
    without a join.
    """
    if len({w.label for w in windows}) < len(windows):
        raise ValueError("window labels must differ")
    at = F.col(time)
    labels = [
        F.when(
            (at >= F.lit(w.start).cast("timestamp_ntz")) & (at < F.lit(w.end).cast("timestamp_ntz")),
            F.lit(w.label),
        )
        for w in windows
    ]
    return df.withColumn("window", F.explode(F.array_compact(F.array(*labels))))


def windowed_distribution(
    df: DataFrame,
    group: Sequence[str],
    time: str,
    windows: Sequence[LabelledWindow],
    thresholds: Sequence[int] = THRESHOLDS,
    user: str = "uniq_imp_id",
    impression: str = "has_won",
) -> DataFrame:
    """Cumulative distribution per group and labelled window, for all windows at once.

    The bounds of all windows cut time into panes. Impressions are added up per pane and user before
    a row is multiplied by the windows that cover its pane.
    """
    require_columns(df, [time, *group, user, impression])
    keyed = [*group, "window"]
    in_pane = df.select(*group, user, impression, _pane(time, windows).alias("_pane"))
    by_pane = user_frequency(in_pane.where("_pane > 0"), [*group, "_pane"], user, impression)
    frequency = user_frequency(_covering(by_pane, windows), keyed, user, "imps")
    return cumulative_distribution(frequency, keyed, thresholds)


def _bounds(windows: Sequence[LabelledWindow]) -> list[date]:
    return sorted({bound for w in windows for bound in (w.start, w.end)})


def _pane(time: str, windows: Sequence[LabelledWindow]) -> Column:
    """Number of window bounds at or before a time; 0 before all of them and for no time."""
    passed = [(F.col(time) >= F.lit(b).cast("timestamp_ntz")).cast("int") for b in _bounds(windows)]
    return F.coalesce(sum(passed[1:], passed[0]) if passed else F.lit(0), F.lit(0))


def _covering(panes: DataFrame, windows: Sequence[LabelledWindow]) -> DataFrame:
    """One row per pane row and window that covers it, marked with ``window``."""
    if len({w.label for w in windows}) < len(windows):
        raise ValueError("window labels must differ")
    number = {bound: k + 1 for k, bound in enumerate(_bounds(windows))}
    labels = [
        F.when((F.col("_pane") >= number[w.start]) & (F.col("_pane") < number[w.end]), F.lit(w.label)) for w in windows
    ]
    return panes.withColumn("window", F.explode(F.array_compact(F.array(*labels)))).drop("_pane")


def trailing_distribution(
    df: DataFrame,
    group: Sequence[str],
    time: str,
    days: int,
    thresholds: Sequence[int] = THRESHOLDS,
    user: str = "uniq_imp_id",
    impression: str = "has_won",
) -> DataFrame:
    """Distribution over the ``days`` before the newest time; that instant itself is out."""
    newest = df.agg(F.max(time)).scalar()
    recent = df.where(
        (F.col(time) >= newest - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col(time) < newest)
    )
    return cumulative_distribution(
        user_frequency(recent, group, user, impression), group, thresholds
    )


def campaign_report(
    frequency: DataFrame, group: Sequence[str], exact: Sequence[int], name: str | None = None
) -> DataFrame:
    """Reach, rounded average, exact and cumulative buckets of the short report.

    ``name`` is a label column that is not part of the group; its smallest value is shown.
    """
    label = [F.min(name).alias(name)] if name else []
    return (
        _histogram(frequency, group, *label)
        .groupBy(*group)
        .agg(*label, *_base(), *_exactly(exact), *_at_least(SHORT_THRESHOLDS))
        .withColumnRenamed("impressions", "total_impressions")
        .withColumn("avg_frequency", F.round(ratio("total_impressions", "reach"), 2))
    )


def weekly_report(
    df: DataFrame,
    group: Sequence[str],
    time: str,
    exact: Sequence[int],
    user: str = "uniq_imp_id",
    impression: str = "has_won",
) -> DataFrame:
    """The short report per ISO week; a week belongs to the ISO year it is numbered in."""
    weekly = df.withColumns({"iso_year": F.extract(F.lit("YEAROFWEEK"), F.col(time)), "week": F.weekofyear(time)})
    keyed = ["iso_year", "week", *group]
    return campaign_report(user_frequency(weekly, keyed, user, impression), keyed, exact)


def saturation_alerts(
    distribution: DataFrame,
    max_average: float = 15,
    frequent_share: float = 0.5,
    min_reach: int = 100,
) -> DataFrame:
    """One row per group and alert: average above 15, half the users at 10+, reach below 100.

    Needs ``reach``, ``impressions`` and ``10+``.
    """
    rules = F.array(
        _alert(ratio("impressions", "reach") > max_average, "avg_frequency", "WARNING"),
        _alert(ratio("10+", "reach") >= frequent_share, "frequent_users", "WARNING"),
        _alert(F.col("reach") < min_reach, "low_reach", "INFO"),
    )
    return distribution.withColumn("_a", F.explode(F.array_compact(rules))).select(
        *distribution.columns, "_a.*"
    )


def _alert(condition: Column, name: str, level: str) -> Column:
    return F.when(condition, F.struct(F.lit(name).alias("alert"), F.lit(level).alias("level")))
