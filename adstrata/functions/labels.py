"""Business labels: ordered bands, priority notes and weighted scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Label of the first rule that holds; a null condition does not hold."""
    (condition, label), *rest = rules
    chain = F.when(condition, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def penalty_score(penalties: Sequence[tuple[Column, int]], start: int = 100) -> Column:
    """``start`` minus the weight of every flag that is true."""
    score = F.lit(start)
    for flag, weight in penalties:
        score = score - F.when(flag, F.lit(weight)).otherwise(F.lit(0))
    return score


def velocity_band(days: Column) -> Column:
    """How fast a conversion came, from elapsed days."""
    # Upper bounds in days and their names.
    bands = [(7, "fast"), (30, "standard"), (90, "extended")]
    return first_match([(days <= limit, name) for limit, name in bands], "long_tail")


def budget_status(spend: Column, budget: Column) -> Column:
    """Spend compared with a 10 % band around the budget."""
    return first_match(
        [
            (spend > budget * F.lit(1.10), "overrun"),
            (spend < budget * F.lit(0.90), "underspent"),
        ],
        "on_track",
    )


def delivery_data_flag(
    impressions: Column, spend: Column, conversion_rate: Column, last_sync: Column, now: Column
) -> Column:
    """One data quality label per delivery row; a sync older than four hours is stale."""
    return first_match(
        [
            (impressions == 0, "no_delivery"),
            (spend.isNull(), "missing_cost_data"),
            (conversion_rate > 0.50, "suspicious_high_rate"),
            (last_sync < now - F.expr("INTERVAL 4 HOURS"), "stale_data"),
        ],
        "healthy",
    )
