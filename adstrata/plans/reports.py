"""The reports as one call each. All of them are lazy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from adstrata.operators import attribution, campaign_daily, health, identity, logextract, paths
from adstrata.operators import reconcile, touch_quality


@dataclass(frozen=True)
class AttributionReport:
    issues: DataFrame
    influence: DataFrame
    summary: DataFrame


def attribution_report(
    opportunities: DataFrame, touchpoints: DataFrame, as_of: str
) -> AttributionReport:
    deals = touch_quality.clean_opportunities(opportunities)
    touches = touch_quality.clean_touchpoints(touchpoints)
    influence = attribution.assign_influence(
        attribution.touchpoint_fact(deals, touches, as_of)
    )
    return AttributionReport(
        issues=touch_quality.touchpoint_issues(deals, touches),
        influence=influence,
        summary=attribution.influence_summary(influence),
    )


def channel_attribution(
    opportunities: DataFrame, touchpoints: DataFrame, as_of: str
) -> DataFrame:
    """Credit per channel and model; validated touches, normalised to the deal value."""
    valid = touch_quality.validate_touchpoints(opportunities, touchpoints).valid
    fact = attribution.touchpoint_fact(
        opportunities, valid, as_of, keep=attribution.CREDITED, deal_credit=True
    )
    return attribution.revenue_by_channel(
        attribution.normalise_allocations(attribution.attribution_by_model(fact))
    )


def daily_quality_report(
    events: DataFrame, campaigns: DataFrame, delivery: DataFrame, lookback_days: int = 60
) -> DataFrame:
    """Campaign quality from raw events, without storing the path model in between."""
    model = paths.conversion_paths(events, campaigns, lookback_days)
    return campaign_daily.campaign_quality(delivery, campaigns, model)


def reporting_health(
    accounts: DataFrame,
    opportunities: DataFrame,
    revenue_source: DataFrame,
    row_counts: DataFrame,
    stages: list[str],
    as_of: str,
    max_age_days: int = 2,
) -> DataFrame:
    """All checks of the reporting tables as one frame; one pass per table for the column checks."""
    account_fields = ["account_id", "account_name", "segment", "updated_at"]
    deal_fields = ["opportunity_id", "account_id", "stage_name", "amount_reporting", "updated_at"]
    return health.combine(
        health.run_checks(
            accounts,
            "accounts",
            health.fields_present(accounts.columns, account_fields),
            health.fresh("updated_at", max_age_days, as_of),
        ),
        health.run_checks(
            opportunities,
            "opportunities",
            health.fields_present(opportunities.columns, deal_fields),
            health.fresh("updated_at", max_age_days, as_of),
        ),
        health.valid_values(opportunities, "opportunities", "stage_name", stages),
        health.duplicate_key(accounts, "accounts", "account_id"),
        health.duplicate_key(opportunities, "opportunities", "opportunity_id"),
        health.revenue_reconciliation(opportunities, revenue_source),
        health.row_count_drop(row_counts),
    )


def advertiser_check(log: DataFrame, stats: DataFrame) -> DataFrame:
    """Compared advertisers of all dates in the log."""
    return reconcile.compare_advertisers(
        reconcile.log_totals(log), reconcile.stats_totals(stats)
    )


def identity_delivery(
    events: DataFrame,
    request: logextract.LogRequest,
    hierarchy: logextract.Hierarchy,
    lookups: logextract.Lookups,
    edges: DataFrame,
    crosswalk: DataFrame,
) -> identity.Stitched:
    """Client rows and fill rates: the report of a log request, stitched to client keys."""
    report = logextract.build_report(events, request, hierarchy, lookups)
    stitched = identity.resolve(report, edges, crosswalk)
    return identity.Stitched(rows=identity.export_rows(stitched.rows), rates=stitched.rates)


def performance_report(
    events: DataFrame,
    group: list[str],
    request: logextract.LogRequest,
    sample: bool = False,
) -> DataFrame:
    """Delivery totals of the rows a request selects. A sample holds the first 100 groups."""
    totals = logextract.performance_totals(logextract.selected(events, request), group)
    return logextract.sample_rows(totals, group, 100) if sample else totals
