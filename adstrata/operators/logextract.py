"""Parametrised log-level extraction: projection, filters, name lookups, renames."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.functions.log_columns import HIERARCHY, METRICS, MICRO_COLUMNS
from adstrata.functions.privacy import PrivacyRules, censor
from adstrata.functions.scalars import from_micros, number_or_zero
from adstrata.functions.times import local_trunc, to_local, utc_bounds
from adstrata.operators import keys

log = logging.getLogger(__name__)

# Derived column -> unit of the local time it is cut to.
DERIVED_TIMES = {"request_date": "day", "request_hour": "hour"}

# Report columns that each hierarchy level adds to the account columns.
_NAMES = {
    "sub_advertiser_id": ["advertiser_id", "advertiser_name"],
    "line_item_id": ["campaign_group_id", "campaign_group_name"],
    "campaign_id": ["campaign_id", "campaign_name", "campaign_type"],
    "nativead_id": ["creative_id", "creative_name"],
}

# The report column that matches the log column of each level.
_NAME_KEYS = {
    "advertiser_id": "account_id",
    "sub_advertiser_id": "advertiser_id",
    "line_item_id": "campaign_group_id",
    "campaign_id": "campaign_id",
    "nativead_id": "creative_id",
}


@dataclass(frozen=True)
class LogRequest:
    """What a client asked for.

    ``start`` and ``end`` are local times, the end is exclusive. ``ids`` filter ``level``;
    without ids all rows of the window are taken. ``expressions`` are extra SQL columns.
    ``allowed`` names the dimensions that may be given out; without it all columns of the log may.
    """

    columns: Sequence[str]
    start: str | datetime
    end: str | datetime
    zone: str = "UTC"
    level: str = "advertiser_id"
    ids: Sequence[int | str] | None = None
    expressions: Sequence[str] = ()
    renames: str = ""
    events_only: bool = False
    privacy: PrivacyRules | None = None
    allowed: Sequence[str] | None = None


@dataclass(frozen=True)
class Hierarchy:
    """The entity tables behind the account hierarchy."""

    native_ads: DataFrame
    campaigns_native_ads: DataFrame
    campaigns: DataFrame
    line_items: DataFrame
    sub_advertisers: DataFrame
    users: DataFrame


@dataclass(frozen=True)
class Lookups:
    """Name tables; a missing one skips its enrichment."""

    custom_segments: DataFrame | None = None
    rt_segments: DataFrame | None = None
    dma: DataFrame | None = None
    trackers: DataFrame | None = None
    networks: DataFrame | None = None
    deals: DataFrame | None = None
    byod_deals: DataFrame | None = None


def known_columns(
    requested: Sequence[str], available: Sequence[str], allowed: Sequence[str] | None = None
) -> tuple[list[str], list[str]]:
    """Requested dimensions, then requested measures; names that are unknown or not allowed drop out.

    Measures and the derived times may always be given out.
    """
    known = [c for c in requested if c in available or c in DERIVED_TIMES]
    dims = [c for c in known if c not in METRICS]
    if allowed is not None:
        dims = [c for c in dims if c in allowed or c in DERIVED_TIMES]
    return dims, [c for c in known if c in METRICS]


def lowest_level(columns: Sequence[str]) -> str | None:
    found = [level for level in HIERARCHY if level in columns]
    return found[-1] if found else None


def parse_renames(text: str) -> dict[str, str]:
    """``"old:new, ..."`` as a mapping; parts without a colon are skipped with a warning."""
    renames = {}
    for part in filter(None, (part.strip() for part in text.split(","))):
        old, colon, new = part.partition(":")
        if colon:
            renames[old.strip()] = new.strip()
        else:
            log.warning("Skipping rename without colon: %s", part)
    return renames


def apply_renames(df: DataFrame, text: str) -> DataFrame:
    renames = parse_renames(text)
    absent = sorted(set(renames) - set(df.columns))
    if absent:
        log.warning("Columns to rename were not found: %s", absent)
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns})


def account_zone(users: DataFrame, zones: DataFrame) -> DataFrame:
    """Log zone name per account, from the platform's zone name; unknown zones become UTC."""
    named = users.select(F.col("id").alias("account_id"), F.col("timezone"))
    return named.join(zones, "timezone", "left").select(
        "account_id", F.coalesce("RS_timezone", F.lit("UTC")).alias("zone")
    )


def any_event() -> Column:
    return (F.col("has_won") == 1) | (F.col("has_click") == 1) | (F.col("has_conv") == 1)


def in_time_range(start: datetime, end: datetime, column: str = "request_time") -> Column:
    at = F.col(column)
    return (at >= F.lit(start).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz"))


def at_level(level: str, ids: Sequence[int | str]) -> Column:
    """Membership on a hierarchy column; an unknown level means the advertiser."""
    return F.col(level if level in HIERARCHY else "advertiser_id").isin(list(ids))


def selected(events: DataFrame, request: LogRequest) -> DataFrame:
    """Log rows of the window, the ids and the kind of events asked for.

    The filters stand on stored columns and the local bounds are turned into UTC literals,
    so both reach the scan.
    """
    rows = events.where(in_time_range(*utc_bounds(request.start, request.end, request.zone)))
    if request.ids is not None:
        rows = rows.where(at_level(request.level, request.ids))
    if request.events_only:
        rows = rows.where(any_event())
    return rows


def pull(events: DataFrame, request: LogRequest) -> DataFrame:
    """Selected rows with the columns asked for."""
    rows = selected(events, request)
    dims, mets = known_columns(request.columns, events.columns, request.allowed)

    def output(name: str) -> Column:
        if name in DERIVED_TIMES:
            return local_trunc(DERIVED_TIMES[name], "request_time", request.zone).alias(name)
        if name == "request_time":
            return to_local(name, request.zone).alias(name)
        if name in mets:
            return number_or_zero(name).alias(name)
        return F.col(name)

    extra = [F.expr(text) for text in request.expressions]
    if request.privacy is None:
        return rows.select(*map(output, dims + mets), *extra)
    # Censoring needs region and consent, which the client may not have asked for.
    return censor(rows, request.privacy).select(*map(output, dims + mets), *extra)


def name_map(hierarchy: Hierarchy, level: str) -> DataFrame:
    """Distinct names from the account down to ``level``.

    Entities whose chain is broken anywhere do not appear.
    """
    h = hierarchy
    chain = (
        h.native_ads.select(F.col("id").alias("creative_id"), F.col("name").alias("creative_name"))
        .join(
            h.campaigns_native_ads.select(
                F.col("native_ad_id").alias("creative_id"), F.col("campaign_id")
            ),
            "creative_id",
        )
        .join(
            h.campaigns.select(
                F.col("id").alias("campaign_id"),
                F.col("name").alias("campaign_name"),
                F.col("type").alias("campaign_type"),
                F.col("line_item_id").alias("campaign_group_id"),
                F.col("sub_advertiser_id").alias("advertiser_id"),
                F.col("user_id").alias("account_id"),
            ),
            "campaign_id",
        )
        .join(
            h.line_items.select(
                F.col("id").alias("campaign_group_id"), F.col("name").alias("campaign_group_name")
            ),
            "campaign_group_id",
        )
        .join(
            h.sub_advertisers.select(
                F.col("id").alias("advertiser_id"), F.col("name").alias("advertiser_name")
            ),
            "advertiser_id",
        )
        .join(
            h.users.select(
                F.col("id").alias("account_id"), F.col("company_name").alias("account_name")
            ),
            "account_id",
        )
    )
    levels = HIERARCHY[1 : HIERARCHY.index(level) + 1]
    names = [name for above in levels for name in _NAMES[above]]
    return chain.select("account_id", "account_name", *names).distinct()


def audience_names(
    custom_segments: DataFrame | None, rt_segments: DataFrame | None = None
) -> DataFrame:
    """Segment names by identifier, from the tables that are there.

    Retargeting segments have no numeric id.
    """
    frames = []
    if custom_segments is not None:
        frames.append(
            custom_segments.select(
                F.col("id").alias("auid_id"),
                F.col("identifier").cast("string").alias("matched_cseg_and_rt"),
                F.coalesce("display_name", "name").alias("audience"),
            )
        )
    if rt_segments is not None:
        frames.append(
            rt_segments.select(
                F.col("id").cast("string").alias("matched_cseg_and_rt"), F.col("name").alias("audience")
            )
        )
    if not frames:
        raise ValueError("a table of segments is needed")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


LOOKUP_COLUMNS = ["matched_cseg_and_rt", "dma", "conv_tracker_id", "network_id", "deal_id"]


def heavy_lookup_keys(df: DataFrame) -> dict[str, DataFrame]:
    """Frequent keys of all lookups of ``enrich``, found in one pass over their columns."""
    level = lowest_level(df.columns)
    columns = ([level] if level else []) + [c for c in LOOKUP_COLUMNS if c in df.columns]
    return keys.heavy_keys(df, columns)


def enrich(
    df: DataFrame, hierarchy: Hierarchy | None, lookups: Lookups, heavy: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Add names for the columns that are there; on a name clash the log column stays.

    All lookups are left joins without a forced strategy: small tables are broadcast by their
    size, larger ones are shuffled, rows without a key spread by their auction, or by all that
    they hold where the auction was not asked for. Rows of ``heavy`` keys (``heavy_lookup_keys``) are
    dealt over copies of their few lookup rows, so that no task gets all rows of one key.
    """
    heavy = heavy or {}
    spread_by = F.col("auction_id") if "auction_id" in df.columns else F.struct(*df.columns)
    level = lowest_level(df.columns)
    if level is not None and hierarchy is not None:
        df = keys.left_wins_join(df, name_map(hierarchy, level), level, _NAME_KEYS[level], spread_by, heavy.get(level))
    has_segments = lookups.custom_segments is not None or lookups.rt_segments is not None
    if "matched_cseg_and_rt" in df.columns and has_segments:
        audiences = audience_names(lookups.custom_segments, lookups.rt_segments)
        df = keys.left_wins_join(df, audiences, "matched_cseg_and_rt", None, spread_by, heavy.get("matched_cseg_and_rt"))
    if "dma" in df.columns and lookups.dma is not None:
        names = lookups.dma.select(
            F.col("DMA_Adjust").alias("dma"), F.col("DMA_Name").alias("dma_name")
        ).distinct()
        df = keys.left_wins_join(df, names, "dma", None, spread_by, heavy.get("dma"))
        df = df.withColumn("dma", F.col("dma").cast("string"))
    for column, table, source, name in (
        ("conv_tracker_id", lookups.trackers, "name", "conversion_name"),
        ("network_id", lookups.networks, "company_name", "network_name"),
    ):
        if column in df.columns and table is not None:
            names = table.select(F.col("id").alias(column), F.col(source).alias(name))
            df = keys.left_wins_join(df, names, column, None, spread_by, heavy.get(column))
            df = df.withColumn(column, F.col(column).cast("string"))
    if "deal_id" in df.columns and lookups.deals is not None:
        names = lookups.deals.select("deal_id", F.col("name").alias("deal_name"))
        df = keys.left_wins_join(df, names, "deal_id", None, spread_by, heavy.get("deal_id"))
        df = df.withColumn("deal_id", F.coalesce(F.col("deal_id").cast("string"), F.lit("")))
        if lookups.byod_deals is not None:
            df = keys.only_known(df, "deal_id", lookups.byod_deals, "deal_id", heavy=heavy.get("deal_id"))
    return df


def currency_units(df: DataFrame) -> DataFrame:
    """Micro columns in whole currency units."""
    return df.withColumns({c: from_micros(c) for c in MICRO_COLUMNS if c in df.columns})


def build_report(
    events: DataFrame,
    request: LogRequest,
    hierarchy: Hierarchy | None,
    lookups: Lookups,
    balance: bool = False,
) -> DataFrame:
    """The client report: pull, enrich, convert, rename.

    ``balance`` looks for frequent keys first, in one more pass over the key columns, and spreads
    their rows; worth it where lookup tables are too large to be broadcast.
    """
    rows = pull(events, request)
    heavy = heavy_lookup_keys(rows) if balance else None
    report = currency_units(enrich(rows, hierarchy, lookups, heavy))
    return apply_renames(report, request.renames)


def sample_rows(report: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in a fixed order, for a look at the shape of a delivery."""
    return report.orderBy(*order).limit(n)


def performance_totals(events: DataFrame, group: Sequence[str]) -> DataFrame:
    """Cost in currency units, delivery counts and log rows per group."""
    counts = {
        "impressions": "has_won",
        "clicks": "has_click",
        "conversions": "has_conv",
        "lt_conversions": "has_ltconv",
    }
    return events.groupBy(*group).agg(
        (F.sum(F.col("cost").cast("decimal(28,6)")).cast("double") / F.lit(1_000_000.0)).alias("cost_usd"),
        *[F.sum(source).alias(name) for name, source in counts.items()],
        F.count(F.lit(1)).alias("event_count"),
    )


def text_columns(df: DataFrame) -> DataFrame:
    """Every column as text, null as empty text."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
