"""Device-to-identity stitching with repeatable handling of ambiguous links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adstrata.functions.labels import first_match
from adstrata.functions.scalars import ratio
from adstrata.operators import keys

SEED = 42

# Alert limits for the share of rows with an identity and with a client key.
LUID_FILL_ALERT = 0.75
KEY_FILL_ALERT = 0.65

# Export column -> report column.
EXPORT_COLUMNS = {
    "client_key": "synthetic_key",
    "campaign_id": "campaign_group_id",
    "campaign_name": "campaign_group_name",
    "ad_group_id": "campaign_id",
    "ad_group_name": "campaign_name",
    "advertiser_id": "advertiser_id",
    "advertiser_name": "advertiser_name",
    "media_type": "supply_inventory_type",
    "audience_id": "matched_cseg_and_rt",
    "audience_name": "audience",
    "creative_id": "creative_id",
    "creative_name": "creative_name",
    "device_type": "device_type",
    "event_type": "event_type",
    "event_id": "auction_id",
    "total_cost": "cost",
    "timestamp": "request_time",
}


def device_ids(log: DataFrame) -> DataFrame:
    """Distinct non-blank device ids of a log, direct and associated, as ``duid``."""
    return keys.distinct_values(
        log, ["request_duid_sha256", "most_associated_duid_sha256"], "duid"
    )


def flatten_graph(graph: DataFrame) -> DataFrame:
    """Clean ``(luid, duid)`` edges of a nested graph with ``duids: array<struct<id>>``."""
    usable = F.col("luid").isNotNull() & (F.trim("luid") != "") & (F.size("duids") > 0)
    return clean_edges(
        graph.where(usable).select("luid", F.explode("duids.id").alias("duid"))
    )


def clean_edges(edges: DataFrame) -> DataFrame:
    """Trimmed and complete edges. Repeated ones may stay, because a pick takes each value once."""
    trimmed = edges.select(F.trim("luid").alias("luid"), F.trim("duid").alias("duid"))
    return trimmed.where((F.col("luid") != "") & (F.col("duid") != ""))


def restrict_edges(edges: DataFrame, devices: DataFrame) -> DataFrame:
    """Distinct edges of the given devices."""
    return keys.matched(edges, devices, ["duid"]).distinct()


def pick_luids(edges: DataFrame, seed: int = SEED) -> DataFrame:
    """One identity per device."""
    return keys.hash_pick(edges, "duid", "luid", seed)


def clean_crosswalk(crosswalk: DataFrame, luid: str, key: str) -> DataFrame:
    """Complete ``(luid, synthetic_key)`` pairs."""
    return crosswalk.select(F.col(luid).alias("luid"), F.col(key).alias("synthetic_key")).dropna()


def pick_synthetic_keys(crosswalk: DataFrame, seed: int = SEED) -> DataFrame:
    """One client key per identity."""
    return keys.hash_pick(crosswalk, "luid", "synthetic_key", seed)


def device_directory(luids: DataFrame, synthetic_keys: DataFrame) -> DataFrame:
    """Device, identity and client key in one narrow table, so that the log is not joined
    a third time. Keys of identities no device has drop out here."""
    return luids.join(synthetic_keys, "luid", "left")


def stitch(log: DataFrame, directory: DataFrame) -> DataFrame:
    """Match log rows by their own device id, else by the associated one.

    Every log row stays exactly once. Rows without a device id get join keys that match
    nothing and spread over all partitions.
    """
    result = log
    for column, prefix in (
        ("request_duid_sha256", "_own"),
        ("most_associated_duid_sha256", "_linked"),
    ):
        side = directory.select(
            F.col("duid").alias(f"{prefix}_duid"),
            F.struct("luid", "synthetic_key").alias(prefix),
        )
        device = keys.spread_null_key(column, "auction_id")
        result = result.join(side, device == F.col(f"{prefix}_duid"), "left").drop(f"{prefix}_duid")
    match = F.coalesce("_own", "_linked")
    return result.withColumns(
        {
            "matched_luid": match["luid"],
            "synthetic_key": match["synthetic_key"],
            "luid_match_source": first_match(
                [
                    (F.col("_own").isNotNull(), "request_duid_sha256"),
                    (F.col("_linked").isNotNull(), "most_associated_duid_sha256"),
                ]
            ),
        }
    ).drop("_own", "_linked")


def _fill_measures() -> list[Column]:
    luid = F.count("matched_luid")
    key = F.count("synthetic_key")
    total = F.count(F.lit(1))
    return [
        total.alias("total_rows"),
        luid.alias("rows_with_luid"),
        (total - luid).alias("rows_without_luid"),
        key.alias("rows_with_key"),
        ratio(luid, total).alias("luid_fill_rate"),
        ratio(key, total).alias("key_fill_rate"),
    ]


def fill_rates(stitched: DataFrame) -> DataFrame:
    """Rows with and without an identity or client key, and their shares, in one aggregate."""
    return stitched.agg(*_fill_measures())


def observe_fill(stitched: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and their fill rates as a by-product of writing them.

    Saves the second run that a separate aggregate would need. ``Observation.get`` has the
    rates once the rows have been written.
    """
    observation = Observation("fill_rates")
    return stitched.observe(observation, *_fill_measures()), observation


def fill_alerts(
    rates: DataFrame, luid_limit: float = LUID_FILL_ALERT, key_limit: float = KEY_FILL_ALERT
) -> DataFrame:
    """Whether the fill rates fall below their alert limits."""
    return rates.withColumns(
        {
            "luid_fill_alert": F.col("luid_fill_rate") < luid_limit,
            "key_fill_alert": F.col("key_fill_rate") < key_limit,
        }
    )


def event_label() -> Column:
    """A click outweighs an impression; other rows have no label."""
    return first_match(
        [(F.col("has_click") == 1, "click"), (F.col("has_won") == 1, "impression")]
    )


def export_rows(report: DataFrame) -> DataFrame:
    """The client's 17 columns."""
    labelled = report.withColumn("event_type", event_label())
    return labelled.select(
        *[F.col(source).alias(name) for name, source in EXPORT_COLUMNS.items()]
    )


@dataclass(frozen=True)
class Stitched:
    rows: DataFrame
    rates: DataFrame


def resolve(
    log: DataFrame,
    edges: DataFrame,
    crosswalk: DataFrame,
    seed: int = SEED,
    restrict: bool = False,
) -> Stitched:
    """Stitch a log with cleaned edges and crosswalk.

    ``restrict`` cuts the edges down to the devices in the log and the crosswalk to their
    identities first, which pays off when the graph is larger than the log. The result is the
    same: picks are made per device and per identity.
    """
    if restrict:
        edges = keys.matched(edges, device_ids(log), ["duid"])
    luids = pick_luids(edges, seed)
    if restrict:
        crosswalk = keys.matched(crosswalk, luids, ["luid"])
    rows = stitch(log, device_directory(luids, pick_synthetic_keys(crosswalk, seed)))
    return Stitched(rows=rows, rates=fill_rates(rows))
