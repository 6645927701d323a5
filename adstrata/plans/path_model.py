"""The path model kept up to date: a run recomputes the days that new events can change, and no others.

The model lies in ``paths``, one partition a conversion day; ``firsts`` holds the earliest conversion of
each user, tracker and order, one folder a run. A conversion depends on touches of one lookback before
it, so events of the days a to b change conversions of the days a to b + lookback. Where a late
conversion takes the place of an earliest one, the day of the latter changes too.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.operators import paths
from adstrata.sources import readers, writers

_GROUP = ["anonymous_user_id", "conversion_tracker_id", "counted_as"]
# Ending of a table of firsts that is not in force yet.
DRAFT = "-draft"
_PLACE = ["conversion_at", "source_event_id"]


def _same_group(a: DataFrame, b: DataFrame) -> Column:
    first, *others = [a[name].eqNullSafe(b[name]) for name in _GROUP]
    for other in others:
        first = first & other
    return first


def _earliest(conversions: DataFrame) -> DataFrame:
    return conversions.groupBy(*_GROUP).agg(F.min(F.struct(*_PLACE)).alias("first"))


def _conversions(events: DataFrame) -> DataFrame:
    return events.where("has_conversion").select(
        "anonymous_user_id",
        "conversion_tracker_id",
        F.coalesce("order_id", "conversion_event_id", "event_id").alias("counted_as"),
        F.col("event_at").alias("conversion_at"),
        F.col("event_id").alias("source_event_id"),
    )


def _days(days: Iterable[date], before: int, after: int) -> list[date]:
    return sorted({d + timedelta(days=k) for d in days for k in range(-before, after + 1)})


def _on(events: DataFrame, days: list[date]) -> DataFrame:
    return paths.clean_events(events.where(F.col("event_date").isin(days)))


def latest_firsts(spark: SparkSession, root: str) -> DataFrame | None:
    """Earliest conversions as the last finished run has left them; None before the first run."""
    folder = f"{root.rstrip('/')}/firsts"
    names = [n for n in readers.run_folders(spark, folder) if not n.endswith(DRAFT)]
    done = [n for n in names if readers.exists(spark, f"{folder}/{n}/_SUCCESS")]
    return spark.read.parquet(f"{folder}/{max(done)}") if done else None


def update(
    log: DataFrame, campaigns: DataFrame, root: str, run: str, changed: Iterable[date], lookback_days: int = 60
) -> list[date]:
    """Bring the model below ``root`` up to date with events added on the ``changed`` days; returns its days.

    ``log`` are all events with a partition column ``event_date``; only days within a lookback of what
    changes are read. Run ids sort in the order of the runs. A run may add events of any day, but not
    take any away, and campaigns are those of the run: after such changes name all days. A run that
    failed has to be repeated before the next one; that gives the same model, because ``firsts`` follow
    after the paths.
    """
    spark, root = log.sparkSession, root.rstrip("/")
    changed = sorted(set(changed))
    if not changed:
        return []
    known = latest_firsts(spark, root)
    firsts = _earliest(_conversions(_on(log, changed)))
    touched = set(_days(changed, 0, lookback_days))
    if known is not None:
        new, old = firsts, known
        displaced = old.join(new, _same_group(old, new)).where(new["first"] < old["first"])
        # At most one row a day.
        rows = displaced.select(old["first"]["conversion_at"].cast("date").alias("day")).distinct().collect()
        touched |= {row["day"] for row in rows}
        firsts = known.unionByName(new).groupBy(*_GROUP).agg(F.min("first").alias("first"))
    target = f"{root}/firsts/{run}"
    writers.write_files(firsts, f"{target}{DRAFT}", "parquet")
    firsts = spark.read.parquet(f"{target}{DRAFT}")

    days = sorted(touched)
    found = paths.dedup_conversions(_on(log, days)).withColumn(
        "counted_as", F.coalesce("order_id", "conversion_event_id")
    )
    is_first = _same_group(found, firsts) & (F.struct(*[found[c] for c in _PLACE]) == firsts["first"])
    once = found.where("conversion_count_type = 'once'").join(firsts, is_first, "left_semi")
    conversions = found.where("conversion_count_type <> 'once'").unionByName(once).drop("counted_as")
    rollup = paths.path_rollup(_on(log, _days(days, lookback_days, 0)), conversions, lookback_days)
    model = paths.with_campaign(paths.classify_paths(rollup), paths.clean_campaigns(campaigns))
    # A day that has lost its last row is replaced as well: every day has a row without an id.
    blank = spark.createDataFrame([(d,) for d in days], "conversion_date date")
    writers.audit_by_date(model.unionByName(blank, allowMissingColumns=True), f"{root}/paths", "conversion_date")
    writers.write_files(firsts, target, "parquet")
    return days


def read_paths(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/paths").where(F.col("conversion_event_id").isNotNull())
