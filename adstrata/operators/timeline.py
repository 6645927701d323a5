"""Ordered computations per key that do not need a busy key in one task.

A window over (key, time) sorts each key in a single task, which fails when one key holds a
large part of the table. Sequences and running sums are cut where range partitioning cuts the rows.
Look-back aggregates cut the time axis of a busy key into buckets. Windows then run inside a piece of
a key, and what lies before (or after) it arrives as one carried row, computed from totals of the pieces.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.functions.scalars import MICROS, ColumnLike, as_column
from adstrata.sources.scratch import release_shuffles, written

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


# A key with so many rows is busy, however large the table is: no task orders more rows of one key.
BUSY_ROWS = 1_000_000

# Cells of the interval index in a stretch of one lookback.
CELLS = 8


def busy_keys(df: DataFrame, key: Sequence[str], min_rows: int = BUSY_ROWS) -> DataFrame:
    """Keys that hold at least ``min_rows`` rows: at most one for so many rows of the table."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") >= min_rows).drop("_n")


def with_bucket(df: DataFrame, key: Sequence[str], bucket: Column, busy: DataFrame) -> DataFrame:
    """Add ``_bucket``: the given one for busy keys, null for the others, which stay whole.

    Busy keys are broadcast where Spark finds them small; otherwise the shuffled rows of a busy key
    are split by adaptive execution.
    """
    marked = busy.select(*key, F.lit(True).alias("_busy"))
    return (
        df.join(marked, list(key), "left").withColumn("_bucket", F.when(F.col("_busy"), bucket)).drop("_busy")
    )


def order_by_ranges(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    *,
    sequence: str | None = None,
    totals: Mapping[str, Column] | None = None,
    running: Mapping[str, ColumnLike] | None = None,
    later: Mapping[str, Column] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Number rows per key, add key totals and running sums, whatever a key holds.

    Rows are range-partitioned by key and order together, so a busy key is spread over several ranges
    wherever its rows lie: at one instant, or without a time at all. Windows run inside (key, range). A
    boundary cuts at most one key, so no more than two keys a range go on elsewhere; only for those do
    totals of the ranges before arrive, as one carried row per (key, range).

    ``totals`` maps a new column to an aggregate over sums and counts, ``running`` maps a new column to
    the value that is summed up to and including the current row. ``later`` maps a new column to an
    aggregate of the key over rows that have all these columns already; only rows of the keys that a
    boundary cuts move once more for it. Rows with a null in the key belong to
    no key and are dropped. Without ``ranges`` Spark chooses their number. The ranged rows are written
    to the shared folder once: boundaries are sampled, and all that follows has to see the same ones.
    Shuffle files of what led to them are let go.
    """
    totals, later = dict(totals or {}), dict(later or {})
    running = {name: as_column(value) for name, value in (running or {}).items()}
    spark = df.sparkSession
    by = [*[F.col(k) for k in key], *order]
    known = df.dropna(subset=list(key))
    dealt = known.repartitionByRange(*by) if ranges is None else known.repartitionByRange(ranges, *by)
    placed = written(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    release_shuffles(spark)

    whole = F.struct(*key)
    ends = placed.groupBy("_range").agg(F.array_distinct(F.array(F.min(whole), F.max(whole))).alias("_ends"))
    # At most two keys a range reach the driver, and their totals.
    spread: dict[tuple, int] = {}
    for row in ends.collect():
        for end in row["_ends"]:
            spread[tuple(end)] = spread.get(tuple(end), 0) + 1
    cut = [end for end, n in spread.items() if n > 1]
    carried = of_cut_keys = None
    if cut:
        kinds = T.StructType([df.schema[k] for k in key])
        of_cut_keys = placed.join(F.broadcast(spark.createDataFrame(cut, kinds)), list(key), "left_semi")
        per_range = of_cut_keys.groupBy(*key, "_range").agg(
            F.count(F.lit(1)).alias("_rows"),
            *[value.alias(f"_total_{name}") for name, value in totals.items()],
            *[F.sum(value).alias(f"_sum_{name}") for name, value in running.items()],
        )
        of_key = Window.partitionBy(*key)
        earlier = of_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        carried = per_range.select(
            *key,
            "_range",
            F.sum("_rows").over(earlier).alias("_rows_before"),
            *[F.sum(f"_total_{name}").over(of_key).alias(f"_whole_{name}") for name in totals],
            *[F.sum(f"_sum_{name}").over(earlier).alias(f"_before_{name}") for name in running],
        )
        carried = spark.createDataFrame(carried.collect(), carried.schema)

    inside = Window.partitionBy(*key, "_range")

    def numbered(placed: DataFrame) -> DataFrame:
        ordered = inside.orderBy(*order)
        so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local: dict[str, Column] = {f"_local_{name}": value.over(inside) for name, value in totals.items()}
        if sequence:
            local["_place"] = F.row_number().over(ordered)
        for name, value in running.items():
            local[f"_run_{name}"] = F.sum(value).over(so_far)
        rows = placed.withColumns(local)
        added = {name: F.col(f"_local_{name}") for name in totals}
        if sequence:
            added[sequence] = F.col("_place").cast("bigint")
        for name in running:
            added[name] = F.coalesce(f"_run_{name}", F.lit(0))
        if carried is not None:
            rows = rows.join(F.broadcast(carried), [*key, "_range"], "left")
            before = {sequence: "_rows_before"} | {name: f"_before_{name}" for name in running}
            for name in added:
                if name in totals:
                    added[name] = F.coalesce(F.col(f"_whole_{name}"), added[name])
                else:
                    added[name] = F.coalesce(before[name], F.lit(0)) + added[name]
        return rows.select(*placed.columns, *[value.alias(name) for name, value in added.items()])

    rows = numbered(placed)
    if later:
        local = {name: value.over(inside) for name, value in later.items()}
        if of_cut_keys is not None:
            whole = numbered(of_cut_keys).groupBy(*key).agg(
                F.lit(True).alias("_cut"), *[value.alias(f"_whole_{name}") for name, value in later.items()]
            )
            whole = spark.createDataFrame(whole.collect(), whole.schema)
            rows = rows.join(F.broadcast(whole), list(key), "left")
            for name in later:
                local[name] = F.when(F.col("_cut"), F.col(f"_whole_{name}")).otherwise(local[name])
        rows = rows.withColumns(local).drop("_cut", *[f"_whole_{name}" for name in later])
    return rows.drop("_range")


@dataclass(frozen=True)
class Lookback:
    """What to collect over the touches in ``[probe time - lookback, probe time]``.

    ``sums``      new column -> numeric column, summed exactly
    ``distinct``  new column -> value counted once, null values ignored
    ``edges``     suffix -> condition; gives ``first_<suffix>`` and ``last_<suffix>`` times
    ``lists``     new column -> value, distinct values in order joined with " / "
    """

    sums: Mapping[str, Column]
    distinct: Mapping[str, Column]
    edges: Mapping[str, Column]
    lists: Mapping[str, Column]


def lookback_rollup(
    probes: DataFrame,
    touches: DataFrame,
    *,
    key: str,
    probe_at: str,
    touch_at: str,
    collect: Lookback,
    lookback_us: int,
    busy: DataFrame,
    bucket_us: int = HOUR_US,
    empty_list: str = "Unknown",
) -> DataFrame:
    """Aggregate, per probe, the touches of the same key in a trailing time range.

    Joining probes with their touches would emit every pair of a busy key. Instead each
    measure is brought to a difference of two prefix sums on the key's time axis, read once
    at the probe (inclusive) and once where its range begins (exclusive):

    - a sum is the prefix sum up to the probe minus the one before the range;
    - a distinct count needs, per value, the stretches in which the value is in range. A
      stretch opens at a touch with no earlier touch of the value within the lookback, and
      closes one lookback after a touch with no later one within it. Opened minus closed
      stretches is the number of distinct values;
    - the last time is a prefix maximum at the probe, the first a suffix minimum at the
      beginning of the range.

    Distinct lists match probes with the stretches of the listed values, which gives exactly
    the rows that end up in the lists. ``probes`` keeps all its rows and columns; equal rows
    must have been merged before. The time axis of the ``busy`` keys is cut into buckets of
    ``bucket_us``.
    """
    names = [*collect.distinct, *collect.lists]

    touch = touches.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        _micros(touch_at).alias("_us"),
        # Millionths as integers: exact, and cheaper to add up than decimals.
        *[
            (value.cast("decimal(28,6)") * F.lit(MICROS)).cast("bigint").alias(f"sum_{n}")
            for n, value in collect.sums.items()
        ],
        *[value.cast("string").alias(f"value_{n}") for n, value in collect.distinct.items()],
        *[value.cast("string").alias(f"value_{n}") for n, value in collect.lists.items()],
        *[condition.alias(f"edge_{n}") for n, condition in collect.edges.items()],
    )
    stretch_edges = _stretch_edges(touch, names, lookback_us)
    asked = probes.select(
        F.struct(*[F.col(name) for name in probes.columns]).alias("_probe"),
        # A probe without a key finds nothing; it gets a key of its own.
        F.coalesce(
            F.col(key).cast("string"),
            F.concat(F.lit("\u0000"), F.xxhash64(*probes.columns).cast("string")),
        ).alias("_key"),
        _micros(probe_at).alias("_us"),
    )

    points = _points(touch, stretch_edges, asked, collect, lookback_us)
    readings = _readings(points, collect, busy.select(F.col(key).alias("_key")), bucket_us)
    if collect.lists:
        readings = readings.unionByName(
            _listed(stretch_edges, asked, collect, lookback_us), allowMissingColumns=True
        )

    first_us = {n: F.max(F.when(F.col("_side") == -1, F.col(f"next_{n}"))) for n in collect.edges}
    last_us = {n: F.max(F.when(F.col("_side") == 1, F.col(f"last_{n}"))) for n in collect.edges}
    grouped = readings.groupBy("_probe").agg(
        *[
            (F.coalesce(F.sum(F.col("_side") * F.col(f"run_{n}")), F.lit(0)) / F.lit(float(MICROS))).alias(n)
            for n in collect.sums
        ],
        *[
            (
                F.sum(F.when(F.col("_side") == 1, F.col(f"opened_{n}")).otherwise(F.lit(0)))
                - F.sum(F.when(F.col("_side") == -1, F.col(f"closed_{n}")).otherwise(F.lit(0)))
            ).alias(n)
            for n in collect.distinct
        ],
        *[value.alias(f"_first_{n}") for n, value in first_us.items()],
        *[value.alias(f"_last_{n}") for n, value in last_us.items()],
        F.max("_us").alias("_us"),
        *[
            F.collect_set(F.when(F.col("_list") == n, F.col("_value"))).alias(n)
            for n in collect.lists
        ],
    )
    start_us = F.col("_us") - F.lit(lookback_us)
    return grouped.select(
        "_probe.*",
        *[F.col(n) for n in [*collect.sums, *collect.distinct]],
        *[
            _time(F.when(F.col(f"_first_{n}") <= F.col("_us"), F.col(f"_first_{n}"))).alias(f"first_{n}")
            for n in collect.edges
        ],
        *[
            _time(F.when(F.col(f"_last_{n}") >= start_us, F.col(f"_last_{n}"))).alias(f"last_{n}")
            for n in collect.edges
        ],
        *[
            F.when(F.size(n) == 0, F.lit(empty_list))
            .otherwise(F.array_join(F.array_sort(n), " / "))
            .alias(n)
            for n in collect.lists
        ],
    )


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp"))


def _time(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def _bucket_start(bucket_us: int) -> Column:
    return F.col("_us") - F.pmod(F.col("_us"), F.lit(bucket_us))


def _stretch_edges(touch: DataFrame, names: list[str], lookback_us: int) -> DataFrame:
    """Touches that open or close a stretch, per (key, dimension, value).

    With buckets as wide as the lookback, the touches of a value inside one bucket are closer
    than the lookback, so only the first and last of a bucket can be an edge. That leaves one
    row per (key, value, bucket) to order.
    """
    values = touch.select(
        "_key",
        "_us",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n).alias("_dim"), F.col(f"value_{n}").alias("_value"))
                    for n in names
                ]
            )
        ).alias("_dv"),
    ).select("_key", "_us", "_dv.*")
    per_bucket = (
        values.where(F.col("_value").isNotNull())
        .groupBy("_key", "_dim", "_value", _bucket_start(lookback_us).alias("_bucket"))
        .agg(F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
    )
    by_value = Window.partitionBy("_key", "_dim", "_value").orderBy("_bucket")
    before = F.col("_lo") - F.lag("_hi").over(by_value)
    after = F.lead("_lo").over(by_value) - F.col("_hi")
    return per_bucket.select(
        "_key",
        "_dim",
        "_value",
        "_bucket",
        "_lo",
        "_hi",
        (F.coalesce(before, F.lit(lookback_us + 1)) > lookback_us).alias("_opens"),
        (F.coalesce(after, F.lit(lookback_us + 1)) > lookback_us).alias("_closes"),
    )


def _bits(collect: Lookback) -> dict[str, int]:
    """Places in ``_flags`` of what a point of the time axis may be, named as the columns they stand for."""
    names = [f"at_{n}" for n in collect.edges] + [f"{way}_{n}" for n in collect.distinct for way in ("in", "out")]
    return {name: 1 << place for place, name in enumerate(names)}


def _points(
    touch: DataFrame, edges: DataFrame, asked: DataFrame, collect: Lookback, lookback_us: int
) -> DataFrame:
    """Everything that happens on a key's time axis, in reading order within one instant:
    range begins (-1), touches (0), probes (1).

    All points are sorted, so they stay narrow: what a point is stands in the bits of ``_flags``."""
    bits = _bits(collect)

    def flags(conditions: Mapping[str, Column]) -> Column:
        total = F.lit(0).cast("bigint")
        for name, condition in conditions.items():
            total = total + F.when(condition, F.lit(bits[name])).otherwise(F.lit(0))
        return total.alias("_flags")

    touched = touch.select(
        "_key",
        "_us",
        F.lit(0).alias("_side"),
        *[F.col(f"sum_{n}") for n in collect.sums],
        flags({f"at_{n}": F.col(f"edge_{n}") for n in collect.edges}),
    )
    # A value touched once in its bucket moves in and out at one point.
    alone = F.col("_lo") == F.col("_hi")
    arrival = F.struct(
        F.col("_lo").alias("_us"),
        F.col("_opens").alias("_in"),
        (alone & F.col("_closes")).alias("_out"),
    )
    departure = F.struct(
        F.col("_hi").alias("_us"), F.lit(False).alias("_in"), (~alone & F.col("_closes")).alias("_out")
    )
    moves = (
        edges.where(F.col("_dim").isin(list(collect.distinct)))
        .select("_key", "_dim", F.explode(F.array(arrival, departure)).alias("_m"))
        .select("_key", "_dim", "_m.*")
        .where(F.col("_in") | F.col("_out"))
    )
    moved = moves.select(
        "_key",
        "_us",
        F.lit(0).alias("_side"),
        flags(
            {f"{way}_{n}": F.col(f"_{way}") & (F.col("_dim") == n) for n in collect.distinct for way in ("in", "out")}
        ),
    )
    probed = asked.select(
        "_key",
        "_probe",
        F.explode(
            F.array(
                F.struct(F.col("_us").alias("_us"), F.lit(1).alias("_side")),
                F.struct((F.col("_us") - F.lit(lookback_us)).alias("_us"), F.lit(-1).alias("_side")),
            )
        ).alias("_p"),
    ).select("_key", "_probe", "_p.*")
    return touched.unionByName(moved, allowMissingColumns=True).unionByName(
        probed, allowMissingColumns=True
    )


def _readings(
    points: DataFrame, collect: Lookback, busy: DataFrame, bucket_us: int
) -> DataFrame:
    """Prefix sums, prefix maxima and suffix minima at the probe points.

    Windows run inside (key, bucket). What lies outside of a bucket is added to the readings afterwards,
    so that the sorted points do not carry it.
    """
    marked = {name: F.col("_flags").bitwiseAND(F.lit(bit)) != 0 for name, bit in _bits(collect).items()}
    at = {n: F.when(marked[f"at_{n}"], F.col("_us")) for n in collect.edges}
    summed = {
        **{f"run_{n}": F.col(f"sum_{n}") for n in collect.sums},
        **{f"opened_{n}": F.when(marked[f"in_{n}"], 1).otherwise(0) for n in collect.distinct},
        **{f"closed_{n}": F.when(marked[f"out_{n}"], 1).otherwise(0) for n in collect.distinct},
    }
    cut = with_bucket(points, ["_key"], _bucket_start(bucket_us), busy)
    per_bucket = cut.where(F.col("_bucket").isNotNull()).groupBy("_key", "_bucket").agg(
        *[F.coalesce(F.sum(value), F.lit(0)).alias(f"_t_{name}") for name, value in summed.items()],
        *[F.max(at[n]).alias(f"_hi_{n}") for n in collect.edges],
        *[F.min(at[n]).alias(f"_lo_{n}") for n in collect.edges],
    )
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    later = (
        Window.partitionBy("_key").orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = per_bucket.select(
        "_key",
        "_bucket",
        *[F.sum(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n in summed],
        *[F.max(f"_hi_{n}").over(earlier).alias(f"_c_last_{n}") for n in collect.edges],
        *[F.min(f"_lo_{n}").over(later).alias(f"_c_next_{n}") for n in collect.edges],
    )
    inside = Window.partitionBy("_key", "_bucket")
    forward = inside.orderBy("_us", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    backward = inside.orderBy(F.desc("_us"), F.desc("_side")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # Dealt by bucket here, or all buckets of a busy key would stay where its marks were looked up.
    read = (
        cut.repartition("_key", "_bucket")
        .withColumns({f"next_{n}": F.min(at[n]).over(backward) for n in collect.edges})
        .withColumns(
            {
                **{n: F.sum(value).over(forward) for n, value in summed.items()},
                **{f"last_{n}": F.max(at[n]).over(forward) for n in collect.edges},
            }
        )
        .where(F.col("_side") != 0)
    )
    return read.join(carried, ["_key", "_bucket"], "left").select(
        "_probe",
        "_us",
        "_side",
        *[(F.coalesce(F.col(f"_c_{n}"), F.lit(0)) + F.coalesce(n, F.lit(0))).alias(n) for n in summed],
        *[F.greatest(f"_c_last_{n}", f"last_{n}").alias(f"last_{n}") for n in collect.edges],
        *[F.least(f"_c_next_{n}", f"next_{n}").alias(f"next_{n}") for n in collect.edges],
    )


def _listed(edges: DataFrame, asked: DataFrame, collect: Lookback, lookback_us: int) -> DataFrame:
    """One row per probe and listed value in range."""
    return (
        _near_stretches(edges, asked, collect, lookback_us)
        .where((F.col("_us") >= F.col("_from")) & (F.col("_us") <= F.col("_to")))
        .select("_probe", F.lit(0).alias("_side"), F.col("_dim").alias("_list"), "_value")
    )


def _near_stretches(edges: DataFrame, asked: DataFrame, collect: Lookback, lookback_us: int) -> DataFrame:
    """Probes with the stretches of listed values that share a cell of the interval index with them."""
    by_value = Window.partitionBy("_key", "_dim", "_value")
    numbered = edges.where(F.col("_dim").isin(list(collect.lists))).withColumn(
        "_stretch", F.sum(F.col("_opens").cast("int")).over(by_value.orderBy("_bucket"))
    )
    stretches = numbered.groupBy("_key", "_dim", "_value", "_stretch").agg(
        F.min("_lo").alias("_from"), (F.max("_hi") + F.lit(lookback_us)).alias("_to")
    )
    # A stretch is at least as long as the lookback. At its level it is five to nine cells long and reaches
    # into one more at either end, so a probe meets few stretches but those that it is in.
    width = F.lit(max(lookback_us // CELLS, 1)) * F.pow(F.lit(2.0), F.col("_level")).cast("bigint")
    level = F.greatest(F.ceil(F.log2((F.col("_to") - F.col("_from")) / F.lit(float(max(lookback_us, 1))))), F.lit(0))
    indexed = (
        stretches.withColumn("_level", level.cast("int"))
        .withColumn("_cell", F.explode(F.sequence(_cell(F.col("_from"), width), _cell(F.col("_to"), width))))
    )
    levels = stretches.groupBy("_key").agg(F.collect_set(level.cast("int")).alias("_levels"))  # at most 64
    looked_up = (
        asked.join(levels, "_key")
        .withColumn("_level", F.explode("_levels"))
        .select("_probe", "_key", "_us", "_level", _cell(F.col("_us"), width).alias("_cell"))
    )
    return looked_up.join(indexed, ["_key", "_level", "_cell"])


def _cell(us: Column, width: Column) -> Column:
    """Number of the cell of a time axis that begins with the epoch; earlier times have negative numbers."""
    return F.call_function("div", us - F.pmod(us, width), width)
