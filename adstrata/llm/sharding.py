"""Sharding by sampled splitters: shards of near equal bytes.

A sample drawn in proportion to size gives splitters at its quantiles, which cut the keys into many
more ranges than shards. Ranges that turn out overfull in bytes or in records, because one key holds
much, are subdivided by a digest of the record, as are all ranges of a table with very many records. Running sizes inside each piece and the exact totals of the pieces before it
place every record on one line of bytes; a shard is an equal stretch of that line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstrata.llm.frames import stored, without

RANGES_PER_SHARD = 8
# Sampled keys for each range; the driver holds RANGES_PER_SHARD * SAMPLES_PER_RANGE a shard.
SAMPLES_PER_RANGE = 12
# A range above this many times the mean is subdivided.
OVERFULL = 2
# Records that one task should order at most.
PIECE_ROWS = 1_000_000

TEMPORARY = ["_size", "_key", "_record", "_range", "_piece", "_before", "_total", "_pieces", "_upto", "_row", "_rows_before"]


def _splitters(rows: DataFrame, n_ranges: int, seed: int) -> list[int]:
    """Quantile keys of a sample in which a record's chance follows its size."""
    draw = F.xxhash64("_record", "_key", F.lit(seed)).bitwiseAND((1 << 53) - 1)
    chance = (draw + 1) / F.lit(float(1 << 53))
    order = -F.log(chance) / F.col("_size")
    drawn = rows.filter("_size > 0").select("_key", order.alias("_order"))
    sample = drawn.orderBy("_order", "_key").limit(n_ranges * SAMPLES_PER_RANGE).select("_key")
    keys = sorted(row[0] for row in sample.collect())
    cuts = [keys[len(keys) * i // n_ranges] for i in range(1, n_ranges)] if keys else []
    return sorted(set(cuts))


def _range_of(key: Column, cuts: list[int]) -> Column:
    """Number of splitters at or below the key, by halving."""
    if not cuts:
        return F.lit(0)
    middle = len(cuts) // 2
    return F.when(key < cuts[middle], _range_of(key, cuts[:middle])).otherwise(
        _range_of(key, cuts[middle + 1 :]) + (middle + 1)
    )


def assign_shards(
    df: DataFrame, n_shards: int, size: Column, key: Column, record: Column, seed: int = 0
) -> DataFrame:
    """Add ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0 within a shard).

    ``size`` is what is to be shared out evenly; null or negative counts as 0. ``key`` is hashed to
    order records, equal keys lying together as long as they fill no range; ``record`` tells records
    of one key apart. Nulls are values like others. Shards differ from the mean by less than one
    record, so a record larger than a shard leaves others empty. Rows that are equal in key, record
    and size are interchangeable. An empty table stays empty; columns called ``shard`` or ``slot``
    are replaced. ``df`` is written to the shared folder twice, so it should carry what identifies
    a record and not its content.
    """
    kept = without(df, ["shard", "slot", *TEMPORARY])
    rows = df.select(
        *kept,
        F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("_size"),
        F.xxhash64(key).alias("_key"),
        F.xxhash64(record).alias("_record"),
    )
    rows = stored(rows, "shard-records")
    n_ranges = n_shards * RANGES_PER_SHARD
    rows = rows.withColumn("_range", _range_of(F.col("_key"), _splitters(rows, n_ranges, seed)))

    totals = rows.groupBy("_range").agg(F.sum("_size").alias("_total"), F.count("*").alias("_n"))

    def times(column: str) -> Column:
        """How many pieces a range needs for its share of the column."""
        mean = F.sum(column).over(Window.partitionBy()) / n_ranges
        return F.when(F.col(column) > OVERFULL * mean, F.ceil(F.col(column) / mean)).otherwise(1)

    pieces = F.greatest(times("_total"), times("_n"), F.ceil(F.col("_n") / PIECE_ROWS))
    # As many rows as ranges.
    overfull = totals.select("_range", pieces.cast("long").alias("_pieces")).filter("_pieces > 1")
    number = F.pmod(F.xxhash64("_record", "_key", F.lit(~seed)), F.col("_pieces"))
    rows = (
        rows.join(F.broadcast(overfull), "_range", "left")
        .withColumn("_piece", F.when(F.col("_pieces") > 1, number).otherwise(0))
        .drop("_pieces")
    )

    # At most a few times as many rows as ranges.
    in_order = Window.orderBy("_range", "_piece")
    filled = rows.groupBy("_range", "_piece").agg(F.sum("_size").alias("_total"))
    placed = filled.select(
        "_range",
        "_piece",
        (F.sum("_total").over(in_order) - F.col("_total")).alias("_before"),
        F.sum("_total").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_range", "_piece").orderBy("_key", "_record", "_size")
    running = F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    twice_middle = (F.col("_before") + F.col("_upto")) * 2 - F.col("_size")
    exact = "decimal(38,0)"
    shard = F.floor(twice_middle.cast(exact) * n_shards / (F.col("_total") * 2).cast(exact))
    sharded = (
        rows.withColumn("_upto", running)
        .join(F.broadcast(placed), ["_range", "_piece"])
        .withColumn("shard", F.least(F.coalesce(shard.cast("int"), F.lit(0)), F.lit(n_shards - 1)))
    )
    sharded = stored(sharded.select(*kept, "_range", "_piece", "_key", "_record", "_size", "_upto", "shard"), "shard-of")

    held = sharded.groupBy("shard", "_range", "_piece").agg(F.count("*").alias("_row"))
    in_shard = Window.partitionBy("shard").orderBy("_range", "_piece")
    earlier = held.select(
        "shard", "_range", "_piece", (F.sum("_row").over(in_shard) - F.col("_row")).alias("_rows_before")
    )
    in_piece = Window.partitionBy("_range", "_piece", "shard").orderBy("_upto", "_key", "_record")
    return (
        sharded.withColumn("_row", F.row_number().over(in_piece))
        .join(F.broadcast(earlier), ["shard", "_range", "_piece"])
        .select(*kept, "shard", (F.col("_rows_before") + F.col("_row") - 1).cast("long").alias("slot"))
    )


def write_shards(df: DataFrame, path: str) -> None:
    """Write rows with ``shard`` and ``slot`` as one folder a shard, files in slot order."""
    parts = df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    parts.write.partitionBy("shard").parquet(path)
