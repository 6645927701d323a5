"""Key-based building blocks: picks, duplicates, unmatched rows, lookups, unions.

A key may hold a large share of all rows, so picks and counts are aggregates (they combine
map-side) instead of windows, which would bring a whole key into one task. Row-level joins
are plain equi joins without a forced strategy: Spark broadcasts a side only below its size
threshold, and adaptive execution splits hot partitions of a sort-merge join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.functions.scalars import ColumnLike, as_column


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = False
) -> DataFrame:
    """One row per key: the first in ``order`` (nulls last), ties broken by the other columns.

    Null keys form a group of their own.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    if descending:
        ranked = [F.col(name).isNotNull() for name in order]
    else:
        ranked = [F.col(name).isNull() for name in order]
    sort_key = [
        column.alias(alias)
        for position, name in enumerate(order)
        for column, alias in ((ranked[position], f"_absent_{name}"), (F.col(name), name))
    ]
    row = F.struct(*sort_key, *[F.col(name) for name in rest])
    pick = F.max(row) if descending else F.min(row)
    picked = df.groupBy(*keys).agg(pick.alias("_row"))
    return picked.select(
        *[
            F.col(name) if name in keys else F.col(f"_row.{name}").alias(name)
            for name in df.columns
        ]
    )


def hash_rank(seed: int, *columns: ColumnLike) -> Column:
    """Repeatable pseudo-random order: a digest of the seed and the values.

    Unlike ``rand(seed)`` it does not depend on how rows are partitioned.
    """
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[as_column(c).cast("string") for c in columns]))


def hash_pick(df: DataFrame, key: str, candidate: str, seed: int = 42) -> DataFrame:
    """One candidate per key, chosen by digest order. Returns ``(key, candidate)``."""
    rank = F.struct(hash_rank(seed, key, candidate).alias("digest"), F.col(candidate).alias("pick"))
    return (
        df.groupBy(key)
        .agg(F.min(rank).alias("_choice"))
        .select(key, F.col("_choice.pick").alias(candidate))
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with ``copies``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def flag_repeated(df: DataFrame, keys: Sequence[str], flag: str = "is_repeated") -> DataFrame:
    """Mark every member of a repeated key; null key values count as equal."""
    repeated = repeated_keys(df, keys).select(
        *[F.col(name).alias(f"_k_{name}") for name in keys], F.lit(True).alias("_hit")
    )
    same = reduce(
        lambda left, right: left & right,
        [F.col(name).eqNullSafe(F.col(f"_k_{name}")) for name in keys],
    )
    return (
        df.join(repeated, same, "left")
        .withColumn(flag, F.col("_hit").isNotNull())
        .drop("_hit", *[f"_k_{name}" for name in keys])
    )


def unmatched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a partner."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def matched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a partner, each once."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def spread_null_key(column: ColumnLike, spread_by: ColumnLike, buckets: int = 1024) -> Column:
    """Replace an empty join key by one of many keys that match nothing.

    Rows without a key cannot match; left as null they would all land in one partition of
    an outer join.
    """
    column = as_column(column)
    filler = F.concat(
        F.lit("\u0000"), F.pmod(F.xxhash64(as_column(spread_by)), F.lit(buckets)).cast("string")
    )
    return F.when(column.isNull() | (column == ""), filler).otherwise(column)


def heavy_keys(df: DataFrame, columns: Sequence[str], share: float = 0.001, pieces: int = 32) -> dict[str, DataFrame]:
    """Keys that hold at least ``share`` of all rows, for each column, with the ``salts`` to deal them over.

    One pass over the columns alone: each task sketches its frequent values, the sketches are merged.
    A key gets ``pieces`` salts for each mean task that its rows would fill. At most 1 / ``share`` keys a column
    come to the driver; blank keys do not count. A count that the sketch has slightly wrong changes the
    balance of a join, never its result.
    """
    most = int(1 / share)
    own = {f"k{n}": F.col(c).cast("string") for n, c in enumerate(columns)}
    if not own:
        return {}
    row = df.select(*[value.alias(k) for k, value in own.items()]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"approx_top_k({k}, {most}, {10 * most}) filter (where {k} <> '')").alias(k) for k in own],
    ).first()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = {}
    for k, column in zip(own, columns, strict=True):
        heavy = [
            (item, math.ceil(pieces * tasks * count / row.n))
            for item, count in row[k] or []
            if count >= share * row.n
        ]
        if heavy:
            found[column] = df.sparkSession.createDataFrame(heavy, "_heavy string, _salts int")
    return found


def _salted(df: DataFrame, lookup: DataFrame, own: Column, key: str, heavy: DataFrame | None, spread_by: ColumnLike) -> DataFrame:
    """Left join of ``own`` with the column ``key``; rows of heavy keys are dealt over copies of their lookup rows."""
    if heavy is None:
        return df.join(lookup, own == F.col(key), "left").drop(key)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    # The table of heavy keys is bounded by the share that makes a key heavy.
    dealt = df.withColumn("_own", own).join(F.broadcast(heavy), F.col("_own") == F.col("_heavy"), "left")
    dealt = dealt.withColumn("_salt", F.pmod(F.xxhash64(as_column(spread_by)), salts).cast("int")).drop("_heavy", "_salts")
    copies = lookup.join(F.broadcast(heavy), F.col(key) == F.col("_heavy"), "left")
    copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_heavy", "_salts")
    same = (F.col("_own") == F.col(key)) & (F.col("_salt") == F.col("_copy"))
    return dealt.join(copies, same, "left").drop(key, "_own", "_salt", "_copy")


def left_wins_join(
    df: DataFrame,
    lookup: DataFrame,
    left_key: str,
    right_key: str | None = None,
    spread_by: ColumnLike | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Left join on the text form of a key; columns both sides have come from the left.

    The lookup keeps its key column when that has another name. Rows without a key match nothing;
    with ``spread_by``, a column that differs among them, a shuffled join does not gather them in
    one task. ``heavy``, one of ``heavy_keys``, does the same for rows of frequent keys.
    """
    right_key = right_key or left_key
    key = "_lookup_key"
    extra = [name for name in lookup.columns if name not in df.columns]
    side = lookup.select(F.col(right_key).cast("string").alias(key), *extra)
    own = F.col(left_key).cast("string")
    if spread_by is not None:
        own = spread_null_key(own, spread_by)
    if heavy is not None and spread_by is None:
        spread_by = F.struct(*df.columns)
    return _salted(df, side, own, key, heavy, spread_by)


def only_known(
    df: DataFrame, column: str, known: DataFrame, known_column: str, other: str = "", heavy: DataFrame | None = None
) -> DataFrame:
    """Keep a value only where it occurs in ``known``; everything else becomes ``other``.

    Rows whose value is null or empty cannot be known. They are spread over the tasks of the join by all
    that they hold instead of meeting in one, and so are rows of the ``heavy`` keys.
    """
    whole = F.struct(*df.columns)
    own = spread_null_key(F.col(column).cast("string"), whole)
    ids = known.select(F.col(known_column).cast("string").alias("_id")).distinct().withColumn("_known", F.lit(True))
    kept = F.when(F.col("_known"), F.col(column).cast("string")).otherwise(F.lit(other))
    return _salted(df, ids, own, "_id", heavy, whole).withColumn(column, kept).drop("_known")


def tagged_union(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Stack frames, each marked with its name; columns one of them lacks become null."""
    if not frames:
        raise ValueError("at least one frame is needed")
    marked = [frame.withColumn(tag, F.lit(name)) for name, frame in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def distinct_values(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct non-blank values over several columns as one column, in one pass."""
    return (
        df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(name))
        .where(F.col(name).isNotNull() & (F.col(name) != ""))
        .distinct()
    )


def top_rows(df: DataFrame, metric: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest metric, ties in the order of further columns."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *ties).limit(n)
