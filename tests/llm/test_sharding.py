"""Shards: near equal bytes, gapless slots, hot keys, odd rows."""

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from adstrata.llm import queries, sharding


def check(rows, n_shards, sizes):
    by_shard = defaultdict(list)
    for row in rows:
        by_shard[row.shard].append(row.slot)
    assert all(0 <= s < n_shards for s in by_shard)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    bytes_of = defaultdict(int)
    for row in rows:
        bytes_of[row.shard] += row.size
    mean = sum(sizes) / n_shards
    assert all(abs(bytes_of[s] - mean) <= 2 * max(sizes) for s in range(n_shards))


@pytest.mark.parametrize("hot", [0, 700])
def test_equal_bytes(spark, hot):
    rows = [(i, 7 if i < hot else i, (i * 37) % 101 + 1) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, k long, size long").repartition(4)
    found = sharding.assign_shards(df, 5, F.col("size"), F.col("k"), F.col("doc_id")).collect()
    assert sorted(r.doc_id for r in found) == list(range(1500))
    check(found, 5, [r[2] for r in rows])


def test_nulls_repeated_rows_and_clashing_columns(spark):
    rows = [(None, None, None, "x", "y", "z")] * 3 + [(1, 1, 5, "x", "y", "z")] * 200 + [(2, None, -4, "x", "y", "z")]
    df = spark.createDataFrame(rows, "doc_id long, k long, size long, SHARD string, slot string, _range string")
    found = sharding.assign_shards(df, 4, F.col("size"), F.col("k"), F.col("doc_id"))
    assert found.columns == ["doc_id", "k", "size", "shard", "slot"]
    assert found.count() == len(rows)
    by_shard = found.groupBy("shard").agg(F.collect_set("slot").alias("s"), F.count("*").alias("n"), F.max("slot").alias("m"))
    assert all(len(r.s) == r.n == r.m + 1 for r in by_shard.collect())


def test_a_third_without_text_is_spread(spark, monkeypatch):
    """Small records of one key are split by their number, though they hold few bytes."""
    rows = [(i, None if i < 1_000 else i, 8 if i < 1_000 else 3_000) for i in range(3_000)]
    df = spark.createDataFrame(rows, "doc_id long, k long, size long").repartition(4)
    tables = {}
    plain = sharding.stored
    monkeypatch.setattr(sharding, "stored", lambda df, name: tables.setdefault(name, plain(df, name)))
    found = sharding.assign_shards(df, 5, F.col("size"), F.col("k"), F.col("doc_id")).collect()
    check(found, 5, [r[2] for r in rows])
    pieces = tables["shard-of"].groupBy("_range", "_piece").count().agg(F.max("count"))
    assert pieces.first()[0] <= 2.5 * sharding.OVERFULL * 3_000 / (5 * sharding.RANGES_PER_SHARD)


def test_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, k long, size long")
    assert sharding.assign_shards(df, 4, F.col("size"), F.col("k"), F.col("doc_id")).collect() == []


def test_written_shards(spark, tmp_path):
    rows = [(i, i % 3, i % 7) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, shard int, slot int")
    sharding.write_shards(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["shard=0", "shard=1", "shard=2"]


def test_query(spark, folder):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op2_shards(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for row in rows:
        raw = docs[row.doc_id].encode()
        assert (row.size, row.text_crc32, row.law, row.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
    check(rows, queries.SHARDS, [r.size for r in rows])
