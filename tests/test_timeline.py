"""Ordered computations against brute force, with busy and ordinary keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adstrata.operators import timeline
from adstrata.operators.timeline import (
    DAY_US,
    HOUR_US,
    Lookback,
    busy_keys,
    lookback_rollup,
    order_by_ranges,
)
from adstrata.session import RUNTIME_CONF

START = datetime(2024, 1, 1)
TOUCH_SCHEMA = "user string, at timestamp_ntz, id string, kind string, campaign string, cost double"


def make_touches(seed, n=600, hot=0.4):
    """Random touches on a coarse grid of times (so that ties occur), one user holding ``hot``."""
    rng = random.Random(seed)
    touches = []
    for _ in range(n):
        user = "hot" if rng.random() < hot else f"u{rng.randrange(12)}"
        touches.append(
            (
                None if rng.random() < 0.03 else user,
                START + timedelta(minutes=30 * rng.randrange(48 * 40)),
                f"id{rng.randrange(int(n * 0.8))}",
                rng.choice(["impression", "click"]),
                rng.choice([None, "a", "b", "c", "d"]),
                rng.randrange(1000) / 100,
            )
        )
    return touches


def make_probes(seed, n=150):
    rng = random.Random(seed + 1)
    return [
        (
            f"p{i}",
            rng.choice([None, "hot", "hot", "nobody", *[f"u{k}" for k in range(12)]]),
            START + timedelta(minutes=30 * rng.randrange(48 * 45)),
        )
        for i in range(n)
    ]


def brute_force(probes, touches, days):
    expected = {}
    for probe, user, at in probes:
        seen = [
            t
            for t in touches
            if user is not None and t[0] == user and at - timedelta(days=days) <= t[1] <= at
        ]
        impressions = [t for t in seen if t[3] == "impression"]
        expected[probe] = (
            round(sum(t[5] for t in seen), 2),
            len({t[2] for t in impressions}),
            len({t[4] for t in seen if t[4] is not None}),
            min((t[1] for t in impressions), default=None),
            max((t[1] for t in impressions), default=None),
            " / ".join(sorted({t[3] for t in seen})) or "Unknown",
        )
    return expected


@pytest.mark.parametrize("busy_users", [[], ["hot"], ["hot", *[f"u{k}" for k in range(12)]]])
@pytest.mark.parametrize("days", [1, 5, 60])
def test_lookback_equals_all_pairs(spark, busy_users, days):
    touches, probes = make_touches(days), make_probes(days)
    impression = F.col("kind") == "impression"
    result = lookback_rollup(
        spark.createDataFrame(probes, "probe string, user string, probe_at timestamp_ntz"),
        spark.createDataFrame(touches, TOUCH_SCHEMA),
        key="user",
        probe_at="probe_at",
        touch_at="at",
        collect=Lookback(
            sums={"cost": F.col("cost")},
            distinct={"impressions": F.when(impression, F.col("id")), "campaigns": F.col("campaign")},
            edges={"impression": impression},
            lists={"kinds": F.col("kind")},
        ),
        lookback_us=days * DAY_US,
        busy=spark.createDataFrame([(u,) for u in busy_users], "user string"),
        bucket_us=HOUR_US,
    )
    found = {
        row.probe: (
            round(row.cost, 2),
            row.impressions,
            row.campaigns,
            row.first_impression,
            row.last_impression,
            row.kinds,
        )
        for row in result.collect()
    }
    assert found == brute_force(probes, touches, days)


@pytest.mark.parametrize("ranges", [None, 1, 3, 40])
def test_order_by_ranges(spark, ranges):
    """A busy user, half of whose rows have no time; ranges cut users at any place."""
    touches = [t for t in make_touches(5, hot=0.5) if t[0] is not None]
    touches = [(*t[:1], None if t[0] == "hot" and k % 2 else t[1], *t[2:]) for k, t in enumerate(touches)]
    touches = list({(t[0], t[1], t[2]): t for t in touches}.values())
    df = spark.createDataFrame([*touches, (None, START, "lost", "click", "a", 1.0)], TOUCH_SCHEMA).repartition(3)
    result = order_by_ranges(
        df,
        ["user"],
        [F.col("at").asc_nulls_last(), F.col("id")],
        sequence="seq",
        totals={"touches": F.count("id"), "spent": F.sum(F.col("cost").cast("decimal(10,2)"))},
        running={"clicks": (F.col("kind") == "click").cast("bigint")},
        ranges=ranges,
    )
    assert result.columns == [*df.columns, "touches", "spent", "seq", "clicks"]
    found = {(r.user, r.at, r.id): (r.seq, r.touches, r.clicks, float(r.spent)) for r in result.collect()}
    expected = {}
    for user in {t[0] for t in touches}:
        own = sorted((t for t in touches if t[0] == user), key=lambda t: (t[1] is None, t[1] or START, t[2]))
        spent = round(sum(t[5] for t in own), 2)
        clicks = 0
        for position, t in enumerate(own, 1):
            clicks += t[3] == "click"
            expected[t[0], t[1], t[2]] = (position, len(own), clicks, spent)
    assert found == expected


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_later_totals_see_places(spark, ranges):
    """Aggregates over sequence, totals and running sums of a key, wherever ranges cut it."""
    rng = random.Random(7)
    data = [(rng.choice(["hot", "hot", "a", "b", "c", "lone", None]), n, rng.randrange(5)) for n in range(300)]
    data.append(("nothing", 0, None))
    df = spark.createDataFrame(data, "k string, id int, v int").repartition(3)
    result = order_by_ranges(
        df,
        ["k"],
        [F.col("id")],
        sequence="seq",
        totals={"n": F.count("v")},
        running={"so_far": F.col("v")},
        later={
            "ends": F.sum(F.when(F.col("seq").isin(1) | (F.col("seq") == F.col("n")), F.col("v"))),
            "area": F.sum("so_far"),
        },
        ranges=ranges,
    )
    assert result.columns == ["k", "id", "v", "n", "seq", "so_far", "ends", "area"]
    found = {(r.k, r.id): (r.n, r.ends, r.area) for r in result.collect()}
    expected = {}
    for key in {k for k, _, _ in data if k is not None}:
        own = sorted((n, v) for k, n, v in data if k == key)
        values = [v for _, v in own if v is not None]
        ends = [v for p, (_, v) in enumerate(own, 1) if v is not None and p in (1, len(values))]
        area = sum(sum(values[: p + 1]) for p in range(len(values)))
        for n, _ in own:
            expected[key, n] = (len(values), sum(ends) if ends else None, area)
    assert found == expected


def test_ranges_split_a_busy_key_evenly(spark):
    """The windows of one key with equal times are spread over the ranges."""
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id", "timestamp'2024-01-01' as at")
    result = order_by_ranges(df, ["k"], [F.col("at"), F.col("id")], sequence="n", ranges=16)
    assert result.where("k = 'hot'").agg(F.max("n")).head()[0] == 6667
    sizes = result.select(F.spark_partition_id().alias("p")).groupBy("p").count()
    placed = df.repartitionByRange(16, "k", "at", "id").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert placed.max() <= 2 * placed.median()
    assert sizes.count() > 0


def test_listed_values_join_few_stretches(spark):
    """A busy user with many stretches: probes meet those they are in, times the levels of the index."""
    from adstrata.operators import timeline

    day = DAY_US
    stretches = [("hot", "kinds", f"v{k}", 3 * d * day + k * HOUR_US) for d in range(100) for k in range(5)]
    edges = spark.createDataFrame(stretches, "_key string, _dim string, _value string, _lo long").selectExpr(
        "*", "_lo as _hi", "_lo as _bucket", "true as _opens", "true as _closes"
    )
    asked = spark.range(400).selectExpr("cast(id as string) as _probe", "'hot' as _key", f"id * 18 * {HOUR_US} as _us")
    collect = Lookback(sums={}, distinct={}, edges={}, lists={"kinds": F.lit("")})
    found = timeline._listed(edges, asked, collect, day)
    expected = {
        (str(p), value) for p in range(400) for _, _, value, at in stretches if at <= p * 18 * HOUR_US <= at + day
    }
    assert {(r["_probe"], r["_value"]) for r in found.collect()} == expected
    near = timeline._near_stretches(edges, asked, collect, day)
    assert len(expected) <= near.count() <= 1.5 * len(expected)


def test_busy_keys_are_few(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert [r.k for r in busy_keys(df, ["k"], min_rows=10).collect()] == ["hot"]
    assert busy_keys(df, ["k"]).count() == 0


def test_sorted_points_are_narrow(spark):
    """All points are sorted twice: whatever is collected, they hold one column of flags and one for each sum."""
    touches = spark.createDataFrame(make_touches(5, n=50), TOUCH_SCHEMA)
    touch = touches.select(
        F.col("user").alias("_key"),
        F.unix_micros(F.col("at").cast("timestamp")).alias("_us"),
        F.lit(1).alias("sum_cost"),
        *[F.col("campaign").alias(f"value_{n}") for n in ("a", "b", "c")],
        (F.col("kind") == "click").alias("edge_click"),
    )
    collect = Lookback(sums={"cost": F.lit(1)}, distinct=dict.fromkeys("abc"), edges={"click": None}, lists={})
    edges = timeline._stretch_edges(touch, ["a", "b", "c"], DAY_US)
    asked = touch.select(F.struct("_key", "_us").alias("_probe"), "_key", "_us")
    points = timeline._points(touch, edges, asked, collect, DAY_US)
    assert sorted(points.columns) == ["_flags", "_key", "_probe", "_side", "_us", "sum_cost"]


def test_tasks_read_bounded_partitions():
    assert RUNTIME_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "16m"
