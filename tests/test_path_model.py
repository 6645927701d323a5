"""The incremental path model against the full one: late conversions, lost and repeated runs, days left alone."""

from datetime import timedelta

from pyspark.sql import functions as F
from test_paths_and_campaigns import AT, EVENTS, campaigns, event  # noqa: F401

from adstrata.operators import paths
from adstrata.plans import path_model

LOOKBACK = 5


def day(n):
    return AT + timedelta(days=n)


def once(event_id, at, **changes):
    return event(event_id, "conversion", at, conversion_count_type="once", **{"conversion_tracker_id": "t", "order_id": "o", **changes})


FIRST = [
    event("i1", "impression", day(38)),
    once("early", day(40)),
    event("i2", "impression", day(78), user="v"),
    event("c2", "conversion", day(80), user="v", conversion_tracker_id=None),
    once("n1", day(80), user="v", conversion_tracker_id=None, order_id=None),
    event("gone", "conversion", None),
]
SECOND = [
    event("i0", "impression", day(-3)),
    once("late", day(0)),
    once("later", day(1)),
    event("k1", "click", day(-3), user="v"),
    event("c3", "conversion", day(2), user="v"),
]


def add(spark, folder, events):
    rows = spark.createDataFrame(events, EVENTS).withColumn("event_date", F.to_date("event_at")).where("event_date is not null")
    rows.write.mode("append").partitionBy("event_date").parquet(folder)
    return [row[0] for row in rows.select("event_date").distinct().collect()]


def test_runs_give_the_full_model(spark, tmp_path, rows, campaigns):  # noqa: F811
    root, folder = str(tmp_path / "model"), str(tmp_path / "log")
    log = spark.read.schema(EVENTS + ", event_date date")

    def model():
        return rows(path_model.read_paths(spark, root).select(full.columns))

    changed = add(spark, folder, FIRST)
    full = paths.conversion_paths(spark.createDataFrame(FIRST, EVENTS), campaigns, LOOKBACK)
    path_model.update(log.parquet(folder), campaigns, root, "r1", changed, LOOKBACK)
    assert model() == rows(full)
    assert path_model.update(log.parquet(folder), campaigns, root, "r1b", [], LOOKBACK) == []

    # A day that is far from every change is neither read nor written again.
    far = f"{day(80):%Y-%m-%d}"
    kept = sorted(p.name for p in (tmp_path / "model" / "paths" / f"conversion_date={far}").iterdir())
    (tmp_path / "log" / f"event_date={far}" / "part-broken.parquet").write_text("not a table")
    changed = add(spark, folder, SECOND)
    days = path_model.update(log.parquet(folder), campaigns, root, "r2", changed, LOOKBACK)
    assert day(40).date() in days and day(80).date() not in days
    full = paths.conversion_paths(spark.createDataFrame(FIRST + SECOND, EVENTS), campaigns, LOOKBACK)
    expected = rows(full)
    assert model() == expected
    assert "early" not in {r[0] for r in rows(path_model.read_paths(spark, root), "conversion_event_id")}
    assert kept == sorted(p.name for p in (tmp_path / "model" / "paths" / f"conversion_date={far}").iterdir())

    # The same run again, and again after it was lost before its end.
    path_model.update(log.parquet(folder), campaigns, root, "r2", changed, LOOKBACK)
    assert model() == expected
    (tmp_path / "model" / "firsts" / "r2" / "_SUCCESS").unlink()
    assert day(40).date() in path_model.update(log.parquet(folder), campaigns, root, "r2", changed, LOOKBACK)
    assert model() == expected
