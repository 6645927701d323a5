import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from adstrata import session
from adstrata.functions import privacy, times
from adstrata.functions.log_columns import METRICS
from adstrata.operators import keys
from adstrata.operators import logextract as lx
from adstrata.plans import delivery
from adstrata.sources import readers, writers


def test_columns_dimensions_first():
    available = ["cost", "campaign_id", "has_won", "device_type"]
    dims, mets = lx.known_columns(["cost", "request_date", "campaign_id", "nope", "has_won"], available)
    assert dims == ["request_date", "campaign_id"] and mets == ["cost", "has_won"]
    assert lx.lowest_level(["campaign_id", "advertiser_id", "x"]) == "campaign_id"
    assert lx.lowest_level(["x"]) is None
    assert len(METRICS) == len(set(METRICS)) == 151


def test_renames(spark):
    assert lx.parse_renames(" a:b , bad, c : d:e ,") == {"a": "b", "c": "d:e"}
    assert lx.parse_renames("") == {}
    renamed = lx.apply_renames(spark.range(1).withColumn("v", F.lit(1)), "id:key,absent:x")
    assert renamed.columns == ["key", "v"]


EVENTS = """
request_time timestamp_ntz, advertiser_id int, campaign_id int, nativead_id int, cost string, has_won int,
has_click int, has_conv int, deal_id string, country string, has_consent boolean, ip_address string
"""


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [
            (datetime(2024, 3, 10, 4, 59, 59), 1, 10, 100, "1", 1, 0, 0, "d1", "US", True, "ip"),
            (datetime(2024, 3, 10, 5), 1, 10, 100, "2500000", 1, 0, 0, "d1", "US", True, "ip"),
            (datetime(2024, 3, 10, 12), 1, 11, 101, "x", 0, 1, 0, "d2", "FR", False, "ip"),
            (datetime(2024, 3, 11, 3, 59), 2, 10, 100, None, 0, 0, 0, None, None, None, "ip"),
            (datetime(2024, 3, 11, 4), 1, 10, 100, "3", 0, 0, 1, "d3", "US", True, "ip"),
        ],
        EVENTS,
    )


def request(**changes):
    settings = {"columns": ["request_time", "cost"], "start": "2024-03-10", "end": "2024-03-11", "zone": "America/New_York"}
    return lx.LogRequest(**{**settings, **changes})


def test_local_day_across_a_clock_change(events, rows):
    """10 March 2024 has 23 hours in New York."""
    pulled = lx.pull(events, request())
    assert rows(pulled, "request_time", "cost") == [
        (datetime(2024, 3, 10, 0, 0), 2500000.0),
        (datetime(2024, 3, 10, 8, 0), 0.0),
        (datetime(2024, 3, 10, 23, 59), 0.0),
    ]


def test_levels_and_event_filter(events, rows):
    columns = ["campaign_id"]
    assert rows(lx.pull(events, request(columns=columns, level="campaign_id", ids=[11])), "campaign_id") == [(11,)]
    # An unknown level filters advertisers.
    assert len(rows(lx.pull(events, request(columns=columns, level="account", ids=[2])))) == 1
    assert len(rows(lx.pull(events, request(columns=columns, events_only=True)))) == 2


def test_filters_reach_the_scan(spark, events, tmp_path):
    path = str(tmp_path / "log")
    events.write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = lx.pull(spark.read.parquet(path), request(columns=["cost"], level="campaign_id", ids=[10]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "In(campaign_id" in text or "EqualTo(campaign_id" in text
    assert "GreaterThanOrEqual(request_time" in text and "LessThan(request_time" in text
    assert "ReadSchema: struct<request_time:timestamp_ntz,campaign_id:int,cost:string>" in text


def test_report_names_and_left_side_wins(spark, events, rows):
    hierarchy = lx.Hierarchy(
        native_ads=spark.createDataFrame([(100, "ad")], "id int, name string"),
        campaigns_native_ads=spark.createDataFrame([(100, 77)], "native_ad_id int, campaign_id int"),
        campaigns=spark.createDataFrame([(77, "camp", "T", 5, 6, 7)], "id int, name string, type string, line_item_id int, sub_advertiser_id int, user_id int"),
        line_items=spark.createDataFrame([(5, "group")], "id int, name string"),
        sub_advertisers=spark.createDataFrame([(6, "sub")], "id int, name string"),
        users=spark.createDataFrame([(7, "acc")], "id int, company_name string"),
    )
    lookups = lx.Lookups(
        deals=spark.createDataFrame([("d1", "Deal 1"), ("d2", "Deal 2")], "deal_id string, name string"),
        byod_deals=spark.createDataFrame([("d2",), ("d2",)], "deal_id string"),
    )
    report = lx.build_report(
        events,
        request(columns=["campaign_id", "nativead_id", "deal_id", "cost"], renames="cost:spend"),
        hierarchy,
        lookups,
    )
    assert rows(report, "campaign_id", "campaign_name", "creative_id", "deal_id", "deal_name", "spend", "account_name") == [
        (10, "camp", 100, "", "Deal 1", 2.5, "acc"),
        (10, "camp", 100, "", None, 0.0, "acc"),
        (11, None, None, "d2", "Deal 2", 0.0, None),
    ]


def test_zone_per_row(spark, rows):
    users = spark.createDataFrame([(1, "Eastern"), (2, "?"), (3, None)], "id int, timezone string")
    zones = spark.createDataFrame([("Eastern", "America/New_York")], "timezone string, RS_timezone string")
    assert rows(lx.account_zone(users, zones)) == [(1, "America/New_York"), (2, "UTC"), (3, "UTC")]


def test_censoring(events, rows):
    rules = privacy.PrivacyRules(
        restricted_regions=frozenset({"FR"}),
        hidden_in_restricted=("deal_id",),
        hashed=("advertiser_id",),
        needs_consent=("ip_address",),
    )
    pulled = lx.pull(events, request(columns=["deal_id", "ip_address", "advertiser_id"], privacy=rules))
    found = rows(pulled, "deal_id", "ip_address")
    assert found == [("d1", "ip"), (None, None), (None, None)]
    assert {len(r[0]) for r in rows(pulled, "advertiser_id")} == {64}


def test_pull_windows():
    as_of, start = date(2024, 3, 5), date(2024, 1, 1)
    end = datetime(2024, 3, 5)  # exclusive
    assert times.pull_window(as_of, start, output_exists=False) == (datetime(2024, 1, 1), end)
    assert times.pull_window(as_of, start, output_exists=True, repull=True) == (datetime(2024, 1, 1), end)
    assert times.pull_window(as_of, start, output_exists=True) == (datetime(2024, 3, 4), end)
    assert times.local_day_bounds(date(2024, 3, 10), date(2024, 3, 10), "America/New_York") == (
        datetime(2024, 3, 10, 5),
        datetime(2024, 3, 11, 4),
    )


def test_time_columns_by_name():
    assert all(map(times.is_time_column, ["request_time", "REQUEST_HOUR", "visit_date", "imp time", "timestamp"]))
    assert not any(map(times.is_time_column, ["lifetime", "update", "date_added", "request_times"]))


def test_time_text_needs_most_values(spark, rows):
    df = spark.createDataFrame(
        [(n, "2024-01-01T00:00:05" if n < 7 else "later", "2024-01-01" if n < 8 else None, 1_000_000) for n in range(10)],
        "n int, click_time string, start_date string, stats_imp_time bigint",
    )
    out = times.time_text(df)
    assert set(rows(out, "click_time")) == {("2024-01-01T00:00:05",), ("later",)}
    assert set(rows(out, "start_date")) == {("2024-01-01 00:00:00",), (None,)}
    assert set(rows(out, "stats_imp_time")) == {("1970-01-01 00:00:01",)}


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_dated_delivery(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, None)], "id int, v string")
    path = writers.psv_gz(df, str(tmp_path), "out", date(2024, 5, 1))
    assert path.endswith("/out_20240501.psv.gz")
    assert spark.read.option("header", True).option("sep", "|").csv(path).count() == 2
    # Written again, it is replaced.
    assert writers.psv_gz(df.limit(1), str(tmp_path), "out", date(2024, 5, 1)) == path
    assert spark.read.option("header", True).option("sep", "|").csv(path).count() == 1


def test_files_of_a_day_follow_its_size(spark, tmp_path):
    log = spark.range(60_000).selectExpr("timestamp_ntz'2024-05-01 10:00:00' as request_time", "id", "uuid() as u").repartition(8)
    counts = []
    for size in ("64m", "64k"):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
        path = writers.event_log_by_day(log, str(tmp_path / size))
        counts.append(sum(name.endswith(".parquet") for name in os.listdir(f"{path}/event_date=2024-05-01")))
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert counts[0] < counts[1]


def test_exactly_one_file(spark, tmp_path):
    for name in ("a.gz", "b.gz", "c.csv"):
        (tmp_path / name).write_text("x")
    assert readers.single_file(spark, str(tmp_path), ".csv").endswith("/c.csv")
    for suffix in (".gz", ".zip"):
        with pytest.raises(ValueError):
            readers.single_file(spark, str(tmp_path), suffix)


def test_output_is_found_at_its_own_level(spark, tmp_path):
    (tmp_path / "sample").mkdir()
    (tmp_path / "sample" / "x.csv").write_text("x")
    assert not readers.has_output(spark, str(tmp_path))
    assert not readers.has_output(spark, str(tmp_path / "absent"))
    (tmp_path / "x.csv").write_text("x")
    assert readers.has_output(spark, str(tmp_path))
    assert not readers.has_output(spark, str(tmp_path), besides="x.csv")


def test_due_run_follows_the_folder(spark, tmp_path):
    """A sample first; a failed first run, and the same day again, leave the initial window open."""
    folder, start, first, second = tmp_path / "client", date(2024, 1, 1), date(2024, 3, 5), date(2024, 3, 6)

    def due(day, repull=False):
        run = delivery.due_run(spark, str(folder), day, start, repull)
        return run.sample, run.start, run.target.rsplit("/", 1)[1]

    assert due(first) == (True, datetime(2024, 1, 1), "sample")
    (folder / "sample").mkdir(parents=True)
    assert due(first) == (False, datetime(2024, 1, 1), "report_20240305.csv")
    (folder / "report_20240305.csv").mkdir()  # a run that was lost before it ended
    assert due(second)[1] == datetime(2024, 1, 1)
    (folder / "report_20240305.csv" / "_SUCCESS").write_text("")
    assert due(first)[1] == datetime(2024, 1, 1)
    assert due(second) == (False, datetime(2024, 3, 5), "report_20240306.csv")
    assert due(second, repull=True)[1] == datetime(2024, 1, 1)


def test_latest_snapshot_compares_numbers(spark, tmp_path):
    for part in ("year=2023/month=12/day=31/hour=9", "year=2024/month=9/day=1/hour=1", "year=2024/month=10/day=2"):
        (tmp_path / part).mkdir(parents=True)
    assert readers.latest_snapshot_path(spark, str(tmp_path)).endswith("year=2024/month=10/day=2")


def test_table_modes(spark, tmp_path):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1))], "id int, request_time timestamp_ntz")
    table = "log_delivery"
    for options, count in (({"mode": ""}, 1), ({}, 2), ({"mode": "Overwrite"}, 1), ({}, 2), ({"sample": True}, 1)):
        writers.deliver(df, "table", table, **options)
        assert spark.table(table).count() == count
    assert spark.table(table).collect()[0].request_time == "2024-01-01 00:00:00"
    spark.sql(f"drop table {table}")


def test_materialised_models(spark):
    df = spark.range(3)
    writers.as_table(df, "model_table")
    writers.as_table(df, "model_table")
    assert spark.table(writers.as_view(df, "model_view")).count() == spark.table("model_table").count() == 3
    spark.sql("drop table model_table")


def test_audit_rerun_is_idempotent(spark, tmp_path, rows):
    path = str(tmp_path / "audit")
    df = spark.createDataFrame([(date(2024, 1, d), d) for d in (1, 2, 3)], "date date, v int")
    for _ in range(2):
        writers.audit_by_date(df, path)
    writers.audit_by_date(df.where("v = 2").withColumn("v", F.lit(20)), path)
    assert rows(spark.read.parquet(path), "date", "v") == [
        (date(2024, 1, 1), 1), (date(2024, 1, 2), 20), (date(2024, 1, 3), 3)
    ]


def test_log_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.createDataFrame([(datetime(2024, 1, d, 12),) for d in range(1, 10)], "request_time timestamp_ntz")
    writers.event_log_by_day(log, path)
    day = readers.event_day(spark, path, date(2024, 1, 3))
    assert day.count() == 1 and "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().executedPlan().toString()
    assert readers.event_range(spark, path, datetime(2024, 1, 2, 12), datetime(2024, 1, 4, 12)).count() == 2


def test_destinations(spark, tmp_path):
    with pytest.raises(ValueError):
        writers.deliver(spark.range(1), "pigeon", str(tmp_path))
    with pytest.raises(ValueError):
        writers.write_files(spark.range(1), str(tmp_path / "x"), "xml")
    (check,) = writers.verify(spark.range(3), spark.range(2)).collect()
    assert (check.rows_written, check.rows_found, check.is_complete) == (3, 2, False)


def test_heavy_keys_are_spread(spark, rows):
    """A third of the rows in one key, a third blank: no task of a shuffled lookup gets much more than the others."""
    log = spark.range(60_000).select(
        F.concat(F.lit("A"), "id").alias("auction_id"),
        F.expr("case id % 3 when 0 then 'hot' when 1 then if(id % 2 = 0, '', null) else 'd' || id end").alias("deal_id"),
    )
    names = spark.range(60_000).select(F.concat(F.lit("d"), "id").alias("deal_id"), F.col("id").alias("name"))
    names = names.union(spark.createDataFrame([("hot", -1), ("hot", -2)], names.schema))  # two rows for one key
    heavy = keys.heavy_keys(log, ["deal_id"], share=0.01)
    assert [(r._heavy, r._salts) for r in heavy["deal_id"].collect()] == [("hot", 43)]  # 32 pieces, 4 tasks, a third
    plain = keys.left_wins_join(log, names, "deal_id", spread_by="auction_id")
    dealt = keys.left_wins_join(log, names, "deal_id", spread_by="auction_id", heavy=heavy["deal_id"])
    assert dealt.columns == plain.columns and dealt.count() == 80_000
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    known = spark.createDataFrame([("hot",), ("d2",), ("d2",)], "deal_id string")
    one = keys.only_known(log, "deal_id", known, "deal_id", heavy=heavy["deal_id"])
    assert rows(one.groupBy("deal_id").count()) == [("", 39_999), ("d2", 1), ("hot", 20_000)]

    def worst(df):
        sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())
        return sizes[-1] / sizes[(len(sizes) - 1) // 2]

    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in off}
    try:
        for name, value in off.items():
            spark.conf.set(name, value)
        heavy = keys.heavy_keys(log, ["deal_id"], share=0.01)["deal_id"]
        assert worst(keys.left_wins_join(log, names, "deal_id", spread_by="auction_id")) > 4
        assert worst(keys.left_wins_join(log, names, "deal_id", spread_by="auction_id", heavy=heavy)) < 2
        assert worst(keys.only_known(log, "deal_id", known, "deal_id", heavy=heavy)) < 2
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_no_heavy_keys(spark):
    empty = spark.createDataFrame([], "deal_id string, dma int")
    assert keys.heavy_keys(empty, ["deal_id", "dma"]) == {} and keys.heavy_keys(empty, []) == {}
    blank = spark.createDataFrame([(None, 1), ("", 1)], "deal_id string, dma int")
    assert list(keys.heavy_keys(blank, ["deal_id", "dma"])) == ["dma"]
