from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from adstrata.operators import identity, keys, reach

LOG = "cg_id int, cg_name string, uniq_imp_id string, has_won string, local_date timestamp_ntz"
D = [datetime(2024, 1, day) for day in range(1, 11)]
GROUP = ["cg_id", "cg_name"]


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [
            (1, "a", "u1", "1", D[0]),
            (1, "a", "u1", "1", D[1]),
            (1, "a", "u1", "1", D[8]),
            (1, "a", "u2", "x", D[1]),
            (1, "a", None, "1", D[1]),
            (2, None, "u1", "1", D[1]),
            (3, "c", "u3", "1", D[9]),
        ],
        LOG,
    )


def test_summary_counts_rows_per_user(log, rows):
    assert rows(reach.reach_summary(log, GROUP), "cg_id", "reach", "impressions", "frequency") == [
        (1, 2, 4, 2.5),
        (3, 1, 1, 1.0),
    ]


def test_frequencies_skip_incomplete_keys(log, rows):
    frequency = reach.user_frequency(log, GROUP)
    assert rows(frequency, "cg_id", "uniq_imp_id", "imps") == [(1, "u1", 3), (1, "u2", 0), (3, "u3", 1)]
    assert rows(reach.frequency_histogram(frequency, GROUP), "cg_id", "imps", "users") == [(1, 0, 1), (1, 3, 1), (3, 1, 1)]
    every = reach.exact_counts(frequency, GROUP)
    assert rows(every, "cg_id", "imps", "users", "reach", "impressions") == [(1, 0, 1, 2, 3), (1, 3, 1, 2, 3), (3, 1, 1, 1, 1)]
    few = reach.exact_distribution(frequency, GROUP, [3])
    assert rows(few, "cg_id", "3x", "other_x", "reach") == [(1, 1, 1, 2), (3, 0, 1, 1)]
    with pytest.raises(KeyError):
        reach.user_frequency(log, ["nope"])


def test_distributions(log):
    frequency = reach.user_frequency(log, GROUP)
    row = reach.cumulative_distribution(frequency, GROUP, [1, 2, 3, 4]).where("cg_id = 1").collect()[0]
    assert (row["1+"], row["2+"], row["3+"], row["4+"], row.reach, row.avg_imp_per_user) == (1, 1, 1, 0, 2, 1.5)
    row = reach.exact_distribution(frequency, GROUP, [0, 1, 3]).where("cg_id = 1").collect()[0]
    assert (row["0x"], row["1x"], row["3x"]) == (1, 0, 1)


def test_buckets_never_rise(spark):
    frequency = spark.range(500).select(F.lit(1).alias("g"), (F.col("id") % 60).alias("imps"))
    row = reach.cumulative_distribution(frequency, ["g"]).collect()[0]
    buckets = [row[f"{k}+"] for k in range(1, 51)]
    assert buckets == sorted(buckets, reverse=True) and buckets[0] == sum(i % 60 >= 1 for i in range(500))


def test_windows_are_half_open_and_may_overlap(log, rows):
    windows = [
        reach.LabelledWindow(date(2024, 1, 1), date(2024, 1, 2), "first"),
        reach.LabelledWindow(date(2024, 1, 2), date(2024, 1, 10), "rest"),
        reach.LabelledWindow(date(2024, 1, 1), date(2024, 1, 10), "all"),
    ]
    result = reach.windowed_distribution(log, GROUP, "local_date", windows, [1, 2])
    assert rows(result, "cg_id", "window", "reach", "impressions", "2+") == [
        (1, "all", 2, 3, 1),
        (1, "first", 1, 1, 0),
        (1, "rest", 2, 2, 1),
    ]
    with pytest.raises(ValueError):
        reach.in_windows(log, "local_date", [windows[0], windows[0]])


def test_trailing_window_leaves_out_its_end(log, rows):
    result = reach.trailing_distribution(log, GROUP, "local_date", 5, [1])
    assert rows(result, "cg_id", "reach", "1+") == [(1, 1, 1)]


def test_alerts(spark, rows):
    distribution = spark.createDataFrame(
        [(1, 200, 3200, 99), (2, 200, 3000, 100), (3, 99, 99, 0)], "g int, reach bigint, impressions bigint, `10+` bigint"
    )
    assert rows(reach.saturation_alerts(distribution), "g", "alert", "level") == [
        (1, "avg_frequency", "WARNING"),
        (2, "frequent_users", "WARNING"),
        (3, "low_reach", "INFO"),
    ]


def test_weekly_report_and_names(spark, log, rows):
    weekly = reach.weekly_report(log, GROUP, "local_date", [1, 2])
    assert rows(weekly, "week", "cg_id", "reach", "1x", "2x", "avg_frequency") == [(1, 1, 2, 0, 1, 1.0), (2, 1, 1, 1, 0, 1.0), (2, 3, 1, 1, 0, 1.0)]
    items = spark.createDataFrame([(1, "one")], "id int, name string")
    named = reach.with_line_item_names(spark.createDataFrame([(1,), (2,)], "line_item_id int"), items)
    assert rows(named, "line_item_id", "cg_id", "cg_name") == [(1, 1, "one"), (2, None, None)]


EDGES = "luid string, duid string"
EVENTS = "auction_id string, request_duid_sha256 string, most_associated_duid_sha256 string"


@pytest.fixture
def graph(spark):
    return spark.createDataFrame(
        [
            (" L1 ", [("d1",), (" d2 ",), (None,), ("",)]),
            ("L2", [("d2",), ("d2",)]),
            ("", [("d3",)]),
            (None, [("d3",)]),
            ("L3", []),
            ("L4", None),
        ],
        "luid string, duids array<struct<id: string>>",
    )


def test_graph_is_flattened_and_cleaned(graph, rows):
    edges = identity.flatten_graph(graph)
    assert rows(edges, "luid", "duid") == [("L1", "d1"), ("L1", "d2"), ("L2", "d2"), ("L2", "d2")]
    assert rows(identity.restrict_edges(edges, edges.where("duid = 'd2'").select("duid")), "luid") == [("L1",), ("L2",)]


def test_picks_do_not_depend_on_partitions(spark):
    edges = spark.range(3000).select(
        F.concat(F.lit("L"), F.col("id") % 77).alias("luid"), F.concat(F.lit("d"), F.col("id") % 200).alias("duid")
    )
    picks = [sorted(identity.pick_luids(edges.repartition(n)).collect()) for n in (3, 7)]
    assert picks[0] == picks[1] and len(picks[0]) == 200
    assert sorted(identity.pick_luids(edges, seed=7).collect()) != picks[0]


@pytest.mark.parametrize("restrict", [False, True])
def test_stitching_keeps_rows(spark, graph, rows, restrict):
    log = spark.createDataFrame(
        [
            ("own", "d1", "d2"),
            ("linked", "dx", "d1"),
            ("none", "dx", "dy"),
            ("blank", "", None),
            ("null", None, "d1"),
            ("again", "d1", None),
        ],
        EVENTS,
    )
    crosswalk = identity.clean_crosswalk(
        spark.createDataFrame([("L1", "K1"), ("L1", "K1"), ("L2", None), ("L9", "K9")], "encrypted string, k string"),
        "encrypted",
        "k",
    )
    result = identity.resolve(log, identity.flatten_graph(graph), crosswalk, restrict=restrict)
    own, linked = "request_duid_sha256", "most_associated_duid_sha256"
    assert rows(result.rows, "auction_id", "matched_luid", "synthetic_key", "luid_match_source") == [
        ("again", "L1", "K1", own),
        ("blank", None, None, None),
        ("linked", "L1", "K1", linked),
        ("none", None, None, None),
        ("null", "L1", "K1", linked),
        ("own", "L1", "K1", own),
    ]
    (rates,) = identity.fill_alerts(result.rates).collect()
    assert (rates.total_rows, rates.rows_with_luid, rates.rows_without_luid, rates.rows_with_key) == (6, 4, 2, 4)
    assert rates.luid_fill_alert is True and rates.key_fill_alert is False
    observed, observation = identity.observe_fill(result.rows)
    observed.write.format("noop").mode("overwrite").save()
    assert observation.get["rows_with_luid"] == 4 and observation.get["luid_fill_rate"] == rates.luid_fill_rate


def test_device_ids(spark, rows):
    log = spark.createDataFrame([("1", "a", "b"), ("2", "b", ""), ("3", None, "a")], EVENTS)
    assert rows(identity.device_ids(log), "duid") == [("a",), ("b",)]


def test_export_has_seventeen_columns_and_click_first(spark, rows):
    report = spark.range(1).select(
        *[
            F.lit(name).alias(name)
            for name in set(identity.EXPORT_COLUMNS.values()) - {"event_type"}
        ],
        F.explode(F.array(*[F.struct(F.lit(c).alias("has_click"), F.lit(w).alias("has_won")) for c, w in ((1, 1), (0, 1), (0, 0))])).alias("f"),
    ).select("*", "f.*")
    export = identity.export_rows(report)
    assert len(export.columns) == 17
    assert rows(export, "event_type") == [("click",), ("impression",), (None,)]


def test_keep_first_orders_nulls_last_and_groups_null_keys(spark, rows):
    df = spark.createDataFrame([("k", None, 1), ("k", 5, 2), ("k", 7, 3), (None, 1, 4), (None, 2, 5)], "k string, o int, v int")
    assert rows(keys.keep_first(df, ["k"], ["o"]), "k", "v") == [("k", 2), (None, 4)]
    assert rows(keys.keep_first(df, ["k"], ["o"], descending=True), "k", "v") == [("k", 3), (None, 5)]


def test_flag_repeated_treats_nulls_as_equal(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, None)], "a int, b string")
    assert rows(keys.flag_repeated(df, ["a", "b"]), "a", "b", "is_repeated") == [
        (1, "x", False), (1, None, True), (1, None, True), (2, None, False)
    ]


def test_missing_keys_are_spread(spark):
    df = spark.range(10_000).select(F.lit(None).cast("string").alias("k"), "id")
    spread = df.select(keys.spread_null_key("k", "id").alias("k")).distinct().count()
    assert spread > 1000


def test_users_get_dense_numbers_and_bitmaps_add_up(spark):
    from adstrata.operators import reach_bitmaps

    rows = [("g", f"2024-01-0{1 + k % 5}", f"u{k % 70_000}", 1) for k in range(140_000)] + [("g", None, "x", 1), ("g", "2024-01-01", None, 1)]
    df = spark.createDataFrame(rows, "cg string, d string, uniq_imp_id string, has_won int").withColumn("d", F.col("d").cast("timestamp_ntz"))
    days = reach_bitmaps.user_days(df, ["cg"], "d")
    numbers = reach_bitmaps.number_users(days, ranges=5)
    assert numbers.agg(F.min("number"), F.max("number"), F.countDistinct("number")).head() == (1, 70_000, 70_000)
    bitmaps = reach_bitmaps.daily_bitmaps(days, numbers, ["cg"])
    assert bitmaps.select("bucket").distinct().count() == 3
    windows = [
        reach.LabelledWindow(date(2024, 1, 1), date(2024, 1, 2), "day"),
        reach.LabelledWindow(date(2024, 1, 1), date(2024, 1, 4), "three"),
        reach.LabelledWindow(date(2023, 1, 1), date(2023, 1, 4), "none"),
    ]
    found = {r["window"]: (r["reach"], r["impressions"]) for r in reach_bitmaps.reach_of_windows(bitmaps, ["cg"], windows).collect()}
    exact = lambda days: len({u for _, d, u, _ in rows if u and d and int(d[-1]) in days})
    assert found == {"day": (exact({1}), 28_000), "three": (exact({1, 2, 3}), 84_000)}


def test_panes_of_overlapping_windows(spark):
    rows = [("g", "n", f"u{k % 7}", 1, f"2024-01-{1 + k % 20:02d}") for k in range(200)] + [("g", "n", "u1", 1, None)]
    df = spark.createDataFrame(rows, "cg string, name string, uniq_imp_id string, has_won int, d string").withColumn("d", F.col("d").cast("timestamp_ntz"))
    windows = [
        reach.LabelledWindow(date(2024, 1, 3), date(2024, 1, 12), "a"),
        reach.LabelledWindow(date(2024, 1, 5), date(2024, 1, 7), "b"),
        reach.LabelledWindow(date(2024, 1, 10), date(2024, 2, 1), "c"),
    ]
    found = {r["window"]: (r["reach"], r["impressions"]) for r in reach.windowed_distribution(df, ["cg"], "d", windows, [1, 2]).collect()}
    held = lambda a, b: [r for r in rows if r[4] and a <= int(r[4][-2:]) < b]
    assert found == {w: (len({r[2] for r in held(*x)}), len(held(*x))) for w, x in {"a": (3, 12), "b": (5, 7), "c": (10, 32)}.items()}
