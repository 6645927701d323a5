from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from adstrata.operators import health, reconcile


def one(df):
    (row,) = df.collect()
    return (row.status, row.failed_rows, row.detail)


def test_required_fields(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(health.required_fields(df, "t", ["a", "b", "c"]), "check_name", "status", "failed_rows", "detail") == [
        ("required_field_exists", "fail", 2, "c is missing."),
        ("required_field_not_null", "fail", 1, "b has 1 missing value(s)."),
        ("required_field_not_null", "pass", 0, "a has 0 missing value(s)."),
    ]


def test_duplicates_count_all_members_and_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert one(health.duplicate_key(df, "t", "k")) == ("fail", 4, "k has 4 duplicated row(s).")
    assert one(health.duplicate_key(df.distinct(), "t", "k"))[0] == "pass"


def test_freshness(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 8),)], "d date")
    assert one(health.freshness(df, "t", "d", 2, "2024-01-10")) == ("pass", 0, "Newest record is 2 day(s) old.")
    assert one(health.freshness(df, "t", "d", 2, "2024-01-11")) == ("fail", 2, "Newest record is 3 day(s) old.")
    assert one(health.freshness(df.where("d is null"), "t", "d", 2, "2024-01-11"))[0] == "fail"


def test_invalid_values(spark):
    df = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "v string")
    assert one(health.valid_values(df, "t", "v", {"a"})) == ("fail", 3, "v has 3 invalid row(s) of 2 value(s).")
    assert one(health.valid_values(df.where("v = 'a'"), "t", "v", {"a"})) == ("pass", 0, "v has 0 invalid row(s) of 0 value(s).")
    more = df.unionByName(spark.createDataFrame([("y",)], "v string"))
    assert sorted(map(tuple, health.invalid_values(more, "v", {"a"}).collect()), key=str) == [("y", 1), ("z", 2), (None, 1)]


def test_revenue_pairs(spark, rows):
    reported = spark.createDataFrame(
        [("1", 10.0), ("2", None), ("3", 5.0), ("3", 7.0), ("4", 3.0), ("5", 1.0)],
        "opportunity_id string, amount_reporting double",
    )
    source = spark.createDataFrame(
        [("1", 11.0), ("2", 2.0), ("3", 7.0), ("3", 7.0), ("3", 9.0)],
        "opportunity_id string, amount_source double",
    )
    assert rows(health.revenue_mismatches(reported, source), "opportunity_id", "revenue_difference", "source_rows") == [
        ("2", -2.0, 1),
        ("3", -2.0, 1),
        ("3", -2.0, 2),
        ("3", -4.0, 1),
        ("4", 3.0, 1),
    ]
    assert one(health.revenue_reconciliation(reported, source)) == ("fail", 6, "6 revenue mismatches found.")


def test_strict_reconciliation(spark):
    sales = spark.createDataFrame([("1", 10.0), ("2", 5.0), ("9", 1.0)], "opp_id string, opp_value double")
    billing = spark.createDataFrame([("1", 10.01), ("2", 4.5), ("2", 4.5)], "id string, amount double")
    check = health.revenue_reconciliation_strict(sales, billing, "opp_id", "id", "opp_value", "amount", 0.011)
    assert one(check) == ("fail", 2, "Revenue mismatch: $1.00 across 2 records")
    assert one(health.revenue_reconciliation_strict(sales, sales, "opp_id", "opp_id", "opp_value", "opp_value")) == ("pass", 0, "")


def test_row_count_drop(spark, rows):
    history = spark.createDataFrame(
        [
            ("falling", date(2024, 1, 1), 100),
            ("falling", date(2024, 1, 2), 79),
            ("steady", date(2024, 1, 2), 80),
            ("steady", date(2024, 1, 1), 100),
            ("empty", date(2024, 1, 1), 0),
            ("empty", date(2024, 1, 2), 5),
            ("new", date(2024, 1, 2), 5),
        ],
        "table_name string, snapshot_date date, row_count bigint",
    )
    assert rows(health.row_count_drop(history), "table_name", "status", "failed_rows", "detail") == [
        ("empty", "pass", 0, "Row count changed by 0.0%"),
        ("falling", "fail", 79, "Row count changed by 21.0%"),
        ("new", "pass", 0, "Row count changed by 0.0%"),
        ("steady", "pass", 0, "Row count changed by 20.0%"),
    ]


def test_references_and_missing_values(spark):
    child = spark.createDataFrame([("a",), ("x",), (None,)], "account_id string")
    parent = spark.createDataFrame([("a",), ("a",)], "account_id string")
    assert one(health.referential_integrity(child, parent, "rows", "account_id")) == (
        "fail", 2, "Found 2 rows with non-existent account_id"
    )
    profile = health.missing_profile(child, "child")
    assert [tuple(r) for r in profile.collect()] == [("child", "account_id", 1, pytest.approx(100 / 3))]
    assert one(health.missing_values(profile)) == ("fail", 1, "Found missing values in 1 column(s)")
    assert one(health.missing_values(health.missing_profile(parent, "p"))) == ("pass", 0, "")


def test_row_delta_and_guard(spark):
    assert one(health.row_delta(spark.range(100), spark.range(95), "t")) == ("pass", 0, "Row count changed by 5.0%")
    assert one(health.row_delta(spark.range(100), spark.range(106), "t"))[:2] == ("fail", 6)
    assert one(health.rows_preserved(spark.range(3), spark.range(4), "t"))[0] == "fail"
    assert one(health.row_delta(spark.range(0), spark.range(0), "t"))[0] == "pass"
    weighted = spark.createDataFrame([(60,), (40,)], "row_count int")
    assert one(health.row_delta(spark.range(100), weighted, "t"))[0] == "pass"
    with pytest.raises(ValueError):
        health.not_empty(spark.range(0))
    assert health.not_empty(spark.range(1)).count() == 1


def test_score_and_severity(spark, rows):
    results = health.combine(
        health.valid_values(spark.range(3), "t", "id", {"0"}),
        health.duplicate_key(spark.range(3), "t", "id"),
        health.row_delta(spark.range(1), spark.range(9), "t"),
    )
    (score,) = health.health_score(results).collect()
    assert (score.total_checks, score.passed_checks, score.failed_checks, score.health_score) == (3, 1, 2, 33.3)
    assert score.failed_list == "t.row_count_delta, t.valid_values"
    assert rows(health.with_severity(results), "check_name", "severity") == [
        ("duplicate_primary_key", None),
        ("row_count_delta", None),
        ("valid_values", "CRITICAL"),
    ]
    (empty,) = health.health_score(results.where("false")).collect()
    assert empty.health_score == 0.0


LOG = "request_time timestamp_ntz, cluster string, advertiser_id int, cost bigint, has_won int, has_click int, has_conv int, has_ltconv int"
STATS = "user_id int, cached_hour timestamp_ntz, cost bigint, imp bigint, click bigint, conv bigint, ltc bigint, skan_conv bigint"


@pytest.fixture
def log(spark):
    at = datetime(2024, 1, 2, 5)
    return spark.createDataFrame(
        [
            (at, "0", 1, 1_000_000, 1, 0, 0, 0),
            (at, "1", 1, 1_000_000, 1, 0, 0, 0),
            (at, "0", 2, 2_000_000, 1, 1, 0, 0),
            (at, "0", 3, 1_000_000, 1, 0, 1, 0),
            (datetime(2024, 1, 3), "0", 1, 5_000_000, 1, 0, 0, 0),
        ],
        LOG,
    )


@pytest.fixture
def stats(spark):
    hour = datetime(2024, 1, 2, 5)
    return spark.createDataFrame(
        [
            (1, hour, 2_000_000, 2, 0, 0, 0, 0),
            (2, hour, 2_000_000, 1, 1, 1, 1, 3),
            (2, datetime(2024, 1, 2, 6), 0, 0, 0, 1, 0, 0),
            (4, hour, 1, 1, 1, 1, 1, 0),
        ],
        STATS,
    )


DAY = date(2024, 1, 2)


def test_comparison_per_cluster(log, stats, rows):
    compared = reconcile.compare_advertisers(reconcile.log_totals(log, DAY), reconcile.stats_totals(stats, DAY))
    assert rows(compared, "cluster", "advertiser_id", "cost_diff", "cost_perc", "automation_flag", "missing_in_stats") == [
        ("0", 1, 1.0, 100.0, True, False),
        ("0", 2, 0.0, 0.0, False, False),
        ("0", 3, None, None, False, True),
        ("1", 1, 1.0, 100.0, True, False),
    ]
    assert rows(reconcile.clean_advertisers(compared), "advertiser_id") == [(2,), (3,)]
    (summary,) = reconcile.comparison_summary(compared).collect()
    assert (summary.automation_flag, summary.flagged_rows, summary.max_cost_perc) == (True, 2, 100.0)


def test_clusters_can_be_summed(log, stats, rows):
    compared = reconcile.compare_advertisers(
        reconcile.log_totals(log, DAY), reconcile.stats_totals(stats, DAY), sum_clusters=True
    )
    assert rows(compared, "advertiser_id", "automation_flag") == [(1, False), (2, False), (3, False)]


def test_difference_against_zero_is_flagged(spark, log, stats):
    more = stats.withColumn("click", F.lit(1).cast("bigint"))
    compared = reconcile.compare_advertisers(reconcile.log_totals(log, DAY), reconcile.stats_totals(more, DAY), sum_clusters=True)
    row = compared.where("advertiser_id = 1").collect()[0]
    assert row.click_perc is None and row.automation_flag is True


def test_skan_is_taken_off_down_to_zero(stats, rows):
    totals = reconcile.stats_totals(stats)
    assert rows(totals.where("advertiser_id = 2"), "stats_conv", "stats_ltconv") == [(0, 0)]


def test_unknown_denominator(log, stats):
    with pytest.raises(ValueError):
        reconcile.compare_advertisers(log, stats, denominator="both")


def test_cluster_frames_are_stacked(log, rows):
    frames = {c: log.where(F.col("cluster") == c).drop("cluster") for c in ("0", "1")}
    stacked = reconcile.cluster_log(frames)
    assert rows(stacked.groupBy("cluster").count()) == [("0", 4), ("1", 1)]
    with pytest.raises(ValueError):
        reconcile.cluster_log({})
