from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adstrata.functions import labels, scalars
from adstrata.operators import campaign_daily, paths

EVENTS = """
event_id string, anonymous_user_id string, auction_id string, campaign_id string, line_item_id string,
creative_id string, conversion_tracker_id string, conversion_event_id string, order_id string,
event_at timestamp_ntz, event_type string, supply_inventory_type string, device_type string, country string,
region string, city string, cost_micros string, conversion_value string, conversion_count_type string,
has_impression boolean, has_click boolean, has_conversion boolean, is_test_event boolean
"""
CAMPAIGNS = """
campaign_id string, campaign_name string, account_id string, channel string, campaign_type string, status string,
primary_goal string, primary_goal_amount double, budget_amount double, start_date date, end_date date, is_deleted boolean
"""
DELIVERY = """
activity_date date, campaign_id string, line_item_id string, supply_inventory_type string, device_type string,
impressions string, clicks bigint, conversions bigint, reach_count bigint, media_cost double
"""
AT = datetime(2024, 5, 1, 12)


def event(event_id, kind, at, user="u", **changes):
    record = {
        "event_id": event_id,
        "anonymous_user_id": user,
        "campaign_id": "c1",
        "event_at": at,
        "event_type": kind,
        "cost_micros": "1500000",
        "creative_id": "r1",
        **changes,
    }
    names = [field.split()[0] for field in EVENTS.replace("\n", " ").split(",")]
    return tuple(record.get(name) for name in names)


@pytest.fixture
def frame(spark):
    return lambda *events: spark.createDataFrame(list(events), EVENTS)


@pytest.fixture
def campaigns(spark):
    return spark.createDataFrame(
        [
            ("c1", " Name ", "acc", None, "T", "Active", None, 1.0, 100.0, date(2024, 1, 1), None, None),
            ("c2", None, None, "ch", "T", "Active", "CPA", 1.0, 0.0, date(2024, 5, 1), date(2024, 5, 10), False),
            ("c3", "gone", "acc", "ch", "T", "Active", "CPA", 1.0, 0.0, date(2024, 5, 1), date(2024, 5, 10), True),
        ],
        CAMPAIGNS,
    )


def test_clean_events(frame, rows):
    cleaned = paths.clean_events(
        frame(
            event("1", " Impression ", AT, cost_micros="x", device_type=" "),
            event("2", "CLICK", AT, has_click=False),
            event("3", "click", None),
            event("4", "click", AT, is_test_event=True),
        )
    )
    assert rows(cleaned, "event_id", "has_impression", "has_click", "cost_micros", "device_type") == [
        ("1", True, False, None, ""),
        ("2", False, False, 1500000.0, "Unknown"),
    ]


def test_once_trackers_keep_the_earliest(frame, rows):
    def conversion(event_id, hours, count_type, tracker="t", order="o"):
        return event(
            event_id,
            "conversion",
            AT + timedelta(hours=hours),
            conversion_tracker_id=tracker,
            order_id=order,
            conversion_count_type=count_type,
        )

    cleaned = paths.clean_events(
        frame(
            conversion("b", 0, "Once"),
            conversion("a", 0, " once "),
            conversion("c", 1, "once"),
            conversion("m1", 5, None),
            conversion("m2", 6, None),
            conversion("x1", 0, "multiple", tracker="mixed"),
            conversion("x2", 1, "once", tracker="mixed"),
            conversion("n1", 1, "once", tracker=None, order=None),
            conversion("n2", 1, "once", tracker=None, order=None),
        )
    )
    kept = paths.dedup_conversions(cleaned)
    assert [r[0] for r in rows(kept, "conversion_event_id")] == ["a", "m1", "m2", "n1", "n2", "x1"]


def test_lookback_ends_are_included(frame, campaigns, rows):
    day = timedelta(days=1)
    result = paths.conversion_paths(
        frame(
            event("i0", "impression", AT - 60 * day - timedelta(microseconds=1)),
            event("i1", "impression", AT - 60 * day, device_type="TV"),
            event("k1", "click", AT, device_type="Phone", campaign_id="c2"),
            event("k2", "click", AT + timedelta(microseconds=1)),
            event("e1", "error", AT),
            event("x", "conversion", AT, conversion_value="5"),
        ),
        campaigns,
        updated_at=AT,
    )
    assert rows(
        result,
        "first_impression_at",
        "last_click_at",
        "impression_touch_count",
        "click_touch_count",
        "touched_campaign_count",
        "pre_conversion_media_cost",
        "device_type_list",
        "conversion_path_type",
        "impression_to_conversion_bucket",
        "campaign_name",
        "primary_goal",
        "updated_timestamp",
    ) == [
        (AT - 60 * day, AT, 1, 1, 2, 3.0, "Phone / TV", "Click path", "> 30 days", "Name", "No Goal", AT)
    ]


def test_conversion_without_touches_or_user(frame, campaigns, rows):
    result = paths.conversion_paths(
        frame(
            event("i", "impression", AT, user=None),
            event("x", "conversion", AT, user=None),
            event("y", "conversion", AT, user="v", campaign_id="c3"),
        ),
        campaigns,
    )
    assert rows(
        result,
        "conversion_event_id",
        "impression_touch_count",
        "pre_conversion_media_cost",
        "supply_inventory_type_list",
        "conversion_path_type",
        "impression_to_conversion_bucket",
        "campaign_name",
    ) == [
        ("x", 0, 0.0, "Unknown", "Conversion only", "No prior impression", "Name"),
        ("y", 0, 0.0, "Unknown", "Conversion only", "No prior impression", "Unknown Campaign"),
    ]


def test_blank_labels_stay_blank(frame, campaigns, rows):
    result = paths.conversion_paths(
        frame(event("i", "impression", AT, device_type=" "), event("x", "conversion", AT)), campaigns
    )
    assert rows(result, "device_type_list") == [("",)]


def test_equal_conversions_add_their_touch_cost(frame, campaigns, rows):
    result = paths.conversion_paths(
        frame(
            event("i", "impression", AT - timedelta(hours=1)),
            event("x", "conversion", AT, conversion_value="1"),
            event("x", "conversion", AT, conversion_value="3"),
        ),
        campaigns,
    )
    assert rows(result, "conversion_value", "pre_conversion_media_cost", "impression_touch_count") == [
        (3.0, 3.0, 1)
    ]


@pytest.mark.parametrize(
    "hours, band",
    [
        (23, "< 1 day"),
        (24, "1-5 days"),
        (24 * 6 - 1, "1-5 days"),
        (24 * 6, "6-10 days"),
        (24 * 11, "11-20 days"),
        (24 * 21, "21-30 days"),
        (24 * 31, "> 30 days"),
    ],
)
def test_time_bands(spark, hours, band):
    row = spark.range(1).select(
        paths._time_band(
            F.lit(AT).cast("timestamp_ntz"), F.lit(AT - timedelta(hours=hours)).cast("timestamp_ntz")
        ).alias("b")
    )
    assert row.collect()[0].b == band


def test_whole_units_are_complete(spark):
    row = spark.range(1).select(
        scalars.whole_units(
            "HOUR", F.lit("2024-01-01 00:59:00").cast("timestamp_ntz"), F.lit("2024-01-01 01:01:00").cast("timestamp_ntz")
        ).alias("h")
    )
    assert row.collect()[0].h == 0


def test_velocity_bands(spark, rows):
    df = spark.createDataFrame([(d,) for d in (-1, 7, 8, 30, 31, 90, 91, None)], "d int")
    assert [r.v for r in df.select(labels.velocity_band(F.col("d")).alias("v")).collect()] == [
        "fast", "fast", "standard", "standard", "extended", "extended", "long_tail", "long_tail"
    ]


def delivery(spark, *data):
    return spark.createDataFrame(list(data), DELIVERY)


def no_paths(frame, campaigns):
    return paths.conversion_paths(frame(event("z", "conversion", AT, campaign_id="none")), campaigns)


def test_pacing_needs_an_end_date(spark, frame, campaigns):
    d1, d2 = date(2024, 5, 2), date(2024, 5, 3)
    report = campaign_daily.campaign_quality(
        delivery(
            spark,
            (d1, "c1", "l1", " A ", None, "10", 4, 0, 5, 50.0),
            (d2, "c1", "l1", "A", "m", "x", 0, 0, 0, 25.0),
            (d1, "c2", "l1", "A", "m", "0", 0, 0, 0, 0.0),
            (d1, "c9", "l1", "A", "m", "1", 0, 0, 1, 0.0),
            (None, "c1", "l1", "A", "m", "1", 0, 0, 1, 9.0),
        ),
        campaigns,
        no_paths(frame, campaigns),
    )
    found = {(r.campaign_id, r.activity_date): r for r in report.collect()}
    open_end = found["c1", d1]
    assert open_end.expected_budget_progress is None and open_end.has_budget_pacing_gap is None
    assert open_end.actual_budget_progress == 0.5
    assert open_end.has_unusually_high_click_through_rate is True
    assert open_end.primary_health_note == "Missing goal"
    # 20 for the goal, 10 for the rate; the unknown pacing costs nothing.
    assert open_end.reporting_health_score == 70
    assert open_end.supply_inventory_type_list == "A" and open_end.device_type_list == "Unknown"
    second = found["c1", d2]
    assert second.cumulative_media_cost == 75.0 and second.click_through_rate is None
    assert second.has_spend_without_delivery is True and second.reporting_health_score == 60
    clean = found["c2", d1]
    assert clean.actual_budget_progress is None and clean.expected_budget_progress == 0.2
    assert clean.campaign_name == "Unnamed Campaign" and clean.primary_health_note == "Looks clean"
    assert clean.primary_health_note_sort == 999
    unknown = found["c9", d1]
    assert unknown.budget_amount is None and unknown.campaign_name == "Unknown Campaign"
    assert unknown.has_delivery_without_spend is True
    assert len(found) == 4


def test_strict_extremes_are_null_with_any_null(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "a int, b int")
    assert [tuple(r) for r in df.select(scalars.strict_greatest("a", "b"), scalars.strict_least("a", "b")).collect()] == [
        (None, None),
        (2, 1),
    ]


def test_budget_status(spark):
    df = spark.createDataFrame([(111.0,), (110.0,), (90.0,), (89.0,)], "s double")
    status = labels.budget_status(F.col("s"), F.lit(100.0))
    assert [r[0] for r in df.select(status).collect()] == ["overrun", "on_track", "on_track", "underspent"]


def test_stale_data_is_old_data(spark):
    now = datetime(2024, 5, 1, 12)
    df = spark.createDataFrame(
        [
            (0, 1.0, 0.1, now),
            (5, None, 0.1, now),
            (5, 1.0, 0.6, now),
            (5, 1.0, None, now - timedelta(hours=5)),
            (5, 1.0, 0.1, now - timedelta(hours=4)),
        ],
        "daily_impressions int, daily_spend double, daily_conversion_rate double, last_data_sync timestamp_ntz",
    )
    flagged = campaign_daily.data_quality_flags(df, str(now))
    assert [r.data_quality_flag for r in flagged.collect()] == [
        "no_delivery", "missing_cost_data", "suspicious_high_rate", "stale_data", "healthy"
    ]
