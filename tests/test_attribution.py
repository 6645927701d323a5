import random
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from adstrata.operators import attribution, timeline, touch_quality
from workload.attribution import attr_normalized

DEALS = "opportunity_id string, account_id string, stage_name string, created_at date, close_date date, amount double"
TOUCHES = (
    "touchpoint_id string, opportunity_id string, account_id string, campaign_id string, "
    "campaign_type string, channel string, touch_date date"
)
AS_OF = "2024-06-30"


@pytest.fixture
def deals(spark):
    return spark.createDataFrame(
        [
            ("o1", "a1", "Closed Won", date(2024, 1, 1), date(2024, 3, 1), 900.0),
            ("o2", "a2", "Open", date(2024, 1, 1), None, 100.0),
            ("o3", "a3", "Closed Lost", date(2024, 1, 1), date(2024, 2, 1), 50.0),
        ],
        DEALS,
    )


def touches(spark, data):
    return spark.createDataFrame(data, TOUCHES)


def fact(spark, deals, data, **options):
    clean = touch_quality.clean_touchpoints(touches(spark, data))
    return attribution.touchpoint_fact(deals, clean, AS_OF, **options)


def test_issue_precedence(spark, deals, rows):
    data = [
        ("ok", "o1", "a1", "c", "T", "ch", date(2024, 2, 1)),
        ("late", "o1", "a1", "c", None, "ch", date(2024, 3, 2)),
        ("no_date", "o1", "x", "c", None, "ch", None),
        ("no_type", "zz", "x", "c", None, "ch", date(2024, 2, 1)),
        ("mismatch", "o1", "x", "c", "T", "ch", date(2024, 2, 1)),
        ("null_account", "o1", None, "c", "T", "ch", date(2024, 2, 1)),
        ("orphan", "zz", "a1", "c", "T", "ch", date(2024, 2, 1)),
        ("dup1", "o2", "a2", "c", "T", "ch", date(2024, 2, 1)),
        ("dup2", "o2", "a2", "c", "T", "ch", date(2024, 2, 1)),
        ("null_dup1", "o2", "a2", None, "T", "ch", date(2024, 2, 2)),
        ("null_dup2", "o2", "a2", None, "T", "ch", date(2024, 2, 2)),
    ]
    issues = touch_quality.touchpoint_issues(deals, touch_quality.clean_touchpoints(touches(spark, data)))
    assert dict(rows(issues, "touchpoint_id", "issue_type")) == {
        "late": "touch_after_close",
        "no_date": "missing_touch_date",
        "no_type": "missing_campaign_type",
        "mismatch": "account_mismatch",
        "null_account": "account_mismatch",
        "orphan": "opportunity_not_found",
        "dup1": "duplicate_touchpoint",
        "dup2": "duplicate_touchpoint",
        "null_dup1": "duplicate_touchpoint",
        "null_dup2": "duplicate_touchpoint",
    }


def test_deal_listed_twice_repeats_its_touches(spark, deals, rows):
    data = [("t", "o2", "a2", "c", "T", "ch", date(2024, 2, 1))]
    twice = deals.unionByName(deals.where("opportunity_id = 'o2'"))
    issues = touch_quality.touchpoint_issues(twice, touches(spark, data))
    assert rows(issues, "touchpoint_id", "issue_type") == [("t", "duplicate_touchpoint")] * 2


def test_text_dates_are_read_or_null(spark, rows):
    df = spark.createDataFrame(
        [("t1", "2024-02-01"), ("t2", "soon"), ("t3", None)], "touchpoint_id string, touch_date string"
    ).withColumns({"campaign_type": F.lit(None).cast("string"), "channel": F.lit("web")})
    clean = touch_quality.clean_touchpoints(df)
    assert [r[0] is None for r in rows(clean.orderBy("touchpoint_id"), "touch_date")] == [False, True, True]
    assert {r[0] for r in rows(clean, "campaign_type")} == {"Unknown"}


def test_validation_is_sequential(spark, deals, rows):
    data = [
        ("orphan", "zz", "a1", "c", None, "ch", date(2024, 2, 1)),
        ("mismatch", "o1", None, "c", None, "ch", date(2024, 2, 1)),
        ("no_type", "o1", "a1", "c1", None, "ch", date(2024, 2, 1)),
        ("late_no_type", "o1", "a1", "c", None, "ch", date(2024, 5, 1)),
        ("open", "o2", "a2", "c", "T", "ch", date(2024, 2, 1)),
        ("no_date", "o1", "a1", "c", "T", "ch", None),
        ("dup_b", "o1", "a1", "c2", "T", "ch", date(2024, 2, 2)),
        ("dup_a", "o1", "a1", "c2", "T", "other", date(2024, 2, 2)),
    ]
    result = touch_quality.validate_touchpoints(deals, touches(spark, data))
    assert rows(result.valid, "touchpoint_id") == [("dup_a",), ("no_type",)]
    assert rows(result.anomalies, "touchpoint_id", "anomaly_type") == [
        ("dup_a", "duplicate_touchpoint"),
        ("dup_b", "duplicate_touchpoint"),
        ("late_no_type", "missing_campaign_type"),
        ("late_no_type", "touch_after_close"),
        ("mismatch", "account_mismatch"),
        ("no_type", "missing_campaign_type"),
        ("orphan", "opportunity_not_found"),
    ]


def test_sequence_puts_missing_dates_last(spark, deals, rows):
    data = [
        ("t3", "o2", "a2", "c1", "T", "ch", None),
        ("t2", "o2", "a2", "c1", "T", "ch", date(2024, 2, 1)),
        ("t1", "o2", "a2", "c2", "T", "ch", date(2024, 2, 1)),
        ("t0", "o2", "a2", "c3", "T", "ch", date(2024, 2, 5)),
    ]
    result = fact(spark, deals, data)
    assert rows(result, "touch_sequence", "touchpoint_id", "is_first_touch", "is_last_touch", "days_before_close_or_today") == [
        (1, "t1", True, False, 150),
        (2, "t2", False, False, 150),
        (3, "t0", False, False, 146),
        (4, "t3", False, True, None),
    ]


@pytest.mark.parametrize(
    "count, weights", [(1, [1.0]), (2, [0.5, 0.5]), (3, [0.4, 0.2, 0.4]), (4, [0.4, 0.1, 0.1, 0.4])]
)
def test_position_weights(spark, deals, count, weights):
    data = [(f"t{n}", "o2", "a2", "c", "T", "ch", date(2024, 2, 1 + n)) for n in range(count)]
    result = attribution.assign_influence(fact(spark, deals, data)).orderBy("touch_sequence").collect()
    assert [round(r.position_weight, 9) for r in result] == weights
    assert [round(r.weighted_influence, 9) for r in result] == [w * 100 for w in weights]
    assert [r.even_touch_influence for r in result] == [100.0 / count] * count


def random_touches(seed):
    rng = random.Random(seed)
    return [
        (f"t{n}", f"o{1 + int(rng.random() ** 3 * 3)}", "a1", f"c{rng.randrange(4)}", "T", rng.choice(["x", None]), date(2024, 1, 1 + rng.randrange(28)))
        for n in range(200)
    ]


def test_models_add_up_and_do_not_depend_on_partitions(spark, deals):
    same_account = deals.withColumn("account_id", F.lit("a1"))
    clean = touch_quality.clean_touchpoints(touches(spark, random_touches(1)))
    results = []
    for partitions in (3, 7):
        long = attribution.attribution_by_model(
            attribution.touchpoint_fact(same_account, clean.repartition(partitions), AS_OF)
        )
        scaled = attribution.normalise_allocations(long)
        assert attribution.allocation_errors(scaled).count() == 0
        results.append(sorted(scaled.collect()))
    assert results[0] == results[1]


def test_unscaled_two_touch_deal_misses_a_fifth(spark, deals, rows):
    data = [(f"t{n}", "o2", "a2", "c", "T", "ch", date(2024, 2, 1 + n)) for n in range(2)]
    errors = attribution.allocation_errors(attribution.attribution_by_model(fact(spark, deals, data)))
    assert rows(errors, "model", "allocated_revenue") == [("POSITION_WEIGHTED", 80.0)]


def test_summary_keeps_groups_and_counts_deals_once(spark, deals, rows):
    data = [
        ("t1", "o1", "a1", "c1", None, "ch", date(2024, 2, 1)),
        ("t2", "o1", "a1", "c2", None, "ch", date(2024, 2, 2)),
        ("t3", "o2", "a2", "c2", "T", None, date(2024, 2, 2)),
    ]
    summary = attribution.influence_summary(attribution.assign_influence(fact(spark, deals, data)))
    assert rows(summary, "campaign_type", "channel", "touchpoints", "opportunities", "weighted_pipeline") == [
        ("T", "Unknown", 1, 1, 100.0),
        ("Unknown", "ch", 2, 1, 900.0),
    ]


def test_anomalies_join_touches_twice(spark, deals):
    """Once for the rows of all types, once for the repeated keys."""
    found = touch_quality.validate_touchpoints(deals, touches(spark, [])).anomalies
    assert found._jdf.queryExecution().analyzed().toString().count("AS deal_found") == 2


def test_fact_goes_on_with_kept_columns(spark, deals, rows):
    data = [(f"t{n}", "o1", "a1", f"c{n}", "T", "ch", date(2024, 1, 2 + n % 3)) for n in range(5)]
    whole = fact(spark, deals, data)
    kept = fact(spark, deals, data, keep=attribution.CREDITED)
    assert not {"campaign_type", "created_at", "stage_name", "account_id"} & set(kept.columns)
    assert rows(attribution.attribution_by_model(kept)) == rows(attribution.attribution_by_model(whole))


def test_normalised_rows_do_not_move(spark, deals, rows):
    """Touches become a row for each model last: no shuffle, sort or join after that."""
    found = attr_normalized(SimpleNamespace(opportunities=deals, touchpoints=touches(spark, random_touches(2))))
    plan = found._jdf.queryExecution().executedPlan().toString()
    above, *rest = plan.split("Generate explode")
    assert len(rest) == 1
    assert not any(node in above for node in ("Exchange", "Sort", "Join"))


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_deal_credit_scales_as_sums_of_rows_do(spark, deals, rows, monkeypatch, ranges):
    """Also for deals that ranges cut, deals listed twice with other amounts, and touches without id or date."""
    listed = deals.unionByName(deals.where("opportunity_id = 'o1'").withColumn("amount", F.lit(70.0)).withColumn("account_id", F.lit("a2")))
    listed = listed.withColumn("account_id", F.when(F.col("opportunity_id") == "o1", F.col("account_id")).otherwise("a1"))
    data = [
        (None if n % 9 == 0 else t[0], t[1], "a2" if t[1] == "o1" and n % 3 == 0 else t[2], *t[3:6], None if t[1] == "o2" and n % 5 == 0 else t[6])
        for n, t in enumerate(random_touches(3))
    ]
    whole = timeline.order_by_ranges
    monkeypatch.setattr(attribution, "order_by_ranges", lambda *args, **options: whole(*args, **options, ranges=ranges))
    results = [
        attribution.normalise_allocations(
            attribution.attribution_by_model(fact(spark, listed, data, keep=attribution.CREDITED, deal_credit=deal_credit))
        )
        for deal_credit in (False, True)
    ]
    assert results[0].columns == results[1].columns
    assert rows(results[0]) == rows(results[1])
    assert {r.model for r in results[1].collect()} == set(attribution.DEAL_CREDIT)
    assert results[1].groupBy("opportunity_id").agg(F.countDistinct("amount").alias("n")).where("n > 1").count() == 1


def test_fact_picks_from_columns_that_decide(spark, deals, rows, monkeypatch):
    """Touches are joined without columns that nobody keeps; the row that stays of equal ones is the same."""
    ranged = []
    monkeypatch.setattr(timeline, "written", lambda df, name, write=timeline.written: ranged.append(df) or write(df, name))
    twice = deals.unionByName(deals.where("opportunity_id = 'o2'").withColumn("amount", F.lit(7.0)))
    data = [("t1", "o2", "a2", "c", kind, "ch", date(2024, 2, 1)) for kind in ("U", None, "T")]
    whole = fact(spark, twice, data)
    kept = fact(spark, twice, data, keep=attribution.CREDITED)
    assert rows(kept) == rows(whole.select(kept.columns)) and kept.count() == 1
    plans = [df._jdf.queryExecution().optimizedPlan().toString().splitlines() for df in ranged]
    assert [any("Aggregate" in line and "campaign_type" in line for line in plan) for plan in plans] == [True, False]
    assert "campaign_type" in fact(spark, twice, data, keep=["campaign_type"]).columns
    wide = touches(spark, data).selectExpr("*", "length(campaign_type) as a", "-length(campaign_type) as b")
    wide = wide.withColumn("a", F.when(F.col("campaign_type") == "U", 0).otherwise(1))
    picks = [
        attribution.touchpoint_fact(deals, wide.drop("campaign_type"), AS_OF, keep=keep).head()["b"] for keep in (None, ["b"])
    ]
    assert picks[0] == picks[1]


def test_ranges_let_go_of_their_shuffle_files(spark, deals, monkeypatch):
    done = []
    monkeypatch.setattr(timeline, "written", lambda df, name, write=timeline.written: done.append("written") or write(df, name))
    monkeypatch.setattr(timeline, "release_shuffles", lambda session: done.append("released"))
    fact(spark, deals, random_touches(4))
    assert done == ["written", "released"]
