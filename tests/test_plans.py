"""Shape of the physical plans when no side is small enough to be broadcast."""

import re

import pytest

from workload import registry

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(n for n in registry.queries() if not n.startswith("store_"))


@pytest.fixture
def large_tables(spark):
    """Treat every table as too large for a broadcast."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield spark
    for key in keys:
        spark.conf.unset(key)


def planned(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("name", NAMES)
def test_no_pairing_of_all_rows(large_tables, name):
    plan = planned(registry.queries()[name](large_tables, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # Only lists with a bound are broadcast by hand: busy keys, keys that a range boundary cuts.
    broadcasts = re.findall(r"BroadcastHashJoin \[([^\]]*)\], \[([^\]]*)\], (\w+)", plan)
    assert all(kind in ("LeftOuter", "LeftSemi") for _, _, kind in broadcasts)


def test_scans_read_needed_columns_only(spark):
    plan = planned(registry.queries()["reach_cumulative"](spark, FOLDER))
    assert "FileScan parquet [user_id,event_type,props]" in plan


def test_reach_reduces_users_before_groups(spark):
    plan = planned(registry.queries()["reach_summary"](spark, FOLDER))
    assert "hashpartitioning(cg_id, cg_name, uniq_imp_id" in plan


def test_one_pass_over_a_checked_table(spark):
    plan = planned(registry.queries()["health_freshness"](spark, FOLDER))
    assert plan.count("FileScan") == 2


@pytest.mark.parametrize("name", ["attr_summary", "attr_top8", "attr_quality_flags"])
def test_attribution_bounds_its_tasks_in_any_session(spark, name):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64m")
    registry.queries()[name](spark, FOLDER)
    assert spark.conf.get(key) == "16m"
