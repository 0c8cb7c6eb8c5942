"""Shape of the physical plans: what is read, what is shuffled, how often."""

import os
import re

import pytest

import __spark_entry__ as contract
from staffcast.catalog.bindings import Bindings
from staffcast.catalog.queries import plan_inputs

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables not present")


def plan_of(spark, name):
    return contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "calls_monthly_quantity")
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line)
    assert "EqualTo(l_returnflag,R)" in scan
    assert set(re.search("ReadSchema: struct<(.*)>", scan).group(1).split(",")) == {
        "l_suppkey:bigint", "l_quantity:double", "l_returnflag:string", "l_shipdate:timestamp_ntz",
    }


def test_sums_are_partial_before_the_shuffle(spark):
    plan = plan_of(spark, "daily_tickets")
    assert re.search(r"Exchange hashpartitioning\(department_id.*\n.*partial_sum", plan)


@pytest.mark.parametrize("name, key", [("inherited_backlog", "case_number"), ("agent_days_by_day", "agent_id")])
def test_distinct_counts_spread_one_large_department(spark, name, key):
    exchanges = [line for line in plan_of(spark, name).splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and key in exchanges[-1] and key not in exchanges[0]


def test_latest_rows_are_cut_before_the_shuffle(spark):
    assert re.search(r"WindowGroupLimit .*Partial", plan_of(spark, "recent_deflection_rate"))


def test_names_are_looked_up_after_summing(spark):
    plan = plan_of(spark, "calls_monthly_by_team")
    lookup = plan.index("BroadcastHashJoin [department_name")
    assert plan.index("partial_count(1)") > lookup


def test_series_are_spread_for_fitting(spark):
    plan = plan_of(spark, "stl_daily_forecast")
    assert "REPARTITION_BY_NUM" in plan and plan.count("FlatMapGroupsInPandas") == 1


def test_dispatch_scans_the_tickets_once(spark):
    df = contract.queries()["engine_dispatch"](spark, FOLDER)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet.*orders\.parquet", final)) == 1


@pytest.mark.parametrize("name", ["deflection_monthly_form", "historical_capacity_hours", "backlog_monthly_form"])
def test_lines_are_summed_before_the_lookup(spark, name):
    lines = plan_of(spark, name).splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "lineitem" in line)
    above = [line for line in reversed(lines[:scan]) if "Join" in line or "HashAggregate" in line]
    assert "partial_sum" in above[0]


@pytest.mark.parametrize("name", ["capacity_projection", "capacity_projection_from_actuals", "expected_volumes_calibrated"])
def test_facts_used_twice_are_kept_first(spark, name):
    plan = plan_of(spark, name)
    assert len(re.findall(r"FileScan parquet.*lineitem\.parquet", plan)) <= 1
    assert len(re.findall(r"FileScan parquet.*orders\.parquet", plan)) <= 1


def test_no_sums_travel_by_agent(spark):
    below = plan_of(spark, "agent_days_by_day").split("Exchange hashpartitioning(department_id")[-1]
    assert "agent_id" in below and "lineitem" in below
    assert "partial_sum" not in below and "partial_avg" not in below


def test_a_plan_sums_the_lines_once_for_two_inputs(spark):
    bound = Bindings(spark, FOLDER)
    given, fresh = plan_inputs(bound), (bound.deflection(), bound.capacity_history("productive"))
    for kept, made in zip((given.deflection, given.capacity_history), fresh, strict=True):
        assert "lineitem" not in kept._jdf.queryExecution().executedPlan().toString()
        values = [sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in x.collect()) for x in (kept, made)]
        assert kept.columns == made.columns and values[0] == values[1]
