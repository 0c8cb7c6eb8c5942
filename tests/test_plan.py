"""The whole plan on small invented inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staffcast import PlanInputs, PlanParams, run_workforce_plan
from staffcast.sources.sinks import write_tables

DAY = dt.date(2025, 10, 1)


@pytest.fixture(scope="module")
def given(spark):
    tickets = [(DAY + dt.timedelta(days=i), d, float(5 + d + i % 7)) for d in (1, 2, 3, 4) for i in range(100)]
    return PlanInputs(
        incoming=spark.createDataFrame(tickets, "Date date, department_id int, ticket_total double"),
        department_map=spark.createDataFrame(
            [(1, "Alpha", "Payments"), (2, "Beta", "Partners"), (3, "Proj x", "Payments"), (4, "Delta", "Other")],
            "department_id int, department_name string, vertical string",
        ),
        deflection=spark.createDataFrame(
            [(2025, m, 1, 30.0) for m in (10, 11, 12)], "Year int, Month int, department_id int, Not_Reopened double"
        ),
        calls=spark.createDataFrame([(dt.date(2025, 12, 3), "Alpha ", 40)], "`Created Date` date, `User Team` string, Qty int"),
        backlog_monthly=spark.createDataFrame([(1, dt.date(2025, 12, 1), 6)], "department_id int, month_start date, inherited_cases int"),
        capacity_history=spark.createDataFrame([(dt.date(2025, 12, 1), 2, 70.0)], "MonthStartDate date, department_id int, productive double"),
        manual_labels=spark.createDataFrame([(2, "SARIMAX-7")], "department_id int, model string"),
    )


@pytest.fixture(scope="module")
def tables(spark, given):
    return run_workforce_plan(spark, given, PlanParams(as_of="2026-02-01"))


def test_scope_horizon_and_engines(tables):
    daily = tables["Daily_Forecast"]
    got = {r[0]: r[1:] for r in daily.groupBy("department_id").agg(
        F.count("*"), F.min("date"), F.first("engine_used"), F.first("path_used")).collect()}
    first = DAY + dt.timedelta(days=100)
    assert got == {1: (365, first, "Baseline(STL)", "stl"), 2: (365, first, "SARIMAX-7", "sarima")}


def test_forecast_follows_the_weekly_pattern(tables):
    ahead = [r.p50 for r in tables["Daily_Forecast"].where("department_id = 1").orderBy("date").limit(14).collect()]
    assert ahead == pytest.approx([6 + (100 + i) % 7 for i in range(14)], rel=0.02)


def test_adjusted_months(tables):
    rows = tables["Monthly_Forecast_CAL"].orderBy("department_id", "month").collect()
    alpha = [r for r in rows if r.department_id == 1]
    volumes = {r.month: r.actual_volume for r in tables["Monthly_Actuals"].where("department_id = 1").collect()}
    # January is the latest month with volume but without solved tickets
    months = sorted(volumes)[-3:]
    rate = sum((30.0 if m.year == 2025 else 0.0) / volumes[m] for m in months) / 3
    for r in alpha:
        assert r.deflection_rate_recent == pytest.approx(rate)
        assert r.calib_factor == pytest.approx(1 - 0.58 / 100)
        assert r.forecast_p50_post_deflection_cal == pytest.approx(r.forecast_p50 * (1 - rate) * (1 - 0.0058))
        assert r.forecast_p05 <= r.forecast_p50 <= r.forecast_p95
    assert {r.inventory_final for r in alpha if r.month <= dt.date(2026, 12, 1)} == {6.0}
    assert all(r.inventory_final == 0.0 for r in rows if r.department_id == 2)


def test_reports(tables):
    report = tables["workload_report"]
    alpha = {r["Month"]: r for r in report.where("Department_name = 'Alpha'").collect()}
    # the partly elapsed January is in the forecast, so no month is history only
    assert min(alpha) == dt.date(2026, 1, 1) and len(alpha) == 13
    march = alpha[dt.date(2026, 3, 1)]
    parts = ["Forecast after deflection (Human cases)", "Calls not indexed (forecast)", "Repeats (forecast)", "Inventory"]
    total = march["Workload Forecast (Humans + calls not indexed + repeats + inventory)"]
    assert total == pytest.approx(sum(march[p] for p in parts))
    assert march["Calls not indexed (forecast)"] > 0 and march["Capacity"] is None
    beta = {r["Month"]: r for r in tables["capacity_report"].where("Department_name = 'Beta'").collect()}
    # history 70 hours x 6, projected over the 12 months after the latest actual month (January)
    assert beta[dt.date(2026, 2, 1)]["Capacity"] == 420.0 and beta[dt.date(2026, 2, 1)]["Productivity"] == 420.0
    assert tables["boards"].count() == 2 * 11
    assert tables["board_kpis_long"].count() == 2 * 14 * 10


def test_run_log_and_sinks(spark, tables, tmp_path):
    log = {r.stage: r.rows for r in tables["run_log"].collect()}
    assert log["daily_tickets"] == 200 and log["daily_forecast"] == 730 and log["engine_failures"] == 0
    assert log["repeats"] == 0 and log["calls"] == 1 and log["monthly_forecast"] == tables["Monthly_Forecast_RAW"].count()
    assert log["calibrated_rows"] == log["facts"] == 26 and log["label_conflicts"] == 0 and log["backlog_forecast"] == 12
    # the counts were observed, so nothing is scanned again
    assert "FileScan" not in tables["run_log"]._jdf.queryExecution().executedPlan().toString()
    names = write_tables(tables, str(tmp_path), skip_if_empty=("Monthly_Inventory",))
    assert "Monthly_Inventory" not in names and len(names) == len(tables) - 1 and "Implausible_Series" in names
    assert spark.read.parquet(f"{tmp_path}/workload_report").count() == 26
    assert spark.read.parquet(f"{tmp_path}/Model_Used_and_Error").count() == 16


def test_uplift_switch_and_history_months(spark, given):
    params = PlanParams(as_of="2025-12-31", uplift_by_calls=True, fit_series=False)
    tables = run_workforce_plan(spark, given, params)
    december = tables["Monthly_Actuals"].where("department_id = 1").where(F.col("month") == F.lit(dt.date(2025, 12, 1))).first()
    assert december.actual_volume == sum(6 + i % 7 for i in range(61, 92)) + 40
    months = [r[0] for r in tables["workload_report"].where("Department_name = 'Alpha'").orderBy("Month").select("Month").collect()]
    assert months[:4] == [dt.date(2025, 10, 1), dt.date(2025, 11, 1), dt.date(2025, 12, 1), dt.date(2026, 1, 1)]


def test_duplicate_department_is_refused(spark, given):
    twice = given.department_map.unionByName(spark.createDataFrame([(1, "Alpha 2", "Payments")], given.department_map.schema))
    with pytest.raises(ValueError, match="department 1 is listed 2 times"):
        run_workforce_plan(spark, PlanInputs(given.incoming, twice), PlanParams(as_of="2026-02-01"))


def test_only_required_inputs(spark, given):
    tables = run_workforce_plan(
        spark, PlanInputs(given.incoming, given.department_map), PlanParams(as_of="2026-02-01", fit_series=False)
    )
    rows = tables["workload_report"].collect()
    assert len(rows) == 26 and all(r["Capacity"] is None for r in rows)
    assert all(r["Inventory"] == 0 and r["Deflected forecast"] == 0 for r in rows)


def test_conflicting_labels_are_listed(spark, given):
    manual = spark.createDataFrame([(2, "STL", 1), (2, "SARIMAX-7", 2), (1, "STL", 1)], "department_id int, model string, sequence int")
    report = spark.createDataFrame([(1, "A"), (1, "B")], "department_id int, Recommended_Model string")
    tables = run_workforce_plan(
        spark, PlanInputs(given.incoming, given.department_map, manual_labels=manual, previous_report=report), PlanParams(as_of="2026-02-01"))
    got = {tuple(r) for r in tables["Label_Conflicts"].collect()}
    assert got == {("manual", 2, 2, "SARIMAX-7, STL", "SARIMAX-7", "sequence"), ("previous", 1, 2, "A, B", "B", "alphabet")}
    assert {(r[0], r[1]) for r in tables["Daily_Forecast"].select("department_id", "engine_used").distinct().collect()} == {(1, "STL"), (2, "SARIMAX-7")}
    assert {r.stage: r.rows for r in tables["run_log"].collect()}["label_conflicts"] == 2
