import datetime as dt

import pytest

from staffcast import PlanParams
from staffcast.plans.monthly_run import read_inputs, run_monthly

DAY = dt.date(2025, 11, 1)


def test_folder_in_folder_out(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    tickets = [(str(DAY + dt.timedelta(days=i)), d, 4) for d in (1, 2) for i in range(70)]
    spark.createDataFrame(tickets, "Date string, department_id int, count int").write.parquet(f"{source}/incoming.parquet")
    names = spark.createDataFrame([(1, "Alpha", "Payments"), (2, "Beta", "Partners")], "department_id int, Department string, Vertical string")
    names.write.option("header", True).csv(f"{source}/department_map.csv")
    spark.createDataFrame([(1, "2025-12-02", 3)], "department_id int, Date string, RR int").write.option("header", True).csv(f"{source}/repeats.csv")
    report = spark.createDataFrame([(1, "SARIMAX-7"), (2, "SARIMAX-7")], "department_id int, Recommended_Model string")
    report.write.parquet(f"{target}/recommended_models")
    spark.createDataFrame([(2, "STL")], "department_id int, model string").write.option("header", True).csv(f"{source}/manual_labels.csv")

    run_monthly(spark, source, target, PlanParams(as_of="2026-01-15"))
    run_monthly(spark, source, target, PlanParams(as_of="2026-01-15"))  # a second run replaces the first
    daily = spark.read.parquet(f"{target}/Daily_Forecast")
    assert {(r.department_id, r.engine_used) for r in daily.collect()} == {(1, "SARIMAX-7"), (2, "STL")}
    log = {r.stage: r.rows for r in spark.read.parquet(f"{target}/run_log").collect()}
    assert log["repeats"] == 1 and log["daily_forecast"] == 730 and log["deflection"] == 0
    assert spark.read.parquet(f"{target}/boards").count() == 22
    # 2025-11 and 2025-12 are history of an earlier year, so the report starts with the forecast
    months = spark.read.parquet(f"{target}/workload_report").select("Month").distinct().collect()
    assert min(m[0] for m in months) == dt.date(2026, 1, 1)
    assert not (tmp_path / "out" / "Monthly_Inventory").exists()


def test_months_gone_by_stay(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    tickets = [(str(DAY + dt.timedelta(days=i)), 1, 4) for i in range(70)]
    spark.createDataFrame(tickets, "Date string, department_id int, count int").write.parquet(f"{source}/incoming.parquet")
    spark.createDataFrame([(1, "Alpha", "Payments")], "department_id int, Department string, Vertical string").write.parquet(f"{source}/department_map")
    params = PlanParams(as_of="2026-01-15", fit_series=False)
    run_monthly(spark, source, target, params, by_month=True)
    first = {r.month: r.forecast_p50 for r in spark.read.parquet(f"{target}/Monthly_Forecast_RAW").collect()}
    later = [(str(DAY + dt.timedelta(days=i)), 1, 8) for i in range(40, 100)]
    spark.createDataFrame(later, "Date string, department_id int, count int").write.mode("overwrite").parquet(f"{source}/incoming.parquet")
    run_monthly(spark, source, target, params, by_month=True)
    second = {r.month: r.forecast_p50 for r in spark.read.parquet(f"{target}/Monthly_Forecast_RAW").collect()}
    gone = dt.date(2026, 1, 1)
    assert min(first) == gone and second[gone] == first[gone] and second[dt.date(2026, 3, 1)] == 2 * first[dt.date(2026, 3, 1)]
    # actuals of the months that the second run no longer has stay too
    assert {r.month for r in spark.read.parquet(f"{target}/Monthly_Actuals").collect()} == {DAY, dt.date(2025, 12, 1), dt.date(2026, 2, 1), gone}


def test_required_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="incoming, department_map"):
        read_inputs(spark, str(tmp_path), str(tmp_path))
