import datetime as dt

import pytest
from pyspark.sql import functions as F

from staffcast.operators import report
from staffcast.sources.sinks import Stages, read_months, shared_folder, write_boards, write_months, write_tables

JAN, FEB, MAR = (dt.date(2026, m, 1) for m in (1, 2, 3))
SCHEMA = (
    "vertical string, department_id bigint, department_name string, month date, forecast double, "
    "actual_volume double, capacity double, productivity double, inventory_mean double"
)


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([
        ("v", 1, "A/B", JAN, 110.5, 100.0, 200.0, 50.0, 2.345),
        ("v", 1, "A/B", FEB, 90.0, 0.0, 0.0, 50.0, None),
        ("v", 1, "A/B", MAR, 80.0, None, None, None, 1.0),
        ("v", 2, "C", dt.date(2020, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0),
        ("v", 3, None, JAN, 1.0, 1.0, 1.0, 1.0, 1.0),
    ], SCHEMA)


def test_board_months(facts):
    months = report.board_months(facts)
    assert months.count() == 2 * 14
    got = {(r.department_name, r.month): r.asDict() for r in months.collect()}
    first = got["A/B", JAN]
    assert first["Forecast"] == 110.0 and first["Actual Volume"] == 100.0
    assert first["Forecast Accuracy"] == 89.5 and first["Forecast Error %"] == 10.5
    assert first["Difference Capacity vs Productivity"] == 75.0
    assert first["Expected Forecast vs Capacity"] == -90.0
    assert first["Actual vs Productivity %"] == 50.0 and first["Inventory"] == 2.34
    zero = got["A/B", FEB]
    assert zero["Forecast Accuracy"] is None and zero["Difference Capacity vs Productivity"] == 0.0
    future = got["A/B", MAR]
    assert future["Actual Volume"] is None and future["Capacity"] is None
    assert got["C", JAN]["Forecast"] is None and got["C", JAN]["Difference Capacity vs Productivity"] == 0.0


def test_zero_fill_gives_zero_sums_for_existing_months(facts):
    months = report.board_months(facts, zero_fill=True)
    got = {(r.department_name, r.month): r["Actual Volume"] for r in months.collect()}
    assert got["A/B", MAR] == 0.0 and got["C", JAN] is None


def test_long_and_wide_boards(facts):
    months = report.board_months(facts)
    long = report.board_long(months)
    assert long.columns == ["Month", "department_id", "department_name", "KPI", "Total"]
    assert long.count() == 2 * 14 * 10
    wide = report.board_wide(months)
    assert wide.columns[3:] == report.board_labels() and report.board_labels()[0] == "01-26"
    assert report.board_labels()[-1] == "02-27" and len(report.board_labels()) == 14
    assert wide.count() == 2 * 11
    row = wide.where("KPI = 'Forecast' and department_name = 'A/B'").first()
    assert (row["01-26"], row["02-26"], row["04-26"]) == (110.0, 90.0, None)
    comments = wide.where("KPI = 'Comments'").first()
    assert all(comments[label] is None for label in report.board_labels())


def test_gap_text(facts):
    texts = {(r.department_name, r.month): r.capacity_gap for r in report.capacity_gap_text(report.board_months(facts)).collect()}
    assert texts["A/B", JAN] == "75%" and texts["A/B", MAR] == "0%"


def test_names_are_sorted(facts):
    assert [r[0] for r in report.department_names(facts).collect()] == ["A/B", "C"]


def test_capacity_report(facts):
    out = report.capacity_report(facts.withColumn("deflected_forecast", F.lit(2.5)))
    row = out.where(F.col("Month") == F.lit(JAN)).where("Department_name = 'A/B'").first()
    assert row["Actual Volume vs Productivity"] == 50.0 and row["Forecast accuracy"] == pytest.approx(0.105)
    assert row["Difference Capacity vs Productivity"] == -150.0 and row["Expected Forecast vs Capacity"] == -89.5
    zero = out.where(F.col("Month") == F.lit(FEB)).first()
    assert zero["Forecast accuracy"] is None
    assert len(out.columns) == 13


def test_workload_rows(spark):
    df = spark.createDataFrame([
        (10.0, 1.0, 2.0, 8.0, 3.0, 4.0, 5.0, 15.0), (10.0, None, None, None, None, None, None, None),
    ], "actual_volume double, calls_not_indexed_actual double, repeats_actual double, forecast_human_cases_cal double, "
       "calls_not_indexed_forecast double, repeats_forecast double, inventory_final double, capacity double")
    got = [(r.actual_workload, r.workload_forecast, r.workload_minus_capacity) for r in report.workload_rows(df).collect()]
    assert got == [(13.0, 20.0, 5.0), (10.0, None, None)]


def test_history_only_months(spark):
    keys = "vertical string, department_id bigint, department_name string, month date"
    actuals = spark.createDataFrame([("v", 1, "a", m, 5.0) for m in (JAN, FEB, dt.date(2025, 12, 1))], keys + ", actual_volume double")
    forecast = spark.createDataFrame([("v", 1, "a", FEB, 9.0, 5.0)], keys + ", forecast double, actual_volume double")
    assert [r.month for r in report.history_only_months(actuals, forecast, 2026).collect()] == [JAN]
    both = {r.month: (r.forecast, r.actual_volume) for r in report.add_history_months(forecast, actuals, 2026).collect()}
    assert both == {JAN: (None, 5.0), FEB: (9.0, 5.0)}


def test_tables_are_replaced_and_empty_ones_skipped(spark, tmp_path):
    write_tables({"a": spark.range(5), "b": spark.range(0)}, str(tmp_path), skip_if_empty=("b",))
    names = write_tables({"a": spark.range(2), "b": spark.range(0)}, str(tmp_path), skip_if_empty=("b",))
    assert names == ["a"] and spark.read.parquet(f"{tmp_path}/a").count() == 2
    assert not (tmp_path / "b").exists()
    assert write_tables({"b": spark.range(0)}, str(tmp_path)) == ["b"]


def test_boards_get_one_folder_each(facts, spark, tmp_path):
    write_boards(report.board_wide(report.board_months(facts)), f"{tmp_path}/boards")
    folders = sorted(p.name for p in (tmp_path / "boards").iterdir() if p.is_dir())
    assert folders == ["department_id=1", "department_id=2"]
    assert spark.read.parquet(f"{tmp_path}/boards").count() == 22


def test_names_with_one_beginning_keep_boards_of_their_own(facts, spark, tmp_path):
    long = F.concat(F.lit("Specialists of the second level "), F.col("department_name"))
    write_boards(report.board_wide(report.board_months(facts)).withColumn("department_name", long), f"{tmp_path}/boards")
    back = spark.read.parquet(f"{tmp_path}/boards").groupBy("department_id").agg(F.count("*").alias("n"), F.first("board_key").alias("k"))
    assert {(r.department_id, r.n, r.k) for r in back.collect()} == {(d, 11, "Board_Specialists of the second") for d in (1, 2)}


def test_stages_use_the_shared_folder(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    stages = Stages(spark)
    kept = stages.keep_all({"x": spark.range(3), "y": spark.range(4)})
    assert kept["x"].count() == 3 and kept["y"].count() == 4
    assert stages.folder.startswith(shared_folder(spark))


MONTHS_SCHEMA = "department_id bigint, volume double, month date"


def test_a_rerun_replaces_only_its_months(spark, tmp_path):
    path = f"{tmp_path}/months"
    write_months(spark.createDataFrame([(1, 1.0, JAN), (2, 2.0, JAN), (1, 3.0, FEB), (1, 4.0, MAR), (9, 9.0, None)], MONTHS_SCHEMA), path)
    write_months(spark.createDataFrame([(1, 30.0, FEB), (3, 31.0, FEB)], MONTHS_SCHEMA), path, files_per_month=3)
    write_months(spark.createDataFrame([], MONTHS_SCHEMA), path)
    got = {(r.department_id, r.volume, r.month) for r in read_months(spark, path, MONTHS_SCHEMA).collect()}
    assert got == {(1, 1.0, JAN), (2, 2.0, JAN), (1, 30.0, FEB), (3, 31.0, FEB), (1, 4.0, MAR), (9, 9.0, None)}


def test_a_range_of_months_opens_no_other_folder(spark, tmp_path):
    path = f"{tmp_path}/months"
    write_months(spark.createDataFrame([(1, float(m), dt.date(2026, m, 1)) for m in range(1, 13)], MONTHS_SCHEMA), path)
    rows = read_months(spark, path, MONTHS_SCHEMA, "2026-03-01", "2026-05-01")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "month#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert sorted(r.volume for r in rows.collect()) == [3.0, 4.0, 5.0]
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 3


def test_stages_count_rows_while_they_write(spark, facts):
    stages = Stages(spark)
    kept = stages.keep_all({"facts": facts, "none": facts.where("false"), "empty": spark.createDataFrame([], "a int")},
                           facts={"named": F.count("department_name")})
    assert stages.metrics == {"facts": {"rows": 5, "named": 4}, "none": {"rows": 0}, "empty": {"rows": 0}}
    assert kept["facts"].count() == 5
