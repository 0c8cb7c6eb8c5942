import datetime as dt

import pytest
from pyspark.sql import functions as F

from staffcast.operators import backtest, forecasts, reference_data
from staffcast.plans.backtest_run import run_backtest
from staffcast.plans.monthly_run import read_inputs

JAN = dt.date(2024, 1, 1)


def by_month(tested):
    return {(r.department_id, str(r.month), r.engine): r for r in tested.collect()}


def test_backtest_of_a_weekly_pattern_has_no_error(daily):
    values = [4 + i % 7 for i in range(366)]
    table = daily({1: (JAN, values), 2: (dt.date(2024, 7, 20), [3] * 60)})
    months = ["2024-06-01", "2024-08-01", "2024-09-01"]
    got = by_month(backtest.backtest_months(table, months, (backtest.NAIVE, *backtest.ENGINES)))
    assert len(got) == 2 * 3 * 3
    for engine in (backtest.NAIVE, "STL"):
        august = got[1, "2024-08-01", engine]
        assert (august.forecast, august.actual) == pytest.approx((sum(values[213:244]),) * 2, rel=1e-6)
    for engine in (backtest.NAIVE, *backtest.ENGINES):
        # the second department has no days before June; the month stays, without a forecast
        june = got[2, "2024-06-01", engine]
        assert (june.has_forecast, june.forecast, june.path_used, june.actual) == (False, None, None, 0.0)
        assert got[2, "2024-09-01", engine].actual == 3 * 17


@pytest.mark.parametrize("silent", [0, 45, 92])
def test_horizon_reaches_over_a_silent_spell(daily, silent):
    before = (dt.date(2024, 7, 1) - JAN).days - silent
    table = daily({1: (JAN, [10] * before + [None] * silent + [10] * 31)})
    got = by_month(backtest.backtest_months(table, ["2024-07-01"], (backtest.NAIVE, "STL")))
    for engine in (backtest.NAIVE, "STL"):
        row = got[1, "2024-07-01", engine]
        assert row.horizon_days == silent + 31 and row.actual == 310
        assert row.forecast == pytest.approx(310, rel=1e-6)


@pytest.mark.parametrize("engine", [backtest.NAIVE, *backtest.ENGINES])
def test_cuts_are_the_forecasts_of_cut_series(spark, daily, engine):
    table = daily({
        1: (JAN, [5 + i % 7 + (i * i) % 3 for i in range(200)]), 2: (dt.date(2024, 5, 20), [2, None, 9, 4, 0, 7, 7, 1, 3, 3] * 4),
        3: (dt.date(2024, 6, 28), [1, 2])})
    months = ["2024-06-01", "2024-07-01"]
    got = by_month(backtest.backtest_months(table, months, (engine,)))
    for month, after in zip(months, ("2024-07-01", "2024-08-01"), strict=True):
        known = table.where(F.col("date") < month)
        labels = known.select("department_id").distinct().withColumn("model", F.lit(engine))
        ahead = forecasts.seasonal_naive_daily(known) if engine == backtest.NAIVE else forecasts.daily_forecast(known, labels)
        expected = ahead.where((F.col("date") >= month) & (F.col("date") < after)).groupBy("department_id").agg(F.sum("p50").alias("forecast"))
        want = {r.department_id: r.forecast for r in expected.collect()}
        for department in (1, 2, 3):
            row = got[department, month, engine]
            assert row.has_forecast == (department in want)
            if row.has_forecast:
                assert row.forecast == pytest.approx(want[department], rel=1e-9)


def test_series_travel_once_for_all_cuts(daily):
    plan = backtest.backtest_months(daily({1: (JAN, [1] * 40)}), ["2024-02-01"] * 12)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 1 and "Generate" not in plan


def test_tested_months_are_whole_ones_before_the_day():
    assert backtest.tested_months("2024-02-15", 3) == ["2023-11-01", "2023-12-01", "2024-01-01"]


def test_errors_are_ratios_of_sums(spark):
    rows = [(1, "a", 12.0, 10.0), (1, "a", 5.0, 0.0), (1, "b", 10.0, 10.0), (1, "b", 0.0, 0.0), (2, "a", 1.0, 0.0), (1, "a", None, 7.0), (3, "a", None, 1.0)]
    tested = spark.createDataFrame(rows, "department_id bigint, engine string, forecast double, actual double")
    errors = backtest.backtest_errors(tested.withColumn("has_forecast", F.col("forecast").isNotNull()))
    got = {(r.department_id, r.engine): tuple(r)[2:] for r in errors.collect()}
    assert got[1, "a"] == (2, 1, pytest.approx(20), pytest.approx(70), pytest.approx(70))
    assert got[1, "b"] == (2, 0, 0, 0, 0) and got[2, "a"] == (1, 0, None, None, None) and got[3, "a"] == (0, 1, None, None, None)
    chosen = backtest.recommended_models(errors, ("a", "b")).collect()
    assert {r.department_id: r.Recommended_Model for r in chosen} == {1: "b", 2: "a", 3: "a"}
    departments = spark.createDataFrame([(1, "One", "V"), (2, "Two", "V")], "department_id bigint, department_name string, vertical string")
    measured = backtest.measured_errors(errors, departments, ("a", "b")).collect()
    assert [tuple(r) for r in measured] == [("V", 1, "One", "b", 2, 0.0, 0.0, 0.0)]


def test_backtest_run_leaves_what_the_monthly_run_reads(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    days = [(str(JAN + dt.timedelta(days=i)), d, 3 + i % 7 * d) for d in (1, 2) for i in range(200)]
    spark.createDataFrame(days, "Date string, department_id int, count int").write.parquet(f"{source}/incoming.parquet")
    names = spark.createDataFrame([(1, "Alpha", "Payments"), (2, "Beta", "Partners")], "department_id int, Department string, Vertical string")
    names.write.parquet(f"{source}/department_map.parquet")
    assert read_inputs(spark, source, target).model_errors is None
    run_backtest(spark, source, target, "2024-07-10", 2)
    given = read_inputs(spark, source, target)
    assert {r.department_id for r in given.previous_report.collect()} == {1, 2}
    errors = {r.department_id: r for r in given.model_errors.collect()}
    assert errors[1].backtest_months == 2 and errors[2].department_name == "Beta" and errors[1].bias_pct is not None
    assert spark.read.parquet(f"{target}/backtest_months").count() == 2 * 2 * 2


def test_tenure_ranges_include_both_ends(spark):
    agents = spark.createDataFrame(
        [(i, 1, d) for i, d in enumerate([dt.date(2024, 1, 15), dt.date(2024, 4, 15), dt.date(2024, 4, 16), None, dt.date(2024, 6, 1)])],
        "agent_id bigint, department_id bigint, start_date date")
    targets = spark.createDataFrame([(1, "new", 1, 3, 5.0), (1, "old", 4, 6, 9.0), (2, "new", 0, 99, 1.0)],
                                    "department_id bigint, seniority string, min_months int, max_months int, item_target_day double")
    got = {r.agent_id: (r.tenure_months, r.item_target_day) for r in reference_data.tenure_targets(agents, targets, "2024-07-15").collect()}
    assert got == {0: (6, 9.0), 1: (3, 5.0), 2: (2, 5.0), 3: (None, None), 4: (1, 5.0)}


def test_holiday_flags(spark, daily):
    days = daily({1: (JAN, [1, 2, 3])})
    holidays = spark.createDataFrame([(JAN, "New Year"), (JAN, "A day off")], "date date, label string")
    got = [(r.holiday, r.is_holiday) for r in reference_data.holiday_flags(days, holidays).orderBy("date").collect()]
    assert got == [("A day off", 1), (None, 0), (None, 0)]
