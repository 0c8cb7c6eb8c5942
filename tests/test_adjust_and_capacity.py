import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from staffcast.operators import adjust, capacity
from staffcast.sources import inputs, schemas
from staffcast.sources.tables import empty_table

JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


@pytest.fixture
def forecast(spark):
    return spark.createDataFrame(
        [("v", d, f"d{d}", m, 100.0, 80.0, 120.0) for d in (1, 2) for m in (JAN, FEB)],
        "vertical string, department_id bigint, department_name string, month date, "
        "forecast_p50 double, forecast_p05 double, forecast_p95 double",
    )


def test_deflection_defaults_to_zero_and_is_clipped(spark, forecast):
    rate = spark.createDataFrame([(1, 0.95)], "department_id bigint, deflection_rate_recent double")
    got = rows(adjust.apply_deflection(forecast, rate).where(F.col("month") == F.lit(JAN)),
               "department_id", "forecast_p50_post_deflection", "forecast_p95_post_deflection")
    assert got == [(1, pytest.approx(10.0), pytest.approx(12.0)), (2, 100.0, 120.0)]


def test_calls_and_repeats_use_the_base_forecast(spark, forecast):
    calls = spark.createDataFrame([(1, 0.5)], "department_id bigint, calls_not_indexed_rate_recent double")
    repeats = spark.createDataFrame([(2, 9.0)], "department_id bigint, repeats_rate_recent double")
    both = adjust.forecast_repeats(adjust.forecast_calls(forecast, calls), repeats)
    got = rows(both.where(F.col("month") == F.lit(JAN)), "department_id", "calls_not_indexed_forecast", "repeats_forecast")
    assert got == [(1, 50.0, 0.0), (2, 0.0, 500.0)]


def test_backlog_actual_then_forecast_then_zero(spark, forecast):
    actual = spark.createDataFrame([(1, JAN, 7.0)], schemas.MONTHLY_BACKLOG)
    expected = spark.createDataFrame([(1, JAN, 9.0), (1, FEB, 8.0)], "department_id bigint, month date, p50 double")
    got = rows(adjust.attach_backlog(forecast, actual, expected), "department_id", "month", "inventory_final")
    assert got == [(1, JAN, 7.0), (1, FEB, 8.0), (2, JAN, 0.0), (2, FEB, 0.0)]


def test_calibration_bounds_default_and_share(spark, forecast):
    rate = spark.createDataFrame([], "department_id bigint, deflection_rate_recent double")
    deflected = adjust.apply_deflection(forecast, rate)
    errors = spark.createDataFrame([(1, 45.0), (3, -45.0), (4, None), (5, 12.64)], "department_id bigint, bias_pct double")
    assert rows(adjust.calibration_factors(errors).where("department_id != 4")) == [
        (1, 0.7), (3, 1.3), (5, pytest.approx(0.8736)),
    ]
    done = adjust.calibrate(deflected, errors)
    assert rows(done.where(F.col("month") == F.lit(JAN)), "department_id", "forecast_p50_post_deflection_cal") == [(1, 70.0), (2, 100.0)]
    assert rows(adjust.calibrated_share(done)) == [(0.5,)]
    identity = adjust.calibrate(done, empty_table(spark, schemas.MODEL_ERRORS))
    assert rows(adjust.calibrated_share(identity)) == [(0.0,)]


AGENT_ROWS = [
    ("2024-01-01", 1, 10, 5.0, 3.0), ("2024-01-01", 1, 10, 7.0, 1.0),  # one agent, two rows
    ("2024-01-01", 1, 11, 1.0, 2.0),                                   # idle, but produces
    ("2024-01-02", 1, 12, 4.0, None), ("2024-01-03", 1, 13, 0.0, 6.0), # third day: nobody productive
    ("2024-01-04", 1, None, 9.0, 1.0),                                 # productive row without agent
    ("bad", 1, 14, 9.0, 9.0), ("2024-01-05", None, 15, 9.0, 9.0),
]
AGENT_SCHEMA = "work_date string, department_id int, worker_id int, item_target double, productivity double"


def test_agent_days(spark):
    table = inputs.agent_days(spark.createDataFrame(AGENT_ROWS, AGENT_SCHEMA))
    got = rows(capacity.agent_days_by_day(table), "date", "agents_day", "target_mean_day", "prod_sum_day")
    day = lambda d: dt.date(2024, 1, d)
    assert got == [(day(1), 1, 6.0, 6.0), (day(2), 1, 4.0, 0.0), (day(3), None, None, 6.0), (day(4), 0, 9.0, 1.0)]
    joined = capacity.join_agent_day_pieces(capacity.agent_day_pieces(table))
    assert rows(joined, "date", "agents_day", "target_mean_day", "prod_sum_day") == got


def test_whole_and_other_measures_add_up_exactly(spark):
    values = [0.1, 0.2, 3.0, 2.5, 7.0, 4e9, 1e18 + 256, -3.0, 1e30, 1 / 3]
    raw = [("2024-01-01", 1, i, 2.0 + v % 1 if v != 7.0 else 5.0, v) for i, v in enumerate(values)]
    got = capacity.agent_days_by_day(inputs.agent_days(spark.createDataFrame(raw, AGENT_SCHEMA.replace("item_target int", "item_target double")))).first()
    places = decimal.Decimal("1e-9")
    fit = lambda v: decimal.Decimal(repr(v)).quantize(places, decimal.ROUND_HALF_UP, decimal.Context(60))
    total = lambda vs: sum((fit(v) for v in vs), decimal.Decimal(0))
    with decimal.localcontext(decimal.Context(60)):
        assert got.prod_sum_day == float(total(v for v in values if v < 1e19))
        assert got.target_mean_day == float((total(r[3] for r in raw) / len(raw)).quantize(decimal.Decimal("1e-13"), decimal.ROUND_HALF_UP))


def test_agent_days_without_agent_ids_count_rows(spark):
    raw = spark.createDataFrame(AGENT_ROWS, AGENT_SCHEMA).drop("worker_id")
    got = rows(capacity.agent_days_by_day(inputs.agent_days(raw)), "date", "agents_day")
    assert [n for _, n in got] == [2, 1, None, 1]
    assert inputs.agent_days(raw.drop("item_target")) is None


def test_agent_capacity_is_product_of_means(spark):
    table = inputs.agent_days(spark.createDataFrame(AGENT_ROWS, AGENT_SCHEMA))
    mean_agents, mean_target = (1 + 1 + 0) / 3, (6 + 4 + 9) / 3
    assert rows(capacity.agent_capacity(table)) == [(1, JAN, pytest.approx(mean_agents * mean_target), 13.0)]


def test_history_takes_the_first_measure_present(spark):
    raw = spark.createDataFrame(
        [("2024-02-15", 1, 10.0, 2.0, 3.0), ("2024-02-01", 1, 5.0, 1.0, 1.0), ("bad", 1, 9.0, 9.0, 9.0), ("2024-02-01", None, 1.0, 1.0, 1.0)],
        "MonthStartDate string, dept_id int, productivity_total double, avg_per_day double, productive double",
    )
    assert rows(capacity.historical_capacity(raw)) == [(1, FEB, 15.0)]
    assert rows(capacity.historical_capacity(raw.drop("productivity_total"))) == [(1, FEB, 3.0 * 21)]
    hours = raw.drop("productivity_total", "avg_per_day")
    assert rows(capacity.historical_capacity(hours)) == [(1, FEB, 24.0)]
    assert rows(capacity.historical_capacity(hours, tickets_per_hour=5)) == [(1, FEB, 20.0)]
    assert capacity.historical_capacity(hours.drop("productive")) is None
    assert capacity.historical_capacity(raw.drop("MonthStartDate")) is None
    parts = spark.createDataFrame([(2024, "2", 1, 4.0), (2024, "x", 1, 4.0)], "Year int, Month_number string, dept_id int, productive double")
    assert rows(capacity.historical_capacity(parts)) == [(1, FEB, 24.0)]


def test_projection_anchor_and_level(spark, monthly):
    history = monthly("capacity", {1: (2023, 9, [100, 10, 20, 30]), 2: (2023, 6, [8])})
    actuals = monthly("actual_volume", {1: (2024, 2, [1])})
    ahead = capacity.project_capacity(history, actuals, "2030-01-15")
    got = rows(ahead)
    assert len(got) == 24 and got[0] == (1, MAR, 20.0) and got[11] == (1, dt.date(2025, 2, 1), 20.0)
    assert got[12] == (2, MAR, 8.0)
    only_actuals = capacity.project_capacity(history, monthly("actual_volume", {1: (2023, 1, [1])}), "2030-01-15", use_capacity_months=False)
    assert rows(only_actuals)[0] == (1, dt.date(2023, 2, 1), 20.0)
    nothing = empty_table(spark, "department_id bigint, month date, actual_volume double")
    assert rows(capacity.project_capacity(history, nothing, "2030-01-15", months=1)) == [(1, JAN, 20.0), (2, JAN, 8.0)]
    as_of = capacity.project_capacity(history, nothing, "2030-01-15", months=1, use_capacity_months=False)
    assert rows(as_of, "month") == [(dt.date(2030, 2, 1),)] * 2
    assert capacity.project_capacity(empty_table(spark, schemas.MONTHLY_CAPACITY), actuals, "2030-01-15").count() == 0
    assert capacity.with_projection(history, ahead).count() == 5 + 24


def test_consolidation_branches(spark, forecast):
    agents = spark.createDataFrame([(1, JAN, 50.0, 40.0)], schemas.MONTHLY_AGENTS)
    other = spark.createDataFrame([(1, JAN, 9.0), (1, FEB, 8.0)], schemas.MONTHLY_CAPACITY)
    got = rows(capacity.consolidate(forecast, agents, other), "department_id", "month", "capacity", "productivity")
    assert got[:2] == [(1, JAN, 50.0, 40.0), (1, FEB, 8.0, 8.0)]
    assert got[2][2:] == (None, None)
    plain = capacity.consolidate(forecast, agents, other, productivity_from_agents=False)
    assert rows(plain.where("department_id = 1"), "month", "productivity") == [(JAN, 50.0), (FEB, 8.0)]
