import datetime as dt

import pytest
from pyspark.sql import functions as F

from staffcast.operators import calendar, rates

JAN = dt.date(2024, 1, 1)


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*(columns or df.columns)).collect()}


def test_gaps_are_filled_with_zero(daily):
    got = as_set(calendar.dense_daily(daily({1: (JAN, [2, None, None, 5]), 2: (JAN, [7])})))
    assert got == {(1, JAN, 2.0), (1, dt.date(2024, 1, 2), 0.0), (1, dt.date(2024, 1, 3), 0.0),
                   (1, dt.date(2024, 1, 4), 5.0), (2, JAN, 7.0)}


def test_null_keys_and_null_values(spark):
    rows = [(1, JAN, None), (None, JAN, 1.0), (1, None, 1.0)]
    df = spark.createDataFrame(rows, "department_id bigint, date date, tickets double")
    assert as_set(calendar.dense_daily(df)) == {(1, JAN, 0.0)}


def test_monthly_gaps_over_year_end(monthly):
    got = as_set(calendar.dense_monthly(monthly("inventory", {1: (2023, 11, [1, None, None, 4])}), "inventory"))
    assert got == {(1, dt.date(2023, 11, 1), 1.0), (1, dt.date(2023, 12, 1), 0.0), (1, JAN, 0.0), (1, dt.date(2024, 2, 1), 4.0)}


def test_horizons(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 31), dt.date(2024, 1, 1))], "k bigint, day date, month0 date")
    days = calendar.future_days(df, "day", 3).select("step", "date")
    assert as_set(days) == {(1, dt.date(2024, 2, 1)), (2, dt.date(2024, 2, 2)), (3, dt.date(2024, 2, 3))}
    months = calendar.future_months(df, "month0", 2).select("step", "month")
    assert as_set(months) == {(1, dt.date(2024, 2, 1)), (2, dt.date(2024, 3, 1))}
    assert calendar.month_grid(df.select("k"), "2026-01-01", "2027-02-01").count() == 14


def rate_of_one(df):
    (department, rate), = as_set(df)
    assert department == 1
    return rate


@pytest.fixture
def tables(spark, monthly):
    def build(actual, side, value="solved"):
        actuals = monthly("actual_volume", actual).withColumns(
            {"vertical": F.lit("v"), "department_name": F.lit("d")}
        )
        return actuals, monthly(value, side)

    return build


def test_mean_of_latest_three_rows_skips_null_rates(tables):
    actuals, solved = tables({1: (2024, 1, [10, 10, 10, 0, 10])}, {1: (2024, 1, [9, 9, 2, 5, 4])})
    # rows 3, 4, 5 are ranked; row 4 has no volume, so its rate is null and skipped
    assert rate_of_one(rates.deflection_rate(actuals, solved)) == pytest.approx((0.2 + 0.4) / 2)
    assert rate_of_one(rates.deflection_rate(actuals, solved, zero_as=0.0)) == pytest.approx(0.2)


def test_rate_is_clipped_and_null_becomes_zero(tables):
    actuals, solved = tables({1: (2024, 1, [10]), 2: (2024, 1, [0])}, {1: (2024, 1, [99])})
    assert as_set(rates.deflection_rate(actuals, solved)) == {(1, 0.9), (2, 0.0)}


def test_call_outliers_leave_before_ranking(tables):
    actuals, calls = tables(
        {1: (2024, 1, [10] * 5)}, {1: (2024, 1, [10, 29.9, 30, 5, 20])}, "calls_not_indexed"
    )
    # 3.0 is dropped, 2.99 is kept, so months 2, 4 and 5 are used
    assert rate_of_one(rates.calls_rate(actuals, calls)) == pytest.approx((2.99 + 0.5 + 2.0) / 3)


def test_no_rate_left_gives_no_row(tables):
    actuals, calls = tables({1: (2024, 1, [1])}, {1: (2024, 1, [3])}, "calls_not_indexed")
    assert as_set(rates.calls_rate(actuals, calls)) == set()


def test_repeats_count_zero_without_volume(tables):
    actuals, repeats = tables({1: (2024, 1, [10, 0, 10])}, {1: (2024, 1, [6, 5, 3])}, "repeats_workload")
    assert rate_of_one(rates.repeats_rate(actuals, repeats)) == pytest.approx(0.3)


def test_same_as_plain_loops(tables):
    actual = {d: (2023, 1, [(d * 7 + i * 3) % 5 for i in range(14)]) for d in range(1, 9)}
    side = {d: (2023, 3, [(d + i) % 4 if (d + i) % 3 else None for i in range(12)]) for d in range(1, 9)}
    actuals, solved = tables(actual, side)
    want = {}
    for department, (_, _, volumes) in actual.items():
        year, month, found = side[department]
        by_month = {month + i: v for i, v in enumerate(found) if v is not None}
        last = list(enumerate(volumes, start=1))[-3:]
        shares = [by_month.get(m, 0) / v for m, v in last if v > 0]
        want[department] = min(max(sum(shares) / len(shares), 0.0), 0.9) if shares else 0.0
    got = {r[0]: r[1] for r in rates.deflection_rate(actuals, solved).collect()}
    assert got == pytest.approx(want)
