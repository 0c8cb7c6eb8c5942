import datetime as dt
import math
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from staffcast.operators import forecasts

JAN = dt.date(2024, 1, 1)


def by_department(df):
    pdf = df.toPandas().sort_values(["department_id", df.columns[1]])
    return {k: g.reset_index(drop=True) for k, g in pdf.groupby("department_id")}


def week_repeated(values, horizon):
    """The last week again and again; the band is 1.645 sample deviations of the changes over a week wide."""
    filled = [0.0 if v is None else float(v) for v in values]
    week = filled[-7:]
    middle = [week[step % len(week)] for step in range(horizon)]
    changes = [later - earlier for earlier, later in zip(filled, filled[7:])]
    mean = sum(filled) / len(filled)
    width = 1.645 * (statistics.stdev(changes) if len(changes) > 1 else max(1.0, max(mean, 1.0) ** 0.5))
    return middle, [max(m - width, 0.0) for m in middle], [m + width for m in middle]


SERIES = {
    1: [5], 2: [3, 8, 1, None, 9], 3: [4, 6, 2, 8, 1, 0, 3, 7], 4: [(i * i) % 11 for i in range(55)],
    5: [100] * 20,
}


def test_short_series_repeat_their_last_week(daily):
    table = daily({k: (JAN, v) for k, v in SERIES.items()})
    for fc in (forecasts.seasonal_naive_daily(table, 20), forecasts.daily_forecast(table, horizon=20)):
        got = by_department(fc)
        for dept, values in SERIES.items():
            p50, p05, p95 = week_repeated(values, 20)
            assert list(got[dept]["date"])[0] == JAN + dt.timedelta(days=len(values))
            np.testing.assert_allclose(got[dept]["p50"], p50)
            np.testing.assert_allclose(got[dept]["p05"], p05)
            np.testing.assert_allclose(got[dept]["p95"], p95)


def test_56_days_are_decomposed_and_55_are_not(daily):
    values = [10 + (i % 7) * 3 for i in range(56)]
    fc = by_department(forecasts.daily_forecast(daily({1: (JAN, values), 2: (JAN, values[:55])}), horizon=10))
    assert set(fc[1].path_used) == {"stl"} and set(fc[2].path_used) == {"naive"}
    # a series that repeats exactly leaves no remainder, so the fallback spread of 0.5 makes the band
    pattern = np.array([10 + (56 + step) % 7 * 3 for step in range(10)], dtype=float)
    factor = math.exp(1.645 * 0.5)
    np.testing.assert_allclose(fc[1].p50, pattern, rtol=1e-6)
    np.testing.assert_allclose(fc[1].p05, (pattern + 1) / factor - 1, rtol=1e-6)
    np.testing.assert_allclose(fc[1].p95, (pattern + 1) * factor - 1, rtol=1e-6)


def test_labels_choose_the_engine(spark, daily):
    rng = np.random.default_rng(5)
    busy = [float(v) for v in 20 + 8 * np.sin(np.arange(120) * 2 * np.pi / 7) + rng.normal(0, 1, 120)]
    zeros = [0.0] * 70
    table = daily({1: (JAN, busy), 2: (JAN, busy), 3: (JAN, busy), 4: (JAN, zeros), 5: (JAN, busy[:20])})
    labels = spark.createDataFrame(
        [(1, "SARIMAX-7"), (2, "Prophet"), (4, "SARIMAX-7"), (5, "SARIMAX-7")], "department_id bigint, model string"
    )
    got = by_department(forecasts.daily_forecast(table, labels, horizon=15))
    used = {k: (g.engine_used[0], g.path_used[0], bool(g.engine_failed[0])) for k, g in got.items()}
    assert used == {
        1: ("SARIMAX-7", "sarima", False),
        2: ("Prophet", "stl", False),               # unknown label keeps its text
        3: ("Baseline(STL)", "stl", False),
        4: ("Baseline(STL)", "stl", True),          # nothing to fit: falls back
        5: ("Baseline(STL)", "naive", True),        # too short for both
    }
    sd = (pd.Series(busy) - pd.Series(busy).shift(7)).std()
    np.testing.assert_allclose(got[1].p95 - got[1].p50, 1.645 * sd)
    assert np.corrcoef(got[1].p50[:14], busy[1:15])[0, 1] > 0.5


def test_bands_are_ordered_and_finite(daily):
    rng = np.random.default_rng(2)
    table = daily({d: (JAN, [float(v) for v in rng.poisson(d, 60 + 20 * d)]) for d in range(1, 6)} | {9: (JAN, [0.0] * 80)})
    fc = forecasts.daily_forecast(table, horizon=30).toPandas()
    assert len(fc) == 6 * 30 and fc[["p05", "p50", "p95"]].notna().all().all()
    assert np.isfinite(fc[["p05", "p50", "p95"]].to_numpy()).all()
    assert (fc.p05 <= fc.p50).all() and (fc.p05 >= 0).all()


def test_no_band_falls_below_zero(daily):
    values = [0.0] * 60
    values[:30:3] = [6.0] * 10
    fc = by_department(forecasts.daily_forecast(daily({1: (JAN, values)}), horizon=7))[1]
    assert (0 <= fc.p05).all() and (fc.p05 <= fc.p50).all() and (fc.p50 <= fc.p95).all()


def test_impossible_dates_stop_one_department_only(spark):
    rows = [(d, JAN + dt.timedelta(days=i), 5.0 + i % 7) for d in (1, 2) for i in range(70)]
    rows += [(2, dt.date(1, 1, 1), 1.0), (2, dt.date(9000, 12, 31), 1.0)]
    table = spark.createDataFrame(rows, "department_id bigint, date date, tickets double")
    fc = forecasts.daily_forecast(table, horizon=3)
    got = {r.department_id: (r.path_used, r.engine_failed, r.n) for r in fc.groupBy(
        "department_id", "path_used", "engine_failed").agg(F.count("*").alias("n")).collect()}
    assert got == {1: ("stl", False, 3), 2: ("naive", True, 3)}
    found = forecasts.implausible_series(table).collect()
    assert [(r.department_id, r.first_day, r.last_day) for r in found] == [(2, dt.date(1, 1, 1), dt.date(9000, 12, 31))]


def test_series_of_different_length_end_on_their_own_day(daily):
    fc = by_department(forecasts.seasonal_naive_daily(daily({1: (JAN, [1, 2]), 2: (JAN, [1] * 40)}), 5))
    assert fc[1].date[0] == dt.date(2024, 1, 3) and fc[2].date[0] == dt.date(2024, 2, 10)


def test_monthly_rollup_and_guard(spark, daily):
    departments = spark.createDataFrame([(1, "A", "V")], "department_id bigint, department_name string, vertical string")
    fc = forecasts.seasonal_naive_daily(daily({1: (dt.date(2024, 1, 20), [1] * 9), 2: (JAN, [1])}), 33)
    monthly = forecasts.monthly_rollup(fc, departments)
    got = {r.month: (r.forecast_p50, r.days_covered) for r in monthly.collect()}
    assert got == {dt.date(2024, 1, 1): (3.0, 3), dt.date(2024, 2, 1): (29.0, 29), dt.date(2024, 3, 1): (1.0, 1)}
    forecasts.check_quantiles(monthly)
    bad = monthly.withColumn("forecast_p05", F.col("forecast_p50") + 1)
    assert forecasts.quantile_violations(bad).count() == 3
    with pytest.raises(ValueError, match="department 1"):
        forecasts.check_quantiles(bad)


def test_backlog_hold_and_decomposition(monthly):
    long = [50 + 10 * np.sin(i * np.pi / 6) for i in range(40)]
    table = monthly("inventory", {1: (2023, 1, [7]), 2: (2023, 1, [4, None, 10]), 3: (2023, 1, long[:17]),
                                  4: (2023, 1, long[:18]), 5: (2021, 1, long)})
    got = by_department(forecasts.backlog_forecast(table))
    assert {k: g.path_used[0] for k, g in got.items()} == {1: "hold", 2: "hold", 3: "hold", 4: "stl", 5: "stl"}
    assert all(len(g) == 12 for g in got.values())
    sd = np.sqrt(7)
    np.testing.assert_allclose(got[1].iloc[0][["p50", "p05", "p95"]].astype(float), [7, 7 - 1.645 * sd, 7 + 1.645 * sd])
    sd = np.std([4, 0, 10])
    np.testing.assert_allclose(got[2].iloc[0][["p50", "p05", "p95"]].astype(float), [10, max(0, 10 - 1.645 * sd), 10 + 1.645 * sd])
    assert got[2].month[0] == dt.date(2023, 4, 1)
    want = [50 + 10 * np.sin(i * np.pi / 6) for i in range(40, 52)]
    np.testing.assert_allclose(got[5].p50, want, rtol=0.1)
    held = by_department(forecasts.backlog_forecast(table, fit=False))
    assert set(held[5].path_used) == {"hold"}
    np.testing.assert_allclose(held[5].p50, long[-1])


def test_order_of_rows_does_not_matter(daily):
    table = daily({1: (JAN, [float((i * 5) % 9) for i in range(70)])})
    one = by_department(forecasts.daily_forecast(table, horizon=5))[1]
    other = by_department(forecasts.daily_forecast(table.orderBy(F.desc("date")), horizon=5))[1]
    pd.testing.assert_frame_equal(one, other)
