"""One department holds most rows; results are whole and equal to pandas."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from staffcast.operators import capacity, forecasts, volumes
from staffcast.sources import inputs


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    department = F.when(i % 10 < 7, F.lit(1)).otherwise(i % 13)
    return spark.range(60000).select(
        department.alias("department_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i * 7919 % 140).cast("int")).alias("date"),
        (i * 31 % 457).alias("agent_id"), (i % 6).cast("double").alias("item_target_day"),
        (i % 5).cast("double").alias("prod_total_model"),
        (i * 17 % 5000).alias("case_number"),
        F.date_add(F.lit("2023-12-20").cast("date"), (i * 13 % 90).cast("int")).alias("date_opened"),
    )


@pytest.fixture(scope="module")
def frame(rows):
    pdf = rows.toPandas()
    for c in ("date", "date_opened"):
        pdf[c] = pd.to_datetime(pdf[c])
    return pdf


def test_hot_key_is_hot(frame):
    assert (frame.department_id == 1).mean() > 0.6


def test_daily_tickets(rows, frame):
    got = volumes.daily_tickets(inputs.incoming(rows)).toPandas()
    want = frame.groupby(["department_id", "date"]).size()
    got["date"] = pd.to_datetime(got["date"])
    pd.testing.assert_series_equal(
        got.set_index(["department_id", "date"])["tickets"].sort_index(), want.astype(float).sort_index(), check_names=False
    )


def test_inherited_backlog(rows, frame):
    got = inputs.inherited_backlog(rows).toPandas().set_index(["department_id", "month"])["inventory"]
    kept = frame[(frame.date.dt.day == 1) & (frame.date_opened < frame.date)]
    want = kept.groupby(["department_id", "date"])["case_number"].nunique()
    assert {(d, str(m)): v for (d, m), v in got.items()} == {(d, str(m.date())): float(v) for (d, m), v in want.items()}


def test_agent_days(rows, frame):
    got = capacity.agent_days_by_day(inputs.agent_days(rows)).toPandas()
    productive = frame[frame.item_target_day > 1]
    want = productive.groupby(["department_id", "date"])["agent_id"].nunique()
    kept = got.dropna(subset=["agents_day"])
    assert {(r.department_id, str(r.date)): int(r.agents_day) for r in kept.itertuples()} == {
        (d, str(m.date())): v for (d, m), v in want.items()
    }
    assert got.prod_sum_day.sum() == frame.prod_total_model.sum()


def test_forecast_covers_every_department(rows, frame):
    daily = volumes.daily_tickets(inputs.incoming(rows))
    fc = forecasts.daily_forecast(daily, horizon=30)
    counts = {r.department_id: r["count"] for r in fc.groupBy("department_id").count().collect()}
    assert counts == {d: 30 for d in frame.department_id.unique()}
