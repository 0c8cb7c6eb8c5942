"""Gap filling and future horizons without calendar tables or cross joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _densify(series: DataFrame, key: str, time: str, value: str, step: str, before_next: Column) -> DataFrame:
    upcoming = F.lead(time).over(Window.partitionBy(key).orderBy(time))
    spans = series.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        key, time, value, upcoming.alias("_next")
    )
    until = F.greatest(F.col(time), before_next)  # the last row of a key has no next one
    filled = spans.select(
        key, F.col(time).alias("_own"), value,
        F.explode(F.sequence(F.col(time), until, F.expr(f"interval 1 {step}"))).alias(time),
    )
    amount = F.when(F.col(time) == F.col("_own"), F.coalesce(value, F.lit(0.0))).otherwise(F.lit(0.0))
    return filled.select(key, time, amount.alias(value))


def dense_daily(series: DataFrame, value: str = "tickets", key: str = "department_id") -> DataFrame:
    """One row per key and day from first to last day; gaps hold 0.

    Each row is stretched to the day before the next one, which needs a single
    shuffle by key and no join with a calendar.
    """
    return _densify(series, key, "date", value, "day", F.date_sub("_next", 1))


def dense_monthly(series: DataFrame, value: str, key: str = "department_id") -> DataFrame:
    """One row per key and month from first to last month; gaps hold 0."""
    return _densify(series, key, "month", value, "month", F.add_months("_next", -1))


def future_days(rows: DataFrame, last: str, days: int) -> DataFrame:
    """Repeat each row for the ``days`` days after its column ``last``; adds ``step`` (from 1) and ``date``."""
    steps = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(days))))
    return steps.withColumn("date", F.date_add(last, F.col("step")))


def future_months(rows: DataFrame, last: str, months: int) -> DataFrame:
    """Repeat each row for the ``months`` months after its column ``last``; adds ``step`` and ``month``."""
    steps = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(months))))
    return steps.withColumn("month", F.add_months(last, F.col("step")))


def month_grid(keys: DataFrame, first: str, last: str) -> DataFrame:
    """Every key row with every month from ``first`` to ``last`` (ISO dates)."""
    months = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))
    return keys.withColumn("month", F.explode(months))
