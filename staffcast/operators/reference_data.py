"""Joins with small reference tables: targets by tenure and holiday flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def tenure_targets(agents: DataFrame, targets: DataFrame, as_of: str) -> DataFrame:
    """Daily target of every agent by whole months of tenure at ``as_of``.

    ``targets`` has a row per department and seniority with the months it covers, both ends
    included. The join is an equality on the department; the months only filter its few rows
    per department. Agents without a start date, or outside every range, have no target.
    """
    started = agents.withColumn("tenure_months", F.floor(F.months_between(F.lit(as_of).cast("date"), "start_date")).cast("int"))
    rows = targets.select(F.col("department_id").alias("target_department"), "seniority", "min_months", "max_months", "item_target_day")
    covered = (
        (F.col("department_id") == F.col("target_department")) & (F.col("tenure_months") >= F.col("min_months"))
        & (F.col("tenure_months") <= F.col("max_months"))
    )
    return started.join(rows, covered, "left").select(
        "agent_id", "department_id", "start_date", "tenure_months", "seniority", "item_target_day")


def holiday_flags(daily: DataFrame, holidays: DataFrame) -> DataFrame:
    """Adds ``holiday`` (its label, null on other days) and ``is_holiday`` (1 or 0) by date."""
    named = holidays.groupBy("date").agg(F.min("label").alias("holiday"))
    return daily.join(named, "date", "left").withColumn("is_holiday", F.col("holiday").isNotNull().cast("int"))
