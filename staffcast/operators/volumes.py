"""Ticket volumes per day and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staffcast.functions.columns import month_start
from staffcast.operators.scope import attach_departments

KEYS = ["vertical", "department_id", "department_name", "month"]


def daily_tickets(incoming: DataFrame) -> DataFrame:
    """Tickets per department and day. Null keys are dropped; an all-null sum is 0."""
    return (
        incoming.where(F.col("department_id").isNotNull() & F.col("date").isNotNull())
        .groupBy("department_id", "date")
        .agg(F.coalesce(F.sum("ticket_total"), F.lit(0.0)).alias("tickets"))
    )


def monthly_actuals(daily: DataFrame, departments: DataFrame) -> DataFrame:
    """Actual volume per department and month, from the daily sums, within ``departments``.

    Works on daily sums rather than ticket rows, so the facts are scanned once
    for the daily and the monthly view, and the map is joined last.
    """
    monthly = daily.groupBy("department_id", month_start(F.col("date")).alias("month")).agg(
        F.sum("tickets").alias("actual_volume")
    )
    return attach_departments(monthly, departments).where(
        F.col("vertical").isNotNull() & F.col("department_name").isNotNull()
    )


def uplift_by_calls(actuals: DataFrame, calls: DataFrame) -> DataFrame:
    """Actuals plus calls not indexed of the same department and month."""
    return (
        actuals.join(calls, ["department_id", "month"], "left")
        .withColumn("actual_volume", F.col("actual_volume") + F.coalesce("calls_not_indexed", F.lit(0.0)))
        .select(*KEYS, "actual_volume")
    )
