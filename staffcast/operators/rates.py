"""Recent share of a side volume in the actual volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from staffcast.functions.scalar import clip, ratio


def latest_rows(rows: DataFrame, count: int, key: str = "department_id", order: str = "month") -> DataFrame:
    """The ``count`` latest rows of each key. The planner prunes groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= count).drop("_rank")


def monthly_rates(
    actuals: DataFrame, side: DataFrame, value: str, zero_as: float | None = None
) -> DataFrame:
    """``rate = value / actual_volume`` per department and month.

    Months without side volume count 0; months without actual volume get ``zero_as``.
    """
    joined = actuals.select("department_id", "month", "actual_volume").join(
        side.select("department_id", "month", value), ["department_id", "month"], "left"
    )
    amount = F.coalesce(value, F.lit(0.0))
    volume = F.coalesce("actual_volume", F.lit(0.0))
    return joined.select(
        "department_id", "month", volume.alias("actual_volume"), amount.alias(value),
        ratio(amount, volume, zero_as).alias("rate"),
    )


def recent_rate(
    actuals: DataFrame,
    side: DataFrame,
    value: str,
    out: str,
    high: float,
    months: int = 3,
    zero_as: float | None = None,
    below: float | None = None,
) -> DataFrame:
    """Mean rate of each department's latest ``months`` rows, clipped to 0..``high``.

    With ``below``, null rates and rates not under the limit are dropped before
    ranking; otherwise null rates keep their rank and are skipped by the mean.
    """
    rates = monthly_rates(actuals, side, value, zero_as)
    if below is not None:
        rates = rates.where(F.col("rate") < below)
    latest = latest_rows(rates.select("department_id", "month", "rate"), months)
    mean = latest.groupBy("department_id").agg(F.avg("rate").alias("_mean"))
    return mean.select("department_id", clip(F.coalesce("_mean", F.lit(0.0)), 0.0, high).alias(out))


def deflection_rate(actuals: DataFrame, solved: DataFrame, zero_as: float | None = None) -> DataFrame:
    """Share solved by the bot, at most 0.9. ``zero_as=0`` counts months without volume as 0."""
    return recent_rate(actuals, solved, "solved", "deflection_rate_recent", high=0.9, zero_as=zero_as)


def calls_rate(actuals: DataFrame, calls: DataFrame, outlier: float = 3.0, high: float = 5.0) -> DataFrame:
    """Calls not indexed per ticket; months at or above ``outlier`` are left out."""
    return recent_rate(
        actuals, calls, "calls_not_indexed", "calls_not_indexed_rate_recent", high=high, below=outlier
    )


def repeats_rate(actuals: DataFrame, repeats: DataFrame, high: float = 5.0) -> DataFrame:
    """Repeat contacts per ticket; months without volume count 0."""
    return recent_rate(actuals, repeats, "repeats_workload", "repeats_rate_recent", high=high, zero_as=0.0)
