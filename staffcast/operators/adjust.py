"""Adjustments of the monthly forecast: deflection, extra work, backlog, bias."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staffcast.functions.scalar import clip

QUANTILES = ("p50", "p05", "p95")
# Bounds of the calibration factor.
FACTOR_LOW, FACTOR_HIGH = 0.70, 1.30


def attach_rate(monthly: DataFrame, rates: DataFrame, rate: str, high: float) -> DataFrame:
    """Left-join a per-department rate; missing counts as 0 and the range is 0..``high``."""
    joined = monthly.join(rates.select("department_id", rate), "department_id", "left")
    return joined.withColumn(rate, clip(F.coalesce(rate, F.lit(0.0)), 0.0, high))


def apply_deflection(monthly: DataFrame, rates: DataFrame) -> DataFrame:
    """Multiply the three quantiles by ``1 - deflection_rate_recent``."""
    rated = attach_rate(monthly, rates, "deflection_rate_recent", 0.9)
    return rated.withColumns({
        f"forecast_{q}_post_deflection": F.col(f"forecast_{q}") * (1 - F.col("deflection_rate_recent"))
        for q in QUANTILES
    })


def forecast_calls(monthly: DataFrame, rates: DataFrame) -> DataFrame:
    """Expected calls not indexed: recent rate times the base forecast."""
    rated = attach_rate(monthly, rates, "calls_not_indexed_rate_recent", 5.0)
    return rated.withColumn(
        "calls_not_indexed_forecast", F.col("forecast_p50") * F.col("calls_not_indexed_rate_recent")
    )


def forecast_repeats(monthly: DataFrame, rates: DataFrame) -> DataFrame:
    """Expected repeat contacts: recent rate times the base forecast."""
    rated = attach_rate(monthly, rates, "repeats_rate_recent", 5.0)
    return rated.withColumn("repeats_forecast", F.col("forecast_p50") * F.col("repeats_rate_recent"))


def attach_backlog(monthly: DataFrame, actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """Backlog per month: actual where known, else forecast, else 0."""
    known = actual.select("department_id", "month", F.col("inventory").alias("inventory_actual"))
    expected = forecast.select("department_id", "month", F.col("p50").alias("inventory_forecast"))
    keys = ["department_id", "month"]
    return monthly.join(known, keys, "left").join(expected, keys, "left").withColumn(
        "inventory_final", F.coalesce("inventory_actual", "inventory_forecast", F.lit(0.0))
    )


def calibration_factors(errors: DataFrame) -> DataFrame:
    """``1 - bias / 100`` per department, kept within the factor bounds."""
    factor = clip(1 - F.col("bias_pct") / 100.0, FACTOR_LOW, FACTOR_HIGH)
    return errors.where(F.col("department_id").isNotNull()).select(
        "department_id", factor.alias("calib_factor")
    )


def calibrate(monthly: DataFrame, errors: DataFrame) -> DataFrame:
    """Multiply the post-deflection quantiles by the factor; 1 without an error record.

    An empty error table gives the identity calibration.
    """
    joined = monthly.drop("calib_factor").join(calibration_factors(errors), "department_id", "left")
    factored = joined.withColumn("calib_factor", F.coalesce("calib_factor", F.lit(1.0)))
    return factored.withColumns({
        f"forecast_{q}_post_deflection_cal":
            F.col(f"forecast_{q}_post_deflection") * F.col("calib_factor")
        for q in QUANTILES
    })


def calibrated_share(monthly: DataFrame) -> DataFrame:
    """Share of rows whose factor differs from 1."""
    return monthly.agg(F.avg((F.col("calib_factor") != 1.0).cast("int")).alias("calibrated_share"))
