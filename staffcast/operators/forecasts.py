"""Daily ticket forecasts and monthly backlog forecasts with lower and upper bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from staffcast.functions.columns import month_start
from staffcast.functions.scalar import floor_at_zero
from staffcast.operators.calendar import dense_daily, dense_monthly, future_days, future_months
from staffcast.operators.fitting import (
    DEFAULT_ENGINE, FIT_SCHEMA, MAX_SPAN_DAYS, daily_fitter, day_number, month_number, monthly_fitter,
    spread_by_key,
)

# Fixed values of the forecast bands and of the shortest series worth decomposing.
BAND = 1.645
MIN_DAYS = 56
MIN_MONTHS = 18


def _values_in_order(entries: Column) -> Column:
    return F.transform(F.array_sort(entries), lambda e: e["value"])


def daily_profile(daily: DataFrame) -> DataFrame:
    """One row per department describing its gap-filled series.

    ``days``, ``first_day``, ``last_day``, ``mean_tickets``, ``last_week`` (up to
    7 values), ``lag_diffs`` and ``lag_sd`` (count and sample spread of
    ``y[t] - y[t-7]``).
    """
    by_department = Window.partitionBy("department_id")
    lagged = dense_daily(daily).select(
        "department_id", "date", "tickets",
        (F.col("tickets") - F.lag("tickets", 7).over(by_department.orderBy("date"))).alias("lag_diff"),
        F.max("date").over(by_department).alias("last_day"),
    )
    recent = F.when(
        F.col("date") > F.date_sub("last_day", 7),
        F.struct("date", F.col("tickets").alias("value")),
    )
    return lagged.groupBy("department_id").agg(
        F.count("*").alias("days"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.avg("tickets").alias("mean_tickets"),
        _values_in_order(F.collect_list(recent)).alias("last_week"),
        F.count("lag_diff").alias("lag_diffs"),
        F.stddev_samp("lag_diff").alias("lag_sd"),
    )


def _cycle(values: str) -> Column:
    """Value of a repeating cycle at ``step`` (from 1), whatever its length."""
    position = F.pmod(F.col("step") - 1, F.size(values)) + 1
    return F.element_at(values, position.cast("int"))


def _naive_sd() -> Column:
    fallback = F.greatest(F.lit(1.0), F.sqrt(F.greatest(F.col("mean_tickets"), F.lit(1.0))))
    return F.coalesce("lag_sd", fallback)


def _band(p50: Column, sd: Column) -> list[Column]:
    return [p50.alias("p50"), floor_at_zero(p50 - BAND * sd).alias("p05"), (p50 + BAND * sd).alias("p95")]


def seasonal_naive_daily(daily: DataFrame, horizon: int = 365) -> DataFrame:
    """Last week repeated; the band comes from the week-on-week differences."""
    ahead = future_days(daily_profile(daily), "last_day", horizon)
    return ahead.select("department_id", "date", *_band(_cycle("last_week"), _naive_sd()))


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Add the engine label of each department; the default where there is none."""
    if labels is None:
        return rows.withColumn("model", F.lit(DEFAULT_ENGINE))
    known = labels.select("department_id", "model")
    return rows.join(known, "department_id", "left").withColumn(
        "model", F.coalesce("model", F.lit(DEFAULT_ENGINE))
    )


def daily_forecast(
    daily: DataFrame, labels: DataFrame | None = None, horizon: int = 365, min_days: int = MIN_DAYS,
    fit: bool = True,
) -> DataFrame:
    """Forecast every department with the engine its label asks for.

    ``SARIMAX-7`` fits a seasonal ARMA and falls back to decomposition when that
    fails (``engine_used`` is then the default label); every other label uses
    decomposition. Series shorter than ``min_days`` repeat their last week.
    ``path_used`` tells what ran: naive, stl or sarima. ``fit=False`` skips the
    grouped fits and repeats the last week everywhere.
    """
    profile = daily_profile(daily)
    if not fit:
        ahead = future_days(_labelled(profile, labels), "last_day", horizon)
        return ahead.select(
            "department_id", "date", *_band(_cycle("last_week"), _naive_sd()),
            F.col("model").alias("engine_used"), F.lit("naive").alias("path_used"),
            F.lit(False).alias("engine_failed"),
        )
    # both branches read the same columns of ``daily``, so its shuffle is made once and reused
    series = _labelled(daily.select("department_id", day_number(F.col("date")).alias("slot"), "tickets"), labels)
    fits = spread_by_key(series).groupBy("department_id").applyInPandas(
        daily_fitter(horizon, min_days), FIT_SCHEMA
    )
    ahead = future_days(profile.join(fits, "department_id", "left"), "last_day", horizon)
    path = F.coalesce("fit_path", F.lit("naive"))
    log_mean = F.col("level") + _cycle("season")

    def by_path(naive: Column, stl: Column, sarima: Column) -> Column:
        return F.when(path == "stl", stl).when(path == "sarima", sarima).otherwise(naive)

    week, naive_sd = _cycle("last_week"), _naive_sd()
    arma_mean = floor_at_zero(F.expm1(F.element_at("log_path", F.col("step"))))
    arma_sd = F.coalesce("lag_sd", F.lit(1.0))
    return ahead.select(
        "department_id", "date",
        by_path(week, floor_at_zero(F.expm1(log_mean)), arma_mean).alias("p50"),
        by_path(
            floor_at_zero(week - BAND * naive_sd),
            floor_at_zero(F.expm1(log_mean - BAND * F.col("log_sd"))),
            floor_at_zero(arma_mean - BAND * arma_sd),
        ).alias("p05"),
        by_path(
            week + BAND * naive_sd,
            floor_at_zero(F.expm1(log_mean + BAND * F.col("log_sd"))),
            arma_mean + BAND * arma_sd,
        ).alias("p95"),
        "engine_used",
        path.alias("path_used"),
        F.coalesce("engine_failed", F.lit(False)).alias("engine_failed"),
    )


def implausible_series(daily: DataFrame, max_days: int = MAX_SPAN_DAYS) -> DataFrame:
    """Departments whose first and last day are further apart than can be right; they are not fitted."""
    spans = daily.where("department_id IS NOT NULL AND date IS NOT NULL").groupBy("department_id").agg(
        F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    days = F.date_diff("last_day", "first_day") + 1
    return spans.withColumn("days", days.cast("bigint")).where(F.col("days") > max_days)


def monthly_rollup(forecast: DataFrame, departments: DataFrame) -> DataFrame:
    """Monthly sums of the three quantiles; first and last month may be partial (``days_covered``)."""
    monthly = forecast.groupBy("department_id", month_start(F.col("date")).alias("month")).agg(
        F.coalesce(F.sum("p50"), F.lit(0.0)).alias("forecast_p50"),
        F.coalesce(F.sum("p05"), F.lit(0.0)).alias("forecast_p05"),
        F.coalesce(F.sum("p95"), F.lit(0.0)).alias("forecast_p95"),
        F.count("*").alias("days_covered"),
    )
    return monthly.join(departments, "department_id").select(
        "vertical", "department_id", "department_name", "month",
        "forecast_p50", "forecast_p05", "forecast_p95", "days_covered",
    )


def quantile_violations(monthly: DataFrame) -> DataFrame:
    """Rows whose quantiles are out of order."""
    return monthly.where(
        (F.col("forecast_p05") > F.col("forecast_p50")) | (F.col("forecast_p50") > F.col("forecast_p95"))
    )


def check_quantiles(monthly: DataFrame) -> None:
    """Raise ``ValueError`` if any row is out of order. Starts a job that stops at the first hit."""
    hit = quantile_violations(monthly).select("department_id", "month").take(1)
    if hit:
        raise ValueError(f"quantile order violated, e.g. department {hit[0][0]}, month {hit[0][1]}")


def backlog_profile(backlog: DataFrame) -> DataFrame:
    """One row per department: months, last month, last value and population spread of its backlog."""
    dense = dense_monthly(backlog, "inventory")
    return dense.groupBy("department_id").agg(
        F.count("*").alias("months"),
        F.max("month").alias("last_month"),
        F.max_by("inventory", "month").alias("last_value"),
        F.stddev_pop("inventory").alias("spread"),
    )


def _hold_sd() -> Column:
    single = F.greatest(F.lit(1.0), F.sqrt(F.greatest(F.col("last_value"), F.lit(1.0))))
    return F.when(F.col("months") > 1, F.col("spread")).otherwise(single)


def backlog_forecast(
    backlog: DataFrame, horizon: int = 12, min_months: int = MIN_MONTHS, fit: bool = True
) -> DataFrame:
    """Backlog per future month: decomposition with a yearly cycle, or the last value held.

    ``fit=False`` holds the last value everywhere and needs no grouped fit.
    """
    profile = backlog_profile(backlog)
    held = floor_at_zero(F.col("last_value"))
    if not fit:
        ahead = future_months(profile, "last_month", horizon)
        return ahead.select("department_id", "month", *_band(held, _hold_sd()), F.lit("hold").alias("path_used"))
    series = backlog.where(F.col("department_id").isNotNull() & F.col("month").isNotNull())
    series = series.select("department_id", month_number(F.col("month")).alias("slot"), "inventory")
    fits = spread_by_key(series).groupBy("department_id").applyInPandas(
        monthly_fitter(min_months), FIT_SCHEMA
    )
    ahead = future_months(profile.join(fits, "department_id", "left"), "last_month", horizon)
    decomposed = F.coalesce(F.col("fit_path") == "stl", F.lit(False))
    log_mean = F.col("level") + _cycle("season")
    sd = _hold_sd()
    return ahead.select(
        "department_id", "month",
        F.when(decomposed, floor_at_zero(F.expm1(log_mean))).otherwise(held).alias("p50"),
        F.when(decomposed, floor_at_zero(F.expm1(log_mean - BAND * F.col("log_sd"))))
        .otherwise(floor_at_zero(held - BAND * sd)).alias("p05"),
        F.when(decomposed, floor_at_zero(F.expm1(log_mean + BAND * F.col("log_sd"))))
        .otherwise(held + BAND * sd).alias("p95"),
        F.when(decomposed, F.lit("stl")).otherwise(F.lit("hold")).alias("path_used"),
    )
