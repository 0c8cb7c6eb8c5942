"""Series fits: the only Python that runs on executors.

One group is one department's series after daily (or monthly) summing, so its
size is bounded by the calendar, not by ticket volume. The group returns one row
of parameters; forecasts are expanded from them with DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from staffcast.functions import loess, seasonal_arma

FIT_SCHEMA = (
    "department_id bigint, fit_path string, engine_used string, engine_failed boolean, fit_error string, level double, "
    "season array<double>, log_sd double, log_path array<double>"
)
FIT_COLUMNS = [field.split()[0] for field in FIT_SCHEMA.split(", ")]
DEFAULT_ENGINE = "Baseline(STL)"
ARMA_ENGINE = "SARIMAX-7"
# Longest series that is fitted, in days: a century. Dates further apart are taken for wrong ones.
MAX_SPAN_DAYS = 36525


def day_number(day: Column) -> Column:
    """Days since 1970 as a plain number; fits work on these, since pandas' dates end in 2262."""
    return F.unix_date(day)


def month_number(month: Column) -> Column:
    return (F.year(month) * 12 + F.month(month)).cast("int")


def spread_by_key(series: DataFrame, key: str = "department_id") -> DataFrame:
    """Hash-partition by key into an explicit number of partitions.

    Series tables are small in bytes but costly to fit. Without this, adaptive
    execution would merge them into one partition and fit them one by one.
    """
    session = series.sparkSession
    tasks = max(
        int(session.conf.get("spark.sql.shuffle.partitions")),
        3 * session.sparkContext.defaultParallelism,
    )
    return series.repartition(tasks, key)


def _evenly_spaced(slot: np.ndarray, value: np.ndarray) -> np.ndarray:
    span = int(slot.max() - slot.min()) + 1
    if span > MAX_SPAN_DAYS:
        raise ValueError(f"first and last row are {span} steps apart")
    dense = np.zeros(span)
    dense[slot - slot.min()] = np.nan_to_num(value)
    return dense


def decomposition_row(y: np.ndarray, period: int) -> dict:
    """Level, last cycle and remainder spread of ``log(1 + y)``."""
    z = np.log1p(y)
    parts = loess.decompose(z, period)
    spread = float(np.std(parts.remainder, ddof=1)) if len(y) > 1 else 0.0
    known = spread > loess.EXACT_FIT * float(np.max(np.abs(z)))
    return {
        "fit_path": "stl",
        "level": float(parts.trend[-1]),
        "season": parts.seasonal[-period:].tolist(),
        "log_sd": spread if known else 0.5,
    }


def _arma_row(y: np.ndarray, horizon: int) -> dict | None:
    z = np.log1p(y)
    p = seasonal_arma.fit(z)
    if p is None:
        return None
    path = seasonal_arma.forecast(z, p, horizon)
    return {"fit_path": "sarima", "log_path": path.tolist()} if np.all(np.isfinite(path)) else None


def _fit_frame(pdf: pd.DataFrame, row: dict) -> pd.DataFrame:
    row = row | {"department_id": int(pdf["department_id"].iloc[0])}
    return pd.DataFrame([[row.get(c) for c in FIT_COLUMNS]], columns=FIT_COLUMNS)


def fit_daily(
    slot: np.ndarray, tickets: np.ndarray, asked: str, horizon: int, min_days: int,
) -> tuple[np.ndarray, dict]:
    """The gap-filled series and the fit that its label asks for, with decomposition as the
    fallback of the seasonal ARMA, and no fit for a series that is too short or implausible."""
    row, engine, error = None, asked, None
    try:
        y = _evenly_spaced(slot, tickets)
    except Exception as problem:
        back, y = slot.max() - slot, np.zeros(7)
        y[6 - back[back < 7]] = np.nan_to_num(tickets[back < 7])
        return y, {"fit_path": "naive", "engine_used": DEFAULT_ENGINE, "engine_failed": True, "fit_error": str(problem)[:200]}
    if asked == ARMA_ENGINE:
        try:
            row = _arma_row(y, horizon)
            error = None if row else "seasonal ARMA could not be fitted"
        except Exception as problem:
            error = str(problem)[:200]
        engine = asked if row else DEFAULT_ENGINE
    if row is None and len(y) >= min_days:
        try:
            row = decomposition_row(y, 7)
        except Exception as problem:
            error = str(problem)[:200]
    return y, {
        "fit_path": "naive", **(row or {}), "engine_used": engine, "engine_failed": error is not None, "fit_error": error}


def median_path(row: dict, y: np.ndarray, horizon: int) -> np.ndarray:
    """The middle forecast of the days after a series from the row of its fit, as `forecasts.daily_forecast`
    expands it."""
    if row["fit_path"] == "sarima":
        return np.maximum(np.expm1(np.array(row["log_path"])), 0.0)
    cycle = np.maximum(np.expm1(row["level"] + np.array(row["season"])), 0.0) if row["fit_path"] == "stl" else y[-7:]
    return np.resize(cycle, horizon)


def daily_fitter(horizon: int, min_days: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Grouped-map function choosing the engine by label."""

    def fit_one(pdf: pd.DataFrame) -> pd.DataFrame:
        slot, tickets = pdf["slot"].to_numpy(), pdf["tickets"].to_numpy(dtype=float)
        return _fit_frame(pdf, fit_daily(slot, tickets, pdf["model"].iloc[0], horizon, min_days)[1])

    return fit_one


def monthly_fitter(min_months: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Grouped-map function for monthly series with a yearly cycle."""

    def fit_one(pdf: pd.DataFrame) -> pd.DataFrame:
        row, error = {"fit_path": "hold"}, None
        try:
            y = _evenly_spaced(pdf["slot"].to_numpy(), pdf["inventory"].to_numpy(dtype=float))
            if len(y) >= min_months:
                row = decomposition_row(y, 12)
        except Exception as problem:
            error = str(problem)[:200]
        return _fit_frame(pdf, row | {"engine_failed": error is not None, "fit_error": error})

    return fit_one


def decompose_daily(daily: DataFrame, value: str = "tickets") -> DataFrame:
    """Trend, seasonal and remainder of ``log(1 + y)`` for every day of every department."""

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        slot = pdf["slot"].to_numpy()
        try:
            y = _evenly_spaced(slot, pdf[value].to_numpy(dtype=float))
        except ValueError:  # reported by forecasts.implausible_series
            return pd.DataFrame(columns=["department_id", "slot", "trend", "seasonal", "remainder"])
        parts = loess.decompose(np.log1p(y), 7)
        return pd.DataFrame({
            "department_id": int(pdf["department_id"].iloc[0]), "slot": slot.min() + np.arange(len(y)),
            "trend": parts.trend, "seasonal": parts.seasonal, "remainder": parts.remainder,
        })

    schema = "department_id bigint, slot int, trend double, seasonal double, remainder double"
    rows = daily.select("department_id", day_number(F.col("date")).alias("slot"), value)
    split_rows = spread_by_key(rows).groupBy("department_id").applyInPandas(split, schema)
    return split_rows.select("department_id", F.date_from_unix_date("slot").alias("date"), "trend", "seasonal", "remainder")


def arma_steps(daily: DataFrame, horizon: int) -> DataFrame:
    """The seasonal ARMA of every department day by day: department_id, step, date, z, noise,
    ahead, and the coefficients a, big_a, m, big_m.

    In the past z is the log of 1 plus the tickets and `noise` the fit's residual; in the future
    z is the forecast and `noise` 0. So every row but the first eight obeys one recursion.
    Departments whose series cannot be fitted have no rows.
    """
    columns = ["department_id", "step", "slot", "z", "noise", "ahead", "a", "big_a", "m", "big_m"]

    def trace(pdf: pd.DataFrame) -> pd.DataFrame:
        slot = pdf["slot"].to_numpy()
        try:
            z = np.log1p(_evenly_spaced(slot, pdf["tickets"].to_numpy(dtype=float)))
            p = seasonal_arma.fit(z)
        except Exception:  # reported by the forecast itself, as engine_failed
            p = None
        if p is None:
            return pd.DataFrame(columns=columns)
        path = seasonal_arma.forecast(z, p, horizon)
        steps = np.arange(len(z) + horizon)
        return pd.DataFrame({
            "department_id": int(pdf["department_id"].iloc[0]), "step": steps, "slot": int(slot.min()) + steps,
            "z": np.concatenate((z, path)), "noise": np.concatenate((seasonal_arma.residuals(z, p), np.zeros(horizon))),
            "ahead": steps >= len(z), "a": p[0], "big_a": p[1], "m": p[2], "big_m": p[3],
        })

    schema = ("department_id bigint, step int, slot int, z double, noise double, ahead boolean, a double, big_a double, "
              "m double, big_m double")
    rows = daily.where("department_id IS NOT NULL AND date IS NOT NULL").select(
        "department_id", day_number(F.col("date")).alias("slot"), "tickets")
    steps = spread_by_key(rows).groupBy("department_id").applyInPandas(trace, schema)
    return steps.withColumn("date", F.date_from_unix_date("slot")).drop("slot")
