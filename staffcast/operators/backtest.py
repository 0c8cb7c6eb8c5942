"""Rolling backtest of the daily engines, and the model recommendation that follows from it.

A department's series travels once: one grouped call cuts it before every tested month, lets
every engine fit what is left, and returns one row for each month and engine. The horizon of a
cut runs from its own last ticket to the end of the tested month, however long the department
was silent. A month that has no ticket before it has no forecast; it stays, flagged, and is
counted apart from the months that errors are taken over.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from staffcast.functions.columns import month_start
from staffcast.operators.fitting import day_number, fit_daily, median_path, spread_by_key
from staffcast.operators.forecasts import MIN_DAYS
from staffcast.sources import schemas

ENGINES = ("STL", "SARIMAX-7")
NAIVE = "naive"
_EPOCH = dt.date(1970, 1, 1)
_CUT_SCHEMA = "department_id bigint, month date, engine string, path_used string, horizon_days int, forecast double, fit_error string"


def tested_months(as_of: str, count: int) -> list[str]:
    """The last `count` whole months before the day `as_of`, as ISO dates of their first days."""
    day = dt.date.fromisoformat(as_of)
    last = day.year * 12 + day.month - 1
    return [dt.date(m // 12, m % 12 + 1, 1).isoformat() for m in range(last - count, last)]


def _cut_fitter(months: Sequence[str], engines: Sequence[str], min_days: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    bounds = []
    for text in months:
        first = dt.date.fromisoformat(text)
        after = dt.date(first.year + first.month // 12, first.month % 12 + 1, 1)
        bounds.append((first, (first - _EPOCH).days, (after - _EPOCH).days))

    def fit_cuts(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(pdf["slot"].to_numpy())
        slot, tickets = pdf["slot"].to_numpy()[order], pdf["tickets"].to_numpy(dtype=float)[order]
        department, out = int(pdf["department_id"].iloc[0]), []
        for month, first, after in bounds:
            known = int(np.searchsorted(slot, first))
            for engine in engines:
                if not known:
                    out.append((department, month, engine, None, None, None, None))
                    continue
                horizon = after - 1 - int(slot[known - 1])
                least = sys.maxsize if engine == NAIVE else min_days
                y, row = fit_daily(slot[:known], tickets[:known], engine, horizon, least)
                path = median_path(row, y, horizon)
                out.append((department, month, engine, row["fit_path"], horizon, float(path[first - after :].sum()), row["fit_error"]))
        return pd.DataFrame(out, columns=[field.split()[0] for field in _CUT_SCHEMA.split(", ")])

    return fit_cuts


def backtest_months(
    daily: DataFrame, months: Sequence[str], engines: Sequence[str] = ENGINES, min_days: int = MIN_DAYS,
) -> DataFrame:
    """Forecast and actual volume of each tested month (ISO date of its first day), department
    and engine: department_id, month, engine, path_used, horizon_days, forecast, fit_error,
    has_forecast, actual. Each month is forecast from the days before it."""
    rows = daily.where("department_id IS NOT NULL AND date IS NOT NULL")
    series = rows.select("department_id", day_number(F.col("date")).alias("slot"), "tickets")
    cuts = spread_by_key(series).groupBy("department_id").applyInPandas(_cut_fitter(months, engines, min_days), _CUT_SCHEMA)
    actual = rows.groupBy("department_id", month_start(F.col("date")).alias("month")).agg(F.sum("tickets").alias("actual"))
    joined = cuts.join(actual, ["department_id", "month"], "left")
    return joined.withColumns({"has_forecast": F.col("forecast").isNotNull(), "actual": F.coalesce("actual", F.lit(0.0))})


def backtest_errors(tested: DataFrame) -> DataFrame:
    """MAPE, WAPE and bias in percent per department and engine, over the months with a forecast;
    `months_without_forecast` counts the others. WAPE and bias are ratios of sums; months
    without actual volume count in them but have no percentage of their own."""
    known = F.col("has_forecast")
    gap = F.when(known, F.col("forecast") - F.col("actual"))
    total = F.sum(F.when(known, F.col("actual")))
    return tested.groupBy("department_id", "engine").agg(
        F.count_if(known).alias("backtest_months"), F.count_if(~known).alias("months_without_forecast"),
        F.avg(F.when(F.col("actual") > 0, F.abs(gap) / F.col("actual") * 100)).alias("mape_pct"),
        F.when(total > 0, F.sum(F.abs(gap)) / total * 100).alias("wape_pct"),
        F.when(total > 0, F.sum(gap) / total * 100).alias("bias_pct"),
    )


def _best(errors: DataFrame, engines: Sequence[str]) -> DataFrame:
    """Per department the engine of least WAPE; of equal ones the first listed."""
    place = F.array_position(F.array(*[F.lit(e) for e in engines]), F.col("engine"))
    order = Window.partitionBy("department_id").orderBy(F.col("wape_pct").asc_nulls_last(), place)
    return errors.where(place > 0).withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def recommended_models(errors: DataFrame, engines: Sequence[str] = ENGINES) -> DataFrame:
    """``department_id, Recommended_Model``: the engine of least WAPE; of equal ones the first listed.

    Written as ``recommended_models`` to the output folder, the next monthly run reads it.
    """
    return _best(errors, engines).select("department_id", F.col("engine").alias("Recommended_Model"))


def measured_errors(errors: DataFrame, departments: DataFrame, engines: Sequence[str] = ENGINES) -> DataFrame:
    """The errors of each department's recommended engine in the form of the model error table,
    which the calibration takes its bias from; departments without a tested volume are left out.

    Written as ``model_errors`` to the output folder, the next monthly run reads it.
    """
    names = departments.select("department_id", "vertical", "department_name")
    rows = _best(errors, engines).where("bias_pct IS NOT NULL").join(names, "department_id")
    types = {name: kind for name, kind in (field.split() for field in schemas.MODEL_ERRORS.split(", "))}
    return rows.withColumn("model_used", F.col("engine")).select(*[F.col(c).cast(kind).alias(c) for c, kind in types.items()])
