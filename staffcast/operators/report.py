"""Report tables: KPI boards in wide and long form, and the two department reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from staffcast.functions.scalar import month_label, percent_text, round_even, signed_ratio
from staffcast.operators.calendar import month_grid
from staffcast.operators.volumes import KEYS

# Boards belong to a department id; names need not differ.
BOARD_KEYS = ("department_id", "department_name")
# Months shown on a board.
BOARD_FIRST, BOARD_LAST = "2026-01-01", "2027-02-01"
# KPI rows of a board in display order, without the blank comments row.
BOARD_KPIS = (
    "Forecast",
    "Actual Volume",
    "Forecast Accuracy",
    "Capacity",
    "Productivity",
    "Difference Capacity vs Productivity",
    "Expected Forecast vs Capacity",
    "Forecast Error %",
    "Actual vs Productivity %",
    "Inventory",
)


def expected_volumes(adjusted: DataFrame, actuals: DataFrame, base: str = "forecast_p50") -> DataFrame:
    """Forecast side of the reports joined with the actual volume on the four keys.

    ``base`` is the column shown as ``forecast``: the raw forecast, or e.g.
    ``forecast_p50_post_deflection_cal`` for the calibrated one. The deflected
    volume keeps its decimals.
    """
    forecast = adjusted.withColumns({
        "forecast": F.col(base),
        "forecast_base": F.col("forecast_p50"),
        "forecast_human_cases_cal": F.col("forecast_p50_post_deflection_cal"),
        "deflected_forecast": F.col("forecast_p50") * F.col("deflection_rate_recent"),
    })
    return forecast.join(actuals.select(*KEYS, "actual_volume"), KEYS, "left")


def history_only_months(actuals: DataFrame, forecast_keys: DataFrame, year: int) -> DataFrame:
    """Department months of ``year`` that have actuals but no forecast."""
    of_year = actuals.where(F.year("month") == year).select(*KEYS, "actual_volume")
    return of_year.join(forecast_keys.select(*KEYS), KEYS, "left_anti")


def add_history_months(expected: DataFrame, actuals: DataFrame, year: int) -> DataFrame:
    """Append this year's history-only months; their forecast columns are null."""
    extra = history_only_months(actuals, expected, year)
    return expected.unionByName(extra, allowMissingColumns=True)


def board_months(
    rows: DataFrame, first: str = BOARD_FIRST, last: str = BOARD_LAST, zero_fill: bool = False
) -> DataFrame:
    """KPIs per department name and month over the whole range; months without data are null.

    With ``zero_fill`` the sums of months that exist but hold only nulls are 0.
    ``rows`` is read twice (names and sums), so pass a written table.
    """
    sums = ("forecast", "actual_volume", "capacity", "productivity")
    in_range = F.col("month").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    total = [F.coalesce(F.sum(c), F.lit(0.0)) if zero_fill else F.sum(c) for c in sums]
    by_month = rows.where(in_range).groupBy(*BOARD_KEYS, "month").agg(
        *[t.alias(c) for t, c in zip(total, sums)], F.avg("inventory_mean").alias("inventory_mean")
    )
    names = rows.where(F.col("department_name").isNotNull()).select(*BOARD_KEYS).distinct()
    grid = month_grid(names, first, last).join(by_month, [*BOARD_KEYS, "month"], "left")
    f, a = F.col("forecast"), F.col("actual_volume")
    c, p = F.col("capacity"), F.col("productivity")
    gap = F.coalesce(round_even(signed_ratio(c - p, c) * 100, 0), F.lit(0.0))
    kpis: dict[str, Column] = {
        "Forecast": round_even(f, 0),
        "Actual Volume": round_even(a, 0),
        "Forecast Accuracy": round_even(100 - signed_ratio(F.abs(f - a), a) * 100, 1),
        "Capacity": c,
        "Productivity": p,
        "Difference Capacity vs Productivity": gap,
        "Expected Forecast vs Capacity": round_even(f - c, 0),
        "Forecast Error %": round_even(signed_ratio(f - a, a) * 100, 1),
        "Actual vs Productivity %": round_even(signed_ratio(a - p, a) * 100, 1),
        "Inventory": round_even(F.col("inventory_mean"), 2),
    }
    return grid.select(*BOARD_KEYS, "month", *[kpis[k].alias(k) for k in BOARD_KPIS])


def board_long(months: DataFrame) -> DataFrame:
    """One row per month label, department and KPI: ``Month, department_id, department_name, KPI, Total``."""
    labelled = months.withColumn("Month_label", month_label(F.col("month")))
    return labelled.unpivot(
        ["Month_label", *BOARD_KEYS], list(BOARD_KPIS), "KPI", "Total"
    ).withColumnRenamed("Month_label", "Month")


def board_labels(first: str = BOARD_FIRST, last: str = BOARD_LAST) -> list[str]:
    """Month labels of a board in order."""
    start, end = (int(d[:4]) * 12 + int(d[5:7]) - 1 for d in (first, last))
    return [f"{m % 12 + 1:02d}-{m // 12 % 100:02d}" for m in range(start, end + 1)]


def board_wide(months: DataFrame, first: str = BOARD_FIRST, last: str = BOARD_LAST) -> DataFrame:
    """KPI rows by month columns per department, with a blank ``Comments`` row.

    The labels are given to the pivot, so no extra job looks for them.
    """
    blank = months.withColumn("Comments", F.lit(None).cast("double"))
    long = blank.withColumn("label", month_label(F.col("month"))).unpivot(
        ["label", *BOARD_KEYS], ["Comments", *BOARD_KPIS], "KPI", "Total"
    )
    return long.groupBy(*BOARD_KEYS, "KPI").pivot("label", board_labels(first, last)).agg(F.first("Total"))


def capacity_gap_text(months: DataFrame) -> DataFrame:
    """Capacity gap of each board month as percent text, the older display form."""
    return months.select(
        *BOARD_KEYS, "month",
        percent_text(F.col("Difference Capacity vs Productivity")).alias("capacity_gap"),
    )


def department_names(rows: DataFrame) -> DataFrame:
    """Sorted distinct department names."""
    return rows.where("department_name is not null").select("department_name").distinct().orderBy("department_name")


def capacity_report(rows: DataFrame) -> DataFrame:
    """Volume against capacity and productivity, one row per department month."""
    f, a = F.col("forecast"), F.col("actual_volume")
    c, p = F.col("capacity"), F.col("productivity")
    measured = rows.withColumns({
        "actual_minus_prod": a - p,
        "forecast_accuracy": signed_ratio(f - a, a),
        "productivity_minus_capacity": p - c,
        "forecast_minus_capacity": f - c,
    })
    # Display names, in display order.
    names = {
        "month": "Month",
        "vertical": "Vertical",
        "department_name": "Department_name",
        "inventory_mean": "Inventory",
        "actual_volume": "Actual Volume",
        "productivity": "Productivity",
        "actual_minus_prod": "Actual Volume vs Productivity",
        "forecast": "Forecast",
        "deflected_forecast": "Deflected forecast",
        "forecast_accuracy": "Forecast accuracy",
        "productivity_minus_capacity": "Difference Capacity vs Productivity",
        "capacity": "Capacity",
        "forecast_minus_capacity": "Expected Forecast vs Capacity",
    }
    return measured.select(*names).withColumnsRenamed(names)


def workload_rows(rows: DataFrame) -> DataFrame:
    """Actual workload, expected workload and its gap to the capacity.

    Missing volumes count 0 in the sums. Months without a forecast have no expected workload
    and no gap, and a missing capacity leaves the gap null.
    """
    zero = F.lit(0.0)
    expected = F.col("forecast_human_cases_cal").isNotNull()
    filled = rows.withColumns(
        {c: F.coalesce(c, zero) for c in ("calls_not_indexed_actual", "repeats_actual", "inventory_final")}
        | {c: F.when(expected, F.coalesce(c, zero)) for c in ("calls_not_indexed_forecast", "repeats_forecast")}
    )
    summed = filled.withColumns({
        "actual_workload": F.coalesce("actual_volume", zero)
        + F.col("calls_not_indexed_actual") + F.col("repeats_actual"),
        "workload_forecast": F.col("forecast_human_cases_cal")
        + F.col("calls_not_indexed_forecast") + F.col("repeats_forecast") + F.col("inventory_final"),
    })
    return summed.withColumn("workload_minus_capacity", F.col("workload_forecast") - F.col("capacity"))


def workload_report(rows: DataFrame) -> DataFrame:
    """Display form of ``workload_rows``, sorted for reading."""
    # Display names, in display order; the two names of deflected volume are this library's own.
    names = {
        "month": "Month",
        "vertical": "Vertical",
        "department_name": "Department_name",
        "actual_volume": "Actual Volume",
        "calls_not_indexed_actual": "Calls not indexed (actual)",
        "repeats_actual": "Repeats (actual)",
        "actual_workload": "Actual Workload (Cases + calls not indexed + repeats)",
        "forecast_base": "Forecast (Cases)",
        "calls_not_indexed_forecast": "Calls not indexed (forecast)",
        "repeats_forecast": "Repeats (forecast)",
        "deflected_forecast": "Deflected forecast",
        "forecast_human_cases_cal": "Forecast after deflection (Human cases)",
        "inventory_final": "Inventory",
        "workload_forecast": "Workload Forecast (Humans + calls not indexed + repeats + inventory)",
        "capacity": "Capacity",
        "productivity": "Productivity",
        "workload_minus_capacity": "Expected Workload vs Capacity",
    }
    ordered = workload_rows(rows).orderBy("vertical", "department_name", "month")
    return ordered.select(*names).withColumnsRenamed(names)
