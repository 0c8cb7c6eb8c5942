"""Queries over one run of the fitted plan.

What a plan forecasts has no counterpart in SQL, but everything around it has: which months
there are, actual volumes, rates, factors, capacity. Those columns are returned as they are.
What follows from the forecasts is computed a second time, by SQL that starts from the plan's
kept daily and backlog forecasts, and each row says whether the two differ.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from staffcast.catalog.bindings import Bindings
from staffcast.catalog.queries import PLAN, plan_inputs
from staffcast.catalog.registry import query
from staffcast.operators import adjust, calendar, forecasts, report, scope
from staffcast.plans.workforce import PlanTables, run_workforce_plan
from staffcast.sources import inputs
from staffcast.sources.sinks import Stages

#: KPIs of a board that depend on the forecast.
FORECAST_KPIS = ("Forecast", "Forecast Accuracy", "Expected Forecast vs Capacity", "Forecast Error %")

_plans: dict[tuple[str, str], PlanTables] = {}


def fitted_plan(b: Bindings) -> PlanTables:
    """The tables of one fitted plan over a folder, run once per application and shared by the
    queries below while its stage tables can be read."""
    key = (b.spark.sparkContext.applicationId, b.folder)
    if key in _plans:
        try:
            _plans[key]["Monthly_Forecast_CAL"].take(1)
            return _plans[key]
        except PySparkException:  # the shared folder was cleared
            pass
    _plans.clear()
    _plans[key] = run_workforce_plan(b.spark, plan_inputs(b), PLAN)
    return _plans[key]


def _differs(value: str, expected: str, slack: str = "1e-9") -> str:
    """SQL for: the value is not the expected one, up to a part of it; nulls are equal to nulls."""
    return f"coalesce(abs({value} - ({expected})) > {slack} * (1 + abs({expected})), ({value} IS NULL) <> (({expected}) IS NULL))"


def _rounded(value: str, expected: str, digits: int) -> str:
    """SQL for: the value is not the expected one rounded to so many places."""
    return f"coalesce(abs({value} - ({expected})) > {0.5 * 10 ** -digits} + 1e-6, ({value} IS NULL) <> (({expected}) IS NULL))"


_MONTH_SUMS = """SELECT department_id, CAST(trunc(date, 'MM') AS DATE) AS month, sum(p50) AS p50, sum(p05) AS p05, sum(p95) AS p95,
    count(*) AS days FROM {daily} GROUP BY ALL"""


@query
def monthly_rollup_fitted(b: Bindings) -> DataFrame:
    """Monthly sums of the fitted daily forecasts."""
    plan = fitted_plan(b)
    sums_differ = " OR ".join(_differs(f"m.forecast_{q}", f"s.{q}") for q in ("p50", "p05", "p95"))
    return b.spark.sql(f"""SELECT vertical, department_id, department_name, month, days_covered, days_covered <> days OR {sums_differ} AS sums_differ,
        forecast_p05 > forecast_p50 OR forecast_p50 > forecast_p95 OR forecast_p05 < 0 AS out_of_order
        FROM {{monthly}} m FULL JOIN ({_MONTH_SUMS}) s USING (department_id, month)""",
        monthly=plan["Monthly_Forecast_RAW"], daily=plan["Daily_Forecast"])


@query
def monthly_chain_fitted(b: Bindings) -> DataFrame:
    """Deflection, calls, repeats, backlog and bias on the fitted monthly forecast: the rates and
    factors, and whether every adjusted value is its rate times the sums of the daily forecast."""
    plan = fitted_plan(b)
    post = " OR ".join(_differs(f"c.forecast_{q}_post_deflection", f"s.{q} * (1 - deflection_rate_recent)") for q in ("p50", "p05", "p95"))
    cal = " OR ".join(
        _differs(f"c.forecast_{q}_post_deflection_cal", f"s.{q} * (1 - deflection_rate_recent) * calib_factor") for q in ("p50", "p05", "p95"))
    return b.spark.sql(f"""SELECT vertical, department_id, department_name, month, days_covered, deflection_rate_recent,
        calls_not_indexed_rate_recent, repeats_rate_recent, calib_factor, inventory_actual,
        f.p50 IS NOT NULL AS has_backlog_forecast, {post} AS deflected_differs, {cal} AS calibrated_differs,
        {_differs('calls_not_indexed_forecast', 's.p50 * calls_not_indexed_rate_recent')} AS calls_differ,
        {_differs('repeats_forecast', 's.p50 * repeats_rate_recent')} AS repeats_differ,
        {_differs('inventory_forecast', 'f.p50')} OR {_differs('inventory_final', 'coalesce(inventory_actual, f.p50, 0)')} AS backlog_differs
        FROM {{adjusted}} c FULL JOIN ({_MONTH_SUMS}) s USING (department_id, month) LEFT JOIN {{backlog}} f USING (department_id, month)""",
        adjusted=plan["Monthly_Forecast_CAL"], daily=plan["Daily_Forecast"], backlog=plan["Backlog_Forecast"])


@query
def backlog_final_fitted(b: Bindings) -> DataFrame:
    """Backlog around the end of history from the fitted forecast: actual, else forecast, else 0."""
    stages = Stages(b.spark)
    actual = stages.keep("backlog", inputs.inherited_backlog(b.backlog_daily()))
    ahead = stages.keep("ahead", forecasts.backlog_forecast(actual))
    months = scope.attach_departments(
        calendar.month_grid(b.scoped().select("department_id"), "2000-06-01", "2003-12-01"), b.scoped())
    return b.spark.sql(f"""SELECT vertical, department_id, department_name, month, inventory_actual, path_used,
        {_differs('inventory_forecast', 'f.p50')} AS forecast_differs, f.p05 > f.p50 OR f.p50 > f.p95 OR f.p05 < 0 AS out_of_order,
        {_differs('inventory_final', 'coalesce(inventory_actual, f.p50, 0)')} AS final_differs
        FROM {{final}} LEFT JOIN {{ahead}} f USING (department_id, month)""", final=adjust.attach_backlog(months, actual, ahead), ahead=ahead)


@query
def capacity_report_fitted(b: Bindings) -> DataFrame:
    """The capacity report on fitted forecasts: what it measures, and whether the rest follows."""
    plan = fitted_plan(b)
    # months after the end of the daily forecast's year have none; history months neither
    return b.spark.sql(f"""SELECT r.Month AS month, r.Vertical AS vertical, r.Department_name AS department_name, r.Inventory AS inventory,
        `Actual Volume` AS actual, Productivity AS productivity, `Actual Volume vs Productivity` AS actual_gap,
        `Difference Capacity vs Productivity` AS productivity_gap, Capacity AS capacity, s.p50 IS NOT NULL AS has_forecast,
        {_differs('r.Forecast', 's.p50')} AS forecast_differs,
        {_differs('`Deflected forecast`', 's.p50 * deflection_rate_recent')} AS deflected_differs,
        {_differs('`Forecast accuracy`', 'try_divide(s.p50 - `Actual Volume`, `Actual Volume`)')} AS accuracy_differs,
        {_differs('`Expected Forecast vs Capacity`', 's.p50 - Capacity')} AS gap_differs
        FROM {{report}} r LEFT JOIN (SELECT department_name, c.month, deflection_rate_recent, s.p50
            FROM {{adjusted}} c JOIN ({_MONTH_SUMS}) s USING (department_id, month)) s
        ON s.department_name = r.Department_name AND s.month = r.Month""",
        report=plan["capacity_report"], adjusted=plan["Monthly_Forecast_CAL"], daily=plan["Daily_Forecast"])


def _board_values(b: Bindings) -> DataFrame:
    """Boards of the fitted plan by month, with every forecast KPI computed again from the daily forecast."""
    plan = fitted_plan(b)
    kpi = {name: f"max(Total) FILTER (WHERE KPI = '{name}')" for name in (*FORECAST_KPIS, "Actual Volume", "Capacity")}
    columns = ", ".join(f"{expr} AS `{name}`" for name, expr in kpi.items())
    return b.spark.sql(f"""WITH k AS (SELECT department_id, to_date(concat('01-', Month), 'dd-MM-yy') AS month, {columns} FROM {{long}} GROUP BY ALL)
        SELECT department_id, date_format(month, 'MM-yy') AS label,
            {_rounded('Forecast', 's.p50', 0)} AS `Forecast`,
            {_rounded('`Forecast Accuracy`', '100 - try_divide(abs(s.p50 - actual_volume), actual_volume) * 100', 1)} AS `Forecast Accuracy`,
            {_rounded('`Expected Forecast vs Capacity`', 's.p50 - Capacity', 0)} AS `Expected Forecast vs Capacity`,
            {_rounded('`Forecast Error %`', 'try_divide(s.p50 - actual_volume, actual_volume) * 100', 1)} AS `Forecast Error %`
        FROM k LEFT JOIN ({_MONTH_SUMS}) s USING (department_id, month) LEFT JOIN {{actuals}} a USING (department_id, month)""",
        long=plan["board_kpis_long"], daily=plan["Daily_Forecast"], actuals=plan["Monthly_Actuals"])


@query
def board_kpis_fitted(b: Bindings) -> DataFrame:
    """Long KPI rows of the fitted plan: totals that no forecast is in, and whether the others differ."""
    long = fitted_plan(b)["board_kpis_long"]
    wrong = _board_values(b).unpivot(["department_id", "label"], list(FORECAST_KPIS), "KPI", "differs")
    rows = long.withColumnRenamed("Month", "label").join(wrong, ["department_id", "label", "KPI"], "left")
    return rows.select(
        "label", "department_id", "department_name", "KPI", F.when(~F.col("KPI").isin(*FORECAST_KPIS), F.col("Total")).alias("total"),
        F.col("Total").isNotNull().alias("has_total"), F.coalesce("differs", F.lit(False)).alias("differs"))


@query
def board_wide_fitted(b: Bindings) -> DataFrame:
    """KPI rows by month columns of the fitted plan against its long rows: months with a value,
    the sum of those that no forecast is in, and the months in which the two forms differ."""
    plan = fitted_plan(b)
    labels = report.board_labels(*PLAN.board_range)
    wide = plan["boards"].unpivot(["department_id", "department_name", "KPI"], labels, "label", "value")
    long = plan["board_kpis_long"].select(F.col("Month").alias("label"), "department_id", "KPI", "Total")
    both = wide.join(long, ["department_id", "label", "KPI"], "left")
    free = ~F.col("KPI").isin(*FORECAST_KPIS)
    return both.groupBy("department_id", "department_name", "KPI").agg(
        F.count("value").alias("months"), F.sum(F.when(free, F.col("value"))).alias("total"),
        F.count_if(~F.col("value").eqNullSafe(F.col("Total"))).alias("differ"))


@query
def run_log_fitted(b: Bindings) -> DataFrame:
    """Rows of every stage of the fitted plan, counted while they were written."""
    return fitted_plan(b)["run_log"]
