"""The whole plan: raw inputs in, named report tables and a run log out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from staffcast.operators import adjust, capacity, forecasts, rates, report, scope, volumes
from staffcast.plans.params import PlanParams
from staffcast.sources import inputs, schemas
from staffcast.sources.sinks import Stages
from staffcast.sources.tables import empty_table, published_model_errors, with_department_names


@dataclass(frozen=True)
class PlanInputs:
    """Raw tables. Everything but ``incoming`` and ``department_map`` may be None.

    ``backlog_daily`` is preferred over ``backlog_monthly``. ``backlog_open`` has
    one row per open case and day and feeds the boards' mean backlog.
    ``previous_report`` holds ``department_id, Recommended_Model``;
    ``manual_labels`` (``department_id, model``) wins over it.
    """

    incoming: DataFrame
    department_map: DataFrame
    deflection: DataFrame | None = None
    calls: DataFrame | None = None
    repeats: DataFrame | None = None
    backlog_daily: DataFrame | None = None
    backlog_monthly: DataFrame | None = None
    backlog_open: DataFrame | None = None
    capacity_history: DataFrame | None = None
    agent_days: DataFrame | None = None
    manual_labels: DataFrame | None = None
    previous_report: DataFrame | None = None
    model_errors: DataFrame | None = None


class PlanTables(Mapping[str, DataFrame]):
    """Named result tables; a report table is put together when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _if_given(raw: DataFrame | None, build: Callable[[DataFrame], DataFrame | None]) -> DataFrame | None:
    return None if raw is None else build(raw)


def _or_empty(spark: SparkSession, table: DataFrame | None, schema: str) -> DataFrame:
    return empty_table(spark, schema) if table is None else table


def _labels(spark: SparkSession, given: PlanInputs) -> DataFrame:
    manual = _if_given(given.manual_labels, inputs.model_labels)
    previous = _if_given(given.previous_report, lambda raw: inputs.model_labels(raw, schemas.REPORT_MODEL))
    return inputs.merge_labels(
        _or_empty(spark, manual, schemas.MODEL_LABELS), _or_empty(spark, previous, schemas.MODEL_LABELS)
    )


def _label_conflicts(spark: SparkSession, given: PlanInputs) -> DataFrame:
    """Departments that the manual labels or the previous report list with different labels."""
    out = empty_table(spark, schemas.LABEL_CONFLICTS)
    if given.manual_labels is not None:
        out = out.unionByName(inputs.label_conflicts(given.manual_labels, "manual"))
    if given.previous_report is not None:
        out = out.unionByName(inputs.label_conflicts(given.previous_report, "previous", schemas.REPORT_MODEL))
    return out


def _require_unique(departments: DataFrame) -> None:
    clash = inputs.map_conflicts(departments).take(1)
    if clash:
        raise ValueError(f"department {clash[0][0]} is listed {clash[0][1]} times in the department map")


def _side_tables(
    spark: SparkSession, given: PlanInputs, p: PlanParams, departments: DataFrame
) -> dict[str, DataFrame]:
    """Monthly side inputs; an absent input becomes an empty typed table."""
    if given.backlog_daily is not None:
        backlog = inputs.inherited_backlog(given.backlog_daily)
    else:
        backlog = _if_given(given.backlog_monthly, inputs.backlog_monthly)
    typed_agent_days = _if_given(given.agent_days, inputs.agent_days)
    made = {
        "deflection": (
            _if_given(given.deflection, lambda raw: inputs.deflection_monthly(raw, departments)),
            schemas.MONTHLY_DEFLECTION,
        ),
        "calls": (
            _if_given(given.calls, lambda raw: inputs.calls_monthly(raw, departments)),
            schemas.MONTHLY_CALLS,
        ),
        "repeats": (_if_given(given.repeats, inputs.repeats_monthly), schemas.MONTHLY_REPEATS),
        "backlog": (backlog, schemas.MONTHLY_BACKLOG),
        "backlog_mean": (
            _if_given(given.backlog_open, inputs.backlog_mean_of_days), schemas.MONTHLY_BACKLOG_MEAN,
        ),
        "capacity_history": (
            _if_given(
                given.capacity_history, lambda raw: capacity.historical_capacity(raw, p.tickets_per_hour)
            ),
            schemas.MONTHLY_CAPACITY,
        ),
        "agents": (_if_given(typed_agent_days, capacity.agent_capacity), schemas.MONTHLY_AGENTS),
    }
    return {name: _or_empty(spark, table, schema) for name, (table, schema) in made.items()}


def run_workforce_plan(spark: SparkSession, given: PlanInputs, params: PlanParams) -> PlanTables:
    """Run a plan and return its tables by name.

    Each raw input is scanned once: its monthly (or daily) sums are written to
    the shared folder and read back, and everything after works on those. The
    report tables are lazy; ``staffcast.sources.sinks.write_tables`` saves them.
    The run log has the rows counted while the stages were written.
    """
    p = params
    stages = Stages(spark)
    departments = stages.keep("departments", inputs.department_map(given.department_map))
    _require_unique(departments)
    scoped = scope.departments_in_scope(departments, p.verticals, p.exclude_tokens)
    # one scan of the tickets serves the forecasts and the monthly actuals
    all_daily = volumes.daily_tickets(inputs.incoming(given.incoming))
    side = stages.keep_all(_side_tables(spark, given, p, departments) | {
        "daily_tickets": all_daily.join(scoped.select("department_id"), "department_id", "left_semi")
    })
    daily, calls, backlog = side.pop("daily_tickets"), side["calls"], side["backlog"]

    actuals = volumes.monthly_actuals(daily, scoped)
    if p.uplift_by_calls:
        actuals = volumes.uplift_by_calls(actuals, calls)
    daily_fc = forecasts.daily_forecast(daily, _labels(spark, given), p.horizon_days, p.min_days, p.fit_series)
    backlog_fc = forecasts.backlog_forecast(backlog, p.horizon_months, p.min_months, p.fit_series)
    made = stages.keep_all({
        "monthly_actuals": actuals,
        "daily_forecast": scope.attach_departments(daily_fc, scoped),
        "backlog_forecast": backlog_fc,
        "implausible_series": forecasts.implausible_series(daily),
        "label_conflicts": _label_conflicts(spark, given),
    }, daily_forecast={"failed_days": F.count_if("engine_failed")})
    actuals, daily_fc = made["monthly_actuals"], made["daily_forecast"]
    monthly_fc = forecasts.monthly_rollup(daily_fc.drop("vertical", "department_name"), scoped)

    errors = given.model_errors
    if errors is None:
        errors = with_department_names(published_model_errors(spark), departments)
    adjusted = adjust.apply_deflection(
        monthly_fc, rates.deflection_rate(actuals, side["deflection"], p.deflection_zero_as)
    )
    adjusted = adjust.forecast_calls(adjusted, rates.calls_rate(actuals, calls))
    adjusted = adjust.forecast_repeats(adjusted, rates.repeats_rate(actuals, side["repeats"]))
    adjusted = adjust.attach_backlog(adjusted, backlog, made["backlog_forecast"])
    adjusted = stages.keep("adjusted", adjust.calibrate(adjusted, errors), calibrated_rows=F.count_if(F.col("calib_factor") != 1.0))
    forecasts.check_quantiles(adjusted)
    raw_monthly = adjusted.select(*monthly_fc.columns)

    capacity_all = capacity.with_projection(
        side["capacity_history"],
        capacity.project_capacity(side["capacity_history"], actuals, p.as_of, p.horizon_months),
    )
    expected = report.add_history_months(
        report.expected_volumes(adjusted, actuals, p.forecast_base), actuals, p.year
    )
    keys = ["department_id", "month"]
    facts = (
        expected
        .join(calls.select(*keys, F.col("calls_not_indexed").alias("calls_not_indexed_actual")), keys, "left")
        .join(side["repeats"].select(*keys, F.col("repeats_workload").alias("repeats_actual")), keys, "left")
        .join(side["backlog_mean"], keys, "left")
        .join(backlog.select(*keys, F.col("inventory").alias("inventory_known")), keys, "left")
    )
    # months without a forecast show the backlog they had
    facts = facts.withColumn("inventory_final", F.coalesce("inventory_final", "inventory_known")).drop("inventory_known")
    facts = stages.keep(
        "facts", capacity.consolidate(facts, side["agents"], capacity_all, p.productivity_from_agents)
    )

    def boards() -> DataFrame:
        return report.board_months(facts, *p.board_range, p.board_zero_fill)

    return PlanTables({
        "Monthly_Actuals": lambda: actuals,
        "Monthly_Forecast_RAW": lambda: raw_monthly,
        "Monthly_Forecast_CAL": lambda: adjusted,
        "Monthly_Capacity_Hist": lambda: side["capacity_history"],
        "Monthly_Capacity_All": lambda: capacity_all,
        "Monthly_Inventory": lambda: side["backlog_mean"],
        "Model_Used_and_Error": lambda: errors,
        "Daily_Forecast": lambda: daily_fc,
        "Backlog_Forecast": lambda: made["backlog_forecast"],
        "Implausible_Series": lambda: made["implausible_series"],
        "Label_Conflicts": lambda: made["label_conflicts"],
        "boards": lambda: report.board_wide(boards(), *p.board_range),
        "board_kpis_long": lambda: report.board_long(boards()),
        "capacity_report": lambda: report.capacity_report(facts),
        "workload_report": lambda: report.workload_report(facts),
        "run_log": lambda: run_log(spark, stages.metrics, p.horizon_days),
    })


def run_log(spark: SparkSession, metrics: Mapping[str, Mapping[str, int]], horizon_days: int) -> DataFrame:
    """Rows per stage, as one table ``stage, rows``, from what was counted while the stages were written."""
    rows = {stage: counted["rows"] for stage, counted in metrics.items()}
    rows["monthly_forecast"] = rows.pop("adjusted")
    rows["calibrated_rows"] = metrics["adjusted"]["calibrated_rows"]
    # every department has as many forecast rows as the horizon has days
    rows["engine_failures"] = metrics["daily_forecast"]["failed_days"] // horizon_days
    return spark.createDataFrame(sorted(rows.items()), "stage string, rows bigint")
