"""Registered queries: one per operator family, over the generated tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from staffcast.catalog.bindings import TOKENS, VERTICALS, Bindings
from staffcast.catalog.registry import all_queries as all_queries, query
from staffcast.functions.columns import month_start
from staffcast.functions.scalar import board_key, month_label, working_days
from staffcast.operators import (
    adjust, backtest, calendar, capacity, fitting, forecasts, rates, reference_data, report, scope, volumes,
)
from staffcast.plans.params import PlanParams
from staffcast.plans.workforce import PlanInputs, PlanTables, run_workforce_plan
from staffcast.sources import inputs, schemas
from staffcast.sources.sinks import Stages, read_months, write_boards, write_months, write_tables
from staffcast.sources.tables import (
    empty_table, published_model_errors, read_first, read_table, with_department_names,
)

PLAN = PlanParams(
    as_of="2001-06-30", verticals=VERTICALS, exclude_tokens=TOKENS,
    board_first="2001-01-01", board_last="2002-02-01",
)
NAIVE_PLAN = replace(PLAN, fit_series=False)


# --- sources, columns, scope -------------------------------------------------


@query
def incoming_normalised(b: Bindings) -> DataFrame:
    return inputs.incoming(b.incoming_text())


@query
def default_ticket_count(b: Bindings) -> DataFrame:
    return volumes.daily_tickets(inputs.incoming(b.incoming_events()))


@query
def scoped_departments(b: Bindings) -> DataFrame:
    return b.scoped()


@query
def map_conflicts(b: Bindings) -> DataFrame:
    raw = b.table("customer").select(
        F.col("c_nationkey").alias("department_id"), F.col("c_mktsegment").alias("department_name"),
        F.lit("ALL").alias("vertical"),
    )
    return inputs.map_conflicts(inputs.department_map(raw))


@query
def source_fallback(b: Bindings) -> DataFrame:
    raw = read_first(b.spark, [f"{b.folder}/orders_daily.parquet", f"{b.folder}/orders.parquet"])
    return raw.groupBy(month_start(F.col("o_orderdate")).alias("month")).agg(F.count("*").alias("rows"))


@query
def absent_source(b: Bindings) -> DataFrame:
    """Rates when the bot table does not exist: every department gets 0."""
    raw = read_first(b.spark, [f"{b.folder}/solved.csv", f"{b.folder}/solved.parquet"])
    solved = empty_table(b.spark, schemas.MONTHLY_DEFLECTION) if raw is None else raw
    return rates.deflection_rate(b.actuals(), solved)


@query
def labels_merge(b: Bindings) -> DataFrame:
    folder = Stages(b.spark).folder
    write_tables({"manual.csv": b.manual_labels()}, folder, format="csv")
    write_tables({"previous": b.previous_report()}, folder)
    manual = read_table(b.spark, f"{folder}/manual.csv", schemas.MODEL_LABELS)
    previous = read_table(b.spark, f"{folder}/previous")
    return inputs.merge_labels(
        inputs.model_labels(manual), inputs.model_labels(previous, schemas.REPORT_MODEL)
    )


@query
def model_error_table(b: Bindings) -> DataFrame:
    return b.model_errors()


# --- monthly volumes ---------------------------------------------------------


@query
def daily_tickets(b: Bindings) -> DataFrame:
    return b.daily()


@query
def monthly_actuals(b: Bindings) -> DataFrame:
    return b.actuals()


@query
def training_uplift(b: Bindings) -> DataFrame:
    return volumes.uplift_by_calls(b.actuals(), inputs.calls_monthly(b.calls_summed(), b.departments()))


@query
def deflection_monthly_form(b: Bindings) -> DataFrame:
    return inputs.deflection_monthly(b.deflection(), b.departments())


@query
def deflection_by_name(b: Bindings) -> DataFrame:
    return inputs.deflection_monthly(b.deflection_named(), b.departments())


@query
def deflection_event_form(b: Bindings) -> DataFrame:
    return inputs.deflection_monthly(b.deflection_events(), b.departments())


@query
def calls_monthly_quantity(b: Bindings) -> DataFrame:
    return inputs.calls_monthly(b.calls_summed(), b.departments())


@query
def calls_monthly_by_team(b: Bindings) -> DataFrame:
    return inputs.calls_monthly(b.calls_counted(), b.departments())


@query
def repeats_monthly(b: Bindings) -> DataFrame:
    return inputs.repeats_monthly(b.repeats())


@query
def inherited_backlog(b: Bindings) -> DataFrame:
    return inputs.inherited_backlog(b.backlog_daily())


@query
def backlog_monthly_form(b: Bindings) -> DataFrame:
    return inputs.backlog_monthly(b.backlog_monthly())


@query
def backlog_mean_of_days(b: Bindings) -> DataFrame:
    return inputs.backlog_mean_of_days(b.backlog_open())


# --- recent rates ------------------------------------------------------------


@query
def recent_deflection_rate(b: Bindings) -> DataFrame:
    return rates.deflection_rate(b.actuals(), inputs.deflection_monthly(b.deflection(), b.departments()))


@query
def recent_deflection_rate_zero(b: Bindings) -> DataFrame:
    solved = inputs.deflection_monthly(b.deflection_events(), b.departments())
    return rates.deflection_rate(b.actuals(), solved, zero_as=0.0)


@query
def recent_calls_rate(b: Bindings) -> DataFrame:
    return rates.calls_rate(b.actuals(), inputs.calls_monthly(b.calls_counted(), b.departments()))


@query
def calls_rates_kept(b: Bindings) -> DataFrame:
    calls = inputs.calls_monthly(b.calls_counted(), b.departments())
    return rates.monthly_rates(b.actuals(), calls, "calls_not_indexed").where("rate < 3.0")


@query
def recent_repeats_rate(b: Bindings) -> DataFrame:
    return rates.repeats_rate(b.actuals(), inputs.repeats_monthly(b.repeats()))


# --- calendar ----------------------------------------------------------------


@query
def dense_daily(b: Bindings) -> DataFrame:
    return calendar.dense_daily(b.daily())


@query
def dense_monthly(b: Bindings) -> DataFrame:
    return calendar.dense_monthly(inputs.inherited_backlog(b.backlog_daily()), "inventory")


@query
def horizon_daily(b: Bindings) -> DataFrame:
    last = b.daily().groupBy("department_id").agg(F.max("date").alias("last_day"))
    return calendar.future_days(last, "last_day", 365).select("department_id", "step", "date")


@query
def horizon_monthly(b: Bindings) -> DataFrame:
    last = b.actuals().groupBy("department_id").agg(F.max("month").alias("last_month"))
    return calendar.future_months(last, "last_month", 12).select("department_id", "step", "month")


@query
def daily_profile(b: Bindings) -> DataFrame:
    profile = forecasts.daily_profile(b.daily())
    return profile.withColumns({
        "first_of_week": F.element_at("last_week", 1),
        "week_sum": F.aggregate("last_week", F.lit(0.0), lambda total, v: total + v),
        "next_day": F.date_add("last_day", 1),
    }).drop("last_week")


@query
def backlog_profile(b: Bindings) -> DataFrame:
    return forecasts.backlog_profile(inputs.inherited_backlog(b.backlog_daily()))


@query
def working_days_per_month(b: Bindings) -> DataFrame:
    months = b.table("lineitem").select(month_start(F.col("l_shipdate")).alias("month")).distinct()
    return months.select(
        "month", month_label(F.col("month")).alias("label"), working_days(F.col("month")).alias("working_days")
    )


# --- forecasts ---------------------------------------------------------------


@query
def seasonal_naive_daily(b: Bindings) -> DataFrame:
    return forecasts.seasonal_naive_daily(b.daily())


@query
def short_series_forecast(b: Bindings) -> DataFrame:
    """30-day series through the full dispatch: too short to fit, so the last week repeats."""
    return forecasts.daily_forecast(b.daily_events())


@query
def monthly_rollup(b: Bindings) -> DataFrame:
    return forecasts.monthly_rollup(forecasts.seasonal_naive_daily(b.daily()), b.scoped())


@query
def quantile_violations(b: Bindings) -> DataFrame:
    """Lines as quantile triples, so some rows are out of order."""
    triples = b.table("lineitem").groupBy(
        F.col("l_suppkey").alias("department_id"), month_start(F.col("l_shipdate")).alias("month")
    ).agg(
        F.avg("l_quantity").alias("forecast_p50"), F.min("l_linenumber").cast("double").alias("forecast_p05"),
        (F.max("l_quantity") - 10).alias("forecast_p95"),
    )
    return forecasts.quantile_violations(triples)


@query
def stl_daily_forecast(b: Bindings) -> DataFrame:
    return forecasts.daily_forecast(b.daily())


def _log_steps(fc: DataFrame, step: int, key: str) -> DataFrame:
    """Forecast rows with the log of the middle value and of the same place one cycle before."""
    order = Window.partitionBy("department_id").orderBy(key)
    return fc.withColumns({
        "z": F.log1p("p50"), "before": F.lag(F.log1p("p50"), step).over(order),
        "up": F.log1p("p95") - F.log1p("p50"), "down": F.log1p("p50") - F.log1p("p05"),
    })


def _invariants(fc: DataFrame, step: int, key: str) -> DataFrame:
    """Per department: rows, and those that break the shape of a decomposed forecast.

    Its log repeats after one cycle, and its band is as wide above as below on the log scale
    where nothing is raised to 0.
    """
    steps = _log_steps(fc, step, key)
    return steps.groupBy("department_id", "path_used").agg(
        F.count("*").alias("rows"),
        F.count_if((F.col("p50") > 0) & (F.abs(F.col("z") - F.col("before")) > 1e-9)).alias("not_periodic"),
        F.count_if((F.col("p05") > 0) & (F.abs(F.col("up") - F.col("down")) > 1e-9)).alias("lopsided"),
        F.count_if((F.col("p05") < 0) | (F.col("p05") > F.col("p50")) | (F.col("p50") > F.col("p95"))).alias("out_of_order"),
    )


@query
def stl_forecast_invariants(b: Bindings) -> DataFrame:
    """Shape of the fitted daily forecasts of all departments."""
    return _invariants(forecasts.daily_forecast(b.daily()), 7, "date")


@query
def backlog_fit_invariants(b: Bindings) -> DataFrame:
    """Shape of the fitted monthly backlog forecasts of all departments."""
    return _invariants(forecasts.backlog_forecast(inputs.backlog_monthly(b.backlog_monthly())), 12, "month")


@query
def implausible_series(b: Bindings) -> DataFrame:
    """Departments whose tickets span more than five years, to check the report on bad dates."""
    return forecasts.implausible_series(b.daily(), 1826)


@query
def naive_spread_short(b: Bindings) -> DataFrame:
    """Profile and spread of series of one to seven days: all events by user and calendar week."""
    week = F.date_diff(F.col("ts").cast("date"), F.lit("1970-01-05").cast("date"))
    rows = b.table("events").select(
        (F.col("user_id") * 100_000 + F.floor(week / 7)).alias("department_id"), F.col("ts").alias("date"))
    profile = forecasts.daily_profile(volumes.daily_tickets(inputs.incoming(rows)))
    return profile.select("department_id", "days", "mean_tickets", forecasts._naive_sd().alias("spread"))


@query
def published_error_calibration(b: Bindings) -> DataFrame:
    """The published error record with names of the map, and the factor that follows from each bias."""
    errors = with_department_names(published_model_errors(b.spark), b.departments())
    return errors.join(adjust.calibration_factors(errors), "department_id").select(
        "department_id", "department_name", "mape_pct", "wape_pct", "bias_pct", "calib_factor")


@query
def stl_reconstruction(b: Bindings) -> DataFrame:
    parts = fitting.decompose_daily(b.daily())
    return parts.groupBy("department_id").agg(
        F.count("*").alias("days"),
        F.sum(F.col("trend") + F.col("seasonal") + F.col("remainder")).alias("log_sum"),
    )


@query
def engine_dispatch(b: Bindings) -> DataFrame:
    """Forecast with merged labels, summarised per department."""
    fc = forecasts.daily_forecast(b.daily(), b.labels())
    return fc.groupBy("department_id", "engine_used", "path_used").agg(
        F.count("*").alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.sum((F.col("p05") > F.col("p50")).cast("int")).alias("low_above_middle"),
        F.count(F.when((F.col("p50") > 0) & (F.col("p50") > F.col("p95")), 1)).alias("middle_above_high"),
        F.count(F.when(F.col("p05") < 0, 1)).alias("negative"),
    )


@query
def sarima_daily_forecast(b: Bindings) -> DataFrame:
    labels = b.departments().select("department_id", F.lit("SARIMAX-7").alias("model"))
    return forecasts.daily_forecast(b.daily(), labels)


@query
def sarima_recursion(b: Bindings) -> DataFrame:
    """The seasonal ARMA of all departments, row by row: days seen and forecast, rows that break
    the model's recursion, coefficients out of bounds, and forecast rows that don't follow from it.

    With noise e, z[t] = a z[t-1] + A z[t-7] - aA z[t-8] + e[t] + m e[t-1] + M e[t-7] + mM e[t-8],
    over the past, whose noise is the residual, and over the forecast, whose noise is 0.
    """
    stages = Stages(b.spark)
    daily = stages.keep("daily_tickets", b.daily())
    steps = stages.keep("steps", fitting.arma_steps(daily, 365))
    at = Window.partitionBy("department_id").orderBy("step")
    lags = {f"{c}{k}": F.lag(c, k).over(at) for c in ("z", "noise") for k in (1, 7, 8)}
    a, big_a, m, big_m = (F.col(c) for c in ("a", "big_a", "m", "big_m"))
    expected = (a * F.col("z1") + big_a * F.col("z7") - a * big_a * F.col("z8")
                + F.col("noise") + m * F.col("noise1") + big_m * F.col("noise7") + m * big_m * F.col("noise8"))
    traced = steps.withColumns(lags).withColumn("gap", F.abs(F.col("z") - expected))
    labels = b.departments().select("department_id", F.lit("SARIMAX-7").alias("model"))
    made = forecasts.daily_forecast(daily, labels).join(
        forecasts.daily_profile(daily).select("department_id", F.coalesce("lag_sd", F.lit(1.0)).alias("sd")), "department_id")
    rows = traced.join(made, ["department_id", "date"], "left")
    mean = F.greatest(F.expm1("z"), F.lit(0.0))
    band = forecasts.BAND * F.col("sd")

    def differs(value: Column, expected: Column) -> Column:
        return F.coalesce(F.abs(value - expected) > 1e-9 * (1 + F.abs(expected)), F.lit(True))

    bound = F.greatest(F.abs(a), F.abs(big_a)) > 1
    ma_bound = F.greatest(F.abs(m), F.abs(big_m)) > 0.98
    return rows.groupBy("department_id").agg(
        F.count_if(~F.col("ahead")).alias("days"), F.count_if("ahead").alias("steps"), F.min(F.when(F.col("ahead"), F.col("date"))).alias("first_day"),
        F.sum(F.when(~F.col("ahead"), F.col("z"))).alias("log_sum"),
        F.count_if((F.col("step") >= 8) & (F.coalesce("gap", F.lit(1.0)) > 1e-8)).alias("broken"),
        F.count_if(F.col("ahead") & (F.col("noise") != 0)).alias("noisy"), F.count_if(bound | ma_bound).alias("out_of_bounds"),
        F.count_if(F.col("ahead") & (
            differs(F.col("p50"), mean) | differs(F.col("p05"), F.greatest(mean - band, F.lit(0.0))) | differs(F.col("p95"), mean + band)
        )).alias("not_followed"))


@query
def backlog_hold_forecast(b: Bindings) -> DataFrame:
    return forecasts.backlog_forecast(inputs.inherited_backlog(b.backlog_daily()), fit=False)


@query
def backlog_stl_forecast(b: Bindings) -> DataFrame:
    return forecasts.backlog_forecast(inputs.backlog_monthly(b.backlog_monthly()))


# --- backtest ---------------------------------------------------------------

TESTED = [f"2000-{m:02d}-01" for m in range(7, 13)] + [f"2001-{m:02d}-01" for m in range(1, 7)]


def _thinned(b: Bindings) -> DataFrame:
    """Daily tickets with silent spells before tested months: some departments lack the 75 days
    before March 2001, others all days before October 2000."""
    silent = F.col("date").between("2000-12-16", "2001-02-28") & (F.col("department_id") % 4 == 1)
    young = (F.col("date") < "2000-10-01") & (F.col("department_id") % 4 == 2)
    return b.daily().where(~silent & ~young)


@query
def backtest_errors_naive(b: Bindings) -> DataFrame:
    return backtest.backtest_errors(backtest.backtest_months(b.daily(), TESTED, (backtest.NAIVE,)))


@query
def backtest_months_naive(b: Bindings) -> DataFrame:
    """Every tested month after silent spells: the horizon reaches its end, and none is lost."""
    return backtest.backtest_months(_thinned(b), TESTED, (backtest.NAIVE,)).drop("fit_error")


def _fitted_backtest(b: Bindings) -> DataFrame:
    return Stages(b.spark).keep("tested", backtest.backtest_months(b.daily(), TESTED))


@query
def backtest_invariants(b: Bindings) -> DataFrame:
    """Both fitted engines over all departments and months: coverage, actual volume, impossible values."""
    return _fitted_backtest(b).groupBy("department_id", "engine", "path_used").agg(
        F.count("*").alias("months"), F.sum("actual").alias("actual"), F.sum("horizon_days").alias("horizon_days"),
        F.count_if(~(F.col("forecast") >= 0) | F.isnan("forecast")).alias("impossible"))


@query
def backtest_recommendation(b: Bindings) -> DataFrame:
    """The recommendation and its errors written and read as the monthly run reads them: departments
    by engine are whole, each has the engine of least error, and its bias makes the factor."""
    stages = Stages(b.spark)
    errors = stages.keep("errors", backtest.backtest_errors(_fitted_backtest(b)))
    write_tables({
        "recommended_models": backtest.recommended_models(errors),
        "model_errors": backtest.measured_errors(errors, b.departments()),
    }, stages.folder)
    labels = inputs.model_labels(read_table(b.spark, f"{stages.folder}/recommended_models"), schemas.REPORT_MODEL)
    measured = read_table(b.spark, f"{stages.folder}/model_errors")
    least = errors.groupBy("department_id").agg(F.min("wape_pct").alias("least"))
    chosen = labels.join(errors.withColumnRenamed("engine", "model"), ["department_id", "model"]).join(least, "department_id")
    factors = measured.select("department_id", "department_name", "model_used", F.col("bias_pct").alias("read_bias")).join(
        adjust.calibration_factors(measured), "department_id")
    kept_in = 1 - F.col("bias_pct") / 100
    inside = F.least(F.greatest(kept_in, F.lit(adjust.FACTOR_LOW)), F.lit(adjust.FACTOR_HIGH))
    return chosen.join(factors, "department_id").select(
        "department_id", "department_name", F.col("wape_pct").eqNullSafe(F.col("least")).alias("is_least"), "backtest_months",
        "months_without_forecast", ((F.col("model") == F.col("model_used")) & (F.col("bias_pct") == F.col("read_bias"))).alias("errors_follow"),
        (F.col("calib_factor") == inside).alias("factor_follows"))


# --- reference data ----------------------------------------------------------


@query
def tenure_targets(b: Bindings) -> DataFrame:
    return reference_data.tenure_targets(b.agents(), b.tenure_ranges(), PLAN.as_of)


@query
def holiday_flags(b: Bindings) -> DataFrame:
    return reference_data.holiday_flags(b.daily(), b.holidays())


# --- adjustments -------------------------------------------------------------


def _deflected(b: Bindings) -> DataFrame:
    solved = inputs.deflection_monthly(b.deflection(), b.departments())
    return adjust.apply_deflection(monthly_rollup(b), rates.deflection_rate(b.actuals(), solved))


@query
def deflection_applied(b: Bindings) -> DataFrame:
    return _deflected(b)


@query
def calls_and_repeats_forecast(b: Bindings) -> DataFrame:
    calls = inputs.calls_monthly(b.calls_counted(), b.departments())
    monthly = adjust.forecast_calls(monthly_rollup(b), rates.calls_rate(b.actuals(), calls))
    return adjust.forecast_repeats(
        monthly, rates.repeats_rate(b.actuals(), inputs.repeats_monthly(b.repeats()))
    )


@query
def backlog_final(b: Bindings) -> DataFrame:
    """Backlog of the months around the end of history: actual, else held forecast, else 0."""
    actual = inputs.inherited_backlog(b.backlog_daily())
    months = scope.attach_departments(
        calendar.month_grid(b.scoped().select("department_id"), "2000-06-01", "2003-12-01"), b.scoped()
    )
    return adjust.attach_backlog(months, actual, forecasts.backlog_forecast(actual, fit=False))


@query
def bias_calibration(b: Bindings) -> DataFrame:
    return adjust.calibrate(_deflected(b), b.model_errors())


@query
def identity_calibration(b: Bindings) -> DataFrame:
    return adjust.calibrate(_deflected(b), empty_table(b.spark, schemas.MODEL_ERRORS))


@query
def calibrated_share(b: Bindings) -> DataFrame:
    return adjust.calibrated_share(bias_calibration(b))


# --- capacity ----------------------------------------------------------------


@query
def agent_days_by_day(b: Bindings) -> DataFrame:
    return capacity.agent_days_by_day(inputs.agent_days(b.agent_days()))


@query
def agent_days_without_ids(b: Bindings) -> DataFrame:
    return capacity.agent_days_by_day(inputs.agent_days(b.agent_days().drop("worker_id")))


@query
def agent_days_by_outer_joins(b: Bindings) -> DataFrame:
    pieces = capacity.agent_day_pieces(inputs.agent_days(b.agent_days()))
    return capacity.join_agent_day_pieces(Stages(b.spark).keep("pieces", pieces))


@query
def agent_capacity(b: Bindings) -> DataFrame:
    return capacity.agent_capacity(inputs.agent_days(b.agent_days()))


@query
def historical_capacity_total(b: Bindings) -> DataFrame:
    return capacity.historical_capacity(b.capacity_history("productivity_total"))


@query
def historical_capacity_wdays(b: Bindings) -> DataFrame:
    return capacity.historical_capacity(b.capacity_history("avg_per_day"))


@query
def historical_capacity_hours(b: Bindings) -> DataFrame:
    return capacity.historical_capacity(b.capacity_history("productive"))


def _history(b: Bindings) -> DataFrame:
    return capacity.historical_capacity(b.capacity_history("productive"))


@query
def capacity_projection(b: Bindings) -> DataFrame:
    # the projection reads the monthly history twice, so it is kept
    history = Stages(b.spark).keep("history", _history(b))
    return capacity.project_capacity(history, b.actuals(), PLAN.as_of)


@query
def capacity_projection_from_actuals(b: Bindings) -> DataFrame:
    history = Stages(b.spark).keep("history", _history(b))
    projected = capacity.project_capacity(history, b.actuals(), PLAN.as_of, use_capacity_months=False)
    return capacity.with_projection(history, projected)


def _capacity_sides(b: Bindings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Actual and projected department months, capacity by agents, capacity by history and projection."""
    stages = Stages(b.spark)
    history, actuals = stages.keep("history", _history(b)), stages.keep("actuals", b.actuals())
    projected = stages.keep("projected", capacity.project_capacity(history, actuals, PLAN.as_of))
    months = scope.attach_departments(projected.select("department_id", "month"), b.scoped())
    months = months.join(actuals.select("department_id", "month"), ["department_id", "month"], "left_anti")
    rows = actuals.unionByName(months, allowMissingColumns=True)
    agents = capacity.agent_capacity(inputs.agent_days(b.agent_days()))
    return rows, agents, capacity.with_projection(history, projected)


@query
def capacity_consolidation(b: Bindings) -> DataFrame:
    """Months with agent rows, and projected months, which fall back to the history."""
    return capacity.consolidate(*_capacity_sides(b))


@query
def capacity_consolidation_plain(b: Bindings) -> DataFrame:
    """Productivity always equal to the capacity, as in the earliest boards."""
    return capacity.consolidate(*_capacity_sides(b), productivity_from_agents=False)


# --- reports -----------------------------------------------------------------


@query
def history_only_months(b: Bindings) -> DataFrame:
    # the two sides need different columns of the daily sums, so those are kept to scan the orders once
    daily = Stages(b.spark).keep("daily_tickets", b.daily())
    forecast_keys = forecasts.monthly_rollup(forecasts.seasonal_naive_daily(daily), b.scoped())
    return report.history_only_months(volumes.monthly_actuals(daily, b.scoped()), forecast_keys, PLAN.year)


@query
def expected_volumes_calibrated(b: Bindings) -> DataFrame:
    """Report columns with the calibrated forecast shown as the forecast."""
    daily = Stages(b.spark).keep("daily_tickets", b.daily())  # read by the forecast, the rates and the report
    actuals = volumes.monthly_actuals(daily, b.scoped())
    monthly = forecasts.monthly_rollup(forecasts.seasonal_naive_daily(daily), b.scoped())
    solved = inputs.deflection_monthly(b.deflection(), b.departments())
    adjusted = adjust.calibrate(adjust.apply_deflection(monthly, rates.deflection_rate(actuals, solved)), b.model_errors())
    expected = report.expected_volumes(adjusted, actuals, "forecast_p50_post_deflection_cal")
    return expected.select(
        *volumes.KEYS, "forecast", "forecast_base", "forecast_human_cases_cal", "deflected_forecast", "actual_volume"
    )


@query
def department_names(b: Bindings) -> DataFrame:
    return report.department_names(b.actuals())


@query
def board_keys(b: Bindings) -> DataFrame:
    """Board keys of customer names by market segment: long names and ``/`` and ``:`` occur."""
    names = b.table("customer").select(
        F.concat(F.col("c_name"), F.lit("/"), F.col("c_mktsegment"), F.lit(":x")).alias("name")
    )
    return names.select("name", board_key(F.col("name")).alias("board_key"))


def plan_inputs(b: Bindings) -> PlanInputs:
    sums = Stages(b.spark).keep("plan_sums", b.plan_sums())
    return PlanInputs(
        incoming=b.incoming(), department_map=b.department_map(), deflection=b.deflection(sums),
        calls=b.calls_counted(), repeats=b.repeats(), backlog_daily=b.backlog_daily(),
        backlog_open=b.backlog_open(), capacity_history=b.capacity_history("productive", sums),
        agent_days=b.agent_days(),
        manual_labels=b.manual_labels(), previous_report=b.previous_report(), model_errors=b.model_errors(),
    )


def _plan(b: Bindings, params: PlanParams) -> PlanTables:
    return run_workforce_plan(b.spark, plan_inputs(b), params)


@query
def workload_vs_capacity(b: Bindings) -> DataFrame:
    return _plan(b, NAIVE_PLAN)["workload_report"]


@query
def capacity_report(b: Bindings) -> DataFrame:
    return _plan(b, NAIVE_PLAN)["capacity_report"]


@query
def board_kpis_long(b: Bindings) -> DataFrame:
    return _plan(b, NAIVE_PLAN)["board_kpis_long"]


@query
def board_wide(b: Bindings) -> DataFrame:
    return _plan(b, NAIVE_PLAN)["boards"]


@query
def run_log(b: Bindings) -> DataFrame:
    return _plan(b, NAIVE_PLAN)["run_log"]


@query
def workload_with_fits(b: Bindings) -> DataFrame:
    return _plan(b, PLAN)["workload_report"]


@query
def workload_identities(b: Bindings) -> DataFrame:
    """The fitted plan: its columns that don't depend on a fit, and whether the others add up."""
    rows = workload_with_fits(b)
    human, calls, repeats = (F.col(f"`{c}`") for c in (
        "Forecast after deflection (Human cases)", "Calls not indexed (forecast)", "Repeats (forecast)"))
    total = F.col("`Workload Forecast (Humans + calls not indexed + repeats + inventory)`")
    parts = human + calls + repeats + F.col("Inventory")
    return rows.select(
        F.col("Month").alias("month"), F.col("Department_name").alias("department_name"),
        F.col("Actual Volume").alias("actual"), F.col("`Calls not indexed (actual)`").alias("calls"),
        F.col("`Repeats (actual)`").alias("repeats"), F.col("Capacity").alias("capacity"),
        F.col("Productivity").alias("productivity"), total.isNotNull().alias("has_forecast"),
        F.coalesce(F.abs(total - parts) > 1e-6, F.lit(False)).alias("parts_differ"),
        F.coalesce(F.abs(F.col("`Expected Workload vs Capacity`") - (total - F.col("Capacity"))) > 1e-6, F.lit(False)).alias("gap_differs"),
    )


def _board_rows(b: Bindings) -> DataFrame:
    # kept, because a board reads its rows twice: for the names and for the sums
    return Stages(b.spark).keep("monthly_actuals", b.actuals()).withColumns({
        "forecast": F.col("actual_volume") + F.dayofyear("month") % 5 - 2,
        "capacity": F.col("actual_volume") * 1.5 - 6, "productivity": F.col("actual_volume") + 1,
        "inventory_mean": F.col("actual_volume") / 8,
    })


def _small_boards(b: Bindings) -> DataFrame:
    return report.board_months(_board_rows(b), *PLAN.board_range)


@query
def board_months(b: Bindings) -> DataFrame:
    return _small_boards(b)


@query
def board_months_zero_filled(b: Bindings) -> DataFrame:
    """Odd months have no actual volume and no capacity; their sums show 0."""
    even = F.month("month") % 2 == 0
    rows = _board_rows(b).withColumns({c: F.when(even, F.col(c)) for c in ("actual_volume", "capacity")})
    return report.board_months(rows, *PLAN.board_range, zero_fill=True)


@query
def board_gap_text(b: Bindings) -> DataFrame:
    return report.capacity_gap_text(_small_boards(b))


@query
def board_folders(b: Bindings) -> DataFrame:
    """Boards written with a folder per department and read back; all names begin with the same 32 characters."""
    path = f"{Stages(b.spark).folder}/boards"
    alike = F.concat(F.lit("Specialists of the second level "), F.col("department_name"))
    boards = report.board_wide(_small_boards(b), *PLAN.board_range).withColumn("department_name", alike)
    write_boards(boards, path)
    back = read_table(b.spark, path).withColumn("department_id", F.col("department_id").cast("bigint"))
    return back.groupBy("department_id", "department_name", "board_key").agg(
        F.count("*").alias("kpis"), F.sum("`01-01`").alias("january"), F.sum("`06-01`").alias("june")
    )


@query
def months_rewritten(b: Bindings) -> DataFrame:
    """Actuals written by months; a second run doubles March and drops a vertical of April 2001 and
    leaves the other months alone. The first half of the year is read back."""
    path = f"{Stages(b.spark).folder}/actuals"
    actuals = Stages(b.spark).keep("actuals", b.actuals())
    write_months(actuals, path)
    march, april = (F.col("month") == F.lit(m).cast("date") for m in ("2001-03-01", "2001-04-01"))
    again = actuals.where(march | april & (F.col("vertical") != VERTICALS[0]))
    write_months(again.withColumn("actual_volume", F.col("actual_volume") * F.when(march, 2).otherwise(1)), path, files_per_month=2)
    schema = "vertical string, department_id bigint, department_name string, actual_volume double, month date"
    return read_months(b.spark, path, schema, "2001-01-01", "2001-06-01")


@query
def label_conflicts(b: Bindings) -> DataFrame:
    """Departments with several labels in two tables: with a sequence column, with equal places, and without one."""
    rows = b.labels_by_customer()
    with_order = inputs.label_conflicts(rows, "sequence")
    return with_order.unionByName(inputs.label_conflicts(rows.drop("Sequence"), "none"))


@query
def labels_in_sequence(b: Bindings) -> DataFrame:
    """The label of the last row by sequence, of several the greatest."""
    return inputs.model_labels(b.labels_by_customer())


@query
def written_tables(b: Bindings) -> DataFrame:
    """Tables written, replaced, skipped when empty, and read back."""
    folder = Stages(b.spark).folder
    empty = empty_table(b.spark, schemas.MONTHLY_CAPACITY)
    monthly = b.actuals()
    write_tables({"volume": monthly.where("month < '1996-01-01'")}, folder)
    names = write_tables({"volume": monthly, "none": empty}, folder, skip_if_empty=("none",))
    back = read_table(b.spark, f"{folder}/{names[0]}")
    return back.groupBy("vertical").agg(
        F.count("*").alias("rows"), F.sum("actual_volume").alias("volume"), F.lit(len(names)).alias("tables")
    )
