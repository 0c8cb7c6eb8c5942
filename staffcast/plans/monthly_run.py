"""The monthly run: tables of an input folder in, report tables of an output folder out."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession

from staffcast.deploy import ship_package
from staffcast.plans.params import PlanParams
from staffcast.plans.workforce import PlanInputs, PlanTables, run_workforce_plan
from staffcast.sources.sinks import write_boards, write_tables
from staffcast.sources.tables import read_first

# The input folder holds one table per input, named as the fields of ``PlanInputs``.
INPUT_TABLES = [field.name for field in fields(PlanInputs) if field.name != "previous_report"]
REQUIRED = ("incoming", "department_map")
SKIP_IF_EMPTY = ("Monthly_Capacity_Hist", "Monthly_Capacity_All", "Monthly_Inventory")
# Tables with a row per department and month, which can be kept month by month.
MONTHLY = (
    "Monthly_Actuals", "Monthly_Forecast_RAW", "Monthly_Forecast_CAL", "Monthly_Capacity_Hist", "Monthly_Capacity_All",
    "Monthly_Inventory", "Backlog_Forecast",
)


def _find(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    return read_first(spark, [f"{folder}/{name}{suffix}" for suffix in (".parquet", ".csv", "")])


def read_inputs(spark: SparkSession, input_folder: str, output_folder: str) -> PlanInputs:
    """Find each input as parquet or CSV. The model report comes from the output folder, where the
    backtest leaves it, and so do its errors unless the inputs have a table of their own."""
    folder = input_folder.rstrip("/")
    found = {name: _find(spark, folder, name) for name in INPUT_TABLES}
    missing = [field for field in REQUIRED if found[field] is None]
    if missing:
        raise FileNotFoundError(f"no table for {', '.join(missing)} in {folder}")
    previous = _find(spark, output_folder.rstrip("/"), "recommended_models")
    if found["model_errors"] is None:
        found["model_errors"] = _find(spark, output_folder.rstrip("/"), "model_errors")
    return PlanInputs(previous_report=previous, **found)


def run_monthly(
    spark: SparkSession, input_folder: str, output_folder: str, params: PlanParams, by_month: bool = False
) -> PlanTables:
    """Run the plan on a folder of tables and write every result table.

    With `by_month` the monthly tables have a folder per month, and a run replaces only the
    months that it computes: the forecasts of months gone by stay as they were.
    """
    ship_package(spark)
    tables = run_workforce_plan(spark, read_inputs(spark, input_folder, output_folder), params)
    out = output_folder.rstrip("/")
    write_tables(
        {n: t for n, t in tables.items() if n != "boards"}, out, skip_if_empty=SKIP_IF_EMPTY, by_month=MONTHLY if by_month else ())
    write_boards(tables["boards"], f"{out}/boards", params.board_suffix)
    return tables


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m staffcast.plans.monthly_run", description=__doc__)
    parser.add_argument("inputs")
    parser.add_argument("outputs")
    parser.add_argument("--as-of", required=True, help="ISO date that stands for today")
    parser.add_argument("--verticals", nargs="*", help="verticals to keep; none after the flag keeps all")
    parser.add_argument("--exclude-tokens", nargs="*", help="parts of names that leave a department out")
    parser.add_argument("--horizon-days", type=int)
    parser.add_argument("--horizon-months", type=int)
    parser.add_argument("--tickets-per-hour", type=float)
    parser.add_argument("--uplift-by-calls", action="store_true", default=None)
    parser.add_argument("--board-first", help="first month of the boards; by default January of the year of --as-of")
    parser.add_argument("--board-last", help="last month of the boards; by default February of the year after")
    parser.add_argument("--by-month", action="store_true", help="keep monthly tables by month and replace only this run's months")
    chosen = vars(parser.parse_args(arguments))
    source, target, as_of, by_month = (chosen.pop(k) for k in ("inputs", "outputs", "as_of", "by_month"))
    scope = {name: value for name, value in chosen.items() if value is not None}
    if "verticals" in scope:
        scope["verticals"] = tuple(scope["verticals"]) or None
    if "exclude_tokens" in scope:
        scope["exclude_tokens"] = tuple(scope["exclude_tokens"])
    spark = SparkSession.builder.appName("staffcast monthly run").getOrCreate()
    tables = run_monthly(spark, source, target, PlanParams(as_of=as_of, **scope), by_month)
    tables["run_log"].show(truncate=False)


if __name__ == "__main__":
    main()
