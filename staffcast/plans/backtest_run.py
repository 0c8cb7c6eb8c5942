"""The backtest: tables of an input folder in, errors and recommended models of an output folder out.

The next monthly run with the same output folder reads both: the models as labels, the errors
as the bias to calibrate by.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from staffcast.deploy import ship_package
from staffcast.operators import backtest, volumes
from staffcast.plans.monthly_run import read_inputs
from staffcast.sources import inputs
from staffcast.sources.sinks import Stages, write_tables


def run_backtest(
    spark: SparkSession, input_folder: str, output_folder: str, as_of: str, months: int = 12,
    engines: Sequence[str] = backtest.ENGINES,
) -> dict[str, DataFrame]:
    """Test the engines on the last `months` whole months before `as_of` and write the tables
    `backtest_months`, `backtest_errors`, `recommended_models` and `model_errors`."""
    ship_package(spark)
    given = read_inputs(spark, input_folder, output_folder)
    stages = Stages(spark)
    daily = stages.keep("daily_tickets", volumes.daily_tickets(inputs.incoming(given.incoming)))
    tested = stages.keep("tested", backtest.backtest_months(daily, backtest.tested_months(as_of, months), engines))
    errors = stages.keep("errors", backtest.backtest_errors(tested))
    tables = {
        "backtest_months": tested,
        "backtest_errors": errors,
        "recommended_models": backtest.recommended_models(errors, engines),
        "model_errors": backtest.measured_errors(errors, inputs.department_map(given.department_map), engines),
    }
    write_tables(tables, output_folder.rstrip("/"))
    return tables


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m staffcast.plans.backtest_run", description=__doc__)
    parser.add_argument("inputs")
    parser.add_argument("outputs")
    parser.add_argument("--as-of", required=True, help="ISO date that stands for today")
    parser.add_argument("--months", type=int, default=12, help="whole months before that date to test")
    parser.add_argument("--engines", nargs="+", default=list(backtest.ENGINES))
    chosen = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("staffcast backtest").getOrCreate()
    tables = run_backtest(spark, chosen.inputs, chosen.outputs, chosen.as_of, chosen.months, chosen.engines)
    tables["backtest_errors"].orderBy("department_id", "engine").show(truncate=False)


if __name__ == "__main__":
    main()
