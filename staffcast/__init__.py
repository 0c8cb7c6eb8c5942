"""Demand forecasting and staffing analytics on Spark DataFrames."""

from staffcast.plans.params import PlanParams
from staffcast.plans.workforce import PlanInputs, run_workforce_plan

__all__ = ["PlanInputs", "PlanParams", "run_workforce_plan"]
