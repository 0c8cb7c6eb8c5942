"""Logical tables: their Spark types and the column names accepted for each field."""

from __future__ import annotations

DEPARTMENT_MAP = "department_id bigint, department_name string, vertical string"
MONTHLY_DEFLECTION = "department_id bigint, month date, solved double"
MONTHLY_CALLS = "department_id bigint, month date, calls_not_indexed double"
MONTHLY_REPEATS = "department_id bigint, month date, repeats_workload double"
MONTHLY_BACKLOG = "department_id bigint, month date, inventory double"
MONTHLY_BACKLOG_MEAN = "department_id bigint, month date, inventory_mean double"
MONTHLY_CAPACITY = "department_id bigint, month date, capacity double"
MONTHLY_AGENTS = "department_id bigint, month date, capacity_agents double, productivity_agents double"
MODEL_LABELS = "department_id bigint, model string"
MODEL_ERRORS = (
    "vertical string, department_id bigint, department_name string, model_used string, "
    "backtest_months int, mape_pct double, wape_pct double, bias_pct double"
)

# Accepted column names, tried in this order.
DATE = ("Date", "date")
DEPARTMENT_ID = ("department_id", "dept_id", "Department_ID")
TICKET_TOTAL = ("ticket_total", "Ticket_Total", "count", "tickets", "qty")
MAP_NAME = ("department_name", "Department", "dept_name", "Department_Name")
MAP_VERTICAL = ("vertical", "Vertical")
DEFLECTION_SOLVED = ("Not_Reopened", "not_reopened", "Not Reopened", "NotReopened")
DEFLECTION_YEAR = ("Week_Year", "Year", "year")
DEFLECTION_MONTH = ("Month_number", "month_number", "Month", "month")
DEFLECTION_NAME = ("department", "department_name", "Department", "Department_name")
CALLS_DATE = ("Created Date", "CreatedDate", "Date", "date")
CALLS_TEAM = ("User Team", "Team", "department_name", "Department", "Department_name")
CALLS_QUANTITY = ("calls_not_indexed", "call_not_indexed", "Volume", "Qty", "count", "tickets")
REPEATS_DEPARTMENT = ("department_id", "dept_id", "Department_ID", "department")
REPEATS_DATE = ("Date", "date", "Month", "month", "MonthDate")
REPEATS_VALUE = (
    "repeat_touchpoints", "repeats", "repeat_items", "RR", "rr_items", "total_touchpoints_7d",
)
BACKLOG_CASE = ("case_number", "Case Number", "case", "Case")
BACKLOG_OPENED = ("date_opened", "Date Opened", "opened_date", "Opened Date")
BACKLOG_STATUS = ("status", "Status")
BACKLOG_MONTH = ("month_start", "Month_Start", "month", "Month", "date", "Date")
BACKLOG_COUNT = (
    "inherited_cases", "Inherited_Cases", "inventory", "Inventory", "backlog", "Backlog",
)
CAPACITY_MONTH = ("MonthStartDate", "monthstartdate")
CAPACITY_YEAR = ("Year", "year")
CAPACITY_MONTH_NUMBER = ("Month_number", "month_number", "month")
CAPACITY_TOTAL = ("productivity_total", "prod_total_model")
CAPACITY_PER_DAY = ("avg_per_day",)
CAPACITY_HOURS = ("productive",)
AGENT_DATE = ("date", "Date", "work_date")
AGENT_ID = ("agent_id", "Agent_ID", "worker_id")
AGENT_TARGET = ("item_target_day", "target_day", "item_target")
AGENT_PRODUCTION = ("prod_total_model", "productivity", "prod_model")
LABEL_MODEL = ("model",)
REPORT_MODEL = ("Recommended_Model",)
LABEL_SEQUENCE = ("sequence", "row_number", "updated_at")
LABEL_CONFLICTS = "source string, department_id bigint, entries bigint, labels string, kept string, decided_by string"
