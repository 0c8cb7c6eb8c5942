"""From raw tables with varying headers to typed logical tables.

Row-level tables are only projected here. Where a table is keyed by department
*name*, it is summed per (name, month) before the name is looked up, so the join
never sees fact-sized input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from staffcast.functions.columns import (
    find_column, month_from_parts, month_start, quoted, require_columns, strip_headers,
    to_day, to_id, to_number,
)
from staffcast.functions.scalar import stripped
from staffcast.sources import schemas as S
from staffcast.sources.tables import empty_table


def incoming(raw: DataFrame) -> DataFrame:
    """Ticket rows ``date, department_id, ticket_total``; a missing count column means 1 per row."""
    raw = strip_headers(raw)
    c = require_columns(raw, "incoming", date=S.DATE, department_id=S.DEPARTMENT_ID)
    count = find_column(raw, S.TICKET_TOTAL)
    return raw.select(
        to_day(raw, c["date"]).alias("date"),
        to_id(raw, c["department_id"]).alias("department_id"),
        (to_number(raw, count) if count else F.lit(1.0)).alias("ticket_total"),
    )


def department_map(raw: DataFrame) -> DataFrame:
    """Distinct ``department_id, department_name, vertical``."""
    raw = strip_headers(raw)
    c = require_columns(
        raw, "department map",
        department_id=S.DEPARTMENT_ID, department_name=S.MAP_NAME, vertical=S.MAP_VERTICAL,
    )
    return raw.select(
        to_id(raw, c["department_id"]).alias("department_id"),
        quoted(c["department_name"]).alias("department_name"),
        quoted(c["vertical"]).alias("vertical"),
    ).distinct()


def map_conflicts(departments: DataFrame) -> DataFrame:
    """Department ids listed more than once; each would multiply its tickets in a join."""
    return (
        departments.where(F.col("department_id").isNotNull())
        .groupBy("department_id").agg(F.count("*").alias("entries"))
        .where("entries > 1")
    )


def ids_for_names(summed: DataFrame, departments: DataFrame, value: str) -> DataFrame:
    """Replace ``department_name`` by its id in a table already summed per (name, month)."""
    names = departments.select("department_id", "department_name").where("department_name is not null")
    return (
        summed.join(names, "department_name", "left")
        .where(F.col("department_id").isNotNull())
        .groupBy("department_id", "month").agg(F.sum(value).alias(value))
    )


def sum_by_month(rows: DataFrame, key: str, value: str, amount: Column | None = None) -> DataFrame:
    """Sum ``amount`` (or count rows) per key and month; rows with a null key are left out."""
    total = F.count("*").cast("double") if amount is None else F.sum(F.coalesce(amount, F.lit(0.0)))
    return (
        rows.where(F.col(key).isNotNull() & F.col("month").isNotNull())
        .groupBy(key, "month").agg(total.alias(value))
    )


def sum_by_parts(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Sum ``amount`` per key, year and month number, then turn the two numbers into a month.

    The month is built once per group instead of once per row.
    """
    parts = [key, "year", "month_number"]
    summed = rows.dropna(subset=parts).groupBy(*parts).agg(F.sum(F.coalesce("amount", F.lit(0.0))).alias(value))
    month = month_from_parts(F.col("year"), F.col("month_number"))
    return summed.select(key, month.alias("month"), value).where(F.col("month").isNotNull())


def _trimmed(name: str) -> Column:
    return stripped(quoted(name).cast("string"))


def deflection_monthly(raw: DataFrame, departments: DataFrame) -> DataFrame | None:
    """Solved-by-bot volume per department and month.

    Monthly form (year, month number, solved count; by id or by name) if its
    columns are present, else event form (one row per solved ticket), else None.
    """
    raw = strip_headers(raw)
    solved = find_column(raw, S.DEFLECTION_SOLVED)
    year, month_number = find_column(raw, S.DEFLECTION_YEAR), find_column(raw, S.DEFLECTION_MONTH)
    by_id, by_name = find_column(raw, S.DEPARTMENT_ID), find_column(raw, S.DEFLECTION_NAME)
    day = find_column(raw, S.DATE)
    if solved and year and month_number and (by_id or by_name):
        key = "department_id" if by_id else "department_name"
        rows = raw.select(
            (to_id(raw, by_id) if by_id else _trimmed(by_name)).alias(key),
            to_id(raw, year).alias("year"), to_id(raw, month_number).alias("month_number"),
            to_number(raw, solved).alias("amount"),
        )
        summed = sum_by_parts(rows, key, "solved")
        return summed if by_id else ids_for_names(summed, departments, "solved")
    if day and by_id:
        rows = raw.select(
            to_id(raw, by_id).alias("department_id"), month_start(to_day(raw, day)).alias("month")
        )
        return sum_by_month(rows, "department_id", "solved")
    return None


def calls_monthly(raw: DataFrame, departments: DataFrame) -> DataFrame:
    """Calls not indexed per department and month: summed quantity, or row count without one."""
    raw = strip_headers(raw)
    c = require_columns(raw, "calls not indexed", date=S.CALLS_DATE)
    by_id, team = find_column(raw, S.DEPARTMENT_ID), find_column(raw, S.CALLS_TEAM)
    quantity = find_column(raw, S.CALLS_QUANTITY)
    if not by_id and not team:
        raise KeyError(f"calls not indexed: no department id or team column in {raw.columns}")
    key = to_id(raw, by_id).alias("department_id") if by_id else _trimmed(team).alias("department_name")
    columns = [key, month_start(to_day(raw, c["date"])).alias("month")]
    if quantity:
        columns.append(to_number(raw, quantity).alias("amount"))
    summed = sum_by_month(
        raw.select(*columns), "department_id" if by_id else "department_name",
        "calls_not_indexed", F.col("amount") if quantity else None,
    )
    return summed if by_id else ids_for_names(summed, departments, "calls_not_indexed")


def repeats_monthly(raw: DataFrame) -> DataFrame | None:
    """Repeat contacts per department and month; None when a needed column is missing."""
    raw = strip_headers(raw)
    key, day = find_column(raw, S.REPEATS_DEPARTMENT), find_column(raw, S.REPEATS_DATE)
    value = find_column(raw, S.REPEATS_VALUE)
    if not (key and day and value):
        return None
    rows = raw.select(
        to_id(raw, key).alias("department_id"),
        month_start(to_day(raw, day)).alias("month"),
        to_number(raw, value).alias("amount"),
    )
    return sum_by_month(rows, "department_id", "repeats_workload", F.col("amount"))


def _case_key(raw: DataFrame, name: str) -> Column:
    """Case number without surrounding spaces; whole-number columns are kept, being smaller to shuffle."""
    if isinstance(raw.schema[name].dataType, T.IntegralType):
        return quoted(name)
    return stripped(quoted(name).cast("string"))


def inherited_backlog(raw: DataFrame) -> DataFrame:
    """Distinct cases open on the first day of a month that were opened before it.

    Rows of other days go first, then the exact distinct count is done in two
    steps: by (department, month, case) and then by (department, month), so one
    large department is spread over all tasks.
    """
    raw = strip_headers(raw)
    c = require_columns(
        raw, "backlog snapshots",
        department_id=S.DEPARTMENT_ID, date=S.DATE, case_number=S.BACKLOG_CASE, date_opened=S.BACKLOG_OPENED,
    )
    status = find_column(raw, S.BACKLOG_STATUS)
    rows = raw.select(
        to_id(raw, c["department_id"]).alias("department_id"),
        to_day(raw, c["date"]).alias("date"),
        _case_key(raw, c["case_number"]).alias("case_number"),
        to_day(raw, c["date_opened"]).alias("date_opened"),
        (F.lower(stripped(quoted(status).cast("string"))) if status else F.lit(None).cast("string")).alias("status"),
    )
    # States that end a case.
    ended = F.col("status").isin("closed", "resolved")
    return (
        rows.where(F.col("date") == month_start(F.col("date")))
        .where(F.col("date_opened") < F.col("date"))
        .where(~F.coalesce(ended, F.lit(False)))
        .where(F.col("department_id").isNotNull() & F.col("case_number").isNotNull())
        .groupBy("department_id", F.col("date").alias("month"))
        .agg(F.countDistinct("case_number").cast("double").alias("inventory"))
    )


def backlog_monthly(raw: DataFrame) -> DataFrame:
    """Backlog already counted per month, summed per department and month."""
    raw = strip_headers(raw)
    c = require_columns(
        raw, "monthly backlog",
        department_id=S.DEPARTMENT_ID, month=S.BACKLOG_MONTH, inventory=S.BACKLOG_COUNT,
    )
    rows = raw.select(
        to_id(raw, c["department_id"]).alias("department_id"),
        month_start(to_day(raw, c["month"])).alias("month"),
        to_number(raw, c["inventory"]).alias("amount"),
    )
    return sum_by_month(rows, "department_id", "inventory", F.col("amount"))


def backlog_mean_of_days(raw: DataFrame) -> DataFrame | None:
    """One row per open case and day: mean over days of the daily count; None without the columns."""
    raw = strip_headers(raw)
    day, key = find_column(raw, S.DATE), find_column(raw, S.DEPARTMENT_ID)
    if not (day and key):
        return None
    rows = raw.select(to_id(raw, key).alias("department_id"), to_day(raw, day).alias("date"))
    daily = rows.dropna().groupBy("department_id", "date").agg(F.count("*").alias("open_count"))
    return daily.groupBy("department_id", month_start(F.col("date")).alias("month")).agg(
        F.avg("open_count").alias("inventory_mean")
    )


def agent_days(raw: DataFrame) -> DataFrame | None:
    """Typed agent-day rows; ``agent_id`` only if the source has one; None without the columns."""
    raw = strip_headers(raw)
    day, key = find_column(raw, S.AGENT_DATE), find_column(raw, S.DEPARTMENT_ID)
    target, production = find_column(raw, S.AGENT_TARGET), find_column(raw, S.AGENT_PRODUCTION)
    agent = find_column(raw, S.AGENT_ID)
    if not (day and key and target and production):
        return None
    return raw.select(
        to_day(raw, day).alias("date"),
        to_id(raw, key).alias("department_id"),
        *([quoted(agent).alias("agent_id")] if agent else []),
        to_number(raw, target).alias("item_target_day"),
        to_number(raw, production).alias("prod_total_model"),
    )


def _label_rows(raw: DataFrame, model_names: tuple[str, ...]) -> DataFrame | None:
    """``department_id, model, place`` of all usable rows; place is null without a sequence column."""
    raw = strip_headers(raw)
    key, model = find_column(raw, S.DEPARTMENT_ID[:1]), find_column(raw, model_names)
    if not (key and model):
        return None
    sequence = find_column(raw, S.LABEL_SEQUENCE)
    place = quoted(sequence) if sequence else F.lit(None).cast("bigint")
    if sequence and isinstance(raw.schema[sequence].dataType, T.StringType):
        # numbers in text files go by value; what is no number, such as ISO times, by its text
        place = F.struct(place.try_cast("double").alias("number"), place.alias("text"))
    return raw.select(
        to_id(raw, key).alias("department_id"), quoted(model).cast("string").alias("model"), place.alias("place")
    ).dropna(subset=["department_id", "model"])


def _last_label() -> Column:
    return F.max_by("model", F.struct("place", "model"))


def model_labels(raw: DataFrame, model_names: tuple[str, ...] = S.LABEL_MODEL) -> DataFrame | None:
    """``department_id, model`` with one row per id; None when a column is missing.

    Of an id listed several times the last label counts, by the sequence column where the table
    has one (null first). Rows of equal place, and tables without such a column, keep the
    greatest label: files have no order of rows. ``label_conflicts`` lists what was decided so.
    """
    rows = _label_rows(raw, model_names)
    return None if rows is None else rows.groupBy("department_id").agg(_last_label().alias("model"))


def label_conflicts(raw: DataFrame, source: str, model_names: tuple[str, ...] = S.LABEL_MODEL) -> DataFrame:
    """Departments listed with different labels: how often, which, the one kept, and whether the
    sequence decided or, for want of one or of different places, the alphabet."""
    rows = _label_rows(raw, model_names)
    if rows is None:
        return empty_table(raw.sparkSession, S.LABEL_CONFLICTS)
    # one row per label, so nothing grows with the number of rows of a department
    labels = rows.groupBy("department_id", "model").agg(F.count("*").alias("entries"), F.max("place").alias("place"))
    listed = labels.groupBy("department_id").agg(
        F.sum("entries").alias("entries"), F.array_join(F.array_sort(F.collect_list("model")), ", ").alias("labels"),
        F.count("*").alias("different"), _last_label().alias("kept"), F.max("place").alias("last"),
        F.collect_list(F.struct("model", "place")).alias("places"))
    at_last = F.size(F.filter("places", lambda p: p["place"].eqNullSafe(F.col("last"))))
    return listed.where("different > 1").select(
        F.lit(source).alias("source"), "department_id", "entries", "labels", "kept",
        F.when(at_last > 1, F.lit("alphabet")).otherwise(F.lit("sequence")).alias("decided_by"))


def merge_labels(manual: DataFrame, previous: DataFrame) -> DataFrame:
    """Manual labels win over those of an earlier report."""
    earlier = previous.select("department_id", F.col("model").alias("earlier_model"))
    return manual.join(earlier, "department_id", "full").select(
        "department_id", F.coalesce("model", "earlier_model").alias("model")
    )
