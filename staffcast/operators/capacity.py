"""What the team can handle: from agent days, from history, and projected ahead."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staffcast.functions.columns import find_column, month_start, strip_headers, to_day, to_id, to_number
from staffcast.functions.scalar import exact, exact_parts, exact_total, working_days
from staffcast.operators.calendar import future_months
from staffcast.operators.rates import latest_rows
from staffcast.sources import schemas as S
from staffcast.sources.inputs import sum_by_month, sum_by_parts

# Tickets handled per productive hour; targets up to this mark an absent agent.
TICKETS_PER_HOUR = 6.0
IDLE_TARGET = 1


def agent_days_by_day(rows: DataFrame) -> DataFrame:
    """Per department and day: productive agents, their mean target, production of everybody.

    With an ``agent_id`` column the count is distinct: the different agents of a day, rows of
    bare keys, are dealt by (department, day, agent), so a large department is spread over all
    tasks, while the measures are summed where they are read. The rows are scanned once for
    each; no sum travels by agent. Days without a productive agent keep null counts. Sums and
    means are exact, so equal inputs give equal results however the rows are dealt.
    """
    keys, productive = ["department_id", "date"], F.col("item_target_day") > IDLE_TARGET
    rows = rows.where(F.col("department_id").isNotNull() & F.col("date").isNotNull())
    target = exact_parts(F.when(productive, F.col("item_target_day")))
    produced = exact_parts(F.col("prod_total_model"))
    measured = rows.select(
        *keys, F.when(productive, F.lit(1)).alias("productive"), target[0].alias("target"), target[1].alias("target_rest"),
        produced[0].alias("produced"), produced[1].alias("produced_rest"),
    )
    if "agent_id" in rows.columns:
        agents = rows.where(productive & F.col("agent_id").isNotNull()).select(*keys, "agent_id").distinct()
        measured = measured.unionByName(agents.select(*keys, F.lit(1).alias("agent")), allowMissingColumns=True)
    else:
        measured = measured.withColumn("agent", F.col("productive"))
    targets = F.count("target") + F.count("target_rest")
    target_sum = exact_total(F.sum("target"), F.sum("target_rest"))
    # a mean of 13 places, as Spark takes it of these decimals; only sums beyond 28 digits divide as doubles
    mean = (target_sum.try_cast("decimal(28,9)") / F.nullif(targets, F.lit(0)).cast("decimal(10,0)")).cast("decimal(32,13)")
    daily = measured.groupBy(*keys).agg(
        F.count("agent").alias("agents"),
        F.count("productive").alias("productive_rows"),
        F.coalesce(mean.cast("double"), F.try_divide(target_sum.cast("double"), targets)).alias("target_mean_day"),
        exact_total(F.sum("produced"), F.sum("produced_rest")).cast("double").alias("prod_sum_day"),
    )
    return daily.select(
        "department_id", "date",
        F.when(F.col("productive_rows") > 0, F.col("agents")).alias("agents_day"),
        "target_mean_day", "prod_sum_day",
    )


def agent_day_pieces(rows: DataFrame) -> DataFrame:
    """Per department, day and productive-or-not: agents, mean target, production. One scan."""
    productive = F.coalesce(F.col("item_target_day") > IDLE_TARGET, F.lit(False))
    agents = F.countDistinct("agent_id") if "agent_id" in rows.columns else F.count("*")
    return (
        rows.where(F.col("department_id").isNotNull() & F.col("date").isNotNull())
        .groupBy("department_id", "date", productive.alias("productive"))
        .agg(
            agents.alias("agents"), F.avg(exact(F.col("item_target_day"))).cast("double").alias("target_mean"),
            F.coalesce(F.sum(exact(F.col("prod_total_model"))).cast("double"), F.lit(0.0)).alias("prod_sum"),
        )
    )


def join_agent_day_pieces(pieces: DataFrame) -> DataFrame:
    """Same result as ``agent_days_by_day`` by two full outer joins of daily pieces.

    The single pass is the one to use; this form serves sources that deliver the
    pieces separately, and to check the single pass against. The pieces are
    read several times, so keep them as a table first.
    """
    keys = ["department_id", "date"]
    productive = pieces.where("productive")
    counted = productive.select(*keys, F.col("agents").alias("agents_day"))
    targets = productive.select(*keys, F.col("target_mean").alias("target_mean_day"))
    produced = pieces.groupBy(*keys).agg(F.sum(exact(F.col("prod_sum"))).cast("double").alias("prod_sum_day"))
    return counted.join(targets, keys, "full").join(produced, keys, "full")


def agent_capacity(rows: DataFrame) -> DataFrame:
    """Monthly capacity (mean agents times mean target) and productivity from agent days.

    The means are taken over exact values and only then multiplied, so months whose product
    ends in a tie round the same way in every run.
    """
    return agent_days_by_day(rows).groupBy(
        "department_id", month_start(F.col("date")).alias("month")
    ).agg(
        (F.avg("agents_day") * F.avg(exact(F.col("target_mean_day"))).cast("double")).alias("capacity_agents"),
        F.sum(exact(F.col("prod_sum_day"))).cast("double").alias("productivity_agents"),
    )


def historical_capacity(raw: DataFrame, tickets_per_hour: float = TICKETS_PER_HOUR) -> DataFrame | None:
    """Capacity per department and month from the first measure the source offers.

    Total productivity as it is; else the mean per day times the working days of
    the month; else productive hours times ``tickets_per_hour``. None when month,
    department or all measures are missing.
    """
    raw = strip_headers(raw)
    start, key = find_column(raw, S.CAPACITY_MONTH), find_column(raw, S.DEPARTMENT_ID)
    year, number = find_column(raw, S.CAPACITY_YEAR), find_column(raw, S.CAPACITY_MONTH_NUMBER)
    measures = [
        (find_column(raw, S.CAPACITY_TOTAL), F.lit(1.0)),
        (find_column(raw, S.CAPACITY_PER_DAY), working_days(F.col("month"))),
        (find_column(raw, S.CAPACITY_HOURS), F.lit(float(tickets_per_hour))),
    ]
    usable = [(column, scale) for column, scale in measures if column]
    if not key or not usable or not (start or (year and number)):
        return None
    column, scale = usable[0]
    chosen = [to_id(raw, key).alias("department_id"), to_number(raw, column).alias("amount")]
    if start:
        rows = raw.select(*chosen, month_start(to_day(raw, start)).alias("month"))
        summed = sum_by_month(rows, "department_id", "amount", F.col("amount"))
    else:
        rows = raw.select(*chosen, to_id(raw, year).alias("year"), to_id(raw, number).alias("month_number"))
        summed = sum_by_parts(rows, "department_id", "amount")
    # the scale is the same for all rows of a month, so it is applied after summing
    return summed.select("department_id", "month", (F.col("amount") * scale).alias("capacity"))


def project_capacity(
    history: DataFrame, actuals: DataFrame | None, as_of: str, months: int = 12,
    use_capacity_months: bool = True,
) -> DataFrame:
    """Mean of each department's latest 3 capacity months, for the months ahead.

    All departments start after one common anchor: the latest month found in the
    actuals or the capacity history (``use_capacity_months=False`` looks at the
    actuals only), or the month of ``as_of`` when there is none. The anchor is a
    scalar subquery, so it needs no cross join and no value passes the driver.
    """
    candidates = []
    if actuals is not None:
        candidates.append(actuals.agg(F.max("month").alias("anchor")).scalar())
    if use_capacity_months or actuals is None:
        candidates.append(history.agg(F.max("month").alias("anchor")).scalar())
    newest = F.greatest(*candidates) if len(candidates) > 1 else candidates[0]
    anchor = F.coalesce(newest, month_start(F.lit(as_of).cast("date")))
    level = (
        latest_rows(history.where(F.col("department_id").isNotNull()), 3)
        .groupBy("department_id").agg(F.avg("capacity").alias("capacity"))
    )
    ahead = future_months(level.withColumn("anchor", anchor), "anchor", months)
    return ahead.select("department_id", "month", "capacity")


def with_projection(history: DataFrame, projection: DataFrame) -> DataFrame:
    """History followed by the projection."""
    columns = ["department_id", "month", "capacity"]
    return history.select(*columns).unionByName(projection.select(*columns))


def consolidate(
    rows: DataFrame, agents: DataFrame, capacity: DataFrame, productivity_from_agents: bool = True
) -> DataFrame:
    """Attach ``capacity`` and ``productivity`` per department and month.

    Capacity comes from agent days, else from history or projection.
    Productivity comes from agent days, else equals the capacity;
    ``productivity_from_agents=False`` always uses the capacity.
    """
    keys = ["department_id", "month"]
    other = capacity.select(*keys, F.col("capacity").alias("_other"))
    joined = rows.join(agents.select(*keys, "capacity_agents", "productivity_agents"), keys, "left").join(
        other, keys, "left"
    )
    chosen = F.coalesce("capacity_agents", "_other")
    productivity = F.coalesce(F.col("productivity_agents"), chosen) if productivity_from_agents else chosen
    return joined.withColumns({"productivity": productivity, "capacity": chosen}).drop("_other")
