"""Raw inputs derived from the generated tables (``nation``, ``orders``, ``lineitem``, ...).

Column names vary on purpose, as in real exports, so that every registered query
also exercises name resolution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from staffcast.operators import scope, volumes
from staffcast.sources import inputs
from staffcast.sources.tables import read_table

VERTICALS = ("ASIA", "EUROPE", "AMERICA")
TOKENS = ("_7", "_13")


# Types of the generated tables that are read; given, so that no job has to infer them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Bindings:
    """Builds each raw input lazily for one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.folder}/{name}.parquet"
            self._tables[name] = read_table(self.spark, path, TABLES[name])
        return self._tables[name]

    def department_map(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias(" DEPARTMENT_ID"),
            F.col("n_name").alias("Department "),
            F.col("r_name").alias("Vertical"),
        )

    def departments(self) -> DataFrame:
        return inputs.department_map(self.department_map())

    def scoped(self) -> DataFrame:
        return scope.departments_in_scope(self.departments(), VERTICALS, TOKENS)

    def orders_of_nation(self) -> DataFrame:
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        return self.table("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))

    def lines_of_nation(self) -> DataFrame:
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        return self.table("lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))

    def lines_by_month(self, where: str = "true", **measures: Column) -> DataFrame:
        """Sums of measures of the lines by supplier and month: ``s_nationkey``, ``year``, ``month_number``
        and the measures by name.

        Lines are summed by supplier first, so only those sums meet the suppliers.
        """
        lines = self.table("lineitem").where(where).groupBy("l_suppkey", F.trunc("l_shipdate", "MM").alias("month")).agg(
            *[F.sum(measure).alias(name) for name, measure in measures.items()])
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
            "s_nationkey", F.year("month").alias("year"), F.month("month").alias("month_number"), *measures)

    def plan_sums(self) -> DataFrame:
        """The sums that two inputs of a plan take, by one pass over the lines; keep them before both read them."""
        return self.lines_by_month(solved=F.col("l_discount") * 4, productive=F.col("l_tax"))

    def incoming(self) -> DataFrame:
        return self.orders_of_nation().select(
            F.col("o_orderdate").alias(" Date"), F.col("c_nationkey").alias("Dept_id")
        )

    def incoming_text(self) -> DataFrame:
        """Tickets as text export with unreadable dates, ids and counts in between."""
        key = F.col("o_orderkey")

        def spoiled(every: int, bad: str, good: Column) -> Column:
            return F.when(key % every == 0, F.lit(bad)).otherwise(good)

        day = spoiled(50, "not a date", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        dept = spoiled(40, "x", spoiled(33, "7.5", F.col("c_nationkey").cast("string")))
        count = spoiled(60, "", (key % 3 + 1).cast("string"))
        return self.orders_of_nation().select(
            day.alias("date "), dept.alias("Department_ID"), count.alias("Tickets")
        )

    def incoming_events(self) -> DataFrame:
        return self.table("events").select(
            F.col("ts").alias("date"), (F.col("user_id") % 5).alias("dept_id")
        )

    def daily(self) -> DataFrame:
        return volumes.daily_tickets(inputs.incoming(self.incoming()))

    def daily_events(self) -> DataFrame:
        return volumes.daily_tickets(inputs.incoming(self.incoming_events()))

    def actuals(self) -> DataFrame:
        return volumes.monthly_actuals(self.daily(), self.scoped())

    def deflection(self, sums: DataFrame | None = None) -> DataFrame:
        sums = self.lines_by_month(solved=F.col("l_discount") * 4) if sums is None else sums
        return sums.select(
            F.col("year").alias("Week_Year"), F.col("month_number").alias("Month_number"),
            F.col("solved").alias("Not_Reopened"), F.col("s_nationkey").alias("department_id"),
        )

    def deflection_named(self) -> DataFrame:
        name = F.concat(F.lit("  NATION_"), F.col("s_nationkey").cast("string"), F.lit(" "))
        return self.lines_by_month(amount=F.col("l_tax")).select(
            F.col("year").cast("string").alias("Year"), F.col("month_number").cast("string").alias("Month"),
            F.col("amount").alias("NotReopened"), name.alias("department"),
        )

    def deflection_events(self) -> DataFrame:
        return self.orders_of_nation().where("o_orderstatus = 'F'").select(
            F.col("o_orderdate").alias("Date"), F.col("c_nationkey").alias("department_id")
        )

    def calls_counted(self) -> DataFrame:
        team = F.concat(F.lit(" NATION_"), F.col("s_nationkey").cast("string"), F.lit("  "))
        return self.lines_of_nation().where("l_returnflag = 'R'").select(
            F.col("l_shipdate").alias("Created Date"), team.alias("User Team")
        )

    def calls_summed(self) -> DataFrame:
        month = F.make_date("year", "month_number", F.lit(1))
        return self.lines_by_month("l_returnflag = 'R'", amount=F.col("l_quantity") / 25).select(
            month.alias("CreatedDate"), F.col("s_nationkey").alias("department_id"), F.col("amount").alias("Qty"),
        )

    def repeats(self) -> DataFrame:
        return self.orders_of_nation().where("o_orderpriority = '1-URGENT'").select(
            F.col("c_nationkey").alias("department"), F.col("o_orderdate").alias("Month"),
            F.lit(1).alias("repeats"),
        )

    def backlog_daily(self) -> DataFrame:
        """A line is a sighting of its order in the backlog; odd lines fall on the month start."""
        lines = self.lines_of_nation()
        opened = self.table("orders").select("o_orderkey", "o_orderdate")
        day = F.when(F.col("l_linenumber") % 2 == 1, F.trunc("l_shipdate", "MM")).otherwise(
            F.col("l_shipdate").cast("date")
        )
        flag = F.col("l_returnflag")
        status = (
            F.when((flag == "A") & (F.col("l_linenumber") > 3), F.lit(" Closed "))
            .when(flag == "A", F.lit("RESOLVED"))
            .when(flag == "R", F.lit("open"))
        )
        return lines.join(opened, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("s_nationkey").alias("department_id"), day.alias("Date"),
            F.col("l_orderkey").alias("Case Number"), F.col("o_orderdate").alias("Date Opened"),
            status.alias("Status"),
        )

    def backlog_monthly(self) -> DataFrame:
        month = F.make_date("year", "month_number", F.lit(1))
        return self.lines_by_month(amount=F.col("l_linenumber")).select(
            F.col("s_nationkey").alias("dept_id"), month.alias("Month_Start"), F.col("amount").alias("Inherited_Cases"),
        )

    def backlog_open(self) -> DataFrame:
        return self.lines_of_nation().select(
            F.col("l_shipdate").alias("date"), F.col("s_nationkey").alias("department_id")
        )

    def agent_days(self) -> DataFrame:
        return self.lines_of_nation().select(
            F.col("l_shipdate").alias("work_date"), F.col("s_nationkey").alias("dept_id"),
            F.col("l_suppkey").alias("worker_id"), F.col("l_linenumber").alias("item_target"),
            F.col("l_quantity").alias("productivity"),
        )

    def capacity_history(self, measure: str, sums: DataFrame | None = None) -> DataFrame:
        source = {"productivity_total": "l_quantity", "avg_per_day": "l_discount", "productive": "l_tax"}[measure]
        sums = self.lines_by_month(**{measure: F.col(source)}) if sums is None else sums
        return sums.select(
            F.col("year").alias("Year"), F.col("month_number").alias("Month_number"),
            F.col("s_nationkey").alias("department_id"), measure,
        )

    def previous_report(self) -> DataFrame:
        key = F.col("n_nationkey")
        model = F.when(key % 4 == 0, "SARIMAX-7").when(key % 4 == 1, "STL").when(key % 4 == 2, "Prophet")
        return self.table("nation").select(key.alias("department_id"), model.alias("Recommended_Model"))

    def manual_labels(self) -> DataFrame:
        key = F.col("n_nationkey")
        model = F.when(key % 2 == 0, "STL").otherwise("SARIMAX-7")
        return self.table("nation").where(key % 5 == 0).select(key.alias("department_id"), model.alias("model"))

    def labels_by_customer(self) -> DataFrame:
        """A label for each customer, so many for a department; two customers share a place, and
        all customers of every fifth department agree."""
        key = F.col("c_custkey")
        model = F.when((F.col("c_nationkey") % 5 == 0) | (key % 3 == 0), "STL").when(key % 3 == 1, "SARIMAX-7").otherwise("Prophet")
        return self.table("customer").select(
            F.col("c_nationkey").alias("department_id"), model.alias("model"), F.floor(key / 2).alias("Sequence"))

    def labels(self) -> DataFrame:
        return inputs.merge_labels(
            inputs.model_labels(self.manual_labels()),
            inputs.model_labels(self.previous_report(), ("Recommended_Model",)),
        )

    def agents(self) -> DataFrame:
        """Suppliers as agents; they start with their first line, and every seventh has no start date."""
        first = self.table("lineitem").groupBy("l_suppkey").agg(F.min(F.col("l_shipdate").cast("date")).alias("first_day"))
        known = F.when(F.col("s_suppkey") % 7 != 0, F.col("first_day"))
        return self.table("supplier").join(first, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
            F.col("s_suppkey").alias("agent_id"), F.col("s_nationkey").cast("bigint").alias("department_id"), known.alias("start_date"))

    def tenure_ranges(self) -> DataFrame:
        """Three ranges of months per department, with gaps between them."""
        ranges = F.explode(F.array(*[
            F.struct(F.lit(s).alias("seniority"), F.lit(a).alias("min_months"), F.lit(b).alias("max_months"), F.lit(t).alias("base"))
            for s, a, b, t in (("new", 1, 74, 5), ("grown", 76, 77, 8), ("senior", 78, 999, 12))]))
        return self.table("nation").select(F.col("n_nationkey").cast("bigint").alias("department_id"), ranges.alias("r")).select(
            "department_id", "r.seniority", "r.min_months", "r.max_months", (F.col("r.base") + F.col("department_id") % 3).cast("double").alias("item_target_day"))

    def holidays(self) -> DataFrame:
        """Days around the turn of the year, for every year of the orders."""
        years = self.table("orders").select(F.year("o_orderdate").alias("year")).distinct()
        # Month, day, label.
        days = ((12, 24, "Christmas Eve"), (12, 25, "Christmas Day"), (12, 26, "Boxing/St. Stephen"),
                (12, 31, "New Year Eve"), (1, 1, "New Year Day"), (1, 6, "Epiphany"))
        day = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("label")) for m, d, n in days]))
        return years.select("year", day.alias("x")).select(F.make_date("year", "x.m", "x.d").alias("date"), "x.label")

    def model_errors(self) -> DataFrame:
        """Bias from -45 to 45 %, so both bounds of the factor are reached; a third has no record."""
        key = F.col("n_nationkey")
        return self.table("nation").where(key % 3 != 0).select(
            F.lit(None).cast("string").alias("vertical"), key.cast("bigint").alias("department_id"),
            F.col("n_name").alias("department_name"), F.lit("STL").alias("model_used"),
            F.lit(12).alias("backtest_months"), F.lit(20.0).alias("mape_pct"), F.lit(20.0).alias("wape_pct"),
            ((key % 7 - 3) * 15).cast("double").alias("bias_pct"),
        )
