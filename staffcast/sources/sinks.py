"""Output tables and tables written between stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from staffcast.functions.scalar import board_key


def write_tables(
    tables: Mapping[str, DataFrame],
    folder: str,
    skip_if_empty: Collection[str] = (),
    format: str = "parquet",
    by_month: Collection[str] = (),
) -> list[str]:
    """Write one table per name, replacing earlier ones; returns the names written.

    Of the tables `by_month` only the months that the new rows have are replaced.
    """

    def write(name: str, table: DataFrame) -> bool:
        if name in skip_if_empty and table.isEmpty():
            return False
        if name in by_month:
            write_months(table, f"{folder.rstrip('/')}/{name}")
            return True
        writer = table.write.mode("overwrite").format(format)
        if format == "csv":
            writer = writer.option("header", True)
        writer.save(f"{folder.rstrip('/')}/{name}")
        return True

    ready = dict(tables.items())
    # the tables are independent, so their jobs are submitted together and share the cluster
    with ThreadPoolExecutor(max_workers=max(1, len(ready))) as pool:
        done = {name: pool.submit(write, name, table) for name, table in ready.items()}
        return [name for name, job in done.items() if job.result()]


def write_boards(boards: DataFrame, path: str, suffix: str = "2627") -> None:
    """Write all boards as one table with a folder per department id.

    ``board_key`` is a short text for display; names that share its beginning keep boards of
    their own. Rows are grouped by department first, so each folder gets one file and no task
    keeps writers open for every department. A board is a dozen rows, so no group can grow
    with the facts.
    """
    keyed = boards.withColumn("board_key", board_key(F.col("department_name"), suffix))
    keyed.repartition("department_id").write.mode("overwrite").partitionBy("department_id").parquet(path)


def write_months(table: DataFrame, path: str, files_per_month: int = 1) -> None:
    """Write a table with a folder per month. Months that the table has are replaced whole, the
    other months of the folder stay; rows without a month have a folder of their own.

    Rows are grouped by month first, so a month has `files_per_month` files at most and no task
    keeps writers open for many months; give more files where a month outgrows one task.
    """
    part = F.pmod(F.xxhash64(*[c for c in table.columns if c != "month"]), F.lit(files_per_month))
    writer = table.repartition("month", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("month").parquet(path)


def read_months(spark: SparkSession, path: str, schema: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The months `first` to `last` (ISO dates) of a table written by months; others are not opened."""
    rows = spark.read.schema(schema).parquet(path)
    if first is not None:
        rows = rows.where(F.col("month") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("month") <= F.lit(last).cast("date"))
    return rows


def shared_folder(spark: SparkSession) -> str:
    """Folder for tables between stages: ``spark.checkpoint.dir``, or a local one in local mode."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="staffcast-")


class Stages:
    """Writes small stage results once and reads them back.

    The read-back table has no lineage, so a lost executor never causes the
    facts to be scanned again, and its file size lets the planner choose
    broadcast joins from real numbers. Rows are counted while they are written:
    ``metrics`` has ``rows`` of every stage, and what else was asked for.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/staffcast-{uuid.uuid4().hex}"
        self.metrics: dict[str, dict[str, int]] = {}

    def keep(self, name: str, table: DataFrame, **counted: Column) -> DataFrame:
        """Write and read back; `counted` are aggregates observed on the way."""
        path, seen = f"{self.folder}/{name}", Observation()
        metrics = {"rows": F.count(F.lit(1)), **counted}
        table.observe(seen, *[m.alias(k) for k, m in metrics.items()]).write.mode("overwrite").parquet(path)
        # a table known to be empty is not even planned, so it observes nothing
        self.metrics[name] = dict.fromkeys(metrics, 0) | seen.get
        return self.spark.read.schema(table.schema).parquet(path)

    def keep_all(self, tables: Mapping[str, DataFrame], **counted: Mapping[str, Column]) -> dict[str, DataFrame]:
        """Keep several independent tables; their jobs are submitted together and share the cluster.
        `counted` gives the aggregates to observe by table."""
        with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
            kept = {name: pool.submit(self.keep, name, table, **counted.get(name, {})) for name, table in tables.items()}
            return {name: done.result() for name, done in kept.items()}
