"""Tables written between the stages of an operator, in the folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from staffcast.deploy import ship_package


BATCH_ROWS = 1024  # rows of an Arrow batch; ten thousand texts at once would crowd a worker's memory


def prepare(spark: SparkSession) -> None:
    """Makes the package importable on executors and keeps Arrow batches small."""
    ship_package(spark)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch)) <= BATCH_ROWS:
        spark.conf.set(batch, str(BATCH_ROWS))


def stage_folder(spark: SparkSession) -> str:
    """A new folder for one run. The session's setting names the shared folder; only where it is
    unset in local mode, as in tests, one of this machine is used."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        shared = tempfile.mkdtemp(prefix="llm-")
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


class Kept:
    """Writes intermediate tables once and reads them back: no lineage, so a lost executor costs
    only its own tasks, and the planner sees real sizes."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = stage_folder(spark)
        self.made = 0

    def __call__(self, table: DataFrame, name: str = "table") -> DataFrame:
        path = f"{self.folder}/{self.made:03d}-{name}"
        self.made += 1
        table.write.parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)
