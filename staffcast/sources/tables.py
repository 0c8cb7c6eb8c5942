"""Table scans, optional tables, and the small in-line tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from staffcast.sources import schemas


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Scan a CSV file or folder (path ending ``.csv``) or a parquet table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if path.rstrip("/").endswith(".csv"):
        return reader.option("header", True).csv(path)
    return reader.parquet(path)


def read_first(spark: SparkSession, paths: Sequence[str], schema: str | None = None) -> DataFrame | None:
    """Scan the first path that exists; None when none does."""
    for path in paths:
        try:
            return read_table(spark, path, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return None


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """Typed table without rows, used where an optional input is absent."""
    return spark.createDataFrame([], schema)


def published_model_errors(spark: SparkSession) -> DataFrame:
    """Backtest record per department. Names are not stored; join the department map for them."""
    # Vertical, department_id, MAPE %, WAPE %, bias %.
    record = [
        ("Hospitality", 7, 29.35, 26.00, -0.40),
        ("Hospitality", 8, 43.80, 39.12, 12.64),
        ("Hospitality", 11, 27.76, 22.27, -4.06),
        ("Hospitality", 23, 31.44, 25.79, -1.79),
        ("Hospitality", 5, 20.88, 17.68, -2.70),
        ("Hospitality", 9, 17.29, 14.44, -3.07),
        ("Hospitality", 10, 28.77, 23.23, -1.12),
        ("Partners", 12, 20.88, 20.99, -5.14),
        ("Partners", 13, 27.76, 25.91, 7.36),
        ("Partners", 14, 26.60, 21.38, 5.29),
        ("Partners", 15, 40.03, 30.97, -9.47),
        ("Payments", 3, 18.63, 18.70, 1.28),
        ("Payments", 1, 24.80, 22.19, 0.58),
        ("Payments", 18, 54.89, 38.55, -7.28),
        ("Payments", 2, 28.56, 24.46, -1.36),
        ("Payments", 21, 42.25, 41.25, 17.26),
    ]
    rows = [(v, d, None, "STL", 12, mape, wape, bias) for v, d, mape, wape, bias in record]
    return spark.createDataFrame(rows, schemas.MODEL_ERRORS)


def with_department_names(errors: DataFrame, department_map: DataFrame) -> DataFrame:
    """Fill ``department_name`` of an error table from the department map."""
    names = department_map.select("department_id", F.col("department_name").alias("mapped_name"))
    return errors.join(names, "department_id", "left").select(
        "vertical", "department_id",
        F.coalesce("mapped_name", "department_name").alias("department_name"),
        "model_used", "backtest_months", "mape_pct", "wape_pct", "bias_pct",
    )
