import datetime as dt

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def daily(spark):
    """Builds a daily table from ``{department: (first day, values)}``; None leaves a gap."""

    def build(series):
        rows = [
            (dept, first + dt.timedelta(days=i), float(v))
            for dept, (first, values) in series.items()
            for i, v in enumerate(values) if v is not None
        ]
        return spark.createDataFrame(rows, "department_id bigint, date date, tickets double")

    return build


@pytest.fixture
def monthly(spark):
    """Builds ``department_id, month, <value>`` from ``{department: (year, month, values)}``."""

    def build(value, series):
        rows = []
        for dept, (year, month, values) in series.items():
            for i, v in enumerate(values):
                if v is not None:
                    place = year * 12 + month - 1 + i
                    rows.append((dept, dt.date(place // 12, place % 12 + 1, 1), float(v)))
        return spark.createDataFrame(rows, f"department_id bigint, month date, {value} double")

    return build
