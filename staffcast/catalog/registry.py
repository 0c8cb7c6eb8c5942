"""Where queries register, and the form in which their rows are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from staffcast.catalog.bindings import Bindings
from staffcast.deploy import ship_package
from staffcast.functions.scalar import exact

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Form used for comparing engines: dates as text, doubles to 4 places, whole numbers as bigint.

    Doubles are written as decimals of 9 places first, as in the SQL: the engines add in
    different orders, and a last binary digit must not decide how a tie is rounded.
    """
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            # what no decimal of 28 digits holds stays as it is; + 0.0 turns a negative zero into zero
            plain = col.cast("double")
            col = F.coalesce(F.round(exact(plain), 4).cast("double"), plain) + F.lit(0.0)
        elif isinstance(field.dataType, T.IntegralType):
            col = col.cast("bigint")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(build: Callable[[Bindings], DataFrame]) -> Callable[[Bindings], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return comparable(build(Bindings(spark, folder)))

    _QUERIES[build.__name__] = run
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)
