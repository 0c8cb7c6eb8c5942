"""Header clean-up, column resolution and tolerant casts.

Everything here works on ``df.columns`` and ``df.schema`` while the plan is
built; no job is started.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def strip_headers(df: DataFrame) -> DataFrame:
    """Remove leading and trailing spaces from every column name."""
    return df.toDF(*[name.strip() for name in df.columns])


def find_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate present in ``df``: exact match first, then ignoring case."""
    present = set(df.columns)
    exact = [name for name in candidates if name in present]
    if exact:
        return exact[0]
    by_folded = {name.lower(): name for name in df.columns}
    return next((by_folded[c.lower()] for c in candidates if c.lower() in by_folded), None)


def require_columns(df: DataFrame, table: str, **wanted: Sequence[str]) -> dict[str, str]:
    """Resolve every logical column or raise ``KeyError`` naming all that are missing."""
    found = {logical: find_column(df, names) for logical, names in wanted.items()}
    missing = [logical for logical, name in found.items() if name is None]
    if missing:
        raise KeyError(f"{table}: no column found for {', '.join(missing)} in {df.columns}")
    return found


def quoted(name: str) -> Column:
    """Column reference that is safe for names with dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def _text(name: str) -> Column:
    return quoted(name).cast("string")


def to_day(df: DataFrame, name: str) -> Column:
    """Calendar day; time of day is dropped, unparsable values become null."""
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return quoted(name).cast("date")
    return _text(name).try_cast("date")


def to_number(df: DataFrame, name: str) -> Column:
    """Double; unparsable values and NaN become null."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return quoted(name).cast("double")
    number = quoted(name).cast("double") if isinstance(kind, T.NumericType) else _text(name).try_cast("double")
    return F.nullif(number, F.lit(float("nan")))


def to_id(df: DataFrame, name: str) -> Column:
    """Nullable 64-bit id; values that are not whole numbers become null."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return quoted(name).cast("bigint")
    number = to_number(df, name)
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    if isinstance(kind, T.StringType):
        # text such as '9007199254740993' must not pass through a double
        return F.coalesce(quoted(name).try_cast("bigint"), whole)
    return whole


def month_start(day: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(day, "MM")


def month_from_parts(year: Column, month_number: Column) -> Column:
    """Month start from whole-number year and month; null if either is missing or out of range."""
    text = F.concat(year.cast("string"), F.lit("-"), month_number.cast("string"), F.lit("-1"))
    return text.try_cast("date")
