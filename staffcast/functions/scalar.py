"""Scalar expressions shared by the operators. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clip(value: Column, low: float, high: float) -> Column:
    """Bound ``value``; null stays null (``least``/``greatest`` alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high))))


def floor_at_zero(value: Column) -> Column:
    """Negative values become 0; null stays null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def exact(value: Column) -> Column:
    """Decimal of 9 places, whose sums and means do not depend on the order of rows; null where
    a value does not fit 28 digits."""
    return value.try_cast("decimal(28,9)")


def exact_parts(value: Column) -> list[Column]:
    """A double as a whole number or, where it is none or a large one, as its ``exact`` decimal; the
    other part is null. Whole numbers add up as exactly, and much faster than decimals."""
    whole = F.when((value == F.floor(value)) & (F.abs(value) < 1e9), value.cast("bigint"))
    return [whole, F.when(whole.isNull(), exact(value))]


def exact_total(whole: Column, rest: Column) -> Column:
    """Decimal total of the sums of both parts, 0 without values."""
    zero = F.lit(0)
    return F.coalesce(whole, zero).cast("decimal(19,0)") + F.coalesce(rest, zero.cast("decimal(38,9)")).cast("decimal(37,9)")


def ratio(numerator: Column, denominator: Column, otherwise: float | None = None) -> Column:
    """``numerator / denominator`` where the denominator is positive, else ``otherwise``."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator)).otherwise(
        F.lit(otherwise).cast("double")
    )


def signed_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio that is null when the denominator is null or 0."""
    return F.when(denominator != 0, F.try_divide(numerator, denominator))


def round_even(value: Column, digits: int) -> Column:
    """Round half to even."""
    return F.bround(value, digits)


def stripped(text: Column) -> Column:
    """Text without white space at both ends (``trim`` alone removes only spaces)."""
    return F.trim(text, F.lit(" \t\r\n\f\x0b"))


def working_days(month: Column) -> Column:
    """Number of Mondays to Fridays in the month that starts at ``month``.

    Arithmetic on the weekday of the first day instead of listing the days: 20
    working days fall in the first four weeks, the rest depends on where the
    29th to 31st fall.
    """
    spare = F.dayofmonth(F.last_day(month)) - 28
    first = F.weekday(month)
    extra = [
        F.when((spare > i) & (F.pmod(first + F.lit(i), F.lit(7)) < 5), F.lit(1)).otherwise(F.lit(0))
        for i in range(3)
    ]
    return F.when(month.isNotNull(), F.lit(20) + extra[0] + extra[1] + extra[2]).cast("int")


def month_label(month: Column) -> Column:
    """Board label of a month, e.g. ``03-26``."""
    return F.date_format(month, "MM-yy")


def percent_text(value: Column) -> Column:
    """Whole percent as text, e.g. ``12%``; null counts as 0."""
    whole = F.coalesce(round_even(value, 0).cast("bigint"), F.lit(0))
    return F.concat(whole.cast("string"), F.lit("%"))


def board_key(name: Column, suffix: str = "2627", width: int = 31) -> Column:
    """Table-safe key of a board: ``Board_<name>_<suffix>`` without ``/`` and ``:``."""
    safe = F.translate(name, "/:", "__")
    return F.substring(F.concat(F.lit("Board_"), safe, F.lit("_" + suffix)), 1, width)


def name_contains_any(name: Column, tokens: tuple[str, ...]) -> Column:
    """True if the name holds one of the tokens, ignoring case; a null name holds none."""
    folded = F.upper(F.coalesce(name, F.lit("")))
    hit = F.lit(False)
    for token in tokens:
        hit = hit | folded.contains(token.upper())
    return hit
