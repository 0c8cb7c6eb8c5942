import datetime as dt

import pytest
from pyspark.sql import functions as F

from staffcast.functions import columns, scalar


def one(df, *exprs):
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_headers_are_stripped_and_resolved(spark):
    df = columns.strip_headers(spark.createDataFrame([(1, 2)], [" DEPT_ID ", "Date "]))
    assert df.columns == ["DEPT_ID", "Date"]
    assert columns.find_column(df, ["department_id", "dept_id"]) == "DEPT_ID"
    assert columns.find_column(df, ["date"]) == "Date"
    assert columns.find_column(df, ["month"]) is None


def test_exact_name_wins_over_earlier_case_insensitive_match(spark):
    df = spark.createDataFrame([(1, 2)], ["QTY", "count"])
    assert columns.find_column(df, ["qty", "count"]) == "count"


def test_missing_required_columns_are_all_named(spark):
    df = spark.createDataFrame([(1,)], ["x"])
    with pytest.raises(KeyError, match="date, department_id"):
        columns.require_columns(df, "incoming", date=["Date"], department_id=["dept_id"])


@pytest.mark.parametrize("text, day", [
    ("2024-03-05", dt.date(2024, 3, 5)),
    ("2024-03-05 17:45:00", dt.date(2024, 3, 5)),
    ("2024-3-5", dt.date(2024, 3, 5)),
    ("2024-02-30", None), ("soon", None), ("", None), (None, None),
])
def test_day_from_text(spark, text, day):
    df = spark.createDataFrame([(text,)], "d string")
    assert one(df, columns.to_day(df, "d")) == [(day,)]


def test_day_drops_time_of_day(spark):
    df = spark.sql("select timestamp_ntz'2024-01-31 23:59:59' a, date'2024-01-31' b")
    assert one(df, columns.to_day(df, "a"), columns.to_day(df, "b")) == [(dt.date(2024, 1, 31),) * 2]


def test_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("nan",), (None,)], "v string")
    assert [r[0] for r in one(df, columns.to_number(df, "v"))] == [1.5, None, None, None]


def test_ids_must_be_whole(spark):
    text = spark.createDataFrame([("7",), ("7.0",), ("7.5",), ("x",), ("9007199254740993",)], "v string")
    assert [r[0] for r in one(text, columns.to_id(text, "v"))] == [7, 7, None, None, 9007199254740993]
    number = spark.createDataFrame([(7.0,), (7.5,), (1e300,), (float("nan"),)], "v double")
    assert [r[0] for r in one(number, columns.to_id(number, "v"))] == [7, None, None, None]


def test_month_from_parts(spark):
    df = spark.createDataFrame([(2024, 2), (2024, 13), (None, 1)], "y bigint, m bigint")
    got = [r[0] for r in one(df, columns.month_from_parts(F.col("y"), F.col("m")))]
    assert got == [dt.date(2024, 2, 1), None, None]


def test_clip_keeps_null_and_ratio_guards(spark):
    df = spark.sql("select cast(null as double) n, 5.0d five, 0.0d zero, -2.0d minus")
    got = one(
        df, scalar.clip(F.col("n"), 0, 1), scalar.clip(F.col("five"), 0, 1), scalar.clip(F.col("minus"), 0, 1),
        scalar.ratio(F.col("five"), F.col("zero")), scalar.ratio(F.col("five"), F.col("zero"), 0.0),
        scalar.ratio(F.col("five"), F.col("minus")), scalar.signed_ratio(F.col("five"), F.col("minus")),
        scalar.signed_ratio(F.col("five"), F.col("zero")), scalar.floor_at_zero(F.col("minus")),
        scalar.floor_at_zero(F.col("n")),
    )
    assert got == [(None, 1.0, 0.0, None, 0.0, None, -2.5, None, 0.0, None)]


def test_round_half_to_even_and_percent_text(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (None,)], "v double")
    assert [r[0] for r in one(df, scalar.round_even(F.col("v"), 0))] == [0.0, 2.0, 2.0, None]
    assert [r[0] for r in one(df, scalar.percent_text(F.col("v")))] == ["0%", "2%", "2%", "0%"]


def test_working_days_against_listing(spark):
    months = [dt.date(y, m, 1) for y in (1999, 2000, 2023, 2024) for m in range(1, 13)]
    df = spark.createDataFrame([(m,) for m in months], "m date")
    got = dict(one(df, F.col("m"), scalar.working_days(F.col("m"))))
    for month in months:
        days = [month + dt.timedelta(days=i) for i in range(31)]
        assert got[month] == sum(d.weekday() < 5 for d in days if d.month == month.month)


def test_board_key(spark):
    df = spark.createDataFrame([("A/B:C",), ("A very long department name here",)], "n string")
    keys = [r[0] for r in one(df, scalar.board_key(F.col("n")))]
    assert keys == ["Board_A_B_C_2627", "Board_A very long department na"]
    assert len(keys[1]) == 31


def test_month_label_and_name_tokens(spark):
    df = spark.sql("select date'2026-03-01' m, 'cs_Keyboard' a, cast(null as string) b")
    tokens = ("PROJ", "key")
    got = one(df, scalar.month_label(F.col("m")), scalar.name_contains_any(F.col("a"), tokens),
              scalar.name_contains_any(F.col("b"), tokens))
    assert got == [("03-26", True, False)]
