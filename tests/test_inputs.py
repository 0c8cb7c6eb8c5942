import datetime as dt

import pytest

from staffcast.operators import scope, volumes
from staffcast.sources import inputs, schemas
from staffcast.sources.tables import empty_table, published_model_errors, read_first, with_department_names

JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*(columns or df.columns)).collect()}


@pytest.fixture
def departments(spark):
    raw = spark.createDataFrame(
        [(1, "Alpha", "Payments"), (2, "Beta", "Partners"), (2, "Beta", "Partners"), (3, "proj x", "Payments"),
         (4, "Delta", "Other"), (None, "Nobody", "Payments"), (5, None, "Payments")],
        "DEPT_ID bigint, ` Department ` string, vertical string",
    )
    return inputs.department_map(raw)


def test_incoming_counts_rows_without_a_count_column(spark):
    raw = spark.createDataFrame(
        [("2024-01-01 10:00:00", "1"), ("2024-01-01", "1"), ("bad", "1"), ("2024-01-02", None), ("2024-01-02", "1.5")],
        "`Date ` string, Department_ID string",
    )
    got = as_set(volumes.daily_tickets(inputs.incoming(raw)))
    assert got == {(1, JAN, 2.0)}


def test_incoming_with_counts_and_only_nulls(spark):
    raw = spark.createDataFrame([("2024-01-01", 1, None), ("2024-01-02", 1, 3.0)], "date string, dept_id int, qty double")
    assert as_set(volumes.daily_tickets(inputs.incoming(raw))) == {(1, JAN, 0.0), (1, dt.date(2024, 1, 2), 3.0)}


def test_incoming_without_department_raises(spark):
    with pytest.raises(KeyError, match="department_id"):
        inputs.incoming(spark.createDataFrame([("2024-01-01",)], "Date string"))


def test_map_is_distinct_and_scope_applies(departments):
    assert departments.count() == 6
    kept = scope.departments_in_scope(departments, ("Payments", "Partners"), ("PROJ",))
    assert as_set(kept, "department_id") == {(1,), (2,), (5,)}
    assert as_set(scope.departments_in_scope(departments, None), "department_id") == {(1,), (2,), (3,), (4,), (5,)}


def test_map_conflicts(spark, departments):
    assert inputs.map_conflicts(departments).count() == 0
    twice = departments.unionByName(spark.createDataFrame([(1, "Alpha 2", "Payments")], schemas.DEPARTMENT_MAP))
    assert as_set(inputs.map_conflicts(twice)) == {(1, 2)}


def test_actuals_drop_unmapped_and_unnamed(spark, departments, daily):
    table = daily({1: (dt.date(2024, 1, 31), [1, 2]), 5: (JAN, [9]), 99: (JAN, [7])})
    got = as_set(volumes.monthly_actuals(table, departments), "department_id", "month", "actual_volume")
    assert got == {(1, JAN, 1.0), (1, FEB, 2.0)}


def test_uplift_adds_calls_to_matching_months(spark, departments, daily, monthly):
    actuals = volumes.monthly_actuals(daily({1: (dt.date(2024, 1, 31), [1, 2])}), departments)
    calls = monthly("calls_not_indexed", {1: (2024, 2, [10])})
    got = as_set(volumes.uplift_by_calls(actuals, calls), "month", "actual_volume")
    assert got == {(JAN, 1.0), (FEB, 12.0)}


def test_deflection_monthly_form_by_id_and_by_name(spark, departments):
    rows = [("2024", "1", "2"), ("2024", "1", "3"), ("2024", "13", "9"), ("2024", "2", "x"), (None, "1", "1")]
    by_id = spark.createDataFrame([(*r, 1) for r in rows], "Year string, Month string, Not_Reopened string, dept_id int")
    assert as_set(inputs.deflection_monthly(by_id, departments)) == {(1, JAN, 5.0), (1, FEB, 0.0)}
    by_name = spark.createDataFrame(
        [(*r, " Beta\t") for r in rows] + [("2024", "1", "4", "Unknown")],
        "Year string, Month string, Not_Reopened string, department string",
    )
    assert as_set(inputs.deflection_monthly(by_name, departments)) == {(2, JAN, 5.0), (2, FEB, 0.0)}


def test_deflection_event_form_counts_rows(spark, departments):
    raw = spark.createDataFrame([("2024-01-05", 1), ("2024-01-06", 1), ("bad", 1), ("2024-02-01", None)], "Date string, department_id int")
    assert as_set(inputs.deflection_monthly(raw, departments)) == {(1, JAN, 2.0)}
    assert inputs.deflection_monthly(spark.createDataFrame([(1,)], "x int"), departments) is None


def test_calls_by_team_and_by_quantity(spark, departments):
    team = spark.createDataFrame([("2024-01-03", "Alpha "), ("2024-01-04", "Alpha"), ("2024-01-04", "?")], "`Created Date` string, `User Team` string")
    assert as_set(inputs.calls_monthly(team, departments)) == {(1, JAN, 2.0)}
    quantity = spark.createDataFrame([("2024-01-03", 2, "4"), ("2024-01-04", 2, "bad"), ("2024-01-05", 2, "1.5")], "Date string, department_id int, Volume string")
    assert as_set(inputs.calls_monthly(quantity, departments)) == {(2, JAN, 5.5)}
    with pytest.raises(KeyError):
        inputs.calls_monthly(spark.createDataFrame([("2024-01-03",)], "Date string"), departments)
    with pytest.raises(KeyError):
        inputs.calls_monthly(spark.createDataFrame([(1,)], "department_id int"), departments)


def test_repeats_are_skipped_without_columns(spark):
    raw = spark.createDataFrame([("2024-01-03", 1, 2), ("2024-01-09", 1, None)], "Date string, department int, RR int")
    assert as_set(inputs.repeats_monthly(raw)) == {(1, JAN, 2.0)}
    assert inputs.repeats_monthly(raw.drop("RR")) is None


def test_inherited_backlog_rules(spark):
    rows = [
        (1, "2024-02-01", " A1 ", "2024-01-15", "open"),
        (1, "2024-02-01", "A1", "2024-01-15", "open"),      # same case twice
        (1, "2024-02-01", "A2", "2024-02-01", "open"),      # opened on the day
        (1, "2024-02-01", "A3", "2024-01-15", " Closed "),  # ended
        (1, "2024-02-01", "A4", "2024-01-15", "RESOLVED"),
        (1, "2024-02-01", "A5", "2024-01-15", None),        # unknown status counts
        (1, "2024-02-02", "A6", "2024-01-15", "open"),      # not a month start
        (1, "2024-02-01", None, "2024-01-15", "open"),
        (None, "2024-02-01", "A7", "2024-01-15", "open"),
        (1, "2024-02-01", "A8", "bad", "open"),
    ]
    raw = spark.createDataFrame(rows, "department_id int, Date string, `Case Number` string, `Date Opened` string, Status string")
    assert as_set(inputs.inherited_backlog(raw)) == {(1, FEB, 2.0)}
    assert as_set(inputs.inherited_backlog(raw.drop("Status"))) == {(1, FEB, 4.0)}
    with pytest.raises(KeyError, match="date_opened"):
        inputs.inherited_backlog(raw.drop("Date Opened"))


def test_backlog_monthly_and_mean_of_days(spark):
    raw = spark.createDataFrame([(1, "2024-01-20", "2"), (1, "2024-01-01", "x"), (1, "2024-01-02", "3")], "dept_id int, month_start string, backlog string")
    assert as_set(inputs.backlog_monthly(raw)) == {(1, JAN, 5.0)}
    days = spark.createDataFrame([("2024-01-01", 1), ("2024-01-01", 1), ("2024-01-01", 1), ("2024-01-02", 1)], "date string, department_id int")
    assert as_set(inputs.backlog_mean_of_days(days)) == {(1, JAN, 2.0)}
    assert inputs.backlog_mean_of_days(days.drop("date")) is None


def test_manual_labels_win(spark):
    previous = inputs.model_labels(
        spark.createDataFrame([(1, "STL"), (2, "SARIMAX-7"), (3, None)], "department_id int, Recommended_Model string"),
        schemas.REPORT_MODEL,
    )
    manual = inputs.model_labels(spark.createDataFrame([("2", "STL"), ("4", "X")], "department_id string, model string"))
    assert as_set(inputs.merge_labels(manual, previous)) == {(1, "STL"), (2, "STL"), (4, "X")}


def test_first_existing_source(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/b.parquet")
    assert read_first(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.parquet"]).count() == 3
    assert read_first(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/c.parquet"], "x int") is None
    assert empty_table(spark, schemas.MONTHLY_CALLS).count() == 0


def test_published_errors_take_names_from_the_map(spark, departments):
    errors = published_model_errors(spark)
    assert errors.count() == 16
    named = with_department_names(errors, departments)
    assert as_set(named.where("department_id <= 2"), "department_id", "department_name") == {(1, "Alpha"), (2, "Beta")}


def labels(spark, rows, sequence="int"):
    return spark.createDataFrame(rows, f"department_id int, model string, Sequence {sequence}")


def test_the_last_label_by_sequence_counts(spark):
    rows = [(1, "X", 1), (1, "A", 3), (1, "B", 2), (2, "A", 5), (2, "B", 5), (2, "Z", 1), (3, "M", None), (3, "B", 0), (4, "C", 1), (4, "C", 2), (None, "Q", 1), (5, None, 1)]
    table = labels(spark, rows)
    assert as_set(inputs.model_labels(table)) == {(1, "A"), (2, "B"), (3, "B"), (4, "C")}
    assert as_set(inputs.model_labels(table.drop("Sequence"))) == {(1, "X"), (2, "Z"), (3, "M"), (4, "C")}
    conflicts = {tuple(r)[1:] for r in inputs.label_conflicts(table, "s").collect()}
    assert conflicts == {
        (1, 3, "A, B, X", "A", "sequence"), (2, 3, "A, B, Z", "B", "alphabet"), (3, 2, "B, M", "B", "sequence")}
    assert {r.decided_by for r in inputs.label_conflicts(table.drop("Sequence"), "s").collect()} == {"alphabet"}


def test_sequences_as_text(spark):
    assert as_set(inputs.model_labels(labels(spark, [(1, "A", "10"), (1, "B", "9")], "string"))) == {(1, "A")}
    assert as_set(inputs.model_labels(labels(spark, [(1, "A", "2024-02-01"), (1, "B", "2023-12-01")], "string"))) == {(1, "A")}


def test_no_conflicts_without_columns(spark):
    assert inputs.label_conflicts(spark.createDataFrame([(1,)], "x int"), "s").collect() == []
