from datetime import date

import pytest
from pyspark.errors import PySparkException

from conftest import rows
from stationloom.operators import missing

CITIES = ("Oslo", "Tromsø")


@pytest.fixture()
def pair(obs):
    return obs([
        ("A", "2021-01-01", "PT0H", "e1", "10", ""), ("A", "2021-01-01", "PT0H", "e2", None, ""),
        ("B", "2021-01-01", "PT0H", "e1", "n/a", ""), ("B", "2021-01-01", "PT0H", "e2", "20", ""),
        ("B", "2021-01-02", "PT0H", "e2", "5", ""),
    ])


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(
        [(date(2025, 5, 1), "PT0H", "e1", None, 10.0), (date(2025, 5, 2), "PT0H", "e2", 5.0, None),
         (date(2025, 5, 3), "PT0H", "e3", None, None)],
        "date date, timeOffset string, elementId string, left_value double, right_value double")


def test_missing_values(pair):
    got = missing.missing_values(pair, "A", "B", *CITIES)
    assert rows(got, "elementId", "city", "date") == [
        ("e1", "Tromsø", "2021-01-01"), ("e2", "Oslo", "2021-01-01"), ("e2", "Oslo", "2021-01-02")]
    summary = missing.missing_summary(got)
    assert [tuple(r) for r in summary.collect()] == [("Oslo", "e2", 2), ("Tromsø", "e1", 1)]
    assert rows(missing.missing_counts(pair, "A", "B", *CITIES)) == rows(summary)


def test_duplicates_and_null_keys_match_the_full_comparison(obs):
    data = (
        [("A", "2021-01-01", "PT0H", "e", v, "") for v in (None, None, "1")]
        + [("B", "2021-01-01", "PT0H", "e", v, "") for v in ("2", "3", None)]
        + [("A", "bad", "PT0H", "e", None, ""), ("B", "bad", "PT0H", "e", "4", ""),
           ("B", "2021-01-01", None, "f", "4", "")]
    )
    df = obs(data)
    compared = missing.compare_stations(df, "A", "B")
    left = compared.where("left_value IS NULL AND right_value IS NOT NULL")
    right = compared.where("right_value IS NULL AND left_value IS NOT NULL")
    assert compared.count() == 9 + 1 + 1
    got = missing.missing_values(df, "A", "B", *CITIES)
    columns = ("date", "timeOffset", "elementId", "left_value", "right_value")
    assert rows(got.where("city = 'Oslo'"), *columns) == rows(left, *columns)
    assert rows(got.where("city = 'Tromsø'"), *columns) == rows(right, *columns)
    assert rows(missing.missing_counts(df, "A", "B", *CITIES)) == rows(
        missing.missing_summary(got))


def test_classified(table):
    got = missing.missing_rows_classified(table, *CITIES)
    assert rows(got, "elementId", "missing") == [
        ("e1", "Oslo"), ("e2", "Tromsø"), ("e3", "Tromsø")]
    summary = missing.missing_summary_classified(table, *CITIES)
    wide = missing.missing_summary_pivot(summary, CITIES)
    assert rows(wide, "elementId", "Oslo", "Tromsø") == [
        ("e1", 1, 0), ("e2", 0, 1), ("e3", 0, 1)]
    one = missing.missing_counts_filtered(table, *CITIES, "e3", ["Tromsø"])
    assert rows(one) == [("Tromsø", "e3", 1)]


def test_indicator_wide(spark, table):
    wide = missing.missing_indicator_wide(table, "Oslo", *CITIES, ["e1", "e2", "e3"])
    assert rows(wide, "e1", "e2", "e3") == [(1.0, 0.0, 0.0)]
    two = spark.createDataFrame(
        [("2021-01-01", "PT0H", "e1", None, 1.0), ("2021-01-02", "PT0H", "e3", None, 1.0),
         ("2021-01-02", "PT0H", "e2", 1.0, None)],
        "date string, timeOffset string, elementId string, left_value double, right_value double")
    wide = missing.missing_indicator_wide(two, "Oslo", *CITIES, ["e1", "e2", "e3"])
    assert rows(wide, "date", "e1", "e2", "e3") == [
        ("2021-01-01", 1.0, 0.0, None), ("2021-01-02", None, 0.0, 1.0)]


def test_values_wide(table):
    got = missing.values_by_offset(table, "left_value", ["PT0H"])
    assert rows(got, "date", "PT0H")[1] == (date(2025, 5, 2), 5.0)
    ordered = missing.values_by_offset(table, "left_value", ["PT0H"], order=["PT6H", "PT0H"])
    assert ordered.columns == ["date", "PT0H"]
    assert missing.values_by_element(table, "right_value", ["e1", "e2", "e3"]).columns == [
        "date", "timeOffset", "e1", "e2", "e3"]
    with pytest.raises(PySparkException):
        missing.values_by_offset(table.union(table), "left_value", ["PT0H"]).collect()


def test_runs(spark):
    recorded = spark.createDataFrame(
        [(f"2021-01-0{d}", "PT0H", "e", None, 1.0) for d in (1, 2, 3, 5, 9)]
        + [("2021-01-04", "PT0H", "f", None, 1.0)],
        "date string, timeOffset string, elementId string, left_value double, right_value double")
    got = rows(missing.missing_runs(recorded, "left_value", "recorded").where("elementId = 'e'"),
               "start", "end")
    day = [date(2021, 1, d) for d in range(1, 10)]
    assert got == [(day[0], day[2]), (day[4], day[4]), (day[8], day[8])]
    pivot = missing.missing_runs(recorded, "right_value", elements=["e", "f"]).where("elementId = 'e'")
    assert rows(pivot, "start", "end") == [(day[3], day[3])]
    whole = missing.missing_runs(recorded, "left_value", elements=["e", "f"]).where("elementId = 'e'")
    assert rows(whole, "start", "end") == [(day[0], day[4]), (day[8], day[8])]
    with pytest.raises(ValueError):
        missing.missing_runs(recorded, "left_value", "other")


def test_nullity_correlation(spark):
    wide = spark.createDataFrame(
        [(1.0, None, 1.0), (None, 1.0, 1.0), (1.0, None, 1.0)], "a double, b double, c double")
    assert rows(missing.nullity_correlation(wide, ["a", "b", "c"])) == [("a", "b", -1.0)]
    assert missing.nullity_correlation(wide, ["a"]).count() == 0


def test_before_after(spark):
    before = spark.createDataFrame([("Oslo",), ("Oslo",), ("Tromsø",)], "city string")
    after = spark.createDataFrame([("Oslo",), ("Bergen",)], "city string")
    assert rows(missing.missing_before_after(before, after)) == [
        ("Bergen", 0, 1), ("Oslo", 2, 1), ("Tromsø", 1, 0)]
