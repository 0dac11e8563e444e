import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from stationloom.operators import reshape
from stationloom.schema import MAX_TEMPERATURE, MIN_TEMPERATURE, RANGE_TEMPERATURE


def cell(element, value, day="2021-01-01"):
    return ("S", day, "PT0H", element, value, "degC")


def test_daily_range(obs):
    df = obs([cell(MAX_TEMPERATURE, "15.2"), cell(MIN_TEMPERATURE, "5.7"), cell("rain", "3"),
              cell(MAX_TEMPERATURE, "20", "2021-01-02")])
    got = reshape.daily_range(df)
    assert rows(got, "elementId", "value", "unit") == [
        (RANGE_TEMPERATURE, 9.5, "degC"), (RANGE_TEMPERATURE, None, "degC")]
    assert reshape.add_daily_range(df).count() == 6


def test_first_value_in_order_counts(obs):
    df = obs([cell(MAX_TEMPERATURE, None), cell(MAX_TEMPERATURE, "9"),
              cell(MAX_TEMPERATURE, "30"), cell(MIN_TEMPERATURE, "1")]).coalesce(1)
    assert reshape.daily_range(df).first()["value"] == 8.0
    ordered = df.withColumn("rank", F.when(F.col("value") == "30", 0).otherwise(1))
    assert reshape.daily_range(ordered, "rank").first()["value"] == 29.0


def test_pivot_and_melt(obs):
    df = obs([cell("a", "1"), cell("b", "2"), cell("a", "3", "2021-01-02")])
    wide = reshape.pivot_elements(df, ["a", "b"])
    assert rows(wide, "a", "b") == [(1.0, 2.0), (3.0, None)]
    assert reshape.melt_elements(wide, ["a", "b"]).count() == 4
    with pytest.raises(PySparkException):
        reshape.pivot_elements(df.union(df), ["a", "b"]).collect()


def test_feature_pivot(obs):
    df = obs([cell("a", "1"), cell("a", "3"), cell("b", "2"), cell("a", "9", "2021-01-02")])
    got = reshape.feature_pivot(df, {"a": "A", "b": "B"})
    assert rows(got, "A", "B") == [(2.0, 2.0)]
