from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stationloom import functions as fn


def one(spark, text, function):
    df = spark.createDataFrame([(text,)], "x string")
    return df.select(function(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text, expected", [
    (" 5 ", 5.0), ("1e3", 1000.0), ("-.5", -0.5), ("nan", None), ("", None),
    ("0x10", None), ("1_000", None), ("5d", None), ("5f", None), ("1,5", None),
    ("inf", float("inf")), ("0x1p3", None), (None, None), ("n/a", None),
])
def test_to_number(spark, text, expected):
    assert one(spark, text, fn.to_number) == expected


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "value double")
    got = [r[0] for r in df.select(fn.number_column(df)).collect()]
    assert got == [None, 1.0]


@pytest.mark.parametrize("text, hours", [
    ("PT6H", 6), ("PT10H", 10), ("PT06H", 6), ("PT6H30M", None), ("BAD", None),
    ("xPT6H", None), (None, None),
])
def test_offset_hours_strict(spark, text, hours):
    assert one(spark, text, fn.offset_hours_strict) == hours


@pytest.mark.parametrize("text, hours, minutes", [
    ("PT6H", 6, 0), ("PT6H30M", 6, 30), ("PT15M", 0, 15), ("BAD", 0, 0), (None, 0, 0),
])
def test_offset_parts(spark, text, hours, minutes):
    assert one(spark, text, fn.offset_hours) == hours
    assert one(spark, text, fn.offset_minutes) == minutes


def test_times(spark):
    df = spark.createDataFrame(
        [("2021-03-04T00:00:00.000Z", "PT6H30M"), ("bad", "PT1H"),
         ("2021-03-04T02:00:00+02:00", "PT0H")], "t string, o string")
    at = fn.observation_instant(fn.to_utc_timestamp(F.col("t")), F.col("o"))
    got = df.select(
        at.alias("at"), fn.format_offset(at), fn.iso_format(at)).collect()
    assert got[0][1:] == ("PT6H30M", "2021-03-04T06:30:00.000Z")
    assert got[1]["at"] is None
    assert got[2][1:] == ("PT0H", "2021-03-04T00:00:00.000Z")


@pytest.mark.parametrize("element, unit", [
    ("mean(air_temperature P1D)", "degC"), ("mean(wind_speed P1D)", "m/s"),
    ("sum(precipitation_amount P1D)", "mm"), ("other", ""),
])
def test_unit_of(spark, element, unit):
    assert one(spark, element, fn.unit_of) == unit


def test_source_of(spark):
    assert one(spark, "data/OSLO.csv", fn.source_of) == "SN18700:0"
    assert one(spark, "Tromsø", fn.source_of) == "SN90450:0"
    assert one(spark, "bergen", lambda c: fn.source_of(c, strict=False)) is None
    with pytest.raises(PySparkException):
        one(spark, "bergen", fn.source_of)


def test_texts(spark):
    assert one(spark, "TROMSØ", fn.city_slug) == "tromso"
    assert one(spark, "Ålesund æ", fn.city_slug) == "alesund ae"
    assert one(spark, "oslo", fn.city_label) == "Oslo"
    assert one(spark, "2021-03-04T00:00", fn.date_part_text) == "2021-03-04"
    when = spark.createDataFrame([(datetime(2021, 3, 4),)], "x timestamp")
    got = when.select(fn.month_abbr(F.col("x")), fn.month_name(F.col("x")),
                      fn.month_label(F.col("x")), fn.year_month(F.col("x"))).first()
    assert tuple(got) == ("Mar", "March", "Mar 2021", "2021-03")


def test_percentage(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a long, b long")
    got = [r[0] for r in df.select(fn.percentage(F.col("a"), F.col("b"))).collect()]
    assert got == [33.3, 0.0]
