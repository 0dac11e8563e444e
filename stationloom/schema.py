"""Column layout of the observation model and the fixed values it uses."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SOURCE = "sourceId"
TIME = "referenceTime"
OFFSET = "timeOffset"
ELEMENT = "elementId"
VALUE = "value"
UNIT = "unit"

OBSERVATION_COLUMNS = [SOURCE, TIME, OFFSET, ELEMENT, VALUE, UNIT]

# One series = one station, one element, one daily offset.
SERIES = [SOURCE, ELEMENT, OFFSET]

# Element identifiers.
MEAN_TEMPERATURE = "mean(air_temperature P1D)"
MIN_TEMPERATURE = "min(air_temperature P1D)"
MAX_TEMPERATURE = "max(air_temperature P1D)"
RANGE_TEMPERATURE = "range(air_temperature P1D)"
PRECIPITATION = "sum(precipitation_amount P1D)"
WIND = "mean(wind_speed P1D)"
OBSERVED_ELEMENTS = [
    MEAN_TEMPERATURE,
    MIN_TEMPERATURE,
    MAX_TEMPERATURE,
    PRECIPITATION,
    WIND,
]

# City slug -> station.
STATIONS = {"oslo": "SN18700:0", "tromso": "SN90450:0"}

# Part of a text that names a city -> its slug; the first that fits counts.
CITY_TEXTS = {"oslo": "oslo", "troms": "tromso"}

# Part of an element's name -> unit; the first that fits counts.
UNITS = {"temperature": "degC", "wind_speed": "m/s", "precipitation_amount": "mm"}

# Text tokens a delimited scan reads as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

OBSERVATION_SCHEMA = T.StructType([
    T.StructField(SOURCE, T.StringType()),
    T.StructField(TIME, T.TimestampType()),
    T.StructField(OFFSET, T.StringType()),
    T.StructField(ELEMENT, T.StringType()),
    T.StructField(VALUE, T.StringType()),
    T.StructField(UNIT, T.StringType()),
])

# Nested observation document. ``value`` is text so that numbers and words
# both survive the scan; it becomes numeric in ``functions.number_column``.
DOCUMENT_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField(SOURCE, T.StringType()),
        T.StructField(TIME, T.StringType()),
        T.StructField("observations", T.ArrayType(T.StructType([
            T.StructField(OFFSET, T.StringType()),
            T.StructField(ELEMENT, T.StringType()),
            T.StructField(VALUE, T.StringType()),
            T.StructField(UNIT, T.StringType()),
        ]))),
    ]))),
])


class MissingColumnError(KeyError):
    """A required column is absent from the input."""


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Return ``df`` or raise :class:`MissingColumnError` naming what is absent."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise MissingColumnError(
            f"missing column(s) {absent}; input has {df.columns}"
        )
    return df


def require_rows(df: DataFrame, strict: bool, message: str) -> DataFrame:
    """With ``strict`` run one small job and raise ``ValueError`` when ``df`` is empty.

    Without it the frame stays lazy and an empty selection is an empty result.
    """
    if strict and df.isEmpty():
        raise ValueError(message)
    return df
