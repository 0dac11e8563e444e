"""Scans of observation documents, station files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationloom.functions import null_tokens_to_null, to_utc_timestamp
from stationloom.operators.select import scan_selection
from stationloom.schema import (
    DOCUMENT_SCHEMA,
    ELEMENT,
    OBSERVATION_COLUMNS,
    OFFSET,
    SOURCE,
    TIME,
    UNIT,
    VALUE,
    require_columns,
)

# File name patterns of one city's observations.
RAW_PATTERN = "vaerdata_{city}.csv"
IMPUTED_PATTERN = "vaerdata_{city}_imputert.csv"


def read_observation_json(spark: SparkSession, path: str | Sequence[str],
                          multi_line: bool = True, strict: bool = False) -> DataFrame:
    """Nested observation documents, one per row.

    Invalid JSON and a document whose ``data`` is missing or empty fail the
    query that reads it. ``strict`` looks now, with one pass over the input, and
    raises ``ValueError``. A multi-line document is one task's work, so large
    inputs should be many files; with ``multi_line=False`` every line is a
    document and files split.
    """
    raw = (
        spark.read.schema(DOCUMENT_SCHEMA).option("multiLine", multi_line)
        .option("mode", "FAILFAST").json(path)
    )
    if strict:
        missing = _without_data()
        try:
            bad = not raw.where(missing).isEmpty()
        except (PySparkException, Py4JJavaError) as exc:
            raise ValueError(f"not a valid observation document: {path}") from exc
        if bad:
            raise ValueError("document lacks 'data' or it is empty")
        return raw
    return checked_documents(raw)


def _without_data() -> Column:
    return F.coalesce(F.size("data") <= 0, F.lit(True))


def checked_documents(documents: DataFrame) -> DataFrame:
    """Documents whose ``data`` is missing or empty fail the query that reads them."""
    problem = F.raise_error(F.lit("document lacks 'data' or it is empty"))
    return documents.select(
        F.when(_without_data(), problem).otherwise(F.col("data")).alias("data"))


def parse_documents(texts: DataFrame, column: str) -> DataFrame:
    """Documents held as JSON text in a column; invalid text fails the query."""
    parsed = F.from_json(F.col(column), DOCUMENT_SCHEMA, {"mode": "FAILFAST"})
    return checked_documents(texts.select(parsed["data"].alias("data")))


def flatten_observations(documents: DataFrame) -> DataFrame:
    """One row per nested observation; all columns text.

    A missing unit becomes ``N/A``, an entry without observations gives no row.
    """
    entries = documents.select(F.explode("data").alias("entry"))
    rows = entries.select("entry.*").select(
        SOURCE, TIME, F.explode("observations").alias("observation")
    )
    o = F.col("observation")
    return rows.select(
        SOURCE, TIME, o[OFFSET].alias(OFFSET), o[ELEMENT].alias(ELEMENT),
        o[VALUE].alias(VALUE), F.coalesce(o[UNIT], F.lit("N/A")).alias(UNIT),
    )


def _read_text_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Delimited file with a header; all columns text, null tokens removed."""
    try:
        raw = spark.read.option("header", True).option("escape", '"').csv(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such input: {path}") from exc
        raise
    return text_table(raw)


def text_table(raw: DataFrame) -> DataFrame:
    """Text columns without null tokens."""
    return raw.select(*[
        null_tokens_to_null(F.col(f"`{c}`")).alias(c) for c in raw.columns
    ])


def observation_rows(table: DataFrame) -> DataFrame:
    """Observations of a text table; unparseable times become null."""
    return require_columns(table, [TIME]).withColumn(TIME, to_utc_timestamp(F.col(TIME)))


def read_observation_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Observations from delimited files; unparseable times become null."""
    return observation_rows(_read_text_table(spark, path))


def read_city_observations(spark: SparkSession, data_dir: str, city: str,
                           prefer: str = "imputed") -> DataFrame:
    """Observations of one city.

    ``prefer='imputed'`` takes the imputed file and falls back to the raw one;
    ``'raw'`` takes only the raw one.
    """
    if prefer not in ("imputed", "raw"):
        raise ValueError("prefer must be 'imputed' or 'raw'")
    raw_path = f"{data_dir}/{RAW_PATTERN.format(city=city)}"
    if prefer == "imputed":
        try:
            return read_observation_csv(
                spark, f"{data_dir}/{IMPUTED_PATTERN.format(city=city)}"
            )
        except FileNotFoundError:
            pass
    return read_observation_csv(spark, raw_path)


def read_missing_table(spark: SparkSession, path: str,
                       left_column: str = "oslo_value",
                       right_column: str = "tromso_value") -> DataFrame:
    """Missing table from delimited files; bad dates become null."""
    return missing_rows(_read_text_table(spark, path), left_column, right_column)


def missing_rows(table: DataFrame, left_column: str, right_column: str) -> DataFrame:
    """Missing table of a text table; bad dates become null."""
    raw = require_columns(table, ["date", OFFSET, ELEMENT, left_column, right_column])
    extra = ["city"] if "city" in raw.columns else []
    return raw.select(
        F.col("date").try_cast("date").alias("date"), OFFSET, ELEMENT,
        F.col(left_column).alias("left_value"),
        F.col(right_column).alias("right_value"), *extra,
    )


def scan_observations(spark: SparkSession, path: str, sources: Sequence[str],
                      elements: Sequence[str], start: str, end: str) -> DataFrame:
    """Stations x elements x inclusive time range of a stored table.

    On a table from ``write_observation_table`` the year prunes directories, stations and
    elements reach the file scan.
    """
    table = spark.read.parquet(path)
    return scan_selection(table, sources, elements, start, end).select(
        *OBSERVATION_COLUMNS
    )
