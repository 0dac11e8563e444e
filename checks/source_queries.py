"""Rows of readers and writers, without files."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.missing_queries import COMPARE_SQL, PAIR, numeric
from checks.registry import check, r, with_tables
from checks.tables import OBSERVATIONS_SQL, OSLO, TROMSO, observations
from stationloom.functions import source_of
from stationloom.operators import missing
from stationloom.operators.select import trim_normalise
from stationloom.plans.shared import shared_folder
from stationloom.sources import readers, sinks, versions

_ROWS_SQL = """SELECT sourceId, strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS referenceTime, timeOffset,
    elementId, num, unit FROM obs"""


def as_rows(df):
    return df.select("sourceId", "referenceTime", "timeOffset", "elementId",
                     F.col("value").try_cast("double").alias("num"), "unit")


@check("document_entries", with_tables(OBSERVATIONS_SQL, _ROWS_SQL))
def _(spark, sf):
    """Written as documents, as text, parsed and flattened again."""
    entries = sinks.document_entries(observations(spark, sf))
    texts = entries.select(F.to_json(F.struct("data")).alias("text"))
    return as_rows(readers.flatten_observations(readers.parse_documents(texts, "text")))


@check("city_observations", with_tables(OBSERVATIONS_SQL, """
    SELECT CASE sourceId WHEN '%s' THEN 'oslo' ELSE 'tromso' END AS city, CAST(ts AS DATE) AS day,
           timeOffset, elementId, num FROM obs""" % OSLO))
def _(spark, sf):
    """Rows of city files, read as the text they are."""
    table = readers.observation_rows(readers.text_table(sinks.station_rows(observations(spark, sf))))
    return table.select("city", F.to_date("referenceTime").alias("day"), "timeOffset", "elementId",
                        F.col("value").cast("double").alias("num"))


@check("missing_table_rows", with_tables(OBSERVATIONS_SQL, COMPARE_SQL, """
    SELECT d AS date, timeOffset, elementId, left_value, right_value, city FROM mis"""))
def _(spark, sf):
    found = missing.missing_values(observations(spark, sf), *PAIR)
    texts = found.select(*[F.col(c).cast("string").alias(c) for c in found.columns])
    return numeric(readers.missing_rows(readers.text_table(texts), "left_value", "right_value"))


@check("missing_report", with_tables(OBSERVATIONS_SQL, COMPARE_SQL, """
    SELECT city, elementId, COUNT(*) AS num_missing FROM mis GROUP BY ALL"""))
def _(spark, sf):
    return missing.missing_summary(missing.missing_values(observations(spark, sf), *PAIR))


RANGE_TOTALS_SQL = f"""
    SELECT sourceId, elementId, COUNT(*) AS n, {r('SUM(num)')} AS total FROM (
      SELECT sourceId, elementId, num FROM obs
      UNION ALL
      SELECT sourceId, 'range(air_temperature P1D)',
             MAX(CASE WHEN elementId LIKE 'max(%' THEN num END) - MAX(CASE WHEN elementId LIKE 'min(%' THEN num END)
      FROM obs WHERE elementId LIKE 'm__(air_temperature P1D)' AND DAY(d) <> 13
      GROUP BY sourceId, ts, timeOffset
      UNION ALL
      SELECT sourceId, 'range(air_temperature P1D)', NULL
      FROM obs WHERE elementId LIKE 'm__(air_temperature P1D)' AND DAY(d) = 13
      GROUP BY sourceId, ts, timeOffset) GROUP BY ALL"""


@check("rows_with_range", with_tables(OBSERVATIONS_SQL, RANGE_TOTALS_SQL))
def _(spark, sf):
    rows = sinks.rows_with_range(observations(spark, sf))
    return rows.groupBy("sourceId", "elementId").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").try_cast("double")).alias("total"))


# Null tokens of a text table are read as nulls, and a day without a number has no range.
@check("replaced_with_range", with_tables(OBSERVATIONS_SQL, f"""
    SELECT sourceId, elementId, COUNT(*) AS n, {r('SUM(num)')} AS total FROM (
      SELECT sourceId, elementId, num FROM obs
      UNION ALL
      SELECT sourceId, 'range(air_temperature P1D)',
             MAX(CASE WHEN elementId LIKE 'max(%' THEN num END) - MIN(CASE WHEN elementId LIKE 'min(%' THEN num END)
      FROM obs WHERE elementId LIKE 'm__(air_temperature P1D)' AND num IS NOT NULL
      GROUP BY sourceId, ts, timeOffset) GROUP BY ALL"""))
def _(spark, sf):
    """A table of files that takes the place of the one it was read from."""
    path = shared_folder(spark, "replaced")
    sinks.write_imputed(observations(spark, sf), path)
    sinks.replace_with_range(readers.read_observation_csv(spark, path), path)
    rows = readers.read_observation_csv(spark, versions.current_folder(spark, path))
    return rows.groupBy("sourceId", "elementId").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").try_cast("double")).alias("total"))


@check("imputed_rows", with_tables(OBSERVATIONS_SQL, """
    SELECT sourceId, strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS referenceTime, timeOffset, elementId,
           printf('%.3f', num) AS value, unit FROM obs WHERE num IS NOT NULL"""))
def _(spark, sf):
    numbers = observations(spark, sf).withColumn("value", F.col("value").try_cast("double"))
    return sinks.imputed_rows(numbers.where("value IS NOT NULL"))


@check("trim_normalise", with_tables(OBSERVATIONS_SQL, """
    SELECT elementId, COUNT(*) AS n FROM obs GROUP BY ALL"""))
def _(spark, sf):
    padded = observations(spark, sf).select(F.concat(F.lit("  "), "elementId", F.lit(" ")).alias(" elementId "))
    return trim_normalise(padded).groupBy("elementId").agg(F.count(F.lit(1)).alias("n"))


@check("source_of", with_tables(OBSERVATIONS_SQL, f"""
    SELECT sourceId, found, COUNT(*) AS n FROM (
      SELECT sourceId, CASE WHEN DAY(d) = 1 THEN NULL ELSE sourceId END AS found FROM obs
      WHERE sourceId IN ('{OSLO}', '{TROMSO}')) GROUP BY ALL"""))
def _(spark, sf):
    city = F.when(F.dayofmonth("referenceTime") == 1, "Bergen").when(F.col("sourceId") == OSLO, "OSLO").otherwise("Tromsø")
    texts = observations(spark, sf).select("sourceId", F.concat(F.lit("data/vaerdata_"), city, F.lit(".csv")).alias("path"))
    return texts.groupBy("sourceId", source_of(F.col("path"), strict=False).alias("found")).agg(F.count(F.lit(1)).alias("n"))
