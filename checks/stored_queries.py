"""Operators over a stored table with its series catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.basic_queries import net_sql, plain
from checks.registry import check, r, with_tables
from checks.outlier_queries import _SUMMARY_SQL
from checks.stats_queries import _MONTH_END, KEYS
from checks.tables import NETWORK_SQL, OBSERVATIONS_SQL, network, observations
from stationloom.operators import change, outliers, select, sketches, stats
from stationloom.operators.quantiles import Quantile
from stationloom.plans.shared import shared_folder
from stationloom.schema import SERIES
from stationloom.sources import catalogue, ranges, readers, sinks


def stored(spark, sf):
    """The network written in three steps, one of which replaces a year, and its catalogue."""
    path = shared_folder(spark, "observations")
    table = network(spark, sf)
    early = F.col("referenceTime") < F.lit("1996-03-01").cast("timestamp")
    sinks.write_observation_table(table.where(early), path)
    sinks.write_observation_table(table.where(~early), path, "append")
    # a year written again takes the place of what was there
    sinks.write_observation_table(select.filter_year(table, 1997), path)
    return spark.read.parquet(path), catalogue.read_catalogue(spark, path)


@check("series_catalogue", with_tables(NETWORK_SQL, f"""
    SELECT CAST(YEAR(ts) AS INTEGER) AS "year", {KEYS}, COUNT(*) AS "rows", MIN(ts) AS "first", MAX(ts) AS "last"
    FROM net GROUP BY ALL"""))
def _(spark, sf):
    _, series = stored(spark, sf)
    return series.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first", "last")})


@check("month_stats_stored", with_tables(NETWORK_SQL, f"""
    SELECT {KEYS}, {r('AVG(num)')} AS mean, {r('MEDIAN(num)')} AS median, {r('STDDEV_POP(num)')} AS std
    FROM net_mo WHERE num IS NOT NULL AND strftime(ts, '%Y-%m') = '1996-02' GROUP BY ALL"""))
def _(spark, sf):
    table, series = stored(spark, sf)
    return stats.month_stats(table, "1996-02", catalogue=series)


@check("yearly_median_stored", with_tables(NETWORK_SQL, f"""
    SELECT {KEYS}, 1997 AS "year", {r('MEDIAN(num)')} AS value
    FROM net_mo WHERE num IS NOT NULL AND YEAR(ts) = 1997 GROUP BY ALL"""))
def _(spark, sf):
    table, series = stored(spark, sf)
    return stats.yearly(table, "median", year=1997, catalogue=series)


@check("period_stat_stored", with_tables(NETWORK_SQL, f"""
    SELECT {KEYS}, {_MONTH_END} AS period, {r('AVG(num)')} AS value FROM net_mo
    WHERE ts >= '1996-02-15' AND ts <= '1997-08-01' GROUP BY ALL"""))
def _(spark, sf):
    table, series = stored(spark, sf)
    return change.period_stat(table, "mean", "ME", start="1996-02-15", end="1997-08-01", catalogue=series)


@check("yearly_raw_stored", net_sql("num IS NOT NULL AND YEAR(ts) = 1997", NETWORK_SQL, "net_mo"))
def _(spark, sf):
    table, series = stored(spark, sf)
    return plain(select.yearly_raw(table.drop("year"), None, 1997, catalogue=series))


def sketched(spark, sf):
    """The network with quantile sketches, written and appended to."""
    path = shared_folder(spark, "observations")
    table = network(spark, sf)
    early = F.col("referenceTime") < F.lit("1996-03-15").cast("timestamp")
    sinks.write_observation_table(table.where(early), path, sketches=True)
    sinks.write_observation_table(table.where(~early), path, "append", sketches=True)
    return spark.read.parquet(path), sketches.read_sketches(spark, path)


@check("iqr_summary_sketched", with_tables(NETWORK_SQL, _SUMMARY_SQL))
def _(spark, sf):
    table, made = sketched(spark, sf)
    return outliers.iqr_summary(table, SERIES, sketches=made)


@check("element_quantiles_sketched", with_tables(NETWORK_SQL, f"""
    SELECT elementId, {r('quantile_cont(num, 0.1)')} AS q10, {r('quantile_cont(num, 0.5)')} AS q50,
           {r('quantile_cont(num, 0.99)')} AS q99, COUNT(num) AS n
    FROM net GROUP BY ALL"""))
def _(spark, sf):
    """Groups over all stations; little state, so that brackets are made narrower."""
    table, made = sketched(spark, sf)
    wanted = [Quantile("q10", "value", 0.1), Quantile("q50", "value", 0.5), Quantile("q99", "value", 0.99)]
    return sketches.sketched_quantiles(
        table, made, ["elementId"], wanted, [F.count("value").alias("n")], state=50)


@check("yearly_median_sketched", with_tables(NETWORK_SQL, f"""
    SELECT elementId, CAST(YEAR(ts) AS INTEGER) AS "year", {r('MEDIAN(num)')} AS value FROM net GROUP BY ALL"""))
def _(spark, sf):
    table, made = sketched(spark, sf)
    return sketches.sketched_quantiles(
        table, made, ["elementId", "year"], [Quantile("value", "value", 0.5)])


@check("large_document_rows", with_tables(OBSERVATIONS_SQL, """
    SELECT sourceId, strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS referenceTime, timeOffset, elementId, num, unit FROM obs"""))
def _(spark, sf):
    """One document of each year, of many lines, read by byte ranges."""
    path = shared_folder(spark, "documents")
    entry = F.col("data")[0]
    entries = sinks.document_entries(observations(spark, sf)).select(
        F.substring(entry["referenceTime"], 1, 4).alias("year"), F.concat(F.to_json(entry), F.lit(",")).alias("line"))
    years = entries.select("year").distinct()
    # the last entry has no observations and so no rows
    parts = (entries.withColumn("place", F.lit(1))
             .unionByName(years.select("year", F.lit('{"data": [').alias("line"), F.lit(0).alias("place")))
             .unionByName(years.select("year", F.lit('{"sourceId": "", "observations": []}]}').alias("line"), F.lit(2).alias("place"))))
    parts.repartition("year").sortWithinPartitions("year", "place").select("year", "line").write.partitionBy("year").text(path)
    rows = readers.flatten_observations(ranges.read_large_documents(spark, path))
    return rows.select("sourceId", "referenceTime", "timeOffset", "elementId", F.col("value").try_cast("double").alias("num"), "unit")
