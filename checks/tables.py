"""Observation tables derived from the test tables, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationloom.schema import (
    MAX_TEMPERATURE,
    MEAN_TEMPERATURE,
    MIN_TEMPERATURE,
    PRECIPITATION,
    STATIONS,
    WIND,
)

OSLO, TROMSO = STATIONS["oslo"], STATIONS["tromso"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stations, two offsets, five elements; one aggregate over ``lineitem``.

    ``value`` is text and ``'n/a'`` on day 13; temperature is missing at the
    second station in May and June 1998.
    """
    flag, q, price = F.col("l_returnflag"), F.col("l_quantity"), F.col("l_extendedprice")
    warm = F.when(flag == "A", q)
    rain = F.when(
        F.col("l_discount") >= 0.05, F.floor(q * q * q * q / 10000) / 10
    ).otherwise(0.0)
    order = (
        F.col("l_orderkey") * 10000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")
    )
    days = (
        read(spark, sf_dir, "lineitem")
        .groupBy(
            F.when(F.col("l_linestatus") == "F", OSLO).otherwise(TROMSO).alias("sourceId"),
            F.to_date("l_shipdate").alias("d"),
            F.concat(
                F.lit("PT"), ((F.col("l_linenumber") % 2) * 6).cast("string"), F.lit("H")
            ).alias("timeOffset"),
        )
        .agg(
            (F.max(warm) - 20).alias("high"),
            (F.min(warm) - 25).alias("low"),
            (F.floor((F.avg(warm) - 22) * 10) / 10).alias("mean"),
            F.max_by(rain, F.when(flag == "R", order)).alias("rain"),
            (F.floor(F.min(F.when(flag == "N", price)) / 500) / 10).alias("wind"),
        )
    )
    cells = F.array(*[
        F.struct(
            F.lit(element).alias("elementId"), F.col(c).alias("v"),
            F.lit(unit).alias("unit"),
        )
        for element, c, unit in (
            (MAX_TEMPERATURE, "high", "degC"), (MIN_TEMPERATURE, "low", "degC"),
            (MEAN_TEMPERATURE, "mean", "degC"), (PRECIPITATION, "rain", "mm"),
            (WIND, "wind", "m/s"),
        )
    ])
    outage = (
        (F.col("sourceId") == TROMSO)
        & (F.col("d") >= F.lit("1998-05-01").cast("date"))
        & (F.col("d") < F.lit("1998-07-01").cast("date"))
        & F.col("elementId").contains("air_temperature")
    )
    return (
        days.select("sourceId", "d", "timeOffset", F.inline(cells))
        .where(F.col("v").isNotNull() & ~outage)
        .select(
            "sourceId", F.col("d").cast("timestamp").alias("referenceTime"),
            "timeOffset", "elementId",
            F.when(F.dayofmonth("d") == 13, "n/a")
            .otherwise(F.col("v").cast("string")).alias("value"),
            "unit",
        )
    )


# The same table for the checking engine. ``num`` is the numeric reading of
# ``value``.
OBSERVATIONS_SQL = f"""
l AS (
  SELECT CASE l_linestatus WHEN 'F' THEN '{OSLO}' ELSE '{TROMSO}' END AS sourceId,
         CAST(l_shipdate AS DATE) AS d,
         CONCAT('PT', CAST((l_linenumber % 2) * 6 AS VARCHAR), 'H') AS timeOffset,
         l_returnflag AS rf, l_quantity AS q, l_discount AS disc, l_extendedprice AS p,
         l_orderkey * 10000000 + l_partkey * 10 + l_linenumber AS ord
  FROM lineitem),
long AS (
  SELECT sourceId, d, timeOffset, '{MAX_TEMPERATURE}' AS elementId, MAX(q) - 20 AS v, 'degC' AS unit FROM l WHERE rf = 'A' GROUP BY ALL
  UNION ALL SELECT sourceId, d, timeOffset, '{MIN_TEMPERATURE}', MIN(q) - 25, 'degC' FROM l WHERE rf = 'A' GROUP BY ALL
  UNION ALL SELECT sourceId, d, timeOffset, '{MEAN_TEMPERATURE}', FLOOR((AVG(q) - 22) * 10) / 10, 'degC' FROM l WHERE rf = 'A' GROUP BY ALL
  UNION ALL SELECT sourceId, d, timeOffset, '{PRECIPITATION}', MAX_BY(CASE WHEN disc >= 0.05 THEN FLOOR(q * q * q * q / 10000) / 10 ELSE 0 END, ord), 'mm' FROM l WHERE rf = 'R' GROUP BY ALL
  UNION ALL SELECT sourceId, d, timeOffset, '{WIND}', FLOOR(MIN(p) / 500) / 10, 'm/s' FROM l WHERE rf = 'N' GROUP BY ALL),
obs AS (
  SELECT sourceId, d, CAST(d AS TIMESTAMP) AS ts, timeOffset, elementId, unit,
         CASE WHEN DAY(d) = 13 THEN NULL ELSE v END AS num
  FROM long
  WHERE NOT (sourceId = '{TROMSO}' AND YEAR(d) = 1998 AND MONTH(d) IN (5, 6)
             AND elementId LIKE '%air_temperature%')),
best AS (
  SELECT sourceId, elementId,
         MIN_BY(timeOffset, CAST(regexp_extract(timeOffset, '^PT([0-9]+)H$', 1) AS INTEGER)) AS timeOffset
  FROM obs GROUP BY ALL),
mo AS (SELECT o.* FROM obs o JOIN best b USING (sourceId, elementId, timeOffset))
"""


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per ``lineitem`` row, one station per supplier.

    Grows with the table in rows and in stations.
    """
    flag = F.col("l_returnflag")
    return read(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("SN"), F.col("l_suppkey").cast("string")).alias("sourceId"),
        F.col("l_shipdate").cast("timestamp").alias("referenceTime"),
        F.concat(
            F.lit("PT"), ((F.col("l_linenumber") % 2) * 6).cast("string"), F.lit("H")
        ).alias("timeOffset"),
        F.when(flag == "A", MEAN_TEMPERATURE).when(flag == "R", PRECIPITATION)
        .otherwise(WIND).alias("elementId"),
        F.when(F.dayofmonth("l_shipdate") == 13, F.lit(None))
        .otherwise(F.floor("l_extendedprice") / 10).alias("value"),
        F.when(flag == "A", "degC").when(flag == "R", "mm").otherwise("m/s").alias("unit"),
    )


NETWORK_SQL = f"""
net AS (
  SELECT 'SN' || CAST(l_suppkey AS VARCHAR) AS sourceId, l_shipdate AS ts,
         CONCAT('PT', CAST((l_linenumber % 2) * 6 AS VARCHAR), 'H') AS timeOffset,
         CASE l_returnflag WHEN 'A' THEN '{MEAN_TEMPERATURE}' WHEN 'R' THEN '{PRECIPITATION}' ELSE '{WIND}' END AS elementId,
         CASE WHEN DAY(l_shipdate) = 13 THEN NULL ELSE FLOOR(l_extendedprice) / 10 END AS num
  FROM lineitem),
net_best AS (
  SELECT sourceId, elementId,
         MIN_BY(timeOffset, CAST(regexp_extract(timeOffset, '^PT([0-9]+)H$', 1) AS INTEGER)) AS timeOffset
  FROM net GROUP BY ALL),
net_mo AS (SELECT o.* FROM net o JOIN net_best b USING (sourceId, elementId, timeOffset))
"""


def station_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique (station, element, instant) from ``lineitem``; one station holds a quarter of it.

    Grows with the table in rows and in stations.
    """
    flag, supplier = F.col("l_returnflag"), F.col("l_suppkey")
    at = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(
        mins=(F.col("l_orderkey") % 1440).cast("int"))
    rows = read(spark, sf_dir, "lineitem").groupBy(
        F.when(supplier % 4 == 0, "SN0").otherwise(
            F.concat(F.lit("SN"), supplier.cast("string"))).alias("sourceId"),
        F.when(flag == "A", MEAN_TEMPERATURE).when(flag == "R", PRECIPITATION)
        .otherwise(WIND).alias("elementId"),
        at.alias("referenceTime"),
    ).agg((F.floor(F.max("l_extendedprice")) / 10).alias("number"))
    return rows.select(
        "sourceId", "elementId", "referenceTime",
        F.when(F.dayofmonth("referenceTime") != 13, F.col("number")).alias("value"))


STATION_SERIES_SQL = f"""
ser AS (
  SELECT CASE WHEN l_suppkey % 4 = 0 THEN 'SN0' ELSE 'SN' || CAST(l_suppkey AS VARCHAR) END AS sourceId,
         CASE l_returnflag WHEN 'A' THEN '{MEAN_TEMPERATURE}' WHEN 'R' THEN '{PRECIPITATION}' ELSE '{WIND}' END AS elementId,
         CAST(l_shipdate AS TIMESTAMP) + to_minutes(CAST(l_orderkey % 1440 AS INTEGER)) AS ts,
         CASE WHEN DAY(ts) <> 13 THEN FLOOR(MAX(l_extendedprice)) / 10 END AS num
  FROM lineitem GROUP BY 1, 2, 3),
near AS (
  SELECT *, epoch(ts) AS x, ROW_NUMBER() OVER w AS rn,
         LAST_VALUE(CASE WHEN num IS NOT NULL THEN epoch(ts) END IGNORE NULLS) OVER p AS x0,
         LAST_VALUE(num IGNORE NULLS) OVER p AS y0,
         FIRST_VALUE(CASE WHEN num IS NOT NULL THEN epoch(ts) END IGNORE NULLS) OVER f AS x1,
         FIRST_VALUE(num IGNORE NULLS) OVER f AS y1
  FROM ser
  WINDOW w AS (PARTITION BY sourceId, elementId ORDER BY ts),
         p AS (PARTITION BY sourceId, elementId ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY sourceId, elementId ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
gaps AS (
  SELECT *, rn - MAX(CASE WHEN num IS NOT NULL THEN rn END) OVER (PARTITION BY sourceId, elementId ORDER BY ts) AS into_gap,
         CASE WHEN num IS NOT NULL THEN num WHEN x1 IS NULL THEN y0 WHEN x0 IS NULL THEN y1
              ELSE y0 + (y1 - y0) * (x - x0) / (x1 - x0) END AS filled
  FROM near)
"""


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One observation per event: station = user, element = event type."""
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("sourceId"),
        F.col("ts").cast("timestamp").alias("referenceTime"),
        F.lit("PT0H").alias("timeOffset"),
        F.col("event_type").alias("elementId"),
        F.col("value"),
        F.lit("").alias("unit"),
    )


EVENTS_SQL = """
ev AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS sourceId, ts, 'PT0H' AS timeOffset,
         event_type AS elementId, value AS num
  FROM events)
"""
