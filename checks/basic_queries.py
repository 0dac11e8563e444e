"""Scans, selections, reshaping and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, r, with_tables
from checks.tables import (
    NETWORK_SQL,
    OBSERVATIONS_SQL,
    OSLO,
    TROMSO,
    network,
    observations,
    read,
)
from stationloom import functions as fn
from stationloom.operators import reshape, select
from stationloom.schema import (
    MAX_TEMPERATURE,
    MEAN_TEMPERATURE,
    MIN_TEMPERATURE,
    OBSERVED_ELEMENTS,
    PRECIPITATION,
    STATIONS,
    WIND,
)
from stationloom.sources.readers import flatten_observations


def plain(df):
    """Station, day, offset, element and numeric value."""
    return df.select(
        "sourceId", F.to_date("referenceTime").alias("day"), "timeOffset", "elementId",
        fn.number_column(df).alias("value"),
    )


def net_sql(where: str, tables: str = NETWORK_SQL, source: str = "net") -> str:
    return with_tables(tables, f"""
        SELECT sourceId, CAST(ts AS DATE) AS day, timeOffset, elementId,
               {r('num')} AS value
        FROM {source} WHERE {where}""")


# --- sources ----------------------------------------------------------------

@check("flatten_observations", """
    SELECT 'SN' || CAST(o_custkey AS VARCHAR) AS sourceId,
           strftime(o_orderdate, '%Y-%m-%dT00:00:00.000Z') AS referenceTime,
           CAST(NULL AS VARCHAR) AS timeOffset, 'price' AS elementId,
           CAST(o_orderkey AS VARCHAR) AS value, 'N/A' AS unit
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT 'SN' || CAST(o_custkey AS VARCHAR),
           strftime(o_orderdate, '%Y-%m-%dT00:00:00.000Z'),
           'PT6H', 'status', o_orderstatus, 'code'
    FROM orders WHERE o_orderstatus <> 'P'""")
def _(spark, sf):
    orders = read(spark, sf, "orders")
    text = F.lit(None).cast("string")

    def observation(offset, element, value, unit):
        return F.struct(
            offset.alias("timeOffset"), F.lit(element).alias("elementId"),
            value.cast("string").alias("value"), unit.alias("unit"),
        )

    both = F.array(
        observation(text, "price", F.col("o_orderkey"), text),
        observation(F.lit("PT6H"), "status", F.col("o_orderstatus"), F.lit("code")),
    )
    documents = orders.select(F.array(F.struct(
        F.concat(F.lit("SN"), F.col("o_custkey").cast("string")).alias("sourceId"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'.000Z'").alias("referenceTime"),
        F.when(F.col("o_orderstatus") != "P", both).alias("observations"),
    )).alias("data"))
    return flatten_observations(documents)


@check("scan_observations", net_sql(f"""
    sourceId IN ('SN3', 'SN4', 'SN5', 'SN7') AND elementId IN ('{WIND}', '{PRECIPITATION}')
    AND ts >= TIMESTAMP '1997-01-01' AND ts <= TIMESTAMP '1999-12-31'"""))
def _(spark, sf):
    return plain(select.scan_selection(
        network(spark, sf), ["SN3", "SN4", "SN5", "SN7"], [WIND, PRECIPITATION],
        "1997-01-01", "1999-12-31"))


# --- filters and projections --------------------------------------------------

@check("filter_series", net_sql(f"elementId = '{WIND}' AND timeOffset = 'PT6H'"))
def _(spark, sf):
    return plain(select.filter_series(network(spark, sf), WIND, "PT6H"))


@check("filter_month", net_sql("strftime(ts, '%Y-%m') = '1998-02'"))
def _(spark, sf):
    return plain(select.filter_month(network(spark, sf), "1998-02"))


@check("filter_year", net_sql("YEAR(ts) = 1999"))
def _(spark, sf):
    return plain(select.filter_year(network(spark, sf), 1999))


@check("filter_period", net_sql(
    "ts >= TIMESTAMP '1998-03-01' AND ts <= TIMESTAMP '1998-05-17'"))
def _(spark, sf):
    return plain(select.filter_period(network(spark, sf), "1998-03", "1998-05-17"))


@check("filter_day_of_year", net_sql("MONTH(ts) = 5 AND DAY(ts) = 17"))
def _(spark, sf):
    return plain(select.filter_day_of_year(network(spark, sf), 5, 17))


@check("filter_elements", net_sql(f"elementId IN ('{WIND}', '{MEAN_TEMPERATURE}')"))
def _(spark, sf):
    return plain(select.filter_elements(network(spark, sf), [WIND, MEAN_TEMPERATURE]))


@check("drop_invalid_values", net_sql("num IS NOT NULL", OBSERVATIONS_SQL, "obs"))
def _(spark, sf):
    return plain(select.drop_invalid_values(observations(spark, sf)))


@check("yearly_raw", net_sql(
    "num IS NOT NULL AND YEAR(ts) = 1997", NETWORK_SQL, "net_mo"))
def _(spark, sf):
    return plain(select.yearly_raw(network(spark, sf), None, 1997))


@check("project_metadata", with_tables(OBSERVATIONS_SQL, f"""
    SELECT sourceId, strftime(d, '%Y-%m-%dT') || lpad(CAST(h AS VARCHAR), 2, '0')
             || ':00:00.000Z' AS referenceTime,
           'PT' || CAST(h AS VARCHAR) || 'H' AS timeOffset, elementId,
           {r('num')} AS value,
           CASE WHEN elementId LIKE '%temperature%' THEN 'degC'
                WHEN elementId LIKE '%wind_speed%' THEN 'm/s' ELSE 'mm' END AS unit
    FROM (SELECT *, CAST(regexp_extract(timeOffset, 'PT([0-9]+)H', 1) AS INTEGER) AS h
          FROM obs)"""))
def _(spark, sf):
    obs = observations(spark, sf)
    rows = obs.select(
        "sourceId", "elementId", fn.number_column(obs).alias("value"),
        fn.observation_instant(F.col("referenceTime"), F.col("timeOffset")).alias("instant"),
    )
    return select.project_metadata(rows)


@check("station_lookup", with_tables(OBSERVATIONS_SQL, f"""
    SELECT sourceId, elementId, CASE sourceId WHEN '{OSLO}' THEN 'oslo' ELSE 'tromso' END AS city,
           COUNT(*) AS n
    FROM obs GROUP BY ALL"""))
def _(spark, sf):
    return select.station_lookup(observations(spark, sf), STATIONS).groupBy(
        "sourceId", "elementId", "city").agg(F.count(F.lit(1)).alias("n"))


@check("scalar_functions", with_tables(OBSERVATIONS_SQL, f"""
    SELECT sourceId, d AS day, timeOffset, elementId,
           CAST(regexp_extract(timeOffset, '^PT([0-9]+)H$', 1) AS BIGINT) AS hours,
           strftime(d, '%Y-%m') AS year_month, strftime(d, '%b') AS month_abbr,
           strftime(d, '%B') AS month_name, strftime(d, '%b %Y') AS month_label,
           strftime(d, '%Y-%m-%dT00:00:00.000Z') AS iso,
           CASE sourceId WHEN '{OSLO}' THEN 'oslo' ELSE 'tromso' END AS slug,
           CASE sourceId WHEN '{OSLO}' THEN 'Oslo' ELSE 'Tromsø' END AS label,
           {r('num', 1)} AS value
    FROM obs"""))
def _(spark, sf):
    obs = observations(spark, sf)
    time, city = F.col("referenceTime"), F.when(
        F.col("sourceId") == OSLO, "OSLO").otherwise("TROMSØ")
    return obs.select(
        "sourceId", F.to_date(fn.date_part_text(fn.iso_format(time))).alias("day"),
        "timeOffset", "elementId",
        fn.offset_hours_strict(F.col("timeOffset")).alias("hours"),
        fn.year_month(time).alias("year_month"), fn.month_abbr(time).alias("month_abbr"),
        fn.month_name(time).alias("month_name"), fn.month_label(time).alias("month_label"),
        fn.iso_format(fn.to_utc_timestamp(fn.iso_format(time))).alias("iso"),
        fn.city_slug(city).alias("slug"), fn.city_label(city).alias("label"),
        fn.round_n(fn.to_number(F.col("value")), 1).alias("value"),
    )


# --- reshaping ------------------------------------------------------------------

_RANGE_SQL = f"""
rng AS (
  SELECT sourceId, d, ts, timeOffset,
         MAX(CASE WHEN elementId = '{MAX_TEMPERATURE}' THEN num END)
         - MAX(CASE WHEN elementId = '{MIN_TEMPERATURE}' THEN num END) AS v
  FROM obs
  WHERE elementId IN ('{MAX_TEMPERATURE}', '{MIN_TEMPERATURE}') AND num IS NOT NULL
  GROUP BY ALL)"""


def clean(obs):
    """Observations as a delimited scan gives them: null tokens removed."""
    return obs.withColumn("value", fn.null_tokens_to_null(F.col("value")))


@check("daily_range", with_tables(OBSERVATIONS_SQL, _RANGE_SQL, f"""
    SELECT sourceId, d AS day, timeOffset, 'range(air_temperature P1D)' AS elementId,
           {r('v', 1)} AS value, 'degC' AS unit FROM rng"""))
def _(spark, sf):
    out = reshape.daily_range(clean(observations(spark, sf)))
    return out.select("sourceId", F.to_date("referenceTime").alias("day"), "timeOffset",
                      "elementId", "value", "unit")


@check("add_daily_range", with_tables(OBSERVATIONS_SQL, _RANGE_SQL, f"""
    SELECT sourceId, d AS day, timeOffset, 'range(air_temperature P1D)' AS elementId,
           {r('v', 1)} AS value, 'degC' AS unit FROM rng
    UNION ALL
    SELECT sourceId, d, timeOffset, elementId, {r('num')}, unit FROM obs"""))
def _(spark, sf):
    out = reshape.add_daily_range(clean(observations(spark, sf)))
    return out.select("sourceId", F.to_date("referenceTime").alias("day"), "timeOffset",
                      "elementId", fn.number_column(out).alias("value"), "unit")


def _pivot_sql(columns: dict[str, str], tail: str = "") -> str:
    cells = ", ".join(
        f"""MAX(CASE WHEN elementId = '{e}' THEN {r('num')} END) AS "{n}" """
        for e, n in columns.items())
    return f"SELECT sourceId, d AS day, timeOffset, {cells} FROM obs GROUP BY ALL {tail}"


@check("pivot_elements", with_tables(
    OBSERVATIONS_SQL, _pivot_sql({e: e for e in OBSERVED_ELEMENTS})))
def _(spark, sf):
    wide = reshape.pivot_elements(
        observations(spark, sf), OBSERVED_ELEMENTS,
        ("sourceId", "referenceTime", "timeOffset"))
    return wide.withColumn("day", F.to_date("referenceTime")).drop("referenceTime")


@check("melt_elements", with_tables(
    OBSERVATIONS_SQL,
    "wide AS (SELECT DISTINCT sourceId, d, timeOffset FROM obs)",
    "el AS (SELECT DISTINCT elementId FROM obs)", f"""
    SELECT w.sourceId, w.d AS day, w.timeOffset, e.elementId, {r('o.num')} AS value
    FROM wide w CROSS JOIN el e
    LEFT JOIN obs o USING (sourceId, d, timeOffset, elementId)"""))
def _(spark, sf):
    keys = ("sourceId", "referenceTime", "timeOffset")
    wide = reshape.pivot_elements(observations(spark, sf), OBSERVED_ELEMENTS, keys)
    return plain(reshape.melt_elements(wide, OBSERVED_ELEMENTS, keys))


@check("feature_pivot", with_tables(OBSERVATIONS_SQL, f"""
    SELECT * FROM (
      SELECT sourceId, d AS "date",
             {r(f"AVG(CASE WHEN elementId = '{MAX_TEMPERATURE}' THEN num END)")} AS "TMAX",
             {r(f"AVG(CASE WHEN elementId = '{MIN_TEMPERATURE}' THEN num END)")} AS "TMIN",
             {r(f"AVG(CASE WHEN elementId = '{PRECIPITATION}' THEN num END)")} AS "PRCP"
      FROM obs GROUP BY ALL)
    WHERE "TMAX" IS NOT NULL AND "TMIN" IS NOT NULL AND "PRCP" IS NOT NULL"""))
def _(spark, sf):
    return reshape.feature_pivot(observations(spark, sf), {
        MAX_TEMPERATURE: "TMAX", MIN_TEMPERATURE: "TMIN", PRECIPITATION: "PRCP"})


# --- sets, sorting, limits --------------------------------------------------------

@check("union_sorted_columns", with_tables(OBSERVATIONS_SQL, f"""
    SELECT sourceId, d AS day, timeOffset, elementId, {r('num')} AS value FROM obs
    WHERE sourceId = '{OSLO}' AND elementId = '{WIND}'
    UNION ALL
    SELECT sourceId, d, timeOffset, elementId, {r('num')} FROM obs
    WHERE sourceId = '{TROMSO}' AND elementId = '{WIND}'
    ORDER BY day, timeOffset, sourceId"""))
def _(spark, sf):
    obs = observations(spark, sf)
    both = select.filter_series(obs, WIND, source_id=OSLO).unionByName(
        select.filter_series(obs, WIND, source_id=TROMSO))
    return plain(both).orderBy("day", "timeOffset", "sourceId")


@check("head_rows", with_tables(NETWORK_SQL, f"""
    SELECT sourceId, CAST(ts AS DATE) AS day, timeOffset, elementId, {r('num')} AS value
    FROM net ORDER BY num DESC NULLS LAST, sourceId, ts, timeOffset, elementId LIMIT 5"""))
def _(spark, sf):
    rows = plain(network(spark, sf))
    return select.head_rows(
        rows, [F.desc_nulls_last("value"), "sourceId", "day", "timeOffset", "elementId"])


@check("distinct_values", with_tables(
    NETWORK_SQL, "SELECT DISTINCT sourceId FROM net ORDER BY sourceId"))
def _(spark, sf):
    return select.distinct_values(network(spark, sf), "sourceId")


@check("mixed_direction_sort", with_tables(NETWORK_SQL, """
    SELECT elementId, sourceId, COUNT(*) AS n FROM net GROUP BY ALL
    ORDER BY elementId, n DESC"""))
def _(spark, sf):
    return network(spark, sf).groupBy("elementId", "sourceId").agg(
        F.count(F.lit(1)).alias("n")).orderBy("elementId", F.desc("n"))
