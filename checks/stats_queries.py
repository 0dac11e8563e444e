"""Monthly, yearly, climatological statistics, changes and extremes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, r, with_tables
from checks.tables import (
    EVENTS_SQL,
    NETWORK_SQL,
    OBSERVATIONS_SQL,
    OSLO,
    TROMSO,
    event_observations,
    network,
    observations,
    read,
)
from stationloom.operators import change, extremes, reshape, select, stats
from stationloom.schema import (
    MAX_TEMPERATURE,
    MIN_TEMPERATURE,
    PRECIPITATION,
    RANGE_TEMPERATURE,
    WIND,
)

KEYS = "sourceId, elementId, timeOffset"


@check("count_by_source", """
    SELECT 'SN' || CAST(l_suppkey AS VARCHAR) AS sourceId, COUNT(*) AS num_entries
    FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    return stats.count_by_source(network(spark, sf))


@check("min_time_offset", f"""
    SELECT sourceId, elementId, MIN_BY(o, h) AS timeOffset, COUNT(*) AS "rows"
    FROM (SELECT 'SN' || CAST(l_suppkey AS VARCHAR) AS sourceId,
                 CASE l_returnflag WHEN 'A' THEN 'mean(air_temperature P1D)'
                      WHEN 'R' THEN '{PRECIPITATION}' ELSE '{WIND}' END AS elementId,
                 'PT' || CAST(l_linenumber * 4 AS VARCHAR) || 'H' AS o,
                 l_linenumber * 4 AS h FROM lineitem)
    GROUP BY ALL""")
def _(spark, sf):
    offset = F.concat(
        F.lit("PT"), (F.col("l_linenumber") * 4).cast("string"), F.lit("H"))
    flag = F.col("l_returnflag")
    rows = read(spark, sf, "lineitem").select(
        F.concat(F.lit("SN"), F.col("l_suppkey").cast("string")).alias("sourceId"),
        F.when(flag == "A", "mean(air_temperature P1D)").when(flag == "R", PRECIPITATION)
        .otherwise(WIND).alias("elementId"),
        offset.alias("timeOffset"),
    )
    return select.min_time_offset(rows)


@check("month_stats", with_tables(NETWORK_SQL, f"""
    SELECT {KEYS}, {r('AVG(num)')} AS mean, {r('MEDIAN(num)')} AS median,
           {r('STDDEV_POP(num)')} AS std
    FROM net_mo WHERE num IS NOT NULL AND strftime(ts, '%Y-%m') = '1997-06' GROUP BY ALL"""))
def _(spark, sf):
    return stats.month_stats(network(spark, sf), "1997-06")


def _monthly_sql(tables, source, digits=6):
    return with_tables(tables, f"""
        SELECT {KEYS}, strftime(ts, '%Y-%m') AS year_month, {r('AVG(num)')} AS mean,
               {r('MEDIAN(num)')} AS median, {r('STDDEV_SAMP(num)')} AS std
        FROM {source} WHERE num IS NOT NULL GROUP BY ALL""")


@check("monthly_stats", _monthly_sql(OBSERVATIONS_SQL, "mo"))
def _(spark, sf):
    return stats.monthly_stats(observations(spark, sf))


@check("monthly_stats_network", _monthly_sql(NETWORK_SQL, "net_mo"))
def _(spark, sf):
    return stats.monthly_stats(network(spark, sf))


@check("monthly_stats_hot_groups", _monthly_sql(NETWORK_SQL, "net_mo"))
def _(spark, sf):
    return stats.monthly_stats(network(spark, sf))


def _range_sql(where="TRUE"):
    return with_tables(OBSERVATIONS_SQL, f"""
    rng AS (
      SELECT sourceId, ts, timeOffset, '{RANGE_TEMPERATURE}' AS elementId,
             ROUND(MAX(CASE WHEN elementId = '{MAX_TEMPERATURE}' THEN num END)
             - MAX(CASE WHEN elementId = '{MIN_TEMPERATURE}' THEN num END), 1) AS num
      FROM obs WHERE elementId IN ('{MAX_TEMPERATURE}', '{MIN_TEMPERATURE}') AND num IS NOT NULL
      GROUP BY sourceId, ts, timeOffset)""", f"""
    SELECT * FROM (
      SELECT {KEYS}, strftime(ts, '%Y-%m') AS year_month, {r('AVG(num)')} AS mean,
             {r('MEDIAN(num)')} AS median, {r('STDDEV_SAMP(num)')} AS std,
             CAST(YEAR(ts) AS INTEGER) AS "year", strftime(ts, '%B') AS "month",
             {r('AVG(num)')} AS temp_diff
      FROM rng WHERE timeOffset = 'PT0H' GROUP BY ALL)
    WHERE {where}""")


@check("monthly_range_series", _range_sql())
def _(spark, sf):
    return stats.monthly_range_series(reshape.daily_range(
        select.drop_invalid_values(observations(spark, sf))))


@check("filter_year_range_month", _range_sql(
    "\"year\" BETWEEN 1996 AND 1999 AND \"month\" = 'January'"))
def _(spark, sf):
    series = stats.monthly_range_series(reshape.daily_range(
        select.drop_invalid_values(observations(spark, sf))))
    return select.filter_year_range_month(series, 1996, 1999, "January")


def _yearly_sql(function):
    return with_tables(NETWORK_SQL, f"""
        SELECT {KEYS}, CAST(YEAR(ts) AS INTEGER) AS "year", {r(f'{function}(num)')} AS value
        FROM net_mo WHERE num IS NOT NULL GROUP BY ALL""")


@check("yearly_mean", _yearly_sql("AVG"))
def _(spark, sf):
    return stats.yearly(network(spark, sf), "mean")


@check("yearly_sum", _yearly_sql("SUM"))
def _(spark, sf):
    return stats.yearly(network(spark, sf), "sum")


@check("yearly_median", _yearly_sql("MEDIAN"))
def _(spark, sf):
    return stats.yearly(network(spark, sf), "median")


@check("yearly_std", _yearly_sql("STDDEV_SAMP"))
def _(spark, sf):
    return stats.yearly(network(spark, sf), "std")


@check("orders_yearly_median", f"""
    SELECT o_orderpriority AS sourceId, 'price' AS elementId, 'PT0H' AS timeOffset,
           CAST(YEAR(o_orderdate) AS INTEGER) AS "year", {r('MEDIAN(o_totalprice)')} AS value
    FROM orders GROUP BY ALL""")
def _(spark, sf):
    rows = read(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("sourceId"), F.lit("price").alias("elementId"),
        F.lit("PT0H").alias("timeOffset"),
        F.col("o_orderdate").cast("timestamp").alias("referenceTime"),
        F.col("o_totalprice").alias("value"))
    return stats.yearly(rows, "median")


@check("annual_by_city", with_tables(OBSERVATIONS_SQL, f"""
    SELECT CAST(YEAR(ts) AS INTEGER) AS "year", {r('SUM(num)')} AS value,
           CASE sourceId WHEN '{OSLO}' THEN 'Oslo' ELSE 'Tromsø' END AS city
    FROM mo WHERE elementId = '{PRECIPITATION}' AND num IS NOT NULL GROUP BY ALL"""))
def _(spark, sf):
    return stats.annual_by_city(
        observations(spark, sf), PRECIPITATION, {OSLO: "Oslo", TROMSO: "Tromsø"})


def _climatology_sql(function, tables=NETWORK_SQL, source="net_mo"):
    return with_tables(tables, f"""
        SELECT {KEYS}, CAST(MONTH(ts) AS INTEGER) AS "month",
               strftime(make_date(2000, MONTH(ts), 1), '%b') AS month_name,
               {r(f'{function}(num)')} AS value
        FROM {source} GROUP BY ALL""")


@check("climatology", _climatology_sql("AVG"))
def _(spark, sf):
    return stats.climatology(network(spark, sf), "mean")


@check("climatology_median", _climatology_sql("MEDIAN"))
def _(spark, sf):
    return stats.climatology(network(spark, sf), "median")


@check("climatology_std", _climatology_sql("STDDEV_POP"))
def _(spark, sf):
    return stats.climatology(network(spark, sf), "std")


_CLEAN_SQL = """
lim AS (
  SELECT sourceId, elementId, timeOffset, quantile_cont(num, 0.25) AS q1,
         quantile_cont(num, 0.75) AS q3
  FROM {source} GROUP BY ALL),
cleaned AS (
  SELECT m.sourceId, m.elementId, m.timeOffset, m.ts,
         CASE WHEN num < q1 - 3.0 * (q3 - q1) OR num > q3 + 3.0 * (q3 - q1)
              THEN NULL ELSE num END AS num
  FROM {source} m JOIN lim USING (sourceId, elementId, timeOffset))"""


@check("climatology_clean", _climatology_sql(
    "AVG", OBSERVATIONS_SQL + "," + _CLEAN_SQL.format(source="mo"), "cleaned"))
def _(spark, sf):
    return stats.climatology(observations(spark, sf), "mean", remove_outliers=True)


@check("day_in_history", with_tables(NETWORK_SQL, f"""
    SELECT {KEYS}, {r('AVG(num)')} AS mean FROM net
    WHERE elementId = '{WIND}' AND timeOffset = 'PT0H' AND MONTH(ts) = 5 AND DAY(ts) = 17
    GROUP BY ALL"""))
def _(spark, sf):
    return stats.day_in_history(network(spark, sf), 5, 17, WIND, "PT0H")


def _period_sql(function, label, tables=NETWORK_SQL, source="net_mo"):
    return with_tables(tables, f"""
        SELECT {KEYS}, {label} AS period, {r(f'{function}(num)')} AS value
        FROM {source} GROUP BY ALL""")


_MONTH_END = "LAST_DAY(CAST(ts AS DATE))"
_YEAR_END = "make_date(YEAR(ts), 12, 31)"


@check("period_stat_month", _period_sql("AVG", _MONTH_END))
def _(spark, sf):
    return change.period_stat(network(spark, sf), "mean", "ME")


@check("period_stat_year", _period_sql("STDDEV_POP", _YEAR_END))
def _(spark, sf):
    return change.period_stat(network(spark, sf), "std", "YE")


@check("period_stat_day", _period_sql("MEDIAN", "CAST(ts AS DATE)", EVENTS_SQL, "ev"))
def _(spark, sf):
    return change.period_stat(event_observations(spark, sf), "median", "D")


def _change_sql(function, label, tables, source, where="TRUE"):
    return with_tables(tables, f"""
        per AS (
          SELECT {KEYS}, {label} AS period, {function}(num) AS value
          FROM {source} WHERE {where} GROUP BY ALL HAVING COUNT(num) > 0)""", f"""
        lagged AS (
          SELECT *, LAG(value) OVER (PARTITION BY {KEYS} ORDER BY period) AS base
          FROM per)""", f"""
        SELECT {KEYS}, period, {r('value')} AS value,
               {r('''CASE WHEN base <> 0 THEN (value / base - 1) * 100
                          WHEN value > 0 THEN CAST('Infinity' AS DOUBLE)
                          ELSE CAST('-Infinity' AS DOUBLE) END''')} AS percent_change
        FROM lagged WHERE base IS NOT NULL AND NOT (base = 0 AND value = 0)""")


@check("percent_change_month", _change_sql("AVG", _MONTH_END, OBSERVATIONS_SQL, "mo"))
def _(spark, sf):
    return change.percent_change(observations(spark, sf), "mean", "ME")


@check("percent_change_year", _change_sql(
    "MEDIAN", _YEAR_END, NETWORK_SQL, "net_mo",
    "ts >= TIMESTAMP '1996-01-01' AND ts <= TIMESTAMP '2000-01-01'"))
def _(spark, sf):
    return change.percent_change(
        network(spark, sf), "median", "YE", start="1996-01", end="2000-01")


@check("percent_change_day", _change_sql(
    "AVG", "CAST(ts AS DATE)", OBSERVATIONS_SQL, "mo", f"elementId = '{PRECIPITATION}'"))
def _(spark, sf):
    return change.percent_change(
        observations(spark, sf), "mean", "D", element_id=PRECIPITATION)


@check("percent_change_events", _change_sql("AVG", "CAST(ts AS DATE)", EVENTS_SQL, "ev"))
def _(spark, sf):
    return change.percent_change(event_observations(spark, sf), "mean", "D")


def _extreme_table(order, source="mo"):
    return f"""
        ext AS (
          SELECT *, ROW_NUMBER() OVER (
                   PARTITION BY {KEYS}, YEAR(ts) ORDER BY num {order}, ts) AS rn
          FROM {source} WHERE num IS NOT NULL)"""


def _rows_sql(order, body, tables=OBSERVATIONS_SQL, source="mo"):
    return with_tables(tables, _extreme_table(order, source), body)


@check("annual_extreme_rows", _rows_sql("DESC", f"""
    SELECT {KEYS}, CAST(YEAR(ts) AS INTEGER) AS "year", CAST(ts AS DATE) AS day,
           {r('num')} AS value, unit FROM ext WHERE rn = 1"""))
def _(spark, sf):
    rows = extremes.annual_extreme_rows(observations(spark, sf), "max")
    return rows.withColumn("day", F.to_date("referenceTime")).drop("referenceTime")


@check("annual_minimum_rows_network", _rows_sql("ASC", f"""
    SELECT DISTINCT {KEYS}, CAST(YEAR(ts) AS INTEGER) AS "year", CAST(ts AS DATE) AS day,
           {r('num')} AS value FROM ext WHERE rn = 1""", NETWORK_SQL, "net_mo"))
def _(spark, sf):
    rows = extremes.annual_extreme_rows(network(spark, sf), "min")
    return rows.withColumn("day", F.to_date("referenceTime")).drop("referenceTime", "unit")


def _annual_sql(function):
    return with_tables(NETWORK_SQL, f"""
        ann AS (SELECT {KEYS}, YEAR(ts) AS y, {function}(num) AS value
                FROM net_mo WHERE num IS NOT NULL GROUP BY ALL)""", f"""
        span AS (SELECT {KEYS}, UNNEST(generate_series(MIN(y), MAX(y))) AS y
                 FROM ann GROUP BY {KEYS})""", f"""
        SELECT {KEYS}, make_date(y, 12, 31) AS period, {r('value')} AS value
        FROM span LEFT JOIN ann USING ({KEYS}, y)""")


@check("annual_max", _annual_sql("MAX"))
def _(spark, sf):
    return extremes.annual_extreme(network(spark, sf), "max")


@check("annual_min", _annual_sql("MIN"))
def _(spark, sf):
    return extremes.annual_extreme(network(spark, sf), "min")


_FREQUENCY_TABLE = f"""
        freq AS (
          SELECT s.*, m.m AS mon, COUNT(e.ts) AS years
          FROM (SELECT DISTINCT {KEYS} FROM ext) s
          CROSS JOIN (SELECT UNNEST(generate_series(1, 12)) AS m) m
          LEFT JOIN (SELECT * FROM ext WHERE rn = 1) e
            ON e.sourceId = s.sourceId AND e.elementId = s.elementId
           AND e.timeOffset = s.timeOffset AND MONTH(e.ts) = m.m
          GROUP BY ALL)"""


@check("extreme_month_frequency", with_tables(
    OBSERVATIONS_SQL, _extreme_table("DESC"), _FREQUENCY_TABLE, f"""
    SELECT {KEYS}, CAST(mon AS INTEGER) AS "month", years FROM freq"""))
def _(spark, sf):
    return extremes.extreme_month_frequency(
        extremes.annual_extreme_rows(observations(spark, sf), "max"))


@check("modal_extreme_month", with_tables(
    OBSERVATIONS_SQL, _extreme_table("ASC"), _FREQUENCY_TABLE, f"""
    SELECT {KEYS}, CAST(mon AS INTEGER) AS "month", years
    FROM (SELECT *, ROW_NUMBER() OVER (
            PARTITION BY {KEYS} ORDER BY years DESC, mon) AS k FROM freq)
    WHERE k = 1"""))
def _(spark, sf):
    return extremes.modal_extreme_month(
        extremes.annual_extreme_rows(observations(spark, sf), "min"))


@check("trend_endpoints", with_tables(NETWORK_SQL, f"""
    ann AS (SELECT {KEYS}, make_date(YEAR(ts), 12, 31) AS period, MAX(num) AS value
            FROM net_mo WHERE num IS NOT NULL GROUP BY ALL)""", f"""
    SELECT {KEYS}, MIN(period) AS first_period, {r('MIN_BY(value, period)')} AS first_value,
           MAX(period) AS last_period, {r('MAX_BY(value, period)')} AS last_value
    FROM ann GROUP BY ALL"""))
def _(spark, sf):
    return extremes.trend_endpoints(network(spark, sf), "max")


@check("robust_trend", with_tables(NETWORK_SQL, f"""
    ann AS (SELECT {KEYS}, YEAR(ts) AS y, MAX(num) AS v
            FROM net_mo WHERE num IS NOT NULL GROUP BY ALL)""", f"""
    steps AS (SELECT {KEYS}, SUM(SIGN(b.v - a.v)) AS s, MEDIAN((b.v - a.v) / (b.y - a.y)) AS slope
              FROM ann a JOIN ann b USING ({KEYS}) WHERE b.y > a.y GROUP BY ALL)""", f"""
    tied AS (SELECT {KEYS}, SUM(t) AS n, SUM(t * (t - 1) * (2 * t + 5)) AS ties
             FROM (SELECT {KEYS}, v, COUNT(*) AS t FROM ann GROUP BY ALL) GROUP BY ALL)""", f"""
    line AS (SELECT {KEYS}, MEDIAN(v - slope * y) AS intercept FROM ann JOIN steps USING ({KEYS}) GROUP BY ALL)""", f"""
    zs AS (SELECT {KEYS}, n, COALESCE(s, 0) AS s, slope, intercept, CASE WHEN n * (n - 1) * (2 * n + 5) > ties
             THEN (COALESCE(s, 0) - SIGN(COALESCE(s, 0))) / SQRT((n * (n - 1) * (2 * n + 5) - ties) / 18) ELSE 0 END AS z
           FROM tied LEFT JOIN steps USING ({KEYS}) LEFT JOIN line USING ({KEYS}))""", f"""
    ts5 AS (SELECT *, ABS(z) / SQRT(2.0) AS x, 1 / (1 + 0.3275911 * ABS(z) / SQRT(2.0)) AS t FROM zs)""", f"""
    SELECT {KEYS}, CAST(n AS INTEGER) AS years, CAST(s AS BIGINT) AS s, {r('z')} AS z,
           {r("CASE WHEN z = 0 THEN 1 ELSE ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t"
              " + 0.254829592) * t * EXP(-x * x) END")} AS p_value,
           {r('slope')} AS slope, {r('intercept')} AS intercept
    FROM ts5"""))
def _(spark, sf):
    return extremes.robust_trend(network(spark, sf), "max")
