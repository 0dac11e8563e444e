"""Gap filling and decomposition."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, half_up, r, with_tables
from checks.tables import OBSERVATIONS_SQL, STATION_SERIES_SQL, observations, station_series
from stationloom.functions import round_n
from stationloom.operators import decompose, timeseries
from stationloom.plans import decomposition

GRID_SQL = """
inst AS (
  SELECT *, ts + to_hours(CAST(regexp_extract(timeOffset, 'PT([0-9]+)H', 1) AS INTEGER)) AS moment
  FROM obs),
grid AS (
  SELECT i.sourceId, i.moment, e.elementId, o.num, o.timeOffset AS observed_offset
  FROM (SELECT DISTINCT sourceId, moment FROM inst) i
  JOIN (SELECT DISTINCT sourceId, elementId FROM inst) e USING (sourceId)
  LEFT JOIN inst o ON o.sourceId = i.sourceId AND o.moment = i.moment AND o.elementId = e.elementId),
near AS (
  SELECT *, epoch(moment) AS x, ROW_NUMBER() OVER w AS rn,
         LAST_VALUE(CASE WHEN num IS NOT NULL THEN epoch(moment) END IGNORE NULLS) OVER p AS x0,
         LAST_VALUE(num IGNORE NULLS) OVER p AS y0,
         FIRST_VALUE(CASE WHEN num IS NOT NULL THEN epoch(moment) END IGNORE NULLS) OVER f AS x1,
         FIRST_VALUE(num IGNORE NULLS) OVER f AS y1
  FROM grid
  WINDOW w AS (PARTITION BY sourceId, elementId ORDER BY moment),
         p AS (PARTITION BY sourceId, elementId ORDER BY moment
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY sourceId, elementId ORDER BY moment
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
gaps AS (
  SELECT *, rn - MAX(CASE WHEN num IS NOT NULL THEN rn END) OVER (
              PARTITION BY sourceId, elementId ORDER BY moment) AS into_gap,
         CASE WHEN num IS NOT NULL THEN num WHEN x1 IS NULL THEN y0 WHEN x0 IS NULL THEN y1
              ELSE y0 + (y1 - y0) * (x - x0) / (x1 - x0) END AS filled
  FROM near)"""

_KEYS = "sourceId, elementId"
_COLUMNS = "sourceId, elementId, moment"


def grid(spark, sf):
    return timeseries.observation_grid(observations(spark, sf))


def gridded(spark, sf):
    return grid(spark, sf), {"time": "instant"}


def shown(df):
    return df.select(
        "sourceId", "elementId", F.col("instant").cast("timestamp_ntz").alias("moment"), "value")


@check("observation_grid", with_tables(OBSERVATIONS_SQL, GRID_SQL, f"""
    SELECT {_COLUMNS}, {r('num')} AS value, observed_offset FROM grid"""))
def _(spark, sf):
    rows = grid(spark, sf)
    return rows.select(
        "sourceId", "elementId", F.col("instant").cast("timestamp_ntz").alias("moment"),
        "value", "observed_offset")


@check("interpolate_time_limited", with_tables(OBSERVATIONS_SQL, GRID_SQL, f"""
    SELECT {_COLUMNS}, {r('''CASE WHEN num IS NOT NULL THEN num
        WHEN x0 IS NOT NULL AND into_gap <= 3 THEN filled END''')} AS value FROM gaps"""))
def _(spark, sf):
    cells, options = gridded(spark, sf)
    return shown(timeseries.interpolate_time_limited(cells, 3, **options))


_FILLED_SQL = with_tables(
    OBSERVATIONS_SQL, GRID_SQL, f"SELECT {_COLUMNS}, {r('filled')} AS value FROM gaps")


@check("interpolate_time", _FILLED_SQL)
def _(spark, sf):
    cells, options = gridded(spark, sf)
    return shown(timeseries.interpolate_time(cells, **options))


@check("fill_forward_backward", with_tables(OBSERVATIONS_SQL, GRID_SQL, f"""
    SELECT {_COLUMNS}, {r('COALESCE(y0, y1)')} AS value FROM gaps"""))
def _(spark, sf):
    cells, options = gridded(spark, sf)
    return shown(timeseries.fill_forward_backward(cells, **options))


@check("impute", _FILLED_SQL)
def _(spark, sf):
    cells, options = gridded(spark, sf)
    return shown(timeseries.impute(cells, **options))


@check("impute_observations", with_tables(OBSERVATIONS_SQL, GRID_SQL, f"""
    SELECT sourceId, moment, 'PT' || CAST(HOUR(moment) AS VARCHAR) || 'H' AS timeOffset, elementId,
           {half_up('filled', 3)} AS value,
           CASE WHEN elementId LIKE '%temperature%' THEN 'degC'
                WHEN elementId LIKE '%wind_speed%' THEN 'm/s' ELSE 'mm' END AS unit,
           num IS NULL AND filled IS NOT NULL AS is_imputed
    FROM gaps"""))
def _(spark, sf):
    rows = timeseries.impute_observations(observations(spark, sf))
    return rows.withColumn(
        "moment", F.col("referenceTime").cast("timestamp_ntz")).drop("referenceTime")


def decompose_sql(period: int, multiplicative: bool = False, then: list[str] | None = None,
                  tables: tuple[str, ...] = (OBSERVATIONS_SQL, GRID_SQL)) -> str:
    half = period // 2
    x = "filled + 100" if multiplicative else "filled"
    if period % 2:
        total = f"SUM({x}) OVER (k ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    else:
        total = (f"SUM({x}) OVER (k ROWS BETWEEN {half - 1} PRECEDING AND {half - 1} FOLLOWING)"
                 f" + (LAG({x}, {half}) OVER k + LEAD({x}, {half}) OVER k) / 2")
    key = "sourceId, elementId"
    dev = "v / tr" if multiplicative else "v - tr"
    centre = "m / AVG(m) OVER (PARTITION BY sourceId, elementId)" if multiplicative else \
        "m - AVG(m) OVER (PARTITION BY sourceId, elementId)"
    resid = "dev / seasonal" if multiplicative else "dev - seasonal"
    return with_tables(*tables, f"""
    avgs AS (
      SELECT {key}, moment, num, {x} AS v, rn - 1 AS pos,
             COUNT(*) OVER (PARTITION BY {key}) AS n,
             ({total}) / {period} AS ma
      FROM gaps WINDOW k AS (PARTITION BY {key} ORDER BY moment))""", f"""
    trends AS (
      SELECT *, CASE WHEN pos >= {half} AND pos < n - {half} THEN ma END AS t FROM avgs)""", f"""
    lines AS (
      SELECT {key},
             regr_slope(t, pos) FILTER (pos < {half} + {period}) AS fs,
             regr_intercept(t, pos) FILTER (pos < {half} + {period}) AS fi,
             regr_slope(t, pos) FILTER (pos >= n - 1 - {half} - {period} AND pos < n - 1 - {half}) AS bs,
             regr_intercept(t, pos) FILTER (pos >= n - 1 - {half} - {period} AND pos < n - 1 - {half}) AS bi
      FROM trends GROUP BY ALL)""", f"""
    full_trend AS (
      SELECT tr0.*, CASE WHEN t IS NOT NULL THEN t WHEN pos < {half} THEN fs * pos + fi
                         ELSE bs * pos + bi END AS tr
      FROM trends tr0 JOIN lines USING ({key}))""", f"""
    devs AS (SELECT *, pos % {period} AS phase, {dev} AS dev FROM full_trend)""", f"""
    seas AS (
      SELECT {key}, phase, {centre} AS seasonal
      FROM (SELECT {key}, phase, AVG(dev) AS m FROM devs GROUP BY ALL))""", *then or [f"""
    SELECT {key}, moment, {half_up('tr', 6)} AS trend, {half_up('seasonal', 6)} AS seasonal,
           {half_up(resid, 6)} AS resid
    FROM devs JOIN seas USING ({key}, phase)"""])


def parts(df):
    return df.select(
        "sourceId", "elementId", F.col("instant").cast("timestamp_ntz").alias("moment"),
        *[round_n(F.col(c), 6).alias(c) for c in ("trend", "seasonal", "resid")])


@check("seasonal_decompose", decompose_sql(365))
def _(spark, sf):
    return parts(decomposition.decompose_observations(observations(spark, sf)))


@check("seasonal_decompose_blocks", decompose_sql(365))
def _(spark, sf):
    filled = decomposition.filled_series(observations(spark, sf))
    return parts(decompose.seasonal_decompose(filled, time="instant", block_rows=500))


@check("seasonal_decompose_multiplicative", decompose_sql(24, True))
def _(spark, sf):
    filled = decomposition.filled_series(observations(spark, sf))
    shifted = filled.withColumn("value", F.col("value") + 100)
    return parts(decompose.seasonal_decompose(
        shifted, 24, "multiplicative", time="instant"))


@check("seasonal_recompose", _FILLED_SQL)
def _(spark, sf):
    cells, options = gridded(spark, sf)
    return shown(decompose.seasonal_impute(cells, "recomposed", **options))


@check("seasonal_impute", decompose_sql(365, then=["""
    rest AS (
      SELECT sourceId, elementId, moment, num, epoch(moment) AS x, seasonal, num - seasonal AS d
      FROM devs JOIN seas USING (sourceId, elementId, phase))""", """
    sides AS (
      SELECT *, LAST_VALUE(CASE WHEN d IS NOT NULL THEN x END IGNORE NULLS) OVER p AS x0,
             LAST_VALUE(d IGNORE NULLS) OVER p AS d0,
             FIRST_VALUE(CASE WHEN d IS NOT NULL THEN x END IGNORE NULLS) OVER f AS x1,
             FIRST_VALUE(d IGNORE NULLS) OVER f AS d1
      FROM rest
      WINDOW p AS (PARTITION BY sourceId, elementId ORDER BY moment
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             f AS (PARTITION BY sourceId, elementId ORDER BY moment
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""", f"""
    SELECT sourceId, elementId, moment, {half_up('''CASE WHEN num IS NOT NULL THEN num
        WHEN x1 IS NULL THEN d0 + seasonal WHEN x0 IS NULL THEN d1 + seasonal
        ELSE d0 + (d1 - d0) * (x - x0) / (x1 - x0) + seasonal END''', 6)} AS value
    FROM sides"""]))
def _(spark, sf):
    cells, options = gridded(spark, sf)
    filled = decompose.seasonal_impute(cells, **options)
    return shown(filled.withColumn("value", round_n(F.col("value"), 6)))


def _slope(ha: str, hb: str, da: str, db: str) -> str:
    return (f"CASE WHEN {da} * {db} <= 0 THEN 0 WHEN {da} IS NULL OR {db} IS NULL THEN d1 "
            f"ELSE 3 * ({ha} + {hb}) / ((2 * {hb} + {ha}) / {da} + ({hb} + 2 * {ha}) / {db}) END")


def spline_sql(key: str, limit: int) -> list[str]:
    """Gaps from ``devs`` and ``seas``: lines up to ``limit`` rows, else a monotone cubic over the season."""
    same = " AND ".join(f"{{0}}.{k.strip()} = p.{k.strip()}" for k in key.split(","))
    return ["""
    rest AS (
      SELECT *, epoch(moment) / 86400.0 AS x, COALESCE(seasonal, 0) AS se, num - COALESCE(seasonal, 0) AS d
      FROM devs JOIN seas USING (KEY, phase))""".replace("KEY", key), f"""
    known AS (
      SELECT {key}, pos, num, x, d, LAG(x) OVER w AS xb, LAG(d) OVER w AS db, LEAD(x) OVER w AS xf, LEAD(d) OVER w AS df
      FROM rest WHERE d IS NOT NULL WINDOW w AS (PARTITION BY {key} ORDER BY pos))""", f"""
    placed AS (
      SELECT *, MAX(CASE WHEN d IS NOT NULL THEN pos END) OVER (PARTITION BY {key} ORDER BY pos) AS bp,
             MIN(CASE WHEN d IS NOT NULL THEN pos END) OVER (PARTITION BY {key} ORDER BY pos
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ap
      FROM rest)""", f"""
    sides AS (
      SELECT p.*, b.x AS x1, b.d AS r1, b.num AS n1, a.x AS x2, a.d AS r2, a.num AS n2,
             b.x - b.xb AS h0, a.x - b.x AS h1, a.xf - a.x AS h2,
             (b.d - b.db) / (b.x - b.xb) AS d0, (a.d - b.d) / NULLIF(a.x - b.x, 0) AS d1, (a.df - a.d) / (a.xf - a.x) AS d2
      FROM placed p LEFT JOIN known b ON {same.format('b')} AND b.pos = p.bp
      LEFT JOIN known a ON {same.format('a')} AND a.pos = p.ap)""", f"""
    slopes AS (
      SELECT *, (x - x1) / NULLIF(h1, 0) AS u, {_slope('h0', 'h1', 'd0', 'd1')} AS m1, {_slope('h1', 'h2', 'd1', 'd2')} AS m2
      FROM sides)""", f"""
    splined AS (
      SELECT *, CASE WHEN num IS NOT NULL THEN num WHEN x1 IS NULL THEN r2 + se WHEN x2 IS NULL THEN r1 + se
             WHEN ap - bp - 1 <= {limit} THEN n1 + (n2 - n1) * u
             ELSE se + r1 * (1 - 3 * u * u + 2 * u * u * u) + h1 * m1 * (u - 2 * u * u + u * u * u)
                  + r2 * (3 * u * u - 2 * u * u * u) + h1 * m2 * (u * u * u - u * u) END AS value
      FROM slopes)"""]


@check("seasonal_spline", decompose_sql(365, then=[*spline_sql(_KEYS, 0), f"""
    SELECT {_KEYS}, moment, {half_up('value', 6)} AS value FROM splined"""]))
def _(spark, sf):
    cells, options = gridded(spark, sf)
    filled = decompose.seasonal_impute(cells, "spline", **options)
    return shown(filled.withColumn("value", round_n(F.col("value"), 6)))


@check("impute_observations_spline", decompose_sql(365, then=[*spline_sql(_KEYS, 3), f"""
    SELECT sourceId, moment, 'PT' || CAST(HOUR(moment) AS VARCHAR) || 'H' AS timeOffset, elementId,
           {half_up('value', 3)} AS value,
           CASE WHEN elementId LIKE '%temperature%' THEN 'degC'
                WHEN elementId LIKE '%wind_speed%' THEN 'm/s' ELSE 'mm' END AS unit,
           num IS NULL AND value IS NOT NULL AS is_imputed
    FROM splined"""]))
def _(spark, sf):
    rows = timeseries.impute_observations(observations(spark, sf), method="seasonal_spline")
    return rows.withColumn(
        "moment", F.col("referenceTime").cast("timestamp_ntz")).drop("referenceTime")


def stationed(df):
    return df.select(
        "sourceId", "elementId", F.col("referenceTime").cast("timestamp_ntz").alias("moment"), "value")


@check("series_interpolated_limited", with_tables(STATION_SERIES_SQL, f"""
    SELECT sourceId, elementId, ts AS moment, {r('''CASE WHEN num IS NOT NULL THEN num
        WHEN x0 IS NOT NULL AND into_gap <= 3 THEN filled END''')} AS value FROM gaps"""))
def _(spark, sf):
    return stationed(timeseries.interpolate_time_limited(station_series(spark, sf), 3))


@check("series_interpolated", with_tables(STATION_SERIES_SQL, f"""
    SELECT sourceId, elementId, ts AS moment, {r('filled')} AS value FROM gaps"""))
def _(spark, sf):
    return stationed(timeseries.interpolate_time(station_series(spark, sf)))


_STATIONS_AS_GRID = f"{STATION_SERIES_SQL}".replace("gaps AS (", "gaps0 AS (") + """,
gaps AS (SELECT *, ts AS moment FROM gaps0)"""


@check("series_spline", decompose_sql(48, tables=(_STATIONS_AS_GRID,), then=[*spline_sql(_KEYS, 3), f"""
    SELECT {_COLUMNS}, {half_up('value', 6)} AS value FROM splined"""]))
def _(spark, sf):
    filled = timeseries.impute(station_series(spark, sf), method="seasonal_spline", period=48)
    return stationed(filled.withColumn("value", round_n(F.col("value"), 6)))


@check("series_filled", with_tables(STATION_SERIES_SQL, f"""
    SELECT sourceId, elementId, ts AS moment, {r('COALESCE(y0, y1)')} AS value FROM gaps"""))
def _(spark, sf):
    return stationed(timeseries.fill_forward_backward(station_series(spark, sf)))
