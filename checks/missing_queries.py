"""Missing values between two stations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ORACLES, check, r, with_tables
from checks.tables import NETWORK_SQL, OBSERVATIONS_SQL, OSLO, TROMSO, network, observations, read
from stationloom.operators import missing, runs, select, timeseries
from stationloom.plans.comparison import impute_and_compare
from stationloom.plans.shared import shared_folder
from stationloom.schema import OBSERVATION_COLUMNS, OBSERVED_ELEMENTS, PRECIPITATION
from stationloom.sources import sinks

CITIES = ("Oslo", "Tromsø")
PAIR = (OSLO, TROMSO, *CITIES)

COMPARE_SQL = f"""
lefts AS (SELECT * FROM obs WHERE sourceId = '{OSLO}'),
rights AS (SELECT * FROM obs WHERE sourceId = '{TROMSO}'),
cmp AS (
  SELECT a.d, a.timeOffset, a.elementId, a.num AS left_value, b.num AS right_value
  FROM lefts a LEFT JOIN rights b ON a.d = b.d AND a.timeOffset = b.timeOffset AND a.elementId = b.elementId
  UNION ALL
  SELECT b.d, b.timeOffset, b.elementId, NULL, b.num FROM rights b
  WHERE NOT EXISTS (
    SELECT 1 FROM lefts a WHERE a.d = b.d AND a.timeOffset = b.timeOffset AND a.elementId = b.elementId)),
mis AS (
  SELECT *, 'Oslo' AS city FROM cmp WHERE left_value IS NULL AND right_value IS NOT NULL
  UNION ALL
  SELECT *, 'Tromsø' FROM cmp WHERE right_value IS NULL AND left_value IS NOT NULL),
cls AS (
  SELECT *, CASE WHEN right_value IS NULL THEN 'Tromsø' WHEN left_value IS NULL THEN 'Oslo' END AS lacking
  FROM cmp)"""


def numeric(df):
    """The value columns as numbers, the date as a date."""
    return df.withColumns({
        "date": F.to_date("date"),
        "left_value": F.col("left_value").try_cast("double"),
        "right_value": F.col("right_value").try_cast("double"),
    })


def compared(spark, sf):
    return missing.compare_stations(observations(spark, sf), OSLO, TROMSO)


def lacking(spark, sf):
    return missing.missing_values(observations(spark, sf), *PAIR)


_ROWS = f"""d AS "date", timeOffset, elementId, {r('left_value')} AS left_value,
            {r('right_value')} AS right_value"""


@check("compare_stations", with_tables(
    OBSERVATIONS_SQL, COMPARE_SQL, f"SELECT {_ROWS} FROM cmp"))
def _(spark, sf):
    return numeric(compared(spark, sf))


@check("missing_values", with_tables(
    OBSERVATIONS_SQL, COMPARE_SQL, f"SELECT {_ROWS}, city FROM mis"))
def _(spark, sf):
    return numeric(lacking(spark, sf))


_SUMMARY_SQL = with_tables(OBSERVATIONS_SQL, COMPARE_SQL, """
    SELECT city, elementId, COUNT(*) AS num_missing FROM mis GROUP BY ALL
    ORDER BY city, num_missing DESC""")


@check("missing_summary", _SUMMARY_SQL)
def _(spark, sf):
    return missing.missing_summary(lacking(spark, sf))


@check("missing_counts", _SUMMARY_SQL)
def _(spark, sf):
    return missing.missing_counts(observations(spark, sf), *PAIR)


@check("missing_summary_classified", with_tables(OBSERVATIONS_SQL, COMPARE_SQL, """
    SELECT lacking AS city, elementId, COUNT(*) AS num_missing
    FROM cls WHERE lacking IS NOT NULL GROUP BY ALL ORDER BY city, num_missing DESC"""))
def _(spark, sf):
    return missing.missing_summary_classified(compared(spark, sf), *CITIES)


@check("missing_rows_classified", with_tables(OBSERVATIONS_SQL, COMPARE_SQL, """
    SELECT d AS "date", timeOffset, elementId, lacking AS missing
    FROM cls WHERE lacking IS NOT NULL"""))
def _(spark, sf):
    rows = missing.missing_rows_classified(compared(spark, sf), *CITIES)
    return rows.withColumn("date", F.to_date("date"))


@check("missing_counts_filtered", with_tables(OBSERVATIONS_SQL, COMPARE_SQL, f"""
    SELECT lacking AS city, elementId, COUNT(*) AS num_missing
    FROM cls WHERE lacking IN ('Oslo', 'Tromsø') AND elementId = '{PRECIPITATION}'
    GROUP BY ALL"""))
def _(spark, sf):
    return missing.missing_counts_filtered(
        compared(spark, sf), *CITIES, PRECIPITATION, list(CITIES))


_BEFORE_AFTER_SQL = with_tables(OBSERVATIONS_SQL, COMPARE_SQL, f"""
    inst AS (
      SELECT sourceId, elementId, num,
             ts + to_hours(CAST(regexp_extract(timeOffset, 'PT([0-9]+)H', 1) AS INTEGER)) AS moment
      FROM obs)""", f"""
    grid AS (
      SELECT DISTINCT i.sourceId, i.moment, e.elementId
      FROM inst i JOIN (SELECT DISTINCT sourceId, elementId FROM inst WHERE num IS NOT NULL) e
        USING (sourceId))""", f"""
    after_counts AS (
      SELECT CASE sourceId WHEN '{OSLO}' THEN 'Tromsø' ELSE 'Oslo' END AS city, COUNT(*) AS n
      FROM grid g WHERE NOT EXISTS (
        SELECT 1 FROM grid h WHERE h.sourceId <> g.sourceId AND h.elementId = g.elementId
          AND h.moment = g.moment)
      GROUP BY ALL)""", """
    SELECT c.city, COALESCE(b.n, 0) AS "before", COALESCE(a.n, 0) AS "after"
    FROM (SELECT city FROM mis UNION SELECT city FROM after_counts) c
    LEFT JOIN (SELECT city, COUNT(*) AS n FROM mis GROUP BY ALL) b USING (city)
    LEFT JOIN after_counts a USING (city)""")


@check("missing_before_after", _BEFORE_AFTER_SQL)
def _(spark, sf):
    obs = observations(spark, sf)
    imputed = timeseries.impute_observations(obs).select(*OBSERVATION_COLUMNS)
    return missing.missing_before_after(
        missing.missing_counts(obs, *PAIR), missing.missing_counts(imputed, *PAIR))


@check("impute_and_compare", _BEFORE_AFTER_SQL)
def _(spark, sf):
    return impute_and_compare(observations(spark, sf), *PAIR)


@check("missing_indicator_wide", with_tables(OBSERVATIONS_SQL, COMPARE_SQL, f"""
    SELECT d AS "date", timeOffset, {', '.join(
        f'''CASE WHEN (SELECT COUNT(*) FROM cls WHERE lacking = 'Oslo' AND elementId = '{e}') = 0
            THEN 0.0::DOUBLE
            ELSE MAX(CASE WHEN elementId = '{e}' THEN 1.0::DOUBLE END) END AS "{e}" '''
        for e in OBSERVED_ELEMENTS)}
    FROM cls WHERE lacking = 'Oslo' GROUP BY ALL"""))
def _(spark, sf):
    wide = missing.missing_indicator_wide(
        compared(spark, sf), "Oslo", *CITIES, OBSERVED_ELEMENTS)
    return wide.withColumn("date", F.to_date("date"))


@check("values_by_offset", with_tables(OBSERVATIONS_SQL, COMPARE_SQL, f"""
    SELECT d AS "date",
           {r("MAX(CASE WHEN timeOffset = 'PT6H' THEN right_value END)")} AS "PT6H",
           {r("MAX(CASE WHEN timeOffset = 'PT0H' THEN right_value END)")} AS "PT0H"
    FROM cmp WHERE elementId = '{PRECIPITATION}' GROUP BY ALL"""))
def _(spark, sf):
    one = select.filter_elements(numeric(compared(spark, sf)), [PRECIPITATION])
    return missing.values_by_offset(
        one, "right_value", ["PT0H", "PT6H"], ["PT6H", "PT0H"])


@check("values_by_element", with_tables(OBSERVATIONS_SQL, COMPARE_SQL, f"""
    SELECT d AS "date", timeOffset, {', '.join(
        f"""{r(f"MAX(CASE WHEN elementId = '{e}' THEN left_value END)")} AS "{e}" """
        for e in OBSERVED_ELEMENTS)}
    FROM cmp GROUP BY ALL ORDER BY "date", timeOffset"""))
def _(spark, sf):
    return missing.values_by_element(
        numeric(compared(spark, sf)), "left_value", OBSERVED_ELEMENTS)


@check("missing_summary_pivot", with_tables(OBSERVATIONS_SQL, COMPARE_SQL, """
    SELECT elementId, CAST(COUNT_IF(lacking = 'Oslo') AS BIGINT) AS "Oslo",
           CAST(COUNT_IF(lacking = 'Tromsø') AS BIGINT) AS "Tromsø"
    FROM cls WHERE lacking IS NOT NULL GROUP BY ALL"""))
def _(spark, sf):
    return missing.missing_summary_pivot(
        missing.missing_summary_classified(compared(spark, sf), *CITIES), CITIES)


_RUNS_SQL = """
    tagged AS (
      SELECT *, CASE WHEN LAG(d) OVER w IS NULL OR d - LAG(d) OVER w > 1 THEN 1 ELSE 0 END AS s
      FROM dates WINDOW w AS (PARTITION BY elementId ORDER BY d)),
    runs AS (SELECT *, SUM(s) OVER (PARTITION BY elementId ORDER BY d) AS run FROM tagged)
    SELECT elementId, MIN(d) AS "start", MAX(d) AS "end" FROM runs GROUP BY elementId, run"""


@check("missing_runs", "WITH " + OBSERVATIONS_SQL.strip() + "," + COMPARE_SQL + """,
    dates AS (
      SELECT DISTINCT e.elementId, c.d
      FROM (SELECT DISTINCT d, timeOffset FROM cmp) c
      CROSS JOIN (SELECT DISTINCT elementId FROM cmp) e
      LEFT JOIN cmp v ON v.d = c.d AND v.timeOffset = c.timeOffset AND v.elementId = e.elementId
      WHERE v.right_value IS NULL),""" + _RUNS_SQL)
def _(spark, sf):
    return missing.missing_runs(
        compared(spark, sf), "right_value", elements=OBSERVED_ELEMENTS)


@check("missing_runs_recorded", "WITH " + OBSERVATIONS_SQL.strip() + "," + COMPARE_SQL + """,
    dates AS (SELECT DISTINCT elementId, d FROM cmp WHERE left_value IS NULL),""" + _RUNS_SQL)
def _(spark, sf):
    return missing.missing_runs(compared(spark, sf), "left_value", "recorded")


@check("missing_runs_appended", ORACLES["missing_runs"])
def _(spark, sf):
    path = shared_folder(spark, "runs")
    table, early = compared(spark, sf), F.col("date") < "1996-03-15"
    for part in (table.where(early), table.where(~early)):
        sinks.append_run_summary(
            runs.run_summary(part, "right_value", elements=OBSERVED_ELEMENTS), path)
    return runs.runs_of_summaries(spark.read.parquet(path))


@check("missing_counts_pairs", with_tables(NETWORK_SQL, """
    pairs AS (
      SELECT 'SN' || CAST(s_suppkey AS VARCHAR) AS l, 'SN' || CAST(s_suppkey + k AS VARCHAR) AS r
      FROM supplier, (VALUES (1), (2)) steps(k)),
    sides AS (SELECT l, r, 'left' AS side, l AS lacks, r AS has FROM pairs UNION ALL SELECT l, r, 'right', r, l FROM pairs),
    cells AS (
      SELECT sourceId AS s, elementId AS e, timeOffset AS o, CAST(ts AS DATE) AS d, COUNT(*) AS n, COUNT(num) AS v
      FROM net GROUP BY ALL)""", """
    SELECT l AS left_station, r AS right_station, side, h.e AS elementId,
           CAST(SUM(h.v * CASE WHEN k.n IS NULL THEN 1 ELSE k.n - k.v END) AS BIGINT) AS num_missing
    FROM sides JOIN cells h ON h.s = has LEFT JOIN cells k ON k.s = lacks AND k.e = h.e AND k.o = h.o AND k.d = h.d
    GROUP BY ALL HAVING num_missing > 0"""))
def _(spark, sf):
    steps = read(spark, sf, "supplier").select("s_suppkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    pairs = steps.select(
        F.concat(F.lit("SN"), F.col("s_suppkey").cast("string")).alias("left_station"),
        F.concat(F.lit("SN"), (F.col("s_suppkey") + F.col("k")).cast("string")).alias("right_station"))
    return missing.missing_counts_for_pairs(network(spark, sf), pairs)


@check("nullity_correlation", with_tables(OBSERVATIONS_SQL, COMPARE_SQL, f"""
    wide AS (
      SELECT d, timeOffset, {', '.join(
          f"MAX(CASE WHEN elementId = '{e}' THEN 1 END) IS NULL AS g{i}"
          for i, e in enumerate(OBSERVED_ELEMENTS))}
      FROM cls WHERE lacking = 'Oslo' GROUP BY ALL)""",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS left_element, '{b}' AS right_element,
            {r(f'CORR(CAST(g{i} AS DOUBLE), CAST(g{j} AS DOUBLE))')} AS correlation
            FROM wide HAVING VAR_POP(CAST(g{i} AS DOUBLE)) > 0
             AND VAR_POP(CAST(g{j} AS DOUBLE)) > 0"""
        for i, a in enumerate(OBSERVED_ELEMENTS)
        for j, b in enumerate(OBSERVED_ELEMENTS) if i < j)))
def _(spark, sf):
    wide = missing.missing_indicator_wide(
        compared(spark, sf), "Oslo", *CITIES, OBSERVED_ELEMENTS)
    return missing.nullity_correlation(wide, OBSERVED_ELEMENTS)
