"""Yearly extremes, when they occur, and their end points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.operators.arrays import quantile_of
from stationloom.operators.select import (
    ALL_OFFSETS,
    drop_invalid_values,
    filter_series,
    pick_offset,
)
from stationloom.schema import ELEMENT, OFFSET, SERIES, SOURCE, TIME, VALUE


def _check_kind(kind: str) -> None:
    if kind not in ("max", "min"):
        raise ValueError("kind must be 'max' or 'min'")


def _valid(df: DataFrame, element_id, source_id, time_offset) -> DataFrame:
    chosen = filter_series(
        df, element_id, None if time_offset == ALL_OFFSETS else time_offset, source_id
    )
    return drop_invalid_values(chosen)


def annual_extreme_rows(df: DataFrame, kind: str = "max",
                        element_id: str | None = None,
                        source_id: str | None = None,
                        time_offset: str | None = None) -> DataFrame:
    """The full row holding each year's maximum or minimum, earliest on ties."""
    _check_kind(kind)
    rows = _valid(df, element_id, source_id, time_offset)
    rest = [c for c in rows.columns if c not in (*SERIES, TIME, VALUE)]
    at = F.unix_micros(TIME)
    # An ordered struct makes this a plain aggregate: combined per task before
    # the shuffle, no window over a year's rows.
    row = F.struct(F.col(VALUE), at.alias("at"), F.col(TIME), *rest)
    if kind == "max":
        row = F.struct(F.col(VALUE), (-at).alias("at"), F.col(TIME), *rest)
    best = F.max(row) if kind == "max" else F.min(row)
    groups = rows.groupBy(*SERIES, F.year(TIME).alias("year")).agg(best.alias("row"))
    return pick_offset(groups, time_offset).where(F.col("year").isNotNull()).select(
        *SERIES, "year", *[F.col(f"row.{c}").alias(c) for c in (TIME, VALUE, *rest)]
    )


def annual_extreme(df: DataFrame, kind: str = "max",
                   element_id: str | None = None, source_id: str | None = None,
                   time_offset: str | None = None) -> DataFrame:
    """Yearly maximum or minimum labelled 31 December.

    Years without data between a series' first and last year appear as null.
    """
    _check_kind(kind)
    rows = _valid(df, element_id, source_id, time_offset)
    best = F.max(VALUE) if kind == "max" else F.min(VALUE)
    groups = rows.groupBy(*SERIES, F.year(TIME).alias("year")).agg(best.alias(VALUE))
    years = pick_offset(groups, time_offset).where(F.col("year").isNotNull())
    # One entry per calendar year in each array and map.
    packed = years.groupBy(*SERIES).agg(
        F.map_from_entries(F.collect_list(F.struct("year", VALUE))).alias("known"),
        F.sequence(F.min("year"), F.max("year")).alias("years"),
    )
    return packed.select(*SERIES, F.explode("years").alias("year"), "known").select(
        *SERIES,
        F.make_date(F.col("year"), F.lit(12), F.lit(31)).alias("period"),
        F.try_element_at("known", F.col("year")).alias(VALUE),
    )


def extreme_month_frequency(extreme_rows: DataFrame) -> DataFrame:
    """How many yearly extremes fall in each month, months 1 to 12."""
    month = F.month(TIME)
    counts = F.array(*[F.count_if(month == m) for m in range(1, 13)])
    return (
        extreme_rows.groupBy(*SERIES).agg(counts.alias("counts"))
        .select(*SERIES, F.posexplode("counts").alias("pos", "years"))
        .select(*SERIES, (F.col("pos") + 1).alias("month"), "years")
    )


def modal_extreme_month(extreme_rows: DataFrame) -> DataFrame:
    """The month holding most yearly extremes, the earlier month on ties."""
    frequency = extreme_month_frequency(extreme_rows)
    best = F.max(F.struct(F.col("years"), (-F.col("month")).alias("neg_month")))
    return (
        frequency.groupBy(*SERIES).agg(best.alias("best"))
        .select(*SERIES, (-F.col("best.neg_month")).alias("month"),
                F.col("best.years").alias("years"))
    )


def trend_endpoints(df: DataFrame, kind: str = "max",
                    element_id: str | None = None, source_id: str | None = None,
                    time_offset: str | None = None) -> DataFrame:
    """First and last point of the yearly extreme series."""
    points = annual_extreme(df, kind, element_id, source_id, time_offset)
    return points.groupBy(SOURCE, ELEMENT, OFFSET).agg(
        F.min("period").alias("first_period"),
        F.min_by(VALUE, "period").alias("first_value"),
        F.max("period").alias("last_period"),
        F.max_by(VALUE, "period").alias("last_value"),
    )


# Polynomial for the complementary error function, absolute error below 1.5e-7
# (Abramowitz and Stegun, 7.1.26): the scale, then the coefficients of t to t**5.
_ERFC = (0.3275911, 0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def _erfc(x: Column) -> Column:
    """Complementary error function of numbers from zero on."""
    scale, *coefficients = _ERFC
    t = 1 / (1 + F.lit(scale) * x)
    total = F.lit(0.0)
    for c in reversed(coefficients):
        total = (total + c) * t
    return total * F.exp(-x * x)


def robust_trend(df: DataFrame, kind: str = "max",
                 element_id: str | None = None, source_id: str | None = None,
                 time_offset: str | None = None) -> DataFrame:
    """Mann-Kendall test and Theil-Sen line of the yearly extremes of each series.

    ``years`` counts those with a value; ``s`` adds up the signs of the changes between all
    pairs of years, ``z`` is its normal score, corrected for ties and continuity, and
    ``p_value`` the two-sided probability (to 1e-6). ``slope`` is the median change a year of
    all pairs, ``intercept`` the median of value minus slope times year. With fewer than two
    years slope and intercept are null, ``s`` and ``z`` 0 and ``p_value`` 1. A series has one
    point a year, so its pairs are one small array.
    """
    points = annual_extreme(df, kind, element_id, source_id, time_offset).where(F.col(VALUE).isNotNull())
    packed = points.groupBy(*SERIES).agg(F.sort_array(F.collect_list(
        F.struct(F.year("period").alias("year"), F.col(VALUE).cast("double").alias("v")))).alias("points"))
    pairs = F.flatten(F.transform("points", lambda p: F.transform(
        F.filter("points", lambda q: q["year"] > p["year"]),
        lambda q: F.struct(F.signum(q["v"] - p["v"]).alias("sign"),
                           ((q["v"] - p["v"]) / (q["year"] - p["year"])).alias("slope")))))
    n = F.size("points").cast("double")
    equal = F.transform("points", lambda p: F.size(F.filter("points", lambda q: q["v"] == p["v"])))
    # each of t equal values brings (t - 1) * (2t + 5), together t * (t - 1) * (2t + 5)
    ties = F.aggregate(equal, F.lit(0.0), lambda a, t: a + (t - 1) * (2 * t + 5))
    found = packed.withColumn("pairs", pairs).select(
        *SERIES, "points", F.size("points").alias("years"),
        F.aggregate("pairs", F.lit(0.0), lambda a, x: a + x["sign"]).cast("bigint").alias("s"),
        F.sqrt((n * (n - 1) * (2 * n + 5) - ties) / 18).alias("spread"),
        F.sort_array(F.col("pairs.slope")).alias("slopes"))
    score = F.when(F.col("spread") > 0, (F.col("s") - F.signum(F.col("s").cast("double"))) / F.col("spread")).otherwise(0.0)
    scored = found.withColumns({"z": score, "slope": quantile_of("slopes", 0.5)})
    rests = F.sort_array(F.transform("points", lambda p: p["v"] - F.col("slope") * p["year"]))
    return scored.withColumn("rests", F.when(F.col("slope").isNotNull(), rests)).select(
        *SERIES, "years", "s", "z", F.when(F.col("z") == 0, 1.0).otherwise(_erfc(F.abs("z") / F.sqrt(F.lit(2.0)))).alias("p_value"),
        "slope", quantile_of("rests", 0.5).alias("intercept"))
