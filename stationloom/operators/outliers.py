"""Outliers by interquartile range, over any grouping of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.functions import number_column, percentage, round_n, year_month
from stationloom.operators.quantiles import Quantile, aggregate_groups
from stationloom.operators.select import (
    ALL_OFFSETS,
    element_values,
    min_time_offset,
    pick_offset,
    yearly_raw,
)
from stationloom.operators.arrays import (
    collect_groups,
    inside,
    outside,
    quantile_of,
    statistic_of,
)
from stationloom.operators.attach import attach, null_safe_equal
from stationloom.operators.stats import check_statistic
from stationloom.schema import SERIES, TIME, VALUE

INNER_WHISKER = 1.5
OUTER_WHISKER = 3.0
# Error of a fence in doubles, at most, as a share of the quartiles it is made of.
FENCE_NOISE = 1e-14

_QUARTILES = [Quantile("q1", "__v", 0.25), Quantile("q3", "__v", 0.75)]


def resolve_whisker(whisker: float | None = None, *, extreme: bool = False,
                    instance: float | None = None) -> float:
    """Whisker in force: the call's, else the instance's, else by ``extreme``.

    An instance whisker must be 1.5 or 3.0, a call whisker any positive number.
    """
    if instance not in (None, INNER_WHISKER, OUTER_WHISKER):
        raise ValueError("instance whisker must be 1.5, 3.0 or None")
    chosen = whisker
    if chosen is None:
        chosen = instance or (OUTER_WHISKER if extreme else INNER_WHISKER)
    if chosen <= 0:
        raise ValueError("whisker must be positive")
    return float(chosen)


def iqr_summary(df: DataFrame, keys: Sequence[str] = (), value: str = VALUE,
                sketches: DataFrame | None = None) -> DataFrame:
    """Quartiles, IQR, inner (1.5) and outer (3.0) fences per ``keys``.

    ``sketches`` are stored ones of the same rows, see
    :mod:`stationloom.operators.sketches`; then jobs run while the query is built.
    """
    rows = df.select(*keys, number_column(df, value).alias("__v"))
    q = _group_quartiles(rows, keys, sketches)
    q1, q3 = F.col("q1"), F.col("q3")
    iqr = q3 - q1
    return q.select(
        *keys, q1.alias("Q1"), q3.alias("Q3"), iqr.alias("IQR"),
        (q1 - INNER_WHISKER * iqr).alias("lower_inner"),
        (q3 + INNER_WHISKER * iqr).alias("upper_inner"),
        (q1 - OUTER_WHISKER * iqr).alias("lower_outer"),
        (q3 + OUTER_WHISKER * iqr).alias("upper_outer"),
    )


def _group_quartiles(rows: DataFrame, keys: Sequence[str],
                     sketches: DataFrame | None = None) -> DataFrame:
    if sketches is not None:
        from stationloom.operators.sketches import sketched_quantiles

        return sketched_quantiles(rows, sketches, keys, _QUARTILES)
    if keys:
        return aggregate_groups(rows, keys, _QUARTILES)
    one = aggregate_groups(
        rows.withColumn("__all", F.lit(1)), ["__all"], _QUARTILES
    )
    return one.drop("__all")


def _limits(q1: Column, q3: Column, whisker: float) -> tuple[Column, Column]:
    """Both fences, moved out by the error of doubles: a value on a fence is not outside."""
    reach = whisker * (q3 - q1)
    noise = FENCE_NOISE * (1 + whisker) * F.greatest(F.abs(q1), F.abs(q3))
    return q1 - reach - noise, q3 + reach + noise


def fences(df: DataFrame, keys: Sequence[str], whisker: float, value: str = VALUE,
           sketches: DataFrame | None = None) -> DataFrame:
    """``lower_fence`` and ``upper_fence`` per ``keys``; ``sketches`` as for :func:`iqr_summary`."""
    rows = df.select(*keys, number_column(df, value).alias("__v"))
    lower, upper = _limits(F.col("q1"), F.col("q3"), whisker)
    return _group_quartiles(rows, keys, sketches).select(
        *keys, lower.alias("lower_fence"), upper.alias("upper_fence"),
    )


def flag_outliers(df: DataFrame, keys: Sequence[str] = SERIES, *,
                  whisker: float | None = None, extreme: bool = False,
                  instance: float | None = None, value: str = VALUE,
                  flag: str = "is_outlier", time_offset: str | None = ALL_OFFSETS,
                  sketches: DataFrame | None = None) -> DataFrame:
    """Add a boolean: strictly outside the fences of its group; null is false.

    ``time_offset`` works as in :mod:`stationloom.operators.stats` and needs the
    series columns among ``keys``. ``sketches`` are those of :func:`iqr_summary`.
    """
    w = resolve_whisker(whisker, extreme=extreme, instance=instance)
    limits = pick_offset(fences(df, keys, w, value, sketches), time_offset)
    joined = attach(
        df, limits, list(keys), ["lower_fence", "upper_fence"],
        how="left" if time_offset == ALL_OFFSETS else "inner",
    )
    v = number_column(df, value)
    outside = (v < F.col("lower_fence")) | (v > F.col("upper_fence"))
    return joined.withColumn(flag, F.coalesce(outside, F.lit(False))).drop(
        "lower_fence", "upper_fence"
    )


def count_outliers(df: DataFrame, keys: Sequence[str] = SERIES,
                   **options) -> DataFrame:
    """Number of outliers per ``keys``; options as in :func:`flag_outliers`."""
    return (
        flag_outliers(df, keys, **options)
        .groupBy(*keys)
        .agg(F.count_if("is_outlier").alias("outliers"))
    )


def null_outliers(df: DataFrame, keys: Sequence[str] = SERIES, *,
                  value: str = VALUE, **options) -> DataFrame:
    """Same rows with flagged values set to null."""
    flagged = flag_outliers(df, keys, value=value, flag="__out", **options)
    return flagged.withColumn(
        value, F.when(~F.col("__out"), F.col(value))
    ).drop("__out")


def _month_groups(df: DataFrame, element_id, source_id, time_offset) -> DataFrame:
    """Values of each series and month, ``total`` rows; rows without a time in a null month."""
    # A row without a time belongs to no month but its offset still counts.
    rows = element_values(df, element_id, source_id, time_offset).withColumn(
        "month_start", F.trunc(TIME, "MM")
    )
    return collect_groups(rows, [*SERIES, "month_start"], VALUE)


def _fences_of(values: str, whisker: float) -> tuple[Column, Column]:
    return _limits(quantile_of(values, 0.25), quantile_of(values, 0.75), whisker)


def outliers_per_month(df: DataFrame, element_id: str | None = None,
                       source_id: str | None = None,
                       time_offset: str | None = None,
                       include_empty_months: bool = False,
                       whisker: float | None = None) -> DataFrame:
    """Outliers of each month, judged within the month.

    ``total_count`` counts all rows of the month, null values included.
    Months without outliers appear only with ``include_empty_months``.
    """
    w = resolve_whisker(instance=whisker, extreme=True)
    groups = _month_groups(df, element_id, source_id, time_offset)
    counted = groups.select(
        *SERIES, "month_start",
        F.size(outside("values", *_fences_of("values", w))).cast("bigint").alias("outliers_removed"),
        F.col("total").alias("total_count"),
    )
    counted = pick_offset(counted, time_offset).where(F.col("month_start").isNotNull())
    if not include_empty_months:
        counted = counted.where(F.col("outliers_removed") > 0)
    return counted.select(
        *SERIES, year_month(F.col("month_start")).alias("year_month"),
        "outliers_removed", "total_count",
        percentage(F.col("outliers_removed"), F.col("total_count"))
        .alias("outlier_percentage"),
    )


def stats_with_without_outliers(df: DataFrame, statistic: str,
                                element_id: str | None = None,
                                source_id: str | None = None,
                                time_offset: str | None = None,
                                whisker: float | None = None) -> DataFrame:
    """One statistic of each month over all and over cleaned values.

    Standard deviations are population ones, results have 3 decimals, months
    without a numeric value are left out.
    """
    check_statistic(statistic)
    w = resolve_whisker(instance=whisker, extreme=True)
    groups = _month_groups(df, element_id, source_id, time_offset)
    measured = _with_without(groups, [statistic], w).drop("values", "clean", "total")
    return pick_offset(measured, time_offset).where(
        (F.col("n") > 0) & F.col("month_start").isNotNull()
    ).select(
        *SERIES, year_month(F.col("month_start")).alias("year_month"),
        *_with_without_names([statistic]), "outliers_removed",
    )


def _with_without_names(statistics: Sequence[str]) -> list[str]:
    return [f"{s}_{suffix}_outliers" for s in statistics for suffix in ("with", "without")]


def _with_without(groups: DataFrame, statistics: Sequence[str], whisker: float) -> DataFrame:
    """Add each statistic of all and of ``clean`` values, ``outliers_removed`` and ``n``."""
    cleaned = groups.withColumn("clean", inside("values", *_fences_of("values", whisker)))
    n, kept = F.size("values"), F.size("clean")
    measures = {
        f"{s}_{suffix}_outliers": round_n(statistic_of(s, column), 3)
        for s in statistics
        for column, suffix in (("values", "with"), ("clean", "without"))
    }
    return cleaned.withColumns(
        measures | {"n": n, "outliers_removed": (n - kept).cast("bigint")})


def mean_outliers_by_month(per_month: DataFrame) -> DataFrame:
    """Mean monthly outlier count by calendar month, 1 to 12, null if absent.

    Takes the result of :func:`outliers_per_month` with empty months included.
    """
    month = F.substring("year_month", 6, 2).cast("int")
    means = [
        F.avg(F.when(month == m, F.col("outliers_removed"))) for m in range(1, 13)
    ]
    return (
        per_month.groupBy(*SERIES).agg(F.array(*means).alias("means"))
        .select(*SERIES, F.posexplode("means").alias("pos", "mean_outliers"))
        .select(*SERIES, (F.col("pos") + 1).alias("month"), "mean_outliers")
    )


def outliers_per_year(per_month: DataFrame) -> DataFrame:
    """Sum of monthly outlier counts by year."""
    return per_month.groupBy(
        *SERIES, F.substring("year_month", 1, 4).cast("int").alias("year")
    ).agg(F.sum("outliers_removed").alias("outliers_removed"))


def series_outlier_count(df: DataFrame, element_id: str, time_offset: str) -> DataFrame:
    """Outliers of each station over its whole series, whisker 1.5."""
    rows = element_values(df, element_id, None, time_offset)
    return count_outliers(rows, SERIES)


def year_box_summary(df: DataFrame, year: int, element_id: str | None = None,
                     source_id: str | None = None,
                     time_offset: str | None = None) -> DataFrame:
    """Box-plot figures of one year per series.

    Quartiles and extreme count of the year's values, and the means over its
    months of: monthly mean with and without outliers, cleaned monthly median.
    """
    # Offsets are resolved on the result, which has one row per series.
    raw = yearly_raw(df, element_id, year, source_id, time_offset or ALL_OFFSETS)
    months = _with_without(
        _month_groups(raw, None, None, ALL_OFFSETS), ["mean", "median"], OUTER_WHISKER)
    # Twelve months of values at most come together again.
    years = months.where(F.col("n") > 0).groupBy(*SERIES).agg(
        F.sort_array(F.flatten(F.collect_list("values"))).alias("values"),
        *[F.avg(c).alias(c) for c in (
            "mean_with_outliers", "mean_without_outliers", "median_without_outliers")],
    ).withColumns({"Q1": quantile_of("values", 0.25), "Q3": quantile_of("values", 0.75)})
    limits = _limits(F.col("Q1"), F.col("Q3"), OUTER_WHISKER)
    boxes = years.select(
        *SERIES, "Q1", "Q3", (F.col("Q3") - F.col("Q1")).alias("IQR"),
        F.size(outside("values", *limits)).cast("bigint").alias("extreme_count"),
        "mean_with_outliers", "mean_without_outliers", "median_without_outliers",
    )
    if time_offset is not None:
        return boxes
    best = min_time_offset(df, element_id, source_id).select(
        *[F.col(k).alias(f"__best_{k}") for k in SERIES]
    )
    same = null_safe_equal(boxes, best, [(k, f"__best_{k}") for k in SERIES])
    return boxes.join(best, same, "left_semi")
