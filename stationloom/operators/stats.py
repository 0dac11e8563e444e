"""Monthly, yearly and climatological statistics per series.

Every function covers all stations and elements unless told otherwise. With
``time_offset=None`` each station and element uses its smallest offset, with
``ALL_OFFSETS`` every offset is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.functions import month_abbr, year_month
from stationloom.operators.quantiles import Quantile, aggregate_groups
from stationloom.operators.select import (
    ALL_OFFSETS,
    add_month_parts,
    element_values,
    filter_day_of_year,
    filter_month,
    filter_year,
    keep_min_offset,
    pick_offset,
    stored_years,
)
from stationloom.schema import (
    ELEMENT,
    OFFSET,
    RANGE_TEMPERATURE,
    SERIES,
    SOURCE,
    TIME,
    VALUE,
    require_rows,
)

STATISTICS = ("mean", "median", "std")


def check_statistic(statistic: str, allowed=STATISTICS) -> None:
    if statistic not in allowed:
        raise ValueError(f"statistic must be one of {allowed}, got {statistic!r}")


def measure(statistic: str, value: str, name: str, *,
            sample: bool) -> tuple[list[Quantile], list[Column]]:
    """Inputs of ``aggregate_groups`` for one statistic of one column."""
    if statistic == "median":
        return [Quantile(name, value, 0.5)], []
    column = {
        "mean": F.avg, "sum": F.sum,
        "std": F.stddev_samp if sample else F.stddev_pop,
    }[statistic](value)
    return [], [column.alias(name)]


def count_by_source(df: DataFrame) -> DataFrame:
    """Number of rows per station."""
    return df.groupBy(SOURCE).agg(F.count(F.lit(1)).alias("num_entries"))


def month_stats(df: DataFrame, month: str, element_id: str | None = None,
                source_id: str | None = None, time_offset: str | None = None,
                strict: bool = False, catalogue: DataFrame | None = None) -> DataFrame:
    """Mean, median and population std of one ``YYYY-MM``.

    With the series ``catalogue`` of a stored table only the year of the month is read.
    """
    if catalogue is not None:
        df = stored_years(df, f"{month}-01", f"{month}-01")
    chosen = element_values(df, element_id, source_id, time_offset)
    rows = filter_month(chosen, month)
    if time_offset is None:
        # The offset is a property of the whole series, the rows of the month.
        rows = keep_min_offset(rows, chosen, catalogue)
    out = _month_measures(rows).where(F.col("n") > 0).drop("n")
    return require_rows(out, strict, f"no data points in {month}")


def _month_measures(rows: DataFrame) -> DataFrame:
    return aggregate_groups(
        rows, SERIES, [Quantile("median", VALUE, 0.5)],
        [F.avg(VALUE).alias("mean"), F.stddev_pop(VALUE).alias("std"),
         F.count(VALUE).alias("n")], calendar=True
    ).select(*SERIES, "mean", "median", "std", "n")


def _by_month(df: DataFrame, element_id, source_id, time_offset) -> DataFrame:
    rows = element_values(df, element_id, source_id, time_offset).withColumn(
        "month_start", F.trunc(TIME, "MM")
    )
    groups = aggregate_groups(
        rows, [*SERIES, "month_start"], [Quantile("median", VALUE, 0.5)],
        [F.avg(VALUE).alias("mean"), F.stddev_samp(VALUE).alias("std"),
         F.count(VALUE).alias("n")], calendar=True
    )
    return pick_offset(groups, time_offset).where(
        (F.col("n") > 0) & F.col("month_start").isNotNull()
    )


def monthly_stats(df: DataFrame, element_id: str | None = None,
                  source_id: str | None = None, time_offset: str | None = None,
                  strict: bool = False) -> DataFrame:
    """Mean, median and sample std of every month."""
    out = _by_month(df, element_id, source_id, time_offset).select(
        *SERIES, year_month(F.col("month_start")).alias("year_month"),
        "mean", "median", "std",
    )
    return require_rows(out, strict, f"no data points for {element_id!r}")


def monthly_range_series(df: DataFrame, element_id: str = RANGE_TEMPERATURE,
                         source_id: str | None = None,
                         time_offset: str | None = None) -> DataFrame:
    """Monthly statistics of the daily range with year, month name, ``temp_diff``."""
    groups = _by_month(df, element_id, source_id, time_offset)
    return add_month_parts(groups, "month_start").select(
        *SERIES, year_month(F.col("month_start")).alias("year_month"),
        "mean", "median", "std", "year", "month", F.col("mean").alias("temp_diff"),
    )


def yearly(df: DataFrame, aggregate: str = "mean", element_id: str | None = None,
           source_id: str | None = None, year: int | None = None,
           time_offset: str | None = None, strict: bool = False,
           catalogue: DataFrame | None = None) -> DataFrame:
    """Mean, sum, median or sample std of every year, or of one year.

    With the series ``catalogue`` of a stored table only the year asked for is read.
    """
    check_statistic(aggregate, ("mean", "sum", "median", "std"))
    if catalogue is not None and year is not None:
        df = stored_years(df, f"{year}-01-01", f"{year}-12-31")
    chosen = element_values(df, element_id, source_id, time_offset)
    rows = chosen if year is None else filter_year(chosen, year)
    if year is not None and time_offset is None:
        rows, time_offset = keep_min_offset(rows, chosen, catalogue), ALL_OFFSETS
    rows = rows.withColumn("year", F.year(TIME))
    quantiles, measures = measure(aggregate, VALUE, "result", sample=True)
    groups = aggregate_groups(
        rows, [*SERIES, "year"], quantiles,
        [*measures, F.count(VALUE).alias("n")], calendar=True
    )
    out = pick_offset(groups, time_offset).where(
        (F.col("n") > 0) & F.col("year").isNotNull()
    )
    out = out.select(*SERIES, "year", F.col("result").alias(VALUE))
    return require_rows(out, strict, "no data after filtering")


def annual_by_city(df: DataFrame, element_id: str, labels: dict[str, str],
                   time_offset: str | None = None) -> DataFrame:
    """Yearly sums of several stations in one table, with a ``city`` label each."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    sums = yearly(
        df.where(F.col(SOURCE).isin(list(labels))), "sum", element_id,
        time_offset=time_offset,
    )
    return sums.select(
        "year", VALUE, F.create_map(*pairs)[F.col(SOURCE)].alias("city")
    )


def climatology(df: DataFrame, statistic: str = "mean",
                element_id: str | None = None, source_id: str | None = None,
                time_offset: str | None = None, remove_outliers: bool = False,
                whisker: float | None = None) -> DataFrame:
    """Mean, median or population std by calendar month over all years.

    A month without any numeric value stays, with a null. ``remove_outliers``
    first drops values outside the fences of the whole series (whisker 3.0
    unless given).
    """
    check_statistic(statistic)
    from stationloom.operators.outliers import null_outliers

    rows = element_values(df, element_id, source_id, time_offset)
    chosen = time_offset
    if remove_outliers:
        rows = null_outliers(
            rows, SERIES, instance=whisker, extreme=True,
            time_offset=time_offset
        )
        chosen = ALL_OFFSETS
    rows = rows.withColumn("month", F.month(TIME))
    quantiles, measures = measure(statistic, VALUE, "result", sample=False)
    groups = aggregate_groups(
        rows, [*SERIES, "month"], quantiles, measures
    )
    return pick_offset(groups, chosen).where(F.col("month").isNotNull()).select(
        *SERIES, "month",
        month_abbr(F.make_date(F.lit(2000), F.col("month"), F.lit(1)))
        .alias("month_name"),
        F.col("result").alias(VALUE),
    )


def day_in_history(df: DataFrame, month: int, day: int, element_id: str,
                   time_offset: str,
                   source_ids: list[str] | None = None) -> DataFrame:
    """Mean of one calendar day over all years per station."""
    rows = element_values(df, element_id, None, time_offset)
    if source_ids is not None:
        rows = rows.where(F.col(SOURCE).isin(source_ids))
    return (
        filter_day_of_year(rows, month, day)
        .groupBy(SOURCE, ELEMENT, OFFSET)
        .agg(F.avg(VALUE).alias("mean"))
    )
