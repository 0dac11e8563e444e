"""Statistics by period and the percentage change between periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationloom.operators.quantiles import aggregate_groups
from stationloom.operators.select import (
    ALL_OFFSETS,
    element_values,
    filter_period,
    keep_min_offset,
    pick_offset,
    stored_years,
)
from stationloom.operators.stats import check_statistic, measure
from stationloom.schema import SERIES, TIME, VALUE

# Codes of day, month and year.
FREQUENCIES = ("D", "ME", "YE")


def _period_start(frequency: str) -> Column:
    if frequency == "D":
        return F.to_date(TIME)
    return F.trunc(TIME, "MM" if frequency == "ME" else "YEAR")


def _period_label(frequency: str, start: str) -> Column:
    if frequency == "D":
        return F.col(start)
    if frequency == "ME":
        return F.last_day(start)
    return F.make_date(F.year(start), F.lit(12), F.lit(31))


def period_stat(df: DataFrame, statistic: str = "mean", frequency: str = "ME",
                element_id: str | None = None, source_id: str | None = None,
                time_offset: str | None = None, start: str | None = None,
                end: str | None = None, catalogue: DataFrame | None = None) -> DataFrame:
    """Mean, median or population std per day, month or year.

    ``period`` is the day, the last day of the month, or 31 December. A period
    whose values are all null has a null value. With the series ``catalogue`` of a stored
    table only the years from ``start`` to ``end`` are read.
    """
    check_statistic(statistic)
    if frequency not in FREQUENCIES:
        raise ValueError(f"frequency must be one of {FREQUENCIES}")
    if catalogue is not None:
        df = stored_years(df, start, end)
    chosen = element_values(df, element_id, source_id, time_offset)
    rows = filter_period(chosen, start, end)
    if (start or end) and time_offset is None:
        # The offset is a property of the whole series, the rows of the range.
        rows, time_offset = keep_min_offset(rows, chosen, catalogue), ALL_OFFSETS
    rows = rows.withColumn("start", _period_start(frequency))
    quantiles, measures = measure(statistic, VALUE, "result", sample=False)
    groups = aggregate_groups(
        rows, [*SERIES, "start"], quantiles, measures, calendar=True
    )
    return pick_offset(groups, time_offset).where(F.col("start").isNotNull()).select(
        *SERIES, _period_label(frequency, "start").alias("period"),
        F.col("result").alias(VALUE),
    )


def percent_change(df: DataFrame, statistic: str = "mean", frequency: str = "ME",
                   element_id: str | None = None, source_id: str | None = None,
                   time_offset: str | None = None, start: str | None = None,
                   end: str | None = None, catalogue: DataFrame | None = None) -> DataFrame:
    """Change in percent from the previous period that has a value.

    The first period is dropped. A zero base gives plus or minus infinity, and
    zero to zero is dropped. ``catalogue`` is that of :func:`period_stat`.
    """
    periods = period_stat(
        df, statistic, frequency, element_id, source_id, time_offset, start, end, catalogue
    ).where(F.col(VALUE).isNotNull())
    # One row per period: bounded by the calendar.
    base = F.lag(VALUE).over(Window.partitionBy(*SERIES).orderBy("period"))
    value = F.col(VALUE)
    change = (
        F.when(F.col("base") != 0, (value / F.col("base") - 1) * 100)
        .when(value > 0, F.lit(float("inf")))
        .when(value < 0, F.lit(float("-inf")))
    )
    return (
        periods.withColumn("base", base)
        .where(F.col("base").isNotNull())
        .withColumn("percent_change", change)
        .where(F.col("percent_change").isNotNull())
        .select(*SERIES, "period", VALUE, "percent_change")
    )
