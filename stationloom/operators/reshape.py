"""Daily range, pivots and their inverse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.functions import number_column, round_n
from stationloom.schema import (
    ELEMENT,
    MAX_TEMPERATURE,
    MIN_TEMPERATURE,
    OFFSET,
    RANGE_TEMPERATURE,
    SOURCE,
    TIME,
    UNIT,
    VALUE,
)

def only_row(value: str | Column, what: str) -> Column:
    """Aggregate for a cell that must hold one row; more fail the query."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"duplicate {what}"))
    ).otherwise(F.first(c))


def pivot_unique(df: DataFrame, rows: Sequence[str], columns: str, value: str,
                 names: Sequence[str]) -> DataFrame:
    """Pivot over given column ``names`` in which two rows for one cell are an error.

    One aggregate, so one shuffle: each cell counts its rows and takes its value.
    """
    source = F.col(f"`{value}`")

    def cell(name: str) -> Column:
        here = F.col(f"`{columns}`") == name
        what = F.lit(f"duplicate cell ({', '.join(rows)}, {columns})")
        return F.when(F.count_if(here) > 1, F.raise_error(what)).otherwise(
            F.first(F.when(here, source), ignorenulls=True)).alias(name)

    return df.groupBy(*rows).agg(*[cell(n) for n in names])


def pivot_elements(df: DataFrame, elements: Sequence[str],
                   rows: Sequence[str] = (SOURCE, TIME)) -> DataFrame:
    """One row per station and instant, one column per element."""
    numeric = df.withColumn(VALUE, number_column(df))
    return pivot_unique(numeric, list(rows), ELEMENT, VALUE, elements)


def melt_elements(wide: DataFrame, elements: Sequence[str],
                  rows: Sequence[str] = (SOURCE, TIME)) -> DataFrame:
    """Wide to long; inverse of :func:`pivot_elements`, null cells kept."""
    return wide.unpivot(
        list(rows), [F.col(f"`{e}`") for e in elements], ELEMENT, VALUE
    )


def _first_valid(element: str, order: str | None) -> Column:
    value = F.when(F.col(ELEMENT) == element, F.col(VALUE))
    rank = [F.col(order)] if order else []
    rank = F.struct(*rank, F.col("__number"), value)
    return F.min_by(value, F.when(value.isNotNull(), rank))


def daily_range(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """Max minus min temperature per station, time and offset, 1 decimal.

    Several rows for one cell give the first one holding anything, by ``order_by`` and
    then by number, so the choice does not depend on how rows are spread over tasks. One
    of the two missing gives a null range.
    """
    both = df.where(F.col(ELEMENT).isin(MAX_TEMPERATURE, MIN_TEMPERATURE))
    both = both.withColumn("__number", number_column(both))
    cells = both.groupBy(SOURCE, TIME, OFFSET).agg(
        _first_valid(MAX_TEMPERATURE, order_by).alias("high"),
        _first_valid(MIN_TEMPERATURE, order_by).alias("low"),
    )
    return cells.where(
        F.col("high").isNotNull() | F.col("low").isNotNull()
    ).select(
        SOURCE, TIME, OFFSET,
        F.lit(RANGE_TEMPERATURE).alias(ELEMENT),
        round_n(
            number_column(cells, "high") - number_column(cells, "low"), 1
        ).alias(VALUE),
        F.lit("degC").alias(UNIT),
    )


def add_daily_range(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """Input rows and their range rows together (unsorted; sinks sort)."""
    ranges = daily_range(df, order_by)
    ranges = ranges.withColumn(VALUE, F.col(VALUE).cast(df.schema[VALUE].dataType))
    return df.select(SOURCE, TIME, OFFSET, ELEMENT, VALUE, UNIT).unionByName(ranges)


def feature_pivot(df: DataFrame, names: dict[str, str],
                  keys: Sequence[str] = (SOURCE,)) -> DataFrame:
    """Station x date with one mean column per element; incomplete dates dropped.

    ``names`` maps element to column name.
    """
    rows = df.where(F.col(ELEMENT).isin(list(names)))
    rows = rows.withColumns({VALUE: number_column(rows), "date": F.to_date(TIME)})
    return rows.groupBy(*keys, "date").agg(*[
        F.avg(F.when(F.col(ELEMENT) == e, F.col(VALUE))).alias(n)
        for e, n in names.items()
    ]).dropna(subset=list(names.values()))
