"""Selections and projections. Time filters are ranges, so scans can prune."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationloom.functions import (
    format_offset,
    iso_format,
    month_name,
    number_column,
    offset_hours_strict,
    unit_of,
)
from stationloom.operators.attach import attach
from stationloom.schema import (
    ELEMENT,
    OFFSET,
    SOURCE,
    STATIONS,
    TIME,
    UNIT,
    VALUE,
    require_rows,
)

# ``time_offset`` argument that keeps every offset.
ALL_OFFSETS = "*"


def instant(text: str | pd.Timestamp) -> Column:
    """Literal UTC instant; a partial date means its first moment."""
    ts = pd.Timestamp(text)
    ts = ts.tz_localize("UTC") if ts.tzinfo is None else ts.tz_convert("UTC")
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f+00:00")).cast("timestamp")


def filter_series(df: DataFrame, element_id: str | None = None,
                  time_offset: str | None = None,
                  source_id: str | None = None) -> DataFrame:
    """Rows of one element, offset and station; ``None`` does not restrict."""
    for column, wanted in (
        (ELEMENT, element_id), (OFFSET, time_offset), (SOURCE, source_id),
    ):
        if wanted is not None:
            df = df.where(F.col(column) == wanted)
    return df


def filter_month(df: DataFrame, month: str) -> DataFrame:
    """Rows of one ``YYYY-MM``."""
    first = pd.Timestamp(f"{month}-01")
    return df.where(
        (F.col(TIME) >= instant(first))
        & (F.col(TIME) < instant(first + pd.DateOffset(months=1)))
    )


def filter_year(df: DataFrame, year: int) -> DataFrame:
    """Rows of one calendar year."""
    return df.where(
        (F.col(TIME) >= instant(f"{year}-01-01"))
        & (F.col(TIME) < instant(f"{year + 1}-01-01"))
    )


def filter_period(df: DataFrame, start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """Rows from ``start`` to ``end``, both inclusive and both optional."""
    if start:
        df = df.where(F.col(TIME) >= instant(start))
    if end:
        df = df.where(F.col(TIME) <= instant(end))
    return df


def stored_years(df: DataFrame, start: str | pd.Timestamp | None,
                 end: str | pd.Timestamp | None) -> DataFrame:
    """Rows of a stored table in the years from ``start`` to ``end``.

    The bounds are on the column the table is partitioned by, so whole directories are
    passed over. A frame without a ``year`` stays as it is.
    """
    if "year" not in df.columns:
        return df
    if start:
        df = df.where(F.col("year") >= pd.Timestamp(start).year)
    if end:
        df = df.where(F.col("year") <= pd.Timestamp(end).year)
    return df


def filter_day_of_year(df: DataFrame, month: int, day: int) -> DataFrame:
    """Rows of one calendar day over all years."""
    return df.where((F.month(TIME) == month) & (F.dayofmonth(TIME) == day))


def filter_year_range_month(df: DataFrame, start_year: int, end_year: int,
                            month: str) -> DataFrame:
    """Rows whose ``year`` lies in a range and whose ``month`` has this name."""
    return df.where(
        F.col("year").between(start_year, end_year) & (F.col("month") == month)
    )


def filter_period_prefix(df: DataFrame, prefix: str | int,
                         column: str = "year_month") -> DataFrame:
    """Rows whose period text starts with ``prefix``, for instance a year."""
    return df.where(F.col(column).startswith(str(prefix)))


def filter_elements(df: DataFrame, elements: Sequence[str] | None = None,
                    cities: Sequence[str] | None = None) -> DataFrame:
    """Rows whose element, and whose ``city``, is in the given sets."""
    if elements is not None:
        df = df.where(F.col(ELEMENT).isin(list(elements)))
    if cities is not None:
        df = df.where(F.col("city").isin(list(cities)))
    return df


def drop_invalid_values(df: DataFrame) -> DataFrame:
    """Make ``value`` numeric and drop rows where that fails."""
    return df.withColumn(VALUE, number_column(df)).where(F.col(VALUE).isNotNull())


def scan_selection(df: DataFrame, sources: Sequence[str], elements: Sequence[str],
                   start: str, end: str) -> DataFrame:
    """Stations x elements x inclusive time range.

    Over a table partitioned by station and ``year`` the year bounds prune
    whole partitions.
    """
    first, last = pd.Timestamp(start), pd.Timestamp(end)
    df = df.where(
        F.col(SOURCE).isin(list(sources)) & F.col(ELEMENT).isin(list(elements))
    )
    return filter_period(stored_years(df, first, last), start, end)


def trim_normalise(df: DataFrame, columns: Sequence[str] = (ELEMENT,)) -> DataFrame:
    """Strip blanks from column names and from the text of ``columns``."""
    df = df.toDF(*[c.strip() for c in df.columns])
    return df.withColumns({c: F.trim(F.col(c).cast("string")) for c in columns})


def project_metadata(df: DataFrame, instant_column: str = "instant") -> DataFrame:
    """Observation columns rebuilt from an instant: time text, offset, unit."""
    at = F.col(instant_column)
    return df.select(
        SOURCE,
        iso_format(at).alias(TIME),
        format_offset(at).alias(OFFSET),
        ELEMENT,
        VALUE,
        unit_of(F.col(ELEMENT)).alias(UNIT),
    )


def station_lookup(df: DataFrame, stations: dict[str, str] | None = None) -> DataFrame:
    """Add the ``city`` of each known station; unknown stations are dropped.

    The map is part of the caller's program, so it travels inside the plan and
    needs no join.
    """
    stations = STATIONS if stations is None else stations
    pairs = [F.lit(x) for city, source in stations.items() for x in (source, city)]
    return df.where(F.col(SOURCE).isin(list(stations.values()))).withColumn(
        "city", F.create_map(*pairs)[F.col(SOURCE)]
    )


def element_values(df: DataFrame, element_id: str | None = None,
                   source_id: str | None = None, time_offset: str | None = None,
                   extra: Sequence[str] = ()) -> DataFrame:
    """Series columns, time and numeric value: the narrow input of the operators."""
    chosen = filter_series(
        df, element_id,
        None if time_offset == ALL_OFFSETS else time_offset,
        source_id,
    )
    return chosen.select(
        SOURCE, ELEMENT, OFFSET, TIME, number_column(chosen).alias(VALUE), *extra
    )


def _offset_rank() -> Column:
    hours = offset_hours_strict(F.col(OFFSET))
    return F.when(hours.isNotNull(), F.struct(hours, F.col(OFFSET)))


def min_time_offset(df: DataFrame | None, element_id: str | None = None,
                    source_id: str | None = None, strict: bool = False,
                    catalogue: DataFrame | None = None) -> DataFrame:
    """Smallest ``PT<n>H`` per station and element, by number of hours.

    Equal hours written differently resolve to the smaller text. ``rows`` counts
    the rows of the station and element. With a series ``catalogue`` no observations
    are read.
    """
    # Counting offsets first leaves a handful of rows per station and element.
    keys = [SOURCE, ELEMENT, OFFSET]
    if catalogue is None:
        counted = filter_series(df, element_id, None, source_id).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("rows"))
    else:
        counted = filter_series(catalogue, element_id, None, source_id).groupBy(*keys).agg(
            F.sum("rows").alias("rows"))
    found = (
        counted.groupBy(SOURCE, ELEMENT)
        .agg(F.min(_offset_rank()).alias("best"), F.sum("rows").alias("rows"))
        .where(F.col("best").isNotNull())
        .select(SOURCE, ELEMENT, F.col("best")[OFFSET].alias(OFFSET), "rows")
    )
    return require_rows(found, strict, f"no PT<n>H offset for element {element_id!r}")


def keep_min_offset(df: DataFrame, within: DataFrame | None = None,
                    catalogue: DataFrame | None = None) -> DataFrame:
    """Rows at the smallest offset of their station and element.

    ``within`` is the frame whose offsets count, when that is not ``df``; a series
    ``catalogue`` stands for it.
    """
    keys = [SOURCE, ELEMENT]
    best = min_time_offset(df if within is None else within, catalogue=catalogue)
    best = best.withColumnRenamed(OFFSET, "min_offset")
    return (
        attach(df, best, keys, ["min_offset"], how="inner")
        .where(F.col(OFFSET) == F.col("min_offset"))
        .drop("min_offset")
    )


def pick_offset(groups: DataFrame, time_offset: str | None) -> DataFrame:
    """Keep the groups at one offset; ``None`` means each series' smallest.

    ``groups`` has one row per series and period, so the window below holds as
    many rows as the calendar has periods, not as many as there are
    observations. Choosing after the aggregation saves a pass over the rows.
    """
    if time_offset == ALL_OFFSETS:
        return groups
    if time_offset is not None:
        return groups.where(F.col(OFFSET) == time_offset)
    w = Window.partitionBy(SOURCE, ELEMENT)
    return (
        groups.withColumn("__best", F.min(_offset_rank()).over(w)[OFFSET])
        .where(F.col(OFFSET) == F.col("__best"))
        .drop("__best")
    )


def yearly_raw(df: DataFrame, element_id: str | None, year: int | None,
               source_id: str | None = None, time_offset: str | None = None,
               strict: bool = False, catalogue: DataFrame | None = None) -> DataFrame:
    """Numeric rows of one year; ``time_offset=None`` takes the smallest offset.

    With the series ``catalogue`` of a stored table only that year is read.
    """
    if year is None:
        raise ValueError("year is required for raw rows")
    if catalogue is not None:
        df = stored_years(df, f"{year}-01-01", f"{year}-12-31")
    chosen = filter_series(
        df, element_id,
        None if time_offset == ALL_OFFSETS else time_offset,
        source_id,
    )
    in_year = filter_year(chosen, year)
    if time_offset is None:
        # The offset is a property of the whole series, the rows of the year.
        in_year = keep_min_offset(in_year, chosen, catalogue)
    return require_rows(
        drop_invalid_values(in_year), strict,
        f"no data for element {element_id!r} in {year}",
    )


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values of a column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def add_month_parts(df: DataFrame, month_start: str) -> DataFrame:
    """Add ``year`` and full ``month`` name of a month-start date column."""
    return df.withColumns({
        "year": F.year(month_start),
        "month": month_name(F.col(month_start)),
    })

