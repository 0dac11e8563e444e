"""Writers. Sorting and file layout happen only here.

Each writer has a function that builds its rows, so they can be checked without files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationloom.functions import iso_format
from stationloom.operators.missing import missing_summary
from stationloom.operators.reshape import add_daily_range
from stationloom.operators.select import station_lookup
from stationloom.operators.sketches import write_sketches, year_figures
from stationloom.plans.materialise import materialise
from stationloom.sources.catalogue import write_catalogue
from stationloom.sources.versions import replace_table
from stationloom.schema import (
    ELEMENT,
    OBSERVATION_COLUMNS,
    OFFSET,
    SOURCE,
    TIME,
    UNIT,
    VALUE,
)

# Time, offset and element order the rows; the rest lets a range partition end
# inside an instant that very many stations share.
_FILE_ORDER = [TIME, OFFSET, ELEMENT, SOURCE, VALUE]


def _time_as_text(df: DataFrame) -> DataFrame:
    if isinstance(df.schema[TIME].dataType, T.StringType):
        return df
    return df.withColumn(TIME, iso_format(F.col(TIME)))


def write_observation_table(df: DataFrame, path: str, mode: str = "overwrite",
                            sketches: bool = False) -> None:
    """Columnar table partitioned by year, ordered by station and time inside each file.

    Rebalancing splits a large year over several files and merges small ones. Stations are
    found by the ranges that columnar files keep, so their number makes no directories.
    The table's series catalogue is written or merged after it, from the files just written,
    whose names tell them from others: ``df`` is read once, and the catalogue is of the rows
    stored. With ``sketches`` that look covers the values, too: its figures go to the shared
    folder, the catalogue is made of them, and they tell which series a second look makes
    quantile sketches of.
    """
    spark, name = df.sparkSession, f"part-{uuid.uuid4().hex}"
    table = df.select(*OBSERVATION_COLUMNS).withColumn("year", F.year(TIME))
    table.hint("rebalance", "year", SOURCE).sortWithinPartitions(
        "year", SOURCE, TIME
    ).write.mode(mode).option("mapreduce.output.basename", name).partitionBy("year").parquet(path)
    stored = spark.read.schema(table.schema).option("pathGlobFilter", f"{name}-*").parquet(path)
    if stored.isEmpty():
        # No rows, nothing written in this mode, or a committer with names of its own.
        stored = df
    if not sketches:
        write_catalogue(stored, path, mode)
        return
    figures = materialise(year_figures(stored))
    write_catalogue(stored, path, mode, figures)
    write_sketches(stored, path, mode, figures)


def station_rows(df: DataFrame, stations: dict[str, str] | None = None) -> DataFrame:
    """Rows of known stations with the station's ``city``, times as text."""
    return station_lookup(_time_as_text(df), stations)


def write_by_station(df: DataFrame, path: str, stations: dict[str, str] | None = None,
                     mode: str = "overwrite") -> None:
    """One directory ``city=<slug>`` per known station, delimited text.

    Rows of unknown stations are dropped.
    """
    station_rows(df, stations).hint("rebalance", "city").write.mode(mode).partitionBy(
        "city").option("header", True).csv(path)


def rows_with_range(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """Observations plus their daily range rows, times as text."""
    return _time_as_text(add_daily_range(df, order_by))


def write_with_range(df: DataFrame, path: str, mode: str = "overwrite",
                     order_by: str | None = None) -> None:
    """:func:`rows_with_range`, sorted, as delimited text.

    ``path`` must differ from where ``df`` comes from; see :func:`replace_with_range`.
    """
    rows = rows_with_range(df, order_by).orderBy(*_FILE_ORDER)
    rows.write.mode(mode).option("header", True).csv(path)


def replace_with_range(df: DataFrame, path: str, order_by: str | None = None) -> str:
    """:func:`write_with_range` as the new version of ``path``, which ``df`` may come from.

    Readers find it by :func:`stationloom.sources.versions.current_folder` and see the old
    version or the new one. Returns the new version's folder.
    """
    return replace_table(df.sparkSession, path,
                         lambda folder: write_with_range(df, folder, "errorifexists", order_by))


def imputed_rows(df: DataFrame) -> DataFrame:
    """Fixed column order, times as text, numbers with three decimals as text."""
    return _time_as_text(df).select(
        SOURCE, TIME, OFFSET, ELEMENT,
        F.format_string("%.3f", F.round(F.col(VALUE).cast("double"), 3)).alias(VALUE)
        if not isinstance(df.schema[VALUE].dataType, T.StringType) else VALUE,
        UNIT,
    )


def write_imputed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """:func:`imputed_rows` as delimited text, in order of the numbers behind the texts."""
    imputed_rows(df.orderBy(*_FILE_ORDER)).write.mode(mode).option("header", True).csv(path)


def write_missing_report(missing: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``missing_in_both`` (rows) and ``missing_summary`` (counts) under ``path``."""
    missing.write.mode(mode).option("header", True).csv(f"{path}/missing_in_both")
    missing_summary(missing).write.mode(mode).option("header", True).csv(
        f"{path}/missing_summary"
    )


def append_run_summary(summary: DataFrame, path: str) -> None:
    """Add the summary of a part of the history (``runs.run_summary``) to those at ``path``.

    Parts may overlap and may be added again; readers merge them.
    """
    summary.write.mode("append").partitionBy("year").parquet(path)


def document_entries(df: DataFrame) -> DataFrame:
    """One ``data`` array of one entry per station, time and offset.

    An entry holds the elements of one instant, so the vocabulary bounds it.
    """
    rows = _time_as_text(df).select(*OBSERVATION_COLUMNS)
    entries = rows.groupBy(SOURCE, TIME, OFFSET).agg(
        F.sort_array(F.collect_list(F.struct(OFFSET, ELEMENT, VALUE, UNIT)))
        .alias("observations")
    )
    return entries.select(F.array(F.struct(SOURCE, TIME, "observations")).alias("data"))


def write_observation_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """:func:`document_entries`, one document per line; read back with ``multi_line=False``."""
    document_entries(df).write.mode(mode).json(path)
