"""The series catalogue of a stored observation table.

It has one row per year and series: how many rows, from when to when. It lies inside the
table's folder under a name that scans of the table pass over, and is partitioned by year
as the table is, so a write that replaces years replaces their part of the catalogue, and
a write that appends adds rows that merge with those before. Operators that work on a
part of the history find the offsets of whole series here instead of reading the key
columns of everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationloom.schema import SERIES, TIME

#: Folder of the catalogue inside that of its table.
FOLDER = "_series"
YEAR = "year"


def series_catalogue(df: DataFrame) -> DataFrame:
    """``year, sourceId, elementId, timeOffset, rows, first, last`` of some observations.

    Rows without a time count in the null year, with null ``first`` and ``last``.
    """
    return df.groupBy(F.year(TIME).alias(YEAR), *SERIES).agg(
        F.count(F.lit(1)).alias("rows"), F.min(TIME).alias("first"), F.max(TIME).alias("last"))


def merge_catalogues(parts: DataFrame, keys: Sequence[str] = (YEAR, *SERIES)) -> DataFrame:
    """One row per ``keys`` of catalogue rows from any number of writes."""
    return parts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"))


def write_catalogue(df: DataFrame, path: str, mode: str, figures: DataFrame | None = None) -> None:
    """Write the catalogue of ``df`` beside the table at ``path`` it was written to in ``mode``.

    ``figures`` are those of ``df`` by year (``sketches.year_figures``), which hold the catalogue.
    """
    made = series_catalogue(df) if figures is None else figures.select(YEAR, *SERIES, "rows", "first", "last")
    # A year's catalogue is small: a file for each.
    made.repartition(YEAR).write.mode(mode).partitionBy(YEAR).parquet(f"{path}/{FOLDER}")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The merged catalogue of the table at ``path``, one row per year and series."""
    return merge_catalogues(spark.read.parquet(f"{path}/{FOLDER}"))


def stale_years(spark: SparkSession, path: str) -> list[int | None]:
    """Years whose number of rows the catalogue does not know, as after a write that broke off.

    Numbers of rows come from the footers of the table's files.
    """
    stored = spark.read.parquet(path).groupBy(YEAR).agg(F.count(F.lit(1)).alias("stored"))
    known = read_catalogue(spark, path).groupBy(YEAR).agg(F.sum("rows").alias("known"))
    both = stored.join(known.withColumnRenamed(YEAR, "__year"), F.col(YEAR).eqNullSafe(F.col("__year")), "full_outer")
    wrong = both.where(~F.col("stored").eqNullSafe(F.col("known"))).select(
        F.coalesce(YEAR, "__year").alias(YEAR))
    return [r[YEAR] for r in wrong.orderBy(YEAR).collect()]


def rebuild_catalogue(spark: SparkSession, path: str, years: Sequence[int | None] | None = None) -> None:
    """Make the catalogue anew from the stored table: all of it, or that of some years."""
    table = spark.read.parquet(path)
    if years is not None:
        table = table.where(F.col(YEAR).isin([y for y in years if y is not None])
                            | (F.col(YEAR).isNull() if None in years else F.lit(False)))
    made = table.groupBy(YEAR, *SERIES).agg(
        F.count(F.lit(1)).alias("rows"), F.min(TIME).alias("first"), F.max(TIME).alias("last"))
    writer = made.repartition(YEAR).write.mode("overwrite").partitionBy(YEAR)
    kept = "static" if years is None else "dynamic"
    writer.option("partitionOverwriteMode", kept).parquet(f"{path}/{FOLDER}")

