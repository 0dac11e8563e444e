"""Missing runs as summaries of months that add up.

A summary row is an element's runs within one month. Summaries of any parts of the
history merge into that of the whole, in any order and with repeats, so a new month is
appended without reading what came before. Only runs that touch the ends of their month
are joined across months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationloom.operators.missing import missing_dates
from stationloom.schema import ELEMENT


def _runs(days: Column) -> Column:
    """Runs in the ascending days of one month."""
    starts = F.filter(days, lambda d: ~F.array_contains(days, F.date_sub(d, 1)))
    ends = F.filter(days, lambda d: ~F.array_contains(days, F.date_add(d, 1)))
    return F.arrays_zip(starts.alias("start"), ends.alias("end"))


def run_summary(missing: DataFrame, value: str, cells: str = "pivot",
                elements: Sequence[str] | None = None) -> DataFrame:
    """``elementId, year, month, runs`` of a missing table; arguments as for ``missing_runs``.

    With ``cells='pivot'`` a part of the history has to hold all rows of its dates and
    offsets, because what it does not hold counts as missing.
    """
    month = F.trunc("date", "month").alias("month")
    days = missing_dates(missing, value, cells, elements).groupBy(ELEMENT, month).agg(
        F.array_sort(F.collect_set("date")).alias("days"))
    return days.select(ELEMENT, F.year("month").alias("year"), "month", _runs(F.col("days")).alias("runs"))


def merge_run_summaries(parts: DataFrame) -> DataFrame:
    """One row per element and month of summaries of any parts of the history."""
    both = parts.groupBy(ELEMENT, "year", "month").agg(F.collect_set("runs").alias("parts"))
    days = F.flatten(F.transform(F.flatten("parts"), lambda r: F.sequence(r["start"], r["end"])))
    merged = F.when(F.size("parts") == 1, F.get("parts", F.lit(0))).otherwise(
        _runs(F.array_sort(F.array_distinct(days))))
    return both.select(ELEMENT, "year", "month", merged.alias("runs"))


def runs_of_summaries(parts: DataFrame) -> DataFrame:
    """``elementId, start, end`` of the maximal runs, as ``missing_runs`` over the whole history."""
    runs = merge_run_summaries(parts).select(ELEMENT, "month", F.inline("runs"))
    at_end = (F.col("start") == F.col("month")) | (F.col("end") == F.last_day("month"))
    # Two runs a month at most.
    w = Window.partitionBy(ELEMENT).orderBy("start")
    before = F.lag("end").over(w)
    new = (before.isNull() | (F.date_diff("start", before) > 1)).cast("int")
    joined = (
        runs.where(at_end).withColumn("new", new).withColumn("run", F.sum("new").over(w))
        .groupBy(ELEMENT, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    closed = runs.where(~at_end).select(ELEMENT, "start", "end")
    return closed.unionByName(joined.select(ELEMENT, "start", "end"))
