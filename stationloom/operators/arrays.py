"""Statistics of a sorted array of numbers without nulls.

For groups that the calendar bounds, such as the values of one series in one month: they
are collected in one pass, and whatever depends on a statistic of the group itself, such
as its outliers, follows without reading or joining the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collect_groups(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, values, total``: the sorted valid values of each group, and its number of rows."""
    return rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(value)).alias("values"),
        F.count(F.lit(1)).alias("total"))


def quantile_of(values: str, p: float) -> Column:
    """Linearly interpolated quantile; null for an empty array."""
    at = F.lit(p) * (F.size(values) - 1)
    low, high = F.floor(at).cast("int"), F.ceil(at).cast("int")
    return F.when(low == high, F.get(values, low)).otherwise(
        (high - at) * F.get(values, low) + (at - low) * F.get(values, high))


def mean_of(values: str) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(values) > 0, total / F.nullif(F.size(values), F.lit(0)))


def std_of(values: str, mean: Column) -> Column:
    """Population standard deviation around ``mean``."""
    squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    return F.when(F.size(values) > 0, F.sqrt(squares / F.nullif(F.size(values), F.lit(0))))


def statistic_of(statistic: str, values: str) -> Column:
    if statistic == "median":
        return quantile_of(values, 0.5)
    mean = mean_of(values)
    return mean if statistic == "mean" else std_of(values, mean)


def outside(values: str, low: Column, high: Column) -> Column:
    """The values below ``low`` or above ``high``."""
    return F.filter(values, lambda x: (x < low) | (x > high))


def inside(values: str, low: Column, high: Column) -> Column:
    """The values from ``low`` to ``high``."""
    return F.filter(values, lambda x: (x >= low) & (x <= high))
