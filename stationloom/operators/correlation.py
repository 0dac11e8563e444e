"""Correlation that is null, not an error, for a constant column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: Pearson correlation of two columns without nulls.

    The built-in ``corr`` divides by zero for a constant column in ANSI mode.
    """
    spread = F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y))
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
