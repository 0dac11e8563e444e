"""Missing values between two stations before and after imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationloom.operators.missing import missing_counts
from stationloom.operators.timeseries import impute_observations
from stationloom.schema import OBSERVATION_COLUMNS


def impute_and_compare(df: DataFrame, left: str, right: str, left_city: str,
                       right_city: str) -> DataFrame:
    """``city, before, after``: missing rows in the raw and the imputed table."""
    imputed = impute_observations(df).select(*OBSERVATION_COLUMNS)
    tables = {"before": df, "after": imputed}
    counts = None
    for name, table in tables.items():
        rows = missing_counts(table, left, right, left_city, right_city).select(
            "city", *[
                (F.col("num_missing") if n == name else F.lit(0)).alias(n)
                for n in tables
            ]
        )
        counts = rows if counts is None else counts.unionByName(rows)
    return counts.groupBy("city").agg(*[F.sum(n).alias(n) for n in tables])
