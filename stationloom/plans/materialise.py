"""Keeping a derived table that several later steps read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stationloom.plans.shared import shared_folder


def materialise(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read back.

    The job runs here, once. Later steps start from the files, whichever executors are
    lost, and nothing stays in the session's cache; the files go with the shared folder.
    """
    path = shared_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
