"""Documents to an observation table with daily ranges, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationloom.functions import to_utc_timestamp
from stationloom.operators.reshape import add_daily_range
from stationloom.schema import TIME
from stationloom.sources.readers import flatten_observations


def ingest_documents(documents: DataFrame) -> DataFrame:
    """Flatten documents, parse times and add the daily range rows."""
    rows = flatten_observations(documents).withColumn(
        TIME, to_utc_timestamp(F.col(TIME))
    )
    return add_daily_range(rows)
