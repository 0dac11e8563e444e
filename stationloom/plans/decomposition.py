"""Observations to decomposed series."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stationloom.operators.decompose import seasonal_decompose
from stationloom.operators.timeseries import (
    interpolate_time,
    observation_grid,
)
from stationloom.plans.materialise import materialise
from stationloom.schema import SOURCE, TIME


def filled_series(df: DataFrame) -> DataFrame:
    """Complete grid without nulls, materialised: ``sourceId, elementId, instant, value``.

    Decomposing reads its input several times, and each reading would repeat
    the gridding and filling.
    """
    grid = observation_grid(df).drop("observed_offset")
    return materialise(interpolate_time(grid, time="instant"))


def decompose_observations(df: DataFrame, period: int = 365, model: str = "additive") -> DataFrame:
    """Fill every series of every station and decompose it."""
    filled = filled_series(df)
    return seasonal_decompose(filled, period, model, time="instant")
