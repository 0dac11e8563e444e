"""Observations to fitted and scored precipitation models.

The feature table is far smaller than the observations and every model step
reads it, so it is materialised once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stationloom.operators import predict
from stationloom.plans.materialise import materialise
from stationloom.schema import SOURCE


def rain_training_table(df: DataFrame, train_percent: int = 80) -> DataFrame:
    """Scaled features, label and split of every station, materialised."""
    features = predict.rain_label(predict.weather_features(df))
    split = materialise(
        predict.train_test_split(features, predict.split_key(), train_percent)
    )
    return predict.standard_scale(split)


def rain_classified(df: DataFrame, train_percent: int = 80) -> DataFrame:
    """Every row classified by its station's naive Bayes model."""
    scaled = rain_training_table(df, train_percent)
    model = predict.fit_rain_gaussian_nb(scaled)
    return predict.predict_rain_gaussian_nb(model, scaled)


def precipitation_predicted(df: DataFrame, train_percent: int = 80) -> DataFrame:
    """Every row with the millimetres its station's linear model predicts."""
    features = predict.precipitation_features(df)
    split = materialise(
        predict.train_test_split(features, predict.split_key("date"), train_percent)
    )
    model = predict.fit_precipitation_linear(split)
    return predict.predict_precipitation(model, split)
