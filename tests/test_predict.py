import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from stationloom.operators import predict
from stationloom.schema import MAX_TEMPERATURE, MIN_TEMPERATURE, PRECIPITATION


@pytest.fixture()
def frame(spark):
    random = np.random.default_rng(0)
    n = 400
    high = random.normal(10, 5, n)
    low = high - random.gamma(2, 2, n)
    rain = np.maximum(0, 3 + 0.5 * low - 0.4 * high + random.normal(0, 2, n))
    days = pd.date_range("2020-01-01", periods=n)
    pdf = pd.DataFrame({"sourceId": "S", "date": days.date, "TMAX": high, "TMIN": low, "PRCP": rain})
    df = spark.createDataFrame(pdf)
    df = predict.train_test_split(df, predict.split_key("date"))
    return predict.rain_label(df, "PRCP")


def test_split_is_repeatable(frame):
    shares = frame.groupBy("is_train").count().collect()
    sizes = {r["is_train"]: r["count"] for r in shares}
    assert 0.7 < sizes[True] / 400 < 0.9
    again = predict.train_test_split(frame.drop("is_train").repartition(7), predict.split_key("date"))
    assert rows(again, "date", "is_train") == rows(frame, "date", "is_train")


def test_linear_matches_least_squares(frame):
    pdf = frame.toPandas()
    train = pdf[pdf.is_train]
    design = np.c_[train.TMAX, train.TMIN, np.ones(len(train))]
    expected = np.linalg.lstsq(design, train.PRCP, rcond=None)[0]
    model = predict.fit_precipitation_linear(frame)
    got = model.first()
    np.testing.assert_allclose(
        [got["coef_tmax"], got["coef_tmin"], got["intercept"]], expected, rtol=1e-8)
    scored = predict.predict_precipitation(model, frame)
    assert scored.count() == 400
    test = pdf[~pdf.is_train]
    predicted = np.c_[test.TMAX, test.TMIN, np.ones(len(test))] @ expected
    metrics = predict.regression_metrics(scored).first()
    mse = np.mean((test.PRCP - predicted) ** 2)
    assert metrics["mse"] == pytest.approx(mse)
    assert metrics["r2"] == pytest.approx(1 - mse / np.var(test.PRCP))
    assert predict.actual_vs_predicted(scored).count() == len(test)


def test_scaling(frame):
    scaled = predict.standard_scale(frame)
    got = scaled.where("is_train").agg(F.avg("TMAX_z"), F.stddev_pop("TMAX_z")).first()
    assert got[0] == pytest.approx(0, abs=1e-9) and got[1] == pytest.approx(1)


def test_logistic_minimises_penalised_loss(frame):
    scaled = predict.standard_scale(frame)
    model = predict.fit_rain_logistic(scaled)
    train = scaled.where("is_train").toPandas()
    x = np.c_[train.TMAX_z, train.TMIN_z]
    y = train.label.values
    fitted = model.first()
    w, b = np.array([fitted["w1"], fitted["w2"]]), fitted["w0"]
    p = 1 / (1 + np.exp(-(x @ w + b)))
    # Gradient of 0.5 |w|^2 + summed log loss vanishes at the optimum.
    np.testing.assert_allclose(w + x.T @ (p - y), 0, atol=1e-9)
    assert np.sum(p - y) == pytest.approx(0, abs=1e-9)
    scored = predict.predict_rain_logistic(model, scaled)
    ours = scored.where("is_train").toPandas()["prediction"].values
    np.testing.assert_array_equal(ours, (p > 0.5).astype(int))
    assert predict.fit_rain_logistic(scaled.where("label > 1")).isEmpty()


def test_naive_bayes(frame):
    scaled = predict.standard_scale(frame)
    model = predict.fit_rain_gaussian_nb(scaled)
    got = predict.predict_rain_gaussian_nb(model, scaled).toPandas()
    train = got[got.is_train]
    scores = []
    for k in (0, 1):
        part = train[train.label == k][["TMAX_z", "TMIN_z"]].values
        var = part.var(axis=0) + 1e-9 * train[["TMAX_z", "TMIN_z"]].values.var(axis=0).max()
        x = got[["TMAX_z", "TMIN_z"]].values
        scores.append(np.log(len(part) / len(train)) - 0.5 * np.sum(
            np.log(2 * np.pi * var) + (x - part.mean(axis=0)) ** 2 / var, axis=1))
    np.testing.assert_array_equal(got["prediction"].values, (scores[1] > scores[0]).astype(int))


def test_naive_bayes_single_class(frame):
    scaled = predict.standard_scale(frame).where("label = 1")
    model = predict.fit_rain_gaussian_nb(scaled)
    got = predict.predict_rain_gaussian_nb(model, scaled)
    assert rows(got.select("prediction").distinct()) == [(1,)]


def test_matrix_and_report(spark):
    scored = spark.createDataFrame(
        [("S", 1, 1)] * 3 + [("S", 1, 0)] + [("S", 0, 1)] * 2 + [("T", 0, 0)],
        "sourceId string, label int, prediction int")
    matrix = predict.confusion_matrix(scored)
    assert rows(matrix.where("sourceId = 'S'"), "label", "prediction", "n") == [
        (0, 0, 0), (0, 1, 2), (1, 0, 1), (1, 1, 3)]
    report = {r["class"]: r for r in predict.classification_report(matrix).where(
        "sourceId = 'S'").collect()}
    assert report["1"]["precision"] == 0.6 and report["1"]["recall"] == 0.75
    assert report["0"]["f1"] == 0.0 and report["0"]["support"] == 2
    assert report["accuracy"]["f1"] == 0.5
    assert report["macro avg"]["recall"] == 0.375
    assert report["weighted avg"]["precision"] == pytest.approx(0.4)


def weather(day, element, value, offset="PT6H"):
    return ("S", day, offset, element, value, "")


def test_features(obs):
    df = obs([
        weather("2021-01-01", MAX_TEMPERATURE, "5"), weather("2021-01-01", MIN_TEMPERATURE, "-2"),
        weather("2021-01-01", PRECIPITATION, "0"), weather("2021-01-02", MAX_TEMPERATURE, "5"),
        # The smaller offset holds no number, so it does not count.
        weather("2021-01-01", PRECIPITATION, "x", "PT0H"),
    ])
    got = predict.rain_label(predict.weather_features(df))
    assert rows(got, "TMAX", "TMIN", "RAIN", "label") == [(5.0, -2.0, 0.0, 0)]
    assert predict.precipitation_features(df).count() == 1
    with pytest.raises(PySparkException):
        predict.weather_features(df.union(df)).collect()


def test_element_correlation(obs):
    df = obs([weather(f"2021-01-0{d}", e, str(v)) for d in (1, 2, 3)
              for e, v in (("x", d), ("y", 2 * d + 1))])
    got = predict.element_correlation(df, "x", "y").first()
    assert got["n"] == 3 and got["correlation"] == pytest.approx(1)
    assert (got["slope"], got["intercept"]) == (pytest.approx(2), pytest.approx(1))


def constant_features(spark):
    """One station whose features never change; it rains in a third of the rows."""
    return spark.createDataFrame(
        [("S", f"2021-01-{i + 1:02}", 30.0, -24.0, 3.0 * (i % 3 == 0), int(i % 3 == 0), i < 24) for i in range(30)],
        "sourceId string, date string, TMAX double, TMIN double, PRCP double, label int, is_train boolean")


def test_naive_bayes_of_constant_features_goes_by_the_priors(spark):
    scaled = predict.standard_scale(constant_features(spark))
    got = predict.predict_rain_gaussian_nb(predict.fit_rain_gaussian_nb(scaled), scaled)
    assert rows(got.select("prediction").distinct()) == [(0,)]
    matrix = predict.confusion_matrix(got)
    assert rows(matrix, "label", "prediction", "n") == [(0, 0, 20), (0, 1, 0), (1, 0, 10), (1, 1, 0)]


def test_linear_of_constant_and_collinear_features(spark):
    constant = constant_features(spark)
    model = predict.fit_precipitation_linear(constant)
    assert rows(model, "n", "coef_tmax", "coef_tmin", "intercept") == [(24, 0.0, 0.0, 1.0)]
    scored = predict.predict_precipitation(model, constant)
    assert rows(scored.select("predicted", "will_rain").distinct()) == [(1.0, True)]
    line = constant.withColumn("TMAX", F.dayofmonth("date") * 0.1).withColumn(
        "TMIN", F.col("TMAX") * 2 - 3).withColumn("PRCP", 7 + F.col("TMAX") * 10)
    got = predict.fit_precipitation_linear(line).first()
    pdf = line.where("is_train").toPandas()
    centred = pdf[["TMAX", "TMIN"]].values - pdf[["TMAX", "TMIN"]].values.mean(axis=0)
    expected = np.linalg.lstsq(centred, pdf.PRCP.values - pdf.PRCP.mean(), rcond=1e-8)[0]
    np.testing.assert_allclose([got["coef_tmax"], got["coef_tmin"]], expected, rtol=1e-8)
