import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationloom.operators import outliers
from stationloom.operators.quantiles import Quantile, aggregate_groups
from stationloom.operators.attach import attach
from stationloom.schema import SERIES


def values(obs, numbers):
    days = pd.date_range("2021-01-01", periods=len(numbers))
    return obs([(str(d.date()), None if v is None else str(v))
                for d, v in zip(days, numbers)])


def test_summary(obs):
    got = outliers.iqr_summary(values(obs, [1, 2, 3, 4, "x"]), SERIES).first()
    assert (got["Q1"], got["Q3"], got["IQR"]) == (1.75, 3.25, 1.5)
    assert (got["lower_inner"], got["upper_outer"]) == (-0.5, 7.75)
    assert outliers.iqr_summary(values(obs, [1, 2, 3, 4])).first()["Q1"] == 1.75


def test_flags(obs):
    df = values(obs, [0, 1, 2, 3, 4, 100])
    assert outliers.count_outliers(df, extreme=True).first()["outliers"] == 1
    flagged = outliers.flag_outliers(values(obs, [1, 2, 3, 4, 20, None]))
    assert rows(flagged.where("is_outlier"), "value") == [("20",)]
    assert flagged.where("is_outlier IS NULL").isEmpty()
    cleaned = outliers.null_outliers(values(obs, [1, 2, 3, 4, 20]))
    assert cleaned.where("value IS NULL").count() == 1 and cleaned.count() == 5


def test_whiskers():
    assert outliers.resolve_whisker() == 1.5
    assert outliers.resolve_whisker(extreme=True) == 3.0
    assert outliers.resolve_whisker(extreme=True, instance=1.5) == 1.5
    assert outliers.resolve_whisker(2.0, instance=1.5) == 2.0
    for bad in ({"whisker": 0}, {"whisker": -1.0}, {"instance": 2.0}):
        with pytest.raises(ValueError):
            outliers.resolve_whisker(**bad)


def test_months_without_outliers(obs):
    data = [(d, v) for i, d in enumerate(
        ("2021-01-31", "2021-02-28", "2021-03-31", "2021-04-30"))
        for v in ("10", str(100 + i))]
    df = obs(data)
    every = outliers.outliers_per_month(df, include_empty_months=True)
    assert rows(every, "outliers_removed", "total_count") == [(0, 2)] * 4
    assert outliers.outliers_per_month(df).isEmpty()
    stats = outliers.stats_with_without_outliers(df, "mean")
    assert {"mean_with_outliers", "mean_without_outliers", "outliers_removed"} <= set(
        stats.columns)
    assert stats.count() == 4
    with pytest.raises(ValueError):
        outliers.stats_with_without_outliers(df, "max")


def test_monthly_outliers_count_null_rows(obs):
    numbers = [1, 2, 1, 2, 1, 2, 1, 2, 500, None]
    df = values(obs, numbers)
    got = outliers.outliers_per_month(df).first()
    assert (got["outliers_removed"], got["total_count"]) == (1, 10)
    assert got["outlier_percentage"] == 10.0
    stat = outliers.stats_with_without_outliers(df, "median").first()
    assert (stat["median_with_outliers"], stat["median_without_outliers"]) == (2.0, 1.5)
    per_month = outliers.outliers_per_month(df, include_empty_months=True)
    assert rows(outliers.outliers_per_year(per_month), "year", "outliers_removed") == [(2021, 1)]
    months = dict(rows(outliers.mean_outliers_by_month(per_month), "month", "mean_outliers"))
    assert months[1] == 1.0 and months[2] is None and len(months) == 12
    box = outliers.year_box_summary(df, 2021).first()
    assert box["extreme_count"] == 1 and box["mean_without_outliers"] == 1.5


def test_month_without_numbers_has_no_statistics(obs):
    assert outliers.stats_with_without_outliers(values(obs, ["x", "y"]), "std").isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_brackets_give_exact_quantiles(spark, seed):
    random = np.random.default_rng(seed)
    n = 6000
    key = np.where(random.random(n) < 0.4, 0, random.integers(1, 60, n))
    value = np.round(random.lognormal(1, 2, n), 2) * random.choice([-1, 0, 1, 1], n)
    pdf = pd.DataFrame({"k": key, "v": value})
    pdf.loc[random.random(n) < 0.05, "v"] = None
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    wanted = [Quantile("q1", "v", 0.25), Quantile("med", "v", 0.5), Quantile("q3", "v", 0.75)]
    got = aggregate_groups(df, ["k"], wanted, [F.avg("v").alias("mean")], accuracy=40)
    got = got.toPandas().set_index("k").sort_index()
    expected = pdf.groupby("k")["v"].quantile([0.25, 0.5, 0.75]).unstack()
    np.testing.assert_allclose(got[["q1", "med", "q3"]].values, expected.values, rtol=1e-12)
    joined = attach(df, spark.createDataFrame(got.reset_index()), ["k"], ["med"])
    assert joined.count() == n
    assert joined.where("med IS NULL").isEmpty()


def test_null_key_and_identical_rows(spark):
    df = spark.createDataFrame([(None, 1.0)] * 200 + [("a", 2.0)] * 3, "k string, v double")
    table = aggregate_groups(df, ["k"], [Quantile("m", "v", 0.5)], accuracy=20)
    joined = attach(df, table, ["k"], ["m"])
    assert joined.where("m = v").count() == 203


def test_value_on_a_fence_is_not_outside(obs):
    # quartiles 0.6 and 0.7, so the outer fence is 1, in doubles 0.9999999999999999
    fence = [0.6, 0.6, 0.7, 0.7, 1.0]
    assert outliers.count_outliers(values(obs, fence), extreme=True).first()["outliers"] == 0
    assert outliers.count_outliers(values(obs, [*fence[:4], 1.01]), extreme=True).first()["outliers"] == 1
    monthly = outliers.outliers_per_month(values(obs, fence), include_empty_months=True)
    assert rows(monthly, "outliers_removed") == [(0,)]
