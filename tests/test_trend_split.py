import math
import random
from itertools import combinations
from statistics import NormalDist, median

import pytest
from pyspark.sql import functions as F

from stationloom.operators import extremes, predict


@pytest.mark.parametrize("values", [[1, 2, 4, 4, 9, 7, 12], [5, 5, 5], [3], [9, 7, 8, 2, 1, 1], [2, 1]])
def test_trend_equals_the_textbook(obs, values):
    df = obs([(f"{2000 + 2 * i}-06-01", float(v)) for i, v in enumerate(values)], value_type="double")
    got = extremes.robust_trend(df).first()
    years = [2000 + 2 * i for i in range(len(values))]
    pairs = list(combinations(range(len(values)), 2))
    s = sum((values[j] > values[i]) - (values[j] < values[i]) for i, j in pairs)
    n = len(values)
    spread = n * (n - 1) * (2 * n + 5) - sum(t * (t - 1) * (2 * t + 5) for t in (values.count(v) for v in set(values)))
    z = 0 if spread <= 0 or s == 0 else (s - math.copysign(1, s)) / math.sqrt(spread / 18)
    assert (got["years"], got["s"]) == (n, s)
    assert got["z"] == pytest.approx(z)
    assert got["p_value"] == pytest.approx(2 * (1 - NormalDist().cdf(abs(z))), abs=1e-6)
    if not pairs:
        assert got["slope"] is None and got["intercept"] is None
        return
    slope = median((values[j] - values[i]) / (years[j] - years[i]) for i, j in pairs)
    assert got["slope"] == pytest.approx(slope)
    assert got["intercept"] == pytest.approx(median(v - slope * y for v, y in zip(values, years, strict=True)))


def test_trend_passes_over_years_without_values_and_empty_tables(obs):
    df = obs([("2000-01-01", 1.0), ("2001-01-01", None), ("2003-01-01", 4.0)], value_type="double")
    got = extremes.robust_trend(df).first()
    assert (got["years"], got["s"], got["slope"]) == (2, 1, 1.0)
    assert extremes.robust_trend(df.where("false")).count() == 0


@pytest.mark.parametrize("percent", [0, 37, 80, 100])
def test_exact_sizes(spark, percent):
    sizes = {"a": 1, "b": 7, "c": 1000, "d": 4, None: 33}
    df = spark.createDataFrame([(s, i) for s, n in sizes.items() for i in range(n)], "sourceId string, day int")
    got = predict.exact_train_test_split(df, F.concat_ws("|", "sourceId", "day"), percent)
    counts = {r["sourceId"]: r["n"] for r in got.groupBy("sourceId").agg(F.count_if("is_train").alias("n")).collect()}
    assert counts == {s: n * percent // 100 for s, n in sizes.items()}
    assert got.columns == ["sourceId", "day", "is_train"]


def test_rows_of_one_key_stay_together(spark):
    draw = random.Random(5)
    days = [draw.choice([0, 0, 0, *range(50)]) for _ in range(400)]
    df = spark.createDataFrame([("a", d) for d in days], "sourceId string, day int")
    got = predict.exact_train_test_split(df, F.col("day"), 80).groupBy("day").agg(
        F.count_distinct("is_train").alias("sides"), F.count_if("is_train").alias("n")).collect()
    assert {r["sides"] for r in got} == {1}
    assert sum(r["n"] for r in got) <= 320
    assert predict.exact_train_test_split(df.where("false"), F.col("day")).count() == 0
    with pytest.raises(ValueError):
        predict.exact_train_test_split(df, F.col("day"), 101)
