from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from stationloom.operators import decompose, timeseries

GAPS = [None, 1.0] + [None] * 5 + [7.0] + [None] * 4


def series(spark, numbers, days=None, source="S", element="e"):
    start = datetime(2021, 1, 28)
    days = range(len(numbers)) if days is None else days
    data = [(source, element, start + timedelta(days=d), v) for d, v in zip(days, numbers)]
    return spark.createDataFrame(
        data, "sourceId string, elementId string, referenceTime timestamp, value double")


def filled(df):
    return [r["value"] for r in df.orderBy("sourceId", "referenceTime").collect()]


def test_limited(spark):
    got = filled(timeseries.interpolate_time_limited(series(spark, GAPS), 3))
    assert got == [None, 1, 2, 3, 4, None, None, 7, 7, 7, 7, None]


def test_both_directions(spark):
    expected = [1, 1, 2, 3, 4, 5, 6, 7, 7, 7, 7, 7]
    for fill in (timeseries.interpolate_time, timeseries.impute):
        assert filled(fill(series(spark, GAPS))) == expected
    assert filled(decompose.seasonal_impute(series(spark, GAPS), "recomposed")) == expected


def test_time_weighting_and_all_null(spark):
    assert filled(timeseries.interpolate_time(series(spark, [0.0, None, 9.0], [0, 1, 3]))) == [0, 3, 9]
    assert filled(timeseries.interpolate_time(series(spark, [None, None]))) == [None, None]


def test_forward_backward(spark):
    assert filled(timeseries.fill_forward_backward(series(spark, GAPS))) == (
        [1] * 7 + [7] * 5)


def test_against_pandas(spark):
    random = np.random.default_rng(3)
    numbers = np.where(random.random(300) < 0.5, np.nan, random.normal(size=300))
    days = np.sort(random.choice(600, 300, replace=False))
    df = series(spark, [None if np.isnan(v) else float(v) for v in numbers],
                [int(d) for d in days])
    index = pd.DatetimeIndex([datetime(2021, 1, 28) + timedelta(days=int(d)) for d in days])
    s = pd.Series(numbers, index=index)
    for got, expected in (
        (timeseries.interpolate_time(df), s.interpolate("time", limit_direction="both")),
        (timeseries.interpolate_time_limited(df, 2), s.interpolate("time", limit=2)),
        (timeseries.fill_forward_backward(df), s.ffill().bfill()),
    ):
        np.testing.assert_allclose(
            np.array(filled(got), dtype=float), expected.values, atol=1e-9)


def test_bad_arguments(spark):
    df = series(spark, GAPS)
    for call in (
        lambda: timeseries.interpolate_time_limited(df, 0),
        lambda: decompose.seasonal_impute(df, "other"),
        lambda: decompose.seasonal_decompose(df, model="other"),
        lambda: decompose.seasonal_decompose(df, period=1),
        lambda: decompose.seasonal_decompose(df, period=7, strict=True),
    ):
        with pytest.raises(ValueError):
            call()


def test_a_dense_series_leaves_others_alone(spark):
    sparse = series(spark, GAPS)
    dense = spark.range(5000).select(
        F.lit("dense").alias("sourceId"), F.lit("e").alias("elementId"),
        F.timestamp_seconds(F.lit(1609459200) + F.col("id") * 30).alias("referenceTime"),
        F.when(F.col("id") % 7 == 0, F.col("id").cast("double")).alias("value"))
    both = sparse.select("sourceId", "elementId", "referenceTime", "value").unionByName(dense)
    got = timeseries.interpolate_time_limited(both, 3)
    assert filled(got.where("sourceId <> 'dense'")) == [
        None, 1, 2, 3, 4, None, None, 7, 7, 7, 7, None]
    line = got.where("sourceId = 'dense'").where("value IS NOT NULL")
    at = (F.unix_timestamp("referenceTime") - 1609459200) / 30
    assert line.where((F.abs(F.col("value") - at) > 1e-6) & (at < 4998)).isEmpty()
    assert line.count() == 5000 - 3 * (5000 // 7)


def test_tied_times_are_refused(spark):
    df = series(spark, GAPS)
    for fill in (timeseries.interpolate_time, timeseries.fill_forward_backward):
        with pytest.raises(PySparkException):
            fill(df.union(df)).collect()


def test_decomposition_refuses_bad_values(spark):
    with pytest.raises(PySparkException):
        decompose.seasonal_decompose(series(spark, [1.0] * 9 + [None]), period=5).collect()
    with pytest.raises(PySparkException):
        decompose.seasonal_decompose(
            series(spark, [1.0] * 9 + [0.0]), 5, "multiplicative").collect()


def test_seasonal_fill_follows_the_season(spark):
    x = [float(10 * (i % 6) + i / 10) for i in range(60)]
    gaps = [None if 22 <= i < 32 else v for i, v in enumerate(x)]
    got = filled(decompose.seasonal_impute(series(spark, gaps), period=6))
    assert [g for g, v in zip(got, gaps) if v is not None] == [v for v in gaps if v is not None]
    line = filled(timeseries.interpolate_time(series(spark, gaps)))
    off = [sum(abs(a - b) for a, b in zip(f, x)) for f in (got, line)]
    assert off[0] < off[1] / 2


def test_rows_without_element_are_left_out(obs):
    df = obs([("S", "2021-01-01", "PT0H", None, "1", ""), ("S", "2021-01-01", "PT0H", "a", "2", "")])
    assert rows(timeseries.observation_grid(df), "elementId", "value") == [("a", 2.0)]


def test_grid_and_imputation(obs):
    df = obs([
        ("S", "2021-01-01", "PT0H", "a_temperature", "1", "degC"),
        ("S", "2021-01-02", "PT6H30M", "a_temperature", "x", "degC"),
        ("S", "2021-01-03", "PT0H", "a_temperature", "4", "degC"),
        ("S", "2021-01-02", "PT0H", "wind_speed", "2.00049", "m/s"),
    ])
    assert timeseries.observation_grid(df).count() == 8
    got = timeseries.impute_observations(df).orderBy("elementId", "referenceTime").collect()
    assert [r["timeOffset"] for r in got[:4]] == ["PT0H", "PT0H", "PT6H30M", "PT0H"]
    assert [r["value"] for r in got] == [1.0, 2.5, 2.906, 4.0] + [2.0] * 4
    assert [r["unit"] for r in got] == ["degC"] * 4 + ["m/s"] * 4
    assert [r["is_imputed"] for r in got] == [False, True, True, False, True, False, True, True]


def test_grid_keeps_observed_offsets(obs):
    df = obs([("S", "2021-01-01", "PT18H", "a", "1", ""),
              ("S", "2021-01-01", "PT0H", "b", "1", "")])
    kept = timeseries.impute_observations(df, keep_observed_offsets=True)
    assert rows(kept.where("NOT is_imputed"), "elementId", "timeOffset") == [
        ("a", "PT18H"), ("b", "PT0H")]


def test_duplicate_cell_is_an_error(obs):
    df = obs([("S", "2021-01-01", "PT0H", "a", "1", "")] * 2)
    with pytest.raises(PySparkException):
        timeseries.observation_grid(df).collect()


def reference_decomposition(x, period, additive):
    """Plain numpy form used to check the distributed one."""
    n, half = len(x), period // 2
    weights = np.ones(period) if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5]
    trend = np.full(n, np.nan)
    trend[half:n - half] = np.convolve(x, weights / period, "valid")
    first, last = half, n - 1 - half
    for lo, hi, where in (
        (first, min(first + period, last), np.arange(first)),
        (max(first, last - period), last, np.arange(last + 1, n)),
    ):
        slope, level = np.polyfit(np.arange(lo, hi), trend[lo:hi], 1)
        trend[where] = slope * where + level
    detrended = x - trend if additive else x / trend
    means = np.array([detrended[i::period].mean() for i in range(period)])
    means = means - means.mean() if additive else means / means.mean()
    seasonal = np.tile(means, n // period + 1)[:n]
    return trend, seasonal, (detrended - seasonal if additive else detrended / seasonal)


@pytest.mark.parametrize("period, model, block", [
    (7, "additive", 100_000), (12, "additive", 30), (12, "multiplicative", 30),
])
def test_decomposition(spark, period, model, block):
    random = np.random.default_rng(1)
    x = 50 + np.arange(150) * 0.1 + 5 * np.sin(np.arange(150) * 2 * np.pi / period)
    x = x + random.normal(size=150)
    df = series(spark, [float(v) for v in x])
    got = decompose.seasonal_decompose(
        df, period, model, block_rows=block).orderBy("referenceTime").toPandas()
    parts = reference_decomposition(x, period, model == "additive")
    for name, expected in zip(("trend", "seasonal", "resid"), parts):
        np.testing.assert_allclose(got[name].values, expected, rtol=1e-9, atol=1e-9)
    whole = got["trend"] + got["resid"] + got["seasonal"] if model == "additive" else (
        got["trend"] * got["resid"] * got["seasonal"])
    np.testing.assert_allclose(whole.values, x)


def test_short_series_has_no_decomposition(spark):
    got = decompose.seasonal_decompose(series(spark, [1.0] * 5), period=7)
    assert got.where("trend IS NOT NULL").isEmpty() and got.count() == 5
    assert got.select(F.count("value")).first()[0] == 5


def monotone(x, points):
    """Plain monotone cubic through ``(at, value)`` points, the outer two optional."""
    (x1, y1), (x2, y2) = points[1], points[2]
    h, d = x2 - x1, (y2 - y1) / (x2 - x1)

    def slope(ha, hb, da, db):
        return 0 if da * db <= 0 else 3 * (ha + hb) / ((2 * hb + ha) / da + (hb + 2 * ha) / db)

    m1 = m2 = d
    if points[0]:
        h0 = x1 - points[0][0]
        m1 = slope(h0, h, (y1 - points[0][1]) / h0, d)
    if points[3]:
        h2 = points[3][0] - x2
        m2 = slope(h, h2, d, (points[3][1] - y2) / h2)
    t = (x - x1) / h
    return ((2 * t**3 - 3 * t**2 + 1) * y1 + (t**3 - 2 * t**2 + t) * h * m1
            + (3 * t**2 - 2 * t**3) * y2 + (t**3 - t**2) * h * m2)


def splined(numbers, days, period, limit):
    """Plain version of the seasonal spline; the season from a plain decomposition."""
    valid = [i for i, v in enumerate(numbers) if v is not None]
    if not valid:
        return numbers
    x = np.array(days, dtype=float)
    whole = np.interp(x, x[valid], [numbers[i] for i in valid])
    n, half, season = len(numbers), period // 2, np.zeros(period)
    if n >= 2 * period:
        weights = np.ones(period) if period % 2 else np.array([0.5] + [1] * (period - 1) + [0.5])
        trend = np.full(n, np.nan)
        trend[half:n - half] = np.convolve(whole, weights / period, "valid")
        at = np.arange(n)
        front = at[half:min(half + period, n - 1 - half)]
        back = at[max(half, n - 1 - half - period):n - 1 - half]
        trend[:half] = np.polyval(np.polyfit(front, trend[front], 1), at[:half])
        trend[n - half:] = np.polyval(np.polyfit(back, trend[back], 1), at[n - half:])
        figures = np.array([np.mean((whole - trend)[k::period]) for k in range(period)])
        season = figures - figures.mean()
    rest = [None if v is None else v - season[i % period] for i, v in enumerate(numbers)]
    out = []
    for i, v in enumerate(numbers):
        lower, upper = [k for k in valid if k < i], [k for k in valid if k > i]
        if v is not None:
            out.append(v)
        elif not lower or not upper:
            out.append(rest[(upper or lower[::-1])[0]] + season[i % period])
        elif upper[0] - lower[-1] - 1 <= limit:
            out.append(float(whole[i]))
        else:
            near = [lower[-2] if lower[1:] else None, lower[-1], upper[0], upper[1] if upper[1:] else None]
            out.append(monotone(x[i], [k is not None and (x[k], rest[k]) for k in near]) + season[i % period])
    return out


@pytest.mark.parametrize("period, limit", [(7, 0), (12, 2), (200, 3)])
def test_seasonal_spline(spark, period, limit):
    """Days over two years, so that second points lie in other hours and other years."""
    random = np.random.default_rng(period)
    days = sorted(int(d) for d in random.choice(700, 90, replace=False))
    numbers = [float(v) if keep else None for v, keep in zip(random.normal(size=90), random.random(90) < 0.35)]
    numbers[20:34] = [None] * 14
    short = [None, 2.0, None, None, 5.0, None]
    cases = {"a": (numbers, days), "b": (short, days[:6]), "c": ([None] * 5, days[:5]), "d": ([None, 4.0, None], days[:3])}
    df = None
    for name, (values, at) in cases.items():
        own = series(spark, values, at, source=name)
        df = own if df is None else df.union(own)
    got = {}
    for r in timeseries.impute(df, method="seasonal_spline", period=period, limit=limit).orderBy("referenceTime").collect():
        got.setdefault(r["sourceId"], []).append(r["value"])
    for name, (values, at) in cases.items():
        assert got[name] == pytest.approx(splined(values, at, period, limit), abs=1e-9)


def test_spline_stays_between_its_points(spark):
    numbers = [0.0, 1.0, None, None, None, 9.0, 9.0, None, None, 9.0, 2.0, None, None, 1.0]
    got = filled(decompose.seasonal_impute(series(spark, numbers), "spline", 30))
    assert got[2:5] == sorted(got[2:5]) and 1 < got[2] and got[4] < 9
    assert got[7:9] == [9.0, 9.0] and all(1 < v < 2 for v in got[11:13])
    with pytest.raises(ValueError):
        decompose.seasonal_impute(series(spark, numbers), "spline", 1)
    with pytest.raises(ValueError):
        timeseries.impute(series(spark, numbers), method="other")


def test_second_points_within_hours(spark):
    """Many rows an hour over some hours: both points to each side against a plain search."""
    random = np.random.default_rng(5)
    minutes = sorted(int(m) for m in random.choice(900, 120, replace=False))
    values = [float(m) if random.random() < 0.2 else None for m in minutes]
    df = spark.createDataFrame(
        [("s", "e", datetime(2020, 12, 31, 20) + timedelta(minutes=m), v) for m, v in zip(minutes, values)],
        "sourceId string, elementId string, referenceTime timestamp, value double")
    valid = [i for i, v in enumerate(values) if v is not None]
    for r in timeseries.with_position(df, second=True).collect():
        i = r["position"]
        below, above = [k for k in valid if k <= i][::-1], [k for k in valid if k >= i]
        for side, own in (("before", below), ("after", above)):
            if not own:
                assert r[side] is None
                continue
            assert (r[side]["row"], r[side]["value"]) == (own[0], values[own[0]])
            second = own[1] if own[1:] else None
            assert (r[side]["row2"], r[side]["value2"]) == (second, None if second is None else values[second])


@pytest.mark.parametrize("second", [False, True])
def test_neighbours_come_from_one_order(spark, capsys, second):
    """Rows of a task are sorted once, whatever is asked about them, and are not dealt again for the join."""
    df = spark.createDataFrame([], "sourceId string, elementId string, referenceTime timestamp, value double")
    timeseries.with_position(df, second=second).explain()
    plan = capsys.readouterr().out
    # rows (also for the summary), hours and years within each of the two uses, hours for the join
    assert plan.count("Sort [") <= 9
    assert plan.count("Exchange hashpartitioning") <= 9


def test_spline_places_rows_once(spark, capsys):
    """Neighbours are found once and kept; what reads them has the windows of the seasonal figures only."""
    timeseries.impute(series(spark, GAPS), method="seasonal_spline", period=4).explain()
    assert 0 < capsys.readouterr().out.count("Window [") <= 4


@pytest.mark.parametrize("second", [False, True])
def test_series_and_times_without_name(spark, second):
    data = [(s, e, t, v) for s in (None, "a") for e in (None, "b") for t, v in
            (("2020-01-01 00:00", 1.0), ("2020-01-01 00:30", None), ("2021-05-01 00:00", 3.0), ("2021-05-01 07:00", None))]
    df = spark.createDataFrame(data, "sourceId string, elementId string, at string, value double")
    df = df.withColumn("referenceTime", F.to_timestamp("at")).drop("at")
    got = timeseries.with_position(df, second=second).collect()
    assert len(got) == 16
    for r in got:
        assert r["series_rows"] == 4
        assert (r["before"]["row"], r["after"] and r["after"]["row"]) == [(0, 0), (0, 2), (2, 2), (2, None)][r["position"]]
