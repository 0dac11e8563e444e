from datetime import date

import pytest

from conftest import rows
from stationloom.operators import change, extremes, select, stats

JAN_FEB = [(f"2021-0{m}-0{d}", str(4 * (m - 1) + d)) for m in (1, 2) for d in (1, 2, 3, 4)]
MONTH_ENDS = [
    "01-31", "02-28", "03-31", "04-30", "05-31", "06-30", "07-31", "08-31", "09-30",
    "10-31", "11-30", "12-31",
]
TWO_YEARS = [(f"{2020 + i // 12}-{MONTH_ENDS[i % 12]}", str(i + 1)) for i in range(24)]


def test_month_stats_uses_population_std(obs):
    got = stats.month_stats(obs(JAN_FEB), "2021-02").first()
    assert (got["mean"], got["median"]) == (6.5, 6.5)
    assert got["std"] == pytest.approx(1.25 ** 0.5)


def test_month_stats_empty(obs):
    assert stats.month_stats(obs(JAN_FEB), "2022-02").isEmpty()
    with pytest.raises(ValueError):
        stats.month_stats(obs(JAN_FEB), "2022-02", strict=True)


def test_monthly_stats_uses_sample_std(obs):
    got = rows(stats.monthly_stats(obs(JAN_FEB)), "year_month", "mean", "median", "std")
    std = pytest.approx((5 / 3) ** 0.5)
    assert got == [("2021-01", 2.5, 2.5, std), ("2021-02", 6.5, 6.5, std)]


def test_monthly_std_of_one_value_is_null(obs):
    assert stats.monthly_stats(obs(JAN_FEB[:1])).first()["std"] is None


@pytest.mark.parametrize("aggregate, first", [
    ("mean", 6.5), ("sum", 78.0), ("median", 6.5), ("std", 13 ** 0.5),
])
def test_yearly(obs, aggregate, first):
    got = rows(stats.yearly(obs(TWO_YEARS), aggregate), "year", "value")
    assert got[0] == (2020, pytest.approx(first))
    assert len(got) == 2


def test_yearly_single_year_and_errors(obs):
    df = obs(TWO_YEARS)
    assert rows(stats.yearly(df, year=2021), "year", "value") == [(2021, 18.5)]
    with pytest.raises(ValueError):
        stats.yearly(df, "mode")
    with pytest.raises(ValueError):
        stats.yearly(df, year=1999, strict=True)
    with pytest.raises(ValueError):
        select.yearly_raw(df, "rain", None)
    with pytest.raises(ValueError):
        select.yearly_raw(df, "rain", 1999, strict=True)
    assert select.yearly_raw(df, "rain", 2020).count() == 12


def test_min_offset(obs):
    data = [("S1", "2021-01-01", o, "rain", "1", "mm") for o in
            ("PT5H", "PT2H", "PT10H", "BAD")]
    df = obs(data)
    assert select.min_time_offset(df).first()["timeOffset"] == "PT2H"
    assert rows(select.keep_min_offset(df), "timeOffset") == [("PT2H",)]
    with pytest.raises(ValueError):
        select.min_time_offset(df, "snow", strict=True)
    only_bad = df.where("timeOffset = 'BAD'")
    with pytest.raises(ValueError):
        select.min_time_offset(only_bad, strict=True)


def test_equal_hours_resolve_by_text(obs):
    data = [("S1", "2021-01-01", o, "rain", "1", "mm") for o in ("PT6H", "PT06H")]
    assert select.min_time_offset(obs(data)).first()["timeOffset"] == "PT06H"


def test_offset_of_valueless_rows_counts(obs):
    data = [("S1", "2021-01-01", "PT0H", "rain", "x", "mm"),
            ("S1", "2021-01-01", "PT6H", "rain", "1", "mm")]
    df = obs(data)
    assert stats.monthly_stats(df).isEmpty()
    assert stats.monthly_stats(df, time_offset="PT6H").count() == 1
    assert stats.monthly_stats(df, time_offset=select.ALL_OFFSETS).count() == 1


def test_rows_without_time_are_left_out(obs):
    df = obs([("bad", "7"), ("2021-01-01", "1")])
    assert rows(stats.monthly_stats(df), "year_month", "mean") == [("2021-01", 1.0)]
    assert rows(stats.yearly(df), "year", "value") == [(2021, 1.0)]


def test_climatology(obs):
    df = obs([(f"2021-{MONTH_ENDS[i]}", str(i + 1)) for i in range(6)])
    got = rows(stats.climatology(df), "month", "month_name", "value")
    assert [g[1] for g in got] == ["Jan", "Feb", "Mar", "Apr", "May", "Jun"]
    assert [g[2] for g in got] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert rows(stats.climatology(df, "std"), "value")[0] == (0.0,)
    with pytest.raises(ValueError):
        stats.climatology(df, "max")


def test_climatology_keeps_valueless_month_and_cleans_whole_series(obs):
    days = [(f"2021-01-{d:02d}", str(d % 3)) for d in range(1, 20)]
    df = obs([*days, ("2021-02-01", "1000"), ("2021-03-01", "x")])
    got = dict(rows(stats.climatology(df, remove_outliers=True), "month", "value"))
    assert got[2] is None and got[3] is None
    assert dict(rows(stats.climatology(df), "month", "value"))[2] == 1000.0


def test_day_in_history_and_counts(obs):
    df = obs([("2020-05-17", "2"), ("2021-05-17", "4"), ("2021-05-18", "9")])
    got = stats.day_in_history(df, 5, 17, "rain", "PT1H").first()
    assert got["mean"] == 3.0
    assert rows(stats.count_by_source(df)) == [("S1", 3)]


def test_percent_change(obs):
    df = obs([("2021-01-01", "1"), ("2021-01-02", "2"), ("2021-01-03", "3")])
    got = rows(change.percent_change(df, frequency="D"), "period", "percent_change")
    assert got == [(date(2021, 1, 2), 100.0), (date(2021, 1, 3), 50.0)]
    inside = change.percent_change(df, frequency="D", start="2021-01-02", end="2021-01-03")
    assert inside.count() == 1
    with pytest.raises(ValueError):
        change.percent_change(df, frequency="W")
    with pytest.raises(ValueError):
        change.percent_change(df, statistic="sum")


def test_percent_change_over_gap_and_zero_base(obs):
    df = obs([("2021-01-01", "1"), ("2021-01-02", "0"), ("2021-01-03", "x"),
              ("2021-01-05", "4"), ("2021-02-01", "0"), ("2021-02-02", "0")])
    got = rows(change.percent_change(df, frequency="D"), "period", "percent_change")
    assert got == [(date(2021, 1, 2), -100.0), (date(2021, 1, 5), float("inf")),
                   (date(2021, 2, 1), -100.0)]


def test_period_labels(obs):
    df = obs([("2020-02-03", "1"), ("2020-02-04", "3")])
    assert change.period_stat(df, "std", "ME").first()["period"] == date(2020, 2, 29)
    last = change.period_stat(df, "median", "YE").first()
    assert (last["period"], last["value"]) == (date(2020, 12, 31), 2.0)


def test_extremes(obs):
    df = obs([("2018-03-01", "5"), ("2018-02-01", "5"), ("2018-01-01", "1"),
              ("2020-07-01", "9"), ("2020-08-01", "x")])
    top = extremes.annual_extreme_rows(df, "max")
    assert [(r["year"], r["referenceTime"].month, r["value"]) for r in
            top.orderBy("year").collect()] == [(2018, 2, 5.0), (2020, 7, 9.0)]
    years = rows(extremes.annual_extreme(df, "max"), "period", "value")
    assert years == [(date(2018, 12, 31), 5.0), (date(2019, 12, 31), None),
                     (date(2020, 12, 31), 9.0)]
    frequency = dict(rows(extremes.extreme_month_frequency(top), "month", "years"))
    assert len(frequency) == 12 and frequency[2] == 1 and frequency[1] == 0
    assert extremes.modal_extreme_month(top).first()["month"] == 2
    ends = extremes.trend_endpoints(df, "min").first()
    assert (ends["first_value"], ends["last_value"]) == (1.0, 9.0)


def test_filters(obs):
    df = obs([("2021-01-31T23:00:00Z", "1"), ("2021-02-01", "2"), ("2022-01-01", "3")])
    assert select.filter_month(df, "2021-01").count() == 1
    assert select.filter_year(df, 2021).count() == 2
    assert select.filter_period(df, "2021-02", "2022-01").count() == 2
    assert select.filter_period(df).count() == 3
    trimmed = select.trim_normalise(
        df.withColumnRenamed("unit", " unit ").replace("rain", " rain "), ["elementId"])
    assert trimmed.columns[-1] == "unit"
    assert select.filter_series(trimmed, "rain").count() == 3


def test_station_lookup_drops_unknown(obs):
    df = obs([("SN18700:0", "2021-01-01", "PT1H", "e", "1", ""),
              ("OTHER", "2021-01-01", "PT1H", "e", "1", "")])
    assert rows(select.station_lookup(df), "sourceId", "city") == [("SN18700:0", "oslo")]


def test_annual_by_city(obs):
    df = obs([("SN18700:0", "2021-01-01", "PT1H", "e", "1", ""),
              ("SN18700:0", "2021-02-01", "PT1H", "e", "2", ""),
              ("SN90450:0", "2021-02-01", "PT1H", "e", "5", "")])
    got = stats.annual_by_city(df, "e", {"SN18700:0": "Oslo", "SN90450:0": "Tromsø"})
    assert rows(got, "city", "year", "value") == [("Oslo", 2021, 3.0), ("Tromsø", 2021, 5.0)]
