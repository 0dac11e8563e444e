import random
from datetime import date, timedelta

import pytest

from conftest import rows
from stationloom.operators import missing, runs
from stationloom.sources import sinks


def test_pairs_count_as_each_pair_does(spark, obs):
    rng = random.Random(5)
    days = ["1969-12-30", "1970-01-01", "2021-01-01", "2021-03-05", "2021-03-06", "bad", "2021-1-1", None]
    data = [(rng.choice("ABC"), rng.choice(days), rng.choice(["PT0H", None]), rng.choice(["e", "f"]),
             rng.choice([None, "n/a", "1", "2"]), "") for _ in range(300)]
    df = spark.createDataFrame(data, "sourceId string, referenceTime string, timeOffset string, "
                                     "elementId string, value string, unit string")
    listed = [("A", "B"), ("B", "C"), ("B", "A"), ("A", "A"), ("A", "Z"), ("A", "B"), ("A", None)]
    pairs = spark.createDataFrame(listed, "left_station string, right_station string")
    got = missing.missing_counts_for_pairs(df, pairs)
    expected = []
    for left, right in sorted({p for p in listed if p[1]}):
        one = missing.missing_counts(df, left, right, "left", "right")
        expected += [(left, right, *r) for r in rows(one, "city", "elementId", "num_missing")]
    lone = missing.missing_counts(df, "A", "Z", "left", "right")
    expected += [("A", None, *r) for r in rows(lone, "city", "elementId", "num_missing")]
    assert len(expected) > 12
    assert rows(got) == sorted(expected, key=repr)
    assert rows(missing.missing_counts_for_pairs(df.limit(0), pairs)) == []
    assert rows(missing.missing_counts_for_pairs(df, pairs.limit(0))) == []


@pytest.mark.parametrize("cells", ["pivot", "recorded"])
def test_appended_runs_equal_recomputed(spark, tmp_path, cells):
    rng = random.Random(7)
    data = []
    for k in range(130):
        day = date(2023, 12, 20) + timedelta(days=k)
        for element in ("e", "f"):
            if rng.random() < 0.85:
                value = rng.choice([None, 1.0]) if k % 50 > 40 else None
                data.append((day, "PT0H", element, value, 1.0))
    data += [(None, "PT0H", "e", None, 1.0), data[3]]
    table = spark.createDataFrame(
        data, "date date, timeOffset string, elementId string, left_value double, right_value double")
    whole = rows(missing.missing_runs(table, "left_value", cells, ["e", "f"]))
    path = str(tmp_path / "runs")
    for part in ("date >= '2024-02-15'", "date < '2024-01-31'", "date >= '2024-01-31' AND date < '2024-02-15'",
                 "date < '2024-01-31'"):
        sinks.append_run_summary(runs.run_summary(table.where(part), "left_value", cells, ["e", "f"]), path)
    stored = spark.read.parquet(path)
    assert len(whole) > 4
    assert rows(runs.runs_of_summaries(stored)) == whole
    merged = runs.merge_run_summaries(stored)
    assert rows(runs.runs_of_summaries(merged)) == whole
    assert rows(runs.runs_of_summaries(stored.limit(0))) == []


def test_a_block_of_days_is_one_row(spark):
    """Repeated rows, values and nulls of a station's 64 days go to its pairs together."""
    data = [("A", f"2021-01-{1 + k % 20:02}", "PT0H", "e", "1" if k % 3 else None, "") for k in range(100)]
    df = spark.createDataFrame(data, "sourceId string, referenceTime string, timeOffset string, "
                                     "elementId string, value string, unit string")
    words = missing._day_words(missing._cells(df, None, df["sourceId"]))
    assert words.count() == words.select("sourceId", "elementId", "timeOffset", "block", "odd").distinct().count() == 1
    total = sum(bin(w["word"] & (2 ** 64 - 1)).count("1") << w["digit"]
                for r in words.collect() for w in r["words"] if w["kind"] != "present")
    assert total == 100
