import pytest

from conftest import rows
from stationloom.schema import MAX_TEMPERATURE, MIN_TEMPERATURE, RANGE_TEMPERATURE
from stationloom.sources import readers, sinks, versions


def test_a_table_replaces_itself(spark, obs, tmp_path):
    path = str(tmp_path / "table")
    table = obs([("S1", "2021-01-01", "PT0H", e, v, "degC") for e, v in ((MAX_TEMPERATURE, "9"), (MIN_TEMPERATURE, "2"))])
    sinks._time_as_text(table).write.option("header", True).csv(path)
    assert versions.current_folder(spark, path) == path
    before = readers.read_observation_csv(spark, path)
    first = sinks.replace_with_range(before, path)
    assert versions.current_folder(spark, path) == first
    now = readers.read_observation_csv(spark, first)
    assert rows(now, "elementId", "value") == sorted(
        [(MAX_TEMPERATURE, "9"), (MIN_TEMPERATURE, "2"), (RANGE_TEMPERATURE, "7.0")], key=repr)
    assert before.count() == 2  # who reads the old version goes on reading it

    def broken(folder):
        now.write.csv(folder)
        raise RuntimeError

    with pytest.raises(RuntimeError):
        versions.replace_table(spark, path, broken)
    assert versions.current_folder(spark, path) == first
    second = versions.replace_table(spark, path, lambda folder: now.limit(1).write.option("header", True).csv(folder))
    assert second != first and versions.current_folder(spark, path) == second
    assert readers.read_observation_csv(spark, second).count() == 1
