import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from conftest import rows
from stationloom.sources import ranges, readers


@pytest.fixture()
def small_ranges(spark):
    """Ranges of about 300 bytes, so that entries, strings and escapes lie over several."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for key, value in names.items():
        spark.conf.set(key, value)
    yield
    for key in names:
        spark.conf.unset(key)


def document(n: int, seed: int) -> dict:
    draw = random.Random(seed)
    odd = ["degC", "a } b", "{", "}{", "\\", '"', '\\"{', 'x", {"data": [', "æøå }", "\n{", "", "N" * 700]
    entries = [
        {"sourceId": f"SN{i}", "referenceTime": f"2021-01-{1 + i % 28:02d}T00:00:00.000Z",
         "observations": [{"timeOffset": "PT0H", "elementId": f"e{k}{draw.choice(odd)}", "value": k, "unit": draw.choice(odd)}
                          for k in range(draw.randrange(4))]}
        for i in range(n)]
    return {"before": {"data": {"a": 1}, "x": [{"sourceId": "no"}]}, "list": [{"sourceId": "no"}, {"sourceId": "no"}],
            'tricky"data': [{"sourceId": "no"}], "data": entries, "after": [{"sourceId": "no"}, {"sourceId": "no"}], "end": "}"}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_equals_the_multi_line_reader(spark, small_ranges, tmp_path, indent, ascii_only):
    for k in range(3):
        text = json.dumps(document(30 * k + 1, k), indent=indent, ensure_ascii=ascii_only)
        (tmp_path / f"d{k}.json").write_text(text, encoding="utf-8")
    path = str(tmp_path / "*.json")
    pieces = ranges._pieces(spark, path)
    assert pieces.select("file", "range").distinct().count() > 20
    assert spark.read.option("lineSep", "{").text(path).rdd.getNumPartitions() > 20
    expected = readers.flatten_observations(readers.read_observation_json(spark, path))
    got = readers.flatten_observations(ranges.read_large_documents(spark, path))
    assert got.count() > 50
    assert rows(got) == rows(expected)


def test_several_documents_in_a_file(spark, small_ranges, tmp_path):
    lines = [json.dumps(document(n, n)) for n in (3, 5, 1)]
    (tmp_path / "d.json").write_text("\n".join(lines), encoding="utf-8")
    expected = readers.read_observation_json(spark, str(tmp_path), multi_line=False)
    got = ranges.read_large_documents(spark, str(tmp_path))
    assert rows(readers.flatten_observations(got)) == rows(readers.flatten_observations(expected))


@pytest.mark.parametrize("text", [
    "not json", "{}", '{"data": []}', '{"data": [{"sourceId": "a"}', '{"data": [{"sourceId": "a}]}',
    '{"data": [{"sourceId": }]}', '{"other": [{"sourceId": "a"}]}'])
def test_bad_documents(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text, encoding="utf-8")
    with pytest.raises((PySparkException, Py4JJavaError)):
        ranges.read_large_documents(spark, str(tmp_path)).collect()
