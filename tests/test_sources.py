import json
from datetime import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from stationloom.operators import change, select, stats
from stationloom.plans.ingest import ingest_documents
from stationloom.schema import (
    MAX_TEMPERATURE,
    MIN_TEMPERATURE,
    OBSERVATION_COLUMNS,
    MissingColumnError,
)
from stationloom.sources import catalogue, readers, sinks

DOCUMENT = {"data": [
    {"sourceId": "SN18700:0", "referenceTime": "2021-01-01T00:00:00.000Z", "observations": [
        {"timeOffset": "PT0H", "elementId": MAX_TEMPERATURE, "value": 15.2, "unit": "degC"},
        {"elementId": MIN_TEMPERATURE, "value": 5.7},
    ]},
    {"sourceId": "S2", "referenceTime": "2021-01-01T00:00:00.000Z", "observations": []},
    {"sourceId": "S3", "referenceTime": "2021-01-01T00:00:00.000Z"},
]}


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_flatten(spark, tmp_path):
    path = write(tmp_path / "doc.json", json.dumps(DOCUMENT, indent=2))
    got = readers.flatten_observations(readers.read_observation_json(spark, path, strict=True))
    assert rows(got, "sourceId", "timeOffset", "value", "unit") == [
        ("SN18700:0", "PT0H", "15.2", "degC"), ("SN18700:0", None, "5.7", "N/A")]
    table = ingest_documents(readers.read_observation_json(spark, path))
    assert table.count() == 4
    assert dict(table.dtypes)["referenceTime"] == "timestamp"


@pytest.mark.parametrize("text", ["not json", "{}", '{"data": []}'])
def test_bad_documents(spark, tmp_path, text):
    path = write(tmp_path / "doc.json", text)
    with pytest.raises(ValueError):
        readers.read_observation_json(spark, path, strict=True)
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_observation_json(spark, path).collect()


def test_city_files(spark, tmp_path):
    header = "foo,elementId,timeOffset,referenceTime,value\n"
    write(tmp_path / "vaerdata_oslo.csv",
          header + "1,rain,PT1H,2021-01-01T02:00:00+02:00,5\n2,rain,PT1H,bad,n/a\n")
    write(tmp_path / "vaerdata_tromso.csv", "foo\n1\n")
    got = readers.read_city_observations(spark, str(tmp_path), "oslo")
    assert rows(got.select(F.date_format("referenceTime", "yyyy-MM-dd HH").alias("t"), "value")) == [
        ("2021-01-01 00", "5"), (None, None)]
    write(tmp_path / "vaerdata_oslo_imputert.csv", header)
    assert readers.read_city_observations(spark, str(tmp_path), "oslo").isEmpty()
    assert readers.read_city_observations(spark, str(tmp_path), "oslo", "raw").count() == 2
    with pytest.raises(MissingColumnError):
        readers.read_city_observations(spark, str(tmp_path), "tromso")
    with pytest.raises(FileNotFoundError):
        readers.read_city_observations(spark, str(tmp_path), "bergen")
    with pytest.raises(ValueError):
        readers.read_city_observations(spark, str(tmp_path), "oslo", "other")


def test_missing_table(spark, tmp_path):
    path = write(tmp_path / "m.csv",
                 "date,timeOffset,elementId,oslo_value,tromso_value,city\n"
                 "2021-01-01,PT0H,e,,5,Oslo\nbad,PT0H,e,1,NaN,Tromsø\n")
    got = readers.read_missing_table(spark, path)
    assert [r["date"] is None for r in got.collect()] == [False, True]
    assert rows(got, "left_value", "right_value") == [("1", None), (None, "5")]
    with pytest.raises(FileNotFoundError):
        readers.read_missing_table(spark, str(tmp_path / "none.csv"))


@pytest.fixture()
def table(obs):
    return obs([
        ("SN18700:0", "2020-12-31", "PT0H", MAX_TEMPERATURE, "7.5", "degC"),
        ("SN18700:0", "2020-12-31", "PT0H", MIN_TEMPERATURE, "2", "degC"),
        ("SN90450:0", "2021-01-01", "PT6H", MAX_TEMPERATURE, "1.23456", "degC"),
        ("OTHER", "2021-01-01", "PT6H", MAX_TEMPERATURE, "1", "degC"),
    ])


def test_table_scan_prunes(spark, table, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_observation_table(table, path)
    got = readers.scan_observations(
        spark, path, ["SN18700:0"], [MAX_TEMPERATURE], "2020-01-01", "2020-12-31")
    assert rows(got, "sourceId", "value") == [("SN18700:0", "7.5")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "year" in scan[:scan.index("PushedFilters")]
    assert "sourceId" in scan[scan.index("PushedFilters"):]
    assert "elementId" in scan[scan.index("PushedFilters"):]


def test_by_station(spark, table, tmp_path):
    path = str(tmp_path / "cities")
    sinks.write_by_station(table, path)
    back = spark.read.option("header", True).csv(path)
    assert rows(back.groupBy("city").count()) == [("oslo", 2), ("tromso", 1)]


def test_range_and_imputed_files(spark, table, tmp_path):
    sinks.write_with_range(table, str(tmp_path / "range"))
    back = readers.read_observation_csv(spark, str(tmp_path / "range"))
    assert back.count() == 4 + 3
    sinks.write_imputed(
        table.withColumn("value", F.col("value").cast("double")), str(tmp_path / "imputed"))
    imputed = spark.read.option("header", True).csv(str(tmp_path / "imputed"))
    assert imputed.columns == OBSERVATION_COLUMNS
    assert rows(imputed, "value") == [("1.000",), ("1.235",), ("2.000",), ("7.500",)]


def test_missing_report(spark, tmp_path):
    found = spark.createDataFrame(
        [("2021-01-01", "PT0H", "e", None, "1", "Oslo")],
        "date string, timeOffset string, elementId string, left_value string, "
        "right_value string, city string")
    sinks.write_missing_report(found, str(tmp_path / "report"))
    back = spark.read.option("header", True).csv(str(tmp_path / "report" / "missing_summary"))
    assert rows(back) == [("Oslo", "e", "1")]
    assert readers.read_missing_table(
        spark, str(tmp_path / "report" / "missing_in_both"), "left_value", "right_value"
    ).count() == 1


def test_json_round_trip(spark, obs, tmp_path):
    data = [("S", "2021-01-01", "PT0H", f"e{i}", str(i), "mm") for i in range(9)]
    data.append(("S", "2021-01-01", "PT6H", "e1", "7", "mm"))
    data.append(("T", "2021-01-02", "PT0H", "e", "1", "mm"))
    path = str(tmp_path / "json")
    sinks.write_observation_json(obs(data), path)
    documents = readers.read_observation_json(spark, path, multi_line=False)
    back = readers.flatten_observations(documents)
    assert rows(back, "sourceId", "timeOffset", "elementId", "value") == sorted(
        ((d[0], d[2], d[3], d[4]) for d in data), key=repr)
    assert documents.count() == 3


@pytest.fixture()
def history(obs):
    return obs([
        ("S", f"{year}-0{month}-0{day}", offset, "e", str(year + month + day), "mm")
        for year in (2019, 2020, 2021) for month in (1, 2) for day in (1, 5)
        for offset in ("PT6H", "PT18H")
    ] + [("S", "2018-03-01", "PT0H", "e", "7", "mm"), ("T", "2021-01-01", "PT6H", "e", "8", "mm")])


def test_catalogue_follows_the_table(spark, history, tmp_path):
    path = str(tmp_path / "table")
    late = F.col("referenceTime") >= F.lit("2020-02-01").cast("timestamp")
    sinks.write_observation_table(history.where(~late), path)
    sinks.write_observation_table(history.where(late), path, "append")
    got = catalogue.read_catalogue(spark, path)
    assert rows(got) == rows(catalogue.series_catalogue(history)) and catalogue.stale_years(spark, path) == []
    assert spark.read.parquet(path).count() == history.count()
    # a year replaced by fewer rows, other years untouched
    sinks.write_observation_table(select.filter_month(history, "2020-01"), path)
    fewer = history.where((F.year("referenceTime") != 2020) | (F.month("referenceTime") == 1))
    assert rows(catalogue.read_catalogue(spark, path)) == rows(catalogue.series_catalogue(fewer))
    # files that came by another way
    fewer.where(F.year("referenceTime") == 2019).withColumn("year", F.lit(2019)).write.mode("append").partitionBy("year").parquet(path)
    assert catalogue.stale_years(spark, path) == [2019]
    catalogue.rebuild_catalogue(spark, path, catalogue.stale_years(spark, path))
    assert catalogue.stale_years(spark, path) == []
    some = rows(catalogue.read_catalogue(spark, path))
    catalogue.rebuild_catalogue(spark, path)
    assert rows(catalogue.read_catalogue(spark, path)) == some


def test_catalogue_of_rows_without_time_and_of_nothing(spark, obs, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_observation_table(obs([("S", "bad", "PT6H", "e", "1", "mm"), ("S", "2020-01-01", "PT6H", "e", "1", "mm")]), path)
    assert rows(catalogue.read_catalogue(spark, path), "year", "rows", "first") == sorted(
        [(None, 1, None), (2020, 1, datetime(2020, 1, 1))], key=repr)
    assert catalogue.stale_years(spark, path) == []
    catalogue.rebuild_catalogue(spark, path, [None])
    assert catalogue.read_catalogue(spark, path).count() == 2


@pytest.mark.parametrize("name", ["month", "year", "period", "raw"])
def test_offsets_from_the_catalogue(spark, history, tmp_path, name):
    """Same results, and observations are scanned once, in the years asked for."""
    path = str(tmp_path / "table")
    sinks.write_observation_table(history, path)
    table = spark.read.parquet(path)
    run = {
        "month": lambda df, **o: stats.month_stats(df, "2021-01", **o),
        "year": lambda df, **o: stats.yearly(df, "mean", year=2021, **o),
        "period": lambda df, **o: change.period_stat(df, "mean", "D", start="2021-01-02", end="2021-02-01", **o),
        "raw": lambda df, **o: select.yearly_raw(df, "e", 2021, **o).drop("year"),
    }[name]
    found = run(table, catalogue=catalogue.read_catalogue(spark, path))
    assert rows(found) == rows(run(history))
    # the smallest offset is that of 2018, which S does not have in 2021
    assert {r["sourceId"] for r in found.select("sourceId").collect()} <= {"T"}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    physical = found._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in physical.split("\n") if "FileScan parquet" in line or "Scan parquet" in line]
    own = [line for line in scans if "value:" in line[line.index("ReadSchema"):]]
    assert len(scans) == 2
    assert len(own) == 1 and "year" in own[0][own[0].index("PartitionFilters"):own[0].index("PushedFilters")], plan


@pytest.mark.parametrize("with_sketches", [False, True])
def test_rows_are_looked_at_once(spark, tmp_path, with_sketches):
    """The catalogue was made from a second look at the rows, the sketches from a third."""
    path, looks = str(tmp_path / "table"), spark.sparkContext.accumulator(0)

    def looked(row):
        looks.add(1)
        return row

    for mode, n in (("overwrite", 3000), ("append", 200)):
        data = [("S", datetime(2001, 1, 1 + i % 28), "PT0H", "e", float(i), "mm") for i in range(n)]
        df = spark.createDataFrame(
            spark.sparkContext.parallelize(data, 2).map(looked),
            "sourceId string, referenceTime timestamp, timeOffset string, elementId string, value double, unit string")
        sinks.write_observation_table(df, path, mode, sketches=with_sketches)
    assert looks.value == 3200
    assert [r["rows"] for r in catalogue.read_catalogue(spark, path).collect()] == [3200]
    assert not catalogue.stale_years(spark, path)
