from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="warehouse-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def obs(spark):
    """Build observations from ``(time, value)`` pairs or full tuples."""
    from pyspark.sql import functions as F

    def build(rows, element="rain", source="S1", offset="PT1H", value_type="string"):
        full = []
        for row in rows:
            if len(row) == 2:
                full.append((source, row[0], offset, element, row[1], "mm"))
            else:
                full.append(row)
        schema = ("sourceId string, referenceTime string, timeOffset string, "
                  f"elementId string, value {value_type}, unit string")
        df = spark.createDataFrame(full, schema)
        return df.withColumn("referenceTime", F.try_to_timestamp("referenceTime"))

    return build


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
